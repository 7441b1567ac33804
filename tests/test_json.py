"""JSON reading: documents, lines, field kinds, and arrays cut at record borders."""

import json
import random

import pytest
from conftest import record
from pyspark.sql import functions as F

from feedgate.contract import Field, TableContract
from feedgate.operators import parse
from feedgate.session import block_session
from feedgate.sources import json_chunks, json_feed

KINDS = TableContract(
    "kinds", "u",
    (Field("u", "uuid"), Field("t"), Field("d", "date"), Field("n", "decimal"),
     Field("f", "boolean"), Field("l", "list"), Field("j", "json")),
)
U = "7d0f1a52-93c4-4e0b-8a6d-2b1c5e9f3000"


@pytest.fixture
def parsed(spark, write):
    def run(text, **options):
        folder = write("feed", {"a.json": text})
        feed = json_feed.read_json_feed(spark, folder, **options)
        return parse.parse_json(feed, KINDS).orderBy("_at").collect()

    return run


def test_missing_and_null(parsed):
    (row,) = parsed('{"t":null,"l":null,"j":null,"n":null}')
    assert (row.u, row.t, row.d, row.n, row.f, row.l, row.j) == (None, " ", None, None, None, [], None)
    assert row._parse_error is None


def test_empty_text_is_kept_but_no_value(parsed):
    assert parsed('{"t":""}')[0].t == ""
    assert parsed('{"u":""}')[0]._parse_error == "Invalid UUID for field 'u': "
    assert parsed('{"d":""}')[0]._parse_error == "Invalid date for field 'd': "


@pytest.mark.parametrize(
    "field, error",
    [
        ('"f":"true"', "Invalid boolean for field 'f': true"),
        ('"f":1', "Invalid boolean for field 'f': 1"),
        ('"f":{"a":1}', "Invalid boolean for field 'f': "),
        ('"n":"64250"', "Invalid decimal for field 'n': 64250"),
        ('"n":true', "Invalid decimal for field 'n': true"),
        ('"n":1e400', "Invalid decimal for field 'n': Infinity"),
        ('"d":20240115', "Invalid date for field 'd': 20240115"),
        ('"u":[1]', "Invalid UUID for field 'u': "),
        ('"u":"x","d":"y","n":"z"', "Invalid UUID for field 'u': x"),
    ],
)
def test_type_strict_errors(parsed, field, error):
    assert parsed("{" + field + "}")[0]._parse_error == error


def test_all_errors(spark, write):
    folder = write("feed", {"a.json": '{"u":"x","d":"y","n":"z"}'})
    (row,) = parse.parse_json(json_feed.read_json_feed(spark, folder), KINDS, all_errors=True).collect()
    assert row._parse_error == (
        "Invalid UUID for field 'u': x; Invalid date for field 'd': y; Invalid decimal for field 'n': z"
    )


@pytest.mark.parametrize(
    "number, plain",
    [("64250.50", "64250.5"), ("-1", "-1"), ("1e3", "1000.0"), ("0.10", "0.1"),
     ("123456789.123456789123", "123456789.123456789123"),
     ("12345678901234567890123456789012345678", "12345678901234567890123456789012345678")],
)
def test_numbers(parsed, number, plain):
    assert parsed(f'{{"n":{number}}}')[0].n == plain


@pytest.mark.parametrize(
    "value, text",
    [("5", "5"), ("true", "true"), ('"{x"', "{x"), ('"[1]"', "[1]"), ("[1]", ""), ('{"a":1}', ""),
     ('"é😀"', "é😀")],
)
def test_scalars_as_text(parsed, value, text):
    assert parsed(f'{{"t":{value}}}')[0].t == text


@pytest.mark.parametrize(
    "value, items",
    [('["a",1,null,true,{"x":1},[2],"[y"]', ["a", "1", "null", "true", "", "", "[y"]), ("[]", []),
     ('"a,b"', []), ("{}", [])],
)
def test_lists(parsed, value, items):
    assert parsed(f'{{"l":{value}}}')[0].l == items


def test_json_columns(parsed):
    assert json.loads(parsed('{"j":{"b":1,"a":[true,null]}}')[0].j) == {"a": [True, None], "b": 1}
    assert parsed('{"j":"text"}')[0].j == '"text"'


def test_repeated_key_keeps_the_last(parsed):
    assert [r.t for r in parsed('[{"t":"x","t":"y"},{"t":"z"}]')] == ["y", "z"]


def test_documents(parsed):
    assert parsed("[]") == []
    assert len(parsed('[{"t":"a"},null,5,"x"]')) == 4
    assert len(parsed('{"t":"a"} trailing')) == 1
    (row,) = parsed("{half a record")
    assert row._parse_error == json_feed.MALFORMED


def test_malformed_document_spoils_only_itself(spark, write):
    files = {"a.json": '[{"t":"a"},{"t":', "b.json": '[{"t":"b"},{"t":"c"}]'}
    rows = parse.parse_json(json_feed.read_json_feed(spark, write("feed", files)), KINDS)
    assert sorted((r.t, r._parse_error) for r in rows.collect()) == [
        (" ", json_feed.MALFORMED), ("b", None), ("c", None)
    ]


def test_lines(parsed):
    rows = parsed('{"t":"a"}\n\n  \n{broken\n{"t":"b","t":"c"}\n', layout="lines")
    assert [(r.t, r._parse_error) for r in rows] == [
        ("a", None), (" ", json_feed.MALFORMED_LINE), ("c", None)
    ]


def test_unknown_layout(parsed):
    with pytest.raises(ValueError):
        parsed("[]", layout="xml")


# --- arrays cut at record borders --------------------------------------------------------


def any_value(draw, depth=0):
    kind = draw.random()
    if kind < 0.25 and depth < 3:
        return {draw.choice('abc}{"\\'): any_value(draw, depth + 1) for _ in range(draw.randint(0, 3))}
    if kind < 0.4 and depth < 3:
        return [any_value(draw, depth + 1) for _ in range(draw.randint(0, 3))]
    return draw.choice(
        [1, 2.5, None, True, "}", "{", "\\", '"', '\\"}', "[,]", "é}", 'plain { "text" }', "x" * 50]
    )


def documents():
    draw = random.Random(7)
    made = {}
    for number, indent in enumerate([None, 2, None]):
        elements = [
            {"id": k, "v": any_value(draw)} if draw.random() < 0.93
            else draw.choice([k, None, "s}", [{"q": 1}], True])
            for k in range(150)
        ]
        text = json.dumps(elements, indent=indent, ensure_ascii=number == 2)
        made[f"d{number}.json"] = (elements, ("  \n" if number == 2 else "") + text + "\n" * number)
    made["empty.json"] = ([], " [ ] ")
    made["scalars.json"] = ([1, 2, "a"], '[1, 2,"a"]')
    return made


BROKEN = {
    "cut.json": '[{"a":1},{"b":2},{"c":3}', "word.json": '[{"a":1},{"b":x},{"c":3}]',
    "comma.json": '[{"a":1} {"b":1},{"c":3}]', "open.json": '[{"a":"1},{"b":1},{"c":3}]',
}


def _records(chunks):
    return json_chunks.records(chunks)


@pytest.mark.parametrize("block, pack", [(150, 1), (1000, 400), (1 << 30, 300), (1 << 30, 1 << 20)])
def test_arrays_cut_at_record_borders(spark, write, block, pack):
    made = documents()
    folder = write("feed", {n: text for n, (_, text) in made.items()} | BROKEN)
    session = block_session(spark, block)
    chunks = json_chunks.staged_chunks(session, folder, pack_bytes=pack)
    found = {}
    rows = _records(chunks).select(
        "_source_file", "_at", "_doc_error", F.to_json("record").alias("j")
    )
    for row in rows.orderBy("_at").collect():
        found.setdefault(row._source_file.rsplit("/", 1)[1], []).append(
            row._doc_error or json.loads(row.j)
        )
    for name, (elements, _) in made.items():
        assert found.get(name, []) == elements, name
    for name in BROKEN:
        assert found[name] == [json_chunks.MALFORMED], name


@pytest.mark.parametrize(
    "name, value",
    [("spark.sql.execution.arrow.useLargeVarTypes", "true"),
     ("spark.sql.execution.arrow.maxRecordsPerBatch", "3")],
)
def test_arrays_under_other_batch_settings(spark, write, name, value):
    elements, text = documents()["d0.json"]
    folder = write("feed", {"d0.json": text})
    session = block_session(spark, 2000)
    session.conf.set(name, value)
    rows = _records(json_chunks.staged_chunks(session, folder, pack_bytes=500))
    found = rows.orderBy("_at").select(F.to_json("record").alias("j")).collect()
    assert [json.loads(r.j) for r in found] == elements


def test_record_that_is_too_long_is_refused(spark, write):
    folder = write("feed", {"a.json": json.dumps([{"a": "x" * 5000}, {"b": 1}]), "b.json": '[{"c":1}]'})
    chunks = json_chunks.read_chunks(block_session(spark, 300), folder, max_record_bytes=2000)
    rows = _records(chunks).collect()
    assert sorted((r._source_file[-6:], r._doc_error) for r in rows) == [
        ("a.json", json_chunks.MALFORMED), ("b.json", None)
    ]


def test_large_and_small_documents_in_one_feed(spark, write):
    many = [record(first_name=f"Name{i}") for i in range(300)]
    folder = write("feed", {"big.json": json.dumps(many), "small.json": json.dumps(many[:2])})
    feed = json_feed.read_json_feed(spark, folder, max_document_bytes=10_000)
    assert feed.count() == 302
    assert feed.filter("_source_file like '%big.json'").count() == 300


def test_shares_cover_all_files_once(spark, write, monkeypatch):
    folder = write("feed", {f"{i}.json": f'[{{"t":"{i}"}}]' for i in range(12)})
    monkeypatch.setattr(json_chunks, "MAX_BLOCKS", 3)
    assert len(json_chunks.shares(spark, folder)) == 4
    rows = parse.parse_json(json_feed.read_large_documents(spark, folder, -1), KINDS)
    assert sorted(r.t for r in rows.collect()) == sorted(str(i) for i in range(12))


def test_documents_of_all_kinds_whole_and_cut(spark, write):
    kinds = {
        "object.json": '{"a":{"z":1},"b":{"z":2}}', "array.json": '[{"a":1},{"a":{"b":2}}]', "blank.json": " \n ",
        "number.json": "5", "text.json": '"}"', "nulls.json": '[null,{"a":null}]', "nested.json": "[[{}],[]]",
        "word.json": "{half", "cut.json": '[{"a":1},', "tail.json": '{"a":1} tail',
    }
    folder = write("feed", kinds)

    def read(limit):
        feed = json_feed.read_json_feed(spark, folder, max_document_bytes=limit)
        rows = feed.orderBy("_at").select("_source_file", "_source_time", "_doc_error", F.to_json("record").alias("j"))
        return [tuple(r) for r in rows.collect()]

    assert read(0) == read(1 << 30) and len(read(0)) == 13


def _read_cut(session, folder, most):
    feed = json_feed.read_large_documents(session, folder, -1, max_record_bytes=most)
    rows = feed.orderBy("_at").select("_source_file", "_doc_error", F.to_json("record").alias("j"))
    return [tuple(r) for r in rows.collect()]


@pytest.mark.parametrize("block", [200, 1 << 30])
def test_any_array_has_borders_and_objects_are_tried_whole(spark, write, block):
    made = {
        "scalars.json": json.dumps([*range(3000), "a,]", None, True]), "nested.json": json.dumps([[i, [{"a": [i]}]] for i in range(500)]),
        "one.json": json.dumps({"all": [{"a": i} for i in range(500)]}), "text.json": json.dumps("x," * 2000),
        "empty.json": "[ ]", "tail.json": "[1, 2] 3, [4", "comma.json": "[1,2,]", "blank.json": "[1,,2]", "first.json": "[,1]",
        "open.json": "[1,2", "open2.json": "[1,2,", "braces.json": "[1,2}, 3]", "tab.json": "\n[1\n,\t[2]\n]\n",
    }
    folder = write("feed", made)
    whole = json_feed.read_json_feed(spark, folder, max_document_bytes=1 << 30)
    rows = whole.orderBy("_at").select("_source_file", "_doc_error", F.to_json("record").alias("j"))
    assert _read_cut(block_session(spark, block), folder, 1000) == [tuple(r) for r in rows.collect()]


@pytest.mark.parametrize("block", [300, 1 << 30])
def test_only_the_oversized_record_is_an_error(spark, write, block):
    sizes = [10, 10, 5000, 10, 900, 10, 7000, 8000, 10, 6000]
    records = [{"i": i, "a": "x, " * (n // 3)} for i, n in enumerate(sizes)]
    folder = write("feed", {"a.json": json.dumps(records), "b.json": json.dumps([records[2], 1, 2]), "c.json": json.dumps([records[2]])})
    found = {}
    for path, error, text in _read_cut(block_session(spark, block), folder, 2000):
        found.setdefault(path[-6:], []).append(error or json.loads(text))
    assert found == {
        "a.json": [json_chunks.OVERSIZED if n > 2000 else r for n, r in zip(sizes, records)],
        "b.json": [json_chunks.OVERSIZED, 1, 2], "c.json": [json_chunks.OVERSIZED],
    }


def wrapped(rng, records):
    """A document whose array stands inside objects, among things that look like it."""
    values = []
    for i in range(records):
        text = "".join(rng.choice(['"', "\\", "[", "]", "{", "}", ",", "rows", "x", "é", "\n"]) for _ in range(rng.randint(0, 12)))
        values.append(rng.choice([{"k": i, "t": text}, {"k": i, "rows": [{"rows": [text]}]}, i, [i, text], None, text]))
    before = {"rows": [1], "a": {"data": {"rows": [2]}}, 'x": {"data': "\"data\": {\"rows\": [", "z": "y" * rng.randint(0, 60)}
    inner = {"of": {"rows": [3]}, "rows": values, "more": [4]}
    return json.dumps(before | {"data": inner, "end": {"data": {"rows": [5]}}}, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1])), values


@pytest.mark.parametrize("block", [40, 300, 1 << 20])
def test_wrapped_arrays_cut_in_blocks_of_any_size(spark, write, block):
    rng = random.Random(block)
    texts = [wrapped(rng, n) for n in (0, 1, 30, 120)]
    folder = write("feed", {f"{i}.json": text for i, (text, _) in enumerate(texts)})
    session = block_session(spark, block)
    for limit in (0, 1 << 30):
        feed = json_feed.read_json_feed(session, folder, max_document_bytes=limit, inside="data.rows").orderBy("_at")
        got = [(r._source_file[-6], r._doc_error, r.j) for r in feed.select("_source_file", "_doc_error", F.to_json("record").alias("j")).collect()]
        want = [(str(i), None, v) for i, (_, values) in enumerate(texts) for v in values]
        assert [(f, e, None if j is None else json.loads(j)) for f, e, j in got] == want


def test_documents_without_the_array(spark, write):
    files = {"a.json": '{"data": {"other": [1]}}', "b.json": '{"data": {"rows": [1, 2]}}', "c.json": '{"data": [1]}', "d.json": "[1]", "e.json": '{"data": {"rows": {"k": 1}}}', "f.json": "nonsense"}
    folder = write("feed", files)
    for limit in (0, 1 << 30):
        feed = json_feed.read_json_feed(spark, folder, max_document_bytes=limit, inside="data.rows")
        found = sorted((r._source_file[-6], r._doc_error or "row") for r in feed.collect())
        assert found == [(c, "Malformed JSON document") for c in "a"] + [("b", "row")] * 2 + [(c, "Malformed JSON document") for c in "cdef"]
    with pytest.raises(ValueError, match="plain keys"):
        json_feed.read_json_feed(spark, folder, inside="a..b")


def test_text_is_cut_once(spark, write):
    """Whole lots and those over block borders start from written pieces, not from two cuts of the text."""
    from feedgate.sources import json_chunks

    path = write("feed", {"a.json": "[" + ",".join('{"k": %d}' % i for i in range(500)) + "]"})
    chunks = json_chunks.read_chunks(spark, path, pack_bytes=256)
    assert "MapInArrow" not in chunks._jdf.queryExecution().toString()
    assert chunks.count() > 5


def test_block_numbers_stand_once(spark, write):
    """Fragments go to the tasks alone; many small files keep their own blocks and states."""
    from feedgate.sources import json_chunks, json_feed

    files = {f"f{i:02d}.json": '[{"k": %d, "t": "[,\\""}, {"k": %d}]' % (i, i + 100) for i in range(40)}
    files["odd.json"] = '[{"k": "open, }'
    path = write("feed", files)
    fragments = json_chunks._fragments(spark, path, -1, None, (0, 1))
    assert json_chunks._headed(fragments, "file_id", "block").columns == ["value"]
    rows = json_feed.read_json_feed(spark, path, max_document_bytes=0)
    found = rows.selectExpr("try_variant_get(record, '$.k', 'int') k", "_doc_error").collect()
    assert sorted(r.k for r in found if r._doc_error is None) == [*range(40), *range(100, 140)]
    assert [r._doc_error for r in found if r._doc_error] == [json_feed.MALFORMED]


def test_joined_elements_are_the_same_array(spark, tmp_path):
    """One writer gets few long rows, which give the array that single elements give."""
    import json

    from feedgate.sinks import feed_writer

    texts = [json.dumps({"k": i, "t": "é," * (i % 7)}) for i in range(3000)]
    elements = spark.createDataFrame([(t,) for t in texts] + [(None,)], "element string").coalesce(1)
    joined = feed_writer.joined_elements(elements)
    assert joined.count() < 20
    feed_writer.write_json_arrays(joined, str(tmp_path / "out"))
    text = "".join(r.value + "\n" for r in spark.read.text(str(tmp_path / "out")).collect())
    assert [json.dumps(e) for e in json.loads(text)] == texts
