"""CSV reading: lines, cells, headers."""

import csv
import io

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from feedgate.contract import Field, TableContract
from feedgate.functions import csv_cells, decimals, uuids
from feedgate.operators import parse
from feedgate.sources import csv_feed
from feedgate.sources.inventory import FeedError

ABC = TableContract("abc", "a", (Field("a"), Field("b"), Field("c")))


def by_hand(line):
    """Cells of a line by the rule: quotes toggle, a doubled quote inside stands for one."""
    cells, cell, inside, i = [], "", False, 0
    while i < len(line):
        ch = line[i]
        if ch == '"':
            if inside and line[i + 1 : i + 2] == '"':
                cell, i = cell + '"', i + 1
            else:
                inside = not inside
        elif ch == "," and not inside:
            cells.append(cell)
            cell = ""
        else:
            cell += ch
        i += 1
    return cells + [cell]


LINES = [
    "a,b,c", ",,", "", "a", 'a,"b,c",d', '"a ""q""", b', '"d"e,f', 'x"y,z"w,v', '"open, to the end',
    '"""",""', '"a""b"c"d"', " lead , trail ", '"a" ,b', "a\\,b", '"a\\",b"', "#note,x", 'é,"😀"',
    '""x""', '"a"b,"c"', "a,b,c,d,e",
]


def cells_of(spark, lines):
    rows = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "i int, line string")
    numbers = {f"k{i}": i for i in range(6)}
    found = csv_cells.bound(rows, numbers).orderBy("i").collect()
    return [[r[f"k{i}"] for i in range(6)] for r in found]


def expected(lines):
    return [[(by_hand(l) + [""] * 6)[i] or None for i in range(6)] for l in lines]


def test_cells(spark):
    assert cells_of(spark, LINES) == expected(LINES)


def test_cells_of_random_lines(spark):
    lines = []
    draw = st.lists(st.text('ab",  \\\'#é', max_size=14), min_size=400, max_size=400)

    @settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
    @given(draw)
    def collect(found):
        lines.extend(found)

    collect()
    import random

    shuffle = random.Random(5)
    lines += ["".join(shuffle.choice('ab",, "') for _ in range(12)) for _ in range(2000)]
    assert cells_of(spark, lines) == expected(lines)


def test_long_quoted_cell(spark):
    inner = '{""k"":""' + "v" * 50 + '""},' * 20_000
    (found,) = cells_of(spark, [f'x,"{inner}",y"z"'])
    assert found[:3] == by_hand(f'x,"{inner}",y"z"')


def test_line_of_very_many_cells(spark):
    (found,) = cells_of(spark, ["a,b," + "," * 50_000])
    assert found == ["a", "b", None, None, None, None]


def read(spark, folder, **options):
    rows = csv_feed.read_csv_feed(spark, folder, ABC, **options)
    return [tuple(r) for r in rows.orderBy("_at").select("a", "b", "c").collect()]


def test_header_binding(spark, write):
    folder = write("feed", {"x.csv": ' C ,B,extra,b\n3,2,9,8\n\n   \n30\n"x, y","q ""z"" ",,,,\n'})
    assert read(spark, folder) == [(None, "2", "3"), (None, None, "30"), (None, 'q "z" ', "x, y")]


def test_files_in_order_and_suffix_in_any_case(spark, write):
    files = {"b.csv": "a,b,c\n3,,\n4,,\n", "a.CSV": "A,B,C\n1,,\n2,,", "note.txt": "zzz"}
    assert [r[0] for r in read(spark, write("feed", files))] == ["1", "2", "3", "4"]


def test_byte_order_mark_and_line_ends(spark, write):
    folder = write("feed", {"a.csv": b"\xef\xbb\xbfa,b,c\r\n1,2,3\r\n4,5,6\r\n"})
    assert read(spark, folder) == [("1", "2", "3"), ("4", "5", "6")]


def test_headers_that_differ(spark, write):
    folder = write("feed", {"a.csv": "a,b\n1,2\n", "b.csv": "b,c,a\n5,6,4\n", "c.csv": "B,C,A\n8,9,7"})
    with pytest.raises(Exception, match="header"):
        read(spark, folder)
    assert read(spark, folder, headers="per_file") == [
        ("1", "2", None), ("4", "5", "6"), ("7", "8", "9"),
    ]


def test_header_line_repeated_as_data_is_data(spark, write):
    assert read(spark, write("feed", {"a.csv": "a,b,c\na,b,c\n"})) == [("a", "b", "c")]


def test_blocks_keep_every_line_once_and_in_order(spark, write):
    from feedgate.session import block_session

    body = "".join(f"{i:05d},{'x' * (i % 40)},\n" for i in range(3000))
    folder = write("feed", {"a.csv": "a,b,c\n" + body, "b.csv": "a,b,c\n" + "z,,\n"})
    session = block_session(spark, 5_000)
    found = [r[0] for r in read(session, folder)]
    assert found == [f"{i:05d}" for i in range(3000)] + ["z"]


def test_multiline(spark, write):
    text = 'a,b,c\n1,"two\nlines",3\n4,"q ""x"", \n y",6\n'
    assert read(spark, write("feed", {"a.csv": text}), multiline=True) == [
        ("1", "two\nlines", "3"), ("4", 'q "x", \n y', "6"),
    ]


def test_refused_feeds(spark, write, tmp_path):
    with pytest.raises(FeedError, match="no feed at"):
        read(spark, str(tmp_path / "nowhere"))
    with pytest.raises(FeedError, match="nothing that looks like csv"):
        read(spark, write("none", {"a.json": "[]"}))
    with pytest.raises(FeedError, match="zero bytes"):
        read(spark, write("empty", {"a.csv": "", "b.csv": "a\n1\n"}))


def test_short_row_of_typed_columns(spark, write):
    contract = TableContract(
        "t", "id", (Field("id", "uuid"), Field("d", "date"), Field("n", "decimal"),
                    Field("f", "boolean"), Field("l", "list"), Field("j", "json"), Field("s")),
    )
    folder = write("feed", {"a.csv": "id,d,n,f,l,j,s\n,\n"})
    (row,) = parse.parse_csv(csv_feed.read_csv_feed(spark, folder, contract), contract).collect()
    assert (row.id, row.d, row.n, row.f, row.l, row.j, row.s) == (None,) * 4 + ([], None, " ")
    assert row._parse_error is None


@pytest.mark.parametrize(
    "raw, items",
    [
        ("[a,b]", ["a", "b"]), ('["a","b,c"]', ["a", "b", "c"]), (" [ x ,, y ] ", ["x", "y"]),
        ("[]", []), ("a", ["a"]), ('"a', ["a"]), ('["",""]', []), ('["a""]', ['a"']),
    ],
)
def test_lists(spark, raw, items):
    (row,) = spark.createDataFrame([(raw,)], "v string").select(
        csv_cells.text_list(F.col("v")).alias("x")
    ).collect()
    assert row.x == items


def test_booleans(spark):
    cells = ["true", "TRUE", "False", "yes", "1", " true", "t"]
    rows = spark.createDataFrame([(c,) for c in cells], "v string")
    found = [r[0] for r in rows.select(csv_cells.boolean(F.col("v"))).collect()]
    assert found == [True, True, False, None, None, None, None]


def test_decimals_match_exact_arithmetic(spark):
    import random
    from decimal import Decimal, localcontext

    draw = random.Random(3)
    texts = ["+007.50", "-0.00", ".5", "5.", "-.5", "1e-3", "12.34E-1", "1E+400", "9" * 60 + ".1"]
    for _ in range(500):
        digits = "".join(draw.choice("0123456789") for _ in range(draw.randint(1, 12)))
        at = draw.randint(0, len(digits))
        text = draw.choice(["", "+", "-"]) + digits[:at] + "." + digits[at:]
        texts.append(text + draw.choice(["", f"e{draw.randint(-20, 20)}"]))
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    found = [r[0] for r in rows.select(decimals.plain(F.col("v"))).collect()]
    with localcontext() as context:
        context.prec = 2000
        for text, plain in zip(texts, found):
            assert Decimal(plain) == Decimal(text), text
            assert "e" not in plain.lower() and not plain.startswith(("+", "."))
            assert plain.split(".")[0].lstrip("-") == "0" or plain.lstrip("-")[0] != "0"


def test_long_exponents_stay_exponents(spark):
    from decimal import Decimal

    texts = ["1e1000", "-12.50E+4000", ".00070e-5000", "0e9999", "+005e2000", "900e-1000"]
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    found = [r[0] for r in rows.select(decimals.plain(F.col("v"))).collect()]
    assert found == ["1E+1000", "-1.250E+4001", "7.0E-5004", "0", "5E+2000", "9.00E-998"]
    assert [Decimal(f) for f in found] == [Decimal(t) for t in texts]


def test_no_decimals(spark):
    texts = ["abc", "1,5", " 1", "1 ", ".", "", "-", "1e", "0x1", "NaN", "Infinity", "1e99999999999"]
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    assert {r[0] for r in rows.select(decimals.plain(F.col("v"))).collect()} == {None}


def test_lenient_identifiers(spark):
    texts = ["1-1-1-1-1", "7D0F1A52-93c4-4e0b-8a6d-2b1c5e9f3000", "x-1-1-1-1", "", "1-1-1-1",
             "123456789-1-1-1-1"]
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    strict, lenient = zip(*rows.select(
        uuids.canonical(F.col("v")), uuids.canonical(F.col("v"), lenient=True)
    ).collect())
    folded = "7d0f1a52-93c4-4e0b-8a6d-2b1c5e9f3000"
    assert strict == (None, folded, None, None, None, None)
    assert lenient == (
        "00000001-0001-0001-0001-000000000001", folded, None, None, None,
        "23456789-0001-0001-0001-000000000001",
    )


def test_render_and_read_back(spark, tmp_path):
    from feedgate.sinks.feed_writer import write_csv_rows

    values = [("1", ' "quoted", x', "#c"), ("2", None, " blank "), ("3", "a\\", 'b"c')]
    rows = spark.createDataFrame(values, "a string, b string, c string")
    write_csv_rows(rows, str(tmp_path / "out"))
    assert sorted(read(spark, str(tmp_path / "out"))) == values
    assert list(csv.reader(io.StringIO('"a"'))) == [["a"]]


def test_long_files_as_spark_reads_them(spark, write):
    """Lines of files with tasks of their own, read as text, are those of Spark's CSV reader."""
    from feedgate.sources import csv_feed

    path = write("feed", {
        "a.csv": b"id,name\r\n1,x\r\n\r\nid,name\r\n2,\"a,b\"\r\n",
        "b.csv": b"\xef\xbb\xbfID,Name\n3,\xff\xc3y\n   \n4,\"open\n",
        "c.csv": b"\n \nid,name\n5,\x00z\n",
        "d.csv": b"id,name",
        "e.csv": b"id,name\n" + b"".join(b"%d,%s\n" % (i, b"w" * (i % 50)) for i in range(100, 400)),
    })
    want = csv_feed.read_lines(spark, path, "id,name")
    got = csv_feed.read_long_files(spark, path, "id,name")
    assert "Scan csv" not in got._jdf.queryExecution().toString()
    assert got.columns == want.columns and got.schema["_at"].dataType == want.schema["_at"].dataType
    pick = lambda df: [(r._source_file[-5:], r.line) for r in df.orderBy("_at.file", "_at.block", "_at.seq").collect()]
    assert pick(got) == pick(want) and len(pick(got)) > 300


def test_long_files_check_their_header(spark, write):
    from feedgate.sources import csv_feed

    path = write("feed", {"a.csv": "id,name\n1,x\n", "b.csv": "name,id\n1,x\n"})
    with pytest.raises(Exception, match="header"):
        csv_feed.read_long_files(spark, path, "id,name").collect()
    assert csv_feed.read_long_files(spark, path, "id,name", check_header=False).count() == 2


def test_cells_of_lines_without_quotes(spark):
    """A line without a quote is cut at its commas, whatever else stands in it."""
    from feedgate.functions import csv_cells

    lines = ["a,b,c", "a,,c", ",,", "a", "", "a,b,c,d", " a , b ,c ", "\u0000,￿,x", "#a,b,c", "a" * 30000 + ",b,c", 'a,"b",c']
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, line string")
    found = csv_cells.bound(rows, {"x": 0, "y": 1, "z": 2}).orderBy("i").collect()
    for row, line in zip(found, lines):
        cells = line.replace('"', "").split(",") + [None] * 3
        assert [row.x, row.y, row.z] == [c or None for c in cells[:3]]
