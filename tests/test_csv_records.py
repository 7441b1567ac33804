"""Quoted CSV cut in blocks against a scan of the whole text; any character; parts by bytes."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from feedgate.contract import Field, TableContract
from feedgate.plans import splitting
from feedgate.sinks import feed_writer
from feedgate.sources import csv_feed, csv_records, replay
from feedgate.sources.inventory import FeedError

AB = TableContract("ab", "a", (Field("a"), Field("b")))
#: Non-characters, controls and what quoting, comments or options could take for a sign.
ODD = "￿￾﷐﷑\x00\x01\x1c\x85 #;'\\\t|"


def scanned(data):
    """(offset, bytes, line) of each record that is not blank, by one pass over the whole text."""
    found, start, inside = [], 0, False
    for i, ch in enumerate(data + b"\n"):
        if ch == ord('"'):
            inside = not inside
        if (ch == 10 and not inside) or i == len(data):
            line = data[start:i]
            line = line[:-1] if line.endswith(b"\r") else line
            if start < len(data) and not re.fullmatch(r"\s*", line.decode()):
                found.append((start, i + 1 - start, line.decode()))
            start = i + 1
    return found


def records_of(spark, folder, block):
    rows = csv_records.read_records(spark, folder, block_bytes=block).orderBy("_at").collect()
    return [(os.path.basename(r._source_file), r._offset, r._bytes, r.line, r._first) for r in rows]


def wild(rng, records):
    """Text with quoted line breaks, doubled quotes, blank lines and both line ends."""
    out = []
    for _ in range(records):
        inner = "".join(rng.choices(["x", ",", "\n", "\r\n", '""', "é", "\n\n", "long " * 9], k=rng.randint(0, 12)))
        out.append(rng.choice([f'{rng.randint(0, 99)},"{inner}"', f'"{inner}",b', "plain,line", "", "  ", 'mid"dle\n"x,y']))
    return "a,b\n" + "".join(r + rng.choice(["\n", "\r\n"]) for r in out) + rng.choice(["", "last,one", '"open,\nto the end'])


@pytest.mark.parametrize("block", [7, 64, 1000, 1 << 27])
def test_blocks_of_any_size(spark, write, block):
    rng = random.Random(block)
    files = {f"{i}.csv": wild(rng, rng.choice([1, 8, 30])) for i in range(5)}
    folder = write("feed", files)
    want = []
    for name, text in sorted(files.items()):
        whole = scanned(text.encode())
        want += [(name, *r, i == 0) for i, r in enumerate(whole)]
    assert records_of(spark, folder, block) == want


def test_a_long_record_over_many_blocks(spark, write):
    body = "\n".join(f"line {i}" for i in range(400))
    folder = write("feed", {"a.csv": f'a,b\n1,"{body}"\n2,y\n'})
    assert [r[3] for r in records_of(spark, folder, 100)] == ["a,b", f'1,"{body}"', "2,y"]
    assert csv_records.read_records(spark, folder, block_bytes=100).rdd.getNumPartitions() > 20


def test_an_open_quote_is_refused_when_it_reaches_too_far(spark, write):
    folder = write("feed", {"a.csv": 'a,b\n1,"x\n' + "2,y\n" * 500})
    with pytest.raises(FeedError, match="does not close"):
        csv_records.read_records(spark, folder, block_bytes=200, max_record_bytes=1000)
    assert len(records_of(spark, folder, 200)) == 2  # as one record within the limit


def rows_of(spark, folder, **options):
    feed = csv_feed.read_csv_feed(spark, folder, AB, skip_empty=True, **options)
    return [(r.a, r.b) for r in feed.orderBy("_at").collect()]


@pytest.mark.parametrize("multiline", [False, True])
def test_any_character_stays(spark, write, tmp_path, multiline):
    """At line starts, inside and at the ends of cells; read, split, and read again."""
    rows = [(f"{c}k{i}", f"a{c}b") for i, c in enumerate(ODD)] + [(f"k{i}", f"v{c}") for i, c in enumerate(ODD)]
    rows += [(f"q{i}", f'{c}"{c}, {c}"') for i, c in enumerate(ODD)]
    quoted = [(a, '"' + b.replace('"', '""') + '"' if '"' in b else b) for a, b in rows]
    text = "a,b\n" + "".join(f'{a},{b}\n' for a, b in quoted)
    folder = write("feed", {"a.csv": text})
    assert rows_of(spark, folder, multiline=multiline) == rows
    parts = str(tmp_path / "parts")
    splitting.split_feed(spark, folder, parts, "csv", 60)
    assert rows_of(spark, parts, multiline=multiline) == rows
    assert len(os.listdir(parts)) > 4


def test_lines_that_look_like_signs_are_written_as_they_are(spark, tmp_path):
    lines = ["#note", '"', " x ", "\x00"]
    frame = spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1)
    feed_writer.write_csv_lines(frame, "a", str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_text() == "a\n" + "".join(x + "\n" for x in lines)


def test_multiline_headers(spark, write):
    files = {"a.csv": 'a,b\n1,"x\ny"\n', "b.csv": '"B",A\n"p\r\nq",2\n', "c.csv": "\n  \nA,B\n3,z\n"}
    folder = write("feed", files)
    with pytest.raises(Exception, match="header"):
        rows_of(spark, folder, multiline=True)
    assert rows_of(spark, folder, multiline=True, headers="per_file") == [("1", "x\ny"), ("2", "p\r\nq"), ("3", "z")]
    same = write("same", {"a.csv": files["a.csv"], "c.csv": files["c.csv"]})
    assert rows_of(spark, same, multiline=True) == [("1", "x\ny"), ("3", "z")]


def test_one_scan_for_a_hundred_layouts(spark, write):
    rng = random.Random(1)
    files, want = {}, []
    for i in range(100):
        names = [f"x{j}" for j in range(i % 7)] + ["A", "b"]
        rng.shuffle(names)
        files[f"{i:03d}.csv"] = ",".join(names) + "\n" + ",".join(f"{n.lower()}{i}" for n in names) + "\n"
        want.append((f"a{i}", f"b{i}"))
    folder = write("feed", files)
    feed = csv_feed.read_csv_feed(spark, folder, AB, headers="per_file")
    shown = feed._jdf.queryExecution().executedPlan().toString()
    assert shown.count("FileScan csv") == 1 and "Union" not in shown
    assert [(r.a, r.b) for r in feed.orderBy("_at").collect()] == want


def test_parts_are_even_by_bytes(spark, write, tmp_path):
    """Records of very different length: no part above the threshold and one record."""
    rng = random.Random(3)
    rows = [f'{i},"{"x" * rng.choice([3, 3, 3, 900])}\n"' for i in range(400)]
    folder = write("feed", {"a.csv": "a,b\n" + "\n".join(rows[:150]) + "\n", "b.csv": "a,b\n" + "\n".join(rows[150:])})
    out = tmp_path / "parts"
    splitting.split_feed(spark, folder, str(out), "csv", 4000)
    sizes = [p.stat().st_size for p in out.glob("part-*")]
    total = sum(len(r) + 1 for r in rows)
    assert len([s for s in sizes if s]) == -(-(total + 8) // 4000)
    assert max(sizes) <= 4000 + max(map(len, rows)) + len("a,b\n")
    assert rows_of(spark, str(out), multiline=True) == [(str(i), r.split('"')[1]) for i, r in enumerate(rows)]


def test_refused_records_are_fetched_by_their_bytes(spark, write):
    rng = random.Random(4)
    files = {f"{i} é.csv": wild(rng, 300) for i in range(3)}
    folder = write("feed", files)
    records = csv_records.read_records(spark, folder, block_bytes=500)
    refused = records.filter(F.crc32(F.col("line").cast("binary")) % 5 == 0)
    again = replay.refused_records(refused.select("_at"), fetch_bytes=50)
    got = sorted((r._source_file, r._at.block + r._at.seq, r.line) for r in again.collect())
    assert got == sorted((r._source_file, r._offset, r.line) for r in refused.collect()) and len(got) > 50
    size = sum(r._bytes for r in refused.collect())
    assert again.agg(F.sum("_fetched")).first()[0] <= size + 100 * len(got)
