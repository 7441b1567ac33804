"""Collocations against counts of all phrases; the partition method's bounds."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm.conftest import rows_of

from feedgate.llm import collocations
from feedgate.llm.collocations import Shard

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, support=10, longest=3, top=2000, inside=50):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered(text or "")):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if len(p) > 1 and a >= support}
        dropped = set()
        for p, longer in frequent.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if 100 * longer >= inside * counts[p[i : i + k]]:
                        dropped.add(p[i : i + k])
        scored = []
        for p in frequent.keys() - dropped:
            a = counts[p]
            cuts = [(10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def corpus(rng, docs=500):
    vocabulary = ["the", "The", "of", "new", "york", "city", "x", "é", "dom ", "a-b", "中文", "İ"] + [f"w{i}" for i in range(9)]
    ends = [" ", " ", " ", " ", "\t ", ", ", ". ", "\n", ";", " : ", "!\r\n", "?"]
    rows = []
    for i in range(docs):
        words = rng.choices(vocabulary, k=rng.randint(0, 40))
        if rng.random() < 0.5:
            words += ["new", "york", "city"]
        text = "".join(w + rng.choice(ends) for w in words)
        rows.append((rng.choice(["en", "en", "en", "de", None, "und"]), text if rng.random() < 0.97 else None))
    return rows + [("fr", "la vie"), ("xx", None), ("en", "ha " * 3000)]


@pytest.mark.parametrize("chars, bucket_bytes, partitions", [(1 << 22, 1 << 23, 1), (500, 300, 5), (4000, 2000, 3)])
def test_equals_all_counts(spark, chars, bucket_bytes, partitions):
    """One shard or many, with a local support of ten or of one, one bucket or many."""
    rows = corpus(random.Random(7))
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(partitions)
    got = collocations.collocations(docs, shard_chars=chars, bucket_bytes=bucket_bytes)
    assert got.columns == COLUMNS
    want = brute(rows)
    assert len(want) > 20 and rows_of(got, *COLUMNS) == want


def test_other_parameters(spark):
    rows = corpus(random.Random(8), 150)
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = collocations.collocations(docs, support=4, longest=4, top=15, inside=80, shard_chars=3000, bucket_bytes=1000)
    assert rows_of(got, *COLUMNS) == brute(rows, 4, 4, 15, 80)


def test_shards_hide_what_their_slack_says(spark):
    """A phrase rare in every large shard is no candidate; one that may reach the support is."""
    rows = [("en", 500, "a b. " * 9 + "c d. " * 40)] * 1 + [("en", 500, "a b. " * 1 + "e f. " * 40)]
    texts = spark.createDataFrame([(g, sum(len(t) for _, _, t in rows), t) for g, _, t in rows], "lang string, total bigint, text string")
    mined = collocations.mine(texts.coalesce(1), 10, 2, 100, 1 << 20).collect()
    assert [r.slack for r in mined] == [5, 4]  # about half of the support each, rounded up, less one
    merged = collocations._union(10)
    group = pa.Table.from_pylist([r.asDict() | {"mined": bytes(r.mined)} for r in mined])
    chosen = np.frombuffer(merged(group).column("chosen")[0].as_py(), "<u4")
    shard = Shard.of([t for _, _, t in rows])
    assert len(chosen) == len({"a", "b", "a b", "c", "d", "c d", "e", "f", "e f"})
    assert shard.words == [b"a", b"b", b"c", b"d", b"e", b"f"]


def test_large_counts_are_exact(spark):
    frequent = spark.createDataFrame(
        [("en", "x y", 2, 90_000_000_019), ("en", "x", 1, 99_999_999_977), ("en", "y", 1, 90_000_000_020), ("en", None, 0, 10**13)],
        "lang string, phrase string, words int, a bigint",
    )
    (row,) = collocations.scores(frequent).collect()
    assert row.score == 10**6 * 90_000_000_019**2 // (99_999_999_977 * 90_000_000_020)


def test_awkward_and_nothing(spark, awkward, nothing):
    rows = [(r.lang, r.text) for r in awkward.collect()]
    assert rows_of(collocations.collocations(awkward, support=2), *COLUMNS) == brute(rows, 2)
    assert collocations.collocations(nothing).count() == 0
