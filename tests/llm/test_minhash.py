"""MinHash links and components against all pairs of shingle sets."""

import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from llm.conftest import prose, rows_of
from llm.test_simhash import grouped
from pyspark.sql import functions as F

from feedgate.llm import minhash

COLUMNS = ["doc_id", "n_shingles", "component_id", "kept"]


def shingles(text, k=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^ \t-\r]+", low)
    if len(words) < k:
        return frozenset([" ".join(words)] if words else [])
    return frozenset(" ".join(words[i : i + k]) for i in range(len(words) - k + 1))


def brute(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    distinct = sorted({s for s in sets if s}, key=sorted)
    near = [
        (a, b) for a, b in combinations(range(len(distinct)), 2)
        if 100 * len(distinct[a] & distinct[b]) >= percent * len(distinct[a] | distinct[b])
    ]
    roots = grouped([(i, i) for i in range(len(distinct))] + near)
    number = {s: roots[i] for i, s in enumerate(distinct)}
    ids = defaultdict(list)
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            ids[number[s]].append(i)
    out = []
    for (i, _), s in zip(rows, sets):
        component = min(ids[number[s]], default=None) if s else i
        out.append((i, len(s), component, i == component))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def families(seed, count=12, each=14):
    """Texts with changed words around the limit, chains of them, and copies."""
    rng, texts = random.Random(seed), []
    for _ in range(count):
        words = prose(rng, rng.choice([6, 9, 30, 80, 200])).split()
        for _ in range(each):
            if rng.random() < 0.4:
                words = list(words)  # a step further in a chain
                words[rng.randrange(len(words))] = prose(rng, 1)
                texts.append(" ".join(words))
            else:
                other = list(words)
                for _ in range(rng.randint(0, 3)):
                    other[rng.randrange(len(other))] = prose(rng, 1)
                texts.append("  ".join(other).upper() if rng.random() < 0.2 else " ".join(other))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("most, chunk", [(4096, 1 << 20), (4, 300)])
def test_components_of_all_pairs(spark, most, chunk):
    """Short lists and blocks are dealt out and still find every pair."""
    rows = families(3)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = brute(rows)
    assert 20 < sum(k for *_, k in want) < len(want) - 40
    assert rows_of(minhash.near_duplicates(docs, most=most, chunk=chunk), *COLUMNS) == want


def test_other_limits(spark):
    rows = families(4, 6)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = minhash.near_duplicates(docs, percent=100, shared=64)
    assert rows_of(got, *COLUMNS) == brute(rows, 100)
    with pytest.raises(ValueError):
        minhash.near_duplicates(docs, percent=40)


def test_one_large_family(spark):
    """Members around one text: links come back as stars, not as pairs."""
    rng = random.Random(6)
    base = prose(rng, 120).split()
    rows = [(0, " ".join(base))]
    for i in range(1, 600):
        words = list(base)
        for _ in range(rng.randint(1, 3)):
            words[rng.randrange(len(words))] = f"{i}-{rng.random()}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert rows_of(minhash.near_duplicates(docs, most=100, chunk=5000), *COLUMNS) == brute(rows)


def test_awkward_rows(awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = minhash.near_duplicates(awkward)
    assert got.columns == COLUMNS
    assert rows_of(got, *COLUMNS) == brute(rows)
    assert minhash.near_duplicates(nothing).count() == 0


def test_signatures_estimate_similarity():
    rng = random.Random(9)
    words = prose(rng, 3000).split()
    a, b = " ".join(words), " ".join(words[:2600] + prose(rng, 400).split())
    sets = minhash.Sets([a, "", b, "one two"])
    x, y = shingles(a), shingles(b)
    assert sets.sizes.tolist() == [len(x), 0, len(y), 1]
    signed = sets.signatures(512)
    share = (signed[0] == signed[2]).mean()
    assert abs(share - len(x & y) / len(x | y)) < 0.08
    assert minhash._smallest_linked() == 6


def test_prefixes_hold_every_pair(spark):
    """Two sets that share enough coordinates meet in one of the posted lists."""
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 60, 64)
    sigs = [np.where(rng.random(64) < 0.8, base, rng.integers(0, 1 << 60, 64)) for _ in range(25)]
    frame = spark.createDataFrame([(i, s.tolist()) for i, s in enumerate(sigs)], "node bigint, sig array<bigint>")
    posted = defaultdict(set)
    for r in minhash._prefixes(frame, 36, 4096).collect():
        posted[r.node].add(r.key)
    for i, j in combinations(range(25), 2):
        if (sigs[i] == sigs[j]).sum() >= 36:
            assert posted[i] & posted[j]
    assert max(map(len, posted.values())) <= 64 - 36 + 1


def test_texts_of_candidates_are_not_shuffled(spark, capsys):
    """However many candidates there are, rows are picked where they are read; sets come once."""
    rows = [(1, "a b c d e f g"), (None, "h i j k l m n"), (1, "A b c  d e f g"), (2, "o p q r s t u"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    some = minhash.prints(docs, 5, 64).filter("n_shingles > 0").dropDuplicates(["high", "low"])
    members = some.select(F.lit(0).alias("root"), F.hash("high").alias("node"), "n_shingles", "high", "low", F.col("doc_id").alias("doc"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = minhash._sets_of(docs, members, 5)
        found.explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    texts = [line for line in capsys.readouterr().out.splitlines() if "Exchange" in line and "doc" in line]
    assert not texts, texts
    want = rows_of(some, "high", "low")
    assert len(want) == 3
    assert [r for r in rows_of(found, "high", "low") if r in want] == want  # the empty set is nobody's


def test_ids_that_share_a_bit(spark, monkeypatch):
    """One word of bits lets most rows through; what is no candidate falls out by its digest."""
    monkeypatch.setattr(minhash, "SLOTS", 1)
    rows = families(7, 6)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert rows_of(minhash.near_duplicates(docs, chunk=300), *COLUMNS) == brute(rows)


def test_rows_of_few_ids(spark):
    """Many different texts under the same id, or none."""
    rows = [(None if i % 3 == 0 else i % 3, text) for i, text in families(8, 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert rows_of(minhash.near_duplicates(docs), *COLUMNS) == brute(rows)


def test_signatures_take_four_bytes_a_coordinate():
    """They are written twice and shuffled once, for every row."""
    assert minhash.Sets(["a b c d e f g", ""]).signatures(64).nbytes == 2 * 64 * 4
