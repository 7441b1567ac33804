"""SimHash links and components against all pairs; the code's promises."""

import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from llm.conftest import rows_of
from pyspark.sql import functions as F

from feedgate.llm import golay, simhash
from feedgate.llm.components import components, contract


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^ \t-\r]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def near(points, distance=3):
    return [(a, b) for a, b in combinations(points, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= distance]


def cloud(seed, centres=40, each=25, flips=4):
    rng, out = np.random.default_rng(seed), set()
    for centre in rng.integers(0, 1 << 63, centres).tolist():
        for _ in range(each):
            x = centre
            for bit in rng.choice(64, rng.integers(0, flips), replace=False).tolist():
                x ^= 1 << bit
            out.add(x - (1 << 64) if x >= 1 << 63 else x)
    return sorted(out)


def test_code():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 5000)
    keys = golay.nearby(words)
    others = golay.nearby(words ^ (1 << rng.integers(0, 23, 5000)))
    assert all(o[0] in k for k, o in zip(keys, others))
    assert set((keys >= 0).sum(axis=1)) == {1, 6}


@pytest.mark.parametrize("bucket", [8192, 3])
def test_links_connect_what_all_pairs_connect(spark, bucket):
    points = cloud(7)
    nodes = spark.createDataFrame([(p,) for p in points], "fp bigint")
    found = [tuple(r) for r in simhash.links(nodes, bucket=bucket).collect()]
    assert grouped(found) == grouped(near(points))
    assert len(found) < len(near(points)) * 4


def test_one_large_family(spark):
    """A dense family returns links in proportion to its members, not to its pairs."""
    points = cloud(9, centres=1, each=3000, flips=7)
    nodes = spark.createDataFrame([(p,) for p in points], "fp bigint").repartition(4)
    found = simhash.links(nodes, bucket=256)
    assert {r.node: r.root for r in components(found).collect()} == {
        a: b for a, b in grouped(near(points)).items() if a != b
    }


def test_contract_and_components(spark):
    rng = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(1000, 1200)]
    want = {a: b for a, b in grouped(links).items() if a != b}
    nodes, roots = contract(*np.array(links).T)
    assert dict(zip(nodes.tolist(), roots.tolist())) == want
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    assert {r.node: r.root for r in components(frame).collect()} == want
    assert components(frame.filter("a < 0")).count() == 0


def test_documents(spark, awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    prints = [plain_fingerprint(t) for _, t in rows]
    roots = grouped([(p, p) for p in prints] + near(sorted(set(prints))))
    least = defaultdict(list)
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[roots[p]].append(i)
    want = [(i, f"{p:016x}", min(least[roots[p]], default=None)) for (i, _), p in zip(rows, prints)]
    got = simhash.near_duplicates(awkward).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("f"), "component_id"
    )
    assert rows_of(got, *got.columns) == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))
    kept = simhash.one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, _, c in want}
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.one_of_each(nothing).count() == 0


def test_distance_is_bounded(awkward):
    with pytest.raises(ValueError):
        simhash.links(awkward, 4)
