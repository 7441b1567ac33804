"""Periodic runs against all stretches and periods."""

import random
import re
import time

import numpy as np
import pytest
from llm.conftest import rows_of

from feedgate.llm import periodic


def brute(words, least=12):
    """All runs by their definition: every period's maximal stretches, then the smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        start = 0
        for i in range(q, n + 1):
            if i == n or words[i] != words[i - q]:
                if i - start >= max(least, 2 * q):
                    found.setdefault((start, i), q)  # periods ascend
                start = i - q + 1
    return sorted((s, q, e) for (s, e), q in found.items())


def collapsed(words, runs):
    return " ".join(w for i, w in enumerate(words) if not any(s + q <= i < e for s, q, e in runs))


def of_words(texts):
    return [
        ([(r["start"], r["period"], r["start"] + r["length"]) for r in runs], text)
        for runs, text in periodic._found(texts, periodic.LEAST)
    ]


def check(texts):
    for text, (runs, kept) in zip(texts, of_words(texts)):
        words = re.findall("[^ \t-\r]+", text)
        assert runs == brute(words)
        assert kept == collapsed(words, runs)


def test_random_texts_over_few_words():
    rng = random.Random(1)
    for letters in ("a", "ab", "abc", "abcdef"):
        check([" ".join(rng.choices(letters, k=rng.randint(0, 90))) for _ in range(150)])


def test_planted_and_nested_runs():
    rng = random.Random(2)
    texts = []
    for _ in range(120):
        words = [str(rng.randint(0, 30)) for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(1, 3)):
            unit = [str(rng.randint(0, 3)) for _ in range(rng.randint(1, 25))]
            unit = unit * rng.randint(1, 3) + [str(rng.randint(0, 30)) for _ in range(rng.randint(0, 3))]
            words += (unit * rng.randint(1, 8))[: rng.randint(1, 160)]
        texts.append("  ".join(words))
    assert sum(len(r) for r, _ in of_words(texts)) > 100
    check(texts)


def test_fibonacci_words():
    """Texts with as many runs as a text can have."""
    a, b = "a", "a b"
    for _ in range(10):
        a, b = b, f"{b} {a}"
    check([b])


@pytest.mark.parametrize(
    "text",
    ["x " * 400_000, ("0 " * 700 + "1 ") * 500, "a b c d e f g " * 60_000, " ".join(map(str, range(300_000)))],
    ids=["one word", "nested", "seven", "none"],
)
def test_very_long_texts(text):
    """Work grows with the words, not with the pairs of equal words."""
    begin = time.perf_counter()
    ((runs, kept),) = of_words([text])
    assert time.perf_counter() - begin < 60
    assert len(kept) <= len(text)
    if runs:
        assert max(e - s for s, _, e in runs) == len(text.split())


def test_awkward_rows(awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = periodic.find_runs(awkward)
    assert got.columns == [*awkward.columns, "runs", "collapsed"]
    want = []
    for i, t in rows:
        words = re.findall("[^ \t-\r]+", t or "")
        runs = brute(words) if len(words) < 1000 else []
        want.append((i, str([(s, e - s, q) for s, q, e in runs]), collapsed(words, runs)))
    seen = [(r.doc_id, str([tuple(x) for x in r.runs]), r.collapsed) for r in got.collect()]
    assert sorted(map(str, seen)) == sorted(map(str, want))
    assert periodic.find_runs(nothing).count() == 0
    again = periodic.find_runs(got)  # its own columns are replaced
    assert rows_of(again, "doc_id", "collapsed") == rows_of(got, "doc_id", "collapsed")
    with pytest.raises(ValueError):
        periodic.find_runs(awkward, 5)


def test_names_of_stretches():
    assert periodic._named(np.array([5, 7, 5, -1, -1])).tolist() == [0, -1, 0, -1, -1]
