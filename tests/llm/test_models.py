"""Quality scores, languages, benchmark items: held-out accuracy, brute force, awkward rows."""

import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm.conftest import prose, rows_of
from pyspark.sql import functions as F

from feedgate.llm import decontaminate, language, quality, words
from feedgate.llm.words import DIGIT, LETTER

SF = "/root/testdata/sf0.01"
given = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_words_are_those_of_the_texts(monkeypatch):
    rng = np.random.default_rng(8)
    signs = list("abcDEé中 \n\t.,-19")
    texts = ["".join(rng.choice(signs, rng.integers(0, 300))) for _ in range(60)] + ["", " ", "x" * 999]
    whole = words.words(texts, 255, lambda f: {"h": f.hashes()})
    split = [re.findall("[^ \t-\r]+", t) for t in texts]
    got = [[t[whole.start[j] : whole.end[j]] for j in range(a, b)] for t, a, b in zip(texts, whole.first, whole.first[1:])]
    assert got == split
    known = {}
    for word, h in zip([w.lower() for s in split for w in s], whole.columns["h"].tolist()):
        assert known.setdefault(word, h) == h
    assert len(set(known.values())) == len(known)
    monkeypatch.setattr(words, "FLAT", 128)  # long texts are worked on in stretches
    parts = words.words(texts[:60], LETTER | DIGIT, lambda f: {"h": f.hashes()})
    monkeypatch.undo()
    once = words.words(texts[:60], LETTER | DIGIT, lambda f: {"h": f.hashes()})
    runs = [re.findall(r"[^\W_]+", t) for t in texts[:60]]
    assert [t[once.start[j] : once.end[j]] for t, a, b in zip(texts, once.first, once.first[1:]) for j in range(a, b)] == sum(runs, [])
    assert parts.first[-1] >= once.first[-1]


@given
def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    weights = quality.train(docs, labels)
    rows = quality.score_quality(docs, weights).join(labels, "doc_id").collect()
    unseen = [(r.quality, r.score) for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(unseen) > 50
    assert np.mean([(s >= quality.THRESHOLD) == (q == 1) for q, s in unseen]) >= 0.95
    assert np.array_equal(weights, quality.train(docs.repartition(5), labels))


def test_quality_labels_of_the_held_out_fold_are_not_read(spark):
    rows = [(i, prose(random.Random(i), 30)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    fold = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    one, two = (
        spark.createDataFrame([(i, int(i % 2 if i not in fold else flip)) for i, _ in rows], "doc_id bigint, quality int")
        for flip in (0, 1)
    )
    assert fold and np.array_equal(quality.train(docs, one), quality.train(docs, two))


def test_quality_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (41, None), (5, 1)], "doc_id bigint, quality int")
    weights = quality.train(awkward, labels)
    got = quality.score_quality(awkward, weights)
    assert got.columns == [*awkward.columns, "score"] and got.count() == awkward.count()
    assert all(0 <= r.score <= 1 for r in got.collect())
    empty = {r.score for r in got.collect() if not (r.text or "").split()}
    assert len(empty) == 1
    assert quality.train(awkward, labels.filter("doc_id > 900")) is None
    assert {r.score for r in quality.score_quality(awkward, None).collect()} == {1.0}
    assert quality.score_quality(nothing, weights).count() == 0


def test_quality_score_is_the_sparse_dot_product():
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(1 << quality.BITS) + 1).astype(np.float32)
    texts = ["a b c a b", "", "ONE!! TWO!! two", "x | y | z"]
    first, index = quality.features(texts)
    for i, score in enumerate(quality.scores(texts, weights)):
        at, x = quality._vector(index[first[i] : first[i + 1]])
        assert score == pytest.approx(1 / (1 + np.exp(-(weights[at].astype(float) @ x))), rel=1e-6)


def test_leader_separates():
    rng = np.random.default_rng(6)
    examples = []
    for i in range(200):
        label = i % 2
        at = np.append(rng.choice(50, 5, replace=False) + 50 * label, 1 << quality.BITS)
        examples.append((at, np.append(np.ones(5), 1.0), label))
    w = quality.follow_the_leader(examples)
    assert w[:50].max() <= 0 <= w[50:100].min() and (w[100 : 1 << quality.BITS] == 0).all()


@given
def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.identify(docs, language.train(docs)).collect()
    unseen = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and r.lang_pred != "und"]
    assert np.mean([r.lang == r.lang_pred for r in unseen]) >= 0.95


def brute_path(scores):
    n = scores.shape[1]
    value, back = [0] * n, []
    for row in scores.tolist():
        top = value.index(max(value))
        step = [(value[k], k) if value[k] >= value[top] - language.SWITCH else (value[top] - language.SWITCH, top) for k in range(n)]
        back.append([p for _, p in step])
        value = [v + s for (v, _), s in zip(step, row)]
    state, path = value.index(max(value)), []
    for prev in reversed(back):
        path.append(state)
        state = prev[state]
    return path[::-1]


def test_viterbi_against_one_text_at_a_time():
    rng = np.random.default_rng(11)
    sizes = [0, 3, 1, 40, 0, 17]
    scores = -rng.integers(0, 20, (sum(sizes), 3)) * language.NAT
    first = np.concatenate([[0], np.cumsum(sizes)])
    got = language.viterbi(scores, first)
    for a, b in zip(first, first[1:]):
        assert got[a:b].tolist() == brute_path(scores[a:b])


def test_viterbi_is_the_best_way():
    rng = np.random.default_rng(12)
    scores = -rng.integers(0, 20, (7, 2)) * language.NAT
    def cost(path):
        return sum(scores[i, s] for i, s in enumerate(path)) - language.SWITCH * sum(a != b for a, b in zip(path, path[1:]))
    every = [[n >> i & 1 for i in range(7)] for n in range(128)]
    assert cost(language.viterbi(scores, np.array([0, 7])).tolist()) == max(map(cost, every))


def test_spans_and_scripts(spark, awkward, nothing):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        rows += [(3 * i, prose(rng, 40, "abcde"), "xa"), (3 * i + 1, prose(rng, 40, "vwxyz"), "xb"), (3 * i + 2, prose(rng, 40, "абвгд"), "xc")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.train(docs)
    assert model.languages == ["xa", "xb", "xc"]
    a, b, c = prose(rng, 12, "abcde"), prose(rng, 20, "vwxyz"), prose(rng, 3, "абвгд")
    mixed = f"{a}. {b}, {c}!"
    frame = spark.createDataFrame([(1, mixed), (2, None), (3, ""), (4, "12 !!"), (5, "中文")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in language.identify(frame, model).collect()}
    assert got[1].lang_pred == "xb"
    assert [(mixed[s.start : s.end], s.lang) for s in got[1].spans] == [(a, "xa"), (b, "xb"), (c, "xc")]
    for i in (2, 3, 4):
        assert (got[i].lang_pred, got[i].score, got[i].spans) == ("und", 0.0, [])
    assert got[5].lang_pred in model.languages  # a script no language uses leaves all candidates
    out = language.identify(awkward, model)
    assert out.columns == [*awkward.columns, "lang_pred", "score", "spans"] and out.count() == awkward.count()
    assert {r.lang_pred for r in language.identify(awkward, None).collect()} == {"und"}
    assert language.train(nothing) is None and language.identify(nothing, model).count() == 0


def brute_items(texts, items, index_items=4096):
    """Every passage against every item, by the definition of BM25.

    A passage is twice as long as the longest item of the item's block: 32 neighbours by length.
    """
    def terms(t):
        return re.findall(r"[^\W_]+", t.lower())
    lists = {i: terms(t) for i, t in items if len(terms(t)) >= 5}
    order = sorted(lists, key=lambda i: (len(lists[i]), i))
    indexes = [order[k : k + index_items] for k in range(0, len(order), index_items)]
    blocks = [x[k : k + 32] for x in indexes for k in range(0, len(x), 32)]
    longest = {i: max(len(lists[j]) for j in b) for b in blocks for i in b}
    n, mean = len(lists), np.mean([len(t) for t in lists.values()])
    df = Counter(w for t in lists.values() for w in set(t))

    def impact(i, w):
        tf = lists[i].count(w)
        idf = np.log1p((n - df[w] + 0.5) / (df[w] + 0.5))
        return idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(lists[i]) / mean))

    found = []
    for k, text in enumerate(texts):
        own = terms(text)
        for i, item in lists.items():
            hit = False
            for start in range(0, max(1, len(own) - longest[i]), longest[i]):
                passage = own[start : start + 2 * longest[i]]
                score = sum(impact(i, w) for w in set(passage) & set(item))
                if score < 0.5 * sum(impact(i, w) for w in set(item)):
                    continue
                cut = round(len(item) * 2 / 3)
                there = {tuple(passage[p : p + s]) for s in range(1, 6) for p in range(len(passage) - s + 1)}
                shares = []
                for part in (item[:cut], item[cut:]):
                    size = min(5, len(part))
                    grams = {tuple(part[p : p + size]) for p in range(len(part) - size + 1)}
                    shares.append(len(grams & there) / len(grams))
                hit |= min(shares) >= 0.5
            if hit:
                found.append((k, i))
    return found


def test_benchmark_items_against_brute_force(spark, nothing):
    rng = random.Random(21)
    items = [(i, prose(rng, rng.randint(6, 40), "abc")) for i in range(70)] + [(90, "too short"), (91, None), (92, "")]
    texts = []
    for k in range(120):
        body = prose(rng, rng.randint(0, 300), "abc").split()
        for _ in range(k % 3):
            item = (items[rng.randrange(70)][1] or "").split()
            if k % 5 == 0:
                item = item[: len(item) // 2]
            if k % 7 == 0 and item:
                item[rng.randrange(len(item))] = "zzz"
            at = rng.randint(0, len(body))
            body[at:at] = [w.upper() + "," for w in item]
        texts.append(" ".join(body))
    docs = spark.createDataFrame([*enumerate(texts), (900, None), (901, "")], "doc_id bigint, text string")
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    for index_items in (4096, 25):
        want = sorted(brute_items(texts, [(i, t) for i, t in items if t], index_items))
        found = decontaminate.find_items(docs.withColumn("items", F.lit(1)), frame, index_items)
        got = sorted((r.doc_id, x.item_id) for r in found.collect() for x in r["items"])
        assert got == want and len(want) > 30
        assert found.count() == 122
    assert decontaminate.find_items(nothing, frame).count() == 0
    assert {len(r["items"]) for r in decontaminate.find_items(docs, frame.filter("item_id > 89")).collect()} == {0}


def test_benchmark_items_keep_awkward_rows(spark, awkward):
    items = spark.createDataFrame([(1, "a line that stands in many documents over and over"), (None, "x y z u v w")], "item_id bigint, text string")
    found = decontaminate.find_items(awkward, items)
    assert found.columns == [c for c in awkward.columns if c != "items"] + ["items"]
    rest = [c for c in awkward.columns if c != "items"]
    assert rows_of(found, *rest) == rows_of(awkward, *rest)
    assert sum(len(r["items"]) > 0 for r in found.collect()) == 9


def test_letters_of_unspaced_scripts_are_words():
    first, terms = decontaminate.term_lists(["", "A股 中文x1 ひらカナ", "股", "ไทย a"])
    assert np.diff(first).tolist() == [0, 9, 1, 4] and terms[9] == terms[1]


def test_short_and_unspaced_items_are_found(spark):
    items = [
        (1, "水的沸点是多少度？在海平面是一百度。"), (2, "日本の首都はどこですか。東京です"), (3, "Capital of France"), (4, "42"),
        (5, "capital of france"), (6, "中文"), (7, "!?"), (8, "one two three four five six"), (9, "เมืองหลวงของไทย"),
    ]
    texts = {
        1: "前言水的沸点是多少度在海平面是一百度后语", 2: "では、日本の首都はどこですか。東京ですよ", 3: "The CAPITAL, of France is", 4: "it is 42.",
        5: "capital of all France", 6: "学中文吧", 7: "421 文中", 8: "x one two three four five six y", 9: "อยากรู้ว่าเมืองหลวงของไทยคืออะไร",
        10: "capital of", 11: "france", 12: "42 " * 3000,
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    want = {1: {1}, 2: {2}, 3: {3, 5}, 4: {4}, 6: {6}, 8: {8}, 9: {9}, 12: {4}}
    for index_items in (4096, 2):
        rows = decontaminate.find_items(docs, frame, index_items).collect()
        assert {r.doc_id: {x.item_id for x in r["items"]} for r in rows if r["items"]} == want
        assert all(x.score > 0 and x.question >= 0.5 and x.answer >= 0.5 for r in rows for x in r["items"])


def test_items_are_numbered_without_a_window_over_all(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "Window", None, raising=False)
    rng = random.Random(4)
    rows = [(i if i % 9 else None, prose(rng, rng.randint(1, 30))) for i in range(100)]
    frame = spark.createDataFrame(rows, "item_id bigint, text string").repartition(7)
    got = [(i, len(x.ids)) for x in decontaminate.build_indexes(frame, 40) for i in x.ids]
    want = sorted(rows, key=lambda r: (len(r[1].split()), r[0] is not None, r[0] or 0))
    assert [i for i, _ in got] == [i for i, _ in want] and max(n for _, n in got) <= 40


def test_tasks_hold_one_index_of_bounded_terms(spark, awkward):
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randint(1, 60))) for i in range(60)] + [(70, "a line that stands in many documents over and over"), (None, "over and over")]
    items = spark.createDataFrame(rows, "item_id bigint, text string")
    sizes = [len(x.terms) for x in decontaminate.build_indexes(items, 4096, 100)]
    assert len(sizes) > 5 and max(sizes) <= 160
    one, many = (decontaminate.find_items(awkward, items, 4096, t) for t in (1 << 18, 100))
    assert one.schema == many.schema
    # Scores depend on the passages, which depend on the items of a block.
    rest = [F.col(c) if c != "items" else F.array_sort("items.item_id").alias(c) for c in one.columns]
    assert rows_of(many, *rest) == rows_of(one, *rest) and many.filter(F.size("items") > 0).count() > 8
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan  # each index was used and let go


def test_a_language_without_letters_or_text(spark):
    """It is not learned, and its documents are judged by the others' letters."""
    rng = random.Random(3)
    rows = [(i, prose(rng, 30), "en") for i in range(40)]
    rows += [(100 + i, "12 34", "xx") for i in range(8)] + [(200 + i, "" if i % 2 else None, "yy") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(2)
    model = language.train(docs)
    assert model.languages == ["en"]
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, model).collect()}
    assert {found[i] for i in range(40)} == {("en", 1.0)}
    assert {v for i, v in found.items() if i >= 100} == {("und", 0.0)}


def test_leader_against_plain_updates():
    """The array form gives the weights of one-by-one updates over dictionaries."""
    rng = np.random.default_rng(4)
    examples = []
    for _ in range(60):
        at = np.append(np.sort(rng.choice(200, rng.integers(1, 30), replace=False)), 1 << quality.BITS)
        examples.append((at, np.append(rng.random(len(at) - 1) * 3, 1.0), int(rng.integers(0, 2))))
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= quality.L1:
            return 0.0
        step = (quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2
        return (math.copysign(quality.L1, z[i]) - z[i]) / step

    for _ in range(quality.EPOCHS):
        for at, x, label in examples:
            w = [weight(i) for i in at.tolist()]
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(a * b for a, b in zip(w, x))))))
            for i, old, value in zip(at.tolist(), w, x.tolist()):
                g = (p - label) * value
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / quality.ALPHA
                z[i] = z.get(i, 0.0) + g - sigma * old
                n[i] = n.get(i, 0.0) + g * g
    found = quality.follow_the_leader(examples)
    want = np.zeros(len(found))
    for i in z:
        want[i] = weight(i)
    assert np.allclose(found, want, rtol=1e-9, atol=1e-12) and (want != 0).sum() > 100


def test_sample_is_bounded_by_rows_and_bytes(spark):
    rows = [(i, "x" * 100, "en") for i in range(60)] + [(7, "x" * 100, "en")] * 5 + [(8, f"y{i}", "en") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1)], "doc_id bigint, quality int")
    every = quality.sample(docs, labels).collect()
    kept = {r.doc_id for r in every}
    assert len(every) == len(kept) + (3 if 8 in kept else 0)  # equal rows once, others each
    few = quality.sample(docs, labels, rows=10).collect()
    assert len(few) == 10
    small = quality.sample(docs, labels, size=1050).collect()
    assert sum(len(r.text) for r in small) <= 1050 and len(small) >= 10
    order = sorted(r._order for r in every)
    assert sorted({r._order for r in small}) == sorted(set(order))[: len({r._order for r in small})]
