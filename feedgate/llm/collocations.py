"""Collocations by the partition method: shards mined whole, their union counted exactly, then scored."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from feedgate.llm import words as text_words
from feedgate.llm.common import staged
from feedgate.llm.files import SharedFolder, ship
from feedgate.llm.mph import mix
from feedgate.session import work_dir

#: Words of the longest phrase, occurrences from which a phrase is frequent, phrases of a report,
#: and the share (percent) of a phrase's occurrences inside a longer one that drops it.
LONGEST = 3
SUPPORT = 10
TOP = 2000
INSIDE = 50
#: Language of documents without one.
UNKNOWN = "und"
#: Characters of text of one shard, which is mined in memory (about 100 bytes for each).
SHARD_CHARS = 1 << 22
#: Bytes of text that give one bucket of phrases (a phrase is 4 bytes there), and buckets of a file.
BUCKET_BYTES = 1 << 23
FILE_BUCKETS = 64
#: Shares in which a language's phrases are ranked before all of them are.
SHARES = 8
#: Fixed values of the contract: pieces end at these characters, and at line ends.
_ENDS = b".,;:!?\n\x0b\x0c\r"
#: No byte of UTF-8; stands between pieces.
_MARK = b"\xff"
_TO_MARK = bytes.maketrans(_ENDS, _MARK * len(_ENDS))
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


@dataclass
class Shard:
    """Words of some texts in one sequence of numbers; -1 stands between pieces."""

    words: list[bytes]
    ids: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Shard:
        joined = _MARK.join(t.encode("utf-8", "surrogatepass") for t in texts).lower()  # A-Z only
        pieces = joined.translate(_TO_MARK).replace(_MARK, b" " + _MARK + b" ").split()
        numbers = defaultdict(count().__next__)
        numbers[_MARK]
        ids = np.fromiter(map(numbers.__getitem__, pieces), np.int64, len(pieces)) - 1
        return cls(list(numbers)[1:], ids)

    def phrases(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length: where its phrases start, and their 64-bit hashes."""
        by_word = np.array([xxhash.xxh64_intdigest(w) for w in self.words] + [0], np.uint64)[self.ids]
        inside = self.ids >= 0
        starts, hashes = np.nonzero(inside)[0], by_word[inside]
        for k in range(1, longest + 1):
            if k > 1:
                goes_on = starts + k - 1 < len(self.ids)
                goes_on[goes_on] = inside[starts[goes_on] + k - 1]
                starts, hashes = starts[goes_on], hashes[goes_on]
                hashes = mix(hashes * _ODD[k % 3] + by_word[starts + k - 1])
            yield k, starts, hashes

    def strings(self, k: int, starts: np.ndarray) -> pa.Array:
        words = pa.array(self.words, pa.binary()).cast(pa.string())
        parts = [words.take(pa.array(self.ids[starts + i])) for i in range(k)]
        return parts[0] if k == 1 else pc.binary_join_element_wise(*parts, " ")


def buckets_of(size: int, bucket_bytes: int) -> int:
    return max(1, -(-size // bucket_bytes))


def _keys(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket in the high 32 bits, 32 other bits of the hash below."""
    high = (hashes >> np.uint64(32)) % np.uint64(buckets)
    return (high << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))


def _shards(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[tuple[str, int, int, Shard]]:
    """``lang, bytes of the language, bytes of the shard, shard``: neighbours of one language."""
    held: dict[str, list] = defaultdict(lambda: [[], 0, 0])
    size = 0
    for batch in text_words.slices(batches, 256):
        for lang, total, text in zip(*(batch.column(c) for c in ("lang", "total", "text"))):
            text = text.as_py() or ""
            some = held[lang.as_py()]
            some[0].append(text)
            some[1] = total.as_py()
            some[2] += len(text)
            size += len(text)
            if size >= chars:  # all of them: what a task holds is bounded
                yield from _let_go(held)
                size = 0
    yield from _let_go(held)


def _let_go(held: dict[str, list]) -> Iterator[tuple[str, int, int, Shard]]:
    for lang in list(held):
        texts, total, _ = held.pop(lang)
        yield lang, total, sum(len(t.encode("utf-8", "surrogatepass")) for t in texts), Shard.of(texts)


def _pack(keys: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending 32-bit keys as bytes: how often once, those, the others, their counts."""
    once = times == 1
    parts = [np.array([once.sum()], "<u4"), keys[once].astype("<u4"), keys[~once].astype("<u4"), times[~once].astype("<u4")]
    return b"".join(p.tobytes() for p in parts)


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    values = np.frombuffer(data, "<u4")
    n = int(values[0])
    more = (len(values) - 1 - n) // 2
    keys = values[1 : 1 + n + more]
    return keys, np.concatenate([np.ones(n, np.int64), values[1 + n + more :].astype(np.int64)])


def mine(texts: DataFrame, support: int, longest: int, chars: int, bucket_bytes: int) -> DataFrame:
    """``lang, bucket, slack, mined``: the phrases that are frequent in each shard, with counts there.

    ``texts`` has ``lang, total, text``; ``total`` are the bytes of the language.  A phrase that
    occurs ``support`` times has in some shard at least its share of them, by bytes, rounded up.
    ``slack`` is how often a phrase that is not reported may occur in the shard.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, total, size, shard in _shards(batches, chars):
            least = max(1, -(-support * size // max(total, 1)))
            buckets = buckets_of(total, bucket_bytes)
            hashes = np.concatenate([h for _, _, h in shard.phrases(longest)])
            keys, times = np.unique(_keys(hashes, buckets), return_counts=True)
            keys, times = keys[times >= least], times[times >= least]
            edges = np.searchsorted(keys, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
            filled = np.nonzero((np.diff(edges) > 0) | (least > 1))[0]
            for i in range(0, len(filled), 1024):
                some = filled[i : i + 1024].tolist()
                low = keys & np.uint64(0xFFFFFFFF)
                mined = [_pack(low[edges[b] : edges[b + 1]], times[edges[b] : edges[b + 1]]) for b in some]
                columns = [pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int32())]
                columns += [pa.array([least - 1] * len(some), pa.int64()), pa.array(mined, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "slack", "mined"])

    return texts.mapInArrow(rows, "lang string, bucket int, slack bigint, mined binary")


def _union(support: int):
    """Group of a bucket: the phrases that some shard reports and that may be frequent in all."""

    def merge(group: pa.Table) -> pa.Table:
        slack = group.column("slack").to_numpy()
        found = [_unpack(m.as_py()) for m in group.column("mined")]
        keys = np.concatenate([k for k, _ in found])
        # What a reporting shard adds to the bound: its count, in place of its slack.
        gains = np.concatenate([t - s for (_, t), s in zip(found, slack.tolist())])
        order = np.argsort(keys, kind="stable")
        keys, gains = keys[order], gains[order]
        heads = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0] if len(keys) else np.zeros(0, np.int64)
        bound = np.add.reduceat(gains, heads) + slack.sum() if len(keys) else gains
        chosen = keys[heads][bound >= support]
        head = group.select(["lang", "bucket"]).slice(0, 1)
        return head.append_column("chosen", pa.array([chosen.astype("<u4").tobytes()], pa.binary()))

    return merge


class _Candidates:
    """The candidates as a task sees them: ascending keys in files, a file open at a time."""

    def __init__(self, folder: SharedFolder, files: dict[tuple[str, int], str]):
        self.folder, self.files, self.open = folder, files, {}

    def hold(self, lang: str, keys: np.ndarray) -> np.ndarray:
        """Which keys are candidates."""
        out = np.zeros(len(keys), bool)
        part = (keys >> np.uint64(32)) // np.uint64(FILE_BUCKETS)
        order = np.argsort(part, kind="stable")
        for rows in np.split(order, np.nonzero(np.diff(part[order]))[0] + 1) if len(order) else ():
            name = self.files.get((lang, int(part[rows[0]])))
            if name is None:
                continue
            if name not in self.open:
                self.open = {name: self.folder.load(name, "<u8")}
            known = self.open[name]
            at = np.minimum(np.searchsorted(known, keys[rows]), len(known) - 1)
            out[rows] = known[at] == keys[rows]
        return out


def count_exactly(texts: DataFrame, mined: DataFrame, support: int, longest: int, chars: int, bucket_bytes: int) -> DataFrame:
    """``lang, phrase, words, a``: all frequent phrases with their counts over all texts.

    A row without a phrase holds the words of a language.  Candidates are files in the shared
    folder, ascending 64-bit keys that tasks map and probe; a task counts by whole phrases, so
    what only shares a candidate's hash falls out.
    """
    folder = SharedFolder(work_dir(texts.sparkSession, "phrase-candidates"))

    def save(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group = group.sort_by("bucket")
        parts = [
            np.frombuffer(c.as_py(), "<u4").astype(np.uint64) | (np.uint64(b.as_py()) << np.uint64(32))
            for b, c in zip(group.column("bucket"), group.column("chosen"))
        ]
        keys = np.concatenate(parts)
        name = [folder.save(keys.astype("<u8"))] if len(keys) else [None]
        return pa.table({"lang": [key[0].as_py()], "part": pa.array([key[1].as_py()], pa.int32()), "name": pa.array(name, pa.string())})

    united = mined.groupBy("lang", "bucket").applyInArrow(_union(support), "lang string, bucket int, chosen binary")
    part = F.expr(f"bucket div {FILE_BUCKETS}").cast("int")
    saved = united.withColumn("part", part).groupBy("lang", "part").applyInArrow(save, "lang string, part int, name string")
    # One row for a gigabyte of text.
    files = {(r.lang, r.part): r.name for r in staged(saved, "phrase-files").collect() if r.name}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        candidates = _Candidates(folder, files)
        for lang, total, _, shard in _shards(batches, chars):
            buckets = buckets_of(total, bucket_bytes)
            sizes, tables = 0, []
            for k, starts, hashes in shard.phrases(longest):
                sizes += len(starts) if k == 1 else 0
                starts = starts[candidates.hold(lang, _keys(hashes, buckets))]
                first, times = _distinct(shard.ids, starts, k, len(shard.words))
                columns = [shard.strings(k, first), pa.array(np.full(len(first), k, np.int32)), pa.array(times)]
                tables.append(pa.RecordBatch.from_arrays(columns, ["phrase", "words", "a"]))
            tables.append(pa.RecordBatch.from_arrays(
                [pa.array([None], pa.string()), pa.array([0], pa.int32()), pa.array([sizes], pa.int64())], ["phrase", "words", "a"]
            ))
            for t in tables:
                langs = pa.array([lang] * t.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays([langs, *t.columns], ["lang", "phrase", "words", "a"])

    counted = texts.mapInArrow(rows, "lang string, phrase string, words int, a bigint")
    return counted.groupBy("lang", "phrase", "words").agg(F.sum("a").alias("a")).filter((F.col("a") >= support) | F.col("phrase").isNull())


def _distinct(ids: np.ndarray, starts: np.ndarray, k: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """First place and count of each distinct phrase, by its words."""
    names = np.zeros(len(starts), np.int64)
    for i in range(k):
        # Names are below the number of places, so the product fits.
        _, names = np.unique(names * words + ids[starts + i], return_inverse=True)
    _, first, times = np.unique(names, return_index=True, return_counts=True)
    return starts[first], times.astype(np.int64)


def scores(frequent: DataFrame, inside: int = INSIDE) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of the phrases no longer one holds too often.

    All joins are on language and phrase; products are decimals of up to 37 digits.
    """
    parts = F.split("phrase", " ")
    phrase = frequent.filter("words >= 2").withColumn("parts", parts)
    cut = phrase.select("lang", "phrase", "words", "a", "parts", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cut = cut.select(
        "lang", "phrase", "words", "a", "k",
        F.array_join(F.slice("parts", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("parts", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"),
    )
    known = frequent.filter("words >= 1").select("lang", "phrase", "a")
    left = known.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = known.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    big = "decimal(14,0)"
    cut = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn(
        "score", F.expr(f"(cast(a as {big}) * cast(a as {big}) * cast(1000000 as decimal(7,0))) div (cast(l as {big}) * cast(r as {big}))")
    )
    lowest = cut.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    # What stands in a longer phrase: all shorter stretches of it.
    size = F.sequence(F.lit(2), F.col("words") - 1)
    within = phrase.filter("words > 2").select("lang", "parts", "words", F.col("a").alias("longer"), F.explode(size).alias("size"))
    within = within.select("lang", "parts", "size", "longer", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("at"))
    within = within.select("lang", F.array_join(F.slice("parts", F.col("at"), F.col("size")), " ").alias("phrase"), "longer")
    within = within.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    total = frequent.filter("phrase is null").select("lang", F.col("a").alias("n"))
    kept = lowest.join(within, ["lang", "phrase"], "left").filter(f"longer is null or 100 * longer < {inside} * a")
    return kept.join(total, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(
    docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, top: int = TOP, inside: int = INSIDE,
    shard_chars: int = SHARD_CHARS, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Each language's ``top`` collocations: ``lang, rank, phrase, a, l, r, n, score``.

    Texts (A-Z lower-cased) are cut at ``.,;:!?`` and line ends into pieces, and those at blanks and
    tabs into words.  ``a`` counts a phrase of 2 to ``longest`` words in all texts of the language,
    overlaps included; phrases from ``support`` on are candidates.  ``l`` and ``r`` count the two
    parts of the cut with the lowest ``score``, floor(1000000 a a / (l r)), the first cut on ties; ``n``
    counts all words.  A phrase is left out if a longer candidate that holds it occurs ``inside``
    percent as often.  Rank is by score, count and phrase.

    Every shard (some megabytes of neighbouring texts) is mined whole, at a support lowered to its
    share of the language's bytes.  What shards report meets in buckets by hash, where phrases stay
    that may reach the support: their counts, and for each shard that is silent the most it can
    hide.  These candidates are counted over all texts by their words.  Where a shard's share of
    the support is below two, it reports all phrases, so the union of many small shards is exact
    but for equal hashes; the buckets grow in number with the language's bytes.

    Null texts are empty, null languages are ``und``; ids are not looked at, and rows that repeat
    count each; other columns are ignored.  No rows give no rows.
    """
    ship(docs.sparkSession)
    own = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    sizes = own.groupBy("lang").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).alias("total"))
    sizes = staged(sizes, "language-bytes")
    if sizes.count() <= 1 << 16:  # a name and a number each
        sizes = F.broadcast(sizes)
    texts = own.join(sizes, "lang").select("lang", "total", "text")
    mined = mine(texts, support, longest, shard_chars, bucket_bytes)
    frequent = staged(count_exactly(texts, mined, support, longest, shard_chars, bucket_bytes), "phrases")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # The best of each share of a language first, so that its last task has SHARES * top rows at most.
    ranked = scores(frequent, inside).withColumn("share", F.pmod(F.hash("phrase"), F.lit(SHARES)))
    for group in (["lang", "share"], ["lang"]):
        best = F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("long")
        ranked = ranked.withColumn("rank", best).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
