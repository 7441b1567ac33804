"""MinHash near-duplicates: posting lists of signature coordinates, counted collisions, confirmed links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from feedgate.llm import words as text_words
from feedgate.llm.common import in_order, staged, with_running
from feedgate.llm.components import components, contract
from feedgate.llm.files import ship
from feedgate.llm.mph import mix

#: Words of a shingle; documents link where 100 * intersection >= PERCENT * union.
SHINGLE = 5
PERCENT = 85
#: Coordinates of a signature, and how many a pair must share.  Each coordinate of two linked sets
#: agrees with probability 0.85 or more, so a link is missed with probability below 3e-8.
COORDINATES = 64
SHARED = 36
#: Sets of one prefix list that a task compares with each other; longer lists are dealt out.
LIST = 4096
#: Pairs whose coordinates are compared at once, and links kept before they are contracted.
BLOCK = 1 << 17
KEPT_LINKS = 1 << 20
#: Shingles of one block of sets that are confirmed against each other (8 bytes each): a share of
#: all of them within these limits.
CHUNK = (1 << 14, 1 << 20)
SHARE = 128
#: Words of 64 bits, at most, of the filter that tells the ids of candidates from most others.
SLOTS = 1 << 20

_COUNT = "doc_id {}, n_shingles bigint, high bigint, low bigint, sig array<int>"


def _odd(n: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 32)) | np.uint64(1)


class Sets:
    """Shingle sets of some texts: ascending 64-bit hashes, those of text i from ``first[i]`` on."""

    def __init__(self, texts: list[str], shingle: int = SHINGLE):
        hashes: dict[bytes, int] = {}
        found, factors = [], _odd(shingle, 1)
        for text in texts:
            words = text.encode("utf-8", "surrogatepass").lower().split()  # A-Z only, ASCII white space
            if len(words) < shingle:
                whole = [xxhash.xxh64_intdigest(b" ".join(words), len(words))] if words else []
                found.append(np.array(whole, np.uint64))
                continue
            for w in words:
                if w not in hashes:
                    hashes[w] = xxhash.xxh64_intdigest(w)
            h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
            n = len(h) - shingle + 1
            joined = h[:n] * factors[0]
            for i in range(1, shingle):
                joined += h[i : i + n] * factors[i]
            found.append(np.unique(mix(joined)))
        self.sizes = np.array([len(f) for f in found], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        self.hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)

    def digests(self) -> list[bytes]:
        """128 bits of each set."""
        return [
            xxhash.xxh3_128_digest(self.hashes[a:b].tobytes())
            for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist())
        ]

    def signatures(self, coordinates: int) -> np.ndarray:
        """A row per set: 32 bits of each coordinate's smallest hash."""
        out = np.zeros((len(self.sizes), coordinates), np.int32)
        some = np.nonzero(self.sizes)[0]
        if len(some):
            for c, (factor, salt) in enumerate(zip(_odd(coordinates, 2), _odd(coordinates, 3))):
                least = np.minimum.reduceat(self.hashes * factor, self.first[some])
                out[some, c] = (mix(least ^ salt) >> np.uint64(32)).astype(np.uint32).view(np.int32)
        return out


def prints(docs: DataFrame, shingle: int, coordinates: int) -> DataFrame:
    """``doc_id, n_shingles, high, low, sig`` of every row: size, digest and signature of its set."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    # A set this small equals every set it links with; without signature.
    smallest = _smallest_linked()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_words.slices(batches):
            at = 0
            for _, texts in text_words.grouped(batch.column("text").to_pylist()):
                sets = Sets(texts, shingle)
                digests = np.frombuffer(b"".join(sets.digests()), "<i8").reshape(-1, 2)
                signed = sets.sizes >= smallest
                flat = sets.signatures(coordinates)[signed].reshape(-1)
                ends = np.concatenate([[0], np.cumsum(signed * coordinates)])
                columns = [batch.column("doc_id").slice(at, len(texts)), pa.array(sets.sizes)]
                columns += [pa.array(digests[:, 0]), pa.array(digests[:, 1])]
                columns += [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "high", "low", "sig"])
                at += len(texts)

    return docs.select("doc_id", "text").mapInArrow(rows, _COUNT.format(kind))


def _smallest_linked() -> int:
    """Size of the smallest set that links with a different one (which has one shingle more)."""
    n = 1
    while 100 * n < PERCENT * (n + 1):
        n += 1
    return n


def _prefixes(nodes: DataFrame, shared: int, most: int) -> DataFrame:
    """``key, salt, side, node``: the posting lists that candidates have to meet in.

    Only values that two sets or more hold can collide.  Of those a set needs ``shared``, so a pair
    that shares as many has one in common among all but ``shared - 1`` of each side's, the rarest
    first: these are posted.  A list above ``most`` is dealt out by node, with the others beside.
    A key is a coordinate's number before 32 bits of its value.
    """
    key = F.shiftleft(F.col("at").cast("bigint"), 32).bitwiseOR(F.col("value").bitwiseAND(F.lit((1 << 32) - 1)))
    postings = nodes.select("node", F.posexplode("sig").alias("at", "value")).select("node", key.alias("key"))
    lists = postings.groupBy("key").count().filter("count >= 2")
    live = postings.join(lists, "key").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("count", "key"))).alias("keys"))
    prefix = F.slice("keys", F.lit(1), F.size("keys") - (shared - 1))
    posted = live.filter(F.size("keys") >= shared).select("node", F.explode(prefix).alias("p")).select("node", "p.key")
    posted = staged(posted, "minhash-prefixes")
    hot = posted.groupBy("key").count().filter(F.col("count") > most)
    hot = staged(hot.select("key", F.ceil(F.col("count") / most).cast("int").alias("parts")), "minhash-hot")
    if hot.isEmpty():
        return posted.select("key", F.lit(0).alias("salt"), F.lit(0).cast("tinyint").alias("side"), "node")
    own = F.pmod(F.hash("node"), F.coalesce("parts", F.lit(1)))
    parts = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
    dealt = posted.join(hot, "key", "left").withColumn("salt", F.explode(parts))
    return dealt.select("key", "salt", F.when(F.col("salt") == own, 0).otherwise(1).cast("tinyint").alias("side"), "node")


def _ranges(sizes: np.ndarray, of: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """From where to where in ascending ``sizes`` sets are alike enough in size to link."""
    low = np.searchsorted(sizes, -(-of * percent // 100), side="left")
    return low, np.searchsorted(sizes, of * 100 // percent, side="right")


def _collisions(shared: int, percent: int):
    """Task: sorted prefix lists to links of sets that share enough coordinates, as stars."""

    def compare(held, later, itself) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of ``later`` against those of ``held`` that are near in size; each pair once."""
        (nodes, sizes, sigs), (other, n, sig) = held, later
        low, high = _ranges(sizes, n, percent)
        if itself:
            low = np.maximum(low, np.arange(len(n)) + 1)
        count = np.maximum(high - low, 0)
        total, at = np.cumsum(count), 0
        while at < len(n):
            upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + BLOCK, side="right")))
            c = count[at:upto]
            right = np.repeat(np.arange(at, upto), c)
            left = np.arange(len(right)) - np.repeat(np.cumsum(c) - c, c) + np.repeat(low[at:upto], c)
            same = (sigs[left] == sig[right]).sum(axis=1, dtype=np.uint8) >= shared
            if same.any():
                yield nodes[left[same]], other[right[same]]
            at = upto

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, held_links = [], 0
        run, held = None, None  # the list that goes on at the end of a batch, its side 0
        for batch in batches:
            key, salt, side, node, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "salt", "side", "node", "n"))
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint8).reshape(len(node), -1)
            starts = np.nonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])]))[0] if len(key) else []
            for a, b in zip(starts, [*starts[1:], len(key)]):
                mid = a + int(np.searchsorted(side[a:b], 1))
                first, rest = ((node[x], n[x], sig[x]) for x in (slice(a, mid), slice(mid, b)))
                found = []
                if (key[a], salt[a]) != run:
                    run, held = (key[a], salt[a]), first
                    found += compare(held, first, True)
                elif mid > a:  # more of side 0, in ascending size
                    found += [*compare(held, first, False), *compare(first, first, True)]
                    held = tuple(map(np.concatenate, zip(held, first)))
                if b > mid:
                    found += compare(held, rest, False)
                links += found
                held_links += sum(len(f[0]) for f in found)
            if held_links > KEPT_LINKS:
                links = [contract(*map(np.concatenate, zip(*links)))]
                held_links = len(links[0][0])
        if links:
            yield from _batches(*contract(*map(np.concatenate, zip(*links))))

    return rows


def _batches(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(a), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(a[i : i + (1 << 16)]), pa.array(b[i : i + (1 << 16)])], ["a", "b"])


def candidates(nodes: DataFrame, shared: int = SHARED, most: int = LIST, percent: int = PERCENT) -> DataFrame:
    """``node, root``: groups of sets that share ``shared`` coordinates with another of the group.

    ``nodes`` has ``node, n_shingles, sig``.  Lists carry eight bits of every coordinate, which two
    sets share at least where they share the coordinate; sizes too far apart are passed over.
    """
    lists = _prefixes(nodes, shared, most)
    low = F.transform("sig", lambda x: F.substring(F.hex(x.bitwiseAND(F.lit(255)) + 256), -2, 2))
    slim = nodes.select("node", F.col("n_shingles").alias("n"), F.unhex(F.array_join(low, "")).alias("sig"))
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lists.join(slim, "node").repartition(n, "key", "salt").sortWithinPartitions("key", "salt", "side", "n")
    found = dealt.select("key", "salt", "side", "node", "n", "sig").mapInArrow(_collisions(shared, percent), "a bigint, b bigint")
    return components(found)


def _confirmed(percent: int):
    """Group of one block of sets, or of two: links confirmed on the whole sets, as stars."""

    def link(group: pa.Table) -> pa.Table:
        group = group.sort_by([("root", "ascending"), ("n", "ascending"), ("node", "ascending")])
        root, node, n, later = (group.column(c).to_numpy() for c in ("root", "node", "n", "later"))
        data = np.frombuffer(b"".join(group.column("shingles").to_pylist()), "<u8")
        _, ids = np.unique(data, return_inverse=True)
        first = np.concatenate([[0], np.cumsum(n)])
        seen = np.zeros(int(ids.max(initial=0)) + 1, np.int32)
        label = np.arange(len(node))
        end = np.searchsorted(root, root, side="right")
        high = np.minimum(end, np.array([np.searchsorted(n[i:e], n[i] * 100 // percent, side="right") + i for i, e in enumerate(end)], np.int64))
        two = later.any()
        for i in range(len(node)):
            j = np.arange(i + 1, high[i])
            if two:
                j = j[later[j] != later[i]]  # pairs inside a block are another group's
            if not len(j) or (label[j] == label[i]).all():
                continue  # linked already
            seen[ids[first[i] : first[i + 1]]] = 1
            both = np.add.reduceat(seen[ids[first[j[0]] : first[j[-1] + 1]]], first[j[0] : j[-1] + 1] - first[j[0]])[j - j[0]]
            seen[ids[first[i] : first[i + 1]]] = 0
            close = j[100 * both >= percent * (n[i] + n[j] - both)]
            if len(close):
                joins = np.unique(label[np.append(close, i)])
                label[np.isin(label, joins)] = joins[0]
        own = label != np.arange(len(node))
        return pa.table({"a": node[own], "b": node[label[own]]})

    return link


def _dealt(members: DataFrame, percent: int, chunk: int | None) -> DataFrame:
    """``high, low, root, node, n, c, d, later``: the groups that each set is confirmed in.

    ``members`` (``root, node, n_shingles, high, low``) stand in one global order by candidate group
    and size, cut into blocks of about ``chunk`` shingles: by default small ones where there is
    little, so that one large group is many tasks, and up to the upper limit of ``CHUNK`` where
    there is more.  A group confirms a block (c = d), or two blocks that share a candidate group
    and sizes that may link.  No shingles move for this.
    """
    order = [F.col("root"), F.col("n"), F.col("node")]
    sets = members.select("root", "node", F.col("n_shingles").alias("n"), "high", "low")
    placed = in_order(sets, order, "minhash-sets")
    if chunk is None:
        total = placed.agg(F.sum("n")).first()[0] or 0
        chunk = min(max(CHUNK[0], total // SHARE), CHUNK[1])
    placed = with_running(placed, "n", "upto")
    placed = staged(placed.withColumn("chunk", F.expr(f"(upto - n) div {chunk}")).drop("upto"), "minhash-blocks")
    spans = staged(placed.groupBy("chunk", "root").agg(F.min("n").alias("least"), F.max("n").alias("most")), "minhash-spans")
    # A candidate group within one block has one row, and no other.
    left = spans.select("root", F.col("chunk").alias("c"), F.col("most").alias("top"))
    right = spans.select("root", F.col("chunk").alias("d"), F.col("least").alias("bottom"))
    pairs = left.join(right, "root").filter(f"c < d and 100 * top >= {percent} * bottom").select("root", "c", "d")
    pairs = staged(pairs, "minhash-pairs")
    alone = placed.select("*", F.col("chunk").alias("c"), F.col("chunk").alias("d"), F.lit(False).alias("later"))
    one = placed.join(pairs, (placed.chunk == pairs.c) & (placed.root == pairs.root)).drop(pairs.root)
    two = placed.join(pairs, (placed.chunk == pairs.d) & (placed.root == pairs.root)).drop(pairs.root)
    both = one.withColumn("later", F.lit(False)).unionByName(two.withColumn("later", F.lit(True)))
    return alone.unionByName(both).drop("chunk")


def _sets_of(docs: DataFrame, members: DataFrame, shingle: int) -> DataFrame:
    """``high, low, shingles`` of every set of ``members`` and of some others, each once.

    A set comes from a row that has the id of its ``doc``.  Which rows do is told by bits: one bit
    of each id, in at most ``SLOTS`` words that are broadcast, so no text is shuffled however many
    candidates there are.  Rows that only share a bit bring sets that are nobody's.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_words.slices(batches):
            for _, texts in text_words.grouped(batch.column("text").to_pylist()):
                sets = Sets(texts, shingle)
                digests = np.frombuffer(b"".join(sets.digests()), "<i8").reshape(-1, 2)
                data = [sets.hashes[a:b].tobytes() for a, b in zip(sets.first[:-1], sets.first[1:])]
                columns = [pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.array(data, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["high", "low", "shingles"])

    ids = members.select(*_bit(F.col("doc")))
    bits = F.broadcast(ids.groupBy("_slot").agg(F.bit_or("_bit").alias("_bits")))
    own = docs.select("text", *_bit(F.col("doc_id"))).join(bits, "_slot")
    texts = own.filter(F.col("_bits").bitwiseAND(F.col("_bit")) != 0).select("text")
    # Copies bring the same set.
    return texts.mapInArrow(rows, "high bigint, low bigint, shingles binary").dropDuplicates(["high", "low"])


def _bit(value: Column) -> tuple[Column, Column]:
    """``_slot, _bit``: a word of the filter, and the bit of a value in it; null has one as well."""
    at = F.pmod(F.xxhash64(value), F.lit(64 * SLOTS))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))
    return F.shiftright(at, 6).alias("_slot"), bit.alias("_bit")


def confirm(docs: DataFrame, members: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, chunk: int | None = None) -> DataFrame:
    """``a, b``: links of ``members`` that connect what is alike in a candidate group.

    ``members`` has ``node, n_shingles, high, low, doc, root``.  Shingles move twice: a set to where
    its places are told, and from there to the groups that confirm it.
    """
    dealt = staged(_dealt(members, percent, chunk), "minhash-dealt")
    sets = _sets_of(docs, members, shingle).join(dealt, ["high", "low"]).drop("high", "low")
    return sets.groupBy("c", "d").applyInArrow(_confirmed(percent), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, coordinates: int = COORDINATES,
    shared: int = SHARED, most: int = LIST, chunk: int | None = None,
) -> DataFrame:
    """Each row's ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    Texts are lower-cased (A-Z) and cut into words at ASCII white space; a set is the distinct
    shingles of ``shingle`` words, or the whole sequence where there are fewer.  Rows link where
    100 * intersection >= ``percent`` * union; component_id is the smallest doc_id reachable, and a
    row is kept that has it.  Equal sets are one node.  Nodes are posted under the values of their
    MinHash coordinates, collisions are counted within the rarest lists, and what shares ``shared``
    coordinates is confirmed on the whole sets (64 bits a shingle).

    Null, empty and wordless texts have an empty set and link with nothing: their component_id is
    their own id.  Null ids are no candidates for component_id, which is null where all ids of a
    component are; such rows are kept.  Rows may repeat; other columns are ignored; no rows give
    no rows.
    """
    if not 50 <= percent <= 100:
        raise ValueError("signatures are laid out for sets that share half or more")
    ship(docs.sparkSession)
    rows = staged(
        prints(docs, shingle, coordinates).withColumn("row", F.monotonically_increasing_id()), "minhash-prints"
    )
    some = rows.filter("n_shingles > 0")
    # One node per distinct set: its first row, and the smallest id of its rows.
    sets = staged(
        some.groupBy("high", "low").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"), F.max("n_shingles").alias("n_shingles")),
        "minhash-nodes",
    )
    signed = sets.filter(F.col("n_shingles") >= _smallest_linked())
    first = rows.select("row", "sig", F.col("doc_id").alias("doc"))
    nodes = signed.join(first, signed.node == first.row).select("node", "n_shingles", "high", "low", "doc", "sig")
    nodes = staged(nodes, "minhash-signatures")
    grouped = candidates(nodes.select("node", "n_shingles", "sig"), shared, most, percent)
    inner = staged(grouped.union(grouped.select("root", "root").distinct()), "minhash-candidates")
    members = staged(nodes.drop("sig").join(inner, "node"), "minhash-members")
    roots = components(confirm(docs, members, shingle, percent, chunk))
    rooted = sets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = staged(rooted.join(least, "root").select("high", "low", "component_id"), "minhash-components")
    own = rows.drop("sig", "row")
    linked = own.filter("n_shingles > 0").join(named, ["high", "low"])
    alone = own.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")]
    return linked.select(*columns).union(alone.select(*columns))
