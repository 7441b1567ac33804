"""Hilbert-curve ordering of rows by several columns, cut into shards of equal row counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedgate.llm.common import in_order, with_rank, with_running

#: Levels per dimension are 2 to the power of this.
BITS = 5


def levels(df: DataFrame, value: Column, bits: int = BITS) -> list[tuple]:
    """Cuts of one dimension at equal row counts: ``(smallest value, level)``, at most 2**bits.

    A value's level is the share of rows with smaller values.  Values are counted first, then
    summed in a global order, so neither a hot value nor many distinct values meet in one task.
    """
    counts = df.select(value.alias("v")).filter("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    running = with_running(in_order(counts, [F.col("v")], "hilbert-counts"), "n", "upto")
    total = running.agg(F.sum("n")).first()[0] or 1
    level = F.floor((F.col("upto") - F.col("n")) * F.lit(1 << bits) / F.lit(total)).cast("int")
    # At most 2**bits rows reach the driver.
    cuts = running.groupBy(level.alias("q")).agg(F.min("v").alias("v")).collect()
    return sorted((r["v"], r["q"]) for r in cuts)


def level_of(value: Column, cuts: list[tuple]) -> Column:
    """The level of a value: that of the last cut at or below it; null has level 0."""
    steps = [F.when(value >= F.lit(v), F.lit(q)) for v, q in reversed(cuts)]
    return F.coalesce(*steps, F.lit(0))


def hilbert_table(dims: int) -> list[int]:
    """Steps of the curve for ``dims`` dimensions as ``next_state * 2**dims + digit``.

    A state is an entry corner and a direction; row ``state * 2**dims + corner`` tells which digit
    of the index the corner has, and the state inside it (Hamilton's compact Hilbert indices).
    """
    corners, out = 1 << dims, []
    mask = corners - 1

    def left(x, n):
        n %= dims
        return ((x << n) | (x >> (dims - n))) & mask

    def gray(x):
        return x ^ (x >> 1)

    def trailing_ones(x):
        n = 0
        while x >> n & 1:
            n += 1
        return n

    rank = {gray(i): i for i in range(corners)}
    for state in range(corners * dims):
        entry, direction = state % corners, state // corners
        for corner in range(corners):
            digit = rank[left(corner ^ entry, dims - (direction + 1) % dims)]
            start = gray(2 * ((digit - 1) // 2)) if digit else 0
            turn = 0 if not digit else trailing_ones(digit - 1 if digit % 2 == 0 else digit) % dims
            inner = entry ^ left(start, direction + 1), (direction + turn + 1) % dims
            out.append((inner[1] * corners + inner[0]) * corners + digit)
    return out


def hilbert_index(axes: list[Column], bits: int = BITS) -> Column:
    """Position on the Hilbert curve of a cell given by whole numbers below 2**bits."""
    dims = len(axes)
    steps = F.array(*[F.lit(x) for x in hilbert_table(dims)])
    axes = [a.cast("int") for a in axes]

    def corner(bit):
        bits_of = [F.call_function("shiftright", a, bit).bitwiseAND(F.lit(1)) for a in axes]
        return sum((b * (1 << i) for i, b in enumerate(bits_of)), F.lit(0))

    def step(acc, bit):
        packed = F.get(steps, acc["state"] * (1 << dims) + corner(bit))
        return F.struct(
            F.shiftright(packed, dims).alias("state"),
            (acc["index"] * (1 << dims) + packed.bitwiseAND(F.lit((1 << dims) - 1))).alias("index"),
        )

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("index"))
    return F.aggregate(F.array(*[F.lit(b) for b in reversed(range(bits))]), start, step, lambda a: a["index"])


def hilbert_shards(df: DataFrame, dims: list[Column], ties: list[Column], shards: int, bits: int = BITS) -> DataFrame:
    """All rows and columns of ``df`` with ``hilbert``, ``shard`` and ``slot`` (place in the shard).

    Every dimension is quantised to 2**bits levels of equal row counts; rows are sorted by curve
    index, then ``ties``; runs of equal length are the shards (row counts at most one apart).  Rows
    near each other in all dimensions share a shard, so files cut from it have narrow ranges in
    each.  A hot cell is spread over partitions by the ties.  Null dimensions have level 0.  Rows
    equal in all ties may swap places.  No rows give no rows.
    """
    axes = [level_of(d, levels(df, d, bits)) for d in dims]
    cells = df.withColumn("hilbert", hilbert_index(axes, bits))
    placed = in_order(cells, [F.col("hilbert"), *ties], "hilbert-order")
    n = placed.count()
    ranked = with_rank(placed, "_rank").withColumn("shard", F.floor(F.col("_rank") * shards / F.lit(max(n, 1))).cast("int"))
    first = F.ceil(F.col("shard") * F.lit(n) / F.lit(shards))
    return ranked.withColumn("slot", (F.col("_rank") - first).cast("long")).drop("_rank")


def shard_ranges(sharded: DataFrame, columns: list[str]) -> DataFrame:
    """Per shard the smallest and largest value of each column: what a reader prunes files by."""
    ends = [f(c).alias(f"{p}_{c}") for c in columns for f, p in ((F.min, "min"), (F.max, "max"))]
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *ends)
