"""An index beside a parquet target: per file the range of its keys and a Bloom filter of them.

A load asks the index which files may hold a key of the feed and reads the key column of those only.
The index lies in a folder of the target that Spark's readers pass over.  It is never relied on:
files it does not list with their present size are read as if they may hold any key.
"""

from __future__ import annotations

from array import array

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedgate.contract import TableContract
from feedgate.sources import target as targets

INDEX = "_key_index"

#: Bits of the filter per key, and how many of them a key sets: one in three million absent keys
#: is taken for present.
BITS = 32
HASHES = 16

#: Distinct feed keys that are looked up (8 MB of hashes in each task); with more, most files
#: hold one of them anyway and the target is scanned.
MAX_KEYS = 1 << 20

_FILTERS = "name string, bytes bigint, least string, most string, bloom binary"


def _filters():
    """Task-side work.  Nested, so that it travels by value to the workers."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def places(hashes, nth, size):
        """The ``nth`` bit of each hash among ``size``, a power of two."""
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        return (hashes + np.uint64(nth) * step) & np.uint64(size - 1)

    def build(group):
        hashes = group.column("hash").to_numpy().view(np.uint64)
        size = 1 << max(10, (BITS * len(hashes) - 1).bit_length())
        bits = np.zeros(size, bool)
        for nth in range(HASHES):
            bits[places(hashes, nth, size)] = True
        ends = pc.min_max(group.column("key"))
        return pa.table(
            {
                "name": group.column("name").slice(0, 1).combine_chunks(),
                "bytes": group.column("bytes").slice(0, 1).combine_chunks(),
                "least": pa.array([ends["min"].as_py()], pa.string()),
                "most": pa.array([ends["max"].as_py()], pa.string()),
                "bloom": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary()),
            }
        )

    def may_hold(wanted):
        wanted = np.frombuffer(wanted, "<u8")

        def probe(batches):
            for batch in batches:
                keep = []
                for bloom in batch.column("bloom"):
                    bits, left = np.frombuffer(bloom.as_py(), np.uint8), wanted
                    for nth in range(HASHES):  # most absent keys fall out with the first bits
                        at = places(left, nth, 8 * len(bits))
                        left = left[(bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
                    keep.append(len(left) > 0)
                yield batch.select(["name"]).filter(pa.array(keep))

        return probe

    return build, may_hold


def _files(spark: SparkSession, path: str) -> DataFrame:
    """``file, name, bytes`` of the target's files; no content is read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return listed.select(
        F.col("path").alias("file"), F.regexp_extract("path", "([^/]*)$", 1).alias("name"), F.col("length").alias("bytes")
    )


def _index(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(_FILTERS).parquet(f"{path.rstrip('/')}/{INDEX}")
    except Exception as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return None


def refresh(spark: SparkSession, path: str, contract: TableContract) -> int:
    """Index the files the index lacks, after an append; returns how many.

    Names of new files come to the driver, as many as an append has tasks.
    """
    files, known = _files(spark, path), _index(spark, path)
    if known is not None:
        files = files.join(known.select("name", "bytes"), ["name", "bytes"], "left_anti")
    new = [r.file for r in files.select("file").toLocalIterator()]
    if not new:
        return 0
    build, _ = _filters()
    key = F.col(contract.key).cast("string")
    keys = targets.read_files(spark, new, contract).filter(key.isNotNull()).select(
        F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_size").alias("bytes"),
        key.alias("key"), F.xxhash64(key).alias("hash"),
    )
    # A group is one file's keys.
    built = keys.groupBy("name").applyInArrow(build, _FILTERS)
    place = f"{path.rstrip('/')}/{INDEX}"
    built.write.mode("append").parquet(place)
    # Files without keys: an entry that no key is looked up in.
    without = files.select("name", "bytes").join(spark.read.schema(_FILTERS).parquet(place).select("name", "bytes"), ["name", "bytes"], "left_anti")
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (("least", "string"), ("most", "string"), ("bloom", "binary"))]
    without.select("name", "bytes", *nothing).write.mode("append").parquet(place)
    return len(new)


def files_to_read(spark: SparkSession, path: str, rows: DataFrame, key: str) -> list[str] | None:
    """The target's files that may hold a key of ``rows``; None where all are to be read."""
    known = _index(spark, path)
    if known is None:
        return None
    text = F.col(key).cast("string")
    keys = rows.filter(text.isNotNull()).select(text.alias("key"), F.xxhash64(text).alias("hash"))
    least, most = keys.agg(F.min("key"), F.max("key")).first()
    if least is None:
        return []
    found = [r.hash for r in keys.select("hash").distinct().limit(MAX_KEYS + 1).collect()]
    if len(found) > MAX_KEYS:
        return None
    wanted = array("q", found).tobytes()
    _, may_hold = _filters()
    files = _files(spark, path)
    current = known.join(files.select("name", "bytes"), ["name", "bytes"], "left_semi")
    near = current.filter((F.col("least") <= most) & (F.col("most") >= least))
    held = near.select("name", "bloom").mapInArrow(may_hold(wanted), "name string")
    # Files without an entry of their size: the index is behind, or a file has changed.
    unknown = files.join(known.select("name", "bytes"), ["name", "bytes"], "left_anti").select("name")
    chosen = files.join(held.union(unknown).distinct(), "name", "left_semi").select("file")
    return [r.file for r in chosen.toLocalIterator()]


def rows_that_may_match(spark: SparkSession, path: str, contract: TableContract, rows: DataFrame) -> DataFrame:
    """The target's rows, without files that cannot hold a key of ``rows``."""
    files = files_to_read(spark, path, rows, contract.key)
    if files is None:
        return targets.read_target(spark, path, contract)
    return targets.read_files(spark, files, contract)
