"""Session settings the library relies on, and the place for written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

SETTINGS = {
    # All times in the target are instants, shown in UTC.
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value instead of spoiling the document.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Base64 text without line breaks after 76 characters.
    "spark.sql.chunkBase64String.enabled": "false",
    # Methods above this size are never compiled by the JVM; a wide contract in one generated
    # method would run interpreted.  Spark then generates one smaller class per operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings every feedgate job expects and return the session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def block_session(spark: SparkSession, block_bytes: int) -> SparkSession:
    """A session on the same cluster whose file reads are cut into blocks of this size.

    Reading with the part size as block size splits a feed without a shuffle: every task reads
    one part's bytes and writes one part.
    """
    session = configure(spark.newSession())
    session.conf.set("spark.sql.files.maxPartitionBytes", str(block_bytes))
    session.conf.set("spark.sql.files.openCostInBytes", str(block_bytes))
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    return session


def one_block_a_task(spark: SparkSession) -> SparkSession:
    """A session whose file reads never put two blocks into one task.

    So what is said of a block is said once, with its first fragment, and not with each of them.
    """
    session = block_session(spark, size_setting(spark, "spark.sql.files.maxPartitionBytes"))
    session.conf.set("spark.sql.files.maxPartitionNum", str((1 << 31) - 1))
    for name in ("spark.sql.shuffle.partitions", "spark.sql.files.ignoreCorruptFiles", "spark.sql.files.ignoreMissingFiles"):
        session.conf.set(name, spark.conf.get(name))
    return session


def bucket_session(spark: SparkSession, buckets: int) -> SparkSession:
    """A session on the same cluster whose shuffles match a table with this many buckets."""
    session = configure(spark.newSession())
    session.conf.set("spark.sql.shuffle.partitions", str(buckets))
    return session


def size_setting(spark: SparkSession, name: str) -> int:
    """A size setting in bytes; Spark writes sizes as ``134217728b`` or ``128m``."""
    text = spark.conf.get(name).strip().lower()
    digits = text.rstrip("bkmgt")
    unit = text[len(digits) :].rstrip("b")
    return int(digits) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` for tables a job writes.

    The folder has to be shared by all executors, so the setting is required on a
    cluster; only a local session may fall back to the machine's temporary folder.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="feedgate-")
    return f"{base.rstrip('/')}/feedgate-{label}-{uuid.uuid4().hex}"
