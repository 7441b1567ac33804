"""Files in a folder that all executors share: arrays read by memory map, and this package."""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
from pyarrow import fs
from pyspark.sql import SparkSession

import feedgate
from feedgate.session import work_dir


class SharedFolder:
    """A folder below ``spark.checkpoint.dir``: a local path, ``file:``, or any URI pyarrow opens.

    A file gets a name of its own and its final name only when it is whole, so a task that is
    run again or twice leaves at most files nobody reads.
    """

    def __init__(self, uri: str):
        self.uri = uri

    def _open(self):
        # Hadoop writes local folders with one slash, "file:/x".
        return fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", self.uri))

    @contextmanager
    def create(self) -> Iterator[tuple[str, object]]:
        """``name, stream`` of a new file."""
        system, root = self._open()
        system.create_dir(root, recursive=True)
        name = uuid.uuid4().hex
        with system.open_output_stream(f"{root}/{name}.part") as out:
            yield name, out
        system.move(f"{root}/{name}.part", f"{root}/{name}")  # whole only now

    def save(self, array: np.ndarray) -> str:
        """Write an array flat, little-endian, and return its file name."""
        with self.create() as (name, out):
            out.write(np.ascontiguousarray(array).data if array.size else b"")
        return name

    def load(self, name: str, dtype: str) -> np.ndarray:
        """The flat array, mapped where the folder is mounted, else read."""
        system, root = self._open()
        size = system.get_file_info(f"{root}/{name}").size
        if not size:
            return np.zeros(0, dtype)
        if isinstance(system, fs.LocalFileSystem):
            return np.memmap(f"{root}/{name}", dtype=dtype, mode="r")
        with system.open_input_stream(f"{root}/{name}") as source:
            return np.frombuffer(source.read(), dtype)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application; they may not have it installed.

    Packed below ``spark.checkpoint.dir``.  A package that is in an archive already came to the
    workers that way.
    """
    here = Path(feedgate.__file__).parent
    if spark.sparkContext.applicationId in _shipped or not here.is_dir():
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(here.rglob("*.py")):
            out.write(path, Path(here.name) / path.relative_to(here))
    folder = SharedFolder(work_dir(spark, "code"))
    with folder.create() as (name, out):
        out.write(packed.getvalue())
    system, root = folder._open()
    system.move(f"{root}/{name}", f"{root}/feedgate.zip")
    spark.sparkContext.addPyFile(f"{folder.uri}/feedgate.zip")
    _shipped.add(spark.sparkContext.applicationId)
