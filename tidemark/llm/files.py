"""Files of formats that Spark does not write, in a folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyarrow import fs
from pyspark.sql import SparkSession

from tidemark.session import work_folder


def shared_folder(spark: SparkSession, label: str) -> str:
    """The URI of a new folder under ``spark.checkpoint.dir``, its file system named."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_folder(spark, label))
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(path).toString()


def place_of(uri: str) -> tuple[fs.FileSystem, str]:
    scheme, colon, path = uri.partition(":")
    if colon and scheme == "file":
        return fs.LocalFileSystem(), "/" + path.lstrip("/")
    return fs.FileSystem.from_uri(uri)


class Attempt:
    """Files of one task attempt, which get their final names together at the end.

    A repeated or lost task writes the same files again, so it does not matter which attempt
    is renamed last, and no reader sees a file that is not whole.
    """

    def __init__(self, folder: str):
        self.system, self.folder = place_of(folder)
        self.system.create_dir(self.folder, recursive=True)
        self.mark = uuid.uuid4().hex
        self.names: list[str] = []

    @contextmanager
    def create(self, name: str) -> Iterator:
        with self.system.open_output_stream(f"{self.folder}/.{self.mark}-{name}") as stream:
            yield stream
        self.names.append(name)

    def publish(self) -> None:
        for name in self.names:
            self.system.move(f"{self.folder}/.{self.mark}-{name}", f"{self.folder}/{name}")


def mapped(folder: str, name: str, kind: str) -> np.ndarray:
    """A file as an array: memory-mapped where it is local, else read."""
    system, path = place_of(f"{folder}/{name}")
    if system.get_file_info(path).size == 0:
        return np.zeros(0, kind)
    if isinstance(system, fs.LocalFileSystem):
        return np.asarray(np.memmap(path, kind, "r"))  # slices of the plain class are quicker
    with system.open_input_file(path) as stream:
        return np.frombuffer(stream.read(), kind)
