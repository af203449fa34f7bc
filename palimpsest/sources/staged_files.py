"""Files already staged: which are there, and what do they hash to?"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions.links import base_name
from palimpsest.workspace import ship_library

PIECE_BYTES = 8 * 1024 * 1024
# Hadoop's names of schemes, and those the task's file systems know.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}
READABLE = ("file", "s3", "gs", "gcs", "hdfs", "viewfs", "abfs")
#: From a path to a file system that is open in the task, and the path inside it.
Opener = Callable[[str], tuple[fs.FileSystem, str]]


def _binary_files(spark: SparkSession, path: str | list[str], glob: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def list_staged(
    spark: SparkSession,
    path: str | list[str],
    glob: str | None = None,
    name: Column | None = None,
) -> DataFrame:
    """``name``, ``path``, ``length`` of the files under ``path``; reads no bytes."""
    label = base_name(F.col("path")) if name is None else name
    return _binary_files(spark, path, glob).select(label.alias("name"), "path", "length")


def digest_staged(
    spark: SparkSession,
    path: str | list[str],
    glob: str | None = None,
    name: Column | None = None,
    opener: Opener | None = None,
) -> DataFrame:
    """``name``, ``path``, ``md5`` of every file under ``path``, whatever its size."""
    return digest_paths(list_staged(spark, path, glob, name), opener)


def digest_paths(listing: DataFrame, opener: Opener | None = None) -> DataFrame:
    """``name``, ``path``, ``md5`` of the listed files, each read in pieces by one task.

    ``opener`` replaces the choice of the file system, for stores that need
    credentials or that ``open_path`` does not know; an unknown scheme fails on the
    driver, before any task runs.
    """
    if opener is None:
        scheme = F.regexp_extract("path", "^([A-Za-z][A-Za-z0-9+.-]*):", 1)
        for row in listing.select(scheme.alias("scheme")).distinct().collect():
            known_scheme(row.scheme or "file")
    ship_library(listing.sparkSession)
    spread = listing.select("name", "path").repartition("path")
    return spread.mapInArrow(_digester(opener), "name string, path string, md5 string")


def known_scheme(scheme: str) -> str:
    """The scheme as the task's file systems call it."""
    known = SCHEMES.get(scheme, scheme)
    if known not in READABLE:
        raise ValueError(f"no file system for {scheme}: paths; give an opener")
    return known


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark lists it, and the path inside it."""
    found = re.match("^([A-Za-z][A-Za-z0-9+.-]*):(.*)$", path, re.DOTALL)
    if not found or found[1] == "file":
        inner = found[2] if found else path
        return fs.LocalFileSystem(), "/" + inner.lstrip("/")
    return fs.FileSystem.from_uri(f"{known_scheme(found[1])}:{found[2]}")


def _digester(opener: Opener | None = None, piece_bytes: int = PIECE_BYTES):
    """The function the tasks run; defined here so that Spark ships it by value."""
    open_file = opener or open_path

    def md5_of(path: str) -> str:
        filesystem, inner = open_file(path)
        digest = hashlib.md5()
        with filesystem.open_input_stream(inner, compression=None) as stream:
            while piece := stream.read(piece_bytes):
                digest.update(piece)
        return digest.hexdigest()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = pa.array(map(md5_of, batch.column("path").to_pylist()), pa.string())
            columns = [batch.column("name"), batch.column("path"), hashes]
            yield pa.RecordBatch.from_arrays(columns, names=["name", "path", "md5"])

    return digest
