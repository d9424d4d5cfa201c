"""M1: pointer files as rows.

A pointer file is three lines of text: version, oid and size. One file is one
row. Files are read as binary content and taken as text here: for files this
small the whole-text source spends several times as long on each.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The pointer format and the largest file that can be a pointer.
POINTER_VERSION = "https://git-lfs.github.com/spec/v1"
POINTER_PATTERN = r"\Aversion (\S+)\noid sha256:([0-9a-f]{64})\nsize ([0-9]+)\n\z"
LINE_STARTS = {"version": "version ", "oid": "oid sha256:", "size": "size "}
POINTER_MAX_BYTES = 1024


SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def relative_path(file_path: Column, root: str) -> Column:
    """File path below ``root``, whose scheme is ignored; a path that does not start with the root is an error."""
    session = SparkSession.active()
    given = session._jvm.org.apache.hadoop.fs.Path(root)
    whole = given.getFileSystem(session._jsc.hadoopConfiguration()).makeQualified(given).toString()
    start = re.sub(SCHEME, "", whole).rstrip("/") + "/"
    plain = F.regexp_replace(file_path, SCHEME, "")
    outside = F.raise_error(F.concat(F.lit(f"not below {start}: "), plain))
    return F.when(F.startswith(plain, F.lit(start)), F.substring(plain, F.lit(len(start) + 1), F.length(plain))).otherwise(outside)


def pointer_files(files: DataFrame, root: str) -> DataFrame:
    """path below ``root`` and text of the files small enough for a pointer, from a binary file source.

    The size is tested on file metadata, so larger files drop out of the listing.
    """
    small = files.filter(F.col("_metadata.file_size") <= POINTER_MAX_BYTES)
    return small.select(relative_path(F.col("path"), root).alias("path"), F.col("content").cast("string").alias("value"))


def read_pointer(files: DataFrame, text: str = "value") -> DataFrame:
    """Adds version, oid, size and ``well_formed`` from the text of a pointer file.

    Each field is the rest of its line, so a malformed file still gives what can
    be read of it and validation can name the fault. ``size`` is null when it is
    no bigint.
    """
    parts = {
        name: F.when(F.startswith(line, F.lit(start)), F.substring(line, len(start) + 1, POINTER_MAX_BYTES))
        for (name, start), line in zip(LINE_STARTS.items(), [F.get("_lines", F.lit(i)) for i in range(3)])
    }
    return (
        files.withColumn("_lines", F.split(text, "\n"))
        .withColumns(
            {
                "version": parts["version"],
                "oid": parts["oid"],
                "size": parts["size"].try_cast("bigint"),
                "well_formed": F.col(text).rlike(POINTER_PATTERN),
            }
        )
        .drop(text, "_lines")
    )


def scan_pointers(spark: SparkSession, root: str, subdirs: Sequence[str] = ()) -> DataFrame:
    """path, version, oid, size, well_formed for each file below ``root``.

    The driver lists files, so a tree of billions of files is best taken in
    batches: ``subdirs`` limits the listing to some folders below the root while
    paths stay relative to the root. Files too large to be pointers are dropped
    unread; ``misfit_files`` reports them. No file source of Spark gives a row
    for an empty file: ``listed_files`` has its name.
    """
    return read_pointer(pointer_files(binary_files(spark, root, subdirs), root.rstrip("/")))


def binary_files(spark: SparkSession, root: str, subdirs: Sequence[str] = ()) -> DataFrame:
    """The files below ``root``, or below some folders of it, in the binary file source."""
    base = root.rstrip("/")
    where = [f"{base}/{sub}" for sub in subdirs] or [base]
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(where)


def listed_files(files: DataFrame, root: str) -> DataFrame:
    """path of every file the source has listed, the empty ones too.

    The names pass through the driver, which made the list: take large trees by ``subdirs``.
    """
    names = [(unquote(name),) for name in files.inputFiles()]
    return files.sparkSession.createDataFrame(names, "path string").select(relative_path(F.col("path"), root).alias("path"))


def misfit_files(spark: SparkSession, root: str, subdirs: Sequence[str] = ()) -> DataFrame:
    """path, file_size of files too large for a pointer; content is not read."""
    files = binary_files(spark, root, subdirs)
    # A filter on ``length`` would be applied file by file, and thousands of files
    # without a row in one task exhaust its stack; metadata is tested in the listing.
    return files.filter(F.col("_metadata.file_size") > POINTER_MAX_BYTES).select(
        relative_path(F.col("path"), root).alias("path"), F.col("length").alias("file_size")
    )
