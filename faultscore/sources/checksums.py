"""File integrity (A9): SHA-256 of files, compared with a manifest.

The file index lists every file below a folder, empty ones too; the list is a
table, each file is read in blocks on an executor through the shared file
system with the digest carried from block to block, and the manifest check is
an equi-join on the path relative to that folder.  A digest needs a file's
bytes in order, so a file is the unit of work, whatever its size: a task holds
one block of it.  File systems that Arrow cannot open are read through Spark's
own reader, a file a row, which holds files of up to 2 GiB.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a file that a task holds at a time.
BLOCK_BYTES = 1 << 20
#: Schemes whose files are read in blocks, and what Arrow calls them.
STREAMED = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfss": "abfss"}
FILES_PER_TASK = 16


def block_digest(url: str, block: int = BLOCK_BYTES) -> tuple[int, str]:
    """(bytes, SHA-256) of one file, read block by block."""
    scheme, rest = url.split(":", 1)
    if scheme == "file":
        system, path = pafs.LocalFileSystem(), unquote(urlsplit(url).path)
    else:
        system, path = pafs.FileSystem.from_uri(f"{STREAMED[scheme]}:{rest}")
    digest, length = hashlib.sha256(), 0
    with system.open_input_stream(path, compression=None, buffer_size=0) as stream:
        while data := stream.read(block):
            digest.update(data)
            length += len(data)
    return length, digest.hexdigest()


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for urls in batches:
        for url in urls["url"]:  # a row as soon as its file is read
            length, digest = block_digest(url)
            yield pd.DataFrame({"path": [unquote(url)], "length": [length], "sha256": [digest]})


def file_checksums(spark: SparkSession, root: str, name_glob: str | None = None) -> DataFrame:
    """path (below ``root``, or the file's own name), length and sha256 of a
    file, or of every file in a folder and the folders below it."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    listed = (reader.option("pathGlobFilter", name_glob) if name_glob else reader).load(root)
    urls = sorted(listed.inputFiles())  # names only: Spark's file index holds them on the driver in any case
    if {u.split(":", 1)[0] for u in urls} <= set(STREAMED):
        table = spark.createDataFrame([(u,) for u in urls], "url string").repartition(max(1, -(-len(urls) // FILES_PER_TASK), min(len(urls), spark.sparkContext.defaultParallelism)))
        files = table.mapInPandas(_digests, "path string, length long, sha256 string")
    else:
        files = listed.select("path", "length", F.sha2("content", 256).alias("sha256"))
    folder = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//)?", "", root).rstrip("/") + "/"
    below = F.substring_index("path", folder, -1)
    relative = F.when(F.contains(F.col("path"), F.lit(folder)), below).otherwise(F.substring_index("path", "/", -1))
    return files.select(relative.alias("path"), "length", "sha256")


def verify_checksums(checksums: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows whose hash differs from the manifest (path, expected, actual)."""
    joined = manifest.select("path", F.col("sha256").alias("expected")).join(
        checksums.select("path", F.col("sha256").alias("actual")), "path", "left"
    )
    return joined.where(F.col("actual").isNull() | (F.col("actual") != F.col("expected")))


def require_checksum(checksums: DataFrame, manifest: DataFrame) -> None:
    bad = verify_checksums(checksums, manifest).take(1)
    if bad:
        row = bad[0]
        raise ValueError(f"checksum mismatch: expected {row['expected']}, got {row['actual']}")
