"""Listing and fingerprints of landed files."""

from __future__ import annotations

import hashlib
import posixpath

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lonja.session import materialized

BLOCK = 4 << 20
MAX_TASKS = 20_000
#: Digests under one node of a hash tree.
FAN_IN = 256


def open_file(uri: str):
    """Random-access stream on a file of any file system Arrow knows (local, HDFS, S3, GCS)."""
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file:///" + uri[len("file:/"):].lstrip("/")
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, length`` of the files below a folder; contents are not read."""
    return spark.read.format("binaryFile").load(path).select("path", "length")


def _digest(batches):
    for batch in batches:
        digests, paths = [], batch.column("path").to_pylist()
        for path in paths:
            digest = hashlib.sha256()
            with open_file(path) as stream:
                while block := stream.read(BLOCK):
                    digest.update(block)
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths), batch.column("length"), pa.array(digests, pa.string())],
            names=["path", "length", "sha256"],
        )


def source_fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of every file of a source, streamed block by block, one file per task."""
    files = list_files(spark, path)
    tasks = max(1, min(MAX_TASKS, files.count()))
    return files.repartition(tasks, "path").mapInArrow(
        _digest, "path string, length bigint, sha256 string"
    )


def changed_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files that appeared, vanished or changed between two fingerprints; must be empty."""
    left = before.select("path", F.col("sha256").alias("before"))
    right = after.select("path", F.col("sha256").alias("after"))
    return left.join(right, "path", "full").where(~F.col("before").eqNullSafe(F.col("after")))


def _numbered(rows: DataFrame) -> DataFrame:
    """``place`` from 0 in the order of ``path``, with no task that sees all rows."""
    spread = rows.repartitionByRange("path").withColumn("part", F.spark_partition_id())
    spread = materialized(spread, "paths")
    # One small row per range.
    sizes = spread.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("path")) - 1
    return spread.withColumn("inside", inside).join(before, "part").withColumn("place", F.col("before") + F.col("inside"))


def _node(kind: str, parts: Column) -> Column:
    """Digest of a node: its kind and its parts, each with its length before it."""
    framed = F.transform(parts, lambda part: F.concat(F.octet_length(part).cast("string"), F.lit(":"), part))
    return F.sha2(F.concat(F.lit(f"{kind}\n"), F.array_join(framed, "\n")), 256)


def source_digest(fingerprint: DataFrame, root: str = "", fan_in: int = FAN_IN) -> DataFrame:
    """One line per source for the run log: the SHA-256 of its file, or the root of a hash tree over its files.

    A leaf of the tree is the digest of a file's name below ``root`` and of its SHA-256, in the order of the
    names; a node is the digest of ``fan_in`` neighbours. So renaming a file, exchanging the contents of two or
    moving bytes from one to another gives another root, and no task sees more than ``fan_in`` digests.
    """
    one = fingerprint.limit(2).collect()
    if len(one) < 2:
        return fingerprint.select("sha256")
    name = F.when(F.startswith("path", F.lit(root)), F.substring("path", F.lit(len(root) + 1), F.length("path"))).otherwise(F.col("path"))
    rows = _numbered(fingerprint.select(name.alias("path"), "sha256"))
    level = rows.select("place", _node("file", F.array("path", "sha256")).alias("sha256"))
    level = materialized(level, "hash-tree")
    while level.limit(2).count() > 1:
        parents = level.groupBy(F.floor(F.col("place") / fan_in).alias("parent")).agg(
            F.array_sort(F.collect_list(F.struct("place", "sha256"))).alias("children"))  # fan_in at most
        level = materialized(parents.select(
            F.col("parent").alias("place"),
            _node("node", F.transform("children", lambda child: child["sha256"])).alias("sha256")), "hash-tree")
    return level.select("sha256")


def source_root(fingerprint: DataFrame) -> str:
    """The longest folder that all paths have in common."""
    row = fingerprint.agg(F.min("path").alias("first"), F.max("path").alias("last")).first()
    if row["first"] is None:
        return ""
    return posixpath.commonprefix([row["first"], row["last"]]).rpartition("/")[0] + "/"
