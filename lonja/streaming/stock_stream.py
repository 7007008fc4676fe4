"""Stock pages as they land: micro-batches folded into a state from which the totals of any moment follow.

The state has one row per SKU, warehouse and instant (the smallest and the largest version seen there, and whether
a bad observation was among them). Minimum, maximum and "any" do not mind order or repetition, so late pages, pages
that come twice and batches that are run again after a restart give the state of one full load of the same pages.
Its size is that of the distinct observations, not of the stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lonja.operators import stock
from lonja.sources import stock_pages

STATE = "sku string, warehouse string, updated_at timestamp, low struct<quantity:bigint,reserved:bigint>, high struct<quantity:bigint,reserved:bigint>, bad boolean"
#: Versions kept: the one a batch starts from must outlive it, in case the batch is run again.
KEPT = 2


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[int]:
    """Batches whose state is completely written, in order."""
    path, system = _folder(spark, root)
    if not system.exists(path):
        return []
    names = [status.getPath().getName() for status in system.listStatus(path)]
    numbers = [int(name.removeprefix("batch-")) for name in names if name.startswith("batch-")]
    return sorted(n for n in numbers if system.exists(_folder(spark, f"{root}/batch-{n}/_SUCCESS")[0]))


def read_state(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """The newest state, or the newest one from before a batch; empty if there is none."""
    known = [n for n in versions(spark, root) if before is None or n < before]
    if not known:
        return spark.createDataFrame([], STATE)
    return spark.read.schema(STATE).parquet(f"{root}/batch-{known[-1]}")


def fold_into(root: str, catalogue: DataFrame) -> Callable[[DataFrame, int], None]:
    """What ``foreachBatch`` runs: page texts (``value``) of one batch onto the state below ``root``."""

    def fold(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        observed = stock.validate_observations(stock_pages.scan_snapshot(stock_pages.parsed_pages(batch)), catalogue)
        # A batch that is run again starts from the same state as the first time.
        state = stock.merge_instants(read_state(spark, root, number), stock.stock_instants(observed))
        state.write.mode("overwrite").parquet(f"{root}/batch-{number}")
        for old in versions(spark, root)[:-KEPT]:
            path, system = _folder(spark, f"{root}/batch-{old}")
            system.delete(path, True)

    return fold


def stream_stock(
    spark: SparkSession, pages: str, root: str, catalogue: DataFrame, files_per_batch: int = 1000, available_now: bool = False
) -> StreamingQuery:
    """Watch a folder of pages (a file each) and keep the state below ``root`` up to date.

    ``available_now`` stops after the pages that are there. Progress and state are in ``root``: started again, the
    stream goes on where it was.
    """
    texts = spark.readStream.format("text").option("wholetext", "true").option("maxFilesPerTrigger", files_per_batch).load(pages)
    writer = texts.writeStream.foreachBatch(fold_into(f"{root}/state", catalogue)).option("checkpointLocation", f"{root}/progress")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def current_totals(spark: SparkSession, root: str, catalogue: DataFrame) -> DataFrame:
    """The totals of :func:`lonja.operators.stock.stock_totals` over all pages seen so far."""
    return stock.totals_of_instants(read_state(spark, f"{root}/state"), catalogue)
