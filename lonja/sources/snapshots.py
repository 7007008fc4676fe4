"""Published snapshots: versioned Parquet folders, an append-only ledger and the run log.

A load writes all its tables to folders of its own. What makes them current is one row appended to the run
log, so readers see either the previous snapshot or the complete new one. A run that fails leaves the
previous one in place.

Before that row, a run claims its base: a file named after the snapshot it was built on, created exclusively.
Of two loads on the same base only one can do that, whatever their timing.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.operators.browse import latest_publication

SCHEMAS = {
    "products": (
        "id bigint, sku string, ean string, name string, brand string, category string, "
        "brand_key string, category_key string, base_cost decimal(18,4), net_cost decimal(18,4), "
        "pvp decimal(18,4), tax_rate decimal(9,6), weight_kg decimal(18,4), listed_on date, "
        "description string, price_origin string, category_discount decimal(9,6), "
        "brand_discount decimal(9,6), is_historical boolean, in_catalog boolean, stock_total bigint, "
        "stock_status string, stock_as_of timestamp, last_run_id string"
    ),
    "orders": (
        "id bigint, source_order_id string, order_date date, customer string, channel string, "
        "status string, has_rejected_lines boolean, last_run_id string"
    ),
    "order_lines": (
        "id bigint, order_id bigint, product_id bigint, line_key string, quantity bigint, "
        "unit_price decimal(18,4), discount decimal(9,6), source_locator string, last_run_id string"
    ),
    "stock_by_warehouse": (
        "product_id bigint, warehouse_code string, quantity bigint, reserved bigint, "
        "updated_at timestamp, last_run_id string"
    ),
    "low_stock": "sku string, name string, stock_total bigint, recent_units bigint",
    "ledger": (
        "source string, record_locator string, entity_key string, reason_code string, "
        "field_name string, action string, severity string, detail string, raw_excerpt string, "
        "run_id string"
    ),
    "runs": (
        "run_id string, started_at timestamp, finished_at timestamp, status string, phase string, "
        "error_code string, csv_sha256 string, xml_sha256 string, orders_sha256 string, "
        "stock_sha256 string, rules_version string, counters string, summary string, "
        "recorded_at timestamp"
    ),
}
BUSINESS = ["products", "orders", "order_lines", "stock_by_warehouse"]


def latest_states(log: DataFrame) -> DataFrame:
    """The last recorded state of every run."""
    fields = [name for name in log.columns if name != "run_id"]
    return (
        log.groupBy("run_id")
        .agg(F.max_by(F.struct(*fields), "recorded_at").alias("s"))
        .select("run_id", "s.*")
    )


class SnapshotStore:
    """Tables below one folder of a shared file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.staged: list[str] = []

    def _file(self, path: str):
        """A path and its file system, as Spark itself reaches it."""
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _claim_path(self, base: str | None) -> str:
        return f"{self.root}/claims/{base or 'none'}"

    def claim(self, base: str | None) -> bool:
        """Take the right to publish on a base; False if another run has it or had it."""
        path, system = self._file(self._claim_path(base))
        try:
            system.create(path, False).close()
        except Py4JJavaError as error:
            if not system.exists(path):
                raise error
            return False
        return True

    def release(self, base: str | None) -> None:
        """Give the base back after a run that claimed it could not commit."""
        path, system = self._file(self._claim_path(base))
        system.delete(path, False)

    def discard_staged(self) -> None:
        """Remove the intermediate results written through this store."""
        for staged in self.staged:
            path, system = self._file(staged)
            system.delete(path, True)
        self.staged.clear()

    def _read(self, path: str, table: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[table]).parquet(path)

    def _exists(self, path: str) -> bool:
        try:
            self.spark.read.format("binaryFile").load(path).select("path").isEmpty()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True

    def runs(self) -> DataFrame:
        """The last state of every run; empty in a new store only."""
        if self._exists(f"{self.root}/runs"):
            return latest_states(self._read(f"{self.root}/runs", "runs"))
        if self._exists(f"{self.root}/products") or self._exists(f"{self.root}/ledger"):
            raise FileNotFoundError(f"the run log of the store {self.root} is lost")
        return latest_states(self.spark.createDataFrame([], SCHEMAS["runs"]))

    def current_run(self) -> str | None:
        row = latest_publication(self.runs()).select("run_id").first()
        return row["run_id"] if row else None

    def read(self, table: str, run_id: str | None = None) -> DataFrame:
        """A business table as published by a run, by default by the current one.

        Empty only if nothing was ever published; a version whose folder is lost is an error.
        """
        run_id = run_id or self.current_run()
        if run_id is None:
            return self.spark.createDataFrame([], SCHEMAS[table])
        return self._read(f"{self.root}/{table}/version={run_id}", table)

    def ledger(self, run_id: str) -> DataFrame:
        return self._read(f"{self.root}/ledger/version={run_id}", "ledger")

    def write(self, table: str, rows: DataFrame, run_id: str) -> DataFrame:
        """Write one version of a table and read it back, so that later steps start from files."""
        wanted = self.spark.createDataFrame([], SCHEMAS[table]).schema
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])
        path = f"{self.root}/{table}/version={run_id}"
        typed.write.mode("overwrite").parquet(path)
        return self._read(path, table)

    def stage(self, name: str, rows: DataFrame, run_id: str) -> DataFrame:
        """Intermediate result of a run as files: shared by later steps, safe against lost executors."""
        path = f"{self.root}/stage/{name}/version={run_id}"
        self.staged.append(path)
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def record_run(self, **values) -> None:
        """Append one state of a run to the log."""
        row = {name.split(" ")[0]: None for name in SCHEMAS["runs"].split(", ")} | values
        self.spark.createDataFrame([row], SCHEMAS["runs"]).coalesce(1).write.mode("append").parquet(
            f"{self.root}/runs"
        )
