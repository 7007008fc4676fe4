"""One complete load: four sources to a published snapshot.

Every branch is a chain of DataFrame jobs. Results with several consumers are staged as Parquet in the
store, which also gives later joins their true sizes. Small facts only come to the driver: problems that
stop the run, counters and digests.
"""

from __future__ import annotations

import itertools
import logging
import uuid
from dataclasses import dataclass
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.operators import catalogue, merge, metrics, orders, pricing, reporting, stock, tariffs
from lonja.operators.issues import cells_excerpt, explode_issues, order_excerpt
from lonja.session import tune
from lonja.sources import files, stock_pages, tables
from lonja.sources import tariffs as tariff_files
from lonja.sources.snapshots import SnapshotStore
from lonja.vocabulary import (
    BUSINESS_ZONE,
    CATALOGUE,
    FAIL,
    ORDERS,
    RULES_VERSION,
    SALES_START,
    STOCK,
    TARIFFS,
)


log = logging.getLogger(__name__)
#: Column of the run log with each source's digest.
HASHES = {CATALOGUE: "csv_sha256", TARIFFS: "xml_sha256", ORDERS: "orders_sha256", STOCK: "stock_sha256"}


class RunFailed(ValueError):
    """A run that must not publish anything."""

    def __init__(self, code: str, source: str, locator: str = "/"):
        super().__init__(code)
        self.code, self.source, self.locator = code, source, locator


@dataclass(frozen=True)
class Sources:
    catalogue: str
    tariffs: str
    orders: str
    stock: str
    per_page: int = 50


def _stop_on(problems: DataFrame, source: str) -> None:
    """Fail on the first of the rows ``problem, locator``."""
    found = problems.orderBy("locator").limit(1).collect()
    if found:
        raise RunFailed(found[0]["problem"], source, found[0]["locator"])


def _no_excerpt():
    return F.lit(None).cast("string")


class Load:
    """State of one run; each step reads and writes staged tables."""

    def __init__(self, spark: SparkSession, sources: Sources, store: SnapshotStore, zone: str):
        self.spark, self.sources, self.store, self.zone = spark, sources, store, zone
        self.run_id = str(uuid.uuid4())
        self.base = store.current_run()
        self.phase = "extract"
        #: Issues known so far, by the part of the load that found them; all read staged files.
        self.ledgers: dict[str, DataFrame] = {}
        self.prints: dict[str, DataFrame] = {}
        self.hashes: dict[str, str] = {}

    def stage(self, name: str, rows: DataFrame) -> DataFrame:
        return self.store.stage(name, rows, self.run_id)

    def keeper(self, name: str):
        """Stages the frames an operator asks to keep, one after the other."""
        step = itertools.count(1)
        return lambda rows: self.stage(f"{name}_step{next(step)}", rows)

    def scan(self, name: str, rows: DataFrame) -> DataFrame:
        scanned = self.stage(f"{name}_scan", rows)
        _stop_on(tables.structural_problems(scanned), name)
        return tables.records_of(scanned)

    def fingerprint(self, name: str) -> DataFrame:
        """Digests of a source's files; a source that cannot be read ends the run."""
        path = {
            CATALOGUE: self.sources.catalogue,
            TARIFFS: self.sources.tariffs,
            ORDERS: self.sources.orders,
            STOCK: self.sources.stock,
        }[name]
        try:
            return files.source_fingerprint(self.spark, path)
        except AnalysisException as error:
            code = "STOCK_FETCH_FAILED" if name == STOCK else "SOURCE_READ_FAILED"
            raise RunFailed(code, name) from error

    def remember(self, name: str) -> None:
        """Digest of a source before it is read."""
        self.prints[name] = self.stage(f"hash_{name}", self.fingerprint(name))
        self.hashes[HASHES[name]] = files.source_digest(
            self.prints[name], files.source_root(self.prints[name])).first()["sha256"]

    def load_tariffs(self) -> tuple[DataFrame, DataFrame]:
        self.tariff_elements = tariff_files.read_elements(self.spark, self.sources.tariffs)
        problems = tariff_files.structure_problems(self.tariff_elements).where("problem is not null")
        _stop_on(problems.select("problem", F.lit("/").alias("locator")), TARIFFS)
        rules = self.stage(
            "tariff_rules",
            tariffs.deduplicate_rules(tariffs.validate_rules(tariff_files.scan_rules(self.tariff_elements))),
        )
        exceptions = self.stage(
            "tariff_exceptions",
            tariffs.deduplicate_exceptions(
                tariffs.validate_exceptions(tariff_files.scan_exceptions(self.tariff_elements))
            ),
        )
        for frame in (rules, exceptions):
            _stop_on(frame.where("problem is not null").select("problem", "locator"), TARIFFS)
        return rules, exceptions

    def load_catalogue(self) -> DataFrame:
        self.remember(CATALOGUE)
        self.remember(TARIFFS)
        scanned = self.scan(CATALOGUE, tables.scan_catalogue(self.spark, self.sources.catalogue))
        parsed = self.stage("catalogue_parsed", catalogue.parse_catalogue(scanned))
        # Known even if the tariffs turn out to be unusable; the settled rows replace them below.
        self.ledgers[CATALOGUE] = explode_issues(parsed, cells_excerpt(F.col("cells")))
        rules, exceptions = self.load_tariffs()
        judge = pricing.price_judge(
            tariffs.exception_dimension(exceptions),
            tariffs.rule_dimension(rules, "categoria"),
            tariffs.rule_dimension(rules, "marca"),
        )
        chosen = catalogue.select_first_valid(parsed, judge, self.keeper("catalogue"))
        records = self.stage("catalogue_records", chosen)
        terms = tariffs.unapplied_terms(
            tariff_files.scan_conditions(self.tariff_elements),
            tariff_files.volume_terms(rules),
        )
        plain = ["source", "locator", "entity", "issues", "excerpt"]
        # An exception without a product is no fault of its element.
        orphans = tariffs.orphan_exceptions(exceptions, parsed).withColumn("excerpt", _no_excerpt())
        self.tariff_issues = self.stage(
            "tariff_issues",
            rules.select(plain)
            .unionByName(exceptions.select(plain))
            .unionByName(terms.select(plain))
            .unionByName(orphans.select(plain)),
        )
        self.ledgers[CATALOGUE] = explode_issues(records, cells_excerpt(F.col("cells")))
        self.ledgers[TARIFFS] = explode_issues(self.tariff_issues, F.col("excerpt"))
        self.seen = (
            parsed.where("entity is not null and (candidate or size(issues) > 0)")
            .select(F.col("entity").alias("sku"))
            .distinct()
        )
        return records

    def load_orders(self) -> DataFrame:
        self.remember(ORDERS)
        scanned = self.scan(ORDERS, tables.scan_orders(self.spark, self.sources.orders))
        selected = orders.select_orders(scanned, self.zone, self.keeper("orders"))
        records = self.stage("order_records", selected)
        self.ledgers[ORDERS] = explode_issues(records, order_excerpt(F.col("cells")))
        return records

    def load_stock(self, accepted: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        self.remember(STOCK)
        pages = stock_pages.read_pages(self.spark, self.sources.stock)
        if not stock_pages.page_problems(pages, self.sources.per_page).isEmpty():
            raise RunFailed("STOCK_FETCH_FAILED", STOCK)
        skus = accepted.select("sku")
        checked = stock.validate_observations(stock_pages.scan_snapshot(pages), skus)
        records = self.stage(
            "stock_records", stock.reconcile_versions(self.stage("stock_checked", checked))
        )
        totals = self.stage("stock_totals", stock.stock_totals(records, skus))
        conflicts = stock.conflict_warnings(records)
        self.ledgers[STOCK] = (
            explode_issues(records, stock.ledger_excerpt(records))
            .unionByName(explode_issues(totals, _no_excerpt()))
            .unionByName(explode_issues(conflicts, _no_excerpt()))
        )
        return records, totals, conflicts

    def require(self, accepted: DataFrame, code: str, source: str) -> None:
        if not tables.empty_source(accepted, code).isEmpty():
            raise RunFailed(code, source)

    def require_unchanged(self) -> None:
        for name, before in self.prints.items():
            if not files.changed_files(before, self.fingerprint(name)).isEmpty():
                raise RunFailed("SOURCE_CHANGED", name)

    def require_base(self) -> None:
        """The snapshot this run was built on must still be the current one."""
        if self.store.current_run() != self.base:
            raise RunFailed("RUN_SUPERSEDED", "etl")

    def commit(self, **state) -> None:
        """Publish: claim the base, then make the new version the current one by its row in the run log."""
        self.require_base()
        if not self.store.claim(self.base):
            raise RunFailed("RUN_SUPERSEDED", "etl")
        try:
            self.store.record_run(**state)
        except Exception:
            self.store.release(self.base)
            raise

    def write_ledger(self, *more: DataFrame) -> DataFrame:
        rows = reduce(DataFrame.unionByName, [*self.ledgers.values(), *more])
        return self.store.write("ledger", rows.withColumn("run_id", F.lit(self.run_id)), self.run_id)

    def counted(self, name: str, counters: DataFrame) -> DataFrame:
        counters = self.stage(f"counters_{name}", counters)
        if not counters.where(~reporting.reconciles()).isEmpty():
            raise RunFailed("UNEXPECTED_ERROR", name)
        return counters

    def publish(self, started: datetime, as_of: date, threshold: int) -> dict:
        store, run_id = self.store, self.run_id
        records = self.load_catalogue()
        accepted = records.where("outcome = 'accepted'")
        self.require(accepted, "EMPTY_CATALOG", CATALOGUE)
        selected = self.load_orders()
        headers = self.stage("order_headers", orders.order_headers(selected))
        self.require(headers, "EMPTY_ORDERS", ORDERS)
        observed, totals, conflicts = self.load_stock(accepted)
        self.require_unchanged()

        self.phase = "publish"
        self.store.record_run(
            run_id=run_id, started_at=started, status="running", phase="publish",
            rules_version=RULES_VERSION, recorded_at=_now(), **self.hashes,
        )

        previous = {name: store.read(name, self.base) for name in ("products", "orders", "order_lines")}
        with_stock = accepted.join(totals.select("sku", *merge.STOCK_STATE), "sku")
        merged = self.stage("merged", merge.merge_products(previous["products"], with_stock, run_id))
        if not merge.stock_catalogue_mismatch(merged, totals).isEmpty():
            raise RunFailed("UNEXPECTED_ERROR", STOCK)
        lines = self.stage("lines", orders.order_lines(selected))
        created, created_issues = merge.create_historical_products(merged, lines, self.seen, run_id)
        created_issues = self.stage("historical_issues", created_issues)
        self.ledgers["created"] = explode_issues(created_issues, _no_excerpt())
        products = store.write(
            "products",
            merge.touch_products(merged, lines, run_id).unionByName(created), run_id,
        )
        store.write("stock_by_warehouse", merge.replace_stock(products, stock.accepted_observations(observed), run_id), run_id)
        published = store.write("orders", merge.merge_orders(previous["orders"], headers, run_id), run_id)
        published_lines = store.write(
            "order_lines",
            merge.merge_order_lines(previous["order_lines"], lines, published, products, run_id),
            run_id,
        )
        ledger = self.write_ledger()

        counters = {
            CATALOGUE: self.counted(CATALOGUE, reporting.catalog_counters(records, self.tariff_issues)),
            STOCK: self.counted(STOCK, reporting.stock_counters(observed, totals, conflicts)),
            ORDERS: self.counted(
                ORDERS, reporting.orders_counters(selected, headers, created_issues)
            ),
        }
        finished = _now()
        run = {
            "run_id": run_id,
            "finished_at": finished.strftime("%Y-%m-%dT%H:%M:%S.%fZ"),
            "rules_version": RULES_VERSION,
        }
        eligible = metrics.eligible_lines(
            published, published_lines, products, date.fromisoformat(SALES_START), as_of
        )
        store.write("low_stock", metrics.low_stock_products(eligible, products, as_of), run_id)
        summary = reporting.run_summary(
            run, counters, ledger, eligible, products, as_of, threshold, self.zone
        )
        texts = summary.select(
            F.to_json(F.struct("rows.*")).alias("counters"),
            F.to_json(F.struct(*summary.columns), {"ignoreNullFields": "false"}).alias("summary"),
        ).first()
        self.commit(
            run_id=run_id, started_at=started, finished_at=finished, status="completed",
            phase="publish", rules_version=RULES_VERSION, counters=texts["counters"],
            summary=texts["summary"], recorded_at=_now(), **self.hashes,
        )
        return {"run_id": run_id, "counters": texts["counters"], "summary": texts["summary"]}

    def fail(self, started: datetime, code: str, source: str, locator: str) -> None:
        """Keep what is known about the failed run; the previous snapshot stays current.

        If the known issues cannot be written, the failure alone is; nothing here hides the first error.
        """
        entry = self.spark.range(1).select(
            F.lit(source).alias("source"), F.lit(locator).alias("record_locator"),
            F.lit(None).cast("string").alias("entity_key"), F.lit(code).alias("reason_code"),
            F.lit("").alias("field_name"), F.lit(FAIL).alias("action"), F.lit("error").alias("severity"),
            F.lit(f"Ejecución fallida: {code}").alias("detail"),
            F.lit(None).cast("string").alias("raw_excerpt"),
        )
        try:
            try:
                self.write_ledger(entry)
            except Exception:
                log.exception("the issues of run %s cannot be written", self.run_id)
                self.ledgers.clear()
                self.write_ledger(entry)
            self.store.record_run(
                run_id=self.run_id, started_at=started, finished_at=_now(), status="failed",
                phase=self.phase, error_code=code, rules_version=RULES_VERSION, recorded_at=_now(), **self.hashes,
            )
        except Exception:
            log.exception("the failure of run %s (%s) cannot be recorded", self.run_id, code)


def _now() -> datetime:
    return datetime.now(timezone.utc)


def run_load(
    spark: SparkSession,
    sources: Sources,
    store: SnapshotStore,
    as_of: date,
    threshold: int = 0,
    zone: str = BUSINESS_ZONE,
) -> dict:
    """Load all four sources and publish them together, or publish nothing and record why."""
    load = Load(tune(spark), sources, store, zone)
    started = _now()
    store.record_run(
        run_id=load.run_id, started_at=started, status="running", phase="extract",
        rules_version=RULES_VERSION, recorded_at=started,
    )
    try:
        return load.publish(started, as_of, threshold)
    except RunFailed as failure:
        load.fail(started, failure.code, failure.source, failure.locator)
        raise
    except Exception:
        load.fail(started, "UNEXPECTED_ERROR", "etl", "/")
        raise
    finally:
        store.discard_staged()
