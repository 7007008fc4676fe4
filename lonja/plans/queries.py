"""One query per operator over the given tables.

Each takes ``(spark, folder)`` and returns a DataFrame of plain types: decimals as doubles, dates and
instants as text, so that other engines' results compare directly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.functions import dates, numbers, text
from lonja.functions.parser import Parser, parse
from lonja.operators import (
    browse,
    catalogue,
    integrity,
    merge,
    metrics,
    orders,
    pricing,
    reporting,
    stock,
    tariffs,
)
from lonja.operators.grouping import lookup
from lonja.operators.issues import (
    cells_excerpt,
    explode_issues,
    issue,
    order_excerpt,
    severity,
)
from lonja.plans import samples
from lonja.plans.samples import AS_OF, PAGE, START, table
from lonja.session import materialized, tune, work_folder
from lonja.sources import files, stock_pages, tables
from lonja.sources import tariffs as tariff_files
from lonja.sources.snapshots import SCHEMAS, SnapshotStore, latest_states
from lonja.vocabulary import (
    CATALOGUE,
    CATALOGUE_COLUMNS,
    DROP,
    ORDER_COLUMNS,
    ORDERS,
    REJECT,
    RULES_VERSION,
    STOCK,
    STOCK_FIELDS,
    TARIFFS,
    WARN,
)

QUERIES = {}
LINE_CELLS = ["line_sku", "line_quantity", "line_price", "line_discount"]


def portable(df: DataFrame) -> DataFrame:
    columns = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind.startswith("decimal"):
            column = column.cast("double")
        elif kind == "date":
            column = column.cast("string")
        elif kind.startswith("timestamp"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(name))
    return df.select(*columns)


def query(make):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return portable(make(tune(spark), folder))

    QUERIES[make.__name__] = run
    return make


# --- sources ---------------------------------------------------------------------------------------


def _landed_csv(spark, rows: DataFrame, columns, separator, encoding, purpose) -> str:
    path = work_folder(spark, purpose)
    (
        rows.select(*columns).write.option("header", True).option("sep", separator)
        .option("encoding", encoding).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def _scanned_catalogue(spark, folder) -> DataFrame:
    rows = samples.catalogue_texts(spark, folder)
    path = _landed_csv(spark, rows, CATALOGUE_COLUMNS, ";", "ISO-8859-1", "catalogue-csv")
    return tables.records_of(tables.scan_catalogue(spark, path))


def _line_count() -> Column:
    return (F.col("end_line") - F.col("start_line") + 1).alias("n_lines")


@query
def scan_catalog_csv(spark, folder):
    return _scanned_catalogue(spark, folder).select(F.array_join("cells", "|").alias("cells"), _line_count())


@query
def scan_orders_csv(spark, folder):
    rows = samples.order_texts(spark, folder)
    path = _landed_csv(spark, rows, ORDER_COLUMNS, ",", "UTF-8", "orders-csv")
    scanned = tables.records_of(tables.scan_orders(spark, path))
    return scanned.select(F.array_join("cells", "|").alias("cells"), _line_count())


def _escaped(value: Column, *more: tuple[str, str]) -> Column:
    for character, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), *more):
        value = F.replace(value, F.lit(character), F.lit(entity))
    return value


def _attribute(name: str, value: Column) -> Column:
    """Nothing if the value is null."""
    text = _escaped(value, ('"', "&quot;"), ("\r", "&#13;"), ("\n", "&#10;"), ("\t", "&#09;"))
    return F.coalesce(F.concat(F.lit(f' {name}="'), text, F.lit('"')), F.lit(""))


def _child(name: str, value: Column) -> Column:
    """Nothing if the value is null."""
    return F.coalesce(F.concat(F.lit(f"<{name}>"), _escaped(value), F.lit(f"</{name}>")), F.lit(""))


def _element(name: str, attributes: Column, *children: Column) -> Column:
    return F.concat(F.lit(f"<{name}"), attributes, F.lit(">"), *children, F.lit(f"</{name}>"))


def _rule_element(*children: Column) -> Column:
    attributes = F.concat(_attribute("tipo", F.col("kind")), _attribute("valor", F.col("label")))
    return _element("Descuento", attributes, _child("PorcentajeBase", F.col("base_text")), *children)


def _exception_element() -> Column:
    children = _child("PrecioNetoAcordado", F.col("price_text")), _child("AplicaDescuentoAdicional", F.col("flag_text"))
    return _element("Producto", _attribute("sku", F.col("sku")), *children)


TARIFF_SIZE = 500


def _landed_tariffs(spark, **sections: DataFrame) -> DataFrame:
    """Elements read back from landed documents; every section has ``ord, element``, and each five hundred are a document."""
    frames = [rows.select(F.lit(name).alias("section"), "ord", "element") for name, rows in sections.items()]
    rows = reduce(DataFrame.unionByName, frames).withColumn("doc", F.floor(F.col("ord") / TARIFF_SIZE))
    parts = []
    for name in tariff_files.SECTIONS:
        mine = F.collect_list(F.when(F.col("section") == name, F.struct("ord", "element")))  # a document's elements
        content = F.array_join(F.transform(F.array_sort(mine), lambda e: e["element"]), "")
        parts += [F.lit(f"<{name}>"), content, F.lit(f"</{name}>")]
    head, foot = '<?xml version="1.0" encoding="UTF-8"?><TarifasProveedor>', "</TarifasProveedor>"
    document = F.concat(F.lit(head), *parts, F.lit(foot))
    path = work_folder(spark, "tariffs-xml")
    rows.groupBy("doc").agg(document.alias("value")).write.partitionBy("doc").text(path)
    return tariff_files.read_elements(spark, path)


@query
def scan_tariff_rules(spark, folder):
    rows = samples.rule_rows(spark, folder).withColumn("element", _rule_element())
    return tariff_files.scan_rules(_landed_tariffs(spark, Descuentos=rows)).select(
        "kind", F.trim("label").alias("label"), "bases", "base_text", "nested", "volumes"
    )


@query
def scan_tariff_exceptions(spark, folder):
    rows = samples.exception_rows(spark, folder).withColumn("element", _exception_element())
    return tariff_files.scan_exceptions(_landed_tariffs(spark, Excepciones=rows)).select(
        F.coalesce("sku", F.lit("")).alias("sku"), "prices", "price_text", "flags",
        F.trim("flag_text").alias("flag_text"),
    )


@query
def tariff_structure_check(spark, folder):
    element = F.concat(F.lit('<Descuento tipo="marca" valor="'), "p_brand", F.lit('"/>'))
    groups = (
        table(spark, folder, "part")
        # A document of at most one hundred parts.
        .groupBy(F.floor(F.col("p_partkey") / 100).alias("g"))
        .agg(F.array_join(F.collect_list(element), "").alias("rules"))
    )
    kind = F.col("g") % 6
    document = F.concat(
        F.lit('<?xml version="1.0" encoding="'), F.when(kind == 4, "latin1").otherwise("UTF-8"), F.lit('"?>'),
        F.when(kind == 1, "<!DOCTYPE x>").otherwise(""), F.lit("<TarifasProveedor><Descuentos>"), "rules",
        F.when(kind == 3, "<Otro/>").otherwise(""), F.when(kind == 5, "").otherwise("</Descuentos>"),
        F.when(kind == 2, "").otherwise("<Excepciones/>"), F.lit("</TarifasProveedor>"),
    )
    path = work_folder(spark, "tariffs-xml")
    groups.select("g", document.alias("value")).write.partitionBy("g").text(path)
    problems = tariff_files.structure_problems(tariff_files.read_elements(spark, path))
    return problems.select(F.regexp_extract("path", "g=([0-9]+)/", 1).alias("path"), "problem")


def _pages(spark, folder) -> DataFrame:
    """Complete pages of fifty observations: ``page, data, total``."""
    rows = samples.stock_rows(spark, folder).where("ord % 2 = 0")
    record = F.struct("ord", F.struct(*STOCK_FIELDS).alias("r"))
    total = rows.agg(F.count("*")).scalar()
    return (
        rows.groupBy((F.floor(F.col("ord") / (2 * PAGE)) + 1).alias("page"))
        .agg(F.array_sort(F.collect_list(record)).alias("sorted"))
        .select("page", F.transform("sorted", lambda x: x["r"]).alias("data"), total.alias("total"))
    )


def _landed_pages(spark, pages: DataFrame) -> DataFrame:
    count = F.ceil(F.col("total") / PAGE).cast("bigint")
    meta = F.struct(
        "page", F.lit(PAGE).alias("per_page"), F.col("total").alias("total_records"),
        count.alias("total_pages"), ((F.col("page") < count) != F.col("wrong_next")).alias("has_next"),
    )
    path = work_folder(spark, "stock-pages")
    written = dict(pages.dtypes)["data"] == "array<string>"  # records that are JSON text already
    data = F.concat(F.lit("["), F.array_join("data", ","), F.lit("]")) if written else F.to_json("data")
    page = F.concat(F.lit('{"data":'), data, F.lit(',"meta":'), F.to_json(meta), F.lit("}"))
    pages.select(page).write.text(path)
    return stock_pages.read_pages(spark, path, multi_line=False)


@query
def scan_stock_snapshot(spark, folder):
    pages = _landed_pages(spark, _pages(spark, folder).withColumn("wrong_next", F.lit(False)))
    return stock_pages.scan_snapshot(pages).select("locator", *STOCK_FIELDS)


@query
def stock_page_completeness(spark, folder):
    page = F.col("page")
    pages = _pages(spark, folder).withColumns(
        {
            "wrong_next": page % 40 == 7,
            "data": F.when(page % 50 == 9, F.slice("data", 2, PAGE)).when(page % 60 == 11, F.slice("data", 1, 0)).otherwise(F.col("data")),
        }
    )
    return stock_pages.page_problems(_landed_pages(spark, pages), PAGE)


@query
def stock_incremental_filter(spark, folder):
    return stock_pages.changed_since(samples.stock_rows(spark, folder), "2024-01-15T00:00:00Z").select("ord")


@query
def attach_provenance(spark, folder):
    records = tables.with_provenance(_scanned_catalogue(spark, folder), CATALOGUE)
    named = parse(records, {"_sku": (text.identifier, F.get("cells", F.lit(0)))})
    return named.select(
        "source", F.col("_sku.value").alias("entity"), _line_count(),
        F.element_at(F.split("locator", ":"), -1).contains("-").alias("is_range"),
    )


@query
def source_fingerprint(spark, folder):
    """One file per five hundred documents, in the order of their ids, and the digest of all of them."""
    path = work_folder(spark, "texts")
    lines = table(spark, folder, "documents").select(
        F.floor(F.col("doc_id") / 500).alias("part"), "doc_id", F.regexp_replace("text", r"[\r\n]", " ").alias("value")
    )
    lines = lines.repartition("part").sortWithinPartitions("part", "doc_id").select("part", "value")
    lines.write.partitionBy("part").text(path)
    before = files.source_fingerprint(spark, path)
    changed = files.changed_files(before, files.source_fingerprint(spark, path)).agg(F.count("*")).scalar()
    part = F.regexp_extract("path", "part=([0-9]+)/", 1).cast("bigint")
    # File names carry a random number; in the tree, each file goes by its part.
    named = before.withColumn("path", F.lpad(part.cast("string"), 12, "0"))
    whole = files.source_digest(materialized(named, "prints"), fan_in=4).select("sha256")
    each = before.select(part.alias("part"), F.col("length").alias("n_bytes"), "sha256", changed.alias("changed"))
    return each.unionByName(whole.select(F.lit(-1).cast("bigint").alias("part"), "sha256"), allowMissingColumns=True)


@query
def empty_source_guard(spark, folder):
    candidates = materialized(_parsed_catalogue(spark, folder)).where("candidate")
    none = candidates.where(F.col("pvp") > 10**9)
    return (
        tables.empty_source(candidates, "EMPTY_CATALOG")
        .withColumn("rows_found", F.lit("all"))
        .unionByName(tables.empty_source(none, "EMPTY_CATALOG").withColumn("rows_found", F.lit("none")))
    )


# --- cleaning jobs ---------------------------------------------------------------------------------


def _cleaned(rows: DataFrame, key: str, column: str, parser: Parser) -> DataFrame:
    found = parse(rows, {"p": (parser, F.col(column))})
    return found.select(key, F.col("p.value").alias("value"), F.col("p.code").alias("code"))


def _document_digest(spark, folder, parser: Parser) -> DataFrame:
    rows = parse(table(spark, folder, "documents").hint("rebalance"), {"t": (parser, F.col("text"))})
    return rows.select("doc_id", F.md5("t").alias("digest"), F.length("t").alias("n_chars"))


@query
def clean_missing_tokens(spark, folder):
    rows = parse(samples.catalogue_texts(spark, folder), {"value": (text.present, F.col("precio_coste"))})
    return rows.select("ord", "value")


@query
def clean_text(spark, folder):
    return _document_digest(spark, folder, text.clean_text)


@query
def comparison_key(spark, folder):
    return _document_digest(spark, folder, text.comparison_key)


@query
def require_text(spark, folder):
    return _cleaned(samples.catalogue_texts(spark, folder), "ord", "nombre", text.required_text)


@query
def clean_identifier(spark, folder):
    return _cleaned(samples.catalogue_texts(spark, folder), "ord", "sku", text.identifier)


@query
def map_status(spark, folder):
    return _cleaned(samples.order_texts(spark, folder), "locator", "estado", text.status)


@query
def map_channel(spark, folder):
    return _cleaned(samples.order_texts(spark, folder), "locator", "canal", text.channel)


@query
def clean_decimal(spark, folder):
    return _cleaned(samples.catalogue_texts(spark, folder), "ord", "peso_kg", numbers.decimal)


@query
def strip_currency_columns(spark, folder):
    parser = Parser(text.present, numbers.strip_currency)
    rows = parse(
        samples.catalogue_texts(spark, folder),
        {"cost": (parser, F.col("precio_coste")), "pvp": (parser, F.col("pvp_recomendado"))},
    )
    return rows.select("ord", "cost", "pvp")


@query
def clean_money(spark, folder):
    return _cleaned(samples.order_texts(spark, folder), "locator", "precio_unitario", numbers.money)


@query
def repair_currency_suffix(spark, folder):
    rows = parse(
        samples.catalogue_texts(spark, folder),
        {"c": (numbers.catalogue_money, F.col("precio_coste")), "p": (numbers.catalogue_money, F.col("pvp_recomendado"))},
    )
    return rows.select(
        "ord", F.col("c.value").alias("cost"), F.col("c.code").alias("cost_code"), F.col("c.repaired").alias("cost_repaired"),
        F.col("p.value").alias("pvp"), F.col("p.code").alias("pvp_code"), F.col("p.repaired").alias("pvp_repaired"),
    )


@query
def clean_discount(spark, folder):
    return _cleaned(samples.order_texts(spark, folder), "locator", "descuento_linea", numbers.discount)


@query
def clean_tax(spark, folder):
    return _cleaned(samples.catalogue_texts(spark, folder), "ord", "iva", numbers.tax)


@query
def clean_weight(spark, folder):
    return _cleaned(samples.catalogue_texts(spark, folder), "ord", "peso_kg", numbers.weight)


@query
def clean_quantity(spark, folder):
    return _cleaned(samples.order_texts(spark, folder), "locator", "cantidad", numbers.quantity)


@query
def clean_stock_quantity(spark, folder):
    return _cleaned(samples.stock_rows(spark, folder), "ord", "quantity", numbers.stock_quantity)


@query
def round_money_columns(spark, folder):
    sign = F.when(F.col("l_linenumber") % 2 == 0, -1).otherwise(1).cast("decimal(1,0)")
    product = F.col("l_extendedprice").cast(numbers.MONEY) * F.col("l_discount").cast(numbers.RATIO)
    rows = table(spark, folder, "lineitem").withColumn("v", (product * sign).cast("decimal(30,10)"))
    return rows.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        *[numbers.round_half_up(F.col("v"), n).alias(f"r{n}") for n in (0, 1, 2, 3)],
    )


@query
def clean_date(spark, folder):
    return _cleaned(samples.catalogue_texts(spark, folder), "ord", "fecha_alta", dates.date)


@query
def clean_instant(spark, folder):
    return _cleaned(samples.stock_rows(spark, folder), "ord", "updated_at", dates.instant)


@query
def clean_ean(spark, folder):
    return _cleaned(samples.catalogue_texts(spark, folder), "ord", "ean", text.ean)


# --- validation and ledger -------------------------------------------------------------------------


def _parsed_catalogue(spark, folder) -> DataFrame:
    return catalogue.parse_catalogue(samples.catalogue_rows(spark, folder))


def _issue_rows(records: DataFrame, *keys: str) -> DataFrame:
    return records.select(*keys, F.explode("issues").alias("i")).select(
        *keys, F.col("i.code").alias("code"), F.coalesce("i.field", F.lit("")).alias("field"),
        F.col("i.action").alias("action"), F.col("i.severity").alias("severity"),
    )


@query
def validate_column_count(spark, folder):
    return _issue_rows(catalogue.column_counts(samples.catalogue_rows(spark, folder)), "ord", "entity")


@query
def validate_catalog_row(spark, folder):
    rows = _issue_rows(_parsed_catalogue(spark, folder), "ord", "entity")
    return rows.where((F.col("action") == REJECT) & (F.col("field") != ""))


@query
def drop_bad_optional_fields(spark, folder):
    dropped = F.size(F.filter("issues", lambda i: i["action"] == DROP))
    return _parsed_catalogue(spark, folder).where("candidate").select(
        "ord", "ean", "tax_rate", "weight_kg", "listed_on", "description", dropped.alias("n_dropped")
    )


def _header_rows(spark, folder, *more: str) -> DataFrame:
    """All rows with the header of their order, without raw cells, and with those parsed line cells that are named."""
    parsed = orders.parse_order_rows(samples.order_rows(spark, folder))
    unread = ["cells", "line_key", *[name for name in LINE_CELLS if name not in more]]
    return orders.resolve_headers(materialized(parsed.drop(*unread), "stage", "zstd"))


def _line_rows(spark, folder) -> DataFrame:
    return orders.validate_lines(_header_rows(spark, folder, *LINE_CELLS))


def _selected_orders(spark, folder) -> DataFrame:
    """All rows of the source without their raw cells, which only the ledger's excerpts need."""
    return orders.select_orders(
        samples.order_rows(spark, folder), keep=lambda rows: materialized(rows.drop("cells", "line_key"), "stage", "zstd"))


def _settled_orders(spark, folder) -> DataFrame:
    """The same, written once for several readers, without the signatures: the line values give them again."""
    rows = materialized(_selected_orders(spark, folder).drop("line_key"), "stage", "zstd")
    key = orders.line_signature(
        F.col("entity"), F.col("sku"), F.col("quantity"), F.col("unit_price"), F.col("discount")
    )
    return rows.withColumn("line_key", F.when(F.col("line_ok"), key))


def _with_cells(spark, folder, rows: DataFrame) -> DataFrame:
    """Rows with issues and the raw cells at their place in the source, which is read again by those who want them.

    The cells would be half of what the rows weigh on their way to their order. Each place counts once.
    """
    cells = samples.order_rows(spark, folder).groupBy("ord", "locator").agg(F.min("cells").alias("cells"))
    return lookup(rows.where(F.size("issues") > 0), cells, ["ord", "locator"])


@query
def validate_order_line(spark, folder):
    fields = ["sku", "cantidad", "precio_unitario", "descuento_linea"]
    return _issue_rows(_line_rows(spark, folder), "locator").where(F.col("field").isin(fields))


def _stock_catalogue(spark, folder) -> DataFrame:
    return table(spark, folder, "part").where("p_partkey % 20 <> 0").select(
        F.concat(F.lit("PRV-"), "p_partkey").alias("sku")
    )


def _checked_stock(spark, folder) -> DataFrame:
    return stock.validate_observations(samples.stock_rows(spark, folder), _stock_catalogue(spark, folder))


def _reconciled_stock(spark, folder) -> DataFrame:
    return stock.reconcile_versions(materialized(_checked_stock(spark, folder)))


@query
def validate_stock_row(spark, folder):
    rows = _checked_stock(spark, folder)
    return _issue_rows(rows, "locator", "entity", "invalidates").where(F.col("action") == REJECT)


@query
def warn_reserved_exceeds_quantity(spark, folder):
    rows = _checked_stock(spark, folder)
    return _issue_rows(rows, "locator", "quantity", "reserved").where(F.col("action") == WARN)


def _selected_catalogue(spark, folder) -> DataFrame:
    judge = pricing.price_judge(
        samples.price_exceptions(spark, folder), samples.category_rules(spark, folder), samples.brand_rules(spark, folder)
    )
    return catalogue.select_first_valid(_parsed_catalogue(spark, folder), judge, materialized)


def _records(spark, folder) -> dict[str, DataFrame]:
    """The settled rows of the three record sources, each computed once."""
    return {
        CATALOGUE: materialized(_selected_catalogue(spark, folder)),
        ORDERS: _settled_orders(spark, folder),
        STOCK: materialized(_reconciled_stock(spark, folder)),
    }


def _terms(spark, folder) -> DataFrame:
    conditions = table(spark, folder, "customer").select(
        F.concat(F.lit("/TarifasProveedor/Condiciones/*["), F.col("c_custkey") + 1, F.lit("]")).alias("locator"),
        F.lit(None).cast("string").alias("entity"), F.lit(None).cast("string").alias("excerpt"),
    )
    rules = _valid_rules(spark, folder).withColumn("volume_excerpts", F.array().cast("array<string>"))
    return tariffs.unapplied_terms(conditions, tariff_files.volume_terms(rules))


def _tariff_issues(spark, folder) -> DataFrame:
    """Repeated rules and exceptions, unusable agreed prices, terms never applied, exceptions without a product."""
    plain = ["source", "locator", "entity", "issues"]
    exceptions = _kept_exceptions(spark, folder)
    frames = [
        tariffs.deduplicate_rules(_valid_rules(spark, folder)), exceptions, _terms(spark, folder),
        tariffs.orphan_exceptions(exceptions, _parsed_catalogue(spark, folder)),
    ]
    return reduce(DataFrame.unionByName, [frame.select(plain) for frame in frames])


def _created_issues(spark, folder, selected: DataFrame) -> DataFrame:
    seen = table(spark, folder, "part").select(F.concat(F.lit("PRV-"), "p_partkey").alias("sku"))
    lines = orders.order_lines(selected)
    return merge.create_historical_products(_previous_products(spark, folder), lines, seen, "run-2")[1]


def _ledger(spark, folder, records: dict[str, DataFrame] | None = None, excerpts: bool = False) -> DataFrame:
    """Issues of all sources: of their rows, of tariff elements, and those that belong to no row.

    Order rows get their raw cells with ``excerpts`` only; readers that count issues need none.
    """
    if records is None:
        records = {
            CATALOGUE: _selected_catalogue(spark, folder),
            ORDERS: _settled_orders(spark, folder),
            STOCK: materialized(_reconciled_stock(spark, folder)),
        }
    reconciled = records[STOCK]
    totals = stock.stock_totals(reconciled, _stock_catalogue(spark, folder))
    nothing = F.lit(None).cast("string")
    lines = explode_issues(records[ORDERS], nothing)
    if excerpts:
        lines = explode_issues(_with_cells(spark, folder, records[ORDERS]), order_excerpt(F.col("cells")))
    return reduce(
        DataFrame.unionByName,
        [
            explode_issues(records[CATALOGUE], cells_excerpt(F.col("cells"))),
            lines,
            explode_issues(reconciled, stock.ledger_excerpt(reconciled)),
            explode_issues(totals, nothing),
            explode_issues(stock.conflict_warnings(reconciled), nothing),
            explode_issues(_tariff_issues(spark, folder), nothing),
            explode_issues(_created_issues(spark, folder, records[ORDERS]), nothing),
        ],
    )


@query
def issue_ledger(spark, folder):
    return _ledger(spark, folder, excerpts=True).select(
        "source", "record_locator", "entity_key", "reason_code", "field_name", "action", "severity"
    )


@query
def severity_assignment(spark, folder):
    found = severity(F.col("source"), F.col("action"), F.col("reason_code"))
    ledger = _ledger(spark, folder).select("source", "action", "reason_code", found.alias("severity"))
    return ledger.groupBy("source", "action", "reason_code", "severity").agg(F.count("*").alias("n"))


@query
def bounded_excerpt(spark, folder):
    rows = samples.catalogue_rows(spark, folder).select(
        F.lit(CATALOGUE).alias("source"), "locator", cells_excerpt(F.col("cells")).alias("excerpt")
    )
    # Numbers, truth values, lists and records that are no objects, as the pages have them.
    def odd(text, i):
        return (
            F.when(i % 11 == 1, F.regexp_replace(text, r'"quantity":"([0-9]+)"', '"quantity":$1.0'))
            .when(i % 11 == 2, F.regexp_replace(text, r'"reserved":"[^"]*"', '"reserved":true'))
            .when(i % 11 == 3, F.regexp_replace(text, r'"warehouse":"[^"]*"', '"warehouse":[1]'))
            .when(i % 11 == 4, F.lit("[7]"))
            .when(i % 11 == 5, F.regexp_replace(text, r'"quantity":"([0-9]+)"', '"quantity":$1e3'))
            .otherwise(text)
        )

    records = _pages(spark, folder).withColumn("wrong_next", F.lit(False))
    texts = F.transform(F.transform("data", lambda r: F.to_json(r)), odd)
    observed = stock_pages.scan_snapshot(_landed_pages(spark, records.withColumn("data", texts))).select(
        F.lit(STOCK).alias("source"), "locator", "excerpt"
    )
    lines = samples.order_rows(spark, folder).select(
        F.lit(ORDERS).alias("source"), "locator", order_excerpt(F.col("cells")).alias("excerpt")
    )
    return reduce(DataFrame.unionByName, [rows, lines, observed, _tariff_excerpts(spark, folder)]).withColumn(
        "n_chars", F.length("excerpt"))


def _tariff_excerpts(spark, folder) -> DataFrame:
    """Rules (some with many volume terms), their volume terms, exceptions and conditions."""
    volume = F.transform(F.sequence(F.lit(1), F.pmod("ord", F.lit(15)) + 1), lambda i: _element(
        "PorVolumen", _attribute("desdeUnidades", (i * 10).cast("string")), F.concat(i.cast("string"), F.lit("&amp;"))))
    rules = samples.rule_rows(spark, folder).withColumn("label", F.concat("label", F.lit(' <&"ñ')))
    rules = rules.withColumn("element", _rule_element(F.array_join(volume, "")))
    exceptions = samples.exception_rows(spark, folder).withColumn("element", _exception_element())
    conditions = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("ord"), _element("Plazo", _attribute("cliente", F.col("c_name")), F.lit("60 días")).alias("element"))
    elements = _landed_tariffs(spark, Condiciones=conditions, Descuentos=rules, Excepciones=exceptions)
    found = tariff_files.scan_rules(elements).withColumn("entity", F.lit(None).cast("string"))
    frames = [found, tariff_files.volume_terms(found), tariff_files.scan_exceptions(elements), tariff_files.scan_conditions(elements)]
    return reduce(DataFrame.unionByName, [frame.select(F.lit(TARIFFS).alias("source"), "locator", "excerpt") for frame in frames])


# --- tariffs ---------------------------------------------------------------------------------------


def _valid_rules(spark, folder) -> DataFrame:
    return tariffs.validate_rules(samples.rule_rows(spark, folder))


def _kept_exceptions(spark, folder) -> DataFrame:
    return tariffs.deduplicate_exceptions(tariffs.validate_exceptions(samples.exception_rows(spark, folder)))


def _first_code() -> Column:
    return F.get("issues", F.lit(0))["code"].alias("issue")


@query
def tariff_rule_validate(spark, folder):
    return _valid_rules(spark, folder).select("ord", "kind", "key", "ratio", "problem")


@query
def tariff_rule_dedup(spark, folder):
    return tariffs.deduplicate_rules(_valid_rules(spark, folder)).select("ord", "kept", "problem", _first_code())


@query
def tariff_exception_validate(spark, folder):
    rows = tariffs.validate_exceptions(samples.exception_rows(spark, folder))
    return rows.select("ord", "sku", "agreed_price", "blocked", "problem")


@query
def tariff_exception_dedup(spark, folder):
    return _kept_exceptions(spark, folder).select("ord", "kept", "problem", _first_code())


@query
def unapplied_terms(spark, folder):
    return _issue_rows(_terms(spark, folder), "locator", "entity")


@query
def orphan_exceptions(spark, folder):
    rows = tariffs.orphan_exceptions(_kept_exceptions(spark, folder), _parsed_catalogue(spark, folder))
    return _issue_rows(rows, "locator", "entity")


# --- pricing and candidate selection ---------------------------------------------------------------


def _candidates(spark, folder) -> DataFrame:
    return _parsed_catalogue(spark, folder).where("candidate")


@query
def price_by_exception(spark, folder):
    rows = pricing.price_by_exception(_candidates(spark, folder), samples.price_exceptions(spark, folder))
    return rows.select("ord", "has_exception", "agreed_price")


@query
def price_by_discounts(spark, folder):
    rows = pricing.price_by_discounts(
        _candidates(spark, folder), samples.category_rules(spark, folder), samples.brand_rules(spark, folder)
    )
    return rows.select("ord", "category_discount", "brand_discount", "discounted_cost", "discount_problem")


@query
def cost_exceeds_pvp(spark, folder):
    judge = pricing.price_judge(
        samples.price_exceptions(spark, folder), samples.category_rules(spark, folder), samples.brand_rules(spark, folder)
    )
    rows = judge(_candidates(spark, folder)).where("verdict.code = 'COST_EXCEEDS_PVP'")
    return rows.select("ord", "net_cost", "pvp", "price_origin")


@query
def rescued_cost_audit(spark, folder):
    rows = _issue_rows(_selected_catalogue(spark, folder), "ord", "entity")
    return rows.where((F.col("action") == DROP) & (F.col("field") == "precio_coste"))


@query
def select_first_valid_candidate(spark, folder):
    net_cost = F.when(F.col("candidate"), F.col("net_cost")).alias("net_cost")
    return _selected_catalogue(spark, folder).select("ord", "outcome", net_cost, F.size("issues").alias("n_issues"))


@query
def pluggable_row_verdict(spark, folder):
    def no_red(records: DataFrame) -> DataFrame:
        red = F.col("candidate") & F.contains("name", F.lit("red"))
        entry = issue(CATALOGUE, "COST_EXCEEDS_PVP", REJECT)
        return records.withColumn("verdict", F.when(red, entry))

    rows = catalogue.select_first_valid(_parsed_catalogue(spark, folder), no_red, materialized)
    return rows.select("ord", "outcome")


# --- orders ----------------------------------------------------------------------------------------


@query
def group_orders(spark, folder):
    rows = orders.parse_order_rows(samples.order_rows(spark, folder))
    return rows.where("grouped").groupBy(F.col("entity").alias("order_id")).agg(F.count("*").alias("n_rows"))


@query
def resolve_order_header(spark, folder):
    """Header rejections, each error on each row, beside the settled headers."""
    rows = _header_rows(spark, folder)
    errors = F.array_join(
        F.transform(
            F.filter("issues", lambda i: (i["action"] == REJECT) & i["field"].isin("fecha_pedido", "cliente", "canal", "estado")),
            lambda i: F.concat_ws(":", i["code"], i["field"]),
        ),
        " ",
    )
    return rows.where("grouped").select("locator", "header_ok", "order_date", "channel", "status", errors.alias("errors"))


@query
def inherit_header_values(spark, folder):
    rows = _issue_rows(_header_rows(spark, folder), "locator")
    return rows.where("code = 'HEADER_VALUE_INHERITED'")


@query
def customer_first_spelling(spark, folder):
    rows = _header_rows(spark, folder).where("header_ok")
    return rows.groupBy(F.col("entity").alias("order_id")).agg(F.max("customer").alias("customer"))


@query
def line_signature(spark, folder):
    rows = _line_rows(spark, folder).where("line_ok")
    key = orders.line_signature(
        F.col("entity"), F.col("sku"), F.col("quantity"), F.col("unit_price"), F.col("discount")
    )
    return rows.select("locator", key.alias("line_key"))


@query
def dedup_order_lines(spark, folder):
    detail = F.filter("issues", lambda i: i["code"] == "DUPLICATE_ORDER_LINE")
    return _selected_orders(spark, folder).select(
        "locator", "outcome", F.get(detail, F.lit(0))["detail"].alias("detail")
    )


@query
def partial_order_flag(spark, folder):
    return orders.order_headers(_selected_orders(spark, folder))


# --- stock -----------------------------------------------------------------------------------------


@query
def stock_exact_dedup(spark, folder):
    return _issue_rows(_reconciled_stock(spark, folder), "locator").where("code = 'EXACT_DUPLICATE'")


@query
def stock_conflicts(spark, folder):
    rows = materialized(_reconciled_stock(spark, folder))
    found = rows.unionByName(stock.conflict_warnings(rows), allowMissingColumns=True)
    return _issue_rows(found, "locator", "entity").where("code = 'CONFLICTING_STOCK'")


@query
def stock_latest_version(spark, folder):
    return _reconciled_stock(spark, folder).select("locator", "outcome")


@query
def stock_totals(spark, folder):
    rows = _checked_stock(spark, folder)
    return stock.stock_totals(rows, _stock_catalogue(spark, folder)).select(
        "sku", "stock_total", "stock_status", "stock_as_of"
    )


@query
def stock_overflow(spark, folder):
    """The observations with quantities near the 64-bit limit, so that sums leave it."""
    huge = F.when(F.col("ord") % 4 == 0, str(2**62)).otherwise(str(2**63 - 1))
    rows = samples.stock_rows(spark, folder).withColumn("quantity", huge)
    catalogue_ = _stock_catalogue(spark, folder)
    reconciled = stock.reconcile_versions(materialized(stock.validate_observations(rows, catalogue_)))
    totals = stock.stock_totals(reconciled, catalogue_)
    overflow = F.exists("issues", lambda i: i["code"] == "NUMERIC_OUT_OF_RANGE")
    return totals.select("sku", "stock_total", "stock_status", overflow.alias("overflow"))


# --- merges and publishing -------------------------------------------------------------------------


def _typed(rows: DataFrame, schema: str, **columns: Column) -> DataFrame:
    """Rows with the schema of a published table; columns not given are NULL."""
    selected = []
    for field in SCHEMAS[schema].split(", "):
        column, kind = field.split(" ")
        selected.append(columns.get(column, F.lit(None)).cast(kind).alias(column))
    return rows.select(*selected)


def _previous_products(spark, folder) -> DataFrame:
    i = F.col("p_partkey")
    rows = table(spark, folder, "part").where(i % 7 != 0)
    current = i % 3 != 0
    return _typed(
        rows, "products", id=i * 3 + 1000, sku=F.concat(F.lit("PRV-"), i),
        name=F.when(current, F.concat(F.lit("old "), "p_name")), net_cost=F.when(current, F.lit(1)),
        is_historical=~current, in_catalog=current, stock_status=F.when(current, "known").otherwise("unknown"),
        stock_total=F.when(current, i), last_run_id=F.lit("run-1"),
    )


def _accepted_products(spark, folder) -> DataFrame:
    i = F.col("p_partkey")
    rows = table(spark, folder, "part").where((i % 4 != 0) | (i % 28 == 0))
    return _typed(
        rows, "products", sku=F.concat(F.lit("PRV-"), i), name=F.col("p_name"), net_cost=F.col("p_retailprice"),
        stock_status=F.lit("unknown"),
    ).drop("id", "is_historical", "in_catalog", "last_run_id")


def _merged_products(spark, folder) -> DataFrame:
    return merge.merge_products(_previous_products(spark, folder), _accepted_products(spark, folder), "run-2")


PRODUCT_STATE = ["id", "sku", "name", "net_cost", "is_historical", "in_catalog", "stock_total", "stock_status", "last_run_id"]


@query
def merge_products(spark, folder):
    return _merged_products(spark, folder).select(*PRODUCT_STATE)


@query
def retire_absent_products(spark, folder):
    rows = merge.retire_absent_products(
        _previous_products(spark, folder), _accepted_products(spark, folder), "run-2"
    )
    return rows.select(*PRODUCT_STATE)


def _sold_lines(spark, folder) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("PRV-"), "l_partkey").alias("sku"),
        F.concat(F.lit("PED-"), "l_orderkey").alias("source_order_id"),
        (F.col("l_linenumber") * F.lit(10**12) + F.col("l_suppkey")).alias("ord"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey").alias("source_locator"),
    )


@query
def create_historical_products(spark, folder):
    known = _previous_products(spark, folder)
    seen = table(spark, folder, "part").where("p_partkey % 14 = 0").select(F.concat(F.lit("PRV-"), "p_partkey").alias("sku"))
    rows, issues = merge.create_historical_products(known, _sold_lines(spark, folder), seen, "run-2")
    details = issues.select(F.col("entity").alias("sku"), F.get("issues", F.lit(0))["detail"].alias("detail"), "locator")
    return rows.select("id", "sku", "is_historical", "in_catalog", "last_run_id").join(details, "sku")


@query
def replace_stock_by_warehouse(spark, folder):
    products = samples.products(spark, folder)
    observed = stock.accepted_observations(_reconciled_stock(spark, folder))
    return merge.replace_stock(products, observed, "run-2")


def _order_headers(spark, folder) -> DataFrame:
    return samples.orders(spark, folder).where("id % 10 <> 1 or id % 9 = 0").drop("id")


def _previous_orders(spark, folder) -> DataFrame:
    rows = samples.orders(spark, folder).where("id % 9 <> 0")
    return rows.select((F.col("id") * 2 + 5000).alias("id"), "source_order_id")


def _merged_orders(spark, folder) -> DataFrame:
    return merge.merge_orders(_previous_orders(spark, folder), _order_headers(spark, folder), "run-2")


@query
def merge_orders(spark, folder):
    return _merged_orders(spark, folder).select(
        "id", "source_order_id", "order_date", "channel", "status", "has_rejected_lines", "last_run_id"
    )


@query
def merge_order_lines(spark, folder):
    parts = [f"l_{n}" for n in ("orderkey", "partkey", "suppkey", "linenumber")]
    rows = table(spark, folder, "lineitem").withColumn("line_key", F.md5(F.concat_ws("-", *parts)))
    known = samples.orders(spark, folder)
    products = samples.products(spark, folder)
    lines = rows.select(
        F.concat(F.lit("PED-"), "l_orderkey").alias("source_order_id"), F.concat(F.lit("PRV-"), "l_partkey").alias("sku"),
        "line_key", F.col("l_quantity").cast("bigint").alias("quantity"), F.lit(1).cast(numbers.MONEY).alias("unit_price"),
        F.col("l_discount").cast(numbers.RATIO).alias("discount"), F.lit("new").alias("source_locator"),
    ).where(F.substring("line_key", 1, 1) != "0")
    previous = rows.where(F.substring("line_key", 2, 1) != "0").select(
        (F.col("l_partkey") * 1_000_000_000 + F.col("l_orderkey") * 1000 + F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"), "line_key",
    )
    merged = merge.merge_order_lines(previous, lines, known, products, "run-2")
    return merged.select("id", "order_id", "product_id", "line_key", "quantity", "discount", "source_locator")


def _published_orders(spark, folder, run_id: str) -> DataFrame:
    return samples.orders(spark, folder).withColumn("last_run_id", F.lit(run_id))


@query
def publish_snapshot(spark, folder):
    """Two versions written, only the first one committed: readers must see the first."""
    store = SnapshotStore(spark, work_folder(spark, "store"))
    stamp = F.lit("2024-01-01 00:00:00").cast("timestamp")
    first, second = "run-1", "run-2"
    store.write("orders", _published_orders(spark, folder, first), first)
    late = _published_orders(spark, folder, second).withColumn("status", F.lit("CANCELADO"))
    when = spark.range(1).select(stamp.alias("t")).first()["t"]
    store.record_run(run_id=first, started_at=when, finished_at=when, status="completed", phase="publish", rules_version=RULES_VERSION, recorded_at=when)
    store.write("orders", late, second)
    store.record_run(run_id=second, started_at=when, finished_at=when, status="failed", phase="publish", rules_version=RULES_VERSION, recorded_at=when)
    columns = ["id", "source_order_id", "order_date", "channel", "status", "has_rejected_lines"]
    return merge.fingerprint(store.read("orders"), columns).withColumn("current_run", F.lit(store.current_run()))


def _run_events(spark, folder) -> DataFrame:
    """Run states from the events: five states of many runs."""
    kind = F.col("event_type")
    status = F.when(kind.isin("click", "purchase"), "completed").when(kind == "error", "failed").otherwise("running")
    return table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("run_id"), status.alias("status"), F.col("ts").alias("finished_at"),
        F.date_trunc("day", "ts").alias("started_at"), F.col("event_id").alias("counters"), F.col("ts").alias("recorded_at"),
    )


@query
def run_log(spark, folder):
    return latest_states(_run_events(spark, folder)).select("run_id", "status", "counters")


@query
def idempotence_fingerprint(spark, folder):
    rows = samples.products(spark, folder)
    columns = ["id", "sku", "name", "category_key", "net_cost", "stock_status", "stock_total"]
    first = merge.fingerprint(rows, columns).withColumn("load", F.lit(1))
    again = merge.fingerprint(rows.repartition(13, "brand"), columns).withColumn("load", F.lit(2))
    return first.unionByName(again)


# --- sales analytics -------------------------------------------------------------------------------


def _eligible(spark, folder) -> DataFrame:
    return metrics.eligible_lines(
        samples.orders(spark, folder), samples.order_lines(spark, folder), samples.products(spark, folder), START, AS_OF
    )


@query
def eligible_lines(spark, folder):
    return _eligible(spark, folder).select(
        "order_id", "order_date", "channel", "has_rejected_lines", "sku", "category_key", "quantity", "net_cost", "amount"
    )


@query
def sales_summary(spark, folder):
    return metrics.sales_summary(_eligible(spark, folder))


@query
def previous_month_sales(spark, folder):
    return metrics.previous_month_sales(_eligible(spark, folder), AS_OF)


@query
def monthly_sales(spark, folder):
    return metrics.monthly_sales(_eligible(spark, folder), START, AS_OF)


@query
def monthly_year_on_year(spark, folder):
    return metrics.year_on_year(metrics.monthly_sales(_eligible(spark, folder), START, AS_OF))


@query
def sales_by_channel(spark, folder):
    return metrics.sales_by_channel(_eligible(spark, folder))


@query
def sales_by_category(spark, folder):
    return metrics.sales_by_category(_eligible(spark, folder))


@query
def top_products(spark, folder):
    return metrics.top_products(_eligible(spark, folder))


@query
def margin_summary(spark, folder):
    return metrics.margin_summary(_eligible(spark, folder))


@query
def low_stock_products(spark, folder):
    return metrics.low_stock_products(_eligible(spark, folder), samples.products(spark, folder), AS_OF)


@query
def trailing_months_filter(spark, folder):
    rows = metrics.trailing_months(samples.orders(spark, folder), AS_OF, 4)
    return rows.groupBy("order_date").agg(F.count("*").alias("n"))


@query
def sku_contribution_review(spark, folder):
    return metrics.sku_contribution(_eligible(spark, folder), samples.products(spark, folder))


@query
def independent_recalculation(spark, folder):
    # Five metrics and the rebuilt totals read the same lines.
    lines = materialized(_eligible(spark, folder))
    return metrics.independent_recalculation(lines, START, AS_OF)


# --- browsing and reporting ------------------------------------------------------------------------


@query
def catalog_search(spark, folder):
    return browse.catalog_search(samples.products(spark, folder), " WIDGET Nandu ").select("sku", "name")


@query
def catalog_category_filter(spark, folder):
    rows = samples.products(spark, folder)
    found = browse.catalog_category(rows, " PROMO ").select("sku", F.lit("promo").alias("asked"))
    return found.unionByName(browse.catalog_category(rows, "-").select("sku", F.lit("-").alias("asked")))


@query
def catalog_page(spark, folder):
    shown, total, page, pages = browse.catalog_page(samples.products(spark, folder), "ring", "large", 3)
    return shown.withColumns({"total": F.lit(total), "page": F.lit(page), "pages": F.lit(pages)})


@query
def catalog_categories(spark, folder):
    return browse.catalog_categories(samples.products(spark, folder))


@query
def latest_publication(spark, folder):
    return browse.latest_publication(_run_events(spark, folder)).select("run_id", "finished_at", "counters")


@query
def conflicting_skus(spark, folder):
    ledger = explode_issues(_selected_catalogue(spark, folder), F.lit(None).cast("string"))
    return browse.conflicting_skus(ledger, samples.products(spark, folder))


def _catalog_counters(spark, folder, selected: DataFrame) -> DataFrame:
    return reporting.catalog_counters(selected, _kept_exceptions(spark, folder))


def _order_counters(spark, folder, selected: DataFrame) -> DataFrame:
    created = _created_issues(spark, folder, selected)
    return reporting.orders_counters(selected, orders.order_headers(selected), created)


def _stock_counters(spark, folder, rows: DataFrame) -> DataFrame:
    totals = stock.stock_totals(rows, _stock_catalogue(spark, folder))
    return reporting.stock_counters(rows, totals, stock.conflict_warnings(rows))


@query
def catalog_counters(spark, folder):
    return _catalog_counters(spark, folder, _selected_catalogue(spark, folder))


@query
def orders_counters(spark, folder):
    return _order_counters(spark, folder, _settled_orders(spark, folder))


@query
def stock_counters(spark, folder):
    return _stock_counters(spark, folder, materialized(_reconciled_stock(spark, folder)))


@query
def reconcile_counters(spark, folder):
    sources = {CATALOGUE: _selected_catalogue, ORDERS: _selected_orders, STOCK: _reconciled_stock}
    frames = [
        reporting.record_counters(make(spark, folder)).select(
            F.lit(name).alias("source"), "rows_read", reporting.reconciles().alias("reconciles")
        )
        for name, make in sources.items()
    ]
    return reduce(DataFrame.unionByName, frames)


@query
def rejections_by_reason(spark, folder):
    return reporting.rejections_by_reason(_ledger(spark, folder))


@query
def missing_order_reasons(spark, folder):
    needed = ["entity", "order_date", "customer", "channel", "status", "outcome", "issues"]
    selected = materialized(_selected_orders(spark, folder).select(needed), "stage", "zstd")
    rows = reporting.missing_order_reasons(selected, orders.order_headers(selected))
    return rows.withColumn("reasons", F.array_join("reasons", " "))


@query
def run_summary(spark, folder):
    # Reasons and counters come from the same rows; metrics from one set of lines.
    records = _records(spark, folder)
    ledger = _ledger(spark, folder, records)
    lines = materialized(_eligible(spark, folder))
    products = samples.products(spark, folder)
    counters = {
        CATALOGUE: _catalog_counters(spark, folder, records[CATALOGUE]),
        STOCK: _stock_counters(spark, folder, records[STOCK]),
        ORDERS: _order_counters(spark, folder, records[ORDERS]),
    }
    run = {"run_id": "run-2", "finished_at": "2024-01-01T00:00:00.000000Z", "rules_version": RULES_VERSION}
    row = reporting.run_summary(run, counters, ledger, lines, products, AS_OF, 100)
    return row.select(
        "schema_version", "run_id", "as_of", "products_loaded", "rows_rejected", "revenue_previous_month", "previous_month",
        "low_stock_count", "rejection_threshold", "alert_required", F.size("rejected_by_reason").alias("n_reasons"),
        F.col("rows.orders_csv.orders_loaded").alias("orders_loaded"),
    )


@query
def alert_required(spark, folder):
    """The decision per event day: errors count as rejected rows, purchases as low stock."""
    kind = F.col("event_type")
    days = table(spark, folder, "events").groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.when(kind == "error", 1)).alias("rejected"), F.count(F.when((kind == "purchase") & (F.col("value") > 300), 1)).alias("low_stock")
    )
    return days.withColumn("alert", reporting.alert_required(F.col("rejected"), F.col("low_stock"), 66))


@query
def run_history_append(spark, folder):
    rows = table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("run_id"), (F.col("value") > 40).alias("alert_required"),
        F.when(F.col("event_id") % 2 == 0, F.col("ts")).alias("email_sent_at"), "event_id",
    )
    history = rows.where("event_id % 3 = 0").drop("event_id")
    added = reporting.append_history(history, rows.drop("event_id"))
    return reporting.pending_mails(history.unionByName(added)).select("run_id").withColumn(
        "appended", F.col("run_id").cast("bigint") % 3 != 0
    )


@query
def chart_series(spark, folder):
    return reporting.chart_series(metrics.monthly_sales(_eligible(spark, folder), START, AS_OF))


# --- integrity -------------------------------------------------------------------------------------


def _stamped(rows: DataFrame, key: str) -> DataFrame:
    """Rows with the run they come from; every 503rd row names a run that does not exist."""
    return rows.withColumn("last_run_id", F.when(F.col(key) % 503 == 7, "run-x").otherwise("run-1"))


def _checked_lines(spark, folder) -> DataFrame:
    """Lines with faults: unknown orders and products, zero and negative quantities, repeated keys."""
    rows = table(spark, folder, "lineitem")
    k, part = F.col("l_orderkey"), F.col("l_partkey")
    quantity = F.col("l_quantity").cast("bigint")
    return _stamped(
        rows.select(
            F.when(part % 97 == 5, -k - 1).otherwise(k).alias("order_id"),
            F.when(k % 89 == 3, -part - 1).otherwise(part).alias("product_id"),
            F.concat_ws("-", F.col("l_linenumber"), F.col("l_suppkey") % 50).alias("line_key"),
            F.when(part % 101 == 1, 0).when(part % 103 == 1, -quantity).otherwise(quantity).alias("quantity"),
            F.when(part % 107 == 1, 0).otherwise(1).cast(numbers.MONEY).alias("unit_price"),
            F.when(part % 109 == 1, 2).otherwise(0).cast(numbers.RATIO).alias("discount"),
        ),
        "product_id",
    )


def _checked_products(spark, folder) -> DataFrame:
    rows = samples.products(spark, folder)
    i = F.col("id")
    return _stamped(
        rows.withColumns(
            {
                "sku": F.when(i % 211 == 3, "PRV-1").otherwise(F.col("sku")),
                "base_cost": F.when(i % 223 == 3, -1).otherwise(F.col("base_cost")).cast(numbers.MONEY),
                "tax_rate": F.when(i % 227 == 3, 2).otherwise(0).cast(numbers.RATIO),
                "category_discount": F.lit(0).cast(numbers.RATIO),
                "brand_discount": F.when(i % 229 == 3, -1).cast(numbers.RATIO),
                "weight_kg": F.when(i % 233 == 3, -1).cast(numbers.MONEY),
                "name": F.when(i % 239 != 3, F.col("name")),
                "stock_total": F.when(i % 241 == 3, 7).otherwise(F.col("stock_total")),
            }
        ),
        "id",
    )


def _checked_orders(spark, folder) -> DataFrame:
    rows = samples.orders(spark, folder)
    i = F.col("id")
    return _stamped(
        rows.withColumns(
            {
                "source_order_id": F.when(i % 251 == 3, "PED-1").otherwise(F.col("source_order_id")),
                "channel": F.when(i % 257 == 3, "web").otherwise(F.col("channel")),
                "status": F.when(i % 263 == 3, "RARO").when(i % 5 == 4, "DEVUELTO").otherwise(F.col("status")),
            }
        ),
        "id",
    )


def _checked_stock_rows(spark, folder) -> DataFrame:
    rows = table(spark, folder, "events").select(
        F.col("user_id").alias("product_id"), F.concat_ws("-", F.col("event_type"), F.col("event_id") % 8).alias("warehouse_code"),
        (F.col("event_id") % 3).alias("quantity"), "event_id",
    )
    return _stamped(rows, "event_id").drop("event_id")


def _checked_ledger(spark, folder) -> DataFrame:
    e = F.col("event_id")
    return table(spark, folder, "events").select(
        F.lit("run-1").alias("run_id"), F.lit(STOCK).alias("source"),
        F.floor(e / F.when(e % 100 < 2, 2).otherwise(1)).cast("string").alias("record_locator"),
        F.lit("INVALID_STOCK").alias("reason_code"), F.lit("").alias("field_name"),
        F.when(e % 269 == 3, "raro").otherwise("warn").alias("action"), F.when(e % 271 == 3, "alta").otherwise("warning").alias("severity"),
    )


def _runs(spark) -> DataFrame:
    return spark.range(1).select(F.lit("run-1").alias("run_id"))


@query
def fk_check(spark, folder):
    return integrity.foreign_keys(
        _checked_products(spark, folder), _checked_orders(spark, folder), _checked_lines(spark, folder),
        _checked_stock_rows(spark, folder), _runs(spark),
    )


@query
def unique_check(spark, folder):
    return integrity.unique_keys(
        _checked_products(spark, folder), _checked_orders(spark, folder), _checked_lines(spark, folder),
        _checked_stock_rows(spark, folder), _checked_ledger(spark, folder),
    )


@query
def domain_check(spark, folder):
    return integrity.domains(
        _checked_products(spark, folder), _checked_orders(spark, folder), _checked_lines(spark, folder),
        _checked_ledger(spark, folder),
    )


@query
def state_check(spark, folder):
    return integrity.states(_checked_products(spark, folder))


@query
def stock_total_check(spark, folder):
    return integrity.stock_totals(samples.products(spark, folder), _checked_stock_rows(spark, folder))


@query
def ledger_counter_check(spark, folder):
    """Counters of the order source against its ledger and tables."""
    selected = _settled_orders(spark, folder)
    headers, lines = orders.order_headers(selected), orders.order_lines(selected)
    ledger = explode_issues(selected, F.lit(None).cast("string"))
    counted = reporting.record_counters(selected).withColumns(
        {
            "orders_loaded": headers.agg(F.count("*")).scalar(),
            "partial_orders": headers.agg(F.count(F.when(F.col("has_rejected_lines"), 1))).scalar(),
        }
    )
    pairs = [F.struct(F.lit(n).alias("counter"), F.col(n).alias("value")) for n in counted.columns]
    counters = counted.select(F.lit(ORDERS).alias("source"), F.explode(F.array(*pairs)).alias("x")).select("source", "x.*")
    none = samples.products(spark, folder).where("false")
    return integrity.ledger_counters(counters, ledger, none, none, headers, lines)
