"""Supplier catalogue: row validation and choice of one row per SKU."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lonja.functions import dates, numbers, text
from lonja.functions.parser import parse
from lonja.operators.grouping import attach_group
from lonja.operators.issues import ISSUE, issue, issue_list
from lonja.vocabulary import (
    CATALOGUE,
    CATALOGUE_COLUMNS,
    DEDUPLICATE,
    DETAIL,
    DROP,
    NORMALIZE,
    REJECT,
)

FIELD_PARSERS = {
    "sku": text.identifier,
    "ean": text.ean,
    "nombre": text.required_text,
    "marca": text.required_text,
    "categoria": text.required_text,
    "precio_coste": numbers.catalogue_money,
    "pvp_recomendado": numbers.catalogue_money,
    "iva": numbers.tax,
    "peso_kg": numbers.weight,
    "fecha_alta": dates.date,
}
OPTIONAL = ["ean", "iva", "peso_kg", "fecha_alta"]


def _wrong_count() -> Column:
    return issue(CATALOGUE, "INVALID_COLUMN_COUNT", REJECT, None, DETAIL["column_count"])


def column_counts(scanned: DataFrame) -> DataFrame:
    """Rows of raw cells with a wrong number of them: ``ord, locator, cells, entity, issues``.

    Needs the parser of the identifier only, and of these rows only.
    """
    wrong = scanned.where(F.size("cells") != len(CATALOGUE_COLUMNS))
    rows = parse(wrong, {"_sku": (FIELD_PARSERS["sku"], F.get("cells", F.lit(CATALOGUE_COLUMNS.index("sku"))))})
    return rows.withColumns({"entity": F.col("_sku.value"), "issues": F.array(_wrong_count())}).drop("_sku")


def parse_catalogue(scanned: DataFrame) -> DataFrame:
    """Validate rows of raw cells (``ord, locator, cells``).

    Adds the typed columns, ``entity``, ``candidate`` (all required fields are good), ``cost_problem`` and
    ``issues``. A bad cost does not reject the row yet: an agreed price may still replace it.
    """
    cells = F.col("cells")
    aligned = F.size(cells) == len(CATALOGUE_COLUMNS)
    fields = {
        f"_{name}": (FIELD_PARSERS[name], F.get(cells, CATALOGUE_COLUMNS.index(name)))
        for name in FIELD_PARSERS
    }
    fields["description"] = (text.clean_text, F.get(cells, CATALOGUE_COLUMNS.index("descripcion")))
    rows = parse(scanned, fields)

    def code(name: str) -> Column:
        return F.col(f"_{name}.code")

    pvp_code = F.coalesce(
        code("pvp_recomendado"),
        F.when(F.col("_pvp_recomendado.value").isNull(), "MISSING_REQUIRED_FIELD"),
    )
    required = [
        ("sku", code("sku"), "sku"),
        ("nombre", code("nombre"), "required"),
        ("marca", code("marca"), "required"),
        ("categoria", code("categoria"), "required"),
        ("pvp_recomendado", F.col("_pvp_code"), "pvp"),
    ]
    rows = rows.withColumn("_pvp_code", pvp_code).withColumn("_aligned", aligned)
    good = F.col("_aligned")
    for _, problem, _ in required:
        good = good & problem.isNull()
    rows = rows.withColumn("candidate", good)

    cost = F.col("_precio_coste")
    entries = [(~F.col("_aligned"), _wrong_count())]
    for name, problem, detail in required:
        entries.append(
            (
                F.col("_aligned") & problem.isNotNull(),
                issue(CATALOGUE, problem, REJECT, name, DETAIL[detail]),
            )
        )
    for name, condition in (
        ("pvp_recomendado", F.col("_aligned")),
        ("precio_coste", F.col("candidate")),
    ):
        entries.append(
            (
                condition & F.col(f"_{name}.repaired"),
                issue(
                    CATALOGUE, "NORMALIZED_CURRENCY_SUFFIX", NORMALIZE, name,
                    F.concat(F.lit(DETAIL["suffix"]), F.col(f"_{name}.plain")),
                ),
            )
        )
    for name in OPTIONAL:
        entries.append(
            (
                F.col("candidate") & code(name).isNotNull(),
                issue(CATALOGUE, code(name), DROP, name, DETAIL[name]),
            )
        )
    rows = parse(
        rows,
        {
            "brand_key": (text.comparison_key, F.col("_marca.value")),
            "category_key": (text.comparison_key, F.col("_categoria.value")),
        },
    )
    return rows.select(
        F.lit(CATALOGUE).alias("source"),
        "ord",
        "locator",
        "cells",
        F.col("_sku.value").alias("entity"),
        "candidate",
        F.col("_sku.value").alias("sku"),
        F.col("_ean.value").alias("ean"),
        F.col("_nombre.value").alias("name"),
        F.col("_marca.value").alias("brand"),
        F.col("_categoria.value").alias("category"),
        "brand_key",
        "category_key",
        cost["value"].alias("base_cost"),
        F.col("_pvp_recomendado.value").alias("pvp"),
        F.col("_pvp_recomendado.plain").alias("pvp_text"),
        F.col("_iva.value").alias("tax_rate"),
        F.col("_peso_kg.value").alias("weight_kg"),
        F.col("_fecha_alta.value").alias("listed_on"),
        "description",
        F.coalesce(
            cost["code"], F.when(cost["value"].isNull(), "MISSING_REQUIRED_FIELD")
        ).alias("cost_problem"),
        issue_list(*entries).alias("issues"),
    )


Verdict = Callable[[DataFrame], DataFrame]
Keep = Callable[[DataFrame], DataFrame]


def select_first_valid(
    records: DataFrame, judge: Verdict, keep: Keep = lambda rows: rows
) -> DataFrame:
    """Keep, per SKU, the first row in file order that the judge accepts.

    ``judge`` gets the records and adds ``verdict``: NULL where the final price is good, else the issue
    that rejects the row. Every row is judged before any row is chosen. The result has all records with
    ``outcome`` in accepted, deduplicated, rejected and the complete issue list. The judged rows are
    read twice; ``keep`` may write them out in between.
    """
    judged = judge(records).withColumn(
        "_valid", F.col("candidate") & F.col("verdict").isNull()
    ).withColumn("_print", F.sha2(F.to_json("cells"), 256))
    order = F.when(F.col("_valid"), F.col("ord"))
    judged = keep(judged)
    grouped = attach_group(
        judged.withColumn("_group", F.coalesce("sku", F.concat(F.lit("\x00"), "locator"))),
        ["_group"],
        F.min_by(F.struct("ord", "locator", "_print"), order).alias("_kept"),
    )
    kept = F.col("_kept")
    first = F.col("_valid") & (F.col("ord") == kept["ord"])
    same = F.col("_valid") & ~first & (F.col("_print") == kept["_print"])
    other = F.col("_valid") & ~first & (F.col("_print") != kept["_print"])
    added = issue_list(
        (F.col("candidate") & F.col("verdict").isNotNull(), F.col("verdict")),
        (
            F.col("_valid") & F.col("cost_problem").isNotNull(),
            issue(CATALOGUE, F.col("cost_problem"), DROP, "precio_coste", DETAIL["rescued"]),
        ),
        (
            same,
            issue(
                CATALOGUE, "EXACT_DUPLICATE", DEDUPLICATE, None,
                F.concat(F.lit(DETAIL["same_row"]), kept["locator"]),
            ),
        ),
        (
            other,
            issue(
                CATALOGUE, "CONFLICTING_PRODUCT_SKU", REJECT, None,
                F.concat(F.lit(DETAIL["other_row"]), kept["locator"]),
            ),
        ),
    )
    return grouped.withColumns(
        {
            "outcome": F.when(first, "accepted").when(same, "deduplicated").otherwise("rejected"),
            "issues": F.concat("issues", added),
        }
    ).drop("_valid", "_print", "_group", "_kept")


def no_verdict() -> Column:
    return F.lit(None).cast(ISSUE)
