"""Multi-step column parsers.

A parser is a sequence of column expressions. :func:`parse` runs the steps of many parsers side by side as
consecutive projections, so that each intermediate text is computed once per row instead of being repeated
in every branch of the next step.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Step = Callable[[Column], Column]


class Parser:
    def __init__(self, *steps: Step | "Parser"):
        flat: list[Step] = []
        for step in steps:
            flat.extend(step.steps if isinstance(step, Parser) else [step])
        self.steps = flat

    def __call__(self, raw: Column) -> Column:
        for step in self.steps:
            raw = step(raw)
        return raw


def outcome(value: Column, code: Column | None = None) -> Column:
    """``struct<value, code>``; ``code`` names the reason a value was refused."""
    code = F.lit(None) if code is None else code
    return F.struct(value.alias("value"), code.cast("string").alias("code"))


def counted(df: DataFrame) -> DataFrame:
    """Count the rows that pass here (an observed metric).

    Filters are not pushed below an observation. That is wanted above long chains of derived columns:
    pushed down, each filter would repeat the expressions of the whole chain once more, and the plan
    would grow beyond all bounds.
    """
    return df.observe(f"rows_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def parse(df: DataFrame, fields: dict[str, tuple[Parser, Column]]) -> DataFrame:
    """Add one column per field: the result of its parser over its raw text column."""
    df = df.withColumns({name: raw for name, (_, raw) in fields.items()})
    for position in range(max(len(parser.steps) for parser, _ in fields.values())):
        df = df.withColumns(
            {
                name: parser.steps[position](F.col(name))
                for name, (parser, _) in fields.items()
                if position < len(parser.steps)
            }
        )
    return counted(df)
