"""Ordered classification rules, held as data and compiled to one CASE per target and stage."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwork.functions.text import leading_int

# fixed values: the texts rules start from and write
UNASSIGNED = "Not Assigned"
SURE = "Sure Mapping"
SUBSCRIPTION = "SW Subscription"
YEARS_SAID = r"(\d+)\s*YEA"
RULE_TARGETS = ("duration", "frequency", "consumption", "type", "mapping_duration", "mapping_billing")


@dataclass(frozen=True)
class Test:
    """``op``: eq, ne, regex, contains, gt, is_null, not_null."""

    field: str
    op: str
    value: object = None

    def column(self) -> Column:
        c = F.col(self.field)
        made = {
            "eq": lambda: c == self.value, "ne": lambda: c != self.value, "regex": lambda: c.rlike(self.value),
            "contains": lambda: c.contains(self.value), "gt": lambda: c > self.value,
            "is_null": c.isNull, "not_null": c.isNotNull,
        }[self.op]()
        return F.coalesce(made, F.lit(False))


@dataclass(frozen=True)
class Rule:
    """When all tests hold, ``target`` becomes ``value``.

    ``value`` is a literal, ``("capture", field, regex, unit)`` for a matched group plus unit, or
    ``("years", field)`` for months / 12 rounded to 4 with the unit YR. Stages run in order and see earlier results;
    inside a stage later rules win.
    """

    stage: int
    target: str
    value: object
    tests: tuple[Test, ...] = field(default=())

    def condition(self) -> Column:
        out = F.lit(True)
        for t in self.tests:
            out = out & t.column()
        return out

    def result(self) -> Column:
        if isinstance(self.value, tuple) and self.value[0] == "capture":
            _, source, pattern, unit = self.value
            return F.concat(F.regexp_extract(source, pattern, 1), F.lit(unit))
        if isinstance(self.value, tuple) and self.value[0] == "years":
            return F.concat(F.round(F.col(self.value[1]) / F.lit(12.0), 4).cast("string"), F.lit(" YR"))
        return F.lit(self.value)


def with_defaults(df: DataFrame, description: Sequence[str], lifecycle: str) -> DataFrame:
    """Unassigned targets, the joined description and the months at the head of the life-cycle text."""
    return df.withColumns({
        "matched_type": F.lit("mt=auto"), **{t: F.lit(UNASSIGNED) for t in RULE_TARGETS},
        "description": F.concat_ws(" ", *description), "months": leading_int(F.col(lifecycle)),
    })


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    for _, stage in groupby(sorted(rules, key=lambda r: r.stage), key=lambda r: r.stage):
        made: dict[str, Column] = {}
        for r in reversed(list(stage)):
            base = made.get(r.target)
            made[r.target] = F.when(r.condition(), r.result()) if base is None else base.when(r.condition(), r.result())
        df = df.withColumns({t: c.otherwise(F.col(t)) for t, c in made.items()})
    return df


def finish_rules(df: DataFrame) -> DataFrame:
    """Upper-case description; the first ``N YEA`` in it sets N YR, whatever N; ratio = 12 x years; years shown with two decimals."""
    df = df.withColumn("description", F.upper("description"))
    text = F.col("description")
    said = F.nullif(F.regexp_extract(text, YEARS_SAID, 1), F.lit(""))
    df = df.withColumns({
        "duration": F.when(said.isNotNull(), F.concat(said, F.lit(" YR"))).otherwise(F.col("duration")),
        "mapping_duration": F.when(said.isNotNull(), SURE).otherwise(F.col("mapping_duration")),
        "type": F.when(text.contains("SUBSC"), SUBSCRIPTION).otherwise(F.col("type")),
    })
    years = F.nullif(F.regexp_extract("duration", r"(\d*\.?\d+)", 1), F.lit("")).cast("decimal(18,4)")
    in_years = F.col("duration").rlike("YR")
    return df.withColumns({
        "mrr_ratio": F.when(in_years, (years * 12).cast("double")).otherwise(F.lit(0.0)),
        "duration": F.when(in_years, F.concat(years.cast("decimal(18,2)").cast("string"), F.lit(" YR"))).otherwise(
            F.col("duration")),
    })
