"""Vendor rules held as tables: a new vendor is a new row, no new code.

A rule table is read once per call (its length is bounded by ``MOST_RULES``, more is an error) and its SQL texts become
one expression per column that picks the text of the row's rule. However many rules there are, the data is read once
and no join is added. A condition that is NULL counts as not met.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tierwork.operators.lookups import explode_quantity, unit_blocks

MOST_RULES = 2000
MATCH_RULES = "rule_no int, rule string, on_ext string, on_own string, with_note boolean, residual string, keep string"
REPORT_RULES = ("rule_no int, vendor string, applies string, keep string, report_date string, units string, "
                "columns map<string,string>")


def read_rules(rules: DataFrame) -> list[Row]:
    """The rules by their number; a number given twice is an error, since the order decides."""
    listed = rules.orderBy("rule_no").limit(MOST_RULES + 1).collect()
    if len(listed) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    if len({r.rule_no for r in listed}) < len(listed):
        raise ValueError("rule_no is not unique")
    return listed


def _met(text: str | None) -> Column:
    return F.coalesce(F.expr(text), F.lit(False)) if text is not None else F.lit(True)


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda p, q: p | q, conditions, F.lit(False))


def _dispatch(number: str, texts: Sequence[str | None]) -> Column:
    """The text of the row's rule; rules with the same text share a branch, rules without one give NULL."""
    branches: dict[str, list[int]] = {}
    for i, text in enumerate(texts):
        if text is not None:
            branches.setdefault(text, []).append(i)
    out = F.lit(None)
    for text, numbers in branches.items():
        out = F.when(F.col(number).isin(*numbers), F.expr(text)).otherwise(out)
    return out


def match_by_rules(ext: DataFrame, own: DataFrame, keys: Sequence[str], note: str, rules: DataFrame) -> DataFrame:
    """External rows full-joined to own rows under any rule, then filtered by the rules.

    A rule (``MATCH_RULES``) links rows with equal keys for which ``on_ext`` holds on the external row, ``on_own`` on the
    own row, ``residual`` on both and, ``with_note``, whose delivery notes agree. Own columns are called ``own_...``
    in ``residual`` and ``keep``. A joined or lone row belongs to a rule if ``on_ext`` or ``on_own`` holds for it (a rule
    without both takes every row); it stays under the first rule it belongs to whose ``keep`` holds, named in ``rule``.

    Rules with and without the note are joined apart, each as an equi-join, so a hot order spreads over its notes and only
    rows that a rule without note may link meet on the order alone. Lone rows come from anti-joins, which AQE splits at hot
    keys (a full outer join it does not). NULL keys link with nothing; repeated rows link each; a pair linked by
    several rules is one row; an empty side or rule table gives what is left of the other, or nothing.
    """
    clash = [c for c in ext.columns if c in {"rule", *[f"own_{x}" for x in own.columns]} or c.startswith("__")]
    if clash:
        raise ValueError(f"columns of the external rows clash: {clash}")
    listed = read_rules(rules)
    yours = ext.withColumn("__ext", F.array(*[_met(r.on_ext) for r in listed]).cast("array<boolean>"))
    mine = own.select(F.array(*[_met(r.on_own) for r in listed]).cast("array<boolean>").alias("__own"),
                      *[F.col(c).alias(f"own_{c}") for c in own.columns])
    same = reduce(lambda p, q: p & q, [F.col(k) == F.col(f"own_{k}") for k in keys])
    notes_agree = F.col(note) == F.col(f"own_{note}")

    def links(numbers: Sequence[int]) -> Column:
        return _any([F.col("__ext")[i] & F.col("__own")[i] & _met(listed[i].residual) for i in numbers])

    strict = [i for i, r in enumerate(listed) if r.with_note]
    loose = [i for i, r in enumerate(listed) if not r.with_note]
    found: list[DataFrame] = []
    lone_ext, lone_own = yours, mine
    if strict:
        on = same & notes_agree & links(strict)
        found.append(yours.join(mine, on))
        lone_ext, lone_own = lone_ext.join(mine, on, "left_anti"), lone_own.join(yours, on, "left_anti")
    if loose:
        some_ext = yours.where(_any([F.col("__ext")[i] for i in loose]))
        some_own = mine.where(_any([F.col("__own")[i] for i in loose]))
        on = same & links(loose)
        known = F.coalesce(notes_agree & links(strict), F.lit(False))
        found.append(some_ext.join(some_own, on & ~known))
        lone_ext, lone_own = lone_ext.join(some_own, on, "left_anti"), lone_own.join(some_ext, on, "left_anti")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*found, lone_ext, lone_own])

    def stays(i: int, r: Row) -> Column:
        given = [F.coalesce(F.col(side)[i], F.lit(False))
                 for side, text in (("__ext", r.on_ext), ("__own", r.on_own)) if text is not None]
        return (_any(given) if given else F.lit(True)) & _met(r.keep)

    rule = F.coalesce(F.lit(None).cast("string"), *[F.when(stays(i, r), F.lit(r.rule)) for i, r in enumerate(listed)])
    return rows.withColumn("rule", rule).where("rule IS NOT NULL").select(
        "rule", *ext.columns, *[f"own_{c}" for c in own.columns])


def _case(texts: Sequence[str | None], kind: str) -> str:
    """As ``_dispatch`` on the row's rule, as SQL text, so that ``unit_no`` in a rule's text may be bound by the surrounding lambda."""
    branches: dict[str, list[int]] = {}
    for i, text in enumerate(texts):
        if text is not None:
            branches.setdefault(text, []).append(i)
    cases = [f"WHEN __rule IN ({', '.join(map(str, numbers))}) THEN ({text}\n)" for text, numbers in branches.items()]
    return f"CAST({f'CASE {" ".join(cases)} END' if cases else 'NULL'} AS {kind})"


def _sum_type(kind: str) -> str:
    """What ``sum`` returns for a column of the type."""
    if kind.startswith("decimal"):
        p, s = (int(x) for x in kind[kind.index("(") + 1:-1].split(","))
        return f"decimal({min(38, p + 10)},{s})"
    return "double" if kind in ("double", "float") else "bigint"


def _total(what: str, cells: Column, kind: str | None) -> Column:
    """Count, min, max or sum of an array's values that are not NULL; a count without a type counts all."""
    if what == "count":
        return (F.size(cells) if kind is None else F.size(F.filter(cells, lambda x: x.isNotNull()))).cast("long")
    if what in ("min", "max"):
        return (F.array_min if what == "min" else F.array_max)(cells)
    if what != "sum":
        raise ValueError(f"unknown total {what}")
    wide = _sum_type(kind)
    return F.aggregate(cells, F.lit(None).cast(wide), lambda acc, x: F.coalesce((acc + x).cast(wide), acc, x.cast(wide)))


def report_by_rules(df: DataFrame, rules: DataFrame, columns: Mapping[str, str], common: Sequence[str],
                    totals: Mapping[str, tuple[str, str | None]] | None = None) -> DataFrame:
    """One wide report over all vendors in one scan.

    A row takes the first rule (``REPORT_RULES``) that ``applies``; ``keep`` filters it, ``report_date`` dates it and ``columns``
    holds the text of each report column, absent ones stay NULL. Where the rule has ``units``, a row of n >= 1 units becomes
    n rows with ``unit_no`` 1 to n (blocks first, so no row holds n values), which the column texts may use for serial numbers;
    fewer than 1 or NULL units leave the row as it is, without ``unit_no``. Rows without a rule go.

    With ``totals`` (into -> (count, sum, min or max; column, ``unit_no`` or, to count rows, None)) the rows that one row of ``df`` and one block give come
    as one, with their totals in place of ``unit_no`` and the columns these read, still to be merged by the caller: an aggregation then meets rows
    and not units. If a column that stays depends on ``unit_no``, each unit is such a row by itself.
    """
    clash = [c for c in df.columns if c == "unit_no" or c.startswith("__")]
    if clash:
        raise ValueError(f"columns clash: {clash}")
    listed = read_rules(rules)
    unknown = sorted({name for r in listed for name in (r.columns or {})} - set(columns))
    if unknown:
        raise ValueError(f"rules name columns that the report does not have: {unknown}")
    number = F.coalesce(F.lit(None).cast("int"), *[F.when(_met(r.applies), F.lit(i)) for i, r in enumerate(listed)])
    keep = F.coalesce(_dispatch("__rule", [r.keep or "true" for r in listed]).cast("boolean"), F.lit(False))
    kept = df.withColumn("__rule", number).where(F.col("__rule").isNotNull()).where(keep)
    units = F.floor(_dispatch("__rule", [r.units for r in listed]).cast("double")).cast("long")
    counted = kept.withColumn("__units", units).withColumn("__rows", F.greatest(F.coalesce("__units", F.lit(1)), F.lit(1)))
    texts = [r.columns or {} for r in listed]
    vendor = F.element_at(F.array(*[F.lit(r.vendor) for r in listed]).cast("array<string>"), F.col("__rule") + 1).alias("vendor")
    dates = [r.report_date for r in listed]
    if totals is None:
        unfolded = explode_quantity(counted, "__rows", "__no").withColumn("unit_no", F.when(F.col("__units") >= 1, F.col("__no")))
        return unfolded.select(
            vendor, *common, "unit_no", _dispatch("__rule", dates).cast("date").alias("report_date"),
            *[_dispatch("__rule", [t.get(name) for t in texts]).cast(kind).alias(name) for name, kind in columns.items()])

    kinds = {**columns, "unit_no": "bigint"}
    read = list(dict.fromkeys(c for _, c in totals.values() if c is not None))
    staying = {"report_date": ("date", dates), **{n: (k, [t.get(n) for t in texts]) for n, k in columns.items() if n not in read}}
    numbered = lambda some: any("unit_no" in text.lower() for text in some if text is not None)
    by_unit = any(numbered(some) for _, some in staying.values())
    if by_unit:
        blocks = explode_quantity(counted, "__rows", "__no").withColumn("__nos", F.array("__no"))
    else:
        blocks = unit_blocks(counted, "__rows").withColumn("__nos", F.sequence("__first", "__last"))
    blocks = blocks.withColumn("__nos", F.when(F.col("__units") >= 1, F.col("__nos")).otherwise(F.array(F.lit(None).cast("long"))))

    def cells(some: Sequence[str | None], kind: str) -> Column:
        """The column's value for each unit of the block."""
        if not numbered(some):
            return F.array_repeat(_dispatch("__rule", some).cast(kind), F.size("__nos"))
        return F.expr(f"transform(__nos, unit_no -> {_case(some, kind)})")

    def only(some: Sequence[str | None], kind: str) -> Column:
        return cells(some, kind)[0] if numbered(some) else _dispatch("__rule", some).cast(kind)

    of_units = [(F.col("__nos") if c == "unit_no" else cells([t.get(c) for t in texts], kinds[c])).alias(f"__of_{c}") for c in read]
    filled = blocks.select(vendor, *common, *[only(some, kind).alias(n) for n, (kind, some) in staying.items()], "__nos", *of_units)
    return filled.select("vendor", *common, *staying, *[
        _total(what, F.col("__nos" if c is None else f"__of_{c}"), None if c is None else kinds[c]).alias(into) for into, (what, c) in totals.items()])
