"""Whole load steps put together from the single operators: raw -> cleaned table, staged -> star fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwork.functions.values import row_hash
from tierwork.operators import cdc
from tierwork.operators.columns import cast_to_schema
from tierwork.operators.history import lookup_dimension_keys
from tierwork.operators.ordered import keep_first


def load_cleaned(
    raw: DataFrame, target: DataFrame | None, schema: T.StructType, keys: Sequence[str], mark: str, mode: str, at,
    present_keys: DataFrame | None = None, force: bool = False,
) -> DataFrame:
    """New snapshot of a cleaned table.

    Current flag by newest mark, texts normalised, rows without key dropped, cast to the target's ``schema``, hashed
    after that (so the hash is of what is stored), one row per key and mark, merged, and - with an extract of existing
    keys - flagged as deleted. Adds hash_key, is_current, inserted_at, modified_at and is_deleted.
    ``raw`` may be a part: current rows of keys that it does not contain stay as they are.
    """
    pk = [*keys, mark]
    flagged = cdc.current_flag(raw, mode, keys, mark)
    clean = cdc.drop_null_keys(cdc.fill_missing(flagged), pk)
    typed = cast_to_schema(clean, T.StructType([*schema.fields, T.StructField("is_current", T.BooleanType())]))
    content = [F.col(f.name) for f in schema.fields if f.name not in pk]
    stamped = typed.withColumns({
        "hash_key": row_hash(content), "inserted_at": F.lit(at), "modified_at": F.lit(at), "is_deleted": F.lit(False),
    })
    rows = keep_first(stamped, pk, [F.col("hash_key")])
    if target is None:
        out = rows
    else:
        touched = rows.select(*keys).distinct()
        out = cdc.merge_upsert(
            target.join(touched, list(keys), "left_semi"), rows, pk, hash_col="hash_key", current_col="is_current",
            keep_cols=["inserted_at", "is_deleted"], force=force,
        ).unionByName(target.join(touched, list(keys), "left_anti"))
    return out if present_keys is None else cdc.soft_delete(out, present_keys, keys, "is_deleted")


def load_fact(
    staged: DataFrame, fact: DataFrame, marks: DataFrame, source_col: str, ts: str,
    dims: Sequence[tuple[DataFrame, Sequence[str], str]], keys: Sequence[str],
) -> tuple[DataFrame, DataFrame]:
    """(new fact snapshot, new marks): rows after their source's mark, keyed to the dimensions, upserted."""
    delta = cdc.delta_by_source(staged, marks, source_col, ts, "mark")
    rows = lookup_dimension_keys(delta, dims).select(*fact.columns)
    new_fact = cdc.merge_upsert(fact, rows, keys, deactivate_absent=False)
    seen = cdc.new_marks(delta, source_col, ts, "mark")
    return new_fact, cdc.advance_watermark(marks, seen, [source_col], "mark")
