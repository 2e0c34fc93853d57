"""Keyed merge of updates into a table."""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlake import session
from paperlake.session import data_bytes

_HIT = "__hit"


def _insert_rows(target: DataFrame, updates: DataFrame, replaced: Sequence[str], touch: str | None, now: Column):
    """Updates in the columns and types of the target; columns they do not carry start as null."""
    columns = []
    for field in target.schema.fields:
        if field.name == touch:
            value = now
        elif field.name in replaced:
            value = F.col(field.name)
        else:
            value = F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return updates.select(columns)


def upsert(
    target: DataFrame,
    updates: DataFrame,
    key: str = "paper_id",
    update_cols: Sequence[str] | None = None,
    touch: str | None = None,
    now: Column | None = None,
    invalidate: Iterable[str] = (),
    broadcast_limit: int | None = None,
) -> DataFrame:
    """Insert new keys and replace `update_cols` of known ones (all columns by default).

    `touch` names a time stamp set to `now` on every inserted or updated row, `invalidate`
    columns that become null when a row is updated. `updates` must hold each key once. The result
    has the schema of the target.

    Updates below the broadcast limit are probed by a scan of the target that never shuffles;
    larger ones are merged by one full outer join on the key.
    """
    update_cols = [c for c in (update_cols or target.columns) if c != key]
    replaced = [key, *update_cols]
    now = F.current_timestamp() if now is None else now
    invalidate = set(invalidate)
    fields = target.schema.fields

    def merged(hit: Column, absent: Column) -> list[Column]:
        """The row after the merge; `hit` marks a matching update, `absent` a missing target."""
        out = []
        for field in fields:
            old, new = F.col(f"t.{field.name}"), F.col(f"u.{field.name}")
            if field.name == key:
                value = F.coalesce(old, new)
            elif field.name == touch:
                value = F.when(hit, now).otherwise(old)
            elif field.name in update_cols:
                value = F.when(hit, new).otherwise(old)
            elif field.name in invalidate:
                value = F.when(hit & ~absent, F.lit(None)).otherwise(old)
            else:
                value = old
            out.append(value.cast(field.dataType).alias(field.name))
        return out

    carried = updates.select(*[c for c in replaced if c != touch])
    small = data_bytes(carried) <= (session.BROADCAST_BYTES if broadcast_limit is None else broadcast_limit)
    if not small:
        left = target.withColumn("__known", F.lit(True)).alias("t")
        right = carried.withColumn(_HIT, F.lit(True)).alias("u")
        joined = left.join(right, F.col(f"t.{key}") == F.col(f"u.{key}"), "full_outer")
        return joined.select(merged(F.col(f"u.{_HIT}").isNotNull(), F.col("t.__known").isNull()))

    known = target.select(key).join(F.broadcast(updates.select(key)), key, "left_semi")
    inserts = _insert_rows(target, carried.join(known, key, "left_anti"), replaced, touch, now)
    if set(update_cols) | {key} >= set(target.columns) and touch is None:
        # Every column is replaced: drop the old rows and append the new ones.
        kept = target.join(F.broadcast(updates.select(key)), key, "left_anti").select(target.columns)
        return kept.unionByName(_insert_rows(target, updates, replaced, touch, now))
    right = F.broadcast(carried.withColumn(_HIT, F.lit(True))).alias("u")
    joined = target.alias("t").join(right, F.col(f"t.{key}") == F.col(f"u.{key}"), "left")
    return joined.select(merged(F.col(f"u.{_HIT}").isNotNull(), F.lit(False))).unionByName(inserts)
