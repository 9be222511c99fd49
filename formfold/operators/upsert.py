"""Change detection and insert-or-update."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHANGE_TIMES = ("date_created", "date_changed", "date_voided")


def since(df: DataFrame, moment: str | Column, columns: Sequence[str] = CHANGE_TIMES) -> DataFrame:
    """Rows created, changed or voided at or after the moment."""
    at = F.lit(moment).cast("timestamp") if isinstance(moment, str) else moment
    there = [c for c in columns if c in df.columns]
    if not there:
        raise ValueError(f"none of the change columns {', '.join(columns)} in {', '.join(df.columns)}")
    return df.filter(reduce(lambda a, b: a | b, [F.col(c) >= at for c in there]))


def changed_encounters(records: Mapping[str, DataFrame], moment: str | Column) -> DataFrame:
    """Encounters touched themselves or through any observation, voided ones too.

    The keys of both sides are deduplicated map-side before the shuffle.
    """
    own = since(records["encounter"], moment).select("encounter_id")
    through = since(records["obs"], moment).select("encounter_id")
    return own.union(through).distinct()


def changed_persons(records: Mapping[str, DataFrame], moment: str | Column) -> DataFrame:
    own = since(records["person"], moment).select("person_id")
    through = since(records["person_name"], moment).select("person_id")
    return own.union(through).distinct()


def flagged(rows: DataFrame, key: str, gone: DataFrame | None) -> DataFrame:
    """The rows, voided where their key is in ``gone``."""
    if gone is None:
        return rows
    marks = gone.select(key, F.lit(1).alias("_gone")).distinct()
    return rows.join(marks, key, "left").select(*[
        F.coalesce("_gone", c).alias(c) if c == "voided" else F.col(c) for c in rows.columns])


def upsert(
    target: DataFrame,
    changes: DataFrame,
    key: str,
    update_cols: Sequence[str] | None = None,
    recomputed: DataFrame | None = None,
) -> DataFrame:
    """Insert new keys; on existing keys set ``update_cols`` (default: all columns).

    ``recomputed`` are all keys the changes were computed for (one distinct column).
    A row of such a key that the changes no longer contain stays, flagged voided:
    the live rows are then those of a rebuild, and nothing is deleted.

    The target is only probed against the changes, so a small change set is
    broadcast (by measured size) and the target is not shuffled.
    """
    columns = target.columns
    changes = changes.selectExpr(*columns)
    if update_cols is None:
        kept = target.join(changes.select(key), key, "left_anti").selectExpr(*columns)
        return flagged(kept, key, recomputed).unionByName(changes)
    new = changes.select(
        key, F.lit(True).alias("_found"), *[F.col(c).alias(f"_new_{c}") for c in update_cols])
    if recomputed is not None:
        target = target.join(
            recomputed.select(key, F.lit(True).alias("_asked")).distinct(), key, "left")
    else:
        target = target.withColumn("_asked", F.lit(None).cast("boolean"))
    def value(c):
        old = F.col(c)
        if c == "voided":
            old = F.when(F.col("_asked") & F.col("_found").isNull(), 1).otherwise(old)
        return F.when(F.col("_found"), F.col(f"_new_{c}")).otherwise(old) if c in update_cols else old

    updated = target.join(new, key, "left").select(*[value(c).alias(c) for c in columns])
    inserted = changes.join(target.select(key), key, "left_anti").select(*columns)
    return updated.unionByName(inserted)
