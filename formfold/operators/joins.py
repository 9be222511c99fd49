"""Joins with metadata, and joins that update columns of the left side.

No side is broadcast by hint: Spark broadcasts what it measures to be below its
threshold and sorts the rest, and adaptive execution splits a hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def of_metadata(
    df: DataFrame, key: str, meta: DataFrame, meta_id: str, uuids: Sequence[str]
) -> DataFrame:
    """Rows whose metadata row has one of the uuids."""
    chosen = meta.filter(F.col("uuid").isin(list(uuids))).select(F.col(meta_id).alias(key))
    return df.join(chosen, key, "left_semi")


def pivot_by_type(
    df: DataFrame, owner: str, type_key: str, value: str,
    meta: DataFrame, meta_id: str, columns: Mapping[str, str], out_key: str,
) -> DataFrame:
    """Typed values of an owner side by side: one column per type uuid."""
    kinds = meta.select(F.col(meta_id).alias(type_key), F.col("uuid").alias("type_uuid"))
    typed = df.filter("voided = 0").join(kinds, type_key)
    measures = [
        F.max(F.when(F.col("type_uuid") == uuid, F.struct(F.lower(value).alias("f"), F.col(value).alias("v"))))
        .getField("v").alias(name)
        for name, uuid in columns.items()
    ]
    return typed.groupBy(F.col(owner).alias(out_key)).agg(*measures)


def attributes_by_type(records: Mapping[str, DataFrame], columns: Mapping[str, str]) -> DataFrame:
    """Person attributes of unretired types, one row per person that has any of them."""
    meta = records["person_attribute_type"].filter("retired = 0").filter(
        F.col("uuid").isin(list(columns.values())))
    return pivot_by_type(
        records["person_attribute"], "person_id", "person_attribute_type_id", "value",
        meta, "person_attribute_type_id", columns, "person_id")


def identifiers_by_type(records: Mapping[str, DataFrame], columns: Mapping[str, str]) -> DataFrame:
    """Patient identifiers; a patient with identifiers of other types only still
    gets a row (of nulls)."""
    return pivot_by_type(
        records["patient_identifier"], "patient_id", "identifier_type", "identifier",
        records["patient_identifier_type"], "patient_identifier_type_id", columns, "patient_id")


def first_row(df: DataFrame, key: str, by: str, columns: Sequence[str]) -> DataFrame:
    """One whole row per key, the one with the lowest ``by``; combines partially."""
    kept = F.min_by(F.struct(*columns), F.col(by)).alias("kept")
    return df.groupBy(key).agg(kept).select(key, *[F.col(f"kept.{c}").alias(c) for c in columns])


def update_join(
    target: DataFrame, source: DataFrame, key: str, how: str = "inner"
) -> DataFrame:
    """Set the shared columns of ``target`` from ``source`` (one row per key).

    ``outer``: a row without a partner gets nulls.  ``inner``: it keeps its values.
    """
    shared = [c for c in source.columns if c != key]
    new = source.selectExpr(key, "true AS _found", *[f"{c} AS _new_{c}" for c in shared])
    joined = target.join(new, key, "left")
    found = "true" if how == "outer" else "_found"
    return joined.selectExpr(*[f"if({found}, _new_{c}, {c}) AS {c}" if c in shared else c for c in target.columns])
