"""The twelve record tables and the upstream tables of the marts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

RECORDS = (
    "person", "patient", "person_name", "person_attribute", "person_attribute_type",
    "patient_identifier", "patient_identifier_type", "person_address",
    "encounter", "encounter_type", "form", "obs",
)
# column to split a JDBC read on, for the tables that grow
SPLIT_ON = {
    "person": "person_id", "patient": "patient_id", "person_name": "person_name_id",
    "person_attribute": "person_attribute_id", "patient_identifier": "patient_identifier_id",
    "person_address": "person_address_id", "encounter": "encounter_id", "obs": "obs_id",
}


def read_sources(
    spark: SparkSession, root: str, tables: Iterable[str] = RECORDS, fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """One directory per table under ``root``."""
    return {t: spark.read.format(fmt).load(f"{root}/{t}") for t in tables}


def read_upstream(
    spark: SparkSession, root: str, tables: Iterable[str], fmt: str = "parquet"
) -> dict[str, DataFrame]:
    return read_sources(spark, root, tables, fmt)


def read_jdbc(
    spark: SparkSession,
    url: str,
    bounds: Mapping[str, tuple[int, int]],
    partitions: int,
    tables: Iterable[str] = RECORDS,
    **options: str,
) -> dict[str, DataFrame]:
    """The same tables from a database.

    ``bounds`` gives the key range of each growing table; its read is split into
    ``partitions`` key ranges.  The bounds only shape the split: rows outside
    them are read by the first and the last range.
    """
    out = {}
    for table in tables:
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
        if table in SPLIT_ON and table not in bounds:
            raise ValueError(f"{table} grows: give its key range in bounds, or one task reads all of it")
        if table in bounds:
            low, high = bounds[table]
            reader = reader.options(
                partitionColumn=SPLIT_ON[table], lowerBound=low, upperBound=high,
                numPartitions=partitions)
        out[table] = reader.options(fetchsize=10000, **options).load()
    return out
