"""Curated tables and marts on storage: typed writes, empty tables, publishing.

A table is never changed in place.  Every write goes to a version folder of its own.  One small
file, the state, names the versions that are current, of all tables; a run writes the next
state when all its tables are written, so that readers see the old rows of all tables or the
new ones, and a run that dies leaves the old ones.

A refresh adds a version that holds the rows it changed.  Of several versions of a table the
newest row of a key counts.  When a table has more than `MOST_VERSIONS` versions, or its
changes reach a quarter of its rows, the refresh writes the whole table instead.

Marts, and curated tables when they are written again from their own files, are laid out by the
columns that the declared indexes name (`sources/indexes`), so that a range or value of any of
them is in few files.  All files carry Bloom filters of the keys.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from formfold.sources import indexes
from formfold.sources.schemas import CURATED, declared, key_of, schema_of, spark_type, width
from formfold.sources.staging import file_names, read_file, remove, write_file

MOST_VERSIONS = 5
KEPT_STATES = 20
DIGEST = "row_digest"
_switching = threading.Lock()


def typed(df: DataFrame, table: str) -> DataFrame:
    """Exactly the declared columns, in order, in their types and widths."""
    out = []  # SQL texts: a hundred columns built by calls take longer than a small refresh
    for name, declared_type in declared(table):
        value = f"CAST({name} AS {spark_type(name, declared_type).simpleString()})"
        out.append(f"substring({value}, 1, {width(declared_type)}) AS {name}" if width(declared_type) else f"{value} AS {name}")
    return df.selectExpr(*out)


def with_digest(df: DataFrame) -> DataFrame:
    """The rows with a digest of all their values."""
    values = ", ".join(f"coalesce(CAST({c} AS STRING), '\u0000')" for c in df.columns)
    return df.selectExpr("*", f"xxhash64({values}) AS {DIGEST}")


# ---- state -------------------------------------------------------------------------

def state(spark: SparkSession, root: str) -> dict:
    """{"tables": {name: [{"version", "rows"}, ...]}, "batches": {stream: last batch}}"""
    names = _states(spark, root)
    if not names:
        return {"tables": {}, "batches": {}}
    return json.loads(read_file(spark, f"{root}/state/{names[-1]}"))


def _states(spark: SparkSession, root: str) -> list[str]:
    return [n for n in file_names(spark, f"{root}/state") if n.endswith(".json")]


def switch(spark: SparkSession, root: str, tables: Mapping[str, Sequence[dict]], batch: tuple[str, int] | None = None) -> None:
    """Make versions current, all at once, and note the stream's batch they come from.  One run
    at a time writes to a root."""
    with _switching:
        now = state(spark, root)
        now["tables"] |= {name: list(versions) for name, versions in tables.items()}
        if batch:
            now["batches"][batch[0]] = batch[1]
        write_file(spark, f"{root}/state/{time.time_ns():020d}-{uuid.uuid4().hex}.json", json.dumps(now))
        for name in _states(spark, root)[:-KEPT_STATES]:
            remove(spark, f"{root}/state/{name}")


def versions_of(spark: SparkSession, root: str, table: str) -> list[dict]:
    found = state(spark, root)["tables"].get(table)
    if not found:
        raise LookupError(f"{table} was never written below {root}")
    return found


def vacuum(spark: SparkSession, root: str, table: str) -> None:
    """Delete the versions that are no longer current.  Not while a reader may still use them."""
    current = {f"version={v['version']}" for v in versions_of(spark, root, table)}
    for name in file_names(spark, f"{root}/{table}"):
        if name.startswith("version=") and name not in current:
            remove(spark, f"{root}/{table}/{name}")


# ---- tables ------------------------------------------------------------------------

def write_version(df: DataFrame, root: str, name: str, blooms: Sequence[str] = ()) -> dict:
    """Write rows without making them current; gives the version with its number of rows, counted
    while they are written."""
    version, seen = uuid.uuid4().hex, Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("compression", "zstd")
    # adaptive is of the file, not of a column; without it each filter takes 1 MB however few the rows
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for column in blooms:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(f"{root}/{name}/version={version}")
    return {"version": version, "rows": seen.get["rows"]}


def prepare(df: DataFrame, root: str, table: str) -> dict:
    """Write a version of a curated table without making it current."""
    rows = typed(df, table)
    if table == "client_registration":
        rows = with_digest(rows)
    return write_version(rows, root, table, indexes.keys_of(table))


def optimized(spark: SparkSession, root: str, table: str, versions: Sequence[dict], files: int | None = None) -> dict:
    """One version in place of several, laid out by the declared indexes; not current yet."""
    rows = read_versions(spark, root, table, versions)
    return prepare(indexes.laid_out(rows, indexes.of_table(table), files), root, table)


def optimize(spark: SparkSession, root: str, table: str, files: int | None = None) -> None:
    """Write a table again in the order of its indexes."""
    switch(spark, root, {table: [optimized(spark, root, table, versions_of(spark, root, table), files)]})


def write_curated(df: DataFrame, root: str, table: str) -> None:
    """Replace a curated table."""
    switch(df.sparkSession, root, {table: [prepare(df, root, table)]})


def read_versions(spark: SparkSession, root: str, table: str, versions: Sequence[dict], digest: bool = False) -> DataFrame:
    """The newest row of every key."""
    schema, key = schema_of(table), key_of(table)
    if digest:
        schema = schema.add(DIGEST, "long")
    first, *later = [spark.read.schema(schema).parquet(f"{root}/{table}/version={v['version']}") for v in versions]
    for rows in later:  # few, and each with few rows
        first = first.join(rows.select(key), key, "left_anti").select(*rows.columns).unionByName(rows)
    return first


def read_curated(spark: SparkSession, root: str, table: str) -> DataFrame:
    return read_versions(spark, root, table, versions_of(spark, root, table))


def with_changes(changes: DataFrame, root: str, table: str) -> list[dict] | None:
    """The versions of a table that hold changed rows (of keys once each), in place of those of
    the same keys; None where nothing changed.  Written, but not current yet."""
    spark = changes.sparkSession
    versions = versions_of(spark, root, table)
    added = prepare(changes, root, table)
    if not added["rows"]:
        remove(spark, f"{root}/{table}/version={added['version']}")
        return None
    versions = [*versions, added]
    if len(versions) <= MOST_VERSIONS and 4 * sum(v["rows"] for v in versions[1:]) < max(versions[0]["rows"], 1000):
        return versions
    return [optimized(spark, root, table, versions)]


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], schema_of(table))


def reset(spark: SparkSession, root: str, tables: Sequence[str] = CURATED) -> None:
    """Every curated table anew and empty, with its declared columns."""
    switch(spark, root, {t: [prepare(empty_table(spark, t), root, t)] for t in tables})


def reset_database(spark: SparkSession, database: str) -> None:
    """Drop a catalog database with its tables and create it again."""
    spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
    spark.sql(f"CREATE DATABASE `{database}`")


# ---- marts -------------------------------------------------------------------------

def prepare_mart(df: DataFrame, name: str, root: str, files: int | None = None,
                 made: tuple[DataFrame, Mapping[str, str]] | None = None) -> dict:
    """Write a version of a mart; its schema is that of the select.  made: see `indexes.laid_out`."""
    rows = indexes.laid_out(df, indexes.of_mart(name), files, made)
    return write_version(rows, root, name, [c for c in ("encounter_id", "uuid") if c in df.columns])


def publish_mart(df: DataFrame, name: str, root: str | None = None, database: str | None = None) -> None:
    """Create a mart from a select.  In a database the mart is a view of its current version."""
    spark = df.sparkSession
    if database:
        root = spark.sql(f"DESCRIBE DATABASE `{database}`").filter("info_name = 'Location'").first()["info_value"]
    made = prepare_mart(df, name, root)
    if database:
        path = f"{root}/{name}/version={made['version']}"
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS SELECT * FROM parquet.`{path}`")
    else:
        switch(spark, root, {name: [made]})


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}/version={versions_of(spark, root, name)[-1]['version']}")
