"""Checks in place of enforced constraints; every check counts map-side first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values of a key that occur more than once, or are missing, with their count."""
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return counted.filter((F.col("n") > 1) | missing)


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values of a unique column that occur more than once; missing ones are allowed."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n"))
    return counted.filter("n > 1")


def missing_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n): rows without a value, in one pass over all columns."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "n")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """(key, n): referenced values without a row in the parent.

    References are counted per value first, so a value with very many rows is
    one row in the join.
    """
    counted = child.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_key).alias(key))
    return counted.join(known, key, "left_anti")


def orphans_of(children: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """(table_name, key, n) over the rows of several tables that refer to one parent."""
    counted = children.filter(F.col(key).isNotNull()).groupBy("table_name", key).agg(
        F.count(F.lit(1)).alias("n"))
    return counted.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


BROKEN = "table_name string, column_name string, parent_name string, value string, n bigint"


def broken_references(tables: Mapping[str, DataFrame], references: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """(table_name, column_name, parent_name, value, n): referenced values that their parent lacks.

    references: (table, column, parent table, parent column).  Every table is read once: a row
    gives each of its references, these are counted per value before anything is shuffled,
    and one anti join meets the keys of all parents.
    """
    by_child: dict[str, list] = {}
    for child, column, parent, key in references:
        by_child.setdefault(child, []).append((column, parent, key))
    counted = []
    for child, refs in by_child.items():
        cells = [F.struct(F.lit(c).alias("column_name"), F.lit(p).alias("parent_name"), F.lit(k).alias("parent_key"),
                          F.col(c).cast("string").alias("value")) for c, p, k in refs]
        counted.append(tables[child].select(F.lit(child).alias("table_name"), F.explode(F.array(*cells)).alias("c")).select(
            "table_name", "c.*"))
    keys = [tables[p].select(F.lit(p).alias("parent_name"), F.lit(k).alias("parent_key"), F.col(k).cast("string").alias("value"))
            for p, k in dict.fromkeys((p, k) for _, _, p, k in references)]
    used = reduce(DataFrame.unionAll, counted).filter("value IS NOT NULL").groupBy(
        "table_name", "column_name", "parent_name", "parent_key", "value").agg(F.count(F.lit(1)).alias("n"))
    there = reduce(DataFrame.unionAll, keys)
    return used.join(there, ["parent_name", "parent_key", "value"], "left_anti").select(
        "table_name", "column_name", "parent_name", "value", "n")


def violations(df: DataFrame, table: str, key: str, unique: str | None, not_null: Sequence[str]) -> DataFrame:
    """(table_name, rule, column_name, n): values of the key or the unique column that occur
    more than once, and missing values of columns that must have one; n is 0 where all is well.

    One scan and one shuffle: a row gives its key, its unique value and the columns it lacks.
    """
    said = [("primary key", key, F.col(key).cast("string"))]
    said += [("unique", unique, F.col(unique).cast("string"))] if unique else []
    cells = [F.struct(F.lit(r).alias("rule"), F.lit(c).alias("column_name"), v.alias("value")) for r, c, v in said]
    cells += [F.when(F.col(c).isNull(), F.struct(
        F.lit("not null").alias("rule"), F.lit(c).alias("column_name"), F.lit(None).cast("string").alias("value")))
        for c in not_null]
    counted = df.select(F.explode(F.filter(F.array(*cells), lambda c: c.isNotNull())).alias("c")).select("c.*").groupBy(
        "rule", "column_name", "value").agg(F.count(F.lit(1)).alias("times"))
    broken = F.when(F.col("rule") == "not null", F.col("times")).when(
        F.col("value").isNotNull() & (F.col("times") > 1), 1).otherwise(0)
    found = counted.groupBy("rule", "column_name").agg(F.sum(broken).cast("bigint").alias("n"))
    rules = [(r, c) for r, c, _ in said] + [("not null", c) for c in not_null]
    every = df.sparkSession.createDataFrame(rules, "rule string, column_name string")
    return every.join(found, ["rule", "column_name"], "left").select(
        F.lit(table).alias("table_name"), "rule", "column_name", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
