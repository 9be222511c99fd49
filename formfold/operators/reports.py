"""Run history, cross-tabs and the JSON form of the registry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formfold.sources.staging import shared_folder, written

PAGE = 10


def run_history(runs: DataFrame, page: int = PAGE) -> DataFrame:
    """The newest runs.  Only the page is kept per task, the whole log is never sorted."""
    newest = runs.orderBy(F.desc("start_time"), F.desc("id")).limit(page)
    return newest.select(
        "script_name",
        *[F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("")).alias(c)
          for c in ("start_time", "stop_time")],
        F.when(F.col("error").isNotNull(), "Pending").otherwise("Success").alias("status"),
    )


def retained(runs: DataFrame, names: Sequence[str], now=None, hours: int = 12) -> DataFrame:
    """Runs without those of the given names that started before the limit."""
    limit = (now if now is not None else F.current_timestamp()) - F.expr(f"INTERVAL {hours} HOURS")
    old = F.col("script_name").isin(list(names)) & (F.col("start_time") < limit)
    return runs.filter(~F.coalesce(old, F.lit(False)))


def cross_tab(df: DataFrame, row: str, column: str, measure=None) -> DataFrame:
    """Long cross-tab: one line per cell with its totals and its place.

    Rows and columns are both placed by falling total.  Cells are counted map-side;
    what is totalled and placed after that is one line per cell.
    """
    value = F.count(F.lit(1)) if measure is None else F.sum(measure)
    cells = written(df.groupBy(row, column).agg(value.alias("value")), "cells", shared_folder(df.sparkSession))
    rows = placed(cells, row, "row")
    columns = placed(cells, column, "column")
    for axis, totals in ((row, rows), (column, columns)):  # a missing value is a line too
        own = totals.withColumnRenamed(axis, "_axis")
        cells = cells.join(own, F.col(axis).eqNullSafe(F.col("_axis"))).drop("_axis")
    return cells


def placed(cells: DataFrame, axis: str, name: str) -> DataFrame:
    """Totals of one axis and their places; as many lines as the axis has values."""
    totals = cells.groupBy(axis).agg(F.sum("value").alias(f"{name}_total"))
    order = [F.desc(f"{name}_total"), F.asc(axis)]
    # sorted by range over all tasks and written, so that a task can count its own rows
    folder = shared_folder(cells.sparkSession)
    ranged = written(
        totals.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), f"{name}-totals", folder)
    before = Window.orderBy("_range")  # one line per task
    starts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", (F.sum("_n").over(before) - F.col("_n")).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.withColumn("_own", own).join(starts, "_range").select(
        axis, f"{name}_total", (F.col("_own") + F.col("_before")).cast("int").alias(f"{name}_place"))


def cross_tab_sets(df: DataFrame, pairs: Sequence[tuple[str, str]], measure: str) -> DataFrame:
    """Long cross-tabs of several pairs of axes from one scan: (row_axis, column_axis, row_value,
    column_value, records, total, row_total, row_place, column_total, column_place).

    Cells of all pairs are one aggregate over grouping sets.  Both axes of a pair are placed by
    falling total; what is placed is one line per value of an axis.
    """
    axes = list(dict.fromkeys(a for pair in pairs for a in pair))
    sets = [[F.col(a), F.col(b)] for a, b in pairs]
    grouped = df.groupingSets(sets, *[F.col(a) for a in axes]).agg(
        F.count(F.lit(1)).alias("records"), F.sum(measure).alias("total"), F.grouping_id().alias("_set"))
    text = lambda a: F.col(a).cast("string")
    number = lambda pair: sum(1 << (len(axes) - 1 - i) for i, a in enumerate(axes) if a not in pair)
    of_pair = [F.when(F.col("_set") == number((a, b)), F.struct(
        F.lit(a).alias("row_axis"), F.lit(b).alias("column_axis"), text(a).alias("row_value"), text(b).alias("column_value")))
        for a, b in pairs]
    cells = grouped.select(F.explode(F.filter(F.array(*of_pair), lambda c: c.isNotNull())).alias("c"), "records", "total").select(
        "c.*", "records", "total")
    cells = written(cells, "cells", shared_folder(df.sparkSession))
    pair = ["row_axis", "column_axis"]
    for axis in ("row", "column"):
        value, total = f"{axis}_value", f"{axis}_total"
        totals = cells.groupBy(*pair, value).agg(F.sum("total").alias(total))
        order = Window.partitionBy(*pair).orderBy(F.desc(total), F.asc(value))
        totals = totals.withColumn(f"{axis}_place", F.row_number().over(order)).select(
            *[F.col(c).alias(f"_{c}") for c in (*pair, value)], total, f"{axis}_place")
        same = [F.col(c) == F.col(f"_{c}") for c in pair] + [F.col(value).eqNullSafe(F.col(f"_{value}"))]
        cells = cells.join(totals, same).drop(*[f"_{c}" for c in (*pair, value)])
    return cells


def cross_tab_wide(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Wide cross-tab over known column values, ordered by falling row total.  Rows of any
    other value, or of none, count in ``other`` and in the total."""
    cell = F.col(column)
    known = F.coalesce(cell.isin(list(values)), F.lit(False))
    wide = df.groupBy(row).agg(
        *[F.count_if(cell == v).alias(v) for v in values], F.count_if(~known).alias("other"),
        F.count(F.lit(1)).alias("_total"))
    return wide.orderBy(F.desc("_total"), F.asc(row)).drop("_total")


def as_json(df: DataFrame, column: str = "patient") -> DataFrame:
    """One JSON object per row, missing values kept as null."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(column))


def dump_json(df: DataFrame, path: str) -> None:
    """The same as line-delimited JSON files, written by all tasks at once."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
