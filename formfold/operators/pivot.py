"""Observations (entity, concept, value) folded into one wide row per encounter.

The observations travel while they are narrow (six columns, the unused value
columns emptied), gathered by a hash of the key with ``rebalance``.  Folding a
hundred columns before that shuffle would send one mostly empty wide row per
observation wherever the table is not stored by encounter.  After it, the partial
fold sees whole encounters and emits about one row each; because adaptive
execution may split an oversized partition of the gathering shuffle, an encounter
holding any share of all rows is folded by several tasks, and the final fold merges
their few rows.  The join with the encounter table comes last, one row against one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formfold.catalog import Rule
from formfold.functions import casts, decode

TEXT_KINDS = ("text", "trimmed text")


def live(df: DataFrame) -> DataFrame:
    return df.filter("voided = 0")


def of_concepts(obs: DataFrame, concepts: Sequence[int]) -> DataFrame:
    """Live observations of the listed concepts (both tests reach the scan)."""
    return live(obs).filter(F.col("concept_id").isin(list(concepts)))


def measure(rule: Rule) -> str:
    """SQL of the partial-combinable aggregate of one rule."""
    hit = f"concept_id = {rule.key}"
    if rule.kind == "answers":
        value = decode.rank("value_coded", rule.answers)
    elif rule.kind == "flag":
        hit, value = f"{hit} AND value_coded = {rule.flag}", str(rule.flag)
    elif rule.kind in TEXT_KINDS:
        raw = "trim(value_text)" if rule.kind == "trimmed text" else "value_text"
        return f"max(CASE WHEN {hit} THEN struct(lower({raw}) AS folded, {raw} AS raw) END).raw"
    else:
        value = VALUE_OF[rule.kind]
    return f"max(CASE WHEN {hit} THEN {value} END)"


VALUE_OF = {
    "numeric": "value_numeric", "datetime": "value_datetime",
    "text": "value_text", "trimmed text": "value_text",
    "answers": "value_coded", "code": "value_coded", "flag": "value_coded",
}


def gathered(
    obs: DataFrame, rules: Sequence[Rule], keys: Sequence[str], coded: Sequence[int] = (),
    clustered: bool = False,
) -> DataFrame:
    """Observations of a key in one place, with only the values some rule reads.

    Gathering is by a hash column and not by the key itself, so that the planner
    does not take it for the final grouping and skewed partitions may be split.
    Observations that are stored ``clustered`` by key stay where they are.
    """
    wanted: dict[str, set[int]] = {}
    for rule in rules:
        wanted.setdefault(VALUE_OF[rule.kind], set()).add(rule.concept)
    if coded:
        wanted.setdefault("value_coded", set()).update(coded)
    values = [
        F.when(F.col("concept_id").isin(sorted(concepts)), F.col(column)).alias(column)
        for column, concepts in wanted.items()
    ]
    slim = obs.select(*keys, "concept_id", *values)
    if clustered:
        return slim
    return slim.withColumn("gather", F.xxhash64(keys[0])).hint("rebalance", "gather")


def finish(rule: Rule) -> str:
    """SQL of the aggregated value as the column type wants it."""
    if rule.kind == "answers":
        return decode.from_rank(rule.name, rule.answers, rule.width)
    return casts.fit(rule.name, rule.kind, rule.type, rule.width)


def lost(rule: Rule) -> tuple[str, str] | None:
    """What the column type takes away from the aggregated value, and the SQL test for it."""
    if rule.kind == "answers" and rule.width:
        shown = decode.from_rank(rule.name, rule.answers, None)
        longer = any(len(text) > rule.width for text in rule.answers.ranked())
        return "cut", f"length({shown}) > {rule.width}" if longer else "false"
    return casts.lost(rule.name, rule.kind, rule.type, rule.width)


def count_lost(folded: DataFrame, rules: Sequence[Rule], prefix: str = "") -> DataFrame:
    """(column_name, lost, n) of the rules' columns where something can be lost, in one pass."""
    tests = {r.name: lost(r) for r in rules if lost(r)}
    counts = folded.agg(*[F.expr(f"count_if({test}) AS {name}") for name, (_, test) in tests.items()])
    what = F.coalesce(*[F.when(F.col("column_name").isin([n for n, (w, _) in tests.items() if w == kind]), F.lit(kind))
                        for kind in ("cut", "bounded")])
    return counts.unpivot([], list(tests), "column_name", "n").select(
        F.concat(F.lit(prefix), "column_name").alias("column_name"), what.alias("lost"), "n")


def eav_pivot(
    obs: DataFrame,
    rules: Sequence[Rule],
    keys: Sequence[str] = ("encounter_id",),
    marks: Mapping[str, tuple[int, str]] | None = None,
    clustered: bool = False,
) -> DataFrame:
    """One row per key with every rule's column, typed.

    ``marks`` are further aggregates by name: the concept whose codes they read,
    and their SQL.
    """
    folded = fold(obs, rules, keys, marks, clustered)
    return folded.selectExpr(*keys, *[f"{finish(r)} AS {r.name}" for r in rules], *(marks or {}))


def fold(
    obs: DataFrame,
    rules: Sequence[Rule],
    keys: Sequence[str],
    marks: Mapping[str, tuple[int, str]] | None = None,
    clustered: bool = False,
) -> DataFrame:
    """The same before the columns get their types: ranks, numbers, moments and texts."""
    keys, marks = list(keys), marks or {}
    rows = gathered(obs, rules, keys, [concept for concept, _ in marks.values()], clustered)
    return rows.groupBy(*keys).agg(
        *[F.expr(f"{measure(r)} AS {r.name}") for r in rules],
        *[F.expr(f"{sql} AS {name}") for name, (_, sql) in marks.items()])


def wide(df: DataFrame, keys: Sequence, by: str, value: str, columns: Mapping[str, str], other: str | None = None) -> DataFrame:
    """One row per key with the largest value of each listed value of ``by`` ({value: column}),
    and of all others in ``other``."""
    cells = [F.max(F.when(F.col(by) == v, F.col(value))).alias(c) for v, c in columns.items()]
    if other:
        cells.append(F.max(F.when(~F.col(by).isin(list(columns)), F.col(value))).alias(other))
    return df.groupBy(*keys).agg(*cells)


def folded_again(rule: Rule) -> str:
    """SQL that folds a rule's folded values further."""
    if rule.kind in TEXT_KINDS:
        return f"max(struct(lower({rule.name}) AS folded, {rule.name} AS raw)).raw AS {rule.name}"
    return f"max({rule.name}) AS {rule.name}"
