"""Declared indexes as the order of rows in files.

The bits of the indexed columns' quantiles are interleaved to one number, highest bits first, and rows
are ordered by it.  So the rows of a range or value of any indexed column are in some of the
files only, and the least and largest value that a file states for the column let a reader skip the
others.  The first column of the list gets the first bit: with 2 ** f files, the first f columns
are halved, or each of k < f columns is cut in 2 ** (f / k) parts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import lru_cache
from importlib import resources

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formfold.sources.schemas import declared

BITS, MOST_BITS = 4, 60
SAMPLE = 2_000


@lru_cache(maxsize=1)
def listed() -> dict[str, tuple[str, ...]]:
    lines = (resources.files("formfold") / "specs" / "indexes.txt").read_text(encoding="utf-8").splitlines()
    parts = [line.split(" | ") for line in lines if line and not line.startswith("#")]
    return {name: tuple(columns.split(", ")) for name, columns in parts}


def of_table(table: str) -> tuple[str, ...]:
    return listed().get(f"form {table}", ())


def of_mart(mart: str) -> tuple[str, ...]:
    return listed().get(f"mart {mart}", ())


def keys_of(table: str) -> list[str]:
    """Columns that are looked up by single values."""
    return [c for c, _ in declared(table) if c in ("encounter_id", "uuid", "encounter_uuid")]


def splitters(df: DataFrame, columns: Sequence[str], parts: int, sample: int = SAMPLE) -> dict[str, list]:
    """Values that cut each column in about equal parts, from a random sample of the rows.  They
    decide where rows lie, and nothing else."""
    rows = df.select(*columns).orderBy(F.rand(7)).limit(sample).collect()
    out = {}
    for i, c in enumerate(columns):
        values = sorted(r[i] for r in rows if r[i] is not None)
        cuts = [values[len(values) * k // parts] for k in range(1, parts)] if values else []
        out[c] = list(dict.fromkeys(cuts))
    return out


def literal(value) -> str:
    """SQL of a value of an indexed column."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"DATE '{value}'" if isinstance(value, date) else str(value)


def part_of(column: str, cuts: list) -> str:
    """SQL of how many of the cuts are not above the value; 0 for none."""
    arms = " ".join(f"WHEN {column} < {literal(cut)} THEN {i}" for i, cut in enumerate(cuts))
    return f"CASE WHEN {column} IS NULL THEN 0 {arms} ELSE {len(cuts)} END"


def interleaved(parts: Sequence[str], bits: int) -> str:
    """SQL of the bits of all columns' parts, the highest of each column first."""
    places = [(level, part) for level in range(bits - 1, -1, -1) for part in parts]
    return " | ".join(f"shiftleft(CAST(shiftright({part}, {level}) & 1 AS BIGINT), {len(places) - 1 - i})"
                      for i, (level, part) in enumerate(places))


def laid_out(df: DataFrame, columns: Sequence[str], files: int | None = None,
             made: tuple[DataFrame, Mapping[str, str]] | None = None) -> DataFrame:
    """The rows in the order of the interleaved columns, in `files` ranges of it.

    made: what the rows are made of, and SQL over it of each column.  Then its rows travel and are
    sorted in place of wider ones, and the columns are made behind.
    """
    columns = [c for c in dict.fromkeys(columns) if c in df.columns]
    if not columns:
        return df
    bits = max(1, min(BITS, MOST_BITS // len(columns)))
    source, sql_of = made or (df, {c: f"`{c}`" for c in df.columns})
    names = [f"`{c}`" for c in source.columns]
    cuts = splitters(df, columns, 2 ** bits)
    keyed = source.selectExpr(*names, *[f"{sql_of[c]} AS _index_{i}" for i, c in enumerate(columns)])
    parts = {f"_part_{i}": part_of(f"_index_{i}", cuts[c]) for i, c in enumerate(columns)}
    ranged = keyed.selectExpr(*names, "_index_0", *[f"{sql} AS {part}" for part, sql in parts.items()]).selectExpr(
        *names, "_index_0", f"{interleaved(list(parts), bits)} AS _order")
    ranged = ranged.repartitionByRange(files, "_order") if files else ranged.repartitionByRange("_order")
    rows = ranged.sortWithinPartitions("_order", "_index_0").selectExpr(*names)
    return rows.selectExpr(*[f"{sql_of[c]} AS `{c}`" for c in df.columns])
