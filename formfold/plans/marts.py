"""The 26 reporting marts: carried columns plus coded columns turned to labels."""

from __future__ import annotations

from pyspark.sql import DataFrame

from formfold.catalog import Answers, Catalog, Mart, default_catalog
from formfold.functions.decode import label, packed_label, place


WORD = 63


def dependent(column: str, by: str, cases: tuple[tuple[int, Answers], ...]) -> str:
    """Label by the value of another column; any other value passes the code through."""
    arms = " ".join(f"WHEN {value} THEN {label(column, answers)}" for value, answers in cases)
    return f"CASE {by} {arms} ELSE CAST({column} AS STRING) END"


def expressions(source: DataFrame, mart: Mart) -> dict[str, str]:
    """SQL over the source of each column of the mart."""
    if mart.everything:
        return {c: f"`{c}`" for c in source.columns}
    return {
        **{c: c for c in mart.carried},
        **{c: label(c, answers) for c, answers in mart.decoded},
        **{c: dependent(c, by, cases) for c, by, cases in mart.dependent},
    }


def packed(source: DataFrame, mart: Mart) -> tuple[DataFrame, dict[str, str]]:
    """The rows a mart is made of in few bytes, and SQL over them of each of its columns.

    A coded column is the place of its label among the labels of its rule, and places take as many
    bits as they need, side by side in BIGINTs.
    """
    made = expressions(source, mart)
    if mart.everything:
        return source, made
    words: list[list[str]] = []
    used = WORD
    for column, answers in mart.decoded:
        bits = max(1, (len(answers.distinct()) - 1).bit_length())
        if used + bits > WORD:
            words.append([])
            used = 0
        words[-1].append(f"shiftleft(CAST({place(column, answers)} AS BIGINT), {used})")
        made[column] = packed_label(f"shiftright(_word_{len(words) - 1}, {used}) & {2 ** bits - 1}", answers)
        used += bits
    kept = dict.fromkeys([*mart.carried, *[x for c, by, _ in mart.dependent for x in (c, by)]])
    return source.selectExpr(*kept, *[f"{' | '.join(w)} AS _word_{i}" for i, w in enumerate(words)]), made


def select(source: DataFrame, mart: Mart) -> DataFrame:
    if mart.everything:
        return source
    return source.selectExpr(*[f"{sql} AS {c}" for c, sql in expressions(source, mart).items()])


def build(upstream: dict[str, DataFrame], name: str, catalog: Catalog | None = None) -> DataFrame:
    mart = (catalog or default_catalog()).mart(name)
    return select(upstream[mart.source], mart)
