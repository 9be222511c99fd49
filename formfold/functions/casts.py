"""Explicit forms of the silent conversions of a non-strict SQL server.

Each function takes and gives SQL text: a table has up to a hundred such columns,
and one parsed text per column is far cheaper to plan than nested function calls.
"""

from __future__ import annotations

INT_MIN, INT_MAX = -2147483648, 2147483647


def _bounded(x: str) -> str:
    # least() and greatest() skip nulls, so the null test has to come first
    return f"CASE WHEN {x} IS NOT NULL THEN CAST(least(greatest({x}, {INT_MIN}), {INT_MAX}) AS INT) END"


def round_to_int(x: str) -> str:
    """Half away from zero; out of range goes to the nearest bound, not an error."""
    return _bounded(f"round({x})")


def number_to_text(x: str) -> str:
    """Plain digits without trailing zeros; exponents only where 38 digits do not suffice."""
    shown = f"CAST({x} AS STRING)"
    plain = f"regexp_replace(CAST(try_cast({shown} AS DECIMAL(38, 18)) AS STRING), '[.]?0+$', '')"
    whole = f"CAST(try_cast({shown} AS DECIMAL(38, 0)) AS STRING)"
    return f"CASE WHEN {x} = 0 THEN '0' ELSE coalesce({plain}, {whole}, {shown}) END"


def leading_number(x: str) -> str:
    """The leading whole number of a text as a decimal, so that a long run of digits is not lost."""
    digits = f"regexp_extract({x}, '^[ \\t\\n]*([+-]?[0-9]+)', 1)"
    return f"try_cast({digits} AS DECIMAL(38, 0))"


def leading_int(x: str) -> str:
    """The leading whole number of a text, bounded; 0 when it has none, null for null."""
    return f"CASE WHEN {x} IS NOT NULL THEN coalesce({_bounded(leading_number(x))}, 0) END"


def lost(x: str, kind: str, type_: str, width: int | None) -> tuple[str, str] | None:
    """What ``fit`` takes away from a value ("cut" to a width, "bounded" to an int), and the SQL
    test for it; None where it can take nothing."""
    if type_ == "int" and kind in ("numeric", "text", "trimmed text"):
        number = f"round({x})" if kind == "numeric" else leading_number(x)
        return "bounded", f"{number} NOT BETWEEN {INT_MIN} AND {INT_MAX}"
    if width and kind in ("numeric", "text", "trimmed text"):
        return "cut", f"length({number_to_text(x) if kind == 'numeric' else x}) > {width}"
    return None


def fit(x: str, kind: str, type_: str, width: int | None) -> str:
    """Bring an aggregated value of the given kind into its column type."""
    if type_ == "date":
        return f"CAST({x} AS DATE)"
    if type_ == "int":
        if kind == "numeric":
            return round_to_int(x)
        return leading_int(x) if kind in ("text", "trimmed text") else f"CAST({x} AS INT)"
    if kind == "numeric":
        x = number_to_text(x)
    elif kind in ("code", "flag"):
        x = f"CAST({x} AS STRING)"
    return f"substring({x}, 1, {width})" if width else x
