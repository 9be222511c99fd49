"""How alike two names are, as a Spark expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published measures.
# Jaro's measure counts letters that both names have at about the same place; Winkler's adds a
# tenth of what is missing for each of up to four letters at the start, where it is above 0.7.
PREFIX, WEIGHT, ABOVE = 4, 0.1, 0.7


def jaro_winkler(first: str, second: str) -> Column:
    """The likeness of two columns, from 0 to 1, letter by letter; 0 for an empty name, and
    null where a name is missing."""
    # one SQL text: the letters of the first name are walked once, and each takes the nearest
    # letter to its left or right that is still there
    pair = f"named_struct('a', {first}, 'b', {second}, 'n', length({first}), 'm', length({second}))"
    reach = "greatest((greatest(p.n, p.m) div 2) - 1, 0)"
    low = f"greatest(i - {reach}, 1)"
    within = f"substring(s.left, {low}, greatest(least(i + {reach}, p.m) - {low} + 1, 0))"
    place = f"int({low} - 1 + locate(substring(p.a, i, 1), {within}))"
    mark = "overlay(s.left PLACING '\\u0000' FROM h.place FOR 1)"
    step = (f"transform(array(named_struct('found', locate(substring(p.a, i, 1), {within}), 'place', {place})), h -> "
            f"if(h.found > 0, named_struct('left', {mark}, 'got', concat(s.got, substring(p.a, i, 1))), s))[0]")
    walk = f"aggregate(sequence(1, p.n), named_struct('left', p.b, 'got', ''), (s, i) -> {step})"
    theirs = "aggregate(sequence(1, p.m), '', (x, j) -> if(substring(w.left, j, 1) = '\\u0000', concat(x, substring(p.b, j, 1)), x))"
    apart = "size(filter(sequence(1, length(w.got)), k -> substring(w.got, k, 1) <> substring(y, k, 1)))"
    share = "length(w.got) / p.n + length(w.got) / p.m"
    jaro = (f"transform(array({walk}), w -> if(w.got = '', 0D, transform(array({theirs}), y -> "
            f"double(({share} + (length(w.got) - ({apart} div 2)) / length(w.got)) / 3))[0]))[0]")
    same = f"size(filter(sequence(1, least(p.n, p.m, {PREFIX})), k -> substring(p.a, 1, k) = substring(p.b, 1, k)))"
    liked = f"transform(array({jaro}), j -> if(j > {ABOVE}D, j + {same} * {WEIGHT}D * (1 - j), j))[0]"
    return F.expr(f"transform(array({pair}), p -> CASE WHEN p.n IS NULL OR p.m IS NULL THEN NULL "
                  f"WHEN p.n = 0 OR p.m = 0 THEN 0D ELSE {liked} END)[0]")
