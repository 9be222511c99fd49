"""Coded answers to labels, as SQL texts (see ``casts`` for why)."""

from __future__ import annotations

from formfold.catalog import Answers


def text_literal(value: str | None) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _case(column: str, arms, other: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {c} THEN {v}" for c, v in arms) + f" ELSE {other} END"


def label(column: str, answers: Answers) -> str:
    """Label of a code; a null or unlisted code gets the other-label."""
    arms = [(code, text_literal(text)) for code, text in answers.labels]
    return _case(column, arms, text_literal(answers.other))


def place(column: str, answers: Answers) -> str:
    """SQL for the place of a code's label in ``answers.distinct()``, from 0."""
    places = {text: i for i, text in enumerate(answers.distinct())}
    return _case(column, [(code, places[text]) for code, text in answers.labels], str(places[answers.other]))


def packed_label(placed: str, answers: Answers) -> str:
    """Label at a place."""
    return f"get(array({', '.join(map(text_literal, answers.distinct()))}), CAST({placed} AS INT))"


def rank(column: str, answers: Answers) -> str:
    """SQL for the position of a code's label in ``answers.ranked()``, from 1.

    Ranks are ints of fixed width: they need no copy of a text per answer.  (A fold that
    also takes the maximum of a text sorts all the same; see README for both measured.)
    """
    place = {text: i for i, text in enumerate(answers.ranked(), 1)}
    arms = [(code, place[text]) for code, text in answers.labels]
    return _case(column, arms, str(place[answers.other]))


def from_rank(ranked: str, answers: Answers, width: int | None) -> str:
    """Label at a rank, cut to the column width (the cut comes after the max)."""
    labels = [text[:width] if width else text for text in answers.ranked()]
    # not element_at: in ANSI mode it is taken as never null, even for a null position
    return f"try_element_at(array({', '.join(map(text_literal, labels))}), {ranked})"
