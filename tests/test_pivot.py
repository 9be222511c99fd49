"""The fold on hand-made rows."""

import datetime as dt

import pytest

from formfold.catalog import Answers, Rule
from formfold.operators import pivot
from formfold.operators.upsert import upsert

YES_NO = Answers(((1065, "Yes"), (1066, "No")), "")
PLACES = Answers(((1, "illicit brew den"), (2, "Street"), (3, "Highway")), "NA")
RULES = [
    Rule("done", "varchar(10)", "concept", "10", "answers", YES_NO),
    Rule("place", "varchar(4)", "concept", "11", "answers", PLACES),
    Rule("number", "int", "concept", "12", "numeric"),
    Rule("number_text", "varchar(10)", "concept", "12", "numeric"),
    Rule("note", "varchar(5)", "concept", "13", "text"),
    Rule("trimmed", "varchar(20)", "concept", "13", "trimmed text"),
    Rule("leading", "int", "concept", "13", "text"),
    Rule("day", "date", "concept", "14", "datetime"),
    Rule("code", "varchar(100)", "concept", "15", "code"),
    Rule("flagged", "varchar(100)", "concept", "15", "flag", None, 7),
]
SCHEMA = ("encounter_id long, concept_id int, value_coded int, value_numeric double, value_text string, "
          "value_datetime timestamp, voided int")


def fold(spark, rows):
    rows = [r + (None,) * (6 - len(r)) + (0,) if len(r) < 7 else r for r in rows]
    obs = spark.createDataFrame(rows, SCHEMA)
    live = pivot.of_concepts(obs, [10, 11, 12, 13, 14, 15])
    return {r["encounter_id"]: r for r in pivot.eav_pivot(live, RULES).collect()}


def test_answers(spark):
    got = fold(spark, [
        (1, 10, 1066), (1, 10, 1065), (2, 10, None), (3, 10, 42), (4, 12, None, 1.0),
        (5, 10, 1065, None, None, None, 1),
    ])
    assert got[1]["done"] == "Yes"          # of two answers the larger label
    assert got[2]["done"] == ""             # a null code is answered, with the other-label
    assert got[3]["done"] == ""             # so is an unlisted one
    assert got[4]["done"] is None           # no observation, no value
    assert 5 not in got                     # voided


def test_label_order_ignores_case_and_cut_comes_last(spark):
    got = fold(spark, [(1, 11, 1), (1, 11, 2), (1, 11, 3), (2, 11, 9), (2, 11, 3)])
    assert got[1]["place"] == "Stre" and got[2]["place"] == "NA"


def test_numbers(spark):
    got = fold(spark, [
        (1, 12, None, 2.5), (2, 12, None, -2.5), (3, 12, None, 2009.0), (4, 12, None, 1e12),
        (5, 12, None, 7.25), (6, 10, 1065)])
    assert [got[i]["number"] for i in (1, 2, 3, 4)] == [3, -3, 2009, 2147483647]
    assert got[3]["number_text"] == "2009" and got[5]["number_text"] == "7.25"
    assert got[6]["number"] is None and got[6]["number_text"] is None


def test_text(spark):
    got = fold(spark, [
        (1, 13, None, None, "apple pie"), (1, 13, None, None, "Banana"), (2, 13, None, None, "  12 days"),
        (3, 13, None, None, "none"), (4, 13, None, None, "99999999999")])
    assert got[1]["note"] == "Banan" and got[1]["trimmed"] == "Banana"
    assert got[2]["trimmed"] == "12 days" and got[2]["leading"] == 12
    assert got[3]["leading"] == 0 and got[4]["leading"] == 2147483647


def test_dates_codes_and_flags(spark):
    day = dt.datetime(2024, 3, 5, 23, 30)
    got = fold(spark, [(1, 14, None, None, None, day), (1, 15, 5), (1, 15, 7), (2, 15, 8)])
    assert got[1]["day"] == dt.date(2024, 3, 5)
    assert got[1]["code"] == "7" and got[1]["flagged"] == "7"
    assert got[2]["code"] == "8" and got[2]["flagged"] is None


def test_one_encounter_with_a_third_of_all_rows(spark):
    obs = spark.range(0, 60000, 1, 16).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS encounter_id", "12 AS concept_id",
        "CAST(NULL AS INT) AS value_coded", "CAST(id AS DOUBLE) AS value_numeric",
        "CAST(NULL AS STRING) AS value_text", "CAST(NULL AS TIMESTAMP) AS value_datetime", "0 AS voided")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        got = pivot.eav_pivot(obs, RULES[2:3])
        assert got.count() == 40001
        assert got.filter("encounter_id = 0").first()["number"] == 59997
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


@pytest.mark.parametrize("columns", [None, ["b"]])
def test_upsert(spark, columns):
    target = spark.createDataFrame([(1, "a", "x", 0), (2, "b", "y", 0), (4, "d", "w", 0)],
                                   "k int, a string, b string, voided int")
    changes = spark.createDataFrame([(2, "B", None, 0), (3, "C", "z", 0)],
                                    "k int, a string, b string, voided int")
    got = {r["k"]: tuple(r)[1:] for r in upsert(target, changes, "k", columns).collect()}
    assert got[1] == ("a", "x", 0) and got[3] == ("C", "z", 0) and len(got) == 4
    assert got[2] == (("B", None, 0) if columns is None else ("b", None, 0))


def test_upsert_flags_rows_that_were_recomputed_away(spark):
    target = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, a string, voided int")
    changes = spark.createDataFrame([], "k int, a string, voided int")
    keys = spark.createDataFrame([(2,)], "k int")
    got = {r["k"]: r["voided"] for r in upsert(target, changes, "k", recomputed=keys).collect()}
    assert got == {1: 0, 2: 1}
