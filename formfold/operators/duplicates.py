"""Clients that may be the same person.

Clients sharing the sound of both names, the gender and a birth-date window form
a group; each member is linked to the group's lowest client id and scored by edit
distance and by Jaro-Winkler similarity (six digits).  The output grows with the clients, not
with the pairs of a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formfold.functions.likeness import jaro_winkler
from formfold.functions.names import codes
from formfold.sources.staging import shared_folder, written

BLOCK = ["given_code", "family_code", "gender", "window"]


def sounds(name: str):
    """The one or two distinct codes of a name."""
    return F.array_distinct(F.array(f"{name}.code_primary", f"{name}.code_secondary"))


def blocks(registry: DataFrame, window_days: int) -> DataFrame:
    """One row per client and block it belongs to.

    Two windowings, half a window apart, so that birth dates closer than half a
    window always meet in one of them.
    """
    day = F.unix_date("DOB")
    halves = [F.floor(day / window_days) * 2, F.floor((day + window_days // 2) / window_days) * 2 + 1]
    coded = registry.select(
        "client_id",
        F.col("Gender").alias("gender"),
        F.concat_ws(" ", "given_name", "family_name").alias("full_name"),
        codes("given_name").alias("given"),
        codes("family_name").alias("family"),
        F.array(*halves).alias("windows"),
    )
    return (
        coded.withColumn("given_code", F.explode(sounds("given")))
        .withColumn("family_code", F.explode(sounds("family")))
        .withColumn("window", F.explode("windows"))
        .select("client_id", "full_name", *BLOCK)
        # after the explodes: a filter on the codes themselves would compute them twice
        .filter("given_code <> '' AND family_code <> '' AND window IS NOT NULL")
    )


def duplicate_candidates(registry: DataFrame, window_days: int = 366) -> DataFrame:
    """(client_id, first_client_id, distance, similarity): members of a group and their
    group's first client, once per pair."""
    folder = shared_folder(registry.sparkSession)
    member = written(blocks(registry, window_days), "name-blocks", folder)  # used twice below
    group = member.groupBy(*BLOCK).agg(
        F.min_by(F.struct("client_id", "full_name"), "client_id").alias("first"),
        F.count(F.lit(1)).alias("n"),
    ).filter("n > 1")
    # one row per block on the right; a hot block splits on the left
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"g.{c}")) for c in BLOCK]  # no gender is a gender too
    linked = member.alias("m").join(group.alias("g"), same).filter("client_id <> first.client_id")
    pairs = linked.select(
        "client_id", F.col("first.client_id").alias("first_client_id"),
        "full_name", F.col("first.full_name").alias("first_name")).distinct()
    return pairs.select(
        "client_id", "first_client_id", F.levenshtein("full_name", "first_name").alias("distance"),
        F.round(jaro_winkler("full_name", "first_name"), 6).alias("similarity"))
