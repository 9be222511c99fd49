"""The client registry: one row per person, with names, attributes, identifiers
and address brought in by update-joins."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formfold.operators import pivot
from formfold.operators.joins import (
    attributes_by_type,
    first_row,
    identifiers_by_type,
    update_join,
)
from formfold.plans.metadata import ADDRESS_FIELDS, ATTRIBUTE_TYPES, IDENTIFIER_TYPES
from formfold.sources.curated import typed
from formfold.sources.schemas import schema_of

NAMES = ("given_name", "middle_name", "family_name")


def persons(
    records: Mapping[str, DataFrame], keys: DataFrame | None = None, keep_voided: bool = False
) -> DataFrame:
    """Persons with their name of the lowest id.

    Being a patient is not asked for, so every person becomes a client.
    """
    person, names = records["person"], pivot.live(records["person_name"])
    if not keep_voided:
        person = pivot.live(person)
    if keys is not None:
        person = person.join(keys, "person_id", "left_semi")
        names = names.join(keys, "person_id", "left_semi")
    named = first_row(names, "person_id", "person_name_id", NAMES)
    return person.join(named, "person_id", "left").select(
        F.col("person_id").alias("client_id"),
        F.to_date("date_created").alias("registration_date"),
        *NAMES,
        F.col("gender").alias("Gender"),
        F.to_date("birthdate").alias("DOB"),
        "dead",
        F.to_date("death_date").alias("death_date"),
        "voided",
    )


def attributes(records: Mapping[str, DataFrame]) -> DataFrame:
    return attributes_by_type(records, ATTRIBUTE_TYPES).withColumnRenamed("person_id", "client_id")


def identifiers(records: Mapping[str, DataFrame]) -> DataFrame:
    return identifiers_by_type(records, IDENTIFIER_TYPES).withColumnRenamed(
        "patient_id", "client_id")


def addresses(records: Mapping[str, DataFrame]) -> DataFrame:
    """The live address of the lowest id of each person."""
    fields = [F.col(f).alias(c) for c, f in ADDRESS_FIELDS.items()]
    live = pivot.live(records["person_address"]).select(
        F.col("person_id").alias("client_id"), "person_address_id", *fields)
    return first_row(live, "client_id", "person_address_id", list(ADDRESS_FIELDS))


def with_details(clients: DataFrame, records: Mapping[str, DataFrame]) -> DataFrame:
    """Bring attributes, identifiers and addresses into registry rows."""
    missing = [f for f in schema_of("client_registration").names if f not in clients.columns]
    clients = clients.select("*", *[F.lit(None).cast("string").alias(c) for c in missing])
    clients = update_join(clients, attributes(records), "client_id", "outer")
    clients = update_join(clients, identifiers(records), "client_id")
    return update_join(clients, addresses(records), "client_id")


def build(
    records: Mapping[str, DataFrame], keys: DataFrame | None = None, keep_voided: bool = False
) -> DataFrame:
    return with_details(persons(records, keys, keep_voided), records).transform(typed, "client_registration")

