"""Declared schemas of the curated tables and of the run log."""

from __future__ import annotations

import re

from pyspark.sql import types as T

from formfold.catalog import FORMS, default_catalog

CURATED = ("client_registration", *FORMS)

# Registry columns and the widths of its text columns.
REGISTRY = """
client_id int, registration_date date, given_name varchar(255), middle_name varchar(255),
family_name varchar(255), Gender varchar(10), DOB date, alias_name varchar(255),
postal_address varchar(255), county varchar(255), sub_county varchar(255),
location varchar(255), sub_location varchar(255), village varchar(255),
phone_number varchar(255), alt_phone_number varchar(255), email_address varchar(255),
national_id_number varchar(50), passport_number varchar(50), dead int, death_date date,
voided int
"""
RUN_LOG = "id string, script_name string, start_time timestamp, stop_time timestamp, error string"

# record keys outgrow 32 bits at the intended scale
WIDE_KEYS = ("client_id", "encounter_id", "visit_id")
KEY = {"client_registration": "client_id"}
NOT_NULL = {
    "client_registration": ("client_id",),
    "hts_test": ("client_id", "encounter_id", "encounter_uuid", "encounter_location",
                 "creator", "date_created"),
}


def key_of(table: str) -> str:
    return KEY.get(table, "encounter_id")


def declared(table: str) -> list[tuple[str, str]]:
    """(column, declared type) in table order."""
    if table == "client_registration":
        return [tuple(part.split()) for part in REGISTRY.replace("\n", " ").split(", ")]
    return [(r.name, r.type) for r in default_catalog().form(table).columns]


def not_null(table: str) -> tuple[str, ...]:
    return NOT_NULL.get(table, ("client_id", "encounter_id"))


def uuid_column(table: str) -> str | None:
    """The column under a uniqueness rule, if the table has one."""
    return "uuid" if "uuid" in [c for c, _ in declared(table)] else None


def references(table: str) -> bool:
    """Whether the table's client must be in the registry."""
    return table not in ("client_registration", "hts_test")


def declared_references() -> list[tuple[str, str, str, str]]:
    """(table, column, parent table, parent column) of every declared reference: the encounter
    tables refer to the registry, and every mart to the demographics of its patient."""
    out = [(t, "client_id", "client_registration", "client_id") for t in CURATED if references(t)]
    parent = "patient_demographics"
    return out + [(f"mart.{m}", "patient_id", f"mart.{parent}", "patient_id") for m in default_catalog().marts() if m != parent]


def spark_type(name: str, declared_type: str) -> T.DataType:
    if declared_type == "date":
        return T.DateType()
    if declared_type == "int":
        return T.LongType() if name in WIDE_KEYS else T.IntegerType()
    return T.StringType()


def width(declared_type: str) -> int | None:
    m = re.search(r"\((\d+)\)", declared_type)
    return int(m.group(1)) if m else None


def schema_of(table: str) -> T.StructType:
    if table == "run_log":
        return T.StructType.fromDDL(RUN_LOG)
    return T.StructType([
        T.StructField(c, spark_type(c, t), c not in not_null(table)) for c, t in declared(table)])
