"""Clinical record tables as views over a star-schema sales data set.

Every row of every base table takes part; the remainders below spread types,
flags and kinds of values over the rows, they select nothing.  A gap is a voided row.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formfold.catalog import Catalog, Mart, default_catalog
from formfold.plans.metadata import (
    ATTRIBUTE_TYPES,
    CONTACT_IDENTIFIER,
    ENCOUNTER_TYPES,
    IDENTIFIER_TYPES,
    KIT_CONCEPTS_SAMPLE,
    TEST_FORMS,
)

VIEWS = {
    "encounter": """
        SELECT o_orderkey AS encounter_id,
               o_custkey AS patient_id,
               CAST(o_orderkey % 7 AS INT) AS encounter_type,
               CAST(o_orderdate AS TIMESTAMP) AS encounter_datetime,
               o_orderkey + 500000 AS visit_id,
               CAST(o_custkey % 11 AS INT) AS location_id,
               CAST(o_orderkey % 13 AS INT) AS creator,
               CONCAT('enc-', CAST(o_orderkey AS STRING)) AS uuid,
               CAST(1 + (o_orderkey + o_custkey) % 2 AS INT) AS form_id,
               CAST(CASE WHEN o_orderkey % 23 = 0 THEN 1 ELSE 0 END AS INT) AS voided,
               CAST(DATE '2024-01-01' + CAST(o_orderkey % 60 AS INT) AS TIMESTAMP) AS date_created,
               CASE WHEN o_orderkey % 5 = 0
                    THEN CAST(DATE '2024-03-01' + CAST(o_orderkey % 30 AS INT) AS TIMESTAMP) END AS date_changed,
               CASE WHEN o_orderkey % 23 = 0
                    THEN CAST(DATE '2024-03-05' + CAST(o_orderkey % 20 AS INT) AS TIMESTAMP) END AS date_voided
        FROM {orders}""",
    "person": """
        SELECT c_custkey AS person_id,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               DATE '1950-01-01' + CAST(c_custkey * 37 % 20000 AS INT) AS birthdate,
               CAST(CASE WHEN c_custkey % 50 = 0 THEN 1 ELSE 0 END AS INT) AS dead,
               CASE WHEN c_custkey % 50 = 0 THEN DATE '2023-06-01' END AS death_date,
               CAST(CASE WHEN c_custkey % 29 = 0 THEN 1 ELSE 0 END AS INT) AS voided,
               CAST(DATE '2024-01-01' + CAST(c_custkey % 75 AS INT) AS TIMESTAMP) AS date_created,
               CASE WHEN c_custkey % 6 = 0 THEN CAST(DATE '2024-03-02' AS TIMESTAMP) END AS date_changed,
               CASE WHEN c_custkey % 29 = 0 THEN CAST(DATE '2024-03-03' AS TIMESTAMP) END AS date_voided
        FROM {customer}""",
    "person_name": """
        SELECT c_custkey * 2 + k AS person_name_id,
               c_custkey AS person_id,
               CASE WHEN k = 0 THEN c_mktsegment ELSE CONCAT(c_mktsegment, 'a') END AS given_name,
               CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE n_name END AS middle_name,
               c_name AS family_name,
               CAST(CASE WHEN (c_custkey + k) % 13 = 0 OR k = 1 AND c_custkey % 3 <> 0 THEN 1 ELSE 0 END AS INT) AS voided,
               CAST(DATE '2024-01-01' + CAST(c_custkey % 70 AS INT) AS TIMESTAMP) AS date_created,
               CAST(NULL AS TIMESTAMP) AS date_changed,
               CAST(NULL AS TIMESTAMP) AS date_voided
        FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey
        LATERAL VIEW explode(array(0, 1)) kk AS k""",
    "patient": """
        SELECT c_custkey AS patient_id,
               CAST(CASE WHEN c_custkey % 31 = 0 OR c_custkey % 10 = 0 THEN 1 ELSE 0 END AS INT) AS voided
        FROM {customer}""",
    "person_attribute": """
        SELECT c_custkey AS person_id,
               t AS person_attribute_type_id,
               CONCAT('v', CAST(c_custkey * 10 + t AS STRING)) AS value,
               CAST(CASE WHEN (c_custkey + t) % 19 = 0 OR (c_custkey + t) % 3 = 0 THEN 1 ELSE 0 END AS INT) AS voided
        FROM {customer} LATERAL VIEW explode(array(1, 2, 3, 4, 5)) tt AS t""",
    "patient_identifier": """
        SELECT c_custkey AS patient_id,
               t AS identifier_type,
               CONCAT('id', CAST(c_custkey * 10 + t AS STRING)) AS identifier,
               CAST(CASE WHEN (c_custkey + t) % 21 = 0 OR (c_custkey + t) % 4 = 0 THEN 1 ELSE 0 END AS INT) AS voided
        FROM {customer} LATERAL VIEW explode(array(1, 2, 3)) tt AS t""",
    "person_address": """
        SELECT c_custkey * 2 + k AS person_address_id,
               c_custkey AS person_id,
               CONCAT('Box ', CAST(c_custkey + k AS STRING)) AS address1,
               r_name AS county_district,
               n_name AS state_province,
               c_mktsegment AS address6,
               CAST(NULL AS STRING) AS address5,
               CONCAT('V', CAST(c_custkey % 40 AS STRING)) AS city_village,
               CAST(CASE WHEN (c_custkey + k) % 27 = 0 OR k = 1 AND c_custkey % 7 <> 0 OR c_custkey % 8 = 0
                         THEN 1 ELSE 0 END AS INT) AS voided
        FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey
        JOIN {region} ON r_regionkey = n_regionkey
        LATERAL VIEW explode(array(0, 1)) kk AS k""",
}

# The encounter type is a function of the order key, so the observations need no
# join with the encounters; the answer table has a fixed size (one row per
# rule and code) and is the broadcast side.
OBS = """
    SELECT l_orderkey AS encounter_id,
           c.concept_id,
           c.value_coded,
           CASE l_linenumber % 4 WHEN 0 THEN l_quantity WHEN 1 THEN -l_quantity / 4
                WHEN 2 THEN l_extendedprice ELSE l_extendedprice * 100000 END AS value_numeric,
           CASE (l_suppkey + l_linenumber) % 5 WHEN 0 THEN CONCAT(' ', p_name)
                WHEN 1 THEN CONCAT(CAST(l_partkey AS STRING), 'x')
                WHEN 2 THEN REPEAT(CONCAT(p_name, ' '), 20)
                WHEN 3 THEN CONCAT('-', CAST(l_suppkey AS STRING))
                ELSE CONCAT(CAST(l_partkey AS STRING), '00000000000') END AS value_text,
           CAST(l_shipdate AS TIMESTAMP) AS value_datetime,
           CAST(l_linenumber % 3 AS INT) AS obs_group_id,
           CAST(CASE WHEN l_suppkey % 17 = 0 THEN 1 ELSE 0 END AS INT) AS voided,
           CAST(DATE '2024-01-01' + CAST(l_suppkey % 90 AS INT) AS TIMESTAMP) AS date_created,
           CASE WHEN l_suppkey % 17 = 0
                THEN CAST(DATE '2024-03-10' + CAST(l_suppkey % 9 AS INT) AS TIMESTAMP) END AS date_voided
    FROM (SELECT *, CAST(l_orderkey % 7 AS INT) AS enc_type FROM {lineitem}) l
    JOIN {answers} c
      ON c.encounter_type = l.enc_type AND c.ord = (l_partkey + l_linenumber) % c.n
    JOIN {part} ON p_partkey = l_partkey"""


def answer_rows(catalog: Catalog) -> list[tuple]:
    """(encounter type, position, concept, code, rows of the type), one per rule and code."""
    rows = []
    for number, name in enumerate(("contact", "client_enrollment", "clinical_visit",
                                   "sti_treatment", "peer_calendar", "violence_screening",
                                   "hts_test")):
        pairs = []
        for rule in catalog.form(name).measures:
            if rule.kind == "answers":
                pairs += [(rule.concept, code) for code, _ in rule.answers.labels]
                pairs.append((rule.concept, 999999))
            elif rule.kind == "flag":
                pairs.append((rule.concept, rule.flag))
            else:
                pairs.append((rule.concept, 1065 if rule.kind == "code" else None))
        if name == "hts_test":
            pairs += KIT_CONCEPTS_SAMPLE
        pairs = list(dict.fromkeys(pairs))
        rows += [(number, i, c, v, len(pairs)) for i, (c, v) in enumerate(pairs)]
    return rows


def values(spark: SparkSession, rows: list[tuple], columns: dict[str, str]) -> DataFrame:
    """A small fixed table as a local relation, whose size the optimizer knows."""
    types = {"INT": pa.int32(), "BIGINT": pa.int64(), "STRING": pa.string()}
    return spark.createDataFrame(pa.table({
        c: pa.array([r[i] for r in rows], types[t]) for i, (c, t) in enumerate(columns.items())}))


def dimensions(spark: SparkSession) -> dict[str, DataFrame]:
    """The four metadata tables; six encounter types, then one for the test forms."""
    numbered = list(enumerate(list(ENCOUNTER_TYPES.values()) + ["hts-type"]))
    attributes = list(ATTRIBUTE_TYPES.values()) + ["other"]
    identifiers = list(IDENTIFIER_TYPES.values()) + [CONTACT_IDENTIFIER]
    return {
        "encounter_type": values(
            spark, [(i, u, 0) for i, u in numbered],
            {"encounter_type_id": "INT", "uuid": "STRING", "retired": "INT"}),
        "form": values(
            spark, list(enumerate(TEST_FORMS.values(), 1)), {"form_id": "INT", "uuid": "STRING"}),
        "person_attribute_type": values(
            spark, [(i, u, f"type {i}", int(u == "other")) for i, u in enumerate(attributes, 1)],
            {"person_attribute_type_id": "INT", "uuid": "STRING", "name": "STRING", "retired": "INT"}),
        "patient_identifier_type": values(
            spark, list(enumerate(identifiers, 1)),
            {"patient_identifier_type_id": "INT", "uuid": "STRING"}),
    }


# declared, so that no job has to look into the files while a plan is built
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}


def base(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.schema(SCHEMAS[n]).parquet(f"{sf_dir}/{n}.parquet") for n in names}


class DerivedRecords(dict):
    """The twelve record tables over ``sf_dir``, each built when first used."""

    def __init__(self, spark: SparkSession, sf_dir: str, catalog: Catalog | None = None):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir
        self.catalog = catalog or default_catalog()

    def __missing__(self, name: str) -> DataFrame:
        if name == "obs":
            answers = values(
                self.spark, answer_rows(self.catalog),
                {"encounter_type": "INT", "ord": "BIGINT", "concept_id": "INT",
                 "value_coded": "INT", "n": "BIGINT"})
            made = self.spark.sql(
                OBS, answers=answers, **base(self.spark, self.sf_dir, "lineitem", "part"))
        elif name in VIEWS:
            text = VIEWS[name]
            used = [t for t in ("orders", "customer", "nation", "region") if "{" + t + "}" in text]
            made = self.spark.sql(text, **base(self.spark, self.sf_dir, *used))
        else:
            made = dimensions(self.spark)[name]
        self[name] = made
        return made

    def before(self, moment: str) -> "DerivedRecords":
        """The same tables as they stood at ``moment``: later rows absent, later
        voidings undone."""
        then = DerivedRecords(self.spark, self.sf_dir, self.catalog)
        for name in ("encounter", "obs", "person", "person_name"):
            then[name] = self[name].filter(f"date_created < TIMESTAMP '{moment}'").withColumns({
                "voided": F.expr(
                    f"CASE WHEN date_voided >= TIMESTAMP '{moment}' THEN 0 ELSE voided END")})
        # identifiers and patients carry no times: some of them stood otherwise then, and of the
        # patients some are no longer live and some have come back
        then["patient_identifier"] = self["patient_identifier"].withColumns({
            "identifier": F.expr("CASE WHEN patient_id % 5 = 0 THEN CONCAT('old', identifier) ELSE identifier END"),
            "voided": F.expr("CASE WHEN patient_id % 3 = 0 THEN 1 - voided ELSE voided END")})
        then["patient"] = self["patient"].withColumn(
            "voided", F.expr("CASE WHEN patient_id % 2 = 0 THEN 0 WHEN patient_id % 7 = 0 THEN 1 ELSE voided END"))
        return then


CARE = """
    SELECT CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS Gender,
           CASE WHEN c_custkey % 6 <> 5
                THEN CONCAT(CAST(c_custkey % 6 * 10 AS STRING), '-', CAST(c_custkey % 6 * 10 + 9 AS STRING)) END AS AgeGroup,
           date_format(last_day(o_orderdate), 'yyyy-MM-dd') AS StartDateEOM,
           CONCAT('Facility ', CAST(c_custkey % 11 AS STRING)) AS FacilityName,
           r_name AS County, n_name AS SubCounty, c_mktsegment AS Mechanism, o_orderpriority AS Agency,
           CAST(c_custkey % 11 AS INT) AS SiteCode, CAST(1 + o_orderkey % 3 AS INT) AS Total
    FROM {orders} JOIN {customer} ON c_custkey = o_custkey JOIN {nation} ON n_nationkey = c_nationkey
    JOIN {region} ON r_regionkey = n_regionkey"""
#: The nine axes of the care cross-tabs; `Total` is their measure.
CARE_AXES = ("Gender", "AgeGroup", "StartDateEOM", "FacilityName", "County", "SubCounty", "Mechanism", "Agency", "SiteCode")


def care(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CARE, **base(spark, sf_dir, "orders", "customer", "nation", "region"))


# ---- upstream tables of the marts: one row per order -------------------------

KEYS = {
    "patient_id": "o_custkey",
    "encounter_id": "o_orderkey",
    "visit_id": "o_orderkey + 500000",
    "uuid": "CONCAT('enc-', CAST(o_orderkey AS STRING))",
    "location_id": "CAST(o_custkey % 11 AS INT)",
    "encounter_provider": "CAST(o_orderkey % 13 AS INT)",
    "provider": "CAST(o_orderkey % 13 AS INT)",
    "created_by": "CAST(o_orderkey % 13 AS INT)",
    "voided": "CAST(CASE WHEN o_orderkey % 23 = 0 THEN 1 ELSE 0 END AS INT)",
    "date_created": "DATE '2024-01-01' + CAST(o_orderkey % 60 AS INT)",
}
NUMBERS = (
    "weight height systolic_pressure diastolic_pressure temperature pulse_rate respiratory_rate "
    "oxygen_saturation muac systolic_bp diastolic_bp hemoglobin gravida parity duration "
    "fundal_height fetal_heart_rate cd4 viral_load birth_weight birth_length quantity dosage "
    "pill_count urine_ph urine_gravity"
).split()
LAB_TESTS = (299, 1030, 302, 32, 1305, 5497)


def upstream_column(name: str) -> str:
    if name in KEYS:
        return KEYS[name]
    if name.endswith("_date") or name.startswith("date_") or name in ("DOB", "lmp", "edd_ultrasound"):
        return "CAST(o_orderdate AS DATE)"
    return "o_totalprice" if name in NUMBERS else "o_orderpriority"


def coded_column(k: int, codes: list[int]) -> str:
    """Every code in turn, then an unlisted one, then null."""
    n = len(codes)
    listed = ", ".join(map(str, codes + [999999]))
    return f"get(array({listed}), CAST((o_orderkey * 31 + {k}) % {n + 2} AS INT))"


def upstream_sql(mart: Mart) -> str:
    carried = mart.carried
    if mart.everything:
        carried = ("patient_id", "encounter_id", "visit_id", "visit_date", "location_id",
                   "encounter_provider", "uuid", "voided", "date_created", "notes")
    cols = [f"{upstream_column(c)} AS {c}" for c in carried]
    coded = [(c, [code for code, _ in a.labels]) for c, a in mart.decoded]
    for c, _, cases in mart.dependent:
        coded.append((c, [code for _, a in cases for code, _ in a.labels]))
    for k, (c, codes) in enumerate(coded, 1):
        if c == "lab_test":
            tests = ", ".join(map(str, LAB_TESTS))
            cols.append(f"get(array({tests}), CAST(o_orderkey % {len(LAB_TESTS)} AS INT)) AS lab_test")
        else:
            cols.append(f"{coded_column(k, list(dict.fromkeys(codes)))} AS {c}")
    return "SELECT " + ",\n       ".join(cols) + "\nFROM {orders}"


def upstream(spark: SparkSession, sf_dir: str, mart: Mart) -> DataFrame:
    return spark.sql(upstream_sql(mart), **base(spark, sf_dir, "orders"))
