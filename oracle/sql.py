"""Expected results as SQL texts for an independent engine.

Formulated the long way round on purpose: every observation is joined with a
table of rules and a table of labels, reduced per (encounter, column), and only
then laid out by columns.
"""

from __future__ import annotations

import re

from oracle import sounds, survey

# Metadata uuids, and the codes and labels of the test kits.
UUIDS = ["ea68aad6-4655-4dc5-80f2-780e33055a9e", "c7f47a56-207b-11e9-ab14-d663bd873d93",
         "92e03f22-9686-11e9-bc42-526af7764f64", "2cc8c535-bbfa-4668-98c7-b12e3550ee7b",
         "c4f9db39-2c18-49a6-bf9b-b243d673c64d", "7b69daf5-b567-4384-9d29-f020c408d613"]
FORM_UUIDS = ["402dc5d7-46da-42d4-b2be-f43ea4ad87b0", "b08471f6-0892-4bf7-ab2b-bf79797b8ea4"]
ATTRIBUTES = {"alias_name": 1, "phone_number": 2, "alt_phone_number": 3, "email_address": 4}
KIT = {
    "result_1": (1040, {703: "Positive", 664: "Negative", 163611: "Invalid"}),
    "result_2": (1326, {703: "Positive", 664: "Negative", 1175: "N/A"}),
    "kit_name": (164962, {164960: "Determine", 164961: "First Response"}),
}
REFRESH_AT, VOID_AT, FEW_AT = "2024-02-15", "2024-03-01", "2024-03-30"


def q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def rule_of(rule: str):
    """(concept, kind, decoder or None, flag or None) of an Appendix A rule."""
    m = re.fullmatch(r"(\d+) → (.+)", rule)
    if not m:
        return None
    concept, what = int(m.group(1)), m.group(2)
    if re.fullmatch(r"D\d{3}", what):
        return concept, "label", what, None
    if what.startswith("flag:"):
        return concept, "code", None, int(what.split("==")[1])
    return concept, what, None, None


def rules_of(form: str):
    for column, type_, rule in survey.form_columns(form):
        parsed = rule_of(rule)
        if parsed:
            yield column, type_, parsed


def answers_cte() -> str:
    rows = []
    for number, form in enumerate(survey.FORM_ORDER):
        pairs = []
        for _, _, (concept, kind, decoder, flag) in rules_of(form):
            if kind == "label":
                pairs += [(concept, c) for c in survey.decoders()[decoder][0]] + [(concept, 999999)]
            elif flag is not None:
                pairs.append((concept, flag))
            else:
                pairs.append((concept, 1065 if kind == "code" else None))
        if form == "hts_test":
            pairs += [(162084, 162082), (162084, 162080), (1040, 703), (1040, 664), (1040, 163611),
                      (1326, 703), (1326, 664), (1326, 1175), (164962, 164960), (164962, 164961),
                      (164964, None), (162502, None)]
        for i, (concept, code) in enumerate(dict.fromkeys(pairs)):
            rows.append(f"({number},{i},{concept},{'NULL' if code is None else code})")
    return ("concept_answer(encounter_type, ord, concept_id, value_coded) AS (VALUES "
            + ",".join(rows) + "),\ntype_size AS (SELECT encounter_type, count(*) AS n "
            "FROM concept_answer GROUP BY encounter_type)")


def views(*names: str) -> list[str]:
    fixtures, out = survey.fixture_views(), []
    if "obs" in names:
        names = ("encounter",) + tuple(n for n in names if n != "encounter")
        out.append(answers_cte())
    return out + [f"{n} AS ({fixtures[n]})" for n in dict.fromkeys(names)]


def before(moment: str) -> list[str]:
    return [
        f"{t}_before AS (SELECT * REPLACE (CASE WHEN date_voided >= TIMESTAMP '{moment}' "
        f"THEN 0 ELSE voided END AS voided) FROM {t} WHERE date_created < TIMESTAMP '{moment}')"
        for t in ("encounter", "obs")] + [
        "patient_identifier_before AS (SELECT * REPLACE (CASE WHEN patient_id % 5 = 0 THEN 'old' || identifier "
        "ELSE identifier END AS identifier, CASE WHEN patient_id % 3 = 0 THEN 1 - voided ELSE voided END AS voided) "
        "FROM patient_identifier)",
        "patient_before AS (SELECT * REPLACE (CASE WHEN patient_id % 2 = 0 THEN 0 WHEN patient_id % 7 = 0 THEN 1 "
        "ELSE voided END AS voided) FROM patient)"]


def carried_sql(type_: str, source: str) -> str:
    if type_.startswith("DATE"):
        return f"CAST(e.{source} AS DATE)"
    return f"substr(e.{source}, 1, 38)" if source == "uuid" else f"e.{source}"


def bounded(value: str) -> str:
    return (f"CASE WHEN {value} > 2147483647 THEN 2147483647 WHEN {value} < -2147483648 THEN -2147483648 "
            f"ELSE CAST({value} AS INTEGER) END")


def leading(value: str) -> str:
    return f"TRY_CAST(regexp_extract({value}, " + r"'^\s*([+-]?\d+)', 1) AS HUGEINT)"


def as_text(value: str) -> str:
    return (f"CASE WHEN {value} = floor({value}) THEN CAST(CAST({value} AS BIGINT) AS VARCHAR) "
            f"ELSE CAST({value} AS VARCHAR) END")


def typed_sql(value: str, kind: str, type_: str) -> str:
    width = re.search(r"\((\d+)\)", type_)
    if type_ == "DATE":
        return f"CAST({value} AS DATE)"
    if type_ == "INT":
        if kind == "numeric":
            return bounded(f"round({value})")
        if kind == "text":
            return f"CASE WHEN {value} IS NOT NULL THEN coalesce({bounded(leading(value))}, 0) END"
        return f"CAST({value} AS INTEGER)"
    if kind == "numeric":
        value = as_text(value)
    elif kind == "code":
        value = f"CAST(CAST({value} AS INTEGER) AS VARCHAR)"
    return f"substr({value}, 1, {width.group(1)})" if width else value


def form_ctes(form: str, tag: str = "", src: str = "", keys: str | None = None,
              keep_voided: bool = False) -> list[str]:
    """CTEs that end in ``{form}{tag}`` from ``encounter{src}`` and ``obs{src}``."""
    out, name = [], f"{form}{tag}"
    rules, labels = [], []
    for column, _, (concept, kind, decoder, flag) in rules_of(form):
        other = None
        if decoder:
            codes, other = survey.decoders()[decoder]
            labels += [f"({q(column)},{c},{q(v)})" for c, v in codes.items()]
        rules.append(f"({q(column)},{concept},{q(kind)},{'NULL' if flag is None else flag},{q(other)})")
    out.append(f"{name}_rule(col, concept, kind, flag, other) AS (VALUES {','.join(rules)})")
    labels = labels or ["('',0,'')"]
    out.append(f"{name}_label(col, code, label) AS (VALUES {','.join(labels)})")
    pick = "1 = 1" if keep_voided or form == "hts_test" else "voided = 0"
    if form != "hts_test":
        pick += f" AND encounter_type = {survey.FORM_ORDER.index(form)}"
    if form in ("contact", "client_enrollment"):
        pick += f" AND patient_id IN (SELECT patient_id FROM patient{src} WHERE voided = 0)"
    if keys:
        pick += f" AND encounter_id IN (SELECT encounter_id FROM {keys})"
    out.append(f"{name}_enc AS (SELECT * FROM encounter{src} WHERE {pick})")
    out.append(f"""{name}_best AS (
        SELECT encounter_id, col,
               arg_max(t, (lower(t), t)) AS txt, max(num) AS num, max(moment) AS moment
        FROM (SELECT o.encounter_id, r.col,
                     CASE r.kind WHEN 'label' THEN coalesce(l.label, r.other)
                                 WHEN 'text' THEN o.value_text
                                 WHEN 'trim(text)' THEN trim(o.value_text) END AS t,
                     CASE r.kind WHEN 'numeric' THEN o.value_numeric WHEN 'code' THEN o.value_coded END AS num,
                     CASE r.kind WHEN 'datetime' THEN o.value_datetime END AS moment
              FROM obs{src} o JOIN {name}_rule r
                ON r.concept = o.concept_id AND (r.flag IS NULL OR r.flag = o.value_coded)
              LEFT JOIN {name}_label l ON l.col = r.col AND l.code = o.value_coded
              WHERE o.voided = 0)
        GROUP BY encounter_id, col)""")
    cols = []
    for column, type_, rule in survey.form_columns(form):
        parsed = rule_of(rule)
        if rule.startswith("enc:"):
            source = rule.split("e.", 1)[1]
            cols.append(f"{carried_sql(type_, source)} AS {column}")
            if form == "contact" and column == "uuid":
                cols.append("substr(i.ident, 1, 50) AS unique_identifier")
        elif parsed:
            kind = parsed[1]
            cell = {"numeric": "num", "code": "num", "datetime": "moment"}.get(kind, "txt")
            value = f"(max(b.{cell}) FILTER (WHERE b.col = {q(column)}))"
            cols.append(f"{typed_sql(value, kind, type_)} AS {column}")
        elif rule.startswith("kit:"):
            slot, part = re.search(r"t\.test_(\d)_result is not null, t\.(\w+)", rule).groups()
            part = f"result_{slot}" if part.startswith("test_") else part
            best = f"arg_max(k.{part}, (lower(k.{part}), k.{part}))" if part != "expiry_date" else f"max(k.{part})"
            cols.append(f"(SELECT {best} FROM {name}_kit k WHERE k.encounter_id = e.encounter_id "
                        f"AND k.result_{slot} IS NOT NULL) AS {column}")
        else:
            cols.append(f"CASE WHEN e.form_id = 2 OR EXISTS (SELECT 1 FROM obs{src} o WHERE o.voided = 0 "
                        f"AND o.encounter_id = e.encounter_id AND o.concept_id = 162084 "
                        f"AND o.value_coded = 162082) THEN 2 ELSE 1 END AS {column}")
    where = ""
    if form == "hts_test":
        out.append(kit_cte(f"{name}_kit", src))
        concepts = sorted({p[0] for _, _, p in rules_of(form)} | {162084})
        where = (f"WHERE e.encounter_id IN (SELECT encounter_id FROM obs{src} WHERE voided = 0 AND "
                 f"concept_id IN ({','.join(map(str, concepts))})) "
                 f"AND e.encounter_id IN (SELECT encounter_id FROM {name}_kit)")
    joins = f"LEFT JOIN {name}_best b ON b.encounter_id = e.encounter_id"
    group = "ALL"
    if form == "contact":
        joins += (" LEFT JOIN (SELECT patient_id, max(identifier) FILTER (WHERE identifier_type = 3) AS ident "
                  f"FROM patient_identifier{src} WHERE voided = 0 GROUP BY patient_id) i ON i.patient_id = e.patient_id")
    out.append(f"{name} AS (SELECT {', '.join(cols)} FROM {name}_enc e {joins} {where} GROUP BY {group})")
    return out


def kit_cte(name: str, src: str = "") -> str:
    parts = []
    for part, (concept, codes) in KIT.items():
        label = f"CASE o.value_coded {' '.join(f'WHEN {c} THEN {q(v)}' for c, v in codes.items())} ELSE '' END"
        parts.append(f"arg_max({label}, lower({label})) FILTER (WHERE o.concept_id = {concept}) AS {part}")
    return (f"{name} AS (SELECT o.encounter_id, o.obs_group_id, {', '.join(parts)}, "
            "substr(arg_max(trim(o.value_text), (lower(trim(o.value_text)), trim(o.value_text))) "
            "FILTER (WHERE o.concept_id = 164964), 1, 50) AS lot_no, "
            "CAST(max(o.value_datetime) FILTER (WHERE o.concept_id = 162502) AS DATE) AS expiry_date "
            f"FROM obs{src} o WHERE o.voided = 0 AND o.concept_id IN (1040, 1326, 164962, 164964, 162502) "
            "GROUP BY o.encounter_id, o.obs_group_id)")


def with_(ctes: list[str], final: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + final


def form_views(form: str) -> list[str]:
    return views("obs", "patient", "patient_identifier")


def form_sql(form: str) -> str:
    return with_(form_views(form) + form_ctes(form), f"SELECT * FROM {form}")


def changed_cte(moment: str, more: str = "") -> str:
    return (f"changed AS (SELECT encounter_id FROM encounter WHERE date_created >= TIMESTAMP '{moment}' "
            f"OR date_changed >= TIMESTAMP '{moment}' OR date_voided >= TIMESTAMP '{moment}' "
            f"UNION SELECT encounter_id FROM obs WHERE date_created >= TIMESTAMP '{moment}' "
            f"OR date_voided >= TIMESTAMP '{moment}'{more})")


def refresh_ctes(form: str, moment: str) -> list[str]:
    lost, ident = "", ""
    if form in ("contact", "client_enrollment"):
        lost = " OR client_id NOT IN (SELECT patient_id FROM patient WHERE voided = 0)"
    if form == "contact":
        ident = (", (SELECT substr(max(identifier), 1, 50) FROM patient_identifier p WHERE p.patient_id = client_id "
                 "AND p.voided = 0 AND identifier_type = 3) AS unique_identifier")
    back = ""
    if form in ("contact", "client_enrollment"):  # patients that have come back
        back = (f" UNION SELECT encounter_id FROM encounter WHERE voided = 0 AND encounter_type = {survey.FORM_ORDER.index(form)} "
                "AND patient_id IN (SELECT patient_id FROM patient WHERE voided = 0) "
                f"AND encounter_id NOT IN (SELECT encounter_id FROM {form}_old WHERE voided = 0)")
    return (form_views(form) + before(moment) + form_ctes(form, "_old", "_before")
            + [changed_cte(moment, back)]
            + form_ctes(form, "_new", "", "changed", True)
            + [f"refreshed AS (SELECT * FROM {form}_new UNION ALL SELECT * REPLACE (CASE WHEN "
               f"encounter_id IN (SELECT encounter_id FROM changed){lost} THEN 1 ELSE voided END AS voided{ident}) "
               f"FROM {form}_old WHERE encounter_id NOT IN (SELECT encounter_id FROM {form}_new))"])


# ---- registry -----------------------------------------------------------------

def attribute_cte() -> str:
    cols = ", ".join(f"max(value) FILTER (WHERE person_attribute_type_id = {i}) AS {c}"
                     for c, i in ATTRIBUTES.items())
    return (f"att AS (SELECT person_id AS client_id, {cols} FROM person_attribute "
            "WHERE voided = 0 AND person_attribute_type_id <= 4 GROUP BY person_id)")


IDENT_CTE = ("ident AS (SELECT patient_id AS client_id, "
             "max(identifier) FILTER (WHERE identifier_type = 1) AS national_id_number, "
             "max(identifier) FILTER (WHERE identifier_type = 2) AS passport_number "
             "FROM patient_identifier WHERE voided = 0 GROUP BY patient_id)")
ADDRESS_CTE = ("addr AS (SELECT person_id AS client_id, address1 AS postal_address, "
               "county_district AS county, state_province AS sub_county, address6 AS location, "
               "address5 AS sub_location, city_village AS village FROM (SELECT *, row_number() OVER "
               "(PARTITION BY person_id ORDER BY person_address_id) AS rn FROM person_address "
               "WHERE voided = 0) WHERE rn = 1)")


def person_cte(name: str, where: str, name_where: str = "voided = 0", src: str = "") -> str:
    return (f"{name} AS (SELECT p.person_id AS client_id, CAST(p.date_created AS DATE) AS registration_date, "
            "n.given_name, n.middle_name, n.family_name, p.gender AS Gender, p.birthdate AS DOB, "
            f"p.dead, p.death_date, p.voided FROM person{src} p LEFT JOIN (SELECT *, row_number() OVER "
            f"(PARTITION BY person_id ORDER BY person_name_id) AS rn FROM person_name{src} WHERE {name_where}) n "
            f"ON n.person_id = p.person_id AND n.rn = 1 WHERE {where})")


REGISTRY_SELECT = """SELECT c.client_id, c.registration_date, c.given_name, c.middle_name, c.family_name,
    c.Gender, c.DOB, a.alias_name, d.postal_address, d.county, d.sub_county, d.location, d.sub_location,
    d.village, a.phone_number, a.alt_phone_number, a.email_address, i.national_id_number, i.passport_number,
    c.dead, c.death_date, c.voided
FROM {clients} c LEFT JOIN att a USING (client_id) LEFT JOIN ident i USING (client_id)
LEFT JOIN addr d USING (client_id)"""
REGISTRY_VIEWS = ("person", "person_name", "person_attribute", "patient_identifier", "person_address")


def registry_ctes() -> list[str]:
    return views(*REGISTRY_VIEWS) + [attribute_cte(), IDENT_CTE, ADDRESS_CTE]


def registry_sql() -> str:
    return with_(registry_ctes() + [person_cte("clients", "p.voided = 0")],
                 REGISTRY_SELECT.format(clients="clients"))


def refresh_registry_sql(moment: str) -> str:
    cut = []
    for t in ("person", "person_name"):
        cut.append(f"{t}_before AS (SELECT * REPLACE (CASE WHEN date_voided >= TIMESTAMP '{moment}' THEN 0 "
                   f"ELSE voided END AS voided) FROM {t} WHERE date_created < TIMESTAMP '{moment}')")
    times = " OR ".join(f"{c} >= TIMESTAMP '{moment}'" for c in ("date_created", "date_changed", "date_voided"))
    changed = (f"changed AS (SELECT person_id FROM person WHERE {times} "
               f"UNION SELECT person_id FROM person_name WHERE {times})")
    return with_(
        registry_ctes() + cut + [changed, person_cte("old", "p.voided = 0", src="_before"),
                                 person_cte("new", "p.person_id IN (SELECT person_id FROM changed)"),
                                 "clients AS (SELECT * FROM old WHERE client_id NOT IN "
                                 "(SELECT person_id FROM changed) UNION ALL SELECT * FROM new)"],
        REGISTRY_SELECT.format(clients="clients"))


# ---- marts ---------------------------------------------------------------------

KEYS = {
    "patient_id": "o_custkey", "encounter_id": "o_orderkey", "visit_id": "o_orderkey + 500000",
    "uuid": "'enc-' || o_orderkey", "location_id": "CAST(o_custkey % 11 AS INT)",
    "encounter_provider": "CAST(o_orderkey % 13 AS INT)", "provider": "CAST(o_orderkey % 13 AS INT)",
    "created_by": "CAST(o_orderkey % 13 AS INT)",
    "voided": "CASE WHEN o_orderkey % 23 = 0 THEN 1 ELSE 0 END",
    "date_created": "CAST(DATE '2024-01-01' + CAST(o_orderkey % 60 AS INT) AS DATE)",
}
NUMBERS = set("""weight height systolic_pressure diastolic_pressure temperature pulse_rate respiratory_rate
oxygen_saturation muac systolic_bp diastolic_bp hemoglobin gravida parity duration fundal_height
fetal_heart_rate cd4 viral_load birth_weight birth_length quantity dosage pill_count urine_ph
urine_gravity""".split())
STAR = ["patient_id", "encounter_id", "visit_id", "visit_date", "location_id", "encounter_provider",
        "uuid", "voided", "date_created", "notes"]
STAGES = ({1204: "WHO Stage1", 1205: "WHO Stage2", 1221: "WHO Stage2", 1206: "WHO Stage3",
           1222: "WHO Stage3", 1207: "WHO Stage4", 1223: "WHO Stage4"}, "")
TESTS = {
    299: {1228: "REACTIVE", 1229: "NON-REACTIVE", 1304: "POOR SAMPLE QUALITY"},
    1030: {1138: "INDETERMINATE", 664: "NEGATIVE", 703: "POSITIVE", 1304: "POOR SAMPLE QUALITY"},
    302: {1115: "Normal", 1116: "Abnormal", 1067: "Unknown"},
    32: {664: "NEGATIVE", 703: "POSITIVE", 1138: "INDETERMINATE"},
    1305: {1306: "BEYOND DETECTABLE LIMIT", 1301: "DETECTED", 1302: "LDL", 1304: "POOR SAMPLE QUALITY"},
}


def source_column(c: str) -> str:
    if c in KEYS:
        return KEYS[c]
    if c.endswith("_date") or c.startswith("date_") or c in ("DOB", "lmp", "edd_ultrasound"):
        return "CAST(o_orderdate AS DATE)"
    return "o_totalprice" if c in NUMBERS else "o_orderpriority"


def slot(k: int, codes: list[int]) -> str:
    """Code of an order, by a lookup list; the place past its end is null."""
    listed = ",".join(map(str, codes + [999999]))
    return f"list_extract([{listed}], CAST((o_orderkey * 31 + {k}) % {len(codes) + 2} AS INT) + 1)"


def mart_sql(mart: str) -> str:
    found = survey.mart_columns(mart)
    if found is None:
        return "SELECT " + ", ".join(f"{source_column(c)} AS {c}" for c in STAR) + " FROM orders"
    decoded, carried = found
    decoded = sorted(decoded, key=lambda d: d[0] == "test_result")
    inner, outer = [f"{source_column(c)} AS {c}" for c in carried], list(carried)
    for k, (column, decoder) in enumerate(decoded, 1):
        if column == "test_result":
            codes = list(dict.fromkeys(c for t in TESTS.values() for c in t))
            inner.append(f"{slot(k, codes)} AS {column}")
            rows = ",".join(f"({t},{c},{q(v)})" for t, m in TESTS.items() for c, v in m.items())
            outer.append(f"CASE WHEN lab_test IN ({','.join(map(str, TESTS))}) THEN (SELECT label FROM "
                         f"(VALUES {rows}) v(test, code, label) WHERE test = lab_test AND code = test_result) "
                         f"ELSE CAST(test_result AS VARCHAR) END AS {column}")
            continue
        if decoder == "special":
            labels, other = STAGES if column == "who_stage" else ({1: "Yes"}, "NO")
        else:
            labels, other = survey.decoders()[decoder]
        if column == "lab_test":
            inner.append("list_extract([299, 1030, 302, 32, 1305, 5497], CAST(o_orderkey % 6 AS INT) + 1) AS lab_test")
        else:
            inner.append(f"{slot(k, list(labels))} AS {column}")
        pairs = ", ".join(f"{c}: {q(v)}" for c, v in labels.items())
        outer.append(f"coalesce(MAP {{{pairs}}}[{column}], {q(other)}) AS {column}")
    return f"SELECT {', '.join(outer)} FROM (SELECT {', '.join(inner)} FROM orders)"


# ---- everything by query name ---------------------------------------------------

RUNS = """runs AS (SELECT CAST(event_id AS VARCHAR) AS id, event_type AS script_name, ts AS start_time,
    CASE WHEN user_id % 10 <> 0 THEN ts + INTERVAL 5 MINUTE END AS stop_time,
    CASE WHEN event_type = 'error' THEN props END AS error FROM events)"""
STAMP = "'%Y-%m-%d %H:%M:%S'"
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
REFERRING = ("contact", "client_enrollment", "clinical_visit", "sti_treatment", "peer_calendar",
             "violence_screening")


def cross_tab_sql() -> str:
    return """WITH cells AS (SELECT c_mktsegment, n_name, count(*) AS value FROM customer
    JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL),
r AS (SELECT c_mktsegment, sum(value) AS row_total,
      row_number() OVER (ORDER BY sum(value) DESC, c_mktsegment) AS row_place FROM cells GROUP BY 1),
c AS (SELECT n_name, sum(value) AS column_total,
      row_number() OVER (ORDER BY sum(value) DESC, n_name) AS column_place FROM cells GROUP BY 1)
SELECT c_mktsegment, n_name, value, CAST(row_total AS BIGINT) AS row_total, row_place,
       CAST(column_total AS BIGINT) AS column_total, column_place
FROM cells JOIN r USING (c_mktsegment) JOIN c USING (n_name)"""


def orphans_sql() -> str:
    ctes = views("obs", "patient", "patient_identifier", "person")
    tagged = []
    for f in REFERRING:
        ctes += form_ctes(f)
        tagged.append(f"SELECT {q(f)} AS table_name, client_id FROM {f}")
    return with_(ctes, "SELECT table_name, client_id, count(*) AS n FROM ("
                 + " UNION ALL ".join(tagged) + ") WHERE client_id NOT IN "
                 "(SELECT person_id FROM person WHERE voided = 0) GROUP BY ALL")


def missing_sql(columns: tuple[str, ...]) -> str:
    parts = [f"SELECT {q(c)} AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n FROM registry"
             for c in columns]
    return with_(registry_ctes() + [person_cte("clients", "p.voided = 0"),
                                    f"registry AS ({REGISTRY_SELECT.format(clients='clients')})"],
                 " UNION ALL ".join(parts))


def size_of(name: str, rows: str) -> str:
    return (f"SELECT {q(name)} AS table_name, count(*) FILTER (WHERE voided = 0) AS live, "
            f"count(*) FILTER (WHERE voided = 1) AS voided, CAST(sum(client_id) AS BIGINT) AS clients FROM ({rows})")


#: Columns of the specification's tables that must have a value, by table; others: client and encounter.
REQUIRED = {
    "client_registration": ["client_id"],
    "hts_test": ["client_id", "encounter_id", "encounter_uuid", "encounter_location", "creator", "date_created"],
}


def violations_sql() -> str:
    registry = REGISTRY_SELECT.format(clients="clients")
    ctes = views("obs", "patient", *REGISTRY_VIEWS) + [
        attribute_cte(), IDENT_CTE, ADDRESS_CTE, person_cte("clients", "p.voided = 0"),
        f"client_registration AS MATERIALIZED ({registry})"]
    parts = []
    for name in ("client_registration", *survey.FORM_ORDER):
        if name != "client_registration":
            *inner, last = form_ctes(name)
            ctes += [*inner, last.replace(f"{name} AS (", f"{name} AS MATERIALIZED (", 1)]
        key = "client_id" if name == "client_registration" else "encounter_id"
        unique = [("primary key", key)]
        if name != "client_registration" and "uuid" in [c for c, _, _ in survey.form_columns(name)]:
            unique.append(("unique", "uuid"))
        for rule, column in unique:
            parts.append(f"SELECT {q(name)} AS table_name, {q(rule)} AS rule, {q(column)} AS column_name, (SELECT count(*) FROM "
                         f"(SELECT {column} FROM {name} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS n")
        for column in REQUIRED.get(name, ["client_id", "encounter_id"]):
            parts.append(f"SELECT {q(name)}, 'not null', {q(column)}, (SELECT count(*) FROM {name} WHERE {column} IS NULL)")
    return with_(ctes, " UNION ALL ".join(parts))


def lost_sql() -> str:
    """Cells that lose something on their way into their column's type, by column."""
    ctes, parts = form_views("hts_test"), []
    for form in survey.FORM_ORDER:
        ctes += form_ctes(form)
        asked = []
        for column, type_, (concept, kind, decoder, flag) in rules_of(form):
            width = re.search(r"\((\d+)\)", type_)
            if type_ == "INT" and kind in ("numeric", "text", "trim(text)"):
                asked.append(f"({q(column)}, 'bounded', {q(kind)}, 0)")
            elif width and kind in ("numeric", "text", "trim(text)", "label"):
                asked.append(f"({q(column)}, 'cut', {q(kind)}, {width.group(1)})")
        number = f"CASE WHEN kind = 'numeric' THEN round(num) ELSE CAST({leading('txt')} AS DOUBLE) END"
        test = (f"CASE WHEN lost = 'bounded' THEN {number} NOT BETWEEN -2147483648 AND 2147483647 "
                f"ELSE length(CASE WHEN kind = 'numeric' THEN {as_text('num')} ELSE txt END) > width END")
        parts.append(
            f"SELECT {q(form)} AS table_name, a.col AS column_name, lost, count(*) FILTER (WHERE {test}) AS n "
            f"FROM (VALUES {', '.join(asked)}) a(col, lost, kind, width) LEFT JOIN (SELECT * FROM {form}_best "
            f"WHERE encounter_id IN (SELECT encounter_id FROM {form}_enc)"
            + (f" AND encounter_id IN (SELECT encounter_id FROM {form})" if form == "hts_test" else "")
            + ") b ON b.col = a.col GROUP BY a.col, lost")
    parts.append("SELECT 'hts_test', 'kit.lot_no', 'cut', (SELECT count(*) FROM (SELECT encounter_id, obs_group_id, "
                 "arg_max(trim(value_text), (lower(trim(value_text)), trim(value_text))) AS t FROM obs WHERE voided = 0 AND "
                 "concept_id = 164964 GROUP BY ALL) WHERE length(t) > 50)")
    return with_(ctes, " UNION ALL ".join(parts))


def mart_orphans_sql() -> str:
    children = " UNION ALL ".join(
        f"SELECT {q('mart.' + m)} AS table_name, patient_id FROM ({mart_sql(m)})" for m in survey.marts() if m != "patient_demographics")
    return with_(views("person"), "SELECT table_name, 'patient_id' AS column_name, 'mart.patient_demographics' AS parent_name, "
                 f"CAST(patient_id AS VARCHAR) AS value, count(*) AS n FROM ({children}) WHERE patient_id NOT IN "
                 "(SELECT person_id FROM person WHERE voided = 0) GROUP BY ALL")


AXES = ["Gender", "AgeGroup", "StartDateEOM", "FacilityName", "County", "SubCounty", "Mechanism", "Agency", "SiteCode"]


def cross_tab_sets_sql() -> str:
    pairs = list(zip(AXES, AXES[1:] + AXES[:1]))
    cells = " UNION ALL ".join(
        f"SELECT {q(a)} AS row_axis, {q(b)} AS column_axis, CAST({a} AS VARCHAR) AS row_value, CAST({b} AS VARCHAR) AS column_value, "
        f"count(*) AS records, CAST(sum(Total) AS BIGINT) AS total FROM care GROUP BY {a}, {b}" for a, b in pairs)
    return f"""WITH care AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS Gender,
    CASE WHEN c_custkey % 6 = 5 THEN NULL ELSE (c_custkey % 6) * 10 || '-' || ((c_custkey % 6) * 10 + 9) END AS AgeGroup,
    strftime(last_day(CAST(o_orderdate AS DATE)), '%Y-%m-%d') AS StartDateEOM, 'Facility ' || (c_custkey % 11) AS FacilityName,
    r_name AS County, n_name AS SubCounty, c_mktsegment AS Mechanism, o_orderpriority AS Agency,
    CAST(c_custkey % 11 AS INT) AS SiteCode, CAST(1 + o_orderkey % 3 AS INT) AS Total
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
cells AS ({cells}),
r AS (SELECT row_axis, column_axis, row_value, sum(total) AS t, row_number() OVER (PARTITION BY row_axis, column_axis
      ORDER BY sum(total) DESC, row_value NULLS FIRST) AS place FROM cells GROUP BY 1, 2, 3),
c AS (SELECT row_axis, column_axis, column_value, sum(total) AS t, row_number() OVER (PARTITION BY row_axis, column_axis
      ORDER BY sum(total) DESC, column_value NULLS FIRST) AS place FROM cells GROUP BY 1, 2, 3)
SELECT x.row_axis, x.column_axis, x.row_value, x.column_value, records, total, CAST(r.t AS BIGINT) AS row_total,
    CAST(r.place AS INTEGER) AS row_place, CAST(c.t AS BIGINT) AS column_total, CAST(c.place AS INTEGER) AS column_place
FROM cells x JOIN r ON r.row_axis = x.row_axis AND r.column_axis = x.column_axis AND r.row_value IS NOT DISTINCT FROM x.row_value
    JOIN c ON c.row_axis = x.row_axis AND c.column_axis = x.column_axis AND c.column_value IS NOT DISTINCT FROM x.column_value"""


def subset_sql() -> str:
    return with_(refresh_ctes("client_enrollment", REFRESH_AT),
        "SELECT o.* REPLACE (coalesce(n.visit_date, o.visit_date) AS visit_date, CASE WHEN n.encounter_id IS NOT NULL "
        "THEN n.voided ELSE r.voided END AS voided) FROM client_enrollment_old o LEFT JOIN client_enrollment_new n "
        "USING (encounter_id) JOIN refreshed r USING (encounter_id) UNION ALL SELECT * FROM client_enrollment_new "
        "WHERE encounter_id NOT IN (SELECT encounter_id FROM client_enrollment_old)")


def run_sql() -> dict[str, str]:
    """Expected results of whole runs on storage."""
    fresh = {f: with_(refresh_ctes(f, REFRESH_AT), "SELECT voided, client_id FROM refreshed") for f in survey.FORM_ORDER}
    built = {f: f"SELECT voided, client_id FROM ({form_sql(f)})" for f in survey.FORM_ORDER}
    sizes = lambda first, rest: " UNION ALL ".join(
        size_of(n, t) for n, t in {"client_registration": first, **rest}.items())
    live = lambda first, rest: "SELECT table_name, live, clients FROM (" + sizes(
        f"SELECT * FROM ({first}) WHERE voided = 0", {n: f"SELECT * FROM ({t}) WHERE voided = 0" for n, t in rest.items()}) + ")"
    published = " UNION ALL ".join(f"SELECT {q('mart.' + m)} AS table_name, count(*) AS n FROM ({mart_sql(m)})" for m in survey.marts())
    rebuilt = " UNION ALL ".join(f"SELECT {q(n)} AS table_name, count(*) AS n FROM ({t}) WHERE voided = 0"
                                 for n, t in {"client_registration": registry_sql(), **built}.items())
    return {
        "workflow_refresh_all": f"{rebuilt} UNION ALL {published}",
        "workflow_recreate_all": f"{rebuilt} UNION ALL {published}",
        "workflow_reset": " UNION ALL ".join(f"SELECT {q(n)} AS table_name, 0 AS n FROM region WHERE r_regionkey = 0"
                                             for n in ("client_registration", *survey.FORM_ORDER)),
        "upstream_roundtrip": mart_sql("hiv_followup"),
        "stream_refresh_all": live(registry_sql(), built),
        "cut_and_clamped_values": lost_sql(),
        "mart_orphans": mart_orphans_sql(),
        "cross_tab_sets": cross_tab_sets_sql(),
        "workflow_rebuild": sizes(registry_sql(), built),
        "workflow_refresh": sizes(refresh_registry_sql(REFRESH_AT), fresh),
        "workflow_publish": " UNION ALL ".join(
            f"SELECT {q(m)} AS mart, count(*) AS n FROM ({mart_sql(m)})" for m in survey.marts()),
        "stream_refresh_contact": form_sql("contact"),
        "curated_roundtrip": form_sql("client_enrollment"),
        "records_roundtrip": registry_sql(),
        "run_log_watermark": f"WITH {RUNS} SELECT t.name AS script_name, (SELECT strftime(max(start_time), {STAMP}) FROM runs "
                             "WHERE script_name = t.name AND stop_time IS NOT NULL AND error IS NULL) AS since FROM (VALUES "
                             + ", ".join(f"({q(t)})" for t in EVENT_TYPES) + ") t(name)",
        "curated_violations": violations_sql(),
        "refresh_client_enrollment_subset": subset_sql(),
        **{f"refresh_{f}_few": with_(refresh_ctes(f, FEW_AT), "SELECT * FROM refreshed") for f in ("contact", "clinical_visit")},
        "name_codes": sounds.name_codes_sql(),
        "duplicate_candidates": sounds.duplicates_sql(
            registry_ctes() + [person_cte("clients", "p.voided = 0")], REGISTRY_SELECT.format(clients="clients")),
    }


def all_sql() -> dict[str, str]:
    registry = registry_ctes() + [person_cte("clients", "p.voided = 0")]
    out = {
        "client_registration": registry_sql(),
        "registry_attributes": with_(views("person_attribute") + [attribute_cte()], "SELECT * FROM att"),
        "registry_identifiers": with_(views("patient_identifier") + [IDENT_CTE], "SELECT * FROM ident"),
        "registry_address": with_(views("person_address") + [ADDRESS_CTE], "SELECT * FROM addr"),
        "hts_kit_groups": with_(views("obs") + [kit_cte("kits")], "SELECT * FROM kits"),
        "update_join_outer": with_(
            registry, "SELECT c.client_id, a.alias_name, a.phone_number FROM clients c LEFT JOIN att a USING (client_id)"),
        "update_join_inner": with_(
            registry, "SELECT c.client_id, CASE WHEN d.client_id IS NULL THEN c.family_name ELSE d.county END "
            "AS county FROM clients c LEFT JOIN addr d USING (client_id)"),
        "pk_violations": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
        "uuid_violations": with_(views("person_name"), "SELECT family_name, count(*) AS n FROM person_name "
                                 "WHERE family_name IS NOT NULL GROUP BY ALL HAVING count(*) > 1"),
        "null_violations": missing_sql(("client_id", "middle_name", "national_id_number", "county")),
        "fk_orphans": orphans_sql(),
        "run_history": f"WITH {RUNS} SELECT script_name, coalesce(strftime(start_time, {STAMP}), '') AS start_time, "
                       f"coalesce(strftime(stop_time, {STAMP}), '') AS stop_time, CASE WHEN error IS NULL "
                       "THEN 'Success' ELSE 'Pending' END AS status FROM runs "
                       "ORDER BY runs.start_time DESC, id DESC LIMIT 10",
        "run_log_retention": f"WITH {RUNS} SELECT id, script_name FROM runs WHERE NOT (script_name IN "
                             "('click', 'view') AND start_time < TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 12 HOUR)",
        "run_states": f"WITH {RUNS} SELECT script_name, strftime(max(start_time), {STAMP}) AS since FROM runs "
                      "WHERE stop_time IS NOT NULL GROUP BY script_name",
        "cross_tab": cross_tab_sql(),
        "cross_tab_wide": "SELECT c_mktsegment, " + ", ".join(
            f'count(*) FILTER (WHERE r_name = {q(r)}) AS "{r}"' for r in REGIONS)
            + ", count(*) FILTER (WHERE r_name NOT IN (" + ", ".join(map(q, REGIONS)) + ")) AS other FROM customer "
            "JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY c_mktsegment",
        "patients_json": with_(registry, "SELECT CAST(to_json(r) AS VARCHAR) AS patient FROM ("
                               + REGISTRY_SELECT.format(clients="clients") + ") r"),
        "events_pivot": "SELECT user_id, CAST(ts AS DATE) AS day, " + ", ".join(
            f"max(value) FILTER (WHERE event_type = {q(t)}) AS {t}" for t in EVENT_TYPES)
            + ", max(value) FILTER (WHERE event_type NOT IN (" + ", ".join(map(q, EVENT_TYPES)) + ")) AS other"
            + " FROM events GROUP BY ALL",
        "orders_lineitem_pivot": "SELECT l_orderkey, " + ", ".join(
            f"max(l_quantity) FILTER (WHERE l_returnflag = '{f}') AS qty_{f.lower()}" for f in "ANR")
            + ", max(l_quantity) FILTER (WHERE l_returnflag NOT IN ('A', 'N', 'R')) AS qty_other"
            + " FROM lineitem GROUP BY l_orderkey",
        "soft_delete_propagation": with_(
            refresh_ctes("contact", VOID_AT),
            "SELECT encounter_id, client_id, voided FROM refreshed WHERE voided = 1 AND encounter_id IN "
            "(SELECT encounter_id FROM contact_old WHERE voided = 0)"),
        "refresh_client_registration": refresh_registry_sql(REFRESH_AT),
    }
    out |= run_sql()
    for form in survey.FORM_ORDER:
        out[form] = form_sql(form)
        out[f"refresh_{form}"] = with_(refresh_ctes(form, REFRESH_AT), "SELECT * FROM refreshed")
    for mart in survey.marts():
        out[f"mart_{mart}"] = mart_sql(mart)
    return out
