"""The seven encounter tables: one wide row per encounter of a form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formfold.catalog import Catalog, Form, Rule, default_catalog
from formfold.operators import pivot
from formfold.operators.joins import identifiers_by_type, of_metadata
from formfold.plans.metadata import ENCOUNTER_TYPES, TEST_FORMS

# only these two forms ask for a live patient row
LIVE_PATIENT = ("contact", "client_enrollment")


def encounters_of(
    records: Mapping[str, DataFrame], form: Form, keep_voided: bool = False
) -> DataFrame:
    """Encounters of one form. The test forms are chosen by form uuid and keep
    voided encounters with their flag; the others by encounter type."""
    enc = records["encounter"]
    if form.name == "hts_test":
        forms = records["form"].filter(F.col("uuid").isin(list(TEST_FORMS.values()))).select(
            "form_id", F.col("uuid").alias("form_uuid"))
        return enc.join(forms, "form_id")
    if not keep_voided:
        enc = pivot.live(enc)
    enc = of_metadata(
        enc, "encounter_type", records["encounter_type"], "encounter_type_id",
        [ENCOUNTER_TYPES[form.name]])
    if form.name in LIVE_PATIENT:
        patients = pivot.live(records["patient"]).select("patient_id")
        enc = enc.join(patients, "patient_id", "left_semi")
    return enc


def members(records: Mapping[str, DataFrame], names: Sequence[str]) -> DataFrame:
    """(table_name, encounter_id, client_id) of the rows several forms' tables have, from
    one scan of the encounters and without folding an observation.

    Not for the test table, whose rows depend on the observations.
    """
    table = F.coalesce(*[F.when(F.col("uuid") == ENCOUNTER_TYPES[n], F.lit(n)) for n in names])
    kinds = records["encounter_type"].select(
        F.col("encounter_type_id").alias("encounter_type"), table.alias("table_name"))
    known = pivot.live(records["patient"]).select("patient_id", F.lit(True).alias("_known")).distinct()
    rows = pivot.live(records["encounter"]).join(kinds.filter("table_name IS NOT NULL"), "encounter_type")
    rows = rows.join(known, "patient_id", "left").filter(
        ~F.col("table_name").isin(list(LIVE_PATIENT)) | F.col("_known"))
    return rows.select("table_name", "encounter_id", F.col("patient_id").alias("client_id"))


def carried(rule: Rule) -> str:
    if rule.type == "date":
        return f"CAST({rule.key} AS DATE) AS {rule.name}"
    return f"substring({rule.key}, 1, {rule.width}) AS {rule.name}" if rule.width \
        else f"{rule.key} AS {rule.name}"


def kit_groups(obs: DataFrame, form: Form, clustered: bool = False) -> DataFrame:
    """One row per (encounter, observation group) with the parts of one test kit."""
    parts = pivot.of_concepts(obs, [r.concept for r in form.kit_parts])
    return pivot.eav_pivot(
        parts, form.kit_parts, ("encounter_id", "obs_group_id"), clustered=clustered)


def kit_slots(form: Form) -> list:
    """Per encounter, the kit of the groups that carry a first (second) result.

    Each column is maximised on its own over the encounter's groups.
    """
    out = []
    for rule in form.columns:
        if rule.source == "kit":
            result = f"result_{rule.key}"
            part = result if rule.kind == "result" else rule.kind
            held = f"CASE WHEN {result} IS NOT NULL THEN"
            value = f"max({held} {part} END)" if rule.type == "date" else \
                f"max({held} struct(lower({part}) AS folded, {part} AS raw) END).raw"
            out.append(F.expr(f"{value} AS {rule.name}"))
    return out


def repeat_mark(form: Form) -> dict[str, tuple[int, str]]:
    """The test-type aggregate: 2 where any observation marks a repeat test, else 1."""
    rule = next(r for r in form.columns if r.source == "test type")
    concept, code = rule.kind.split("=")
    hit = f"concept_id = {concept} AND value_coded = {code}"
    return {rule.name: (int(concept), f"max(CASE WHEN {hit} THEN 2 ELSE 1 END)")}


def build(
    records: Mapping[str, DataFrame],
    name: str,
    catalog: Catalog | None = None,
    keys: DataFrame | None = None,
    keep_voided: bool = False,
    clustered: bool = False,
) -> DataFrame:
    """The table of one form.

    ``keys`` (one column, encounter_id) limits the work to some encounters, each
    recomputed from all of its live observations; a refresh passes it together
    with ``keep_voided`` so that a soft delete reaches the table as a flag.
    ``clustered`` says that the observations are stored by encounter.
    """
    form = (catalog or default_catalog()).form(name)
    enc, obs = encounters_of(records, form, keep_voided), records["obs"]
    if keys is not None:
        enc = enc.join(keys, "encounter_id", "left_semi")
        obs = obs.join(keys, "encounter_id", "left_semi")
    if name == "hts_test":
        wide = _tests(enc, obs, form, clustered)
    else:
        asked = pivot.of_concepts(obs, form.concepts)
        folded = pivot.eav_pivot(asked, form.measures, clustered=clustered)
        wide = enc.join(folded, "encounter_id", "left")
    if owned := owned_identifiers(records, form):
        wide = wide.join(owned[1], "patient_id", "left")
    return wide.selectExpr(*[
        carried(r) if r.source == "encounter" else r.name for r in form.columns])


def owned_identifiers(records: Mapping[str, DataFrame], form: Form):
    """(columns, one row per patient with them), if the form carries identifiers."""
    rules = [r for r in form.columns if r.source == "identifier"]
    if not rules:
        return None
    found = identifiers_by_type(records, {r.name: r.key for r in rules})
    return [r.name for r in rules], found.withColumns(
        {r.name: F.substring(r.name, 1, r.width) for r in rules})


def audit(records: Mapping[str, DataFrame], name: str, catalog: Catalog | None = None) -> DataFrame:
    """(table_name, column_name, lost, n): how many values of a form's table the declared types cut
    or bound, of every column where they can.  Counted on the folded rows, before the types."""
    form = (catalog or default_catalog()).form(name)
    obs, enc = records["obs"], encounters_of(records, form).select("encounter_id")
    if name == "hts_test":
        groups = _groups(obs, form, False)
        kits = [r for r in form.kit_parts if r.kind in pivot.TEXT_KINDS]
        found = pivot.count_lost(enc.join(_asked(groups, form), "encounter_id"), form.measures).unionByName(
            pivot.count_lost(groups, kits, "kit."))
    else:
        folded = pivot.fold(pivot.of_concepts(obs, form.concepts), form.measures, ("encounter_id",))
        found = pivot.count_lost(enc.join(folded, "encounter_id"), form.measures)
    return found.select(F.lit(name).alias("table_name"), "column_name", "lost", "n")


def _groups(obs: DataFrame, form: Form, clustered: bool) -> DataFrame:
    """Answers and the parts of kits folded by (encounter, observation group), untyped, from one scan."""
    mark = repeat_mark(form)
    kit_concepts = [r.concept for r in form.kit_parts]
    held = {name: (concepts[0], f"max(CASE WHEN concept_id IN ({', '.join(map(str, sorted(concepts)))}) THEN 1 ELSE 0 END)")
            for name, concepts in (("_asked", list(form.concepts)), ("_kit", kit_concepts))}
    keys = ("encounter_id", "obs_group_id")
    return pivot.fold(
        pivot.of_concepts(obs, sorted({*form.concepts, *kit_concepts})), [*form.kit_parts, *form.measures], keys,
        {**mark, **held}, clustered)


def _asked(groups: DataFrame, form: Form) -> DataFrame:
    """The groups folded by encounter: kits typed, answers not yet.  An encounter has a row if it
    has a kit and an answer."""
    marks = [*repeat_mark(form), "_asked", "_kit"]
    groups = groups.selectExpr("encounter_id", *[f"{pivot.finish(r)} AS {r.name}" for r in form.kit_parts],
                               *[r.name for r in form.measures], *marks)
    return groups.groupBy("encounter_id").agg(
        *kit_slots(form), *[F.expr(pivot.folded_again(r)) for r in form.measures],
        *[F.max(m).alias(m) for m in marks]).filter("_asked = 1 AND _kit = 1")


def _tests(enc: DataFrame, obs: DataFrame, form: Form, clustered: bool) -> DataFrame:
    mark = repeat_mark(form)
    (column,) = mark
    asked = _asked(_groups(obs, form, clustered), form)
    kits = [r.name for r in form.columns if r.source == "kit"]
    asked = asked.selectExpr("encounter_id", *kits, *[f"{pivot.finish(r)} AS {r.name}" for r in form.measures], *mark)
    # one row per encounter on both sides, so the join cannot fan out
    wide = enc.join(asked, "encounter_id")
    confirmed = F.col("form_uuid") == TEST_FORMS["confirmatory"]
    return wide.withColumn(column, F.when(confirmed, F.lit(2)).otherwise(F.col(column)))
