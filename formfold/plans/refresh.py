"""Change-driven refresh of one table.

What changed decides which keys are recomputed, never which rows are: each
touched encounter is folded again from all of its live observations, so that a
single new answer does not blank the others.  A soft delete arrives as a flag.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formfold.catalog import Catalog, default_catalog
from formfold.operators.upsert import changed_encounters, changed_persons, upsert
from formfold.plans import forms, registry
from formfold.sources.curated import DIGEST, typed, with_digest
from formfold.sources.staging import shared_folder, written


def form_changes(
    records: Mapping[str, DataFrame], name: str, keys: DataFrame, catalog: Catalog | None = None
) -> DataFrame:
    """The touched rows of a form's table, recomputed in whole."""
    return forms.build(records, name, catalog, keys=keys, keep_voided=True)


def returned(records: Mapping[str, DataFrame], target: DataFrame, name: str, catalog: Catalog | None = None) -> DataFrame:
    """Encounters that belong in a table and have no live row there, by key: a patient may have
    come back, which no change time of an encounter tells.  Narrow scans of both sides."""
    now = forms.encounters_of(records, (catalog or default_catalog()).form(name)).select("encounter_id")
    return now.join(target.filter("voided = 0").select("encounter_id"), "encounter_id", "left_anti")


def touched_keys(records: Mapping[str, DataFrame], since, targets: Mapping[str, DataFrame],
                 catalog: Catalog | None = None) -> DataFrame:
    """All encounters that a refresh recomputes; targets: the tables that ask for a live patient."""
    keys = changed_encounters(records, since)
    for name, target in targets.items():
        keys = keys.union(returned(records, target, name, catalog))
    return keys.distinct()


def delta(
    target: DataFrame, changes: DataFrame, keys: DataFrame, records: Mapping[str, DataFrame], name: str,
    catalog: Catalog | None = None,
) -> DataFrame:
    """The rows of a table that differ after a refresh.

    A recomputed row replaces the old one; an old live row whose encounter was recomputed and no
    longer qualifies is voided; rows of other encounters change where their patient's
    identifiers or state did.  What is equal already is left out.
    """
    key, columns = "encounter_id", target.columns
    whole = f"struct({', '.join(columns)})"
    old = target.join(keys, key, "left_semi").selectExpr(f"{key} AS _key", f"{whole} AS _old")
    new = changes.selectExpr(f"{key} AS _key", f"{whole} AS _new")
    both = old.join(new, "_key", "full_outer")
    gone = {"voided": "1"}  # SQL texts, as everywhere where there are a hundred columns
    values = [f"if(_new IS NOT NULL, _new.{c}, {gone.get(c, f'_old.{c}')}) AS {c}" for c in columns]
    differs = "_new IS NULL AND _old.voided = 0 OR _new IS NOT NULL AND NOT _new <=> _old AS _differs"
    rows = both.selectExpr(*values, differs)
    form = (catalog or default_catalog()).form(name)
    if name not in forms.LIVE_PATIENT and not forms.owned_identifiers(records, form):
        return rows.filter("_differs").selectExpr(*columns)
    others = target.join(keys, key, "left_anti").selectExpr(*columns, "false AS _differs")
    now = reapplied(rows.unionByName(others), records, name, catalog)
    return now.filter("_differs OR _stale").selectExpr(*columns)


def refresh_form(
    target: DataFrame,
    records: Mapping[str, DataFrame],
    name: str,
    since,
    update_cols: Sequence[str] | None = None,
    catalog: Catalog | None = None,
) -> DataFrame:
    """The table of a form after the changes since a moment.

    Keys and changes are used several times: they are written once where the
    cluster names a shared folder, and recomputed where it does not.
    """
    folder = shared_folder(target.sparkSession)
    asked = {name: target} if name in forms.LIVE_PATIENT else {}
    keys = written(touched_keys(records, since, asked, catalog), "changed-encounters", folder)
    changes = form_changes(records, name, keys, catalog)
    if update_cols is None:
        rows = written(delta(target, changes, keys, records, name, catalog), f"changes-{name}", folder)
        return upsert(target, rows, "encounter_id").select(*target.columns)
    changes = written(changes, f"changes-{name}", folder)
    done = upsert(target, changes, "encounter_id", update_cols, recomputed=keys)
    return reapplied(done, records, name, catalog).select(*target.columns)


def reapplied(
    table: DataFrame, records: Mapping[str, DataFrame], name: str, catalog: Catalog | None = None
) -> DataFrame:
    """What no change of an encounter tells: identifiers as they now stand, and rows whose
    patient is no longer live voided.  ``_stale`` marks the rows that this changed."""
    form = (catalog or default_catalog()).form(name)
    columns, stale, names, gone = table.columns, ["false"], [], "false"
    if owned := forms.owned_identifiers(records, form):
        names, found = owned
        found = found.selectExpr("patient_id AS _owner", *[f"{n} AS _now_{n}" for n in names])
        table = table.join(found, F.col("client_id") == F.col("_owner"), "left")
        stale += [f"NOT {n} <=> _now_{n}" for n in names]
    if name in forms.LIVE_PATIENT:
        live = records["patient"].filter("voided = 0").select(F.col("patient_id").alias("_patient")).distinct()
        table = table.join(live, F.col("client_id") == F.col("_patient"), "left")
        gone = "coalesce(_patient IS NULL AND voided = 0, false)"
        stale.append(gone)
    changed = {**{n: f"_now_{n}" for n in names}, "voided": f"CAST(if({gone}, 1, voided) AS INT)"}
    return table.selectExpr(*[f"{changed.get(c, c)} AS {c}" for c in columns], f"{' OR '.join(stale)} AS _stale")


def registry_delta(target: DataFrame, records: Mapping[str, DataFrame], persons: DataFrame, only: bool = False) -> DataFrame:
    """The registry rows that differ from those of the target (client_id, row_digest), as they now
    stand.  Attributes, identifiers and addresses have no change time that reaches them, so all
    clients are compared by digest (only: those of ``persons``).  A voided person that the
    registry does not know is added if it is among ``persons``.
    """
    fresh = registry.build(records, persons if only else None, keep_voided=True).transform(with_digest)
    known = target.select("client_id", F.col(DIGEST).alias("_known"))
    asked = persons.select(F.col("person_id").alias("client_id"), F.lit(True).alias("_asked")).distinct()
    rows = fresh.join(known, "client_id", "left").join(asked, "client_id", "left")
    return rows.filter(f"_known IS NULL AND (voided = 0 OR _asked) OR _known <> {DIGEST}").drop("_known", "_asked", DIGEST)


def refresh_registry(target: DataFrame, records: Mapping[str, DataFrame], since) -> DataFrame:
    """The registry after the changes since a moment."""
    folder = shared_folder(target.sparkSession)
    persons = changed_persons(records, since)
    rows = written(registry_delta(with_digest(typed(target, "client_registration")), records, persons), "changed-clients", folder)
    return upsert(target, rows, "client_id").select(*target.columns)


def newly_voided(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows that a refresh turned from live to voided."""
    was_live = before.filter("voided = 0").select(key)
    return after.filter("voided = 1").join(was_live, key, "left_semi")
