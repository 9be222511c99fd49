"""Whole runs: rebuild everything, refresh what changed, publish the marts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime
from functools import partial
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formfold.catalog import FORMS, Catalog, default_catalog
from formfold.operators import pivot, quality
from formfold.operators.reports import run_history
from formfold.operators.upsert import changed_persons
from formfold.plans import forms, marts, refresh, registry
from formfold.plans.metadata import ENCOUNTER_TYPES, TEST_FORMS
from formfold.session import tune
from formfold.sources import curated
from formfold.sources.derived import values
from formfold.sources.runlog import RunLog, present
from formfold.sources.schemas import declared_references
from formfold.sources.staging import give_back, remove, shared_folder

T = TypeVar("T")

# names of the runs, also what retention goes by
REBUILD, REFRESH, PUBLISH = "rebuild", "scheduled_updates", "publish_marts"
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage_observations(
    records: Mapping[str, DataFrame], catalog: Catalog, path: str, names: Iterable[str] = FORMS
) -> dict[str, DataFrame]:
    """The observations the forms ask for, read once and written by form.

    Eight tables come from one store; without this each would scan all of it.
    Only narrow columns travel, once, joined by encounter and form, and only values that
    some rule reads; a hot encounter splits on the observation side.  The files hold whole
    encounters in order, so the folds need not gather them again.
    """
    obs = records["obs"]
    spark = obs.sparkSession
    wanted, columns = [], ["value_numeric", "value_text", "value_datetime"]
    for name in names:
        form = catalog.form(name)
        concepts = set(form.concepts) | {r.concept for r in form.kit_parts}
        read = {(r.concept, pivot.VALUE_OF[r.kind]) for r in [*form.measures, *form.kit_parts]}
        wanted += [(c, name, *[int((c, v) in read) for v in columns]) for c in sorted(concepts)]
    asked = values(spark, wanted, {"concept_id": "INT", "form": "STRING", **{f"reads_{v}": "INT" for v in columns}})
    typed = records["encounter_type"].select(F.col("encounter_type_id").alias("encounter_type"), "uuid")
    tests = records["form"].filter(F.col("uuid").isin(list(TEST_FORMS.values()))).select("form_id")
    form_of = F.coalesce(*[
        F.when(F.col("et.uuid") == u, F.lit(n)) for n, u in ENCOUNTER_TYPES.items()])
    by_type = (
        records["encounter"].alias("e").join(typed.alias("et"), "encounter_type")
        .select("e.encounter_id", form_of.alias("form")).filter("form IS NOT NULL"))
    by_form = records["encounter"].join(tests, "form_id", "left_semi").select(
        "encounter_id", F.lit("hts_test").alias("form"))
    keys = ["encounter_id", "obs_group_id", "concept_id", "value_coded", "voided"]
    chosen = (
        pivot.of_concepts(obs, sorted({c for c, *_ in wanted})).select(*keys, *columns)
        .join(asked, "concept_id")
        .select(*keys, "form", *[F.expr(f"CASE WHEN reads_{v} = 1 THEN {v} END AS {v}") for v in columns])
        .join(by_type.unionByName(by_form), ["encounter_id", "form"]))
    (chosen.sortWithinPartitions("form", "encounter_id")
     .write.partitionBy("form").parquet(path))
    staged = spark.read.schema(chosen.select(*keys, *columns, "form").schema).parquet(path)
    return {n: staged.filter(F.col("form") == n).drop("form") for n in names}


def at_once(spark: SparkSession, works: Mapping[str, Callable[[], T]], threads: int) -> dict[str, T]:
    """The results of independent pieces of work, a few at the same time.  If one fails, those
    that wait are dropped and its error is raised when the running ones are done.  What the driver
    took to plan a piece goes back to the system when the piece is done."""
    def done(work):
        try:
            return work()
        finally:
            give_back(spark)

    with ThreadPoolExecutor(threads) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(partial(done, work))) for name, work in works.items()}
        try:
            return {name: future.result() for name, future in running.items()}
        except BaseException:
            pool.shutdown(cancel_futures=True)
            raise


@dataclass
class Workspace:
    """Where the curated tables, the marts and the run log live.  ``threads`` tables of a run are
    written at the same time; all become current together."""

    spark: SparkSession
    root: str
    catalog: Catalog = field(default_factory=default_catalog)
    staging: str | None = None
    threads: int = 4
    clock: Callable[[], datetime] = present

    def __post_init__(self):
        tune(self.spark)
        self.staging = shared_folder(self.spark, self.staging)
        if not self.staging:
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        self.copies: list[str] = []
        self.log = RunLog(self.spark, f"{self.root}/run_log", clock=lambda: self.clock())

    @contextmanager
    def run(self, name: str):
        """A logged run: stopped also when it fails, and then with its error."""
        run, error = self.log.start(name), None
        try:
            with self.scratch():
                yield
        except Exception as e:
            error = f"{type(e).__name__}: {e}"
            raise
        finally:
            self.log.stop(run, error)

    @contextmanager
    def scratch(self):
        """Copies made within are deleted at the end: nothing reads them after it.  Shuffle files go
        with the write that made them, not when the driver next collects its garbage."""
        before = self.spark.conf.get(DROP_SHUFFLES, None)
        self.spark.conf.set(DROP_SHUFFLES, "true")
        try:
            yield
        finally:
            if before is None:
                self.spark.conf.unset(DROP_SHUFFLES)
            else:
                self.spark.conf.set(DROP_SHUFFLES, before)
            for path in self.copies:
                remove(self.spark, path)
            self.copies.clear()
            self.spark._jvm.System.gc()  # broadcasts of the run go, and the heap shrinks
            give_back(self.spark)

    def fresh(self, what: str) -> str:
        self.copies.append(f"{self.staging}/{what}-{uuid.uuid4().hex}")
        return self.copies[-1]

    def written(self, df: DataFrame, what: str) -> DataFrame:
        path = self.fresh(what)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def table(self, name: str) -> DataFrame:
        return curated.read_curated(self.spark, self.root, name)

    def rebuild(self, records: Mapping[str, DataFrame]) -> None:
        """All eight curated tables from the records."""
        with self.run(REBUILD):
            staged = stage_observations(records, self.catalog, self.fresh("observations"))

            def form(name):
                own = {**{t: records[t] for t in _FORM_RECORDS}, "obs": staged[name]}
                return [curated.prepare(forms.build(own, name, self.catalog, clustered=True), self.root, name)]

            works = {name: partial(form, name) for name in FORMS}
            works[REGISTRY] = lambda: [curated.prepare(registry.build(records), self.root, REGISTRY)]
            curated.switch(self.spark, self.root, at_once(self.spark, works, self.threads))

    def refresh(self, records: Mapping[str, DataFrame]) -> None:
        """Bring in what changed since the last finished rebuild or refresh; without
        one, rebuild."""
        since = self.log.since((REBUILD, REFRESH))
        if since is None:
            return self.rebuild(records)
        with self.run(REFRESH):
            self.bring_in(records, since)

    def refresh_since(self, records: Mapping[str, DataFrame], since) -> None:
        """What a logged refresh does, from a moment on."""
        with self.scratch():
            self.bring_in(records, since)

    def bring_in(self, records: Mapping[str, DataFrame], since) -> None:
        at = F.lit(since).cast("timestamp")
        asked = {name: self.table(name) for name in forms.LIVE_PATIENT}
        keys = partial(self.written, refresh.touched_keys(records, at, asked, self.catalog), "changed-encounters")
        persons = partial(self.written, changed_persons(records, at), "changed-persons")
        found = at_once(self.spark, {"keys": keys, "persons": persons}, self.threads)
        self.apply(records, found["keys"], found["persons"])

    def apply(self, records: Mapping[str, DataFrame], keys: DataFrame, persons: DataFrame | None = None, tables=FORMS,
              only: bool = False, batch: tuple[str, int] | None = None) -> None:
        """Recompute some encounters in their tables, and the clients that differ (only: of
        ``persons``) in the registry; tables that do not change are not written."""
        touched = self.touched_records(records, keys, tables)
        works = {name: partial(self.changed_form, touched[name], name, keys) for name in tables}
        if persons is not None:
            works[REGISTRY] = partial(self.changed_registry, records, persons, only)
        made = at_once(self.spark, works, self.threads)
        curated.switch(self.spark, self.root, {n: v for n, v in made.items() if v}, batch)

    def touched_records(self, records, keys: DataFrame, tables: Iterable[str]) -> dict[str, dict[str, DataFrame]]:
        """The records of some encounters by form: the store is read once for all the forms, and its
        copies hold the touched encounters' values alone, as those of a rebuild."""
        encounters = self.written(records["encounter"].join(keys, "encounter_id", "left_semi"), "touched-encounter")
        own = {**{t: records[t] for t in _FORM_RECORDS}, "encounter": encounters}
        staged = stage_observations({**own, "obs": records["obs"]}, self.catalog, self.fresh("touched-obs"), tables)
        return {name: {**own, "obs": obs} for name, obs in staged.items()}

    def changed_form(self, records, name: str, keys: DataFrame) -> list[dict] | None:
        made = forms.build(records, name, self.catalog, keep_voided=True, clustered=True)
        changes = curated.typed(made, name)
        rows = refresh.delta(self.table(name), changes, keys, records, name, self.catalog)
        return curated.with_changes(rows, self.root, name)

    def changed_registry(self, records, persons: DataFrame, only: bool) -> list[dict] | None:
        versions = curated.versions_of(self.spark, self.root, REGISTRY)
        known = curated.read_versions(self.spark, self.root, REGISTRY, versions, digest=True)
        return curated.with_changes(refresh.registry_delta(known, records, persons, only), self.root, REGISTRY)

    def publish(self, upstream: Mapping[str, DataFrame], names: Iterable[str] | None = None, strict: bool = False) -> None:
        """All marts from their upstream tables, current together.  References that their parent
        lacks are written to `mart_orphans`; strict: and then nothing is published."""
        names, root = list(names or self.catalog.marts()), f"{self.root}/marts"
        with self.run(PUBLISH):
            rules = {n: self.catalog.mart(n) for n in names}
            works = {n: partial(curated.prepare_mart, marts.build(upstream, n, self.catalog), n, root,
                                made=marts.packed(upstream[m.source], m)) for n, m in rules.items()}
            made = at_once(self.spark, works, self.threads)
            broken = curated.write_version(self.broken_references(made), root, "mart_orphans")
            if strict and broken["rows"]:
                raise ValueError(f"{broken['rows']} references of the marts have no row in their parent")
            curated.switch(self.spark, root, {**{n: [v] for n, v in made.items()}, "mart_orphans": [broken]})

    def broken_references(self, made: Mapping[str, dict]) -> DataFrame:
        """Broken references of marts that were written, against the newest version of their parents."""
        root = f"{self.root}/marts"
        current = {n: v[-1] for n, v in curated.state(self.spark, root)["tables"].items()}
        versions = {f"mart.{n}": f"{root}/{n}/version={v['version']}" for n, v in {**current, **made}.items()}
        asked = [r for r in declared_references() if r[0].removeprefix("mart.") in made and r[0] != r[2] and r[2] in versions]
        if not asked:
            return self.spark.createDataFrame([], quality.BROKEN)
        tables = {n: self.spark.read.parquet(versions[n]) for r in asked for n in (r[0], r[2])}
        return quality.broken_references(tables, asked)

    def history(self) -> DataFrame:
        return run_history(self.log.remembered((REFRESH, PUBLISH)))

    def refresh_all(self, records, upstream) -> DataFrame:
        self.refresh(records)
        self.publish(upstream)
        return self.history()

    def recreate_all(self, records, upstream) -> DataFrame:
        self.rebuild(records)
        self.publish(upstream)
        return self.history()


REGISTRY = "client_registration"
_FORM_RECORDS = ("encounter", "encounter_type", "form", "patient", "patient_identifier",
                 "patient_identifier_type")
