"""Whole runs on storage: a refresh gives what a rebuild gives."""

import os
from datetime import timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from formfold.catalog import FORMS, default_catalog
from formfold.operators import quality, reports
from formfold.plans import forms, marts, registry
from formfold.plans.workflows import PUBLISH, REBUILD, REFRESH, Workspace
from formfold.sources import curated, indexes, staging
from formfold.sources.derived import DerivedRecords, upstream
from formfold.sources.records import read_jdbc, read_sources
from formfold.sources.runlog import RunLog, present
from formfold.sources.schemas import declared, schema_of
from formfold.streaming.refresh import merge_batch, refresh_stream
from tests.conftest import SMALL

CUT = "2024-02-15"


def rows(df, live=False):
    df = df.filter("voided = 0") if live else df
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def space(spark):
    """A workspace that stood at the cut and was refreshed to the present."""
    import tempfile

    records = DerivedRecords(spark, SMALL)
    made = Workspace(spark, tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    made.rebuild(_all(records.before(CUT), records))
    made.refresh_since(_all(records, records), CUT)
    return made


class _all(dict):
    """Records of one state, the rest from the present."""

    def __init__(self, first, rest):
        super().__init__()
        self.first, self.rest = first, rest

    def __missing__(self, name):
        return self.first[name] if name in self.first else self.rest[name]


@pytest.mark.parametrize("name", FORMS)
def test_refresh_is_rebuild_on_live_rows(spark, space, name):
    records = DerivedRecords(spark, SMALL)
    built = curated.typed(forms.build(records, name), name)
    assert rows(space.table(name), live=True) == rows(built, live=True)
    assert quality.duplicate_keys(space.table(name), ["encounter_id"]).isEmpty()


def test_registry_refresh_is_rebuild_on_live_rows(spark, space):
    built = registry.build(DerivedRecords(spark, SMALL))
    assert rows(space.table("client_registration"), live=True) == rows(built, live=True)


def test_patients_that_came_back_have_their_rows(spark, space):
    records = DerivedRecords(spark, SMALL)
    then = records.before(CUT)["patient"].filter("voided = 1").select("patient_id")
    back = records["patient"].filter("voided = 0").join(then, "patient_id", "left_semi").withColumnRenamed("patient_id", "client_id")
    assert space.table("contact").filter("voided = 0").join(back, "client_id", "left_semi").count() > 0


def test_refreshing_twice_writes_nothing(spark, space):
    before = curated.state(spark, space.root)["tables"]
    records = DerivedRecords(spark, SMALL)
    keys = records["encounter"].select("encounter_id")
    with space.scratch():
        space.apply(records, keys, records["person"].select("person_id"))
    assert curated.state(spark, space.root)["tables"] == before


def test_a_refresh_writes_what_changed(spark, folder):
    """Few changed rows are a version of their own, many a whole one; the newest row of a key counts."""
    made = Workspace(spark, folder)
    base = forms.build(DerivedRecords(spark, SMALL), "contact")
    curated.write_curated(base, folder, "contact")
    keys = [r[0] for r in base.select("encounter_id").orderBy("encounter_id").limit(40).collect()]
    for i in range(curated.MOST_VERSIONS + 1):
        changed = made.table("contact").filter(f"encounter_id IN ({keys[i]}, {keys[i + 1]})").withColumn(
            "location_id", F.lit(100 + i).cast("int"))
        versions = curated.with_changes(changed, folder, "contact")
        assert [v["rows"] for v in versions[1:]] == ([2] * (i + 1) if i + 1 < curated.MOST_VERSIONS else [2] * max(0, i + 1 - curated.MOST_VERSIONS))
        curated.switch(spark, folder, {"contact": versions})
    places = {r["encounter_id"]: r["location_id"] for r in made.table("contact").collect()}
    assert len(places) == base.count() and [places[k] for k in keys[:4]] == [100, 101, 102, 103]
    assert curated.with_changes(made.table("contact").limit(0), folder, "contact") is None
    curated.vacuum(spark, folder, "contact")
    assert made.table("contact").count() == base.count()


def test_tables_switch_together(spark, folder):
    """A run that dies while it writes leaves all tables as they were."""
    made, records = Workspace(spark, folder), DerivedRecords(spark, SMALL)
    made.rebuild(_all(records.before(CUT), records))
    before = curated.state(spark, folder)
    broken = _all({"person_attribute": records["person_attribute"].filter("raise_error('store is gone') IS NULL")}, records)
    with pytest.raises(Exception, match="store is gone"):
        made.refresh_since(broken, CUT)
    assert curated.state(spark, folder) == before


def test_voided_encounters_are_flagged(spark, space):
    assert space.table("clinical_visit").filter("voided = 1").count() > 0


def test_stream_of_touched_encounters(spark, folder):
    records = DerivedRecords(spark, SMALL)
    made = Workspace(spark, folder)
    curated.write_curated(
        forms.build(_all(records.before(CUT), records), "contact"), folder, "contact")
    feed = f"{folder}/feed"
    records["encounter"].select("encounter_id").repartition(3).write.parquet(feed)
    stream = spark.readStream.schema("encounter_id long").option("maxFilesPerTrigger", 2).parquet(feed)
    for _ in range(2):  # the second start has nothing left to do
        query = refresh_stream(stream, made, lambda: records, f"{folder}/checkpoint", ("contact",), clients=False)
        assert query.awaitTermination(300)
    assert rows(made.table("contact"), live=True) == rows(
        curated.typed(forms.build(records, "contact"), "contact"), live=True)
    assert not [n for n in os.listdir(made.staging) if n.startswith(("batch-", "touched-"))]


def test_a_batch_that_comes_again_is_skipped(spark, folder):
    made, records, calls = Workspace(spark, folder), DerivedRecords(spark, SMALL), []
    made.rebuild(_all(records.before(CUT), records))

    def now():
        calls.append(1)
        return records

    merge = merge_batch(made, now, ("contact",), "a stream")
    patients = records["patient"].select(F.lit("patient").alias("kind"), F.col("patient_id").alias("id"))
    merge(patients, 0)
    first = curated.state(spark, folder)
    merge(patients, 0)
    assert curated.state(spark, folder) == first and len(calls) == 1 and first["batches"] == {"a stream": 0}
    # patients alone bring their encounters and their clients up to date
    live = records["patient"].filter("voided = 0").select(F.col("patient_id").alias("client_id"))
    gone = made.table("contact").filter("voided = 0").join(live, "client_id", "left_anti")
    assert gone.isEmpty()


def test_run_log(spark, folder):
    made = Workspace(spark, folder)
    assert made.log.since((REBUILD, REFRESH)) is None
    with made.run(REBUILD):
        pass
    with pytest.raises(RuntimeError):
        with made.run(REFRESH):
            raise RuntimeError("lost")
    first = made.log.since((REBUILD, REFRESH))
    assert first is not None
    history = made.log.runs().transform(reports.run_history).collect()
    assert [(r["script_name"], r["status"]) for r in history] == [
        (REFRESH, "Pending"), (REBUILD, "Success")]
    # the failed run does not move the watermark
    assert made.log.since((REBUILD, REFRESH)) == made.log.since((REBUILD,)) == first
    kept = made.log.remembered((REFRESH, PUBLISH), hours=0)
    assert [r["script_name"] for r in kept.collect()] == [REBUILD]
    # what the history no longer shows still counts for the watermark
    with made.run(REFRESH):
        pass
    assert made.log.since((REBUILD, REFRESH)) > first


def test_a_rebuild_that_fails_leaves_the_old_tables(spark, folder):
    records = DerivedRecords(spark, SMALL)
    made = Workspace(spark, folder)
    made.rebuild(records)
    before = {n: made.table(n).count() for n in ("client_registration", "contact", "hts_test")}
    broken = _all({"person": records["person"].limit(0), "encounter": records["encounter"].filter(
        "raise_error('store is gone') IS NULL")}, records)
    with pytest.raises(Exception, match="store is gone"):
        made.rebuild(broken)
    assert {n: made.table(n).count() for n in before} == before
    assert not list(Path(made.staging).glob("observations-*"))


def file_ranges(path, column):
    """(least, largest) value of a column in each file."""
    out = []
    for f in Path(path).glob("*.parquet"):
        values = [x for x in pq.read_table(f, columns=[column])[column].to_pylist() if x is not None]
        out.append((min(values), max(values)) if values else None)
    return out


@pytest.mark.parametrize("name", ["client_registration", "contact", "clinical_visit", "sti_treatment", "violence_screening", "peer_calendar"])
def test_tables_are_laid_out_by_their_indexes(spark, space, name):
    """In 16 files a value of any indexed column is in at most three quarters of them, and one of
    the first column in at most half, where its values differ enough."""
    curated.optimize(spark, space.root, name, files=16)
    made = space.table(name).count()
    path = f"{space.root}/{name}/version={curated.versions_of(spark, space.root, name)[-1]['version']}"
    for i, column in enumerate(indexes.of_table(name)):
        ranges = file_ranges(path, column)
        values = [r[0] for r in space.table(name).filter(f"{column} IS NOT NULL").select(column).collect()]
        if len(set(values)) < 8:
            continue
        read = sum(sum(r is not None and r[0] <= v <= r[1] for r in ranges) for v in values) / len(values)
        assert read <= (0.55 if i == 0 else 0.8) * len(ranges), (column, read, len(ranges))
    assert space.table(name).count() == made


def test_marts_are_decoded_behind_the_shuffle(spark, folder):
    """A mart's source rows travel in the order of its indexes and get their labels behind; a publication does so."""
    rules = default_catalog().mart("hiv_followup")
    source = upstream(spark, SMALL, rules).withColumn("unread", F.lit("x")).localCheckpoint()
    mart = marts.build({rules.source: source}, "hiv_followup")
    rows = indexes.laid_out(mart, indexes.of_mart("hiv_followup"), 4, (source, marts.expressions(source, rules)))
    assert rows.schema == mart.schema
    assert rows.exceptAll(mart).count() == mart.exceptAll(rows).count() == 0
    asked = []
    real = indexes.laid_out
    try:
        indexes.laid_out = lambda *args, **named: asked.append(real(*args, **named)) or asked[-1]
        Workspace(spark, folder, staging=folder).publish({rules.source: source}, ["hiv_followup"])
    finally:
        indexes.laid_out = real
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    plan = asked[0]._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.index(" AS who_stage") < plan.index("RepartitionByExpression")
    assert " AS who_stage" not in plan[plan.index("RepartitionByExpression"):]
    assert "unread" not in plan[:plan.index("LogicalRDD")]
    assert curated.read_mart(spark, f"{folder}/marts", "hiv_followup").exceptAll(mart).count() == 0


def test_index_columns_exist():
    for name, columns in indexes.listed().items():
        kind, table = name.split(" ")
        if kind == "form":
            assert set(columns) <= {c for c, _ in declared(table)}, name


def test_run_log_is_put_together(spark, folder):
    log = RunLog(spark, folder, most=6)
    ids = []
    for i in range(7):
        ids.append(log.start(f"run {i % 2}"))
        log.stop(ids[-1], "lost" if i == 3 else None)
    assert len(os.listdir(folder)) <= 12 and log.runs().count() == 7
    assert log.runs().filter("error = 'lost' AND stop_time IS NOT NULL").count() == 1
    old = RunLog(spark, folder, days=0, clock=lambda: present() + timedelta(days=1))
    old.compact()
    assert {r["id"] for r in old.runs().collect()} == set(ids[-2:])


def test_copies_go(spark, folder):
    df = staging.written(spark.range(3), "few", folder)
    path = staging.kept_folder(spark, folder)
    assert df.count() == 3 and os.listdir(path)
    kept = {p: s for p, s in staging._kept.items() if p != path}
    staging._kept.clear()
    staging._kept[path] = spark
    staging.sweep()
    staging._kept.update(kept)
    assert not os.path.exists(path)


def test_publish_and_recreate(spark, folder):
    catalog = default_catalog()
    names = ["patient_demographics", "laboratory_extract", "hts_test"]
    tables = {catalog.mart(n).source: upstream(spark, SMALL, catalog.mart(n)) for n in names}
    made = Workspace(spark, folder)
    made.publish(tables, names)
    got = curated.read_mart(spark, f"{folder}/marts", "laboratory_extract")
    assert got.count() == tables["etl_laboratory_extract"].count()
    assert "HIV VIRAL LOAD" in {r[0] for r in got.select("lab_test").distinct().collect()}
    curated.reset(spark, folder)
    for name in FORMS:
        empty = made.table(name)
        assert empty.count() == 0 and empty.columns == schema_of(name).names


def test_a_mart_that_fails_leaves_the_old_ones(spark, folder):
    catalog = default_catalog()
    names = ["patient_demographics", "triage"]
    tables = {catalog.mart(n).source: upstream(spark, SMALL, catalog.mart(n)) for n in names}
    made = Workspace(spark, folder)
    made.publish(tables, names)
    before = curated.state(spark, f"{folder}/marts")
    source = catalog.mart("triage").source
    with pytest.raises(Exception, match="store is gone"):
        made.publish({**tables, source: tables[source].filter("raise_error('store is gone') IS NULL")}, names)
    few = {**tables, catalog.mart(names[0]).source: tables[catalog.mart(names[0]).source].limit(1)}
    with pytest.raises(ValueError, match="no row in their parent"):
        made.publish(few, names, strict=True)
    assert curated.state(spark, f"{folder}/marts") == before
    made.publish(few, names)
    assert curated.read_mart(spark, f"{folder}/marts", "mart_orphans").count() > 0


def test_broken_references(spark):
    child = spark.createDataFrame([(1, 7), (1, 8), (2, None), (None, 7), (1, 7)], "a long, b int")
    parents = {"p": spark.createDataFrame([(2,)], "a long"), "q": spark.createDataFrame([(8,), (8,)], "k int")}
    got = quality.broken_references({"c": child, **parents}, [("c", "a", "p", "a"), ("c", "b", "q", "k")])
    assert sorted(tuple(r) for r in got.collect()) == [("c", "a", "p", "1", 3), ("c", "b", "q", "7", 3)]


def test_publish_to_a_database(spark):
    curated.reset_database(spark, "reporting")
    df = upstream(spark, SMALL, default_catalog().mart("hts_test"))
    curated.publish_mart(df, "hts_test", database="reporting")
    assert spark.table("reporting.hts_test").count() == df.count()


def test_read_sources(spark, folder):
    records = DerivedRecords(spark, SMALL)
    for name in ("person", "encounter"):
        records[name].write.parquet(f"{folder}/{name}")
    got = read_sources(spark, folder, ("person", "encounter"))
    assert got["person"].columns == records["person"].columns


def test_json_dump(spark, folder):
    clients = registry.build(DerivedRecords(spark, SMALL))
    reports.dump_json(clients, f"{folder}/clients")
    assert spark.read.json(f"{folder}/clients").count() == clients.count()


def test_orphan_of_a_missing_person(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "client_id long")
    parent = spark.createDataFrame([(2,)], "client_id long")
    got = quality.orphans(child, "client_id", parent, "client_id").collect()
    assert [tuple(r) for r in got] == [(1, 2)]


def test_cross_tab_order(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "y"), ("b", "x")], "r string, c string")
    wide = reports.cross_tab_wide(df, "r", "c", ["x", "y"]).collect()
    assert [tuple(r) for r in wide] == [("b", 2, 1, 0), ("a", 1, 0, 0)]
    short = reports.cross_tab_wide(df, "r", "c", ["y"]).collect()
    assert [tuple(r) for r in short] == [("b", 1, 2), ("a", 0, 1)]
    places = {(r["r"], r["c"]): (r["row_place"], r["column_place"])
              for r in reports.cross_tab(df, "r", "c").collect()}
    assert places == {("b", "x"): (1, 1), ("b", "y"): (1, 2), ("a", "x"): (2, 1)}
    gaps = reports.cross_tab(df.union(spark.createDataFrame([(None, "x")], df.schema)), "r", "c")
    assert gaps.count() == 4 and gaps.filter("r IS NULL").first()["row_total"] == 1


def test_growing_tables_need_key_ranges(spark):
    with pytest.raises(ValueError, match="obs grows"):
        read_jdbc(spark, "jdbc:none", {}, 4, ("obs",))


def test_copies_of_touched_observations_hold_what_is_read(spark, folder):
    """One copy by form, of touched encounters alone and without values that no rule reads."""
    from formfold.operators import pivot
    from formfold.plans.metadata import ENCOUNTER_TYPES
    text = next(r for r in default_catalog().form("clinical_visit").measures if r.kind in pivot.TEXT_KINDS)
    coded = next(r for r in default_catalog().form("clinical_visit").measures if r.kind == "answers")
    assert text.concept != coded.concept
    rows = [(1, 0, text.concept, None, 1.5, "a", 0), (1, 0, coded.concept, 7, 2.5, "b", 0), (1, 0, 424242, 1, None, "c", 0),
            (1, 0, text.concept, None, None, "voided", 1), (2, 0, text.concept, None, None, "other", 0), (3, 0, text.concept, None, None, "form", 0)]
    obs = spark.createDataFrame(rows, "encounter_id long, obs_group_id int, concept_id int, value_coded int, value_numeric double, "
                                "value_text string, voided int").selectExpr("*", "TIMESTAMP '2024-01-01 00:00:00' AS value_datetime")
    records = dict.fromkeys(("patient", "patient_identifier", "patient_identifier_type"))
    records |= {"obs": obs, "form": spark.createDataFrame([], "form_id int, uuid string"),
                "encounter": spark.createDataFrame([(1, 0, 0), (2, 0, 0), (3, 1, 0)], "encounter_id long, encounter_type int, form_id int"),
                "encounter_type": spark.createDataFrame([(0, ENCOUNTER_TYPES["clinical_visit"]), (1, ENCOUNTER_TYPES["contact"])],
                                                        "encounter_type_id int, uuid string")}
    space = Workspace(spark, f"{folder}/root", staging=f"{folder}/staging")
    keys = spark.createDataFrame([(1,), (3,)], "encounter_id long")
    touched = space.touched_records(records, keys, ["clinical_visit"])["clinical_visit"]
    assert sorted(r.encounter_id for r in touched["encounter"].collect()) == [1, 3]
    found = {(r.encounter_id, r.concept_id, r.value_coded, r.value_text) for r in touched["obs"].collect()}
    assert found == {(1, text.concept, None, "a"), (1, coded.concept, 7, None)}


def coded_rows(spark, rules):
    """Rows of a mart's source: every listed code in turn, an unlisted one and none."""
    codes = {c: [code for code, _ in a.labels] for c, a in rules.decoded}
    for c, by, cases in rules.dependent:
        codes[c] = [code for _, a in cases for code, _ in a.labels]
        codes[by] = [value for value, _ in cases]
    plain = [f"if(id % 5 = 0, NULL, concat('{c}', id % 7)) AS {c}" for c in rules.carried if c not in codes]
    picked = [f"get(array({', '.join(map(str, listed))}, 424242), CAST((id + {k}) % {len(listed) + 2} AS INT)) AS {c}"
              for k, (c, listed) in enumerate(codes.items())]
    return spark.range(60).selectExpr(*plain, *picked)


@pytest.mark.parametrize("name", ["hiv_followup", "mch_antenatal_visit", "laboratory_extract"])
def test_packed_rows_give_the_mart(spark, name):
    """The rows that travel are narrower than the source's and give the same labels."""
    rules = default_catalog().mart(name)
    source = coded_rows(spark, rules)
    mart = marts.build({rules.source: source}, name)
    travelling, made = marts.packed(source, rules)
    rows_ = travelling.selectExpr(*[f"{made[c]} AS `{c}`" for c in mart.columns])
    assert [(f.name, f.dataType) for f in rows_.schema] == [(f.name, f.dataType) for f in mart.schema]
    assert rows_.exceptAll(mart).count() == mart.exceptAll(rows_).count() == 0
    if len(rules.decoded) > 10:
        assert 2 * len([c for c in travelling.columns if c.startswith("_word_")]) < len(rules.decoded)


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}


def test_a_publication_leaves_little_on_disk(spark, folder):
    """Its shuffle files go when a mart is written, and filters are as large as the rows need."""
    import time
    rules = default_catalog().mart("mch_antenatal_visit")
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, set_before = shuffle_files(spark), spark.conf.get(setting, None)
    space = Workspace(spark, f"{folder}/root", staging=f"{folder}/staging")
    seen, real = [], space.broken_references
    space.broken_references = lambda made: seen.append(spark.conf.get(setting)) or real(made)
    space.publish({rules.source: coded_rows(spark, rules)}, ["mch_antenatal_visit"])
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert seen == ["true"] and spark.conf.get(setting, None) == set_before
    files = list(Path(f"{folder}/root/marts/mch_antenatal_visit").glob("version=*/*.parquet"))
    assert files and max(f.stat().st_size for f in files) < 500_000
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}


def test_the_driver_gives_memory_back(spark, monkeypatch):
    """After every piece of work, also one that fails, and by a command that this JVM has."""
    from contextlib import nullcontext

    from formfold.plans import workflows
    monkeypatch.setattr(staging, "suppress", lambda *errors: nullcontext())
    given, real = [], staging.give_back
    monkeypatch.setattr(workflows, "give_back", lambda s: given.append(real(s)))
    assert workflows.at_once(spark, {"a": lambda: 1, "b": lambda: 2}, 2) == {"a": 1, "b": 2}
    assert len(given) == 2
    with pytest.raises(ZeroDivisionError):
        workflows.at_once(spark, {"a": lambda: 1 / 0}, 2)
    assert len(given) == 3
