"""The catalogue against the specification's counts, and against its text."""

import pytest

from formfold.catalog import FORMS, Catalog, default_catalog, parse_answers
from formfold.sources.derived import answer_rows
from formfold.sources.schemas import schema_of
from oracle import survey

CAT = default_catalog()
MEASURES = {"contact": 14, "client_enrollment": 21, "clinical_visit": 112, "sti_treatment": 18,
            "peer_calendar": 22, "hts_test": 16, "violence_screening": 59}
COLUMNS = {"contact": 24, "client_enrollment": 30, "clinical_visit": 121, "sti_treatment": 27,
           "peer_calendar": 31, "hts_test": 34, "violence_screening": 67}


@pytest.mark.parametrize("name", FORMS)
def test_counts(name):
    form = CAT.form(name)
    assert len(form.measures) == MEASURES[name]
    assert len(form.columns) == COLUMNS[name]
    assert len({c.name for c in form.columns}) == COLUMNS[name]
    assert {r.concept for r in form.measures} <= set(form.concepts)
    assert len(schema_of(name)) == COLUMNS[name]


def test_registry_schema():
    assert len(schema_of("client_registration")) == 22


def test_kit_rules():
    form = CAT.form("hts_test")
    assert len(form.kit_parts) == 5
    assert sum(c.source == "kit" for c in form.columns) == 8
    assert 162084 in form.concepts


@pytest.mark.parametrize("name", FORMS)
def test_rules_are_those_of_the_specification(name):
    stated = {c: r for c, _, r in survey.form_columns(name)}
    for rule in CAT.form(name).measures:
        concept, what = stated[rule.name].split(" → ")
        assert rule.concept == int(concept)
        if rule.kind == "answers":
            labels, other = survey.decoders()[what]
            assert dict(rule.answers.labels) == labels and rule.answers.other == other
        elif rule.kind == "flag":
            assert what == f"flag:code=={rule.flag}"


def test_marts_are_those_of_the_specification():
    assert sorted(survey.marts()) == CAT.marts() and len(CAT.marts()) == 26
    for name in CAT.marts():
        stated, mart = survey.mart_columns(name), CAT.mart(name)
        if stated is None:
            assert mart.everything
            continue
        decoded, carried = stated
        assert list(mart.carried) == carried
        assert {c for c, _ in decoded} == (
            {c for c, _ in mart.decoded} | {c for c, _, _ in mart.dependent})
        for column, decoder in decoded:
            if decoder != "special":
                labels, other = survey.decoders()[decoder]
                answers = dict(mart.decoded)[column]
                assert dict(answers.labels) == labels and answers.other == other


def test_every_rule_is_met_by_the_derived_records():
    assert len(answer_rows(CAT)) == 614


def test_labels_keep_their_blanks():
    a = parse_answers("1= Injecting den; 730=CD4 PERCENT ; 2=a; b; else=NA")
    assert a.labels == ((1, " Injecting den"), (730, "CD4 PERCENT "), (2, "a; b")) and a.other == "NA"


def test_own_catalogue_directory(tmp_path):
    (tmp_path / "forms").mkdir()
    (tmp_path / "answers.txt").write_text("yes | 1=Ja; 2=Nein\n")
    (tmp_path / "forms" / "contact.txt").write_text("x | varchar(3) | concept 9 | answers @yes\n")
    (rule,) = Catalog(tmp_path).form("contact").columns
    assert rule.concept == 9 and rule.answers.ranked() == ["", "Ja", "Nein"]
