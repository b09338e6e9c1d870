"""What the large plans move: modules cut by bitmaps, names and texts that come late or once per site."""

import pytest

from pondside.operators import joins, lookups, observations, visits
from pondside.operators.sites import areas_in_text
from pondside.plans.exports import export
from pondside.plans.synthesis import synthesis_feed
from small import ROWS, as_dicts, small_survey

IDS = [1, 2, 7, 8, 9, 32768, 32769, 65536, 10**12, 0, -1, -8, -32768, -(10**12), 2**63 - 1, -(2**63)]


def text_of(frame, capsys):
    capsys.readouterr()
    frame.explain()
    return capsys.readouterr().out


@pytest.mark.parametrize("joined", [True, False])
def test_module_too_large_for_its_keys_is_cut_by_bitmaps(spark, monkeypatch, capsys, joined):
    day = ROWS["visits"][0][6]
    kept, left = IDS[::2], IDS[1::2]
    rows = [(n, f"v{n}", 1, 1 if n in kept else 2, 1, 9, day, None) for n in IDS]
    rows += [(None, "v", 1, 1, 1, 9, day, None)] + [(n, f"v{n}", 1, 1, 1, 9, day, None) for n in range(100, 120)]
    bridge = [(n, 100) for n in [*IDS, *IDS, 3, 119, None]]
    db = small_survey(spark, visits=rows, visit_observers=bridge)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 20)
    cut = lookups.for_module(db, db["visit_observers"].distinct(), "mares", joined)
    assert not lookups.few_visits(db, "mares")
    assert sorted(r["id_base_visit"] for r in cut.collect()) == sorted([*kept, 119])
    text = text_of(cut, capsys)
    # Cut before the rows move to be told apart.
    assert text.index("HashAggregate") < text.index("BroadcastHashJoin")
    assert not set(left) & {r["id_base_visit"] for r in cut.collect()}


@pytest.mark.parametrize("build", [synthesis_feed, lambda db, m: export(db, "standard", m), observations.observation_flow])
def test_names_come_to_the_observations_by_visit(spark, monkeypatch, capsys, build):
    # A taxon given twice and one without an id repeat and drop rows as a join does.
    taxa = [*ROWS["taxref"], (1001, 500, "Rana a'", None, "Rana a' L."), (None, 1, "x", "x", "x")]
    expected = sorted(map(repr, build(small_survey(spark, taxref=taxa), "mares").collect()))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", -1)
    frame = build(small_survey(spark, taxref=taxa), "mares")
    assert sorted(map(repr, frame.collect())) == expected
    assert len(expected) >= 6
    lines = text_of(frame, capsys).splitlines()
    places = [i for i, line in enumerate(lines) if "hashpartitioning(cd_nom#" in line and "id_base_visit#" not in line]
    assert places
    # Two ids of an observation move to the taxa, not its row.
    assert not any("id_observation" in lines[i + 1] for i in places)


def test_people_of_few_roles_are_named_after_the_move(spark, capsys):
    lines = text_of(visits.visit_observers(small_survey(spark)), capsys).splitlines()
    moved = [i for i, line in enumerate(lines) if "hashpartitioning(id_base_visit#" in line]
    assert len(moved) == 1
    assert not any("collect_list" in line for line in lines[moved[0]:])


def test_texts_of_protected_areas_are_made_once_per_site(spark):
    db = small_survey(spark)
    rows = {r["id_base_site"]: r for r in as_dicts(areas_in_text(db), "id_base_site")}
    assert rows[3]["site_protege"] == "Combe(ZNIEFF1), Marais(ZNIEFF1), Marais(ZPS)" and rows[1]["site_protege"] is None
    core = visits.visit_core(db, "mares", areas=areas_in_text(db))
    assert "site_protege" in core.columns and "protected" not in core.columns


def test_texts_by_name_are_made_once_per_site(spark):
    db = small_survey(spark)
    rows = {r["id_base_site"]: r for r in as_dicts(areas_in_text(db, by_name=True), "id_base_site")}
    assert sorted((r["nom_protege"], r["site_protege"]) for r in rows[3]["protected_names"]) == [
        ("Combe", "Combe(ZNIEFF1)"), ("Marais", "Marais(ZNIEFF1), Marais(ZPS)")
    ]
    assert rows[1]["protected_names"] == []


def test_summary_names_few_taxa_after_the_move(spark, capsys):
    lines = text_of(observations.visit_summary(small_survey(spark)), capsys).splitlines()
    moved = [i for i, line in enumerate(lines) if "hashpartitioning(id_base_visit#" in line and "cd_nom#" not in line]
    assert len(moved) == 1
    assert not any("collect_set" in line for line in lines[moved[0]:])
