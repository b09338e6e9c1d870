"""The exports on the small survey, with results worked out by hand."""

import json

import pytest
from pyspark.sql import functions as F

from pondside.operators import lookups, observations, sites, visits
from pondside.operators.lookups import module_filter
from pondside.plans.exports import EXPORTS, export
from pondside.plans.synthesis import additional_data, synthesis_feed
from pondside.schemas import ANALYSES_COLUMNS, FEED_COLUMNS, STANDARD_COLUMNS
from small import ROWS, as_dicts, small_survey


def test_module_code_is_compared_with_case(db):
    assert [r["id_base_visit"] for r in as_dicts(lookups.module_filter(db, "MARES"))] == [7]


def test_analyses_rows_and_grain(db):
    rows = as_dicts(export(db, "analyses", "mares"), "uuid_visite", "commune", "site_protege")
    # v1, v2 at one commune; v3 in two communes and two protected names; v8 in none. v4 lacks a
    # group, v5 a site complement, v6 a complement, v7 the module.
    assert [(r["uuid_visite"], r["commune"], r["site_protege"]) for r in rows] == [
        ("v1", "L'Isle", None),
        ("v2", "L'Isle", None),
        ("v3", "Bourg", "Combe(ZNIEFF1)"),
        ("v3", "Bourg", "Marais(ZNIEFF1), Marais(ZPS)"),
        ("v3", "L'Isle", "Combe(ZNIEFF1)"),
        ("v3", "L'Isle", "Marais(ZNIEFF1), Marais(ZPS)"),
        ("v8", None, None),
    ]


def test_analyses_values_of_a_visit(db):
    row = as_dicts(export(db, "analyses", "mares").where("uuid_visite = 'v1'"))[0]
    assert row["observers"] == "Zoé Anne ; Abel  ; Luc Bob"
    assert row["organismes_rattaches"] == "Club"
    assert row["visite"] == '"1er passage"'
    assert row["accessibilite"] == "Oui"
    assert row["methodes_prospection"] == "Chant ; Vue"
    assert row["vent"] == "Calme"
    assert (row["altitude_min"], row["altitude_max"]) == (190, 210)
    assert row["milieu_aquatique"] == "Mare"
    assert row["jeu_de_donnees"] == "Jeu 1"
    assert (row["annee"], row["departement"], row["code_dep"]) == (2022, "Isère", "38")
    # The unknown taxon and the missing one count in the sums, not in the names.
    assert (row["diversite"], row["taxons_latin"], row["taxons_fr"]) == (
        1,
        "Rana a ; Rana b",
        "Grenouille",
    )
    assert (row["abondance_total_min"], row["abondance_total_max"]) == (16, 8)


def test_missing_and_null_values(db):
    rows = as_dicts(export(db, "analyses", "mares"), "uuid_visite")
    second = next(r for r in rows if r["uuid_visite"] == "v2")
    assert second["visite"] is None and second["accessibilite"] == "null"
    assert second["vent"] is None and second["methodes_prospection"] is None
    # A role that does not exist is no observer; no observation gives NULL, not 0.
    assert second["observers"] is None and second["diversite"] is None
    assert second["id_dataset"] is None and second["jeu_de_donnees"] is None
    third = next(r for r in rows if r["uuid_visite"] == "v3")
    assert third["visite"] == "null"
    assert third["id_dataset"] == 77 and third["jeu_de_donnees"] is None
    assert third["milieu_aquatique"] is None and third["courant"] is None
    assert third["organismes_rattaches"] is None
    # Observation g has no complement, and f holds text and a fraction where counts are due.
    assert third["abondance_total_min"] is None and third["diversite"] == 2
    last = next(r for r in rows if r["uuid_visite"] == "v8")
    assert last["altitude_min"] is None and last["methodes_prospection"] is None


def test_standard_rows(db):
    rows = as_dicts(export(db, "standard", "mares"), "uuid_observation", "commune")
    # d and e have no known taxon, g no complement, h another module.
    assert [(r["uuid_observation"], r["commune"]) for r in rows] == [
        ("ua", "L'Isle"),
        ("ub", "L'Isle"),
        ("uc", "L'Isle"),
        ("uf", "Bourg"),
        ("uf", "L'Isle"),
    ]
    first = rows[0]
    assert (first["stade_vie"], first["sexe"], first["type_denombrement"]) == (
        "Adulte",
        "Inconnu",
        "Compté",
    )
    assert (first["count_min"], first["count_max"]) == (2, 5)
    assert rows[3]["site_protege"] == "Combe(ZNIEFF1), Marais(ZNIEFF1), Marais(ZPS)"
    assert rows[3]["count_min"] is None and rows[3]["count_max"] is None


def test_feed_rows(db):
    rows = as_dicts(synthesis_feed(db, "mares"), "id_observation")
    assert [r["id_observation"] for r in rows] == ["a", "b", "c", "f"]
    first = rows[0]
    assert first["id_source"] == 7 and first["entity_source_pk_value"] == "a"
    assert first["ids_observers"] == [100, 101, 102]
    assert first["id_nomenclature_obs_meth"] == 9
    assert first["id_nomenclature_bio_condition"] is None
    assert first["the_geom_4326"] == first["the_geom_point"] == {"x": 5.0, "y": 45.0}
    assert first["the_geom_local"] == {"x": 110_000.0, "y": 6_060_000.0}
    assert first["date_min"] == first["date_max"]
    assert first["nom_cite"] == "Rana a L."


def test_additional_data_keeps_null_keys(db):
    rows = {r["id_base_visit"]: r["additional_data"] for r in as_dicts(additional_data(db, "mares"))}
    first, second = json.loads(rows[1]), json.loads(rows[2])
    assert first["num_passage"] == '"1er passage"' and first["accessibilite"] == "Oui"
    assert len(first) == 15 and first["rives"] is None
    assert second["num_passage"] is None and second["accessibilite"] is None


def test_source_unknown_and_ambiguous(spark, db):
    assert lookups.source_lookup(db, "autre").count() == 0
    unknown = small_survey(spark, sources=[(8, "MONITORING_X")])
    assert {r["id_source"] for r in as_dicts(lookups.source_lookup(unknown, "mares"))} == {None}
    twice = small_survey(spark, sources=[(7, "MONITORING_MARES"), (8, "MONITORING_MARES")])
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        lookups.source_lookup(twice, "mares").collect()


@pytest.mark.parametrize("method", EXPORTS)
def test_keys_are_unique(db, method):
    frame = export(db, method, "mares")
    key = ["uuid_observation"] if method == "standard" else ["uuid_visite", "site_protege"]
    doubled = frame.groupBy(*key, "commune", "departement", "code_dep").count().where("count > 1")
    assert doubled.count() == 0


def test_column_order(db):
    assert export(db, "standard", "mares").columns == STANDARD_COLUMNS
    assert export(db, "analyses", "mares").columns == ANALYSES_COLUMNS
    assert synthesis_feed(db, "mares").columns == FEED_COLUMNS
    assert [len(c) for c in (STANDARD_COLUMNS, ANALYSES_COLUMNS, FEED_COLUMNS)] == [40, 38, 36]


def test_summary_exists_exactly_for_visits_with_observations(db):
    found = {r["id_base_visit"] for r in as_dicts(observations.visit_summary(db))}
    assert found == {row[2] for row in ROWS["observations"]}


@pytest.mark.parametrize("build", [EXPORTS["standard"], EXPORTS["analyses"], synthesis_feed])
def test_row_order_does_not_matter(spark, build):
    reversed_rows = {name: list(reversed(rows)) for name, rows in ROWS.items()}
    expected = sorted(map(repr, build(small_survey(spark), "mares").collect()))
    assert sorted(map(repr, build(small_survey(spark, **reversed_rows), "mares").collect())) == expected


@pytest.mark.parametrize("build", [EXPORTS["standard"], EXPORTS["analyses"], synthesis_feed])
def test_same_rows_without_broadcast_and_with_hot_keys(spark, build, request):
    expected = sorted(map(repr, build(small_survey(spark), "mares").collect()))
    request.getfixturevalue("tight")
    db = small_survey(spark)
    found = build(db, "mares")
    assert db.hot_keys("observations", "id_base_visit")
    assert sorted(map(repr, found.collect())) == expected


@pytest.mark.parametrize(
    "build", [observations.visit_summary, observations.known_observations, visits.visit_observers]
)
def test_module_cut_gives_the_same_rows_at_every_size(spark, build, request):
    everything = small_survey(spark)
    mine = {r["id_base_visit"] for r in module_filter(everything, "mares").collect()}
    assert mine < {r["id_base_visit"] for r in everything["visits"].collect()}
    expected = sorted(map(repr, build(small_survey(spark), "mares").collect()))
    assert {r["id_base_visit"] for r in build(small_survey(spark), "mares").collect()} <= mine
    request.getfixturevalue("tight")
    assert sorted(map(repr, build(small_survey(spark), "mares").collect())) == expected


def test_removing_records_removes_their_rows_only(spark):
    build = EXPORTS["standard"]
    rows = as_dicts(build(small_survey(spark), "mares"), "uuid_observation", "commune")
    fewer = [row for row in ROWS["taxref"] if row[0] != 1003]
    left = as_dicts(build(small_survey(spark, taxref=fewer), "mares"), "uuid_observation", "commune")
    assert left == [row for row in rows if row["cd_nom"] != 1003]


def test_altitude_cells_are_half_open(db):
    rows = {r["id_base_site"]: r["altitude_min"] for r in as_dicts(sites.site_altitude(db))}
    assert rows == {1: 190, 2: 190, 3: 900, 4: 190, 5: None}


def test_protected_text_is_null_without_parts(spark):
    frame = spark.createDataFrame(
        [(1, [("a", None)]), (2, [("b", "ZPS"), ("a", "SIC")]), (3, [])],
        "id int, protected array<struct<area_name: string, type_code: string>>",
    )
    rows = as_dicts(frame.select("id", sites.protected_text(F.col("protected")).alias("t")), "id")
    assert [r["t"] for r in rows] == [None, "a(SIC), b(ZPS)", None]


def test_visits_without_observer_are_absent_from_the_list(db):
    rows = as_dicts(visits.visit_observers(db), "id_base_visit")
    assert [r["id_base_visit"] for r in rows] == [1, 3]


def test_small_module_is_cut_out_while_reading(db, capsys):
    frame = synthesis_feed(db, "mares")
    capsys.readouterr()
    frame.explain()
    # Visit complements, the observer bridge, observations and their complements.
    assert capsys.readouterr().out.count("LeftSemi, BuildRight") >= 4
    assert {r["id_observation"] for r in as_dicts(synthesis_feed(db, "MARES"))} == {"h"}
