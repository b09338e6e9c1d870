"""The record rules on the small survey."""

from pondside.operators import quality, rollups, sheet
from pondside.sources import vocabulary
from small import as_dicts, small_survey


def found(frame):
    return [(r["entity"], r["id"], r["field"]) for r in as_dicts(frame, "entity", "id", "field")]


def test_required(db):
    rows = found(quality.dq_required(db))
    assert [row for row in rows if row[0] == "sites_group"] == [
        ("sites_group", "11", "commune"),
        ("sites_group", "11", "id_inventor"),
    ]
    assert [row for row in rows if row[0] == "site"] == [("site", "4", "lat")]
    assert [row for row in rows if row[0] == "visit"] == [
        ("visit", "2", "accessibility"),
        ("visit", "2", "num_passage"),
        ("visit", "3", "num_passage"),
        ("visit", "6", "accessibility"),
        ("visit", "6", "num_passage"),
    ]
    # g has no complement at all.
    missing_sex = [row[1] for row in rows if row[2] == "id_nomenclature_sex"]
    assert missing_sex == ["b", "c", "d", "e", "f", "g", "h"]


def test_first_pass(db):
    assert found(quality.dq_required_first_pass(db)) == [
        ("visit", "1", field) for field in sorted(quality.FIRST_PASS_FIELDS)
    ]


def test_accessible_needs_methods_and_presence(db):
    assert found(quality.dq_required_accessible(db)) == [
        ("visit", id_, field)
        for id_ in ("4", "5", "7")
        for field in ("methode_de_prospection", "presence_amphibien")
    ]


def test_hidden(db):
    assert found(quality.dq_hidden(db)) == [
        ("visit", "3", "methode_de_prospection"),
        ("visit", "3", "vent"),
    ]


def test_enum_ignores_missing_answers(db):
    assert found(quality.dq_enum(db)) == [
        ("visit", "8", "accessibility"),
        ("visit", "8", "num_passage"),
    ]


def test_vocabulary_membership(db):
    # Group 10 and site 5 use an id of another type, site 3 an unknown id.
    assert found(quality.dq_vocabulary(db)) == [
        ("site", "3", "milieu_aquatique"),
        ("site", "5", "id_nomenclature_type_site"),
        ("sites_group", "10", "categories_paysageres"),
    ]


def test_allowed_codes(db):
    assert found(quality.dq_allowed_codes(db)) == [("observation", "b", "id_nomenclature_stade")]


def test_json_type(db):
    assert found(quality.dq_json_type(db)) == [
        ("observation", "f", "count_max"),
        ("observation", "f", "count_min"),
        ("site", "3", "courant"),
        ("visit", "2", "vent"),
        ("visit", "8", "methode_de_prospection"),
    ]


def test_unreadable_documents_are_reported(spark):
    documents = {
        1: '{"vent":2',
        2: "illisible",
        3: "[1]",
        4: '{"vent":2,"vent":2}',
        5: "{'vent':2}",
        6: "",
        7: None,
        8: ' {"vent":2.0,"rives":99999999999,"turbidite":"3","methode_de_prospection":[1,"x"]} ',
        9: '{"methode_de_prospection":[99999999999],"vent":null}',
        10: '{"methode_de_prospection":[null,3],"vent":-2147483648}',
    }
    db = small_survey(spark, visit_complements=list(documents.items()))
    visits = {(row[1], row[2]) for row in found(quality.dq_json_type(db)) if row[0] == "visit"}
    assert visits == {(str(id_), "data") for id_ in (1, 2, 3, 4, 5, 6)} | {
        *[("8", field) for field in ("vent", "rives", "turbidite", "methode_de_prospection")],
        ("9", "methode_de_prospection"),
    }


def test_documents_are_read_once_each_way_for_their_types(db, capsys):
    capsys.readouterr()
    quality.dq_json_type(db).explain()
    text = capsys.readouterr().out
    assert text.count("from_json(") == text.count("parseJson(") == 3


def test_keys(spark):
    from small import ROWS

    visits = [*ROWS["visits"], ROWS["visits"][0], (None, "v9", *ROWS["visits"][0][2:]), (11, "v2", *ROWS["visits"][0][2:])]
    complements = [*ROWS["visit_complements"], ROWS["visit_complements"][2], (40, "{}")]
    db = small_survey(spark, visits=visits, visit_complements=complements, visit_observers=[(1, 100), (50, 100), (50, 101), (None, 7)])
    rows = {(r["entity"], r["id"], r["field"], r["rows"]) for r in as_dicts(quality.dq_keys(db))}
    assert rows == {
        ("visit", "1", "visits: doubled", 2),
        ("visit", None, "visits: missing", 1),
        ("visit", "3", "visit_complements: doubled", 2),
        ("visit", "40", "visit_complements: orphan", 1),
        ("visit", "50", "visit_observers: orphan", 2),
        ("visit", "11", "uuid_base_visit: shared", 2),
    }


def test_the_key_audit_joins_nothing(db, capsys):
    capsys.readouterr()
    quality.dq_keys(db).explain()
    assert "Join" not in capsys.readouterr().out


def test_counts(db):
    # b: minimum missing, maximum given. c: maximum too small. d: maximum left out.
    # e: minimum 1 needs no maximum. f: unreadable counts are missing. h: minimum 0.
    assert found(quality.dq_counts(db)) == [
        ("observation", "c", "count_max"),
        ("observation", "d", "count_max"),
        ("observation", "f", "count_max"),
        ("observation", "h", "count_min"),
    ]


def test_defaults(db):
    seen = {r["id_observation"]: r for r in as_dicts(quality.apply_defaults_observations(db))}
    assert (seen["b"]["count_min"], seen["b"]["id_nomenclature_stade"]) == (1, 6)
    assert (seen["d"]["id_nomenclature_stade"], seen["d"]["id_nomenclature_sex"]) == (5, 7)
    visits = {r["id_base_visit"]: r for r in as_dicts(quality.apply_defaults_visits(db))}
    assert visits[2]["accessibility"] == "Oui" and visits[2]["methode_de_prospection"] == []
    # The default method names no entry.
    assert visits[4]["methode_de_prospection"] is None
    types = {r["id_base_site"]: r["id_nomenclature_type_site"] for r in as_dicts(quality.apply_defaults_sites(db))}
    assert types == {1: 10, 2: 10, 3: 10, 5: 1}


def test_rollups_keep_parents_without_children(db):
    groups = as_dicts(rollups.rollup_group(db), "id_sites_group")
    assert [(r["id_sites_group"], r["nb_sites"], r["nb_visits"]) for r in groups] == [
        (10, 3, 6),
        (11, 0, 0),
    ]
    by_site = {r["id_base_site"]: r for r in as_dicts(rollups.rollup_site(db))}
    assert by_site[1]["nb_visits"] == 4 and str(by_site[1]["last_visit"]) == "2022-05-01"
    visits = {r["id_base_visit"]: r["nb_observations"] for r in as_dicts(rollups.rollup_visit(db))}
    assert visits[1] == 5 and visits[2] == 0


def test_group_sheet(db):
    rows = as_dicts(sheet.group_sheet(db), "id_sites_group")
    assert rows[0]["observateur_principal"] == "Zoé Anne"
    assert rows[0]["communes"] == "Bourg, L'Isle"
    assert rows[1]["observateur_principal"] is None and rows[1]["communes"] is None
    points = as_dicts(sheet.group_sheet_points(db), "base_site_name")
    assert [(p["base_site_name"], p["x"]) for p in points] == [
        ("Hors raster", 10.0),
        ("Mare 1", 110_000.0),
        ("Mare 3", 155_000.0),
    ]


DOCUMENT = """
{ "types": [
    {"mnemonique": "EAU", "label_default": "Eau", "definition_default": "De l'eau "}
  ],
  "nomenclatures": [
    {"type": "EAU", "cd_nomenclature": "EAU_1", "mnemonique": "m", "label_default": "Mare",
     "definition_default": " Mare "},
    {"type": "EAU", "cd_nomenclature": "EAU_1", "mnemonique": "m", "label_default": "Mare"},
    {"type": "AIR", "cd_nomenclature": "EAU_2", "mnemonique": "a", "label_default": "Air"}
  ] }
"""


def test_vocabulary_document(spark, tmp_path):
    (tmp_path / "vocabulary.json").write_text(DOCUMENT, encoding="utf-8")
    documents = vocabulary.read_documents(spark, str(tmp_path / "vocabulary.json"))
    assert as_dicts(vocabulary.vocabulary_types(documents)) == [
        {"type": "EAU", "label": "Eau", "definition": "De l'eau"}
    ]
    entries = as_dicts(vocabulary.vocabulary_entries(documents), "code", "definition")
    assert [(e["type"], e["code"], e["definition"]) for e in entries] == [
        ("EAU", "EAU_1", "Mare"),
        ("EAU", "EAU_1", None),
        ("AIR", "EAU_2", None),
    ]
    broken = as_dicts(quality.dq_vocabulary_integrity(documents), "rule")
    assert [(b["rule"], b["type"], b["code"]) for b in broken] == [
        ("doubled_code", "EAU", "EAU_1"),
        ("foreign_code", "AIR", "EAU_2"),
        ("undeclared_type", "AIR", "EAU_2"),
    ]


def test_a_relation_of_other_types_is_refused(spark):
    import pytest

    db = small_survey(spark)
    db._load = lambda name: spark.createDataFrame([("x", "y")], "id_module string, module_code string")
    with pytest.raises(ValueError, match="modules.*id_module"):
        db["modules"]
