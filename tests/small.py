"""A survey of a few rows with every awkward case the joins and lookups have to keep."""

from datetime import date

from pondside.schemas import RELATIONS
from pondside.sources.star import GRID
from pondside.sources.tables import Survey

ROWS = {
    "modules": [(1, "mares"), (2, "MARES"), (3, "autre")],
    "sources": [(7, "MONITORING_MARES")],
    "datasets": [(1, "Jeu 1")],
    "nomenclature": [
        (1, "MILIEU_AQUATIQUE", "M1", "Mare"),
        (2, "VENT", "V1", "Calme"),
        (3, "METHODE_PROSPECTION", "P1", "Vue"),
        (4, "METHODE_PROSPECTION", "P2", "Chant"),
        (5, "STADE_VIE", "1", "Adulte"),
        (6, "STADE_VIE", "4", "Larve"),
        (7, "SEXE", "1", "Inconnu"),
        (8, "TYP_DENBR", "Co", "Compté"),
        (9, "METH_OBS", "20", "Vu"),
        (10, "TYPE_SITE", "7", "Point"),
        (11, "METHODE_PROSPECTION", "P3", "Vue"),
    ],
    "sites_groups": [
        (10, "Aire A", 100, '{"categories_paysageres":1}'),
        (11, "Aire vide", None, None),
    ],
    "group_communes": [(10, 501), (10, 502)],
    "sites": [
        (1, "Mare 1", 5.0, 45.0, 110_000.0, 6_060_000.0),
        (2, "Sans aire", 5.1, 45.1, 120_000.0, 6_060_000.0),
        (3, "Mare 3", 5.2, 45.2, 155_000.0, 6_060_000.0),
        (4, "Sans complément", 5.3, None, 110_000.0, 6_060_000.0),
        (5, "Hors raster", 5.4, 45.4, 10.0, 10.0),
    ],
    "site_complements": [
        (1, 10, '{"milieu_aquatique": 1, "variation_eau": null}'),
        (2, None, "{}"),
        (3, 10, '{"milieu_aquatique": 99, "courant": "3"}'),
        (5, 10, '{"id_nomenclature_type_site": 1}'),
    ],
    "visits": [
        (1, "v1", 1, 1, 1, 9, date(2022, 4, 18), "beau"),
        (2, "v2", 1, 1, None, 9, date(2022, 5, 1), None),
        (3, "v3", 3, 1, 77, 9, date(2023, 1, 1), None),
        (4, "v4", 2, 1, 1, 9, date(2022, 4, 18), None),
        (5, "v5", 4, 1, 1, 9, date(2022, 4, 18), None),
        (6, "v6", 1, 1, 1, 9, date(2022, 4, 18), None),
        (7, "v7", 1, 2, 1, 9, date(2022, 4, 18), None),
        (8, "v8", 5, 1, 1, 9, date(2021, 12, 31), None),
    ],
    "visit_complements": [
        (
            1,
            '{"num_passage":"1er passage","accessibility":"Oui","vent":2,'
            '"methode_de_prospection":[3,4,11],"presence_amphibien":"Oui"}',
        ),
        (2, '{"accessibility":null,"vent":"n/a","methode_de_prospection":[]}'),
        (3, '{"num_passage":null,"accessibility":"Non","vent":2,"methode_de_prospection":[3]}'),
        (4, '{"num_passage":"2eme passage","accessibility":"Oui"}'),
        (5, '{"num_passage":"2eme passage","accessibility":"Oui"}'),
        (7, '{"num_passage":"2eme passage","accessibility":"Oui"}'),
        (8, '{"num_passage":"5eme","accessibility":"Peut-être","methode_de_prospection":5}'),
    ],
    "observations": [
        ("a", "ua", 1, 1001, "dit \"là\""),
        ("b", "ub", 1, 1002, None),
        ("c", "uc", 1, 1001, None),
        ("d", "ud", 1, None, None),
        ("e", "ue", 1, 4444, None),
        ("f", "uf", 3, 1003, None),
        ("g", "ug", 3, 1001, None),
        ("h", "uh", 7, 1001, None),
    ],
    "observation_complements": [
        ("a", '{"count_min":2,"count_max":5,"id_nomenclature_stade":5,"id_nomenclature_sex":7,'
              '"id_nomenclature_typ_denbr":8}'),
        ("b", '{"count_min":null,"count_max":1,"id_nomenclature_stade":6}'),
        ("c", '{"count_min":3,"count_max":2}'),
        ("d", '{"count_min":10}'),
        ("e", '{"count_min":1}'),
        ("f", '{"count_min":"4","count_max":2.5}'),
        ("h", '{"count_min":0,"count_max":1}'),
    ],
    "taxref": [
        (1001, 500, "Rana a", "Grenouille", "Rana a L."),
        (1002, 500, "Rana b", None, "Rana b L."),
        (1003, 600, "Bufo c", "Crapaud", "Bufo c L."),
    ],
    "visit_observers": [(1, 102), (1, 100), (1, 101), (3, 101), (2, 999)],
    "roles": [
        (100, "Zoé", "Anne", 1),
        (101, "Abel", None, None),
        (102, "Luc", "Bob", 1),
    ],
    "organisations": [(1, "Club")],
    "area_types": [(1, "COM"), (2, "DEP"), (3, "ZPS"), (4, "ZNIEFF1"), (5, "M10")],
    "areas": [
        (501, 1, "L'Isle", "38001"),
        (502, 1, "Bourg", "38002"),
        (503, 1, "Bourg", "99999"),
        (510, 2, "Isère", "38"),
        (520, 3, "Marais", "Z1"),
        (521, 4, "Marais", "Z2"),
        (522, 4, "Combe", "Z3"),
        (530, 5, "Maille", "M"),
    ],
    "site_areas": [
        *[(1, area) for area in (501, 510, 530)],
        *[(3, area) for area in (501, 502, 503, 510, 520, 521, 522)],
    ],
    "altitude_cells": [
        (100_000.0, 6_050_000.0, 210),
        (100_000.0, 6_050_000.0, 190),
        (155_000.0, 6_050_000.0, 900),
    ],
}

_FRAMES: dict = {}


def small_survey(spark, **changed) -> Survey:
    """The survey above; `changed` replaces the rows of relations."""
    rows = {**ROWS, **changed}

    def load(name):
        key = (spark.sparkContext.applicationId, name, repr(rows[name]))
        if key not in _FRAMES:
            schema = ", ".join(f"{column} {kind}" for column, kind in RELATIONS[name].items())
            _FRAMES[key] = spark.createDataFrame(rows[name], schema)
        return _FRAMES[key]

    return Survey(load, GRID)


def as_dicts(frame, *key) -> list[dict]:
    """Collected rows as dictionaries, in the order of `key`."""
    rows = [row.asDict(recursive=True) for row in frame.collect()]
    return sorted(rows, key=lambda row: [str(row[name]) for name in key])
