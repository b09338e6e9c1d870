"""Column contracts: relations read, JSON payloads of the complements, and output columns."""

# Relation -> columns and types the plans rely on. A relation may hold more columns.
RELATIONS = {
    "modules": {"id_module": "int", "module_code": "string"},
    "sources": {"id_source": "int", "name_source": "string"},
    "datasets": {"id_dataset": "int", "dataset_name": "string"},
    "nomenclature": {
        "id_nomenclature": "int",
        "type_code": "string",
        "cd_nomenclature": "string",
        "label_fr": "string",
    },
    "sites_groups": {
        "id_sites_group": "int",
        "sites_group_name": "string",
        "id_inventor": "int",
        "data": "string",
    },
    "group_communes": {"id_sites_group": "int", "id_area": "int"},
    "sites": {
        "id_base_site": "bigint",
        "base_site_name": "string",
        "lon": "double",
        "lat": "double",
        "x": "double",
        "y": "double",
    },
    "site_complements": {"id_base_site": "bigint", "id_sites_group": "int", "data": "string"},
    "visits": {
        "id_base_visit": "bigint",
        "uuid_base_visit": "string",
        "id_base_site": "bigint",
        "id_module": "int",
        "id_dataset": "int",
        "id_digitiser": "int",
        "visit_date_min": "date",
        "comments": "string",
    },
    "visit_complements": {"id_base_visit": "bigint", "data": "string"},
    "observations": {
        "id_observation": "string",
        "uuid_observation": "string",
        "id_base_visit": "bigint",
        "cd_nom": "bigint",
        "comments": "string",
    },
    "observation_complements": {"id_observation": "string", "data": "string"},
    "taxref": {
        "cd_nom": "bigint",
        "cd_ref": "bigint",
        "lb_nom": "string",
        "nom_vern": "string",
        "nom_complet": "string",
    },
    "visit_observers": {"id_base_visit": "bigint", "id_role": "bigint"},
    "roles": {
        "id_role": "bigint",
        "nom_role": "string",
        "prenom_role": "string",
        "id_organisme": "int",
    },
    "organisations": {"id_organisme": "int", "nom_organisme": "string"},
    "area_types": {"id_type": "int", "type_code": "string"},
    "areas": {"id_area": "int", "id_type": "int", "area_name": "string", "area_code": "string"},
    "site_areas": {"id_base_site": "bigint", "id_area": "int"},
    "altitude_cells": {"x0": "double", "y0": "double", "val": "int"},
}

# Columns that a relation may have besides.
OPTIONAL = {"altitude_cells": {"level": "int"}}

# Relations that are joined on a key of their own rows. Bucketed by it they join without a shuffle,
# and as the key is unique no bucket is larger than the others.
BUCKET_KEYS = {
    "observations": "id_observation",
    "observation_complements": "id_observation",
    "visits": "id_base_visit",
    "visit_complements": "id_base_visit",
    "sites": "id_base_site",
    "site_complements": "id_base_site",
}

# JSON keys holding one vocabulary id, with the vocabulary type each belongs to.
GROUP_VOCABULARY = {"categories_paysageres": "CATEGORIE_PAYSAGERE"}
SITE_VOCABULARY = {
    "milieu_aquatique": "MILIEU_AQUATIQUE",
    "variation_eau": "VARIATION_EAU",
    "courant": "COURANT_EAU",
}
# Fixed value: the type of the site itself, a field that the form sets and no export shows.
SITE_TYPE = {"id_nomenclature_type_site": "TYPE_SITE"}
VISIT_VOCABULARY = {
    "pluviosite": "PLUVIOSITE",
    "couverture_nuageuse": "COUVERTURE_NUAGEUSE",
    "vent": "VENT",
    "turbidite": "TURBIDITE",
    "vegetation_aquatique_principale": "VEGETATION_AQUATIQUE",
    "rives": "RIVES",
    "habitat_terrestre_environnant": "HABITAT_TERRESTRE_MAJORITAIRE",
    "activite_humaine": "ACTIVITE_HUMAINE",
}
METHODS_FIELD = "methode_de_prospection"
METHODS_TYPE = "METHODE_PROSPECTION"
OBSERVATION_VOCABULARY = {
    "id_nomenclature_stade": "STADE_VIE",
    "id_nomenclature_sex": "SEXE",
    "id_nomenclature_typ_denbr": "TYP_DENBR",
}
COUNT_FIELDS = ("count_min", "count_max")

# Text fields of a visit payload.
VISIT_TEXT_FIELDS = ("num_passage", "accessibility", "presence_amphibien")


def ints(names) -> str:
    """DDL of integer JSON fields."""
    return ", ".join(f"{name} INT" for name in names)


def texts(names) -> str:
    """DDL of JSON fields read as text."""
    return ", ".join(f"{name} STRING" for name in names)


GROUP_PAYLOAD = ints(GROUP_VOCABULARY)
SITE_PAYLOAD = ints(SITE_VOCABULARY)
VISIT_IDS_PAYLOAD = f"{ints(VISIT_VOCABULARY)}, {METHODS_FIELD} ARRAY<INT>"
# VARIANT keeps the text as it stands in the document, so one parse serves both readings.
VISIT_PAYLOAD = f"{', '.join(f'{f} VARIANT' for f in VISIT_TEXT_FIELDS)}, {ints(VISIT_VOCABULARY)}"
METHODS_PAYLOAD = f"{METHODS_FIELD} ARRAY<INT>"
OBSERVATION_PAYLOAD = ints([*OBSERVATION_VOCABULARY, *COUNT_FIELDS])
# What stored complements keep of their document in typed columns: all fields that the exports and the feed read.
KEPT_PAYLOADS = {
    "site_complements": SITE_PAYLOAD,
    "visit_complements": f"{VISIT_PAYLOAD}, {METHODS_PAYLOAD}",
    "observation_complements": OBSERVATION_PAYLOAD,
}
PAYLOAD = "payload"
# The form rules ask whether a field is filled, whatever its type: they read text.
VISIT_FORM_PAYLOAD = texts([*VISIT_TEXT_FIELDS, *VISIT_VOCABULARY, METHODS_FIELD])
OBSERVATION_FORM_PAYLOAD = texts(OBSERVATION_VOCABULARY)
VOCABULARY_DOCUMENT = (
    "types ARRAY<STRUCT<mnemonique: STRING, label_default: STRING, definition_default: STRING>>, "
    "nomenclatures ARRAY<STRUCT<type: STRING, cd_nomenclature: STRING, mnemonique: STRING, "
    "label_default: STRING, definition_default: STRING>>"
)

# Type codes of areas.
COMMUNE = "COM"
DEPARTMENT = "DEP"
PROTECTED = ("ZNIEFF1", "ZNIEFF2", "ZPS", "ZCS", "SIC", "RNCFS", "RNR", "RNN", "ZC")

# Feed column -> (vocabulary type, code) written on every row of the feed.
FEED_CONSTANTS = {
    "id_nomenclature_obs_meth": ("METH_OBS", "20"),
    "id_nomenclature_obj_count": ("OBJ_DENBR", "IND"),
    "id_nomenclature_observation_status": ("STATUT_OBS", "Pr"),
    "id_nomenclature_bio_condition": ("ETAT_BIO", "1"),
    "id_nomenclature_source_status": ("STATUT_SOURCE", "Te"),
    "id_nomenclature_info_geo_type": ("TYP_INF_GEO", "1"),
    "id_nomenclature_determination_method": ("METH_DETERMIN", "1"),
}

# Output columns, in order.
SITE_COLUMNS = """aire_etude nom_site x_lambert93 y_lambert93 altitude_min altitude_max
    milieu_aquatique variation_eau courant departement code_dep commune site_protege""".split()

STANDARD_COLUMNS = [
    "uuid_observation",
    *SITE_COLUMNS,
    *"""id_dataset jeu_de_donnees uuid_visite date_visite visite observers organismes_rattaches
    methodes_prospection""".split(),
    *VISIT_VOCABULARY,
    *"""commentaire_visite cd_nom nom_latin nom_francais type_denombrement count_min count_max
    stade_vie sexe commentaire_obs""".split(),
]

ANALYSES_COLUMNS = [
    *SITE_COLUMNS,
    *"""uuid_visite date_visite id_dataset jeu_de_donnees annee visite observers
    organismes_rattaches accessibilite methodes_prospection""".split(),
    *VISIT_VOCABULARY,
    *"""presence_amphibien commentaire_visite diversite taxons_latin taxons_fr
    abondance_total_min abondance_total_max""".split(),
]

FEED_COLUMNS = """unique_id_sinp unique_id_sinp_grp id_source entity_source_pk_value id_dataset
    id_nomenclature_obs_meth id_nomenclature_life_stage id_nomenclature_sex
    id_nomenclature_obj_count id_nomenclature_type_count id_nomenclature_observation_status
    id_nomenclature_bio_condition id_nomenclature_source_status id_nomenclature_info_geo_type
    count_min count_max id_observation cd_nom nom_cite altitude_min altitude_max the_geom_4326
    the_geom_point the_geom_local date_min date_max observers id_digitiser
    id_nomenclature_determination_method id_module comment_context comment_description
    ids_observers id_base_site id_base_visit additional_data""".split()

ADDITIONAL_KEYS = [
    *"aire_etude nom_site milieu_aquatique variation_eau courant num_passage accessibilite".split(),
    *VISIT_VOCABULARY,
]
