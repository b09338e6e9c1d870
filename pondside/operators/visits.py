"""Visits: dataset, observers, methods, conditions, and the kept visits of a module."""

from pyspark.sql import DataFrame, functions as F

from pondside.functions.payload import json_text, one_each, unquoted, with_payload
from pondside.functions.text import full_name, joined as joined_text, joined_distinct
from pondside.operators.joins import fact_join, join_dimension
from pondside.operators.lookups import for_module, label_list, of_module, with_labels
from pondside.operators.sites import site_dim
from pondside.schemas import (
    METHODS_FIELD,
    METHODS_PAYLOAD,
    SITE_VOCABULARY,
    VISIT_PAYLOAD,
    VISIT_VOCABULARY,
    ints,
)
from pondside.sources.tables import Survey

CORE_DIMENSIONS = (
    "modules",
    "datasets",
    "nomenclature",
    "sites_groups",
    "altitude_cells",
    "sites",
)


def visit_year(db: Survey) -> DataFrame:
    """Year of each visit."""
    return db["visits"].select("id_base_visit", F.year("visit_date_min").alias("annee"))


def _with_dataset(db: Survey, visits: DataFrame) -> DataFrame:
    names = db["datasets"].withColumnRenamed("dataset_name", "jeu_de_donnees")
    fits = db.fits("datasets")
    return join_dimension(visits, names, "id_dataset", ["id_base_visit"], fits, how="left")


def visit_dataset(db: Survey) -> DataFrame:
    """Dataset of each visit; the name is NULL when the id is NULL or unknown."""
    visits = _with_dataset(db, db["visits"])
    return visits.select("id_base_visit", "id_dataset", "jeu_de_donnees")


def visit_observers(
    db: Survey, module_code: str | None = None, joined: bool = False
) -> DataFrame:
    """Observers of each visit that has one, in the order of their ids, and their organisations.

    With a module, only those of its visits; others too where a join to these follows (`joined`).
    """
    db.measure("roles", "organisations")
    members = join_dimension(
        db["roles"],
        db["organisations"],
        "id_organisme",
        ["id_role"],
        db.fits("organisations"),
        how="left",
        hot=lambda: db.hot_keys("roles", "id_organisme"),
    )
    people = members.select(
        "id_role", full_name("nom_role", "prenom_role").alias("name"), "nom_organisme"
    )
    bridge = for_module(db, db["visit_observers"], module_code, joined)
    few_people = db.fits("roles", db.widened("roles", "organisations"))
    if few_people:
        # Two ids move; the names are looked up where the rows of a visit lie.
        bridge = bridge.repartition("id_base_visit")
    listed = join_dimension(
        bridge,
        people,
        "id_role",
        ["id_base_visit", "id_role"],
        few_people,
        hot=lambda: db.hot_keys("visit_observers", "id_role"),
    )
    grouped = listed.groupBy("id_base_visit").agg(
        F.sort_array(F.collect_list(F.struct("id_role", "name"))).alias("people"),
        joined_distinct("nom_organisme", ", ").alias("organismes_rattaches"),
    )
    return grouped.select(
        "id_base_visit",
        F.col("people.id_role").alias("ids_observers"),
        F.array_join("people.name", " ; ").alias("observers"),
        "organismes_rattaches",
    )


def _method_labels(db: Survey, module_code: str | None = None) -> DataFrame:
    """Labels of the methods of each visit that names one, for a vocabulary that has to be joined."""
    complements = for_module(db, db["visit_complements"], module_code, joined=True)
    documents = with_payload(complements, METHODS_PAYLOAD)
    methods = one_each(documents, ["id_base_visit"], F.col(METHODS_FIELD), "method")
    row_id = ["id_base_visit", "method"]
    labelled = with_labels(db, methods, {"method": "label"}, row_id, ids=methods)
    return labelled.groupBy("id_base_visit").agg(
        joined_distinct("label", " ; ").alias("methodes_prospection")
    )


def _with_method_text(db: Survey, visits: DataFrame) -> DataFrame:
    """Replace the ids of the methods by the text of their labels, looked up by position."""
    listed = visits.withColumn("_labels", label_list(db))
    labels = F.transform(METHODS_FIELD, lambda entry: F.get("_labels", entry))
    text = joined_text(F.sort_array(F.array_distinct(F.array_compact(labels))), " ; ")
    return listed.withColumn("methodes_prospection", text).drop("_labels", METHODS_FIELD)


def visit_methods(db: Survey) -> DataFrame:
    """Methods of each visit with a complement, as text; NULL when it names none."""
    if db.dense("nomenclature", "id_nomenclature"):
        return _with_method_text(db, with_payload(db["visit_complements"], METHODS_PAYLOAD))
    visits = db["visit_complements"].select("id_base_visit")
    return fact_join(visits, _method_labels(db), "id_base_visit", "left")


def _with_texts(complements: DataFrame) -> DataFrame:
    """The three text fields in the form the exports give them."""
    return complements.select(
        "*",
        json_text("num_passage").alias("visite"),
        json_text("accessibility").alias("accessibility_json"),
        unquoted(json_text("accessibility")).alias("accessibilite"),
        unquoted(json_text("presence_amphibien")).alias("presence"),
    ).drop("num_passage", "accessibility", "presence_amphibien")


def json_raw_text(db: Survey) -> DataFrame:
    """Pass number as JSON text, accessibility and presence without quotes."""
    parsed = _with_texts(with_payload(db["visit_complements"], VISIT_PAYLOAD))
    return parsed.select(
        "id_base_visit", "visite", "accessibilite", F.col("presence").alias("presence_amphibien")
    )


def visit_core(
    db: Survey, module_code: str, areas: DataFrame | None = None, with_methods: bool = False
) -> DataFrame:
    """Kept visits of a module with their site; condition columns still hold vocabulary ids.

    A visit is kept when it has a complement and its site has a complement and a group.
    The site comes first, while visit rows are narrow; everything after that is joined on
    `id_base_visit`, so the wide rows move once. There is one row per site, and its `areas`, if given, come
    from the bridge; rows of these tables times the widest rows they take bound what is broadcast.
    Methods, if asked for, are still ids.
    """
    db.measure(*CORE_DIMENSIONS)
    sites = site_dim(db)
    gained = db.widened("sites", "sites_groups", "altitude_cells", *["nomenclature"] * len(SITE_VOCABULARY))
    if areas is not None:
        sites = fact_join(sites, areas, "id_base_site", "left")
        gained += db.widened("site_areas", "areas", "area_types")
    few_sites = db.fits("sites", gained) and (areas is None or db.fits("site_areas"))
    visits = _with_dataset(db, of_module(db, db["visits"], module_code))
    placed = join_dimension(
        visits,
        sites,
        "id_base_site",
        ["id_base_visit"],
        few_sites,
        hot=lambda: db.hot_keys("visits", "id_base_site"),
    )
    documents = for_module(db, db["visit_complements"], module_code, joined=True)
    payload = f"{VISIT_PAYLOAD}, {METHODS_PAYLOAD}" if with_methods else VISIT_PAYLOAD
    return fact_join(placed, _with_texts(with_payload(documents, payload)), "id_base_visit")


def with_conditions(db: Survey, visits: DataFrame) -> DataFrame:
    """Replace the ids of the eight visit conditions by labels."""
    labels = {field: field for field in VISIT_VOCABULARY}
    ids = with_payload(db["visit_complements"], ints(VISIT_VOCABULARY))
    return with_labels(db, visits, labels, ["id_base_visit"], ids)


def with_people_and_methods(db: Survey, visits: DataFrame, module_code: str) -> DataFrame:
    """Add observers and organisations to the visits of a module, and the text of their methods."""
    people = visit_observers(db, module_code, joined=True)
    observed = fact_join(visits, people, "id_base_visit", "left")
    if db.dense("nomenclature", "id_nomenclature"):
        return _with_method_text(db, observed)
    methods = _method_labels(db, module_code)
    return fact_join(observed.drop(METHODS_FIELD), methods, "id_base_visit", "left")


def visit_flow(db: Survey, module_code: str) -> DataFrame:
    """Kept visits of a module with site, dataset and condition labels."""
    return with_conditions(db, visit_core(db, module_code))


def nomenclature_labels(db: Survey) -> DataFrame:
    """Labels of the eight conditions beside each visit complement."""
    parsed = with_payload(db["visit_complements"], VISIT_PAYLOAD)
    return with_conditions(db, parsed).select("id_base_visit", *VISIT_VOCABULARY)
