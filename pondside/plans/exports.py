"""The two tabular exports: one row per observation, or one per visit."""

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from pondside.functions.payload import with_payload
from pondside.operators.joins import fact_join
from pondside.operators.lookups import with_labels
from pondside.operators.observations import visit_summary, with_visit
from pondside.operators.sites import areas_in_text, with_places, with_protected_by_name
from pondside.operators.visits import (
    CORE_DIMENSIONS,
    visit_core,
    with_conditions,
    with_people_and_methods,
)
from pondside.schemas import ANALYSES_COLUMNS, STANDARD_COLUMNS, ints
from pondside.sources.tables import Survey

DIMENSIONS = (
    *CORE_DIMENSIONS,
    "area_types",
    "areas",
    "site_areas",
    "organisations",
    "roles",
    "taxref",
)


def _export_visits(db: Survey, module_code: str, by_name: bool = False) -> DataFrame:
    """Kept visits with all the exports show of them, places and areas by name still as arrays."""
    db.measure(*DIMENSIONS)
    areas = areas_in_text(db, by_name)
    visits = with_people_and_methods(
        db, visit_core(db, module_code, areas=areas, with_methods=True), module_code
    )
    return with_conditions(db, visits).select(
        "*",
        F.col("uuid_base_visit").alias("uuid_visite"),
        F.col("visit_date_min").alias("date_visite"),
        F.col("comments").alias("commentaire_visite"),
    )


def export_standard(db: Survey, module_code: str) -> DataFrame:
    """One row per kept observation, commune and department; no visit without observation."""
    rows = with_visit(db, _export_visits(db, module_code), module_code, ["lb_nom", "nom_vern"])
    labels = {
        "id_nomenclature_typ_denbr": "type_denombrement",
        "id_nomenclature_stade": "stade_vie",
        "id_nomenclature_sex": "sexe",
    }
    ids = with_payload(db["observation_complements"], ints(labels))
    labelled = with_labels(db, rows, labels, ["id_observation"], ids)
    shown = labelled.select(
        "*",
        F.col("lb_nom").alias("nom_latin"),
        F.col("nom_vern").alias("nom_francais"),
    )
    return with_places(shown).select(*STANDARD_COLUMNS)


def export_analyses(db: Survey, module_code: str) -> DataFrame:
    """One row per kept visit, commune, department and protected area, with or without observation."""
    summary = visit_summary(db, module_code, joined=True).withColumnsRenamed(
        {"count_min": "abondance_total_min", "count_max": "abondance_total_max"}
    )
    visits = _export_visits(db, module_code, by_name=True).select(
        "*",
        F.year("date_visite").alias("annee"),
        F.col("presence").alias("presence_amphibien"),
    )
    rows = fact_join(visits, summary, "id_base_visit", "left")
    return with_places(with_protected_by_name(rows)).select(*ANALYSES_COLUMNS)


EXPORTS: dict[str, Callable[[Survey, str], DataFrame]] = {
    "standard": export_standard,
    "analyses": export_analyses,
}


def export(db: Survey, method: str, module_code: str) -> DataFrame:
    """The export named by `method`, for any module."""
    return EXPORTS[method](db, module_code)
