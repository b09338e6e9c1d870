"""The feed of the central observation store."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pondside.operators.joins import fact_join
from pondside.operators.lookups import constant_struct, source_id
from pondside.operators.observations import with_visit
from pondside.operators.visits import (
    CORE_DIMENSIONS,
    visit_core,
    visit_observers,
    with_conditions,
)
from pondside.schemas import ADDITIONAL_KEYS, FEED_COLUMNS, FEED_CONSTANTS
from pondside.sources.tables import Survey


def _additional_data() -> Column:
    """JSON object of site and visit attributes; a missing one stays, as null."""
    values = {
        "num_passage": F.col("visite"),
        "accessibilite": F.parse_json("accessibility_json"),
    }
    fields = [values.get(key, F.col(key)).alias(key) for key in ADDITIONAL_KEYS]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def additional_data(db: Survey, module_code: str) -> DataFrame:
    """The JSON object of each kept visit."""
    visits = with_conditions(db, visit_core(db, module_code))
    return visits.select("id_base_visit", _additional_data().alias("additional_data"))


def synthesis_feed(
    db: Survey, module_code: str, given: DataFrame | None = None, more: Sequence[str] = ()
) -> DataFrame:
    """One row per kept observation, keyed by source and observation id.

    Observations `given` stand for those of the survey; `more` columns of theirs follow those of the feed.
    """
    db.measure(*CORE_DIMENSIONS, "roles", "taxref")
    people = visit_observers(db, module_code, joined=True).drop("organismes_rattaches")
    visits = fact_join(visit_core(db, module_code), people, "id_base_visit", "left")
    described = with_conditions(db, visits).withColumn("additional_data", _additional_data())
    needed = described.select(
        "id_base_visit",
        "uuid_base_visit",
        "id_base_site",
        "id_module",
        "id_dataset",
        "id_digitiser",
        "visit_date_min",
        "comments",
        *["lon", "lat", "x_lambert93", "y_lambert93", "altitude_min", "altitude_max"],
        *["ids_observers", "observers", "additional_data"],
    )
    rows = with_visit(db, needed, module_code, ["nom_complet"], given)
    constants = constant_struct(db)
    point = F.struct(F.col("lon").alias("x"), F.col("lat").alias("y"))
    derived = {
        "unique_id_sinp": F.col("uuid_observation"),
        "unique_id_sinp_grp": F.col("uuid_base_visit"),
        "id_source": source_id(db, module_code),
        "entity_source_pk_value": F.col("id_observation"),
        "id_nomenclature_life_stage": F.col("id_nomenclature_stade"),
        "id_nomenclature_type_count": F.col("id_nomenclature_typ_denbr"),
        "nom_cite": F.col("nom_complet"),
        "the_geom_4326": point,
        "the_geom_point": point,
        "the_geom_local": F.struct(F.col("x_lambert93").alias("x"), F.col("y_lambert93").alias("y")),
        "date_min": F.col("visit_date_min"),
        "date_max": F.col("visit_date_min"),
        "comment_context": F.col("comments"),
        "comment_description": F.col("commentaire_obs"),
        **{name: constants[name] for name in FEED_CONSTANTS},
    }
    return rows.select(*[derived.get(name, F.col(name)).alias(name) for name in FEED_COLUMNS], *more)
