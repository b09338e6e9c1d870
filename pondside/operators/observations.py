"""Observations: the per-visit summary and the kept observations."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from pondside.functions.payload import with_payload
from pondside.functions.text import joined_distinct
from pondside.operators.joins import fact_join, join_dimension, spread_join
from pondside.operators.lookups import few_visits, for_module
from pondside.operators.visits import visit_core
from pondside.schemas import COUNT_FIELDS, OBSERVATION_PAYLOAD, OBSERVATION_VOCABULARY, ints
from pondside.sources.tables import Survey

TAXON_NAMES = ("lb_nom", "nom_vern", "nom_complet")


def _records(
    db: Survey, module_code: str | None, joined: bool, given: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Observations of a module and, where they are few, their complements alone; the rest of these joins nothing.

    Observations `given` stand for those of the relation and are taken as they are."""
    complements = db["observation_complements"]
    if given is not None:
        return given, complements
    observations = for_module(db, db["observations"], module_code, joined)
    if module_code is None or not few_visits(db, module_code):
        return observations, complements
    ids = observations.select("id_observation")
    if db.frame_fits(f"observations of {module_code}", lambda: ids):
        complements = complements.join(F.broadcast(ids), "id_observation", "left_semi")
    return observations, complements


def visit_summary(
    db: Survey, module_code: str | None = None, joined: bool = False
) -> DataFrame:
    """Diversity, taxon names and summed counts of each visit with an observation.

    Observations without a complement or a known taxon still count. Rows are first reduced to
    one per visit and taxon, so a visit or taxon holding much of the data is summed before it
    is looked up and gathered. With a module, only its visits have a row; where a join to them
    follows (`joined`), others may have one too.
    """
    records, complements = _records(db, module_code, joined)
    observations = records.select("id_observation", "id_base_visit", "cd_nom")
    counts = with_payload(complements, ints(COUNT_FIELDS))
    per_taxon = (
        fact_join(observations, counts, "id_observation", "left")
        .groupBy("id_base_visit", "cd_nom")
        .agg(*[F.sum(field).alias(field) for field in COUNT_FIELDS])
    )
    taxa = db["taxref"].select("cd_nom", "cd_ref", "lb_nom", "nom_vern")
    if db.fits("taxref"):
        # Ids and sums move; the names are looked up where the taxa of a visit lie.
        per_taxon = per_taxon.repartition("id_base_visit")
    named = join_dimension(
        per_taxon,
        taxa,
        "cd_nom",
        ["id_base_visit", "cd_nom"],
        db.fits("taxref"),
        how="left",
        hot=lambda: db.hot_keys("observations", "cd_nom"),
    )
    return named.groupBy("id_base_visit").agg(
        F.size(F.collect_set("cd_ref")).alias("diversite"),
        joined_distinct("lb_nom", " ; ").alias("taxons_latin"),
        joined_distinct("nom_vern", " ; ").alias("taxons_fr"),
        *[F.sum(field).alias(field) for field in COUNT_FIELDS],
    )


def _described(records: DataFrame, complements: DataFrame) -> DataFrame:
    """Observations beside the fields of their complement."""
    observations = records.withColumnRenamed("comments", "commentaire_obs")
    return fact_join(observations, with_payload(complements, OBSERVATION_PAYLOAD), "id_observation")


def known_observations(
    db: Survey, module_code: str | None = None, joined: bool = False, given: DataFrame | None = None
) -> DataFrame:
    """Observations with a complement and a known taxon; vocabulary columns still hold ids.

    With a module, only those of its visits; others too where a join to these follows (`joined`).
    """
    records, complements = _records(db, module_code, joined, given)
    return join_dimension(
        _described(records, complements),
        db["taxref"].select("cd_nom", *TAXON_NAMES),
        "cd_nom",
        ["id_observation"],
        db.fits("taxref"),
        hot=lambda: db.hot_keys("observations", "cd_nom"),
    )


def _taxa_by_visit(db: Survey, records: DataFrame, names: Sequence[str]) -> DataFrame:
    """The visit and taxon of each observation of a known taxon, with the names of all rows that have its id."""
    listed = F.collect_list(F.struct(*names)).alias("_taxa")
    return spread_join(
        records.select("id_base_visit", "cd_nom"),
        db["taxref"].groupBy("cd_nom").agg(listed),
        "cd_nom",
        ["id_base_visit", "cd_nom"],
        db.hot_keys("observations", "cd_nom"),
    )


def with_visit(
    db: Survey,
    visits: DataFrame,
    module_code: str,
    names: Sequence[str] = TAXON_NAMES,
    given: DataFrame | None = None,
) -> DataFrame:
    """Known observations, or those `given`, joined to visits of a module, which carry all that is known of them.

    This comes last: the observation rows move while narrow, and the visits already lie by
    their key. Where the taxa have to be moved too, they come to the observations by visit: only two ids of each
    observation go to the taxa, and the `names` asked for come back to where its row moves anyway.
    """
    hot = db.hot_keys("observations", "id_base_visit")
    if hot or given is not None or db.fits("taxref"):
        known = known_observations(db, module_code, joined=True, given=given)
        return spread_join(known, visits, "id_base_visit", ["id_observation"], hot)
    records, complements = _records(db, module_code, joined=True)
    records = records.where(F.col("id_base_visit").isNotNull() & F.col("cd_nom").isNotNull())
    rows = _described(records, complements).unionByName(_taxa_by_visit(db, records, names), allowMissingColumns=True)
    taxa = F.first("_taxa", ignorenulls=True).over(Window.partitionBy("id_base_visit", "cd_nom"))
    named = rows.repartition("id_base_visit").withColumn("_taxa", taxa)
    known = named.where(F.col("id_observation").isNotNull() & F.col("_taxa").isNotNull())
    placed = fact_join(known, visits, "id_base_visit")
    return placed.select("*", F.inline("_taxa")).drop("_taxa")


def observation_flow(db: Survey, module_code: str) -> DataFrame:
    """Kept observations of a module with their taxon and counts."""
    kept = visit_core(db, module_code).select("id_base_visit")
    return with_visit(db, kept, module_code).select(
        "id_observation",
        "id_base_visit",
        "cd_nom",
        "lb_nom",
        "nom_vern",
        "nom_complet",
        *OBSERVATION_VOCABULARY,
        *COUNT_FIELDS,
    )
