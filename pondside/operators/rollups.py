"""Counts per level of the record tree. Every parent is kept, with 0 when it has no child."""

from pyspark.sql import DataFrame, functions as F

from pondside.operators.joins import fact_join
from pondside.sources.tables import Survey


def _zero(name: str):
    return F.coalesce(name, F.lit(0)).alias(name)


def rollup_site(db: Survey) -> DataFrame:
    """Visits and last visit of each site."""
    visits = db["visits"].groupBy("id_base_site").agg(
        F.count(F.lit(1)).alias("nb_visits"), F.max("visit_date_min").alias("last_visit")
    )
    return site_counts(db, visits)


def site_counts(db: Survey, visits: DataFrame) -> DataFrame:
    """All sites with their counted visits."""
    sites = db["sites"].select("id_base_site")
    return fact_join(sites, visits, "id_base_site", "left").select(
        "id_base_site", _zero("nb_visits"), "last_visit"
    )


def rollup_group(db: Survey) -> DataFrame:
    """Sites and visits of each group; visits are counted per site first."""
    return group_counts(db, db["visits"].groupBy("id_base_site").agg(F.count(F.lit(1)).alias("nb_visits")))


def group_counts(db: Survey, visits: DataFrame) -> DataFrame:
    """All groups with their counted sites and the counted visits of these."""
    sites = db["site_complements"].select("id_base_site", "id_sites_group")
    visits = visits.select("id_base_site", F.col("nb_visits").alias("visits"))
    counts = (
        fact_join(sites, visits, "id_base_site", "left")
        .groupBy("id_sites_group")
        .agg(F.count(F.lit(1)).alias("nb_sites"), F.sum("visits").alias("nb_visits"))
    )
    groups = db["sites_groups"].select("id_sites_group")
    return fact_join(groups, counts, "id_sites_group", "left").select(
        "id_sites_group", _zero("nb_sites"), _zero("nb_visits")
    )


def rollup_visit(db: Survey) -> DataFrame:
    """Observations of each visit."""
    return visit_counts(
        db, db["observations"].groupBy("id_base_visit").agg(F.count(F.lit(1)).alias("nb_observations"))
    )


def visit_counts(db: Survey, observations: DataFrame) -> DataFrame:
    """All visits with their counted observations."""
    visits = db["visits"].select("id_base_visit")
    return fact_join(visits, observations, "id_base_visit", "left").select(
        "id_base_visit", _zero("nb_observations")
    )
