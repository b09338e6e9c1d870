"""Data of the one-page group sheet."""

from pyspark.sql import DataFrame, functions as F

from pondside.functions.text import full_name, joined_distinct
from pondside.operators.joins import fact_join, join_dimension
from pondside.sources.tables import Survey


def group_sheet(db: Survey) -> DataFrame:
    """Name, principal observer and communes of each group."""
    db.measure("roles", "areas")
    people = db["roles"].select(
        F.col("id_role").alias("id_inventor"),
        full_name("nom_role", "prenom_role").alias("observateur_principal"),
    )
    areas = db["areas"].select("id_area", "area_name")
    named = join_dimension(
        db["group_communes"], areas, "id_area", ["id_sites_group", "id_area"], db.fits("areas")
    )
    communes = named.groupBy("id_sites_group").agg(
        joined_distinct("area_name", ", ").alias("communes")
    )
    groups = db["sites_groups"].select(
        "id_sites_group", "sites_group_name", F.col("id_inventor").cast("bigint")
    )
    headed = join_dimension(
        groups, people, "id_inventor", ["id_sites_group"], db.fits("roles"), how="left"
    )
    return fact_join(headed, communes, "id_sites_group", "left").select(
        "id_sites_group", "sites_group_name", "observateur_principal", "communes"
    )


def group_sheet_points(db: Survey) -> DataFrame:
    """The map layer: one row per site of a group, so a group of any size stays distributed."""
    members = db["site_complements"].select("id_base_site", "id_sites_group")
    sites = fact_join(db["sites"], members, "id_base_site")
    groups = db["sites_groups"].select("id_sites_group", "sites_group_name")
    placed = join_dimension(
        sites, groups, "id_sites_group", ["id_base_site"], db.fits("sites_groups")
    )
    return placed.select("id_sites_group", "sites_group_name", "base_site_name", "x", "y")
