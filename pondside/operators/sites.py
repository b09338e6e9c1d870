"""Sites: coordinates, altitude, areas, and the one-row-per-site frame the plans join."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from pondside.functions.payload import with_payload
from pondside.functions.text import joined
from pondside.operators.joins import fact_join, join_dimension
from pondside.operators.lookups import with_labels
from pondside.schemas import COMMUNE, DEPARTMENT, PROTECTED, SITE_PAYLOAD, SITE_VOCABULARY
from pondside.sources.tables import Grid, Survey

def site_coordinates(db: Survey) -> DataFrame:
    """Projected and centroid coordinates; the centroid of a point is the point."""
    return db["sites"].select(
        "id_base_site",
        F.col("x").alias("x_lambert93"),
        F.col("y").alias("y_lambert93"),
        F.col("lon").alias("centroid_x"),
        F.col("lat").alias("centroid_y"),
    )


def _with_cell(frame: DataFrame, grid: Grid, x: str, y: str, level: int = 0) -> DataFrame:
    """Add the key of the grid cell of a level a point lies in: column number above, row number below."""
    column = F.floor((F.col(x) - grid.x) / (grid.width / 2**level))
    row = F.floor((F.col(y) - grid.y) / (grid.height / 2**level))
    return frame.withColumn("_cell", F.shiftleft(column, 32) + row)


def _cells(db: Survey, level: int) -> DataFrame:
    """Lowest and highest altitude of each cell of a level."""
    tiles = db["altitude_cells"]
    if "level" in tiles.columns:
        tiles = tiles.where(F.coalesce("level", F.lit(0)) == level)
    return _with_cell(tiles, db.grid, "x0", "y0", level).groupBy("_cell").agg(
        F.min("val").alias("altitude_min"), F.max("val").alias("altitude_max")
    )


def _with_altitude(db: Survey, sites: DataFrame) -> DataFrame:
    """Add the lowest and highest altitude at (x, y) over the cells of all levels that cover it; NULL outside the cells."""
    fits = db.fits("altitude_cells")
    levels = db.altitude_levels()
    if levels == [0]:
        keyed = _with_cell(sites, db.grid, "x", "y")
        return join_dimension(keyed, _cells(db, 0), "_cell", ["id_base_site"], fits, how="left").drop("_cell")
    # The sites' keys alone go through the levels; a level's join is one on equal cells, as there is but one level.
    points = sites.select("id_base_site", "x", "y")
    found = [
        join_dimension(_with_cell(points, db.grid, "x", "y", level), _cells(db, level), "_cell", ["id_base_site"], fits)
        .select("id_base_site", "altitude_min", "altitude_max")
        for level in levels
    ]
    heights = reduce(DataFrame.unionAll, found).groupBy("id_base_site").agg(
        F.min("altitude_min").alias("altitude_min"), F.max("altitude_max").alias("altitude_max")
    )
    return fact_join(sites, heights, "id_base_site", "left")


def site_altitude(db: Survey) -> DataFrame:
    """Lowest and highest altitude at each site."""
    sites = _with_altitude(db, db["sites"].select("id_base_site", "x", "y"))
    return sites.select("id_base_site", "altitude_min", "altitude_max")


def _typed_areas(db: Survey) -> DataFrame:
    """Communes, departments and protected areas of each site, one pass over the bridge."""
    kinds = db["area_types"].where(F.col("type_code").isin(COMMUNE, DEPARTMENT, *PROTECTED))
    db.measure("areas", "area_types")
    areas = join_dimension(
        db["areas"], kinds, "id_type", ["id_area"], db.fits("area_types")
    ).drop("id_type")
    bridge = db["site_areas"]
    return join_dimension(
        bridge,
        areas,
        "id_area",
        ["id_base_site", "id_area"],
        db.fits("areas"),
        hot=lambda: db.hot_keys("site_areas", "id_area"),
    )


def site_areas(db: Survey) -> DataFrame:
    """Distinct communes, departments and protected areas of a site, as arrays."""
    kind = F.col("type_code")
    name = F.struct("area_name")
    department = F.struct("area_name", "area_code")
    protected = F.struct("area_name", "type_code")
    return _typed_areas(db).groupBy("id_base_site").agg(
        F.collect_set(F.when(kind == COMMUNE, name)).alias("communes"),
        F.collect_set(F.when(kind == DEPARTMENT, department)).alias("departments"),
        F.collect_set(F.when(kind.isin(*PROTECTED), protected)).alias("protected"),
    )


def site_commune(db: Survey) -> DataFrame:
    """One row per site and commune name."""
    communes = _typed_areas(db).where(F.col("type_code") == COMMUNE)
    return communes.select("id_base_site", F.col("area_name").alias("commune")).distinct()


def site_department(db: Survey) -> DataFrame:
    """One row per site and department."""
    departments = _typed_areas(db).where(F.col("type_code") == DEPARTMENT)
    return departments.select(
        "id_base_site", F.col("area_name").alias("departement"), F.col("area_code").alias("code_dep")
    ).distinct()


def _protected_label(area):
    """`name(type)`; NULL when a part is."""
    return F.concat(area["area_name"], F.lit("("), area["type_code"], F.lit(")"))


def protected_text(protected):
    """The distinct `name(type)` texts of an array of areas, ascending."""
    texts = F.array_compact(F.transform(protected, _protected_label))
    return joined(F.sort_array(F.array_distinct(texts)), ", ")


def site_protected_areas(db: Survey, by_name: bool = False) -> DataFrame:
    """Protected areas as text, per site or per site and area name."""
    areas = site_areas(db).where(F.size("protected") > 0)
    if not by_name:
        return areas.select("id_base_site", protected_text(F.col("protected")).alias("site_protege"))
    named = areas.select("id_base_site", protected_names(F.col("protected")).alias("protected_names"))
    return with_protected_by_name(named).select("id_base_site", "nom_protege", "site_protege")


def protected_names(protected):
    """Each distinct name in an array of areas, with the text of the areas of that name."""

    def named(name):
        of_name = F.filter(protected, lambda area: area["area_name"] == name)
        return F.struct(name.alias("nom_protege"), protected_text(of_name).alias("site_protege"))

    return F.transform(F.array_distinct(protected["area_name"]), named)


def with_protected_by_name(frame: DataFrame) -> DataFrame:
    """Repeat each row per element of `protected_names`; once, with NULLs, when there is none."""
    rows = frame.withColumn("_protected", F.explode_outer("protected_names"))
    return rows.select("*", "_protected.*").drop("protected_names", "_protected")


def areas_in_text(db: Survey, by_name: bool = False) -> DataFrame:
    """The `places` of each site and its protected areas as text, made once per site, not for each row of it."""
    protected = F.col("protected")
    text = protected_names(protected).alias("protected_names") if by_name else protected_text(protected).alias("site_protege")
    places = _places(F.col("communes"), F.col("departments")).alias("places")
    return site_areas(db).select("id_base_site", places, text)


def _places(communes, departments):
    """Each commune beside each department; where there is none of a kind, once with NULLs for it."""

    def one_at_least(areas, kind):
        return F.when(F.size(areas) > 0, areas).otherwise(F.array(F.lit(None).cast(kind)))

    def beside(commune):
        return F.transform(
            one_at_least(departments, "struct<area_name: string, area_code: string>"),
            lambda department: F.struct(
                commune["area_name"].alias("commune"),
                department["area_name"].alias("departement"),
                department["area_code"].alias("code_dep"),
            ),
        )

    return F.flatten(F.transform(one_at_least(communes, "struct<area_name: string>"), beside))


def with_places(frame: DataFrame) -> DataFrame:
    """Repeat each row per commune and department of its site, as the exports ask."""
    return frame.select("*", F.inline_outer("places")).drop("places")


def site_dim(db: Survey) -> DataFrame:
    """Sites that belong to a group: names, coordinates, altitude and labels, one row each."""
    db.measure("nomenclature", "altitude_cells", "sites_groups")
    complements = with_payload(db["site_complements"], SITE_PAYLOAD)
    sites = fact_join(db["sites"], complements, "id_base_site")
    groups = db["sites_groups"].select(
        "id_sites_group", F.col("sites_group_name").alias("aire_etude")
    )
    grouped = join_dimension(
        sites, groups, "id_sites_group", ["id_base_site"], db.fits("sites_groups")
    )
    labels = {field: field for field in SITE_VOCABULARY}
    placed = _with_altitude(db, grouped)
    labelled = with_labels(db, placed, labels, ["id_base_site"], ids=complements)
    return labelled.select(
        "id_base_site",
        "aire_etude",
        F.col("base_site_name").alias("nom_site"),
        "lon",
        "lat",
        F.col("x").alias("x_lambert93"),
        F.col("y").alias("y_lambert93"),
        "altitude_min",
        "altitude_max",
        *SITE_VOCABULARY,
    )
