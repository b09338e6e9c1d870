"""Monitoring relations derived from a star schema of orders, for checks and benchmarks.

Nations become groups, customers sites, orders visits, lineitems observations, parts taxa and
vocabulary, suppliers observers, regions organisations and departments. Every row of the tables
is used. Records that point nowhere (a complement without its record, an unknown taxon, a site
without a group) are made on purpose by changing keys. `$name` stands for a table, so the same
text serves Spark and the SQL checks.
"""

from collections.abc import Mapping
from string import Template
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession

from pondside.sources.tables import Grid, Survey

GRID = Grid(width=55_000, height=50_000, x=100_000, y=6_050_000)

# The tables read, with their types, so that opening one runs no job.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_returnflag STRING, l_shipdate TIMESTAMP_NTZ",
}

_OBSERVATION_KEY = """concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING),
    CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING), CAST(CAST(l_shipdate AS DATE) AS STRING),
    CAST(CAST(l_quantity AS INT) AS STRING))"""

DERIVED = {
    # The two modules and their sources.
    "modules": """
        SELECT * FROM (VALUES (1, 'suivi_a'), (2, 'suivi_b')) t(id_module, module_code)""",
    "sources": """
        SELECT * FROM (VALUES (10, 'MONITORING_SUIVI_A'), (11, 'MONITORING_SUIVI_B'))
            t(id_source, name_source)""",
    "datasets": """
        SELECT r_regionkey + 1 AS id_dataset,
            concat('Jeu ', CAST(r_regionkey + 1 AS STRING)) AS dataset_name
        FROM $region""",
    # Each run of ids is one vocabulary type; ids 12, 25, 38, 51 and 64 sit in a run but are of
    # another type, which the membership rule must find.
    "nomenclature": """
        SELECT CAST(k AS INT) AS id_nomenclature,
            CASE WHEN k % 13 = 12 THEN 'AUTRE'
                WHEN k <= 12 THEN 'MILIEU_AQUATIQUE'
                WHEN k <= 16 THEN 'VARIATION_EAU'
                WHEN k <= 19 THEN 'COURANT_EAU'
                WHEN k <= 23 THEN 'PLUVIOSITE'
                WHEN k <= 27 THEN 'COUVERTURE_NUAGEUSE'
                WHEN k <= 30 THEN 'VENT'
                WHEN k <= 34 THEN 'TURBIDITE'
                WHEN k <= 38 THEN 'VEGETATION_AQUATIQUE'
                WHEN k <= 44 THEN 'METHODE_PROSPECTION'
                WHEN k <= 47 THEN 'RIVES'
                WHEN k <= 54 THEN 'HABITAT_TERRESTRE_MAJORITAIRE'
                WHEN k <= 63 THEN 'ACTIVITE_HUMAINE'
                WHEN k <= 68 THEN 'STADE_VIE'
                WHEN k <= 71 THEN 'SEXE'
                WHEN k <= 73 THEN 'TYP_DENBR'
                WHEN k = 74 THEN 'METH_OBS'
                WHEN k = 75 THEN 'OBJ_DENBR'
                WHEN k = 76 THEN 'STATUT_OBS'
                WHEN k = 78 THEN 'ETAT_BIO'
                WHEN k = 79 THEN 'STATUT_SOURCE'
                WHEN k = 80 THEN 'TYP_INF_GEO'
                WHEN k = 81 THEN 'METH_DETERMIN'
                WHEN k = 82 THEN 'TYPE_SITE'
                ELSE 'CATEGORIE_PAYSAGERE' END AS type_code,
            CASE WHEN k BETWEEN 65 AND 67 THEN CAST(k - 64 AS STRING)
                WHEN k BETWEEN 69 AND 71 THEN CAST(k - 68 AS STRING)
                WHEN k = 72 THEN 'Co'
                WHEN k = 73 THEN 'NSP'
                WHEN k = 74 THEN '20'
                WHEN k = 75 THEN 'IND'
                WHEN k = 76 THEN 'Pr'
                WHEN k = 78 OR k = 80 OR k = 81 THEN '1'
                WHEN k = 79 THEN 'Te'
                WHEN k = 82 THEN '7'
                ELSE CAST(k AS STRING) END AS cd_nomenclature,
            concat('label ', CAST(k AS STRING)) AS label_fr
        FROM (SELECT p_partkey % 100 AS k FROM $part GROUP BY p_partkey % 100) numbered""",
    "sites_groups": """
        SELECT n_nationkey AS id_sites_group, n_name AS sites_group_name,
            CASE WHEN n_nationkey = 24 THEN NULL ELSE n_nationkey % 9 END AS id_inventor,
            concat('{"categories_paysageres":', CAST(84 + n_nationkey % 16 AS STRING), '}') AS data
        FROM $nation""",
    "group_communes": """
        SELECT n_nationkey AS id_sites_group, 100 + n_nationkey AS id_area FROM $nation
        UNION ALL
        SELECT n_nationkey, 100 + (n_nationkey + 1) % 24 FROM $nation WHERE n_nationkey % 2 = 0""",
    "sites": """
        SELECT c_custkey AS id_base_site, c_name AS base_site_name,
            CAST(c_custkey % 14 - 5 AS DOUBLE) AS lon,
            CASE WHEN c_custkey % 89 = 0 THEN NULL ELSE CAST(41 + c_custkey % 10 AS DOUBLE) END AS lat,
            CAST(100000 + (c_custkey * 7919) % 1100000 AS DOUBLE) AS x,
            CAST(6050000 + (c_custkey * 104729) % 1000000 AS DOUBLE) AS y
        FROM $customer""",
    "site_complements": """
        SELECT c_custkey AS id_base_site,
            CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE c_nationkey END AS id_sites_group,
            concat(CASE WHEN c_custkey % 131 = 0 THEN '["' ELSE '' END,
                '{"milieu_aquatique":', CAST(c_custkey % 13 AS STRING),
                CASE WHEN c_custkey % 7 = 0 THEN ',"variation_eau":null'
                    ELSE concat(',"variation_eau":', CAST(13 + c_custkey % 4 AS STRING)) END,
                CASE WHEN c_custkey % 5 = 0 THEN ''
                    ELSE concat(',"courant":', CAST(17 + c_custkey % 3 AS STRING)) END,
                CASE WHEN c_custkey % 6 = 1 THEN ',"id_nomenclature_type_site":82'
                    WHEN c_custkey % 6 = 2 THEN ',"id_nomenclature_type_site":81' ELSE '' END,
                '}') AS data
        FROM $customer""",
    "visits": """
        SELECT o_orderkey AS id_base_visit,
            concat('V', CAST(o_orderkey AS STRING)) AS uuid_base_visit, o_custkey AS id_base_site,
            CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS id_module,
            CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(1 + o_orderkey % 6 AS INT) END
                AS id_dataset,
            CAST(o_custkey % 9 AS INT) AS id_digitiser,
            CAST(o_orderdate AS DATE) AS visit_date_min, o_orderpriority AS comments
        FROM $orders""",
    "visit_complements": """
        SELECT CASE WHEN o_orderkey % 97 = 0 THEN -1 - o_orderkey ELSE o_orderkey END
                AS id_base_visit,
            concat(CASE WHEN o_orderkey % 109 = 0 THEN '[{"vent":1},' ELSE '' END,
                '{"num_passage":"',
                CASE WHEN o_orderkey % 101 = 0 THEN '4eme' WHEN o_orderkey % 3 = 0 THEN '1er'
                    WHEN o_orderkey % 3 = 1 THEN '2eme' ELSE '3eme' END,
                ' passage","accessibility":"',
                CASE WHEN o_orderkey % 8 = 0 THEN 'Non' ELSE 'Oui' END, '","vent":',
                CASE WHEN o_orderkey % 8 = 0 AND o_orderkey % 16 <> 0 THEN 'null'
                    ELSE CAST(28 + o_orderkey % 3 AS STRING) END,
                CASE WHEN o_orderkey % 8 = 0 THEN ',"pluviosite":null'
                    ELSE concat(',"pluviosite":',
                        CASE WHEN o_orderkey % 103 = 0 THEN '"n/a"'
                            WHEN o_orderkey % 179 = 0 THEN '"21"'
                            WHEN o_orderkey % 181 = 0 THEN '21.5'
                            WHEN o_orderkey % 191 = 0 THEN '99999999999'
                            ELSE CAST(20 + o_orderkey % 4 AS STRING) END,
                        ',"couverture_nuageuse":', CAST(24 + o_orderkey % 4 AS STRING),
                        CASE WHEN o_orderkey % 13 = 0 THEN ''
                            ELSE concat(',"turbidite":', CAST(31 + o_orderkey % 4 AS STRING)) END,
                        ',"vegetation_aquatique_principale":', CAST(35 + o_orderkey % 4 AS STRING),
                        ',"rives":', CAST(45 + o_orderkey % 3 AS STRING),
                        ',"habitat_terrestre_environnant":', CAST(48 + o_orderkey % 7 AS STRING),
                        ',"activite_humaine":', CAST(55 + o_orderkey % 9 AS STRING),
                        ',"presence_amphibien":',
                        CASE WHEN o_orderkey % 17 = 0 THEN 'null'
                            WHEN o_orderkey % 6 = 0 THEN '"Non"' ELSE '"Oui"' END) END,
                CASE o_orderkey % 4 WHEN 0 THEN ''
                    WHEN 1 THEN ',"methode_de_prospection":[]'
                    WHEN 2 THEN concat(',"methode_de_prospection":[',
                        CAST(40 + o_orderkey % 5 AS STRING), ']')
                    ELSE concat(',"methode_de_prospection":[',
                        CAST(40 + o_orderkey % 5 AS STRING), ',',
                        CAST(40 + (o_orderkey + 2) % 5 AS STRING), ']') END,
                CASE WHEN o_orderkey % 113 <> 0 THEN '' WHEN o_orderkey % 8 = 0 THEN ',"accessibility":"Non"'
                    ELSE ',"accessibility":"Oui"' END,
                CASE WHEN o_orderkey % 107 = 0 THEN '' WHEN o_orderkey % 109 = 0 THEN '}]'
                    ELSE '}' END) AS data
        FROM $orders""",
    "observations": f"""
        SELECT {_OBSERVATION_KEY} AS id_observation,
            concat('O', {_OBSERVATION_KEY}) AS uuid_observation, l_orderkey AS id_base_visit,
            CASE WHEN l_partkey % 50 = 0 THEN NULL WHEN l_partkey % 33 = 0 THEN -1 - l_partkey
                ELSE l_partkey END AS cd_nom,
            l_returnflag AS comments
        FROM $lineitem""",
    "observation_complements": f"""
        SELECT concat(CASE WHEN l_quantity = 50 THEN 'x' ELSE '' END, {_OBSERVATION_KEY})
                AS id_observation,
            concat(CASE WHEN l_linenumber = 7 AND l_orderkey % 16 = 0 THEN 'illisible' ELSE '' END,
                '{{"count_min":',
                CASE WHEN l_linenumber = 5 THEN 'null'
                    ELSE CAST(CAST(l_quantity AS INT) AS STRING) END,
                CASE WHEN l_linenumber = 4 THEN ''
                    ELSE concat(',"count_max":',
                        CAST(CAST(l_quantity AS INT) + l_linenumber - 2 AS STRING)) END,
                ',"id_nomenclature_stade":', CAST(64 + l_linenumber % 5 AS STRING),
                ',"id_nomenclature_sex":', CAST(69 + l_linenumber % 3 AS STRING),
                ',"id_nomenclature_typ_denbr":',
                CASE WHEN l_linenumber = 6 THEN 'null'
                    ELSE CAST(72 + l_linenumber % 2 AS STRING) END, '}}') AS data
        FROM $lineitem""",
    # Variants of relations: visits and complements given twice, and an earlier state of the observations.
    "visits_twice": """
        SELECT id_base_visit, CASE WHEN id_base_visit % 211 = 0 THEN 'V1' ELSE uuid_base_visit END
                AS uuid_base_visit, id_base_site, id_module, id_dataset, id_digitiser, visit_date_min, comments
        FROM ($visits) given
        UNION ALL
        SELECT * FROM ($visits) again WHERE id_base_visit % 223 = 0""",
    "visit_complements_twice": """
        SELECT * FROM ($visit_complements) given
        UNION ALL
        SELECT * FROM ($visit_complements) again WHERE id_base_visit % 227 IN (0, 1)
        UNION ALL
        SELECT * FROM ($visit_complements) thrice WHERE id_base_visit % 227 = 0""",
    "observations_before": f"""
        SELECT {_OBSERVATION_KEY} AS id_observation,
            concat('O', {_OBSERVATION_KEY}) AS uuid_observation, l_orderkey AS id_base_visit,
            CASE WHEN l_partkey % 50 = 0 OR l_orderkey % 5 = 0 AND l_linenumber = 2 THEN NULL
                ELSE l_partkey END AS cd_nom,
            CASE WHEN l_orderkey % 7 = 0 THEN concat(l_returnflag, '?') ELSE l_returnflag END
                AS comments
        FROM $lineitem""",
    # An earlier state of the visits: some at another site or day, some not there yet, some gone since.
    "visits_before": """
        SELECT id_base_visit, uuid_base_visit,
            CASE WHEN id_base_visit % 13 = 0 THEN id_base_site + 1 ELSE id_base_site END AS id_base_site,
            id_module, id_dataset, id_digitiser,
            CASE WHEN id_base_visit % 19 = 0 THEN CAST('2049-05-01' AS DATE) ELSE visit_date_min END
                AS visit_date_min, comments
        FROM ($visits) given WHERE id_base_visit % 17 <> 0
        UNION ALL
        SELECT -id_base_visit, uuid_base_visit, id_base_site, id_module, id_dataset, id_digitiser,
            CAST('2050-01-01' AS DATE), comments
        FROM ($visits) again WHERE id_base_visit % 23 = 0""",
    # Tiles of three levels: some split in four, some of these with finer ones in one corner.
    "altitude_cells_mixed": """
        SELECT x0, y0, val, 0 AS level FROM ($altitude_cells) whole WHERE val % 3 <> 0
        UNION ALL
        SELECT x0, y0, val, 1 FROM ($altitude_cells) a WHERE val % 3 = 0
        UNION ALL
        SELECT x0, y0 + 25000, val - 20, 1 FROM ($altitude_cells) b WHERE val % 3 = 0
        UNION ALL
        SELECT x0 + 27500, y0, val + 10, 1 FROM ($altitude_cells) c WHERE val % 3 = 0
        UNION ALL
        SELECT x0 + 27500, y0 + 25000, val - 10, 1 FROM ($altitude_cells) d WHERE val % 6 = 0
        UNION ALL
        SELECT x0, y0 + 12500, val, 2 FROM ($altitude_cells) e WHERE val % 5 = 0
        UNION ALL
        SELECT x0 + 13750, y0 + 12500, val - 100, 2 FROM ($altitude_cells) f WHERE val % 5 = 0""",
    "taxref": """
        SELECT p_partkey AS cd_nom, p_partkey - p_partkey % 4 AS cd_ref, p_name AS lb_nom,
            CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_brand END AS nom_vern,
            concat(p_name, ' ', p_type) AS nom_complet
        FROM $part""",
    "visit_observers": """
        SELECT DISTINCT l_orderkey AS id_base_visit, l_suppkey AS id_role FROM $lineitem""",
    "roles": """
        SELECT s_suppkey AS id_role, s_name AS nom_role,
            CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE concat('P', CAST(s_suppkey AS STRING)) END
                AS prenom_role,
            CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE s_nationkey % 5 END AS id_organisme
        FROM $supplier""",
    "organisations": """
        SELECT r_regionkey AS id_organisme, r_name AS nom_organisme FROM $region""",
    # Five area types, one of them read by no export.
    "area_types": """
        SELECT r_regionkey + 1 AS id_type,
            CASE r_regionkey WHEN 0 THEN 'COM' WHEN 1 THEN 'DEP' WHEN 2 THEN 'ZNIEFF1'
                WHEN 3 THEN 'ZPS' ELSE 'M10' END AS type_code
        FROM $region""",
    "areas": """
        SELECT 100 + n_nationkey AS id_area, 1 AS id_type, concat('C_', n_name) AS area_name,
            concat('C', CAST(n_nationkey AS STRING)) AS area_code
        FROM $nation
        UNION ALL
        SELECT 200 + r_regionkey, 2, r_name, concat('D', CAST(r_regionkey AS STRING)) FROM $region
        UNION ALL
        SELECT 300 + n_nationkey, 3 + n_nationkey % 3, concat('P_', n_name),
            concat('P', CAST(n_nationkey AS STRING))
        FROM $nation""",
    "site_areas": """
        SELECT c_custkey AS id_base_site, 100 + c_nationkey AS id_area FROM $customer
        UNION ALL
        SELECT c_custkey, 100 + (c_nationkey + 1) % 25 FROM $customer WHERE c_custkey % 10 = 1
        UNION ALL
        SELECT c_custkey, 200 + n_regionkey
        FROM $customer JOIN $nation ON n_nationkey = c_nationkey
        UNION ALL
        SELECT c_custkey, 300 + c_nationkey FROM $customer WHERE c_custkey % 3 = 0
        UNION ALL
        SELECT c_custkey, 300 + (c_nationkey + 7) % 25 FROM $customer WHERE c_custkey % 6 = 0""",
    "altitude_cells": """
        SELECT CAST(100000 + 55000 * i AS DOUBLE) AS x0, CAST(6050000 + 50000 * j AS DOUBLE) AS y0,
            CAST((i * 37 + j * 53) % 3000 AS INT) AS val
        FROM (SELECT ((c_custkey * 7919) % 1100000 - (c_custkey * 7919) % 55000) / 55000 AS i,
                ((c_custkey * 104729) % 1000000 - (c_custkey * 104729) % 50000) / 50000 AS j
            FROM $customer) hit
        GROUP BY i, j""",
    "vocabulary_documents": """
        SELECT p_partkey AS id_document,
            concat('{"types":[{"mnemonique":"', p_type, '","label_default":"', p_type,
                '","definition_default":"', p_type, ' "}],"nomenclatures":[{"type":"', p_type,
                '","cd_nomenclature":"', p_type, '_', CAST(p_partkey AS STRING),
                '","mnemonique":"', p_name, '","label_default":"', p_name,
                '","definition_default":"', p_name, ' "},{"type":"', p_brand,
                '","cd_nomenclature":"', p_name, '_', CAST(p_size AS STRING),
                '","mnemonique":"', p_name, '","label_default":"', p_name, '"}]}') AS document
        FROM $part""",
}


# Relations read from a variant of theirs, for rules and merges that the plain ones have no case for.
DOUBLED = {"visits": "visits_twice", "visit_complements": "visit_complements_twice"}
BEFORE = {"observations": "observations_before"}
EARLIER = BEFORE | {"visits": "visits_before"}
MIXED = {"altitude_cells": "altitude_cells_mixed"}


def relation_sql(name: str, tables: dict[str, str]) -> str:
    """Query text of a derived relation over the given table expressions."""
    return Template(_whole(name)).substitute(tables)


def _whole(name: str) -> str:
    """The text of a relation, with that of others it names in place of their names."""
    text = DERIVED[name]
    used = [other for other in Template(text).get_identifiers() if other in DERIVED]
    return Template(text).safe_substitute({other: DERIVED[other] for other in used})


def _read_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {
        name: spark.read.schema(schema).parquet(f"{root}/{name}.parquet")
        for name, schema in TABLES.items()
    }


def _derive(spark: SparkSession, tables: dict[str, DataFrame], name: str) -> DataFrame:
    # Braces of the JSON texts are doubled: the session fills in `{table}` only.
    text = _whole(name).replace("{", "{{").replace("}", "}}")
    used = {table: frame for table, frame in tables.items() if f"${table}" in text}
    return spark.sql(Template(text).substitute({t: f"{{{t}}}" for t in used}), **used)


def derive_survey(spark: SparkSession, root: str, variants: Mapping[str, str] = MappingProxyType({})) -> Survey:
    """The relations over the tables below `root`, some from a variant; nothing is read until a plan asks for it."""
    tables = _read_tables(spark, root)
    return Survey(lambda name: _derive(spark, tables, variants.get(name, name)), GRID)


def derive_documents(spark: SparkSession, root: str) -> DataFrame:
    """One vocabulary document per part."""
    return _derive(spark, _read_tables(spark, root), "vocabulary_documents")
