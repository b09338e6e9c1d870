"""Record rules as reports over whole tables.

Each report has one row per violation: rule, entity, id of the record, field. A record is its
core row with its complement, so a rule on a payload field also sees records without one.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from pondside.functions.payload import one_each, with_payload
from pondside.operators.joins import fact_join, join_dimension, measure
from pondside.operators.lookups import constant_struct
from pondside.schemas import (
    COUNT_FIELDS,
    GROUP_PAYLOAD,
    GROUP_VOCABULARY,
    METHODS_FIELD,
    METHODS_PAYLOAD,
    METHODS_TYPE,
    OBSERVATION_FORM_PAYLOAD,
    OBSERVATION_PAYLOAD,
    OBSERVATION_VOCABULARY,
    SITE_TYPE,
    SITE_VOCABULARY,
    VISIT_FORM_PAYLOAD,
    VISIT_IDS_PAYLOAD,
    VISIT_VOCABULARY,
    ints,
)
from pondside.sources.tables import Survey
from pondside.sources.vocabulary import vocabulary_entries, vocabulary_types

# Answers of the survey forms.
YES = "Oui"
NO = "Non"
FIRST_PASS = "1er passage"
PASSES = (FIRST_PASS, "2eme passage", "3eme passage")
FIRST_PASS_FIELDS = (
    "turbidite",
    "vegetation_aquatique_principale",
    "rives",
    "habitat_terrestre_environnant",
    "activite_humaine",
)
PRESENCE = "presence_amphibien"
# Codes an observation may use, per field.
ALLOWED_CODES = {
    "id_nomenclature_stade": ("1", "2", "3", "8", "9"),
    "id_nomenclature_sex": ("1", "2", "3"),
    "id_nomenclature_typ_denbr": ("Co", "Es"),
}
# Vocabulary defaults of the forms; the one of the methods names no entry.
DEFAULT_CODES = {
    METHODS_FIELD: (METHODS_TYPE, "1"),
    "id_nomenclature_stade": ("STADE_VIE", "1"),
    "id_nomenclature_sex": ("SEXE", "1"),
    "id_nomenclature_type_site": ("TYPE_SITE", "7"),
}


def _violations(
    frame: DataFrame, rule: str, entity: str, key: str, broken: Mapping[str, Column]
) -> DataFrame:
    """One row per record and field whose condition holds; one pass, no shuffle."""
    fields = [F.when(condition, F.lit(field)) for field, condition in broken.items()]
    kept = [
        F.lit(rule).alias("rule"),
        F.lit(entity).alias("entity"),
        F.col(key).cast("string").alias("id"),
    ]
    return one_each(frame, kept, F.array_compact(F.array(*fields)), "field")


def _only(condition: Column, broken: Mapping[str, Column]) -> dict[str, Column]:
    """The conditions, for records that meet another; not a filter, which would parse them anew."""
    return {field: condition & wrong for field, wrong in broken.items()}


def _missing(*fields: str) -> dict[str, Column]:
    return {field: F.col(field).isNull() for field in fields}


def _forms(db: Survey) -> DataFrame:
    return with_payload(db["visit_complements"], VISIT_FORM_PAYLOAD)


def _no_methods() -> Column:
    return F.coalesce(METHODS_FIELD, F.lit("[]")) == "[]"


def dq_required(db: Survey) -> DataFrame:
    """Fields every record must fill, point geometry included."""
    communes = db["group_communes"].select("id_sites_group").distinct()
    groups = fact_join(
        db["sites_groups"], communes.withColumn("commune", F.lit(True)), "id_sites_group", "left"
    )
    visits = fact_join(db["visits"], _forms(db), "id_base_visit", "left")
    complements = with_payload(db["observation_complements"], OBSERVATION_FORM_PAYLOAD)
    observations = fact_join(db["observations"], complements, "id_observation", "left")
    required = [
        (groups, "sites_group", "id_sites_group", ("id_inventor", "commune", "sites_group_name")),
        (db["sites"], "site", "id_base_site", ("base_site_name", "lon", "lat", "x", "y")),
        (
            visits,
            "visit",
            "id_base_visit",
            ("id_base_site", "num_passage", "visit_date_min", "accessibility"),
        ),
        (
            observations,
            "observation",
            "id_observation",
            ("id_nomenclature_stade", "id_nomenclature_sex"),
        ),
    ]
    reports = [
        _violations(frame, "required", entity, key, _missing(*fields))
        for frame, entity, key, fields in required
    ]
    return _union(reports)


def _union(reports: list[DataFrame]) -> DataFrame:
    whole = reports[0]
    for report in reports[1:]:
        whole = whole.unionAll(report)
    return whole


def dq_required_first_pass(db: Survey) -> DataFrame:
    """Conditions that an accessible first pass must describe."""
    first = (F.col("accessibility") == YES) & (F.col("num_passage") == FIRST_PASS)
    return _violations(
        _forms(db),
        "required_first_pass",
        "visit",
        "id_base_visit",
        _only(first, _missing(*FIRST_PASS_FIELDS)),
    )


def dq_required_accessible(db: Survey) -> DataFrame:
    """Methods and presence of an accessible visit; an empty list counts as missing."""
    missing = {METHODS_FIELD: _no_methods(), **_missing(PRESENCE)}
    return _violations(
        _forms(db),
        "required_accessible",
        "visit",
        "id_base_visit",
        _only(F.col("accessibility") == YES, missing),
    )


def dq_hidden(db: Survey) -> DataFrame:
    """Fields that hold a value although the site was not accessible."""
    filled = {field: F.col(field).isNotNull() for field in (*VISIT_VOCABULARY, PRESENCE)}
    return _violations(
        _forms(db),
        "hidden",
        "visit",
        "id_base_visit",
        _only(F.col("accessibility") == NO, {**filled, METHODS_FIELD: ~_no_methods()}),
    )


def dq_enum(db: Survey) -> DataFrame:
    """Answers outside their list."""
    return _violations(
        _forms(db),
        "enum",
        "visit",
        "id_base_visit",
        {
            "num_passage": ~F.col("num_passage").isin(*PASSES),
            "accessibility": ~F.col("accessibility").isin(YES, NO),
            PRESENCE: ~F.col(PRESENCE).isin(YES, NO),
        },
    )


def _held(field: str, kind: str, entry: Column) -> Column:
    """A vocabulary id found in a field, with the type it must have."""
    return F.struct(
        F.lit(field).alias("field"),
        F.lit(kind).alias("type_code"),
        entry.alias("id_nomenclature"),
    )


def _field_ids(frame: DataFrame, entity: str, key: str, types: Mapping[str, str]) -> DataFrame:
    """One row per id in the vocabulary fields, methods included: entity, id, field, type, entry."""
    held = F.array(*[_held(field, kind, F.col(field)) for field, kind in types.items()])
    if METHODS_FIELD in frame.columns:
        methods = F.coalesce(METHODS_FIELD, F.array().cast("array<int>"))
        held = F.concat(
            held, F.transform(methods, lambda entry: _held(METHODS_FIELD, METHODS_TYPE, entry))
        )
    kept = [F.lit(entity).alias("entity"), F.col(key).cast("string").alias("id")]
    rows = one_each(frame, kept, held, "held").select("entity", "id", "held.*")
    return rows.where(F.col("id_nomenclature").isNotNull())


def _vocabulary_ids(db: Survey) -> DataFrame:
    """All vocabulary ids the records hold."""
    site_types = SITE_VOCABULARY | SITE_TYPE
    parts = [
        ("sites_groups", GROUP_PAYLOAD, "sites_group", "id_sites_group", GROUP_VOCABULARY),
        ("site_complements", ints(site_types), "site", "id_base_site", site_types),
        ("visit_complements", VISIT_IDS_PAYLOAD, "visit", "id_base_visit", VISIT_VOCABULARY),
        (
            "observation_complements",
            OBSERVATION_PAYLOAD,
            "observation",
            "id_observation",
            OBSERVATION_VOCABULARY,
        ),
    ]
    return _union(
        [
            _field_ids(with_payload(db[name], payload), entity, key, types)
            for name, payload, entity, key, types in parts
        ]
    )


def dq_vocabulary(db: Survey) -> DataFrame:
    """Ids that are unknown or belong to another type than the field's."""
    types = db["nomenclature"].select("id_nomenclature", F.col("type_code").alias("found"))
    held = join_dimension(
        _vocabulary_ids(db),
        types,
        "id_nomenclature",
        ["entity", "id", "field"],
        db.fits("nomenclature"),
        how="left",
    )
    wrong = held.where(~F.col("found").eqNullSafe(F.col("type_code")))
    return wrong.select(F.lit("vocabulary").alias("rule"), "entity", "id", "field")


def dq_allowed_codes(db: Survey) -> DataFrame:
    """Observation fields whose entry has a code the form does not offer."""
    complements = with_payload(db["observation_complements"], OBSERVATION_PAYLOAD)
    held = _field_ids(complements, "observation", "id_observation", OBSERVATION_VOCABULARY)
    codes = db["nomenclature"].select("id_nomenclature", "cd_nomenclature")
    coded = join_dimension(
        held, codes, "id_nomenclature", ["id", "field"], db.fits("nomenclature")
    )
    offered = F.lit(False)
    for field, allowed in ALLOWED_CODES.items():
        offered = offered | (
            (F.col("field") == field) & F.col("cd_nomenclature").isin(*allowed)
        )
    return coded.where(~offered).select(
        F.lit("allowed_codes").alias("rule"), "entity", "id", "field"
    )


def _mistyped(frame: DataFrame, entity: str, key: str, fields: Mapping[str, str]) -> DataFrame:
    """Documents that cannot be read, as field `data`, and fields with a value that the typed reading does not accept.

    The document is read twice, as the exports do and as it is; what it holds in a field is looked up only where the
    typed reading has nothing. A key named twice makes it unreadable, and an unreadable one has no rows by field.
    """
    typed = F.from_json("data", ", ".join(f"{name} {kind}" for name, kind in fields.items()))
    parsed = frame.select(key, "data", typed.alias("typed"), F.try_parse_json("data").alias("document"))
    unreadable = F.col("data").isNotNull() & (
        F.col("document").isNull() | ~F.startswith(F.ltrim("data", F.lit(" \t\r\n")), F.lit("{"))
    )
    broken = {
        name: F.col(f"typed.{name}").isNull()
        & F.try_variant_get("document", f"$.{name}", "string").isNotNull()
        for name in fields
    }
    return _violations(parsed, "json_type", entity, key, {"data": unreadable, **broken})


def dq_json_type(db: Survey) -> DataFrame:
    """Documents that cannot be read and values of the wrong JSON type; the exports show them as NULL.

    A document that names a key twice is reported too; the exports show the key's last value.
    """
    visit_fields = {**dict.fromkeys(VISIT_VOCABULARY, "INT"), METHODS_FIELD: "ARRAY<INT>"}
    observation_fields = dict.fromkeys([*OBSERVATION_VOCABULARY, *COUNT_FIELDS], "INT")
    return _union(
        [
            _mistyped(
                db["site_complements"], "site", "id_base_site", dict.fromkeys(SITE_VOCABULARY, "INT")
            ),
            _mistyped(db["visit_complements"], "visit", "id_base_visit", visit_fields),
            _mistyped(
                db["observation_complements"], "observation", "id_observation", observation_fields
            ),
        ]
    )


def dq_counts(db: Survey) -> DataFrame:
    """Counts below their bound, and a maximum left out where the minimum is not 1."""
    low, high = F.col("count_min"), F.col("count_max")
    bounds = {
        "count_min": low < 1,
        "count_max": (high < low) | (high.isNull() & F.coalesce(low != 1, F.lit(True))),
    }
    complements = with_payload(db["observation_complements"], OBSERVATION_PAYLOAD)
    return _violations(complements, "counts", "observation", "id_observation", bounds)


# Entity -> key, relation of its core rows, of its complements, and others that refer to it.
KEYED = {
    "sites_group": ("id_sites_group", "sites_groups", None, ("site_complements", "group_communes")),
    "site": ("id_base_site", "sites", "site_complements", ("visits", "site_areas")),
    "visit": ("id_base_visit", "visits", "visit_complements", ("observations", "visit_observers")),
    "observation": ("id_observation", "observations", "observation_complements", ()),
}
# Entity -> a column of its core rows whose values no two keys share.
OWN = {"visit": "uuid_base_visit", "observation": "uuid_observation"}


def _shared(db: Survey, entity: str) -> DataFrame:
    """Values that several keys of an entity hold: one row each, with the smallest of the keys."""
    key, core, *_ = KEYED[entity]
    own = OWN[entity]
    held = db[core].where(F.col(own).isNotNull()).select(own, F.col(key).cast("string").alias("id"))
    counted = held.groupBy(own).agg(F.min("id").alias("id"), F.max("id").alias("last"), F.count(F.lit(1)).alias("rows"))
    named = counted.where("id != last").withColumns({"entity": F.lit(entity), "field": F.lit(f"{own}: shared")})
    return named.select(F.lit("keys").alias("rule"), "entity", "id", "field", "rows")


def _audit(db: Survey, entity: str) -> DataFrame:
    """Broken keys of an entity from one tagged union of the relations that hold it: rows are counted before the shuffle, and
    nothing is joined."""
    key, core, complement, others = KEYED[entity]
    held = [name for name in (core, complement, *others) if name]
    tagged = _union([db[name].select(F.col(key).alias("key"), F.lit(name).alias("relation")) for name in held])
    counts = [F.count_if(F.col("relation") == name).alias(name) for name in held]
    counted = tagged.groupBy("key").agg(*counts)
    known = F.col("key").isNotNull()
    broken = {(core, "missing"): ~known & (F.col(core) > 0)}
    broken |= {(name, "doubled"): known & (F.col(name) > 1) for name in (core, complement) if name}
    broken |= {(name, "orphan"): known & (F.col(core) == 0) & (F.col(name) > 0) for name in held[1:]}
    rows = [
        F.when(condition, F.struct(F.lit(f"{name}: {fault}").alias("field"), F.col(name).alias("rows")))
        for (name, fault), condition in broken.items()
    ]
    kept = [F.lit("keys").alias("rule"), F.lit(entity).alias("entity"), F.col("key").cast("string").alias("id")]
    found = one_each(counted, kept, F.array_compact(F.array(*rows)), "found")
    return found.select("rule", "entity", "id", "found.field", "found.rows")


def dq_keys(db: Survey) -> DataFrame:
    """Keys that the exports rely on: core rows and complements have one row per key, no record lacks its core row, and an identifier
    belongs to one record. `rows` is how many rows of the relation hold a broken key."""
    return _union([_audit(db, entity) for entity in KEYED] + [_shared(db, entity) for entity in OWN])


def dq_vocabulary_integrity(documents: DataFrame) -> DataFrame:
    """Entries with a doubled code, an undeclared type, or a code that does not start with it."""
    codes = vocabulary_entries(documents).groupBy("type", "code").agg(
        F.count(F.lit(1)).alias("entries")
    )
    types = vocabulary_types(documents).select("type", F.lit(True).alias("declared")).distinct()
    fits = measure({"types": types})["types"]
    checked = join_dimension(codes, types, "type", ["type", "code"], fits, how="left")
    broken = {
        "doubled_code": F.col("entries") > 1,
        "undeclared_type": F.col("declared").isNull(),
        "foreign_code": ~F.startswith("code", "type"),
    }
    rules = [F.when(condition, F.lit(rule)) for rule, condition in broken.items()]
    found = one_each(checked, ["type", "code"], F.array_compact(F.array(*rules)), "rule")
    return found.select("rule", "type", "code")


def apply_defaults_visits(db: Survey) -> DataFrame:
    """Visit complements with the form defaults; a default that names no entry stays NULL."""
    default = constant_struct(db, DEFAULT_CODES)[METHODS_FIELD]
    methods = F.coalesce(METHODS_FIELD, F.when(default.isNotNull(), F.array(default)))
    visits = with_payload(db["visit_complements"], f"accessibility STRING, {METHODS_PAYLOAD}")
    return visits.select(
        "id_base_visit",
        F.coalesce("accessibility", F.lit(YES)).alias("accessibility"),
        methods.alias(METHODS_FIELD),
    )


def apply_defaults_observations(db: Survey) -> DataFrame:
    """Observation complements with the form defaults."""
    codes = constant_struct(db, DEFAULT_CODES)
    complements = with_payload(db["observation_complements"], OBSERVATION_PAYLOAD)
    return complements.select(
        "id_observation",
        F.coalesce("count_min", F.lit(1)).alias("count_min"),
        "count_max",
        *[
            F.coalesce(field, codes[field]).alias(field)
            for field in ("id_nomenclature_stade", "id_nomenclature_sex")
        ],
        "id_nomenclature_typ_denbr",
    )


def apply_defaults_sites(db: Survey) -> DataFrame:
    """Site complements with the site type, which the form always sets."""
    stored = F.from_json("data", "id_nomenclature_type_site INT")["id_nomenclature_type_site"]
    default = constant_struct(db, DEFAULT_CODES)["id_nomenclature_type_site"]
    return db["site_complements"].select(
        "id_base_site", F.coalesce(stored, default).alias("id_nomenclature_type_site")
    )
