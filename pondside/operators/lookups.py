"""Lookups by module, source and vocabulary."""

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from pondside.functions.payload import one_each
from pondside.operators.joins import fact_join, hot_keys, join_dimension, spread_join
from pondside.schemas import FEED_CONSTANTS
from pondside.sources.tables import Survey


def of_module(db: Survey, visits: DataFrame, module_code: str) -> DataFrame:
    """Visits of one module; the code is compared as it is, case included."""
    wanted = db["modules"].where(F.col("module_code") == module_code).select("id_module")
    return join_dimension(visits, wanted, "id_module", ["id_base_visit"], db.fits("modules"))


def module_filter(db: Survey, module_code: str) -> DataFrame:
    """Keys of the visits of one module."""
    return of_module(db, db["visits"], module_code).select("id_base_visit")


def few_visits(db: Survey, module_code: str) -> bool:
    """Whether the keys of a module's visits were measured to fit a broadcast."""
    return db.frame_fits(f"visits of {module_code}", lambda: module_filter(db, module_code))


def _visit_bits(db: Survey, module_code: str) -> DataFrame:
    """The keys of a module's visits as bitmaps, one of 4 KB for each 32,768 ids in a row that hold any."""
    visits = module_filter(db, module_code).where(F.col("id_base_visit").isNotNull())
    bucket = F.bitmap_bucket_number("id_base_visit").alias("_bucket")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("id_base_visit")).alias("_bits")
    return visits.groupBy(bucket).agg(bits)


def _in_bits(frame: DataFrame, bits: DataFrame) -> DataFrame:
    """The rows whose visit is in the bitmaps."""
    place = F.bitmap_bit_position("id_base_visit")
    byte = F.substring("_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    held = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int")) == 1
    same = F.bitmap_bucket_number("id_base_visit") == F.col("_bucket")
    return frame.join(F.broadcast(bits), same & held, "left_semi")


def for_module(
    db: Survey, frame: DataFrame, module_code: str | None, joined: bool = False
) -> DataFrame:
    """Rows by visit, cut down to a module, or all without one.

    A module whose keys fit a broadcast, as they are or as bitmaps, is cut out of a table while it is read;
    the visits of another are merged with it. The rows are the same either way. `joined` says that a join to
    the module's visits follows: it cuts the same rows, so those of the last kind are left to it.
    """
    if module_code is None:
        return frame
    if few_visits(db, module_code):
        return frame.join(F.broadcast(module_filter(db, module_code)), "id_base_visit", "left_semi")
    if db.frame_fits(f"visit bits of {module_code}", lambda: _visit_bits(db, module_code)):
        return _in_bits(frame, _visit_bits(db, module_code))
    return frame if joined else frame.join(module_filter(db, module_code).hint("merge"), "id_base_visit", "left_semi")


def source_id(db: Survey, module_code: str) -> Column:
    """Id of the module's source: NULL when unknown, an error when there are several."""
    name = F.concat(F.lit("MONITORING_"), F.upper(F.lit(module_code)))
    return db["sources"].where(F.col("name_source") == name).select("id_source").scalar()


def source_lookup(db: Survey, module_code: str) -> DataFrame:
    """The source id beside each visit of the module."""
    visits = module_filter(db, module_code)
    return visits.select("id_base_visit", source_id(db, module_code).alias("id_source"))


def constant_codes(
    db: Survey, codes: Mapping[str, tuple[str, str]] = FEED_CONSTANTS
) -> DataFrame:
    """One row with the id of each (type, code) pair; NULL for a pair that is not known."""
    vocabulary = db["nomenclature"]
    wanted = [
        F.max(
            F.when(
                (F.col("type_code") == kind) & (F.col("cd_nomenclature") == code),
                F.col("id_nomenclature"),
            )
        ).alias(name)
        for name, (kind, code) in codes.items()
    ]
    return vocabulary.agg(*wanted)


def constant_struct(
    db: Survey, codes: Mapping[str, tuple[str, str]] = FEED_CONSTANTS
) -> Column:
    """The row of `constant_codes` as a scalar subquery, one struct field per pair."""
    return constant_codes(db, codes).select(F.struct(*codes)).scalar()


def label_list(db: Survey) -> Column:
    """All labels of a vocabulary with few ids, each at the position of its id; a scalar subquery."""
    entries = db["nomenclature"].where(F.col("id_nomenclature").isNotNull())
    entries = entries.groupBy("id_nomenclature").agg(F.max("label_fr").alias("label"))
    known = F.map_from_entries(F.collect_list(F.struct("id_nomenclature", "label")))
    whole = entries.agg(known.alias("known"), F.max("id_nomenclature").alias("last"))
    every = F.transform(F.sequence(F.lit(0), F.col("last")), lambda i: F.try_element_at("known", i))
    return whole.select(every).scalar()


def _all_labels(db: Survey, fields: Mapping[str, str], row_id: str, ids: DataFrame) -> DataFrame:
    """The labels of all id columns, by row: ids one below the other, one join, and back beside each other."""
    held = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("id")) for f in fields])
    rows = one_each(ids, [row_id], held, "held").select(row_id, "held.field", F.col("held.id").alias("id"))
    rows = rows.where(F.col("id").isNotNull())
    labels = db["nomenclature"].select(F.col("id_nomenclature").alias("id"), "label_fr")
    found = spread_join(rows, labels, "id", [row_id, "field"], hot_keys(rows, "id"))
    own = [F.max(F.when(F.col("field") == f, F.col("label_fr"))).alias(label) for f, label in fields.items()]
    return found.groupBy(row_id).agg(*own)


def with_labels(
    db: Survey, frame: DataFrame, fields: Mapping[str, str], row_id: Sequence[str], ids: DataFrame
) -> DataFrame:
    """Replace id columns by labels: `fields` maps id column -> label column.

    An id that is NULL or unknown gives a NULL label. Labels of a vocabulary with few ids are looked up
    by position, those of one that fits a broadcast are joined. `ids` holds the same id columns and the
    row's id, is cheap to read, and is looked at only if the vocabulary is too large for that: then one join
    serves all columns.
    """
    kept = [name for name in frame.columns if name not in fields]
    if db.dense("nomenclature", "id_nomenclature"):
        labels = label_list(db)
        found = [F.get(labels, F.col(field)).alias(label) for field, label in fields.items()]
        return frame.select(*kept, *found)
    entries = db["nomenclature"]
    fits = db.fits("nomenclature")
    if not fits and len(fields) > 1:
        labels = _all_labels(db, fields, row_id[0], ids)
        return fact_join(frame.select(*kept), labels, row_id[0], "left")
    for field in fields:
        labels = entries.select(
            F.col("id_nomenclature").alias(field), F.col("label_fr").alias(f"_label_{field}")
        )
        frame = join_dimension(
            frame, labels, field, row_id, fits, how="left", hot=partial(hot_keys, ids, field)
        )
    return frame.select(
        *kept, *[F.col(f"_label_{field}").alias(label) for field, label in fields.items()]
    )
