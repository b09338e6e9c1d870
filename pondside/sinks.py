"""Where results go: CSV files, named views and tables, the stored feed, and relations kept as tables."""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from pondside.functions.payload import kept_payload
from pondside.plans import merge
from pondside.plans.exports import export
from pondside.plans.synthesis import synthesis_feed
from pondside.schemas import BUCKET_KEYS, KEPT_PAYLOADS, RELATIONS
from pondside.sources.tables import Survey


def write_csv(frame: DataFrame, path: str) -> None:
    """CSV part files with a header; quotes are doubled, and NULL differs from empty text."""
    frame.write.options(header=True, quote='"', escape='"', nullValue="", emptyValue='""').csv(path)


def export_csv(db: Survey, method: str, module_code: str, path: str) -> None:
    """Write one export as CSV."""
    write_csv(export(db, method, module_code), path)


def publish_export(db: Survey, method: str, module_code: str) -> str:
    """Make an export a view of the session, replacing one of that name; returns the name."""
    name = f"v_export_{module_code}_{method}"
    export(db, method, module_code).createOrReplaceTempView(name)
    return name


def publish_feed(db: Survey, module_code: str) -> str:
    """Make the feed a view of the session, replacing one of that name; returns the name."""
    name = f"v_synthese_{module_code}"
    synthesis_feed(db, module_code).createOrReplaceTempView(name)
    return name


def _save(frame: DataFrame, database: str, name: str) -> str:
    full = ".".join("`" + part.replace("`", "``") + "`" for part in (database, name))
    frame.write.mode("overwrite").format("parquet").saveAsTable(full)
    return f"{database}.{name}"


def save_export(db: Survey, method: str, module_code: str, database: str) -> str:
    """Keep an export as a table that outlives the session, replacing one of that name; returns the name."""
    return _save(export(db, method, module_code), database, f"v_export_{module_code}_{method}")


def save_feed(db: Survey, module_code: str, database: str) -> str:
    """Keep the feed as a table that outlives the session, replacing one of that name; returns the name."""
    return _save(synthesis_feed(db, module_code), database, f"v_synthese_{module_code}")


def write_feed(db: Survey, module_code: str, path: str, replace: bool = False) -> None:
    """Write the feed as Parquet by year, for a store that merges on source and observation.

    It is written beside and its keys are checked there; a key that is NULL or doubled is an error, and those files stay for
    inspection. Only then do they take their place, with `replace` that of an earlier feed, which stays whole until then.
    """
    feed = synthesis_feed(db, module_code).withColumn("year", F.year("date_min"))
    spark = feed.sparkSession
    fs, target = _file_system(spark, path)
    if fs.exists(target) and not replace:
        raise FileExistsError(path)
    staged, earlier = (f"{path.rstrip('/')}.{state}-{uuid.uuid4().hex}" for state in ("staged", "earlier"))
    feed.write.partitionBy("year").parquet(staged)
    merge.check_keys(spark.read.schema(feed.schema).parquet(staged), staged)
    if fs.exists(target):
        _move(fs, spark, path, earlier)
    _move(fs, spark, staged, path)
    fs.delete(_path(spark, earlier), True)


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _file_system(spark: SparkSession, name: str):
    path = _path(spark, name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _move(fs, spark: SparkSession, name: str, to: str) -> None:
    if not fs.rename(_path(spark, name), _path(spark, to)):
        raise OSError(f"{name} could not be moved to {to}")


def merge_feed(db: Survey, module_code: str, database: str, name: str = "synthese") -> dict[str, int]:
    """Bring the store's table up to date with the module's feed; the number of rows inserted, changed and deleted."""
    return merge.merge_feed(db, module_code, f"{database}.{name}")


def store_tables(db: Survey, database: str, buckets: int | None = None) -> None:
    """Keep the relations as Parquet tables, those of `BUCKET_KEYS` bucketed; documents are parsed here, once for all plans.

    The fields that the exports and the feed read are kept in typed columns beside the document, which the record rules read.

    There are as many buckets as shuffle partitions unless `buckets` says otherwise: for large relations give their size over
    what one task should write. Rows are moved to their bucket first, so a bucket is one file.
    """
    buckets = buckets or int(db["visits"].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for name in RELATIONS:
        key = BUCKET_KEYS.get(name)
        frame = db[name]
        if name in KEPT_PAYLOADS:
            frame = kept_payload(frame, KEPT_PAYLOADS[name])
        if key is None:
            writer = frame.write
        else:
            writer = frame.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        writer.format("parquet").saveAsTable(f"{database}.{name}")
