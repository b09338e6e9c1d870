"""What the operators share: the shared folder, stored intermediate tables, words and folds."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A word is a run of characters other than these six blanks.
WORD = r"[^\x20\x09-\x0D]+"
# Spark's bound of what it sends to a Python worker at once, 64 MB if unset, and the bound for texts.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "2m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; where that is unset, a temporary one, on a single machine only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="checkpoint-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def small_batches(spark: SparkSession) -> None:
    """Texts go to the Python workers in small batches, of which an executor holds several copies outside its heap.
    The bound holds for the session, as it is read when a query runs; one that is set already stays."""
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, BATCH_BYTES)


def stored(frame: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows of `frame`, written as a table in the shared folder and read from there, so that
    they are computed once and outlive any executor. `options` are those of the Parquet writer."""
    path = f"{shared_folder(frame.sparkSession)}/{name}-{uuid.uuid4().hex}"
    frame.write.options(**options).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def removed(frame: DataFrame) -> None:
    """Removes the files of a `stored` table that nothing reads any more."""
    spark = frame.sparkSession
    folders = {name.rpartition("/")[0] for name in frame.inputFiles()}
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_of(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds
