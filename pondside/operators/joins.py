"""Joins to lookup tables that stay whole and balanced when one key holds much of the data."""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# A lookup is broadcast only when measured within both bounds.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024

# A key is hot from this share of the rows on, so at most 1 / HOT_SHARE keys are; below
# HOT_ROWS rows a task copes anyway. TRACKED bounds the sketch each task keeps; MERGERS tasks
# merge the sketches before one task sees them.
HOT_SHARE = 0.001
HOT_ROWS = 100_000
TRACKED = 10_000
MERGERS = 256

# A hot key is cut into as many pieces as there are shuffle partitions, up to this.
MOST_PIECES = 1000


@dataclass(frozen=True)
class Size:
    """Rows and bytes of a frame, and the bytes of its widest row."""

    rows: int
    total: int
    widest: int

    def fits(self, more: int = 0) -> bool:
        """Whether the frame, and so many bytes besides, can be broadcast."""
        return self.rows <= BROADCAST_ROWS and self.total + more <= BROADCAST_BYTES


def sizes(frames: Mapping[str, DataFrame]) -> dict[str, Size]:
    """One job that counts rows and bytes of each frame."""
    counted = [
        frame.agg(
            F.lit(name).alias("name"),
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(_row_bytes(frame)), F.lit(0)).alias("total"),
            F.coalesce(F.max(_row_bytes(frame)), F.lit(0)).alias("widest"),
        )
        for name, frame in frames.items()
    ]
    rows = reduce(DataFrame.unionAll, counted).collect()
    return {row["name"]: Size(row["rows"], row["total"], row["widest"]) for row in rows}


def measure(frames: Mapping[str, DataFrame]) -> dict[str, bool]:
    """Which frames fit a broadcast, found in one job."""
    return {name: size.fits() for name, size in sizes(frames).items()}


def _row_bytes(frame: DataFrame) -> Column:
    widths = [
        F.coalesce(F.octet_length(name), F.lit(0)) if kind in ("string", "binary") else F.lit(8)
        for name, kind in frame.dtypes
    ]
    return sum(widths[1:], widths[0]).cast("bigint")


def hot_keys(frame: DataFrame, key: str) -> list:
    """The few key values (NULL included) holding more than HOT_SHARE of the rows."""
    sketches = frame.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("merger")).agg(
        F.expr(f"approx_top_k_accumulate({key}, {TRACKED})").alias("sketch"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    top = F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch), {round(1 / HOT_SHARE)})")
    # Grouped, so that an empty table gives no group instead of a sketch of nothing.
    found = sketches.groupBy(F.lit("all")).agg(top.alias("top"), F.sum("n_rows").alias("total"))
    floor = F.greatest(F.col("total") * HOT_SHARE, F.lit(HOT_ROWS))
    rows = found.select(F.explode("top").alias("entry"), floor.alias("floor"))
    return [row["item"] for row in rows.where("entry.count > floor").select("entry.item").collect()]


def fact_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on a key that is unique on the right, both sides growing with the data.

    Spark may take a compressed file for small; the hint keeps it from broadcasting a fact.
    """
    return left.join(right.hint("merge"), key, how)


def spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    row_id: Sequence[str],
    hot: Sequence,
    how: str = "inner",
) -> DataFrame:
    """Join to a `right` that is unique by `key`, cutting the rows of the `hot` keys into pieces.

    The piece of a row is a hash of its `row_id`, so a task that is run again places it alike.
    Only rows of hot keys are repeated on the right, once per piece.
    """
    if not hot:
        return fact_join(left, right, key, how)
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = min(partitions, MOST_PIECES)
    known = [value for value in hot if value is not None]
    is_hot = F.col(key).isin(known) if known else F.lit(False)
    left_hot = is_hot | F.col(key).isNull() if None in hot else is_hot
    piece = F.pmod(F.xxhash64(*row_id), F.lit(pieces)).cast("int")
    every = F.sequence(F.lit(0), F.lit(pieces - 1))
    none = F.lit(0)
    cut = left.withColumn("_piece", F.when(left_hot, piece).otherwise(none))
    pieced = F.explode(F.when(is_hot, every).otherwise(F.array(none)))
    repeated = right.withColumn("_piece", pieced).hint("merge")
    return cut.join(repeated, [key, "_piece"], how).drop("_piece")


def join_dimension(
    left: DataFrame,
    right: DataFrame,
    key: str,
    row_id: Sequence[str],
    fits: bool,
    how: str = "inner",
    hot: Callable[[], Sequence] | None = None,
) -> DataFrame:
    """Broadcast `right` when it was measured to fit, otherwise shuffle with hot keys spread.

    `hot` finds the hot keys of `left`, by default by a look at `left` itself.
    """
    if fits:
        return left.join(F.broadcast(right), key, how)
    return spread_join(left, right, key, row_id, hot() if hot else hot_keys(left, key), how)
