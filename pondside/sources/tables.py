"""The relations of one monitoring database as DataFrames."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from pondside.operators.joins import Size, hot_keys, sizes
from pondside.schemas import KEPT_PAYLOADS, OPTIONAL, PAYLOAD, RELATIONS


# Rows of a small relation are looked up by position if all ids are below this.
DENSE_IDS = 10_000

# Levels of altitude cells, each half as wide as the one before.
MOST_LEVELS = 16


@dataclass(frozen=True)
class Grid:
    """Raster of the altitude cells: a cell covers [x0, x0 + width) by [y0, y0 + height).

    Where cells have a `level`, one of level n is 2^n times as narrow and low; its corner lies on the raster of its level.
    """

    width: float = 25.0
    height: float = 25.0
    x: float = 0.0
    y: float = 0.0


class Survey:
    """Relations by name, loaded on first use, with the sizes and hot keys measured so far."""

    def __init__(self, load: Callable[[str], DataFrame], grid: Grid = Grid()):
        self._load = load
        self.grid = grid
        self._tables: dict[str, DataFrame] = {}
        self._sizes: dict[str, Size] = {}
        self._dense: dict[tuple[str, str], bool] = {}
        self._hot: dict[tuple[str, str], list] = {}
        self._levels: list[int] | None = None

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = checked(name, self._load(name))
        return self._tables[name]

    def frame_fits(self, name: str, build: Callable[[], DataFrame]) -> bool:
        """The same for a frame derived from the relations, sized once under the name given."""
        if name not in self._sizes:
            self._sizes.update(sizes({name: build()}))
        return self._sizes[name].fits()

    def measure(self, *names: str) -> None:
        """Size several relations in one job, ahead of the joins that ask for them."""
        todo = {name: self[name] for name in names if name not in self._sizes}
        if todo:
            self._sizes.update(sizes(todo))

    def fits(self, name: str, more: int = 0) -> bool:
        """Whether the relation, as measured, and so many bytes besides are small enough to broadcast."""
        self.measure(name)
        return self._sizes[name].fits(more)

    def widened(self, name: str, *others: str) -> int:
        """Bytes that rows of a relation gain at most when each takes a row of every other relation named."""
        self.measure(name, *others)
        return self._sizes[name].rows * sum(self._sizes[other].widest for other in others)

    def dense(self, name: str, key: str) -> bool:
        """Whether a small relation's ids are few enough from 0 on to look its rows up by position."""
        if (name, key) not in self._dense:
            ends = self[name].agg(F.min(key), F.max(key)).first()
            self._dense[name, key] = ends[0] is None or (ends[0] >= 0 and ends[1] < DENSE_IDS)
        return self.fits(name) and self._dense[name, key]

    def altitude_levels(self) -> list[int]:
        """The levels altitude cells have, at most MOST_LEVELS; 0 alone where they have no such column, or none there is."""
        if self._levels is None:
            cells = self["altitude_cells"]
            levels = [0]
            if "level" in cells.columns:
                found = cells.select(F.coalesce("level", F.lit(0)).alias("level")).distinct()
                levels = sorted(r["level"] for r in found.limit(MOST_LEVELS + 1).collect()) or [0]
            if levels[0] < 0 or levels[-1] >= MOST_LEVELS:
                raise ValueError(f"levels of altitude cells must be 0 to {MOST_LEVELS - 1}: {levels}")
            self._levels = levels
        return self._levels

    def hot_keys(self, name: str, key: str) -> list:
        """The few values of `key` that hold much of the relation."""
        if (name, key) not in self._hot:
            self._hot[name, key] = hot_keys(self[name], key)
        return self._hot[name, key]


def read_survey(spark: SparkSession, root: str, grid: Grid = Grid()) -> Survey:
    """Relations stored as `<root>/<relation>.parquet`."""
    return Survey(lambda name: spark.read.parquet(f"{root}/{name}.parquet"), grid)


def read_tables(spark: SparkSession, database: str, grid: Grid = Grid()) -> Survey:
    """Relations stored as tables of a database, as `sinks.store_tables` leaves them."""
    return Survey(lambda name: spark.table(f"{database}.{name}"), grid)


# Types that hold every value of another.
_WIDER = {
    "int": {"tinyint", "smallint"},
    "bigint": {"tinyint", "smallint", "int"},
    "double": {"float", "tinyint", "smallint", "int"},
}
_INTEGERS = {"tinyint", "smallint", "int", "bigint"}


def _holds(column: str, kind: str, found: str | None) -> bool:
    """Whether a column of type `found` can be read as `kind` without loss; observation ids may be integers or text."""
    if column == "id_observation" and found in _INTEGERS:
        return True
    return found == kind or found in _WIDER.get(kind, ())


def checked(name: str, frame: DataFrame) -> DataFrame:
    """The contract columns of a relation, narrower types widened, and the typed fields stored complements keep; an error
    names the columns that break it."""
    found = dict(frame.dtypes)
    wrong = {
        column: (kind, found.get(column))
        for column, kind in RELATIONS[name].items()
        if not _holds(column, kind, found.get(column))
    }
    if wrong:
        raise ValueError(f"relation {name}: expected and found types differ: {wrong}")
    kinds = RELATIONS[name].items()
    more = [F.col(c).cast(kind).alias(c) for c, kind in OPTIONAL.get(name, {}).items() if _holds(c, kind, found.get(c))]
    kept = [PAYLOAD] if name in KEPT_PAYLOADS and found.get(PAYLOAD, "").startswith("struct<") else []
    return frame.select(
        *(F.col(c) if found[c] == kind else F.col(c).cast(kind).alias(c) for c, kind in kinds), *more, *kept
    )
