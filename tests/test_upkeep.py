"""Rollups kept up from batches of changes, and altitude cells of several levels."""

import glob
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from pondside.operators import rollups, sites
from pondside.plans import upkeep
from pondside.sources.star import GRID
from pondside.sources.tables import Survey
from small import ROWS, as_dicts, small_survey


@pytest.fixture
def kept(spark, tmp_path):
    spark.sql(f"CREATE DATABASE counts LOCATION '{tmp_path}'")
    yield "counts"
    spark.sql("DROP DATABASE counts CASCADE")


def survey_with(spark, visits=None, observations=None):
    return small_survey(spark, visits=visits or ROWS["visits"], observations=observations or ROWS["observations"])


def same(db, kept):
    for name, key in (("rollup_site", "id_base_site"), ("rollup_group", "id_sites_group"), ("rollup_visit", "id_base_visit")):
        assert as_dicts(getattr(upkeep, name)(db, kept), key) == as_dicts(getattr(rollups, name)(db), key)


def batch_of(before, now):
    return {state: upkeep.signed(*(upkeep.relation_rows(db, state) for db in (before, now))) for state in upkeep.STATES}


def files(tmp_path):
    found = glob.glob(f"{tmp_path}/*/**/*.parquet", recursive=True)
    return {name: os.stat(name).st_mtime_ns for name in found}


def states(spark):
    """Three later states: a later visit and observations, the latest one gone again, a moved visit and an emptied one."""
    visits, observations = ROWS["visits"], ROWS["observations"]
    later = [*visits, (9, "v9", 3, 1, 1, 9, date(2030, 1, 1), None), (10, "v10", None, 1, 1, 9, date(2030, 1, 1), None)]
    yield survey_with(spark, later, [*observations, ("y", "uy", 9, 1001, None), ("z", "uz", None, 1001, None)])
    yield survey_with(spark, [v for v in later if v[0] not in (9, 3)], observations)
    moved = [(*v[:2], 5, *v[3:]) if v[0] == 2 else v for v in visits]
    yield survey_with(spark, moved, [o for o in observations if o[2] != 1])


def test_state_after_each_batch_equals_the_full_rollups(spark, db, kept):
    upkeep.start(db, kept, parts=5)
    same(db, kept)
    before = db
    for batch, now in enumerate(states(spark), 1):
        upkeep.apply_batch(spark, kept, batch, batch_of(before, now))
        same(now, kept)
        before = now


def test_a_batch_applied_again_or_cut_off_counts_once(spark, db, kept, monkeypatch):
    upkeep.start(db, kept, parts=5)
    now = next(states(spark))
    changes = batch_of(db, now)
    # The first state is brought up to date, then the run ends.
    upkeep.apply_batch(spark, kept, 1, {"visits_of_site": changes["visits_of_site"]})
    written = upkeep.apply_batch(spark, kept, 1, changes)
    assert written == {"visits_of_site": 0, "observations_of_visit": 1}
    same(now, kept)
    # A partition that was written while another was not: the one is left, the other completed.
    later = survey_with(spark, ROWS["visits"] + [(n, f"w{n}", n % 5, 1, 1, 9, date(2031, 1, 1), None) for n in range(20, 40)])
    changes = batch_of(now, later)
    parts = 5
    place = F.pmod(F.xxhash64(F.col("id_base_site").cast("bigint")), F.lit(parts))
    some = changes["visits_of_site"].where(place < 2)
    first = upkeep.apply_batch(spark, kept, 2, {"visits_of_site": some})["visits_of_site"]
    rest = upkeep.apply_batch(spark, kept, 2, changes)["visits_of_site"]
    whole = {r[0] for r in changes["visits_of_site"].where("id_base_site IS NOT NULL").select(place).distinct().collect()}
    assert first + rest == len(whole)
    same(later, kept)


def test_only_touched_partitions_are_written(spark, db, kept, tmp_path):
    upkeep.start(db, kept, parts=5)
    before = files(tmp_path)
    nothing = batch_of(db, survey_with(spark))
    assert upkeep.apply_batch(spark, kept, 1, nothing) == {"visits_of_site": 0, "observations_of_visit": 0}
    assert files(tmp_path) == before
    one = spark.createDataFrame([(1, date(2022, 4, 18), -1)], "id_base_site bigint, visit_date_min date, sign int")
    assert upkeep.apply_batch(spark, kept, 1, {"visits_of_site": one}) == {"visits_of_site": 1}
    left = [name for name in before if files(tmp_path).get(name) == before[name]]
    gone = {name.split("part=")[1].split("/")[0] for name in before if name not in left}
    assert len(gone) == 1
    assert sorted(t.name for t in spark.catalog.listTables(kept)) == sorted(upkeep.STATES)


def test_a_batch_that_takes_too_much_leaves_the_state(spark, db, kept, tmp_path):
    upkeep.start(db, kept, parts=5)
    before = files(tmp_path)
    one = spark.createDataFrame([(404, -1)], "id_base_visit bigint, sign int")
    with pytest.raises(upkeep.Unmatched):
        upkeep.apply_batch(spark, kept, 1, {"observations_of_visit": one})
    assert files(tmp_path) == before
    with pytest.raises(ValueError, match="numbered from 1"):
        upkeep.apply_batch(spark, kept, 0, {"observations_of_visit": one})
    same(db, kept)


def test_an_empty_survey_starts_and_fills(spark, db, kept):
    none = small_survey(spark, visits=[], observations=[])
    upkeep.start(none, kept, parts=3)
    same(none, kept)
    upkeep.apply_batch(spark, kept, 1, batch_of(none, db))
    same(db, kept)


CELLS = [
    (100_000.0, 6_050_000.0, 210, 0),
    (100_000.0, 6_050_000.0, 500, 1),  # covers site 1 as well
    (127_500.0, 6_050_000.0, 9, 1),
    (155_000.0, 6_056_250.0, 900, 3),  # covers site 3
    (155_000.0, 6_050_000.0, 1, 3),  # ends below it
    (100_000.0, 6_050_000.0, 190, None),  # no level is level 0
]


def with_cells(spark, cells):
    load = small_survey(spark)._load
    frame = spark.createDataFrame(cells, "x0 double, y0 double, val int, level int")
    return Survey(lambda name: frame if name == "altitude_cells" else load(name), GRID)


@pytest.mark.parametrize("broadcasts", [True, False])
def test_altitude_over_cells_of_several_levels(spark, request, broadcasts):
    if not broadcasts:
        request.getfixturevalue("tight")
    found = as_dicts(sites.site_altitude(with_cells(spark, CELLS)), "id_base_site")
    assert [(r["id_base_site"], r["altitude_min"], r["altitude_max"]) for r in found] == [
        (1, 190, 500), (2, 190, 500), (3, 900, 900), (4, 190, 500), (5, None, None),
    ]


def test_no_cells_and_too_many_levels(spark):
    found = sites.site_altitude(with_cells(spark, [])).collect()
    assert len(found) == 5 and all(r["altitude_min"] is None for r in found)
    with pytest.raises(ValueError, match="levels"):
        sites.site_altitude(with_cells(spark, [(0.0, 0.0, 1, 16)]))
