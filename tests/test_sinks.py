"""Written results."""

import csv
import glob

import pytest
from pyspark.sql import functions as F

from pondside import sinks
from pondside.operators import quality
from pondside.plans import merge
from pondside.plans.synthesis import synthesis_feed
from pondside.schemas import RELATIONS, STANDARD_COLUMNS
from pondside.sources.star import GRID
from pondside.sources.tables import read_survey, read_tables
from small import small_survey


def test_csv_export_can_be_read_back(db, tmp_path):
    sinks.export_csv(db, "standard", "mares", str(tmp_path / "out"))
    rows = []
    for name in glob.glob(str(tmp_path / "out" / "part-*.csv")):
        with open(name, encoding="utf-8", newline="") as part:
            rows += csv.DictReader(part)
    assert list(rows[0]) == STANDARD_COLUMNS
    by_id = {row["uuid_observation"]: row for row in rows}
    assert by_id["ua"]["commentaire_obs"] == 'dit "là"'
    assert by_id["ua"]["visite"] == '"1er passage"'
    assert by_id["ub"]["commentaire_obs"] == ""


def test_views_carry_the_module_code(spark, db):
    assert sinks.publish_feed(db, "mares") == "v_synthese_mares"
    assert sinks.publish_export(db, "analyses", "mares") == "v_export_mares_analyses"
    assert spark.sql("SELECT count(*) AS n FROM v_synthese_mares").first()["n"] == 4
    assert spark.table("v_export_mares_analyses").count() == 7
    sinks.publish_feed(db, "autre")
    sinks.publish_feed(db, "mares")


def test_stored_feed_has_one_row_per_source_and_observation(spark, db, tmp_path):
    path = str(tmp_path / "feed")
    sinks.write_feed(db, "mares", path)
    feed = spark.read.parquet(path)
    assert {r["year"] for r in feed.select("year").distinct().collect()} == {2022, 2023}
    keys = feed.select("id_source", "entity_source_pk_value")
    assert keys.distinct().count() == keys.count() == 4
    sinks.write_feed(db, "mares", path, replace=True)
    assert spark.read.parquet(path).count() == 4
    with pytest.raises(FileExistsError):
        sinks.write_feed(db, "mares", path)


def test_feed_with_doubled_or_missing_keys_is_refused(spark, tmp_path):
    db = small_survey(spark)
    load = db._load
    twice = lambda name: load(name).unionAll(load(name)) if name == "observations" else load(name)
    db._load = twice
    path = str(tmp_path / "feed")
    with pytest.raises(ValueError, match="doubled"):
        sinks.write_feed(db, "mares", path)
    sinks.write_feed(small_survey(spark), "mares", path)
    with pytest.raises(ValueError, match="doubled"):
        sinks.write_feed(db, "mares", path, replace=True)
    assert spark.read.parquet(path).count() == 4
    kind = "id_source int, entity_source_pk_value string"
    feed = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (None, "c"), (2, "b")], kind)
    rows = {tuple(r) for r in merge.broken_keys(feed).collect()}
    assert rows == {(1, "b", 2), (None, "c", 1)}


def test_saved_results_are_tables(spark, db, tmp_path):
    spark.sql(f"CREATE DATABASE saved LOCATION '{tmp_path}'")
    try:
        for _ in range(2):
            assert sinks.save_feed(db, "mares", "saved") == "saved.v_synthese_mares"
            assert sinks.save_export(db, "analyses", "mares", "saved") == "saved.v_export_mares_analyses"
        assert spark.table("saved.v_synthese_mares").count() == 4
        assert spark.table("saved.v_export_mares_analyses").count() == 7
    finally:
        spark.sql("DROP DATABASE saved CASCADE")


def test_narrower_key_types_give_the_same_export(spark, db, tmp_path):
    ids = {letter: 100 + at for at, letter in enumerate("abcdefghijklmnopqrstuvwxyz")}
    number = F.create_map(*(F.lit(x) for pair in ids.items() for x in pair))
    for name in RELATIONS:
        frame = db[name]
        for column, kind in frame.dtypes:
            if column == "id_observation":
                frame = frame.withColumn(column, F.try_element_at(number, F.col(column)).cast("int"))
            elif kind == "bigint":
                frame = frame.withColumn(column, F.col(column).cast("int"))
        frame.write.parquet(str(tmp_path / f"{name}.parquet"))
    narrow = read_survey(spark, str(tmp_path), GRID)
    expected = sorted(map(repr, sinks.export(small_survey(spark), "standard", "mares").collect()))
    assert sorted(map(repr, sinks.export(narrow, "standard", "mares").collect())) == expected


def test_stored_relations_give_the_same_export(spark, db, tmp_path):
    for name in RELATIONS:
        db[name].write.parquet(str(tmp_path / f"{name}.parquet"))
    stored = read_survey(spark, str(tmp_path), GRID)
    expected = sorted(map(repr, sinks.export(small_survey(spark), "standard", "mares").collect()))
    assert sorted(map(repr, sinks.export(stored, "standard", "mares").collect())) == expected


def test_bucketed_tables_join_without_a_shuffle(spark, db, tmp_path, capsys):
    spark.sql(f"CREATE DATABASE kept LOCATION '{tmp_path}'")
    try:
        sinks.store_tables(db, "kept")
        feed = synthesis_feed(read_tables(spark, "kept", GRID), "mares")
        capsys.readouterr()
        feed.explain()
        text = capsys.readouterr().out
        rows = sorted(map(repr, feed.collect()))
    finally:
        spark.sql("DROP DATABASE kept CASCADE")
    assert rows == sorted(map(repr, synthesis_feed(small_survey(spark), "mares").collect()))
    assert "from_json" not in text
    assert "Exchange hashpartitioning(id_observation" not in text
    # Observations and observers move to the visits, which lie by their key already.
    assert text.count("Exchange hashpartitioning(id_base_visit") == 2


def test_exports_of_stored_tables_parse_no_document(spark, db, tmp_path, capsys):
    spark.sql(f"CREATE DATABASE typed LOCATION '{tmp_path}'")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        sinks.store_tables(db, "typed")
        kept = read_tables(spark, "typed", GRID)
        for method in ("standard", "analyses"):
            capsys.readouterr()
            frame = sinks.export(kept, method, "mares")
            frame.explain()
            text = capsys.readouterr().out
            assert "from_json" not in text and "data:string" not in text
            expected = sorted(map(repr, sinks.export(small_survey(spark), method, "mares").collect()))
            assert sorted(map(repr, frame.collect())) == expected
        # The rules look at the documents themselves.
        expected = sorted(map(repr, quality.dq_json_type(small_survey(spark)).collect()))
        assert sorted(map(repr, quality.dq_json_type(kept).collect())) == expected
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        spark.sql("DROP DATABASE typed CASCADE")
