"""Bucketed tables and training tables found by their manifest."""

from __future__ import annotations

import shutil
from pathlib import Path

import pytest

from foldwise.plans.reuse import reusable_training
from foldwise.plans.training import join_labels
from foldwise.sources import bucketed as B
from foldwise.spec import FeatureSpec

SPEC = FeatureSpec("id", ("c",), ("x",), "label")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def inputs(spark, tmp_path):
    def write(n, k):
        spark.createDataFrame([(i, "ab"[i % 2], float(i)) for i in range(n)], "id long, c string, x double").write.mode(
            "overwrite").parquet(f"{tmp_path}/f")
        spark.createDataFrame([(i, float(k * i)) for i in range(n)], "id long, label double").write.mode(
            "overwrite").parquet(f"{tmp_path}/l")
        return spark.read.parquet(f"{tmp_path}/f"), spark.read.parquet(f"{tmp_path}/l")
    return write


def test_a_second_program_finds_the_table(spark, inputs, tmp_path):
    root = f"{tmp_path}/root"
    f, lab = inputs(50, 2)
    one, two = (reusable_training(f, lab, SPEC, root, "t") for _ in range(2))
    assert not one.hit and two.hit and one.manifest == two.manifest
    assert sorted(map(str, one.table.df.collect())) == sorted(map(str, two.table.df.collect()))
    plan = _plan(two.table.df)
    assert "Join" not in plan and "Exchange" not in plan
    assert two.table.n_rows == 50 and two.table.encoder.levels == {"c": ["a", "b"]}
    # another name, spec or option is another table
    assert not reusable_training(f, lab, SPEC, root, "u").hit
    assert not reusable_training(f, lab, SPEC, root, "t", n_folds=5).hit
    # a changed input misses
    f, lab = inputs(60, 2)
    three = reusable_training(f, lab, SPEC, root, "t")
    assert not three.hit and three.table.df.count() == 60
    with pytest.raises(ValueError):
        reusable_training(spark.range(3).selectExpr("id", "'a' as c", "1.0 as x"), lab, SPEC, root, "t")


def test_an_interrupted_write_is_never_read(spark, inputs, tmp_path):
    root = f"{tmp_path}/root"
    f, lab = inputs(30, 1)
    one = reusable_training(f, lab, SPEC, root, "t")
    home = Path(one.manifest["rows"]).parent
    # rows are there, the manifest is not committed
    (home / "manifest" / "_SUCCESS").unlink()
    part = next(p for p in Path(one.manifest["rows"]).iterdir() if p.suffix == ".parquet")
    part.write_bytes(b"half a file")
    shutil.rmtree(home / "manifest")
    two = reusable_training(f, lab, SPEC, root, "t")
    assert not two.hit and two.manifest["rows"] != one.manifest["rows"] and two.table.df.count() == 30


def test_bucketed_join_has_no_exchange(spark, tmp_path):
    f = spark.createDataFrame([(i % 90, "a", float(i)) for i in range(300)], "id long, c string, x double")
    lab = spark.createDataFrame([(i, float(i)) for i in [*range(80), 3, 3]], "id long, label double")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bf, bl = B.write_bucketed(f, "id", 4, path=f"{tmp_path}/bf"), B.write_bucketed(lab, "id", 4, path=f"{tmp_path}/bl")
        joined = B.join_bucketed(bf, bl, "id", "label", support=.5)
        assert "SortMergeJoin" in _plan(joined) and "Exchange" not in _plan(joined)
        want = sorted(map(str, join_labels(f, lab, SPEC).collect()))
        assert sorted(map(str, joined.select("id", "c", "x", "label").collect())) == want
        # the tables in another session's catalogue
        again = B.join_bucketed(B.open_bucketed(spark, f"{tmp_path}/bf", "id", 4),
                                B.open_bucketed(spark, f"{tmp_path}/bl", "id", 4), "id", "label", support=.5)
        assert "Exchange" not in _plan(again) and sorted(map(str, again.select("id", "c", "x", "label").collect())) == want
        # hot ids are taken out and salted; the others still move no row
        hot = B.join_bucketed(bf, bl, "id", "label", support=.01)
        assert sorted(map(str, hot.select("id", "c", "x", "label").collect())) == want
        with pytest.raises(Exception, match="holds a null"):
            B.write_bucketed(spark.createDataFrame([(None, 1.0)], "id long, label double"), "id", 2).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_hot_id_in_a_bucketed_table(spark, tmp_path):
    f = spark.createDataFrame([(7 if i % 3 == 0 else i, "a", float(i)) for i in range(600)], "id long, c string, x double")
    lab = spark.createDataFrame([(i, float(i)) for i in [*range(500), 7]], "id long, label double")
    bf, bl = B.write_bucketed(f, "id", 3), B.write_bucketed(lab, "id", 3)
    assert B.hot_ids(bf, "id") == [7]
    got = B.join_bucketed(bf, bl, "id", "label").select("id", "c", "x", "label")
    assert sorted(map(str, got.collect())) == sorted(map(str, join_labels(f, lab, SPEC).collect()))
