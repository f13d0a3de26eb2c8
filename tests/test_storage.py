"""Steps of a run have one folder, which can be dropped."""

from __future__ import annotations

import os

from firmlens import sources as src
from firmlens.sources import files


def test_steps_of_a_run_are_dropped_together(spark, tmp_path, monkeypatch):
    assert src.run_folder(spark) in src.shared_folder(spark, "step") and spark.sparkContext.applicationId in src.run_folder(spark)
    folder = str(tmp_path / "run")  # that of the session holds tables of other tests
    monkeypatch.setattr(files, "run_folder", lambda _: folder)
    table = src.stored(spark.range(5).toDF("id"), "numbers")
    other = src.stored(table.filter("id > 2"), "few")
    assert folder in table.inputFiles()[0] and other.count() == 2 and len(os.listdir(folder)) == 2
    src.drop_steps(spark)
    assert not os.path.exists(folder)
    src.drop_steps(spark)


def test_spread_only_deals_what_has_too_few_parts(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(100).coalesce(1).write.parquet(path)
    few = src.spread(spark.read.parquet(path))
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and few.count() == 100
    many = spark.range(100).repartition(64)
    assert src.spread(many) is many
