"""Principal components against a singular value decomposition."""

from __future__ import annotations

import numpy as np
import pytest

from firmlens.operators import components as co


def plain(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    centred = x - x.mean(0)
    _, size, axes = np.linalg.svd(centred, full_matrices=False)
    axes = axes[:k].T
    axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])] < 0, -1, 1)
    return centred @ axes, (size**2)[:k] / (size**2).sum()


def table(spark, x: np.ndarray, parts: int = 4):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(None, None)], "id long, sims array<double>").repartition(parts)


@pytest.mark.parametrize(("rows", "columns", "k"), [(200, 12, 5), (40, 60, 6), (300, 5, 5), (150, 5_000, 3)])
def test_components_are_those_of_the_whole_matrix(spark, rows, columns, k):
    rng = np.random.default_rng(rows)
    x = rng.normal(size=(rows, k)) * 3.0 ** -np.arange(k) @ rng.normal(size=(k, columns)) + 1e-4 * rng.normal(size=(rows, columns)) + 5
    scores, share = plain(x, k)
    got = sorted(co.component_scores(table(spark, x), "id", k, k).collect(), key=lambda r: r.id)
    assert len(got) == rows
    found = np.array([[r[f"pc{i + 1}"] for i in range(k)] for r in got])
    assert np.allclose(found, scores, atol=1e-6 * np.abs(scores).max()) and np.allclose(got[0].explained, share, atol=1e-9)


def test_scores_are_the_same_in_every_partitioning(spark):
    x = np.random.default_rng(3).normal(size=(80, 30)) @ np.diag(2.0 ** -np.arange(30))
    a, b = ([(r.id, round(r.pc1, 8), round(r.pc2, 8)) for r in co.component_scores(table(spark, x, n), "id", 2).orderBy("id").collect()] for n in (1, 7))
    assert a == b


def test_equal_rows_and_no_rows(spark):
    got = co.component_scores(table(spark, np.ones((5, 3))), "id", 2).collect()
    assert len(got) == 5 and all(abs(r.pc1) < 1e-12 and r.explained == [0.0, 0.0] for r in got)
    with pytest.raises(ValueError, match="rows with columns"):
        co.component_scores(table(spark, np.ones((1, 3))).filter("id > 5"), "id", 2)


def test_what_makes_the_rows_runs_once(spark):
    from pyspark.sql import functions as F

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(50).select("id", F.array(F.rand(1), F.rand(2), F.rand(3)).alias("sims")).mapInArrow(count, "id long, sims array<double>")
    assert co.component_scores(rows, "id", 1).count() == 50 and seen.value == 50
