"""Exact quantiles against numpy, through every path."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mendtable.operators import quantiles as Q

PROBS = [0.0, 0.25, 0.5, 0.9, 1.0]
RNG = np.random.default_rng(7)
SHAPES = {
    "normal": RNG.normal(size=4001),
    "ties": RNG.integers(0, 4, size=4000).astype(float),
    "hot_value": np.where(RNG.random(5000) < 0.4, 3.0, RNG.normal(3, 1, 5000)),
    "heavy_tail": np.exp(RNG.normal(0, 12, 3000)),
    "signs": np.concatenate([-np.exp(RNG.normal(0, 5, 1500)), np.exp(RNG.normal(0, 5, 1500))]),
    "one": np.array([4.5]),
    "two": np.array([1.0, 2.0]),
    "constant": np.full(1000, 7.0),
}


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "v double").repartition(3)


@pytest.mark.parametrize("shape", sorted(SHAPES))
@pytest.mark.parametrize("bracket_rows", [Q.BRACKET_ROWS, 20])
def test_table_quantiles(spark, monkeypatch, shape, bracket_rows):
    monkeypatch.setattr(Q, "BRACKET_ROWS", bracket_rows)
    values = SHAPES[shape]
    found, _ = Q.table_quantiles(frame(spark, values), {"v": F.col("v")}, PROBS)
    assert np.allclose(found["v"], np.quantile(values, PROBS), rtol=1e-12, atol=0)


def test_a_misleading_sketch_cannot_spoil_the_answer(spark, monkeypatch):
    """Brackets that miss the wanted ranks are noticed and widened."""
    monkeypatch.setattr(Q, "_edges", lambda probs: [0.9, 0.95] * len(probs))
    found, _ = Q.table_quantiles(frame(spark, SHAPES["normal"]), {"v": F.col("v")}, [0.25, 0.5])
    assert np.allclose(found["v"], np.quantile(SHAPES["normal"], [0.25, 0.5]))


def test_nulls_and_nan_are_ignored(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    found, extra = Q.table_quantiles(
        df, {"v": F.col("v"), "none": F.lit(None).cast("double")}, [0.5], {"max": "max({})"},
        {"rows": (F.lit(1), "count({})")},
    )
    assert found == {"v": [2.0], "none": None}
    assert extra == {("max", "v"): 3.0, ("max", "none"): None, "rows": 4}


def test_infinities(spark):
    df = frame(spark, [float("-inf"), 1.0, 2.0, float("inf"), float("inf")])
    found, _ = Q.table_quantiles(df, {"v": F.col("v")}, [0.0, 0.5, 1.0])
    assert found["v"] == [float("-inf"), 2.0, float("inf")]


@pytest.mark.parametrize("small, tracked, bracket", [(10**9, 5, 10**6), (100, 100, 10**6), (100, 1, 10**6), (100, 2, 20)])
def test_grouped_quantiles(spark, monkeypatch, small, tracked, bracket):
    """A hot group, small groups, a null group and a group without values, on every path."""
    monkeypatch.setattr(Q, "SMALL_GROUP_ROWS", small)
    monkeypatch.setattr(Q, "TRACKED_PAIRS", tracked)
    monkeypatch.setattr(Q, "BRACKET_ROWS", bracket)
    groups = {
        "hot": SHAPES["normal"], None: SHAPES["ties"][:300], "tiny": np.array([1.0, 5.0]), "big": SHAPES["hot_value"][:900],
    }
    rows = [(g, float(v), float(-v)) for g, vs in groups.items() for v in vs] + [("void", None, None)] * 200
    df = spark.createDataFrame(rows, "g string, v double, w double").repartition(4)
    got = Q.grouped_quantiles(df, {"v": F.col("v"), "w": F.col("w")}, [0.25, 0.5], ["g"]).collect()
    found = {(r.g, r.column_name): r.q for r in got}
    assert len(got) == 2 * (len(groups) + 1)
    for g, vs in groups.items():
        assert np.allclose(found[(g, "v")], np.quantile(vs, [0.25, 0.5]))
        assert np.allclose(found[(g, "w")], np.quantile(-np.asarray(vs), [0.25, 0.5]))
    assert found[("void", "v")] is None
