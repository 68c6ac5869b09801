import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tradeflow.operators import forecast
from tradeflow.sources import tables

SEEN = [-70000, -5, 0, 1, 4, 10, 11, 65535, 65536, 200000, 2**31 - 1]


def brute(means, asked):
    def one(v):
        below = max((k for k in means if k <= v), default=None)
        above = min((k for k in means if k >= v), default=None)
        if below is None or above is None:
            return means[above if below is None else below]
        return means[below] if 2 * v <= below + above else means[above]

    return {v: one(v) for v in asked}


def trades(spark, volumes, seed=3):
    rng = random.Random(seed)
    data = [(v, rng.randrange(1, 10**6) / 100) for v in volumes for _ in range(rng.randrange(1, 6))]
    data += [(None, 1.0), (7, None)]
    df = spark.createDataFrame(data, "volume int, price double")
    means = {}
    for v in volumes:
        prices = [p for w, p in data if w == v and p is not None]
        means[v] = sum(prices) / len(prices)
    return df, means


def requests(spark, volumes):
    return spark.createDataFrame([(v,) for v in volumes], "volume int")


ASKED = sorted(
    {v + d for v in SEEN for d in (-3, -2, -1, 0, 1, 2, 3) if v + d < 2**31}
    | {-(2**31), 2, 3, 7, 100000, 132768, 132769, 10**9, 1073841823, 1073841824}
)


@pytest.mark.parametrize("points", [50_000, 7])
def test_nearest_leaf(spark, monkeypatch, points):
    monkeypatch.setattr(forecast, "RANGE_POINTS", points)
    df, means = trades(spark, SEEN)
    out = forecast.nearest_leaf(forecast.leaves(df), requests(spark, [*ASKED, 10, 10, None]))
    got = out.collect()
    expected = brute(means, ASKED)
    assert len(got) == len(ASKED) + 3
    for volume, prediction in got:
        if volume is None:
            assert prediction is None
        else:
            assert prediction == pytest.approx(expected[volume], rel=1e-12)


def test_tree_equals_exact(spark, tmp_path):
    rng = random.Random(11)
    df, means = trades(spark, sorted(rng.sample(range(0, 2000, 10), 120)))
    asked = list(range(-10, 2100))
    expected = brute(means, asked)
    model = forecast.fit_tree(df)
    forecast.save(model, str(tmp_path / "model"))
    loaded = forecast.load(str(tmp_path / "model"))
    for tree in (model, loaded):
        for volume, prediction in forecast.predict(tree, requests(spark, [*asked, None])).collect():
            if volume is None:
                assert prediction is None
            else:
                assert prediction == pytest.approx(expected[volume], rel=1e-9)


@pytest.mark.parametrize(
    "kind,price", [("double", "double"), ("decimal(12,3)", "double"), ("bigint", "decimal(12,5)")]
)
def test_volumes_of_any_type(spark, tmp_path, kind, price):
    seen = [3_000_000_000, 10, 20] if kind == "bigint" else [10.25, 10.75, 20.0]
    data = spark.createDataFrame(
        [(str(v), str(p)) for v, p in zip(seen, ("0.00004", "1.23456", "2500000"))], "volume string, price string"
    ).selectExpr(f"CAST(volume AS {kind}) AS volume", f"CAST(price AS {price}) AS price")
    forecast.save_leaves(forecast.leaves(data), str(tmp_path / "leaves"))
    asked = data.select("volume", F.lit("x").alias("id"))
    out = forecast.nearest_leaf(forecast.load_leaves(spark, str(tmp_path / "leaves")), asked)
    assert out.columns == ["volume", "id", "prediction"]
    assert sorted(r["prediction"] for r in out.collect()) == [0.00004, 1.23456, 2500000.0]
    between = spark.createDataFrame([(10.5,), (10.51,), (1e12,), (float("nan"),)], "volume double")
    if kind == "double":
        got = forecast.nearest_leaf(forecast.leaves(data), between).collect()
        assert [r["prediction"] for r in sorted(got, key=lambda r: r["volume"])] == [0.00004, 1.23456, 2500000.0, None]


def test_more_leaves_than_a_tree_holds(spark):
    data = spark.range(20_000).selectExpr("id / 7 AS volume", "pmod(hash(id), 1000) / 4 AS price")
    assert forecast.fit_predict(data, data).filter("abs(prediction - price) > 1e-9").isEmpty()


def test_a_tree_that_is_too_deep(spark, monkeypatch):
    df, _ = trades(spark, range(50))
    monkeypatch.setattr(forecast, "MAX_DEPTH", 3)
    with pytest.raises(forecast.TreeLimit):
        forecast.fit_tree(df)


def test_trees_of_one_leaf_and_of_none(spark):
    df, means = trades(spark, [5])
    model = forecast.fit_tree(df)
    for _, prediction in forecast.predict(model, requests(spark, [1, 5, 9])).collect():
        assert prediction == pytest.approx(means[5])
    with pytest.raises(ValueError, match="no trade"):
        forecast.fit_tree(df.filter("volume is null"))


def test_leaves(spark):
    df, means = trades(spark, [1, 2, 3])
    got = {r.volume: r.mean for r in forecast.leaves(df).collect()}
    assert got == pytest.approx(means)


def test_training_files(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5), (3, None), (None, 4.25)], "volume int, price double")
    tables.write_training(df, str(tmp_path / "csv"))
    inferred = tables.read_training(spark, str(tmp_path / "csv"))
    assert inferred.dtypes == [("volume", "int"), ("price", "double")]
    assert rows(inferred) == rows(df)
    declared = tables.read_training(spark, str(tmp_path / "csv"), df.schema)
    assert rows(declared.filter(F.col("volume") == 1)) == [(1, 2.5)]
