"""Price on volume: a fully grown regression tree.

With one numeric feature the grown tree predicts the mean price of each seen
volume; an unseen volume takes the neighbour on its side of the midpoint, the
lower one on a tie. The table of means, ``leaves``, is that model: ``nearest_leaf``
applies it, for any number and type of volumes, and it is saved as Parquet.
``fit_tree`` fits the ``pyspark.ml`` tree on the same leaves.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tradeflow.session import pin
from tradeflow.sources.tables import overwrite_parquet

RANGE_POINTS = 50_000
MAX_DEPTH = 30  # of Spark's trees


def leaves(trades: DataFrame) -> DataFrame:
    """Mean price and number of trades per volume.

    Volumes keep their type and prices their digits: decimals are summed as
    decimals, so their mean does not depend on the order of rows.
    """
    # Groups without any pair of volume and price are dropped by their count. A
    # test of the volume would be pushed below the aggregate, where a volume that
    # is parsed from text would be parsed twice.
    pairs = F.when(F.col("volume").isNotNull(), F.col("price"))
    return (
        trades.groupBy("volume")
        .agg(F.sum(pairs).cast("double").alias("total"), F.count(pairs).alias("n"))
        .filter(F.col("n") > 0)
        .select(
            "volume",
            (F.col("total") / F.col("n")).alias("mean"),
            F.col("n").cast("double").alias("weight"),
        )
    )


def _number(column: Column, kind: T.DataType) -> Column:
    """Wide enough that the sum of two cannot overflow."""
    if isinstance(kind, T.IntegralType):
        return column.cast("decimal(20,0)")
    return column


def nearest_leaf(leaf_means: DataFrame, requests: DataFrame) -> DataFrame:
    """``requests`` with ``prediction``, for any number of leaves and requests.

    Leaves and distinct requests are range partitioned together by volume and
    written out with the number of their range. Each point takes the nearest leaf
    below and above in its range, else from the nearest range that has one. A null
    or NaN volume has no prediction.
    """
    means = leaf_means.select("volume", "mean")
    asked = requests.select("volume", F.lit(None).cast("double").alias("mean"))
    points = means.unionByName(asked).groupBy("volume").agg(F.max("mean").alias("mean"))
    points = pin(points.filter(F.col("volume").isNotNull()), "points")
    kind = points.schema["volume"].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        points = points.filter(~F.isnan("volume"))
    ranges = 1 + points.count() // RANGE_POINTS
    points = points.repartitionByRange(ranges, "volume")
    points = pin(points.withColumn("bucket", F.spark_partition_id()), "points-by-range")
    points = points.withColumn("leaf", F.when(F.col("mean").isNotNull(), F.struct("volume", "mean")))

    # Upward looks are written as downward looks over the reverse order: a frame
    # that ends at the last row would be summed anew for each row.
    def nearest(column: str, partition: list[str], order, to: int):
        window = Window.partitionBy(*partition).orderBy(order)
        return F.last(column, ignorenulls=True).over(
            window.rowsBetween(Window.unboundedPreceding, to)
        )

    volume, bucket = F.col("volume"), F.col("bucket")
    edges = points.groupBy("bucket").agg(F.min("leaf").alias("first"), F.max("leaf").alias("last"))
    # One row per range of many thousand points.
    around = edges.select(
        "bucket",
        nearest("last", [], bucket.asc(), -1).alias("before"),
        nearest("first", [], bucket.desc(), -1).alias("after"),
    )
    sided = (
        points.withColumn("below", nearest("leaf", ["bucket"], volume.asc(), 0))
        .withColumn("above", nearest("leaf", ["bucket"], volume.desc(), 0))
        .join(around, "bucket")
        .withColumn("below", F.coalesce("below", "before"))
        .withColumn("above", F.coalesce("above", "after"))
    )
    below, above = _number(F.col("below.volume"), kind), _number(F.col("above.volume"), kind)
    at = _number(volume, kind)
    lower = F.col("above").isNull() | (at - below <= above - at)
    answers = sided.select(
        volume.alias("_volume"),
        F.when(F.col("below").isNull(), F.col("above.mean"))
        .when(lower, F.col("below.mean"))
        .otherwise(F.col("above.mean"))
        .alias("prediction"),
    )
    # Written out, so that Spark knows its size: it is broadcast if small; if large,
    # both sides are shuffled and a hot volume is split.
    answers = pin(answers, "answers")
    joined = requests.join(answers, requests["volume"].cast(kind) == answers["_volume"], "left")
    return joined.select(*[requests[c] for c in requests.columns], "prediction")


def fit_predict(trades: DataFrame, requests: DataFrame) -> DataFrame:
    """``requests`` with ``prediction`` by the trades' leaves."""
    return nearest_leaf(pin(leaves(trades), "leaves"), requests)


def save_leaves(leaf_means: DataFrame, path: str) -> None:
    overwrite_parquet(leaf_means, path)


def load_leaves(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _features(df: DataFrame) -> DataFrame:
    assembler = VectorAssembler(
        inputCols=["volume"], outputCol="features", handleInvalid="keep"
    )
    return assembler.transform(df)


class TreeLimit(ValueError):
    """Spark cannot grow the tree fully; ``nearest_leaf`` has no such limit."""


def fit_tree(trades: DataFrame) -> DecisionTreeRegressionModel:
    """The fully grown tree of price on volume.

    It is fitted on the leaves. Rows of one volume are never split, and their
    spread adds the same amount to the impurity on every level, so the weighted
    means give the same splits as the rows themselves; the trades are read once,
    whatever the depth. A tree that Spark's depth keeps from being fully grown,
    which shows in a leaf that it does not predict, is refused.
    """
    training = pin(leaves(trades), "leaves")
    n = training.count()
    if n == 0:
        raise ValueError("no trade has both a volume and a price")
    tree = DecisionTreeRegressor(
        labelCol="mean",
        weightCol="weight",
        maxDepth=MAX_DEPTH,
        maxBins=max(2, n),
        minInstancesPerNode=1,
        minInfoGain=0.0,
    )
    model = tree.fit(_features(training))
    off = F.abs(F.col("prediction") - F.col("mean")) > F.lit(1e-6) * (F.abs("mean") + 1)
    if not model.transform(_features(training)).filter(off).isEmpty():
        raise TreeLimit(f"{MAX_DEPTH} levels are not enough for {n} volumes")
    return model


def predict(model: DecisionTreeRegressionModel, requests: DataFrame) -> DataFrame:
    """``requests`` with ``prediction``; null for a null volume."""
    scored = model.transform(_features(requests)).drop("features")
    return scored.withColumn(
        "prediction", F.when(F.col("volume").isNotNull(), F.col("prediction"))
    )


def save(model: DecisionTreeRegressionModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> DecisionTreeRegressionModel:
    return DecisionTreeRegressionModel.load(path)
