"""Price models with spatial blocks: neighbours, folds, metrics, training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import block_id
from ..operators.spatial import knn_join

FOLDS, NEIGHBOURS = 5, 10
#: What the price model sees of a listing (fixed names), and what it adds from the neighbours of the training rows.
FEATURES = (
    "lat", "lng", "dist_asuncion_km", "dist_via_principal_m", "dist_parque_m", "dist_agua_m", "dist_hospital_m", "dist_universidad_m", "frente_avenida", "cerca_agua",
    "pop_500m", "pop_1km", "pop_2km", "biz_500m", "biz_1km", "biz_2km", "log_superficie", "uso_comercial",
)
NEIGHBOUR_FEATURES = ("vecinos_log_usd_m2", "vecinos_dist_km")


def balanced_folds(df: DataFrame, folds: int = FOLDS, block: str = "block") -> DataFrame:
    """(block, n, fold): blocks by size, largest first (equal ones by name), each into the fold with the fewest rows so far, the first of equals.

    Only the blocks' counts go through the one task that deals them in order, of which there are as many as the map has blocks; it keeps a sum for each fold.
    """
    sizes = df.groupBy(F.col(block).alias("block")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "block").coalesce(1)

    def deal(batches):
        import pyarrow as pa

        load = [0] * folds
        for batch in batches:
            dealt = []
            for n in batch.column("n").to_pylist():
                fold = load.index(min(load))
                load[fold] += n
                dealt.append(fold)
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("n"), pa.array(dealt, pa.int32())], names=["block", "n", "fold"])

    return sizes.mapInArrow(deal, f"block {sizes.schema['block'].dataType.simpleString()}, n bigint, fold int")


def with_folds(df: DataFrame, folds: int = FOLDS) -> DataFrame:
    """The rows with their block and its balanced fold."""
    rows = df.withColumn("block", block_id("lat", "lng"))
    return rows.join(balanced_folds(rows, folds).drop("n"), "block")


def model_features(df: DataFrame) -> DataFrame:
    """Adds log_superficie and uso_comercial (1 for comercial, 0 for habitacional, else missing); flags become numbers."""
    use = F.when(F.col("uso") == "comercial", 1.0).when(F.col("uso") == "habitacional", 0.0)
    rows = df.withColumn("log_superficie", F.log1p("superficie_m2")).withColumn("uso_comercial", use)
    return rows.withColumns({c: F.col(c).cast("double") for c in ("frente_avenida", "cerca_agua")})


def neighbour_features(queries: DataFrame, train: DataFrame, target: str, metres: float, k: int = NEIGHBOURS, key: str = "id", skip_self: bool = False) -> DataFrame:
    """Mean target and mean distance of the k nearest training rows."""
    points = train.select(F.col(key).alias("_p"), F.col("lat").alias("r_lat"), F.col("lng").alias("r_lng"), F.col(target).alias("_t"))
    near = knn_join(queries.select(key, "lat", "lng"), points, k, metres, key, "_p", skip_self)
    return near.groupBy(key).agg(F.avg("_t").alias("neighbour_target"), F.avg("distance_m").alias("neighbour_distance_m"))


def regression_metrics(df: DataFrame, truth: str = "y", predicted: str = "p") -> DataFrame:
    """MAE, median absolute error, MAPE, RMSE and R2 in one pass but for the median."""
    e, t = F.col(predicted) - F.col(truth), F.col(truth)
    n = F.count("*")
    return df.agg(
        F.avg(F.abs(e)).alias("mae"), F.percentile(F.abs(e), F.lit(0.5)).alias("medae"), (F.avg(F.abs(e) / F.nullif(F.abs(t), F.lit(0.0))) * 100).alias("mape"), F.sqrt(F.avg(e * e)).alias("rmse"), (1 - F.sum(e * e) / F.nullif(n * F.var_pop(t), F.lit(0.0))).alias("r2")
    )


def imputed(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Missing values become the column's median; a flag tells where."""
    medians = df.agg(*(F.coalesce(F.percentile(c, F.lit(0.5)), F.lit(0.0)).alias(f"_m_{c}") for c in columns))
    both = df.join(F.broadcast(medians))
    return both.select(*(c for c in df.columns if c not in columns), *(F.coalesce(F.col(c).cast("double"), F.col(f"_m_{c}")).alias(c) for c in columns), *(F.col(c).isNull().cast("double").alias(f"{c}_missing") for c in columns))


def train_price_model(df: DataFrame, label: str, features: tuple[str, ...] = FEATURES, kind: str = "forest", trees: int = 100, seed: int = 42):
    """A fitted Spark ML pipeline on log1p of the label; kind: forest or boosted."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

    flags = tuple(f"{c}_missing" for c in features)
    rows = imputed(df, features).withColumn("log_label", F.log1p(F.col(label)))
    learner = RandomForestRegressor(labelCol="log_label", numTrees=trees, minInstancesPerNode=2, maxDepth=10, seed=seed) if kind == "forest" else GBTRegressor(labelCol="log_label", maxIter=trees, stepSize=0.05, seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=[*features, *flags], outputCol="features"), learner]).fit(rows)


def predict_price(model, df: DataFrame, features: tuple[str, ...] = FEATURES) -> DataFrame:
    return model.transform(imputed(df, features)).withColumn("predicted", F.greatest(F.expm1("prediction"), F.lit(0.0)))


METRICS = ("mae", "medae", "mape", "rmse", "r2")


def with_neighbours(df: DataFrame, train: DataFrame, label: str, metres: float, k: int = NEIGHBOURS, skip_self: bool = False) -> DataFrame:
    """Adds the neighbours' mean log price and distance, of training rows only."""
    near = neighbour_features(df, train.withColumn("_log", F.log1p(F.col(label))), "_log", metres, k, skip_self=skip_self)
    return df.join(near.select("id", F.col("neighbour_target").alias(NEIGHBOUR_FEATURES[0]), (F.col("neighbour_distance_m") / 1000).alias(NEIGHBOUR_FEATURES[1])), "id", "left")


def cross_validate(df: DataFrame, label: str, features: tuple[str, ...] = FEATURES, folds: int = FOLDS, neighbours_m: float | None = None, **how) -> DataFrame:
    """Mean metrics over spatial folds (column ``fold``); with neighbours_m the neighbours' features are made anew of each fold's training rows."""
    out = None
    for f in range(folds):
        train, test, own = df.where(F.col("fold") != f), df.where(F.col("fold") == f), features
        if neighbours_m is not None:
            test, train = with_neighbours(test, train, label, neighbours_m), with_neighbours(train, train, label, neighbours_m, skip_self=True)
            own = (*features, *NEIGHBOUR_FEATURES)
        model = train_price_model(train, label, own, **how)
        scored = regression_metrics(predict_price(model, test.withColumn("_y", F.col(label).cast("double")), own).select(F.col("_y").alias("y"), F.col("predicted").alias("p")))
        out = scored if out is None else out.unionByName(scored)
    return out.agg(*(F.avg(c).alias(c) for c in METRICS))


def baseline(df: DataFrame, label: str) -> DataFrame:
    """The metrics of the one prediction that needs no model: the median of all rows."""
    middle = df.agg(F.percentile(F.col(label), F.lit(0.5)).cast("double").alias("p"))
    return regression_metrics(df.select(F.col(label).cast("double").alias("y")).join(F.broadcast(middle)))


def winner(scores: dict[str, DataFrame]) -> str:
    """The kind of least mean absolute error; the first of equals."""
    return min(scores, key=lambda kind: scores[kind].first().mae)


def save_bundle(model, path: str, features: tuple[str, ...], kind: str, n_train: int, metrics: DataFrame, train: DataFrame, label: str, k: int = NEIGHBOURS) -> None:
    """The fitted pipeline, what it was fitted on, its metrics, and the training rows that neighbours are sought among."""
    spark = train.sparkSession
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(list(features), f"log1p({label})", kind, n_train, k)], "features array<string>, target string, algorithm string, n_train bigint, k_neighbours int").crossJoin(metrics).write.mode("overwrite").json(f"{path}/about")
    train.select("id", "lat", "lng", F.log1p(F.col(label)).alias("y_log")).write.mode("overwrite").parquet(f"{path}/neighbours")


def load_bundle(spark, path: str):
    """(pipeline, its description as a row, the neighbours' rows)."""
    from pyspark.ml import PipelineModel

    return PipelineModel.load(f"{path}/model"), spark.read.json(f"{path}/about").first(), spark.read.parquet(f"{path}/neighbours")


#: Rows of a group that values are dealt within.
ROWS_DEALT = 100_000


def permutation_importance(model, df: DataFrame, label: str, features: tuple[str, ...] = FEATURES, seed: int = 42, repeats: int = 10, columns: tuple[str, ...] | None = None) -> list[tuple[str, float]]:
    """Mean rise of the mean absolute error when one column's values are dealt anew, over several dealings, the largest first; of all features, or of the ``columns`` named. Values move within
    hashed groups along two hash orders, so no global sort is needed."""
    from pyspark.sql import Window as W

    rows = df.withColumn("_y", F.col(label).cast("double"))
    mae = lambda d: regression_metrics(predict_price(model, d, features).select(F.col("_y").alias("y"), F.col("predicted").alias("p"))).first().mae
    base, out, groups = mae(rows), [], max(64, rows.count() // ROWS_DEALT)
    for c in columns or features:
        rises = []
        for n in range(seed, seed + repeats):
            part = F.pmod(F.xxhash64("id", F.lit(n)), F.lit(groups))
            a = rows.withColumn("_g", part).withColumn("_a", F.row_number().over(W.partitionBy("_g").orderBy(F.xxhash64("id"), "id")))
            b = a.select("_g", F.row_number().over(W.partitionBy("_g").orderBy(F.xxhash64("id", F.lit(c), F.lit(n)), "id")).alias("_a"), F.col(c).alias("_v"))
            rises.append(mae(a.join(b, ["_g", "_a"]).drop(c, "_g", "_a").withColumnRenamed("_v", c)) - base)
        out.append((c, sum(rises) / repeats))
    return sorted(out, key=lambda x: -x[1])
