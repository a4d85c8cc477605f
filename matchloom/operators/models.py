"""Match-win classifiers on the feature table, with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .evaluate import dev_valid_split, medians, metrics, select_mode, split_diagnostics, symmetrised, temporal_split

BASELINE = ["diff_rank_pre_observed_only", "diff_points_pre_observed_only", "rel_diff_points_pct_min_pre", "elo_diff", "elo_expected", "player_points_missing_pre", "opponent_points_missing_pre", "both_points_observed_pre"]


def _prepared(features: Sequence[str]) -> list:
    filled = [f"{c}__filled" for c in features]
    return [Imputer(strategy="median", inputCols=list(features), outputCols=filled), VectorAssembler(inputCols=filled, outputCol="raw_features")]


def logistic(features: Sequence[str], reg: float = 1e-3) -> Pipeline:
    """Medians, standard scores, L2 with class weights."""
    scale = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True)
    return Pipeline(stages=[*_prepared(features), scale, LogisticRegression(labelCol="win", weightCol="weight", regParam=reg, standardization=False)])


def boosted_trees(features: Sequence[str], rounds: int = 700) -> Pipeline:
    gbt = GBTClassifier(labelCol="win", featuresCol="raw_features", maxIter=rounds, maxDepth=3, stepSize=0.025, subsamplingRate=0.85, minInstancesPerNode=10, seed=23)
    return Pipeline(stages=[*_prepared(features), gbt])


def random_forest(features: Sequence[str], trees: int = 700) -> Pipeline:
    rf = RandomForestClassifier(labelCol="win", featuresCol="raw_features", weightCol="weight", numTrees=trees, featureSubsetStrategy="sqrt", minInstancesPerNode=5, maxDepth=20, seed=23)
    return Pipeline(stages=[*_prepared(features), rf])


def balanced(df: DataFrame, label: str = "win") -> DataFrame:
    """``weight``: classes count alike."""
    share = df.agg(F.avg(F.col(label).cast("double")).alias("_p"))
    w = F.when(F.col(label) == 1, 0.5 / F.col("_p")).otherwise(0.5 / (1 - F.col("_p")))
    return df.crossJoin(F.broadcast(share)).withColumn("weight", w).drop("_p")


def with_score(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn("p", vector_to_array("probability")[1])


def train_and_evaluate(long: DataFrame, features: Sequence[str], pipeline: Pipeline, months: int = 3) -> tuple[PipelineModel, DataFrame]:
    """The model fitted before the split date, and its metrics by row and by match after it."""
    typed = long.withColumns({c: F.col(c).cast("double") for c in features}).withColumn("win", F.col("win").cast("double"))
    split = temporal_split(typed, months)
    model = pipeline.fit(balanced(split.where("is_test = 0")))
    scored = with_score(model, split.where("is_test = 1").withColumn("weight", F.lit(1.0)))
    rows = metrics(scored.withColumn("level", F.lit("row")), ["level"], "win")
    won = scored.where("perspective = 'player1'").select("match_id", F.col("win").alias("y"))
    by_match = metrics(symmetrised(scored).join(won, "match_id").withColumn("level", F.lit("match")), ["level"], "y", "p1")
    return model, rows.unionByName(by_match)


def feature_medians(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """What missing features are filled with at serving; one row."""
    return medians(df, features)


#: Boosting in three sizes: rounds, depth, step, share of rows, least rows of a leaf.
MODES = {"light": (300, 3, 0.05, 0.8, 20), "balanced": (500, 4, 0.04, 0.85, 15), "power": (800, 5, 0.03, 0.9, 10)}


def boosted_modes(long: DataFrame, features: Sequence[str], modes: dict[str, tuple[int, int, float, float, int]] | None = None) -> tuple[str, PipelineModel, DataFrame]:
    """The chosen mode, its model and all modes' figures.

    Each mode is fitted on the earlier dates and stops when the later ones' loss no longer falls (a validation
    indicator); the mode with the smallest train/validation gap among the best is chosen (:func:`select_mode`).
    """
    typed = dev_valid_split(long.withColumns({c: F.col(c).cast("double") for c in features}).withColumn("win", F.col("win").cast("double")))
    marked = typed.withColumn("valid", F.col("is_valid") == 1)
    fitted, tables = {}, []
    for mode, (rounds, depth, step, share, leaf) in (modes or MODES).items():
        gbt = GBTClassifier(labelCol="win", featuresCol="raw_features", maxIter=rounds, maxDepth=depth, stepSize=step, subsamplingRate=share, minInstancesPerNode=leaf, validationIndicatorCol="valid", validationTol=1e-4, seed=23)
        fitted[mode] = Pipeline(stages=[*_prepared(features), gbt]).fit(marked)
        scored = with_score(fitted[mode], marked).select(F.lit(mode).alias("model"), F.col("is_valid").alias("is_test"), F.col("win").alias("y"), "p")
        tables.append(split_diagnostics(scored).withColumn("rounds", F.lit(fitted[mode].stages[-1].getNumTrees)))
    table = tables[0]
    for t in tables[1:]:
        table = table.unionByName(t)
    kept = long.sparkSession.createDataFrame(table.collect(), table.schema)  # a row a mode
    chosen = select_mode(kept.select(F.col("model").alias("mode"), F.col("test_logloss").alias("logloss"), F.abs("gap").alias("gap"))).first()["mode"]
    return chosen, fitted[chosen], kept


def refit(long: DataFrame, features: Sequence[str], pipeline: Pipeline) -> PipelineModel:
    """The model for serving: fitted on all rows."""
    typed = long.withColumns({c: F.col(c).cast("double") for c in features}).withColumn("win", F.col("win").cast("double"))
    return pipeline.fit(balanced(typed))


def save_bundle(model: PipelineModel, features: Sequence[str], quality: DataFrame, path: str) -> None:
    """A model with its features, their fill values and its figures, in one folder."""
    model.write().overwrite().save(f"{path}/model")
    fill = model.stages[0].surrogateDF.first()
    quality.sparkSession.createDataFrame([(f, float(fill[f])) for f in features], "feature string, fill double").coalesce(1).write.mode("overwrite").parquet(f"{path}/features")
    quality.write.mode("overwrite").parquet(f"{path}/quality")


def load_bundle(spark: SparkSession, path: str) -> tuple[PipelineModel, dict[str, float], DataFrame]:
    model = PipelineModel.load(f"{path}/model")
    return model, {r.feature: r.fill for r in spark.read.parquet(f"{path}/features").collect()}, spark.read.parquet(f"{path}/quality")


def backfilled(rows: DataFrame, fill: dict[str, float]) -> DataFrame:
    """``rows`` with every feature of a bundle: missing columns and values get the fill."""
    return rows.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(v)) if f in rows.columns else F.lit(v) for f, v in fill.items()})
