"""Outcome model on Spark ML: majority baseline, stratified folds, LR / random forest CV, importances.

The feature table is at team-competition grain (one row per team and tournament), so it stays
small however large the event data grows; models train on it with Spark ML estimators.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchline.plans import model_relations as mr
from pitchline.plans.outcomes import FEATURES

col = F.col
SEED = 42
N_FOLDS = 5


class _WithoutSummary:
    """A fitted model without its training summary. A summary of two classes holds the session, which can't
    be sent to tasks any more once a write was observed in it; nothing here reads the summary."""

    def _fit(self, dataset):
        model = super()._fit(dataset)
        model._java_obj.setSummary(dataset.sparkSession._jvm.scala.Option.empty())
        return model


class _Forest(_WithoutSummary, RandomForestClassifier):
    pass


class _Regression(_WithoutSummary, LogisticRegression):
    pass


def labelled(features: DataFrame) -> DataFrame:
    """The rows every model, fold and baseline is about: those with a known class."""
    return features.where(col("outcome_class").isNotNull())


def majority_baseline(features: DataFrame) -> DataFrame:
    """Accuracy of always predicting the most frequent class."""
    counts = labelled(features).groupBy("outcome_class").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.sum("n").cast("long").alias("n_samples"),
                      F.max("n").cast("long").alias("majority_count"),
                      (F.max("n") / F.sum("n")).alias("baseline_accuracy"))


def stratified_folds(features: DataFrame, k: int = N_FOLDS, seed: int = SEED) -> DataFrame:
    """Deterministic stratified k-fold assignment: within each class, rows are shuffled by an
    md5 of (key, seed) and dealt round-robin, so every class is balanced to +-1 per fold.

    The rank within a class comes in two levels: rows are numbered within (class, first digits of
    the md5), and each such bucket starts after the rows of the buckets before it. So a class is
    numbered by many tasks, however large."""
    key = F.md5(F.concat(col("team_comp_key"), F.lit(f":{seed}")))
    rows = labelled(features).withColumn("_key", key).withColumn("_bucket", F.substring("_key", 1, 3))
    sizes = rows.groupBy("outcome_class", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("outcome_class").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # 4,096 at most
    starts = sizes.select("outcome_class", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("outcome_class", "_bucket").orderBy("_key", "team_comp_key")
    place = col("_start") + F.row_number().over(within) - 1
    return rows.join(starts, ["outcome_class", "_bucket"]).withColumn("fold", (place % k).cast("int")).select(
        *features.columns, "fold")


def _prepared(features: DataFrame) -> DataFrame:
    """Training rows, materialised once with a reliable checkpoint (the session's shared
    ``spark.checkpoint.dir``): iterative fitting then reads this small table instead of
    re-deriving every mart from the events on each optimiser step, and an executor loss does
    not replay that lineage. NULL features (a team absent from one mart) are set to 0.0."""
    return (labelled(features).na.fill(0.0, subset=FEATURES)
            .checkpoint(eager=True))


def _stages(model: str, n_rows: int):
    idx = StringIndexer(inputCol="outcome_class", outputCol="label", stringOrderType="alphabetAsc")
    asm = VectorAssembler(inputCols=FEATURES, outputCol="raw_features")
    if model == "logistic_regression":
        # sklearn's default L2 (C=1 on the summed loss) is regParam = 1/n on Spark's mean loss;
        # its default stopping tolerance is 1e-4 (Spark's is 1e-6), with the same 1000-step cap
        return [idx, asm, StandardScaler(inputCol="raw_features", outputCol="features", withMean=True,
                                         withStd=True),
                _Regression(featuresCol="features", family="multinomial", maxIter=1000,
                                   regParam=1.0 / max(n_rows, 1), elasticNetParam=0.0, tol=1e-4)]
    return [idx, asm, _Forest(featuresCol="raw_features", numTrees=100, maxDepth=4,
                                             seed=SEED)]


def scaled_features(features: DataFrame) -> DataFrame:
    """What the logistic regression sees, one column a feature: mean 0, sample deviation 1."""
    data = _prepared(features)
    idx, asm, scaler, _ = _stages("logistic_regression", 1)
    out = Pipeline(stages=[asm, scaler]).fit(data).transform(data)
    values = vector_to_array("features")
    return out.select("team_comp_key", *[F.get(values, i).alias(c) for i, c in enumerate(FEATURES)])


def cross_validate(features: DataFrame, k: int = N_FOLDS) -> DataFrame:
    """Per model: mean and std of accuracy over the stratified folds (``CrossValidator`` with a
    fold column, so the folds are exactly ``stratified_folds``)."""
    spark = features.sparkSession
    data = stratified_folds(_prepared(features), k)
    n = data.count()
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction",
                                           metricName="accuracy")
    rows = []
    for model in ("logistic_regression", "random_forest"):
        cv = CrossValidator(estimator=Pipeline(stages=_stages(model, n)), estimatorParamMaps=[{}],
                            evaluator=ev, foldCol="fold", numFolds=k, seed=SEED)
        fitted = cv.fit(data)
        rows.append((model, k, float(fitted.avgMetrics[0]), float(fitted.stdMetrics[0])))
    return spark.createDataFrame(rows, "model string, n_folds int, mean_accuracy double, std_accuracy double")


def optimality(features: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """P4's certificate: the logistic regression fitted on all rows, its coefficients exported, and the
    gradient of its loss there as a relational aggregate: zero, up to ``tolerance``, only at the one
    optimum of the strictly convex loss. One row: (n_rows, n_classes, n_features, steepest_slope, optimal)."""
    spark = features.sparkSession
    data = _prepared(features)
    n = data.count()
    fitted = Pipeline(stages=_stages("logistic_regression", n)).fit(data)
    samples = fitted.transform(data).select(col("team_comp_key").alias("id"), "label", "features")
    slopes = mr.gradient(samples, mr.coefficients(spark, fitted.stages[-1]), 1.0 / n)
    return slopes.agg(F.max(F.abs("slope")).alias("steepest_slope"), F.count_distinct("feature").alias("k"),
                      F.count_distinct("class").alias("n_classes")).select(
        F.lit(n).cast("long").alias("n_rows"), "n_classes", (col("k") - 1).alias("n_features"), "steepest_slope",
        (col("steepest_slope") < tolerance).alias("optimal"))


def forest_agreement(features: DataFrame) -> DataFrame:
    """The forest's nodes as rows. For every feature, whether the importance that the nodes
    give is the model's; for every team, whether walking the nodes predicts what the model does:
    (subject, agrees)."""
    spark = features.sparkSession
    data = _prepared(features)
    fitted = Pipeline(stages=_stages("random_forest", 0)).fit(data)
    forest = fitted.stages[-1]
    nodes = mr.forest_nodes(spark, forest)
    theirs = spark.createDataFrame([(i, name, float(x)) for i, (name, x) in enumerate(zip(FEATURES, forest.featureImportances.toArray(), strict=True))],
                                   "feature int, subject string, theirs double")
    importances = theirs.join(mr.node_importances(nodes), "feature", "left").select(
        "subject", (F.abs(F.coalesce("importance", F.lit(0.0)) - col("theirs")) < 1e-9).alias("agrees"))
    scored = fitted.transform(data).select("team_comp_key", vector_to_array("raw_features").alias("values"), col("prediction").alias("theirs"))
    walked = mr.forest_predictions(nodes, scored, "team_comp_key", forest.getNumTrees, forest.getOrDefault("maxDepth"))
    teams = scored.join(walked, "team_comp_key", "left").select(col("team_comp_key").alias("subject"), col("theirs").eqNullSafe(col("prediction")).alias("agrees"))
    return importances.unionByName(teams)


def feature_importance(features: DataFrame) -> DataFrame:
    """Random-forest importances on all rows, highest first."""
    spark = features.sparkSession
    data = _prepared(features)
    fitted = Pipeline(stages=_stages("random_forest", 0)).fit(data)
    imp = fitted.stages[-1].featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(FEATURES, [float(x) for x in imp])),
                               "feature string, importance double")
    return df.orderBy(col("importance").desc(), col("feature"))

