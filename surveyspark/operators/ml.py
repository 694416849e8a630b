"""Machine-learning operators on tables (M1-M15, M17) built on Spark ML.

Iterative estimators (K-Means, PCA, random forest, cross-validation) read their input
many times, so the jobs in ``plans.jobs`` cut the lineage first with a reliable
``checkpoint()`` under ``spark.checkpoint.dir``; a lost executor then re-reads the
checkpoint instead of recomputing the whole upstream plan.
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    ElementwiseProduct, IndexToString, OneHotEncoder, PCA, StandardScaler, StringIndexer, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from surveyspark.functions import codebooks as cb
from surveyspark.functions.expressions import fmt, pct_deviation
from surveyspark.operators.forest import COUNT, CountedForest, confusions, counted, fit_counted, grow_counted
from surveyspark.session import reliable_checkpoint


# ---------------------------------------------------------------- features

def assemble(df: DataFrame, cols: list[str], out: str = "features", handle_invalid: str = "error") -> DataFrame:
    """M1: feature columns -> vector (NULL raises unless handle_invalid says otherwise)."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid=handle_invalid).transform(df)


def standardize(df: DataFrame, cols: list[str], ddof: int = 1, suffix: str = "_z") -> DataFrame:
    """M2 (ddof=1, sample std) / M3 (ddof=0, population std) as plain columns.

    Means and deviations of all columns come from one aggregation entered as a scalar
    subquery; a constant column gives NULL instead of a division error.
    """
    std = F.stddev_samp if ddof == 1 else F.stddev_pop
    stats = df.agg(F.struct(*[F.struct(F.avg(c).alias("m"), std(c).alias("s")).alias(c) for c in cols])).scalar()
    out = df.withColumn("_st", stats)
    return out.withColumns({
        f"{c}{suffix}": F.try_divide(F.col(c).cast("double") - F.col("_st")[c]["m"], F.col("_st")[c]["s"])
        for c in cols}).drop("_st")


def scale_vector(df: DataFrame, in_col: str = "features", out_col: str = "scaledFeatures",
                 with_mean: bool = True):
    """M2 on a vector column (Spark StandardScaler: sample std). Returns (model, df)."""
    model = StandardScaler(inputCol=in_col, outputCol=out_col, withMean=with_mean, withStd=True).fit(df)
    return model, model.transform(df)


# ---------------------------------------------------------------- clustering, PCA

def kmeans(df: DataFrame, features_col: str = "scaledFeatures", k: int = 3, seed: int = 42,
           prediction_col: str = "prediction"):
    """M4: K-Means fit + predictions. Returns (model, predictions)."""
    model = KMeans(featuresCol=features_col, k=k, seed=seed, predictionCol=prediction_col).fit(df)
    return model, model.transform(df)


def centers(df: DataFrame, model, names: list[str], cluster_col: str = "cluster") -> DataFrame:
    """M5: cluster centres as a table (k rows, report-sized)."""
    rows = [(i, *[float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    schema = ", ".join([f"{cluster_col} int"] + [f"`{n}` double" for n in names])
    return df.sparkSession.createDataFrame(rows, schema)


def pca(df: DataFrame, in_col: str = "scaledFeatures", k: int = 2, out_col: str = "pcaFeatures"):
    """M6: PCA fit + projection. Returns (model, transformed)."""
    model = PCA(k=k, inputCol=in_col, outputCol=out_col).fit(df)
    return model, model.transform(df)


def explained_variance(df: DataFrame, model) -> DataFrame:
    """Explained-variance ratio per component (sign-free summary of a PCA fit)."""
    rows = [(i, float(v)) for i, v in enumerate(model.explainedVariance.toArray())]
    return df.sparkSession.createDataFrame(rows, "componente int, varianza_explicada double")


def cluster_profile(df: DataFrame, key: str, cols: list[str], threshold: float = cb.PROFILE_THRESHOLD_PCT,
                    cluster_col: str = "cluster") -> tuple[DataFrame, DataFrame]:
    """M7 (A10 + A11 + C9 + C10): per (cluster, feature) means vs global means with the
    deviation label, and per cluster the profile text.

    Returns (details, profiles). details: cluster, feature, position, media_cluster,
    media_global, desviacion_pct, etiqueta. profiles: cluster, perfil.
    """
    # one pass over the data: per-cluster sums and counts; the global means are derived from
    # that small table (checkpointed, one row per cluster) instead of a second scan
    per = reliable_checkpoint(df.groupBy(F.col(key).alias(cluster_col)).agg(
        *[F.sum(F.col(c).cast("double")).alias(f"_s_{c}") for c in cols],
        *[F.count(c).alias(f"_n_{c}") for c in cols]))
    glob = per.agg(F.struct(*[F.try_divide(F.sum(f"_s_{c}"), F.sum(f"_n_{c}")).alias(c) for c in cols])).scalar()
    long = per.withColumn("_glob", glob).select(cluster_col, F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(i).alias("position"),
                 F.try_divide(F.col(f"_s_{c}"), F.col(f"_n_{c}")).alias("media_cluster"),
                 F.col("_glob")[c].alias("media_global")) for i, c in enumerate(cols)])))
    dev = pct_deviation("media_cluster", "media_global")
    details = long.withColumn("desviacion_pct", dev).withColumn(
        "etiqueta",
        F.when(F.col("desviacion_pct") > threshold,
               F.concat(F.col("feature"), F.lit(f" {cb.PROFILE_HIGH} ("), fmt("desviacion_pct", 1, signed=True), F.lit("%)")))
        .when(F.col("desviacion_pct") < -threshold,
              F.concat(F.col("feature"), F.lit(f" {cb.PROFILE_LOW} ("), fmt("desviacion_pct", 1), F.lit("%)"))))
    return details, profile_text(details, cluster_col)


def profile_text(details: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """Per cluster, the significant labels in feature order joined by ", ", or the
    fallback sentence when none is significant. Collects at most one label per feature."""
    labels = F.sort_array(F.collect_list(F.when(F.col("etiqueta").isNotNull(), F.struct("position", "etiqueta"))))
    return details.groupBy(cluster_col).agg(labels.alias("_l")).select(
        cluster_col,
        F.when(F.size("_l") == 0, F.lit(cb.PROFILE_AVERAGE_TEXT))
        .otherwise(F.array_join(F.transform("_l", lambda s: s["etiqueta"]), ", ")).alias("perfil"))


# ---------------------------------------------------------------- encoders, forest

def string_indexer(col: str, out: str | None = None, handle_invalid: str = "keep") -> StringIndexer:
    """M9: index by descending frequency, ties alphabetical; unseen -> extra index."""
    return StringIndexer(inputCol=col, outputCol=out or f"{col}_idx", handleInvalid=handle_invalid,
                         stringOrderType="frequencyDesc")


def string_index(df: DataFrame, col: str, out: str | None = None):
    model = string_indexer(col, out).fit(df)
    return model, model.transform(df)


def one_hot(idx_cols: list[str], out_cols: list[str], unknown: str = "keep") -> OneHotEncoder:
    """One-hot encoder.

    unknown="keep": unseen values get their own slot (indexer keep + encoder keep).
    unknown="ignore": every seen level encoded, unseen -> all zeros (indexer keep puts unseen
    at the last index, which ``dropLast`` removes).
    """
    if unknown == "ignore":
        return OneHotEncoder(inputCols=idx_cols, outputCols=out_cols, dropLast=True, handleInvalid="error")
    return OneHotEncoder(inputCols=idx_cols, outputCols=out_cols, handleInvalid="keep")


class PopulationScaler(Estimator):
    """M3 on a vector column: centred and divided by the population std (Spark's own scaler uses the sample std)."""

    def __init__(self, input_col: str, output_col: str):
        super().__init__()
        self.input_col, self.output_col = input_col, output_col

    def _fit(self, dataset):
        mid = f"{self.output_col}_sample"
        model = StandardScaler(inputCol=self.input_col, outputCol=mid, withMean=True, withStd=True).fit(dataset)
        n = dataset.count()
        factor = (n / (n - 1)) ** 0.5 if n > 1 else 1.0
        wider = ElementwiseProduct(scalingVec=Vectors.dense([factor] * len(model.mean)), inputCol=mid, outputCol=self.output_col)
        return PipelineModel([model, wider])


def feature_stages(numeric: list[str], categorical: list[str], unknown: str = "keep",
                   scale_numeric: bool = False, features_col: str = "features", invalid: str = "error") -> list:
    """M11/M12 column transform: numeric (optionally standardised as in M3) + one-hot categoricals.

    ``invalid``: what a NULL or NaN number does: "error" raises, "skip" drops the row, "keep" lets NaN through."""
    stages, feats = [], []
    if numeric and scale_numeric:
        stages.append(VectorAssembler(inputCols=numeric, outputCol="_num_vec", handleInvalid=invalid))
        stages.append(PopulationScaler("_num_vec", "_num_scaled"))
        feats.append("_num_scaled")
    else:
        feats.extend(numeric)
    if categorical:
        idx = [f"{c}_idx" for c in categorical]
        enc = [f"{c}_enc" for c in categorical]
        stages.append(StringIndexer(inputCols=categorical, outputCols=idx, handleInvalid="keep", stringOrderType="frequencyDesc"))
        stages.append(one_hot(idx, enc, unknown))
        feats.extend(enc)
    stages.append(VectorAssembler(inputCols=feats, outputCol=features_col, handleInvalid=invalid))
    return stages


column_transform = feature_stages  # M11 name: numeric + one-hot categorical column transform


def random_forest(label_col: str = "label", features_col: str = "features", seed: int = 42, **params) -> RandomForestClassifier:
    """M13. Node-id caching is on by default: deep trees then reuse cached node assignments
    instead of re-deriving them per level, and the cache is checkpointed every
    ``checkpointInterval`` iterations under ``spark.checkpoint.dir`` (same trees either way)."""
    params.setdefault("cacheNodeIds", True)
    params.setdefault("checkpointInterval", 10)
    return RandomForestClassifier(labelCol=label_col, featuresCol=features_col, seed=seed, **params)


class ClassifierPipeline(Pipeline):
    """A pipeline whose last stage is the classifier. Fitted for several settings of the classifier (as in a grid search),
    the stages before it are fitted once for them all: they cannot differ. The models are those of separate fits. A
    ``CountedForest`` gets the distinct rows of the columns that the stages read, with their counts."""

    def inputs(self, dataset: DataFrame) -> list[str]:
        """The columns of ``dataset`` that the stages before the classifier read."""
        read = set()
        for stage in self.getStages()[:-1]:
            for name in ("inputCol", "inputCols"):
                if stage.hasParam(name) and stage.isDefined(name):
                    value = stage.getOrDefault(name)
                    read |= {value} if isinstance(value, str) else set(value)
        return [c for c in dataset.columns if c in read]

    def fitMultiple(self, dataset, paramMaps):
        *before, classifier = self.getStages()
        if not all(classifier.hasParam(p.name) and p.parent == classifier.uid for point in paramMaps for p in point):
            return super().fitMultiple(dataset, paramMaps)
        prepared = Pipeline(stages=before).fit(dataset)
        forests = [classifier.copy(point) for point in paramMaps]
        if isinstance(classifier, CountedForest) and all(f.can_count() for f in forests):
            rows = prepared.transform(counted(dataset, self.inputs(dataset)))
            models = fit_counted(rows, forests)
            return iter([(i, PipelineModel([*prepared.stages, m])) for i, m in enumerate(models)])
        fitted = classifier.fitMultiple(prepared.transform(dataset), paramMaps)
        return map(lambda found: (found[0], PipelineModel([*prepared.stages, found[1]])), fitted)

    def _fit(self, dataset):
        if isinstance(self.getStages()[-1], CountedForest):
            return next(iter(self.fitMultiple(dataset, [{}])))[1]
        return super()._fit(dataset)


class CountedValidator(CrossValidator):
    """Cross-validation of a ``ClassifierPipeline`` with a ``CountedForest`` over given folds: a fold's forests are grown
    together, and scored on the fold's distinct rows with their counts (the evaluator's weights), which gives the metric
    of all its rows. ``parallelism`` folds run at a time."""

    def _kFold(self, dataset):
        fold, k = self.getFoldCol(), self.getNumFolds()
        if not dataset.filter(F.col(fold).isNull() | ~F.col(fold).between(0, k - 1)).isEmpty():
            raise ValueError(f"folds must be 0 to {k - 1}")
        columns = self.getEstimator().inputs(dataset)
        return [(dataset.filter(F.col(fold) != i), counted(dataset.filter(F.col(fold) == i), columns)) for i in range(k)]

    def _fit(self, dataset):
        pipeline, points, evaluator = self.getEstimator(), self.getEstimatorParamMaps(), self.getEvaluator()
        *before, classifier = pipeline.getStages()
        forests = [classifier.copy(point) for point in points]
        own = all(p.parent == classifier.uid for point in points for p in point)
        if not (own and isinstance(pipeline, ClassifierPipeline) and all(f.can_count() for f in forests)):
            return super()._fit(dataset)
        spark, columns = dataset.sparkSession, pipeline.inputs(dataset)

        def scores(rows) -> list[float]:
            train, validation = rows
            prepared = Pipeline(stages=before).fit(train)
            grown = grow_counted(prepared.transform(counted(train, columns)), forests)
            cells = confusions(prepared.transform(validation), classifier, grown)
            return [evaluator.evaluate(spark.createDataFrame(c, f"label double, prediction double, {COUNT} long").coalesce(1)) for c in cells]

        kept = dataset.persist()
        try:
            with ThreadPool(self.getParallelism()) as pool:
                metrics = np.array(pool.map(inheritable_thread_target(spark)(scores), self._kFold(kept)))
            means = metrics.mean(axis=0)
            best = int(np.argmax(means) if evaluator.isLargerBetter() else np.argmin(means))
            model = pipeline.fit(kept, points[best])
        finally:
            kept.unpersist()
        return self._copyValues(CrossValidatorModel(model, [float(m) for m in means], [], [float(m) for m in metrics.std(axis=0)]))


def classifier_pipeline(target: str, numeric: list[str], categorical: list[str], seed: int = 42,
                        unknown: str = "keep", scale_numeric: bool = False, invalid: str = "error", count_rows: bool = False, **rf_params):
    """Label indexer + feature stages + forest + label decoder. Returns (pipeline, forest). ``count_rows``: the forest is a
    ``CountedForest``, for grids over large tables."""
    label_idx = StringIndexer(inputCol=target, outputCol="label", handleInvalid="keep")
    rf = random_forest("label", "features", seed, **rf_params)
    if count_rows:
        rf = CountedForest(labelCol="label", featuresCol="features", seed=seed, **rf_params)
    stages = [label_idx] + feature_stages(numeric, categorical, unknown, scale_numeric, invalid=invalid) + [rf]
    return ClassifierPipeline(stages=stages), rf


def grid_search(pipeline: Pipeline, rf: RandomForestClassifier, num_trees: list[int], max_depth: list[int],
                fold_col: str | None = "fold", num_folds: int = 5, parallelism: int = 2, seed: int = 42) -> CrossValidator:
    """K-fold cross-validated grid search on accuracy.

    With ``fold_col`` the folds come from a deterministic hash assignment (K5). With a ``CountedForest`` a fold is scored
    on its distinct rows, weighted.
    """
    grid = ParamGridBuilder().addGrid(rf.numTrees, num_trees).addGrid(rf.maxDepth, max_depth).build()
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="accuracy")
    kw = dict(estimator=pipeline, estimatorParamMaps=grid, evaluator=ev, parallelism=parallelism, seed=seed,
              numFolds=num_folds)
    if fold_col:
        kw["foldCol"] = fold_col
        if isinstance(rf, CountedForest):
            ev.setWeightCol(COUNT)
            return CountedValidator(**kw)
    return CrossValidator(**kw)


def best_params(cv_model) -> dict:
    i = int(np.argmax(cv_model.avgMetrics))
    return {p.name: v for p, v in cv_model.getEstimatorParamMaps()[i].items()}


def grid_table(spark, cv_model, metric: str = "accuracy") -> DataFrame:
    """A row for each grid point: its parameters, and the metric's mean and standard deviation over the folds."""
    points = [{p.name: v for p, v in point.items()} for point in cv_model.getEstimatorParamMaps()]
    names = sorted({n for point in points for n in point})
    rows = [(*[point.get(n) for n in names], float(mean), float(std)) for point, mean, std in zip(points, cv_model.avgMetrics, cv_model.stdMetrics)]
    return spark.createDataFrame(rows, ", ".join([*[f"{n} int" for n in names], f"{metric} double", f"{metric}_std double"]))


def class_labels(model) -> list[str]:
    """The classes of a fitted classifier pipeline, in the order of its indices."""
    stage = next(s for s in model.stages if getattr(s, "getOutputCol", lambda: None)() == "label")
    return list(stage.labels)


def score(model, df: DataFrame, label_out: str = "prediccion", proba_out: str = "probabilidades") -> DataFrame:
    """Batch scoring: predicted label (original text), the probability ``p_<class>`` of each class, and
    the same as an array in the order of the label index (the indexer's slot for unseen labels is left out)."""
    labels = class_labels(model)
    scored = model.transform(df)
    out = IndexToString(inputCol="prediction", outputCol=label_out, labels=labels + ["__unseen__"]).transform(scored)
    proba = vector_to_array(F.col("probability"))
    out = out.withColumn(proba_out, F.slice(proba, 1, len(labels)))
    return out.withColumns({f"p_{c}": F.get(F.col(proba_out), F.lit(i)) for i, c in enumerate(labels)})


def evaluate(model, df: DataFrame, target: str) -> DataFrame:
    """Hold-out accuracy and weighted P/R/F1 on the original labels."""
    from surveyspark.operators.metrics import weighted_metrics

    return weighted_metrics(score(model, df), target, "prediccion")
