"""Class-weighted random forest on the customer features."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast import spec
from holdfast.functions import round_away
from holdfast.operators import evaluation
from holdfast.operators.attribution import aligned

WEIGHT = "_weight"

#: A forest is trained on a partition for so many rows, but on this many at least. Each partition
#: sends its sums of every node that is split, so more of them than the rows need only cost.
PARTITION_ROWS, LEAST_PARTITIONS = 250_000, 8


def pipeline(
    num_trees: int = 300,
    max_depth: int = 15,
    min_leaf: int = 5,
    seed: int = spec.SEED,
    max_bins: int = 128,
    label: str = spec.LABEL,
    memory_mb: int = 256,
) -> Pipeline:
    """Scaled numeric and one-hot categorical features into a forest.

    The indexer puts unseen and missing values last and the encoder drops the last slot, so
    they encode as all zeros.
    """
    codes = [f"_{c}_code" for c in spec.CATEGORICAL_FEATURES]
    hots = [f"_{c}_hot" for c in spec.CATEGORICAL_FEATURES]
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=spec.NUMERIC_FEATURES, outputCol="_numeric"),
            StandardScaler(inputCol="_numeric", outputCol="_scaled", withMean=True),
            StringIndexer(
                inputCols=spec.CATEGORICAL_FEATURES, outputCols=codes, handleInvalid="keep", stringOrderType="alphabetAsc"
            ),
            OneHotEncoder(inputCols=codes, outputCols=hots, dropLast=True),
            VectorAssembler(inputCols=["_scaled", *hots], outputCol="features"),
            RandomForestClassifier(
                featuresCol="features",
                labelCol=label,
                weightCol=WEIGHT,
                numTrees=num_trees,
                maxDepth=max_depth,
                minInstancesPerNode=min_leaf,
                featureSubsetStrategy="sqrt",
                maxBins=max_bins,
                seed=seed,
                maxMemoryInMB=memory_mb,
                cacheNodeIds=True,
            ),
        ]
    )


@dataclass
class Prepared:
    """Training rows (label, kept columns, ``features``) in a fixed order, encoded once and held
    while forests are fitted on them or on parts of them."""

    encoder: PipelineModel
    classifier: RandomForestClassifier
    rows: DataFrame
    partitions: int
    label: str

    def fit(self, part: Column | None = None) -> RandomForestClassificationModel:
        """Forest on the rows for which ``part`` holds; classes are balanced among these
        (``evaluation.class_weights``), and a class without rows has no weight."""
        rows = self.rows if part is None else self.rows.filter(part)
        n = {r[0]: r[1] for r in rows.groupBy(self.label).count().collect()}
        weight = F.lit(None).cast("double")
        for of_class, rows_of_class in n.items():
            weight = F.when(F.col(self.label) == of_class, sum(n.values()) / (len(n) * rows_of_class)).otherwise(weight)
        # a copy leaves the training summary behind, which would travel to the tasks with the model
        return self.classifier.fit(rows.withColumn(WEIGHT, weight)).copy()

    def pipeline(self, forest: RandomForestClassificationModel) -> PipelineModel:
        return PipelineModel([*self.encoder.stages, forest])


@contextmanager
def prepared(
    df: DataFrame, stages: Pipeline | None = None, label: str = spec.LABEL, keep: Sequence[str] = (), partitions: int | None = None
) -> Iterator[Prepared]:
    """Labelled rows, encoded and dealt by their hash, so the bootstrap, and with it the forest, is
    the same on any number of cores; ``partitions``, by default a function of the number of rows,
    is the only thing it depends on. They stay in memory or on local disk until the context ends."""
    stages = stages or pipeline(label=label)
    rows = df.filter(F.col(label).isNotNull()).select(*spec.FEATURES, label, *keep)
    if partitions is None:
        partitions = max(LEAST_PARTITIONS, -(-rows.count() // PARTITION_ROWS))
    *encoding, classifier = stages.getStages()
    encoder = Pipeline(stages=encoding).fit(rows)
    dealt = rows.withColumn("_place", F.xxhash64(*spec.FEATURES, label))
    encoded = encoder.transform(dealt).select("_place", label, *keep, "features")
    encoded = encoded.repartition(partitions, "_place").sortWithinPartitions("_place").drop("_place")
    encoded = encoded.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield Prepared(encoder, classifier, encoded, partitions, label)
    finally:
        encoded.unpersist()


def train(df: DataFrame, stages: Pipeline | None = None, label: str = spec.LABEL, partitions: int | None = None) -> PipelineModel:
    """Fit on class-weighted rows (``prepared``)."""
    with prepared(df, stages, label, partitions=partitions) as ready:
        return ready.pipeline(ready.fit())


def predict(model: PipelineModel, df: DataFrame, probability: str = "probability") -> DataFrame:
    """Add the class 1 probability and the class. A narrow stage for any number of records."""
    out = model.transform(df).withColumn("_p", vector_to_array("probability")[1])
    return out.select(*df.columns, F.col("_p").alias(probability), F.col("prediction").cast("int").alias("prediction"))


def encoded_names(model: PipelineModel) -> list[str]:
    """Names of the encoded features, in vector order."""
    indexer = next(s for s in model.stages if hasattr(s, "labelsArray"))
    levels = [f"{c}_{level}" for c, values in zip(spec.CATEGORICAL_FEATURES, indexer.labelsArray, strict=True) for level in values]
    return [*spec.NUMERIC_FEATURES, *levels]


def encode(model: PipelineModel, df: DataFrame, key: str = spec.KEY) -> DataFrame:
    """Key and encoded feature array per record."""
    encoder = PipelineModel(model.stages[:-1])
    return encoder.transform(df).select(key, vector_to_array("features").alias("x"))


def importances(spark: SparkSession, model: PipelineModel, k: int = 20) -> DataFrame:
    """Top features by impurity importance."""
    values = [float(v) for v in model.stages[-1].featureImportances.toArray()]
    one = spark.createDataFrame([(values,)], "v array<double>")
    rows = aligned(encoded_names(model), F.col("v"), one)
    return rows.select("feature", F.col("x").alias("importance")).orderBy(F.desc("importance"), "feature").limit(k)


def fold_models(
    df: DataFrame, stages: Pipeline, fold: str = "fold", label: str = spec.LABEL, parallelism: int = 3
) -> dict[int, PipelineModel]:
    """A model for each held-out fold, fitted on the other folds. All are fitted on one encoded
    table; classes are weighted by the rows of each fit. Encoding does not see labels, and what it
    learns from a held-out row (levels no other row has, scale) changes no split of the others."""
    with prepared(df, stages, label, keep=[fold]) as ready:
        numbers = sorted(r[0] for r in ready.rows.select(fold).distinct().collect())
        fit = inheritable_thread_target(df.sparkSession)(lambda number: ready.fit(F.col(fold) != number))
        with ThreadPoolExecutor(parallelism) as pool:
            return {number: ready.pipeline(model) for number, model in zip(numbers, pool.map(fit, numbers))}


def held_out_scores(
    df: DataFrame, models: dict[int, PipelineModel], fold: str = "fold", label: str = spec.LABEL, keep: Sequence[str] = ()
) -> DataFrame:
    """fold, label and score of every row, by the model that has not seen its fold."""
    parts = [
        predict(model, df.filter(F.col(fold) == number), "score").select(*keep, F.lit(number).alias("fold"), label, "score")
        for number, model in models.items()
    ]
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    return scored


def cross_validate(df: DataFrame, stages: Pipeline, fold: str = "fold", label: str = spec.LABEL) -> DataFrame:
    """ROC-AUC per held-out fold."""
    return evaluation.roc_auc(held_out_scores(df, fold_models(df, stages, fold, label), fold, label), label, by=["fold"])


def node_table(spark: SparkSession, model_path: str) -> DataFrame:
    """Nodes of a saved forest: tree and id in one number, those of its children (a leaf leads to
    itself), feature, threshold, and the class 1 share of its training weight."""
    node = F.col("nodeData")
    number = lambda i: F.shiftleft(F.col("treeID").cast("long"), 32) + i
    leaf = node["leftChild"] < 0
    split, stats = node["split"], node["impurityStats"]
    # a 0/1 feature splits by category: 0 goes left, or 1 does
    by_category = split["numCategories"] != -1
    first = F.get(split["leftCategoriesOrThreshold"], 0)
    left, right = number(node["leftChild"]), number(node["rightChild"])
    turned = by_category & (first == 1.0)
    return spark.read.parquet(f"{model_path}/stages/*_RandomForestClassifier_*/data").select(
        number(node["id"]).alias("node"),
        F.when(leaf, number(node["id"])).when(turned, right).otherwise(left).alias("below"),
        F.when(leaf, number(node["id"])).when(turned, left).otherwise(right).alias("above"),
        F.when(leaf, 0).otherwise(split["featureIndex"]).alias("feature"),
        F.when(by_category, F.lit(0.5)).otherwise(first).alias("threshold"),
        F.try_divide(F.get(stats, 1), F.aggregate(stats, F.lit(0.0), lambda a, b: a + b)).alias("share"),
    )


def walk(encoded: DataFrame, nodes: DataFrame, trees: int, depth: int, key: str = spec.KEY) -> DataFrame:
    """key and class 1 probability (``walked``) of each record, from the node table alone: a join
    for each level, then the mean share of the leaves. Spark broadcasts the nodes if they are few."""
    steps = encoded.select(key, "x", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("t"))
    steps = steps.select(key, "x", F.shiftleft(F.col("t").cast("long"), 32).alias("at"))
    inner = nodes.select("node", "below", "above", "feature", "threshold")  # one broadcast serves all levels
    for _ in range(depth):
        joined = steps.join(inner, F.col("at") == F.col("node"))
        value = F.col("x")[F.col("feature")]
        steps = joined.select(key, "x", F.when(value <= F.col("threshold"), F.col("below")).otherwise(F.col("above")).alias("at"))
    leaves = nodes.select("node", "share")
    return steps.join(leaves, F.col("at") == F.col("node")).groupBy(key).agg(F.avg("share").alias("walked"))


def cv_summary(scores: DataFrame) -> DataFrame:
    """Each fold's score with the mean and population deviation over the folds."""
    whole = Window.partitionBy()
    return scores.select(
        "fold",
        round_away("roc_auc", 4).alias("roc_auc"),
        round_away(F.avg("roc_auc").over(whole), 4).alias("mean_roc_auc"),
        round_away(F.stddev_pop("roc_auc").over(whole), 4).alias("sd_roc_auc"),
    )


def levels(df: DataFrame, numeric=spec.NUMERIC_FEATURES, categorical=spec.CATEGORICAL_FEATURES) -> DataFrame:
    """Encoded features in vector order: numeric columns, then each column's sorted values."""
    entries = [F.struct(F.lit(i).alias("column_no"), F.lit(c).alias("column_name"), F.col(c).alias("level")) for i, c in enumerate(categorical)]
    found = (
        df.select(F.inline(F.array(*entries)))
        .filter(F.col("level").isNotNull())
        .groupBy("column_no", "column_name", "level")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    named = found.select("column_no", "column_name", "level", F.concat_ws("_", "column_name", "level").alias("feature"))
    numbers = F.array(*[F.struct(F.lit(i - len(numeric)).alias("column_no"), F.lit(c).alias("column_name")) for i, c in enumerate(numeric)])
    plain = found.groupBy().agg(F.count(F.lit(1))).select(F.inline(numbers)).select(
        "column_no", "column_name", F.lit(None).cast("string").alias("level"), F.col("column_name").alias("feature")
    )
    place = F.row_number().over(Window.orderBy("column_no", "level")) - 1
    return plain.unionByName(named).select(place.cast("bigint").alias("position"), "feature", "column_name", "level")


def scaled(df: DataFrame, fitted_on: DataFrame, columns=spec.NUMERIC_FEATURES, key: str = spec.KEY, digits: int = 6) -> DataFrame:
    """Numeric columns at mean 0 and population deviation 1 of the fitting rows."""
    moments = [F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("sd")).alias(c) for c in columns]
    fit = F.col("_fit")
    scale = lambda c: F.try_divide(F.col(c) - fit[c]["mean"], fit[c]["sd"])
    fitted = df.withColumn("_fit", fitted_on.agg(F.struct(*moments)).scalar())
    return fitted.select(key, *[round_away(scale(c), digits).alias(c) for c in columns])


def model_info(spark: SparkSession, model: PipelineModel | None, features=spec.FEATURES, version: str = spec.MODEL_VERSION) -> DataFrame:
    """One row: status, whether a model is loaded, its type, feature count and version."""
    loaded = model is not None
    kind = type(model.stages[-1]).__name__ if loaded else "not loaded"
    return spark.createDataFrame(
        [("ok" if loaded else "no model", loaded, kind, len(features) if loaded else 0, version)],
        "status string, model_loaded boolean, model_type string, feature_count int, version string",
    )

