"""Fraud classifiers on Spark ML: features, split, models, evaluation and scoring."""

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakerisk.functions.measures import ratio, round_half_up, row_count
from lakerisk.session import shared_dir

# Model inputs, their order, and the row and model labels of the result tables.
CATEGORIES = {"segment": "segment_idx", "channel": "channel_idx", "merchant_category": "merchant_idx"}
NUMERIC = ["amount", "risk_score", "credit_score"]
FEATURES = NUMERIC + list(CATEGORIES.values())
LOGISTIC_NAME = "Regressão Logística"
FOREST_NAME = "Random Forest (numTrees=30)"
REAL_LABELS = ("Real 0 — não fraude", "Real 1 — fraude")
PREDICTED_LABELS = ("Predito 0", "Predito 1")
SEED = 42


def load_features(silver: DataFrame) -> DataFrame:
    """The six inputs and the flag; a Parquet scan below reads only these columns."""
    return silver.select(*NUMERIC, *CATEGORIES, "is_fraud")


def ml_input(silver: DataFrame) -> DataFrame:
    """Inputs with the transaction id (for the split) and a numeric label."""
    return silver.select(
        "transaction_id", *NUMERIC, *CATEGORIES, "is_fraud",
        F.col("is_fraud").cast("int").cast("double").alias("label"))


def fit_indexer(df: DataFrame) -> Model:
    """Category positions in alphabetical order of the values present."""
    return StringIndexer(
        inputCols=list(CATEGORIES), outputCols=list(CATEGORIES.values()),
        stringOrderType="alphabetAsc",
    ).fit(df)


def index_categories(df: DataFrame) -> DataFrame:
    """Add the index columns. The categories are taken from all rows, before any split."""
    indexed = fit_indexer(df).transform(df)
    # Without the nominal metadata the forest treats an index as the number it is.
    for name in CATEGORIES.values():
        indexed = indexed.withMetadata(name, {})
    return indexed


HASH_BITS = 60  # of the id's digest: fifteen hexadecimal digits
STEP_BITS = 12  # narrowed down per pass: a class's histogram has 4,096 rows


def _hashed(id_column: str, salt: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(salt)), F.col(id_column).cast("string")))


def _hash_bucket(id_column: str, salt: int) -> Column:
    """A number below 10000 that depends on nothing but the id and the salt."""
    return F.conv(F.substring(_hashed(id_column, salt), 1, 8), 16, 10).cast("bigint") % 10000


def exact_cuts(hashed: DataFrame, label: str, test_fraction: float) -> DataFrame:
    """Per class the hash of its ``round(test_fraction * rows)``-th row in the order of ``hash``: column ``cut``.

    The place is narrowed down by ``STEP_BITS`` a pass: counts per leading bits, of the rows that share the bits found
    before, tell in which piece it lies and how many rows of that piece are wanted. No pass sorts rows or gathers them.
    A class of no wanted rows has the cut -1.
    """
    spark = hashed.sparkSession
    wanted = {r[label]: round(test_fraction * r["n"]) for r in hashed.groupBy(label).agg(row_count().alias("n")).collect()}
    found = {value: 0 for value in wanted}  # the leading bits so far
    for left in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        path = F.shiftright("hash", left)
        inside = F.lit(False)
        for value, bits in found.items():
            inside = inside | (F.col(label).eqNullSafe(F.lit(value)) & (F.shiftright(path, STEP_BITS) == bits))
        counts = hashed.filter(inside).groupBy(label, path.alias("bits")).agg(row_count().alias("n")).orderBy("bits").collect()
        for value in found:
            rest = wanted[value]
            for row in (r for r in counts if r[label] == value):
                found[value] = row["bits"]
                if rest <= row["n"]:
                    break
                rest -= row["n"]
            wanted[value] = rest
    cuts = [(value, -1 if wanted[value] <= 0 else bits) for value, bits in found.items()]
    return spark.createDataFrame(cuts, f"`{label}` {dict(hashed.dtypes)[label]}, cut long")


def stratified_split(
    df: DataFrame, label: str = "is_fraud", test_fraction: float = 0.25, salt: int = SEED,
    id_column: str = "transaction_id", exact: bool = False,
) -> DataFrame:
    """Add ``is_test``. The share per class is close to ``test_fraction`` without any shuffle.

    A row's side depends on its id alone, so retried tasks and later runs agree. ``exact`` cuts each class at the
    hash of the row that makes the share exact; rows of one id, whose hash is the same, stay together.
    """
    if not exact:
        return df.withColumn("is_test", _hash_bucket(id_column, salt) < int(test_fraction * 10000))
    hashed = df.withColumn("hash", F.conv(F.substring(_hashed(id_column, salt), 1, HASH_BITS // 4), 16, 10).cast("bigint"))
    cuts = exact_cuts(hashed.select(label, "hash"), label, test_fraction).withColumnRenamed(label, "_class")
    # One row per class.
    return (
        hashed.join(F.broadcast(cuts), F.col(label).eqNullSafe(F.col("_class")))
        .withColumn("is_test", F.coalesce(F.col("hash") <= F.col("cut"), F.lit(False)))
        .drop("hash", "cut", "_class")
    )


def scaler_stats(train: DataFrame) -> DataFrame:
    """Mean and standard deviation of each input, in one pass over the training rows."""
    parts = [
        F.struct(
            F.lit(c).alias("feature"),
            F.avg(F.col(c).cast("double")).alias("mean"),
            F.stddev_samp(F.col(c).cast("double")).alias("std"))
        for c in FEATURES
    ]
    return train.agg(F.array(*parts).alias("stats")).select(F.inline("stats"))


def class_weights(train: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight per class: all rows over twice the class's rows."""
    counts = train.groupBy(label).agg(row_count().alias("rows"))
    total = counts.agg(F.sum("rows").alias("total")).scalar()
    return counts.withColumn("weight", ratio(total, 2 * F.col("rows")))


def add_balanced_weights(train: DataFrame, label: str = "label") -> DataFrame:
    # The weights hold one row per class.
    weights = class_weights(train, label).select(label, "weight")
    return train.join(F.broadcast(weights), label)


def assemble(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)


def fit_scaler(train: DataFrame) -> Model:
    """Standardisation fitted on training rows (``features`` to ``scaled``)."""
    return StandardScaler(
        inputCol="features", outputCol="scaled", withMean=True, withStd=True).fit(train)


def _without_summary(spark: SparkSession, model: PipelineModel) -> PipelineModel:
    """The fitted model without its training summary: stored in the shared folder and read back.

    The summary holds the session, and goes to the tasks with every row function of the model. A session that has observed
    a frame (``DataFrame.observe``) cannot be sent, so from then on no freshly fitted model could score.
    """
    path = shared_dir(spark, "fitted")
    model.save(path)
    return PipelineModel.load(path)


def fit_logistic(train: DataFrame) -> PipelineModel:
    """Scaler and L2 logistic regression on weighted, assembled training rows."""
    scaler = fit_scaler(train)
    rows = train.count()
    logistic = LogisticRegression(
        featuresCol="scaled", labelCol="label", weightCol="weight", maxIter=1000,
        regParam=1.0 / max(rows, 1), elasticNetParam=0.0, standardization=False)
    return _without_summary(train.sparkSession, PipelineModel([scaler, logistic.fit(scaler.transform(train))]))


def fit_forest(train: DataFrame, num_trees: int = 30, max_depth: int = 12) -> PipelineModel:
    """Random forest on the unscaled inputs. Spark grows trees to at most depth 30."""
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", numTrees=num_trees,
        maxDepth=max_depth, featureSubsetStrategy="sqrt", seed=SEED)
    return _without_summary(train.sparkSession, PipelineModel([forest.fit(train)]))


def score_transactions(assembled: DataFrame, model: PipelineModel) -> DataFrame:
    """Fraud probability of every row, with its id and label."""
    scored = model.transform(assembled)
    return scored.select(
        "transaction_id", "label", vector_to_array("probability")[1].alias("score"))


def review_queue(scored: DataFrame) -> DataFrame:
    """All scored rows, most suspicious first."""
    return scored.orderBy(F.desc("score"), "transaction_id")


def predict(scored: DataFrame, score: str = "score", threshold: float = 0.5) -> DataFrame:
    return scored.withColumn("predicted", (F.col(score) >= threshold).cast("int"))


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Exact area under the ROC curve, ties counted half, as one row.

    Rows collapse to one per score, and those are stored by score range with the number of their
    range. The running count of negatives then goes in two steps, over the ranges (one total each)
    and inside each range, so no task sees all scores.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_dir(spark, "scores")
    flag = F.col(label).cast("int")
    (
        df.filter(F.col(score).isNotNull() & flag.isNotNull())
        .groupBy(F.col(score).cast("double").alias("s"))
        .agg(F.sum(flag).alias("pos"), F.sum(1 - flag).alias("neg"))
        .repartitionByRange(ranges, "s")
        .withColumn("part", F.spark_partition_id())
        .write.parquet(path)
    )
    scores = spark.read.schema("s double, pos long, neg long, part int").parquet(path)
    below = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    offsets = scores.groupBy("part").agg(F.sum("neg").alias("part_neg")).select(
        "part", F.coalesce(F.sum("part_neg").over(below), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    negatives_below = (
        F.col("offset") + F.coalesce(F.sum("neg").over(inside), F.lit(0))).cast("double")
    pairs = scores.join(F.broadcast(offsets), "part").select(
        "pos", "neg", (F.col("pos") * (negatives_below + F.col("neg") / 2.0)).alias("won"))
    return pairs.agg(
        ratio(F.sum("won"), F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"))


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """2x2 counts. Both classes always have a row, also when nothing fell there."""
    def cell(real: int, said: int) -> Column:
        hit = (F.col(label).cast("int") == real) & (F.col(predicted).cast("int") == said)
        return F.count(F.when(hit, 1)).alias(PREDICTED_LABELS[said])

    rows = [
        F.struct(F.lit(REAL_LABELS[real]).alias("classe"), cell(real, 0), cell(real, 1))
        for real in (0, 1)
    ]
    return df.agg(F.array(*rows).alias("cells")).select(F.inline("cells"))


def threshold_sweep(
    df: DataFrame, score: str, label: str, thresholds: list[float]
) -> DataFrame:
    """Alerts, precision and recall at each threshold, in one pass over the rows.

    A row falls in the bucket of the highest threshold it reaches; the figures of a threshold then
    add up the buckets above it, of which there are no more than thresholds.
    """
    cuts = sorted(thresholds)
    reached = sum((F.col(score) >= t).cast("int") for t in cuts)
    buckets = df.filter(F.col(score).isNotNull()).groupBy(reached.alias("bucket")).agg(
        row_count().alias("n"), F.sum(F.col(label).cast("int")).alias("fraud"))
    whole = buckets.agg(
        F.collect_list(F.struct("bucket", "n", "fraud")).alias("buckets"),
        F.coalesce(F.sum("fraud"), F.lit(0)).alias("frauds"))
    at = whole.select(
        "buckets", "frauds", F.posexplode(F.array(*[F.lit(float(t)) for t in cuts]))
    ).select("frauds", F.col("col").alias("threshold"),
             F.filter("buckets", lambda b: b["bucket"] > F.col("pos")).alias("above"))

    def total(field: str) -> Column:
        return F.aggregate("above", F.lit(0).cast("bigint"), lambda acc, b: acc + b[field])

    return at.select("threshold", "frauds", total("n").alias("alerts"),
                     total("fraud").alias("hits")).select(
        "threshold", "alerts", "hits",
        round_half_up(ratio(F.col("hits"), F.col("alerts")), 6).alias("precision"),
        round_half_up(ratio(F.col("hits"), F.col("frauds")), 6).alias("recall"))


def _feature_table(spark: SparkSession, values, name: str) -> DataFrame:
    """One row per model input; six numbers."""
    rows = [(feature, float(value)) for feature, value in zip(FEATURES, values.toArray())]
    return spark.createDataFrame(rows, f"feature string, {name} double")


def coefficients(spark: SparkSession, logistic: PipelineModel) -> DataFrame:
    return _feature_table(spark, logistic.stages[-1].coefficients, "coefficient")


def importances(spark: SparkSession, forest: PipelineModel) -> DataFrame:
    return _feature_table(spark, forest.stages[-1].featureImportances, "importance")


def stored_inputs(silver: DataFrame) -> DataFrame:
    """Split model inputs, written once to the shared folder.

    Every pass of the indexer, the fits and the evaluations then reads a narrow table instead of
    deriving Silver again, and a lost executor costs a re-read.
    """
    spark = silver.sparkSession
    path = shared_dir(spark, "training")
    stratified_split(ml_input(silver)).write.parquet(path)
    return spark.read.parquet(path)


def training_table(silver: DataFrame) -> DataFrame:
    """Split, indexed and assembled rows."""
    return assemble(index_categories(stored_inputs(silver)))


def split_sides(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(weighted training rows, test rows)."""
    train = add_balanced_weights(table.filter(~F.col("is_test")))
    return train, table.filter("is_test")


def train_models(silver: DataFrame) -> dict[str, DataFrame]:
    """Fit both classifiers and return their metrics, confusion, coefficients and importances."""
    spark = silver.sparkSession
    train, test = split_sides(training_table(silver))
    logistic, forest = fit_logistic(train), fit_forest(train)
    by_logistic, by_forest = score_transactions(test, logistic), score_transactions(test, forest)
    metrics = [
        roc_auc(scored, "score", "label").select(F.lit(name).alias("modelo"), "auc")
        for name, scored in ((LOGISTIC_NAME, by_logistic), (FOREST_NAME, by_forest))
    ]
    return {
        "metrics": metrics[0].unionByName(metrics[1]),
        "confusion": confusion(predict(by_logistic), "label", "predicted"),
        "coefficients": coefficients(spark, logistic),
        "importances": importances(spark, forest),
    }


def feed_models(models: dict[str, DataFrame]) -> DataFrame:
    """The four model tables as (tabela, item, medida, valor) rows for one panel."""
    def rows(table: str, item: str, measures: list[str]) -> DataFrame:
        parts = F.array(*[
            F.struct(F.lit(m).alias("medida"), F.col(m).cast("double").alias("valor"))
            for m in measures])
        return models[table].select(
            F.lit(table).alias("tabela"), F.col(item).alias("item"), F.inline(parts))

    return (
        rows("metrics", "modelo", ["auc"])
        .unionByName(rows("confusion", "classe", list(PREDICTED_LABELS)))
        .unionByName(rows("coefficients", "feature", ["coefficient"]))
        .unionByName(rows("importances", "feature", ["importance"]))
    )
