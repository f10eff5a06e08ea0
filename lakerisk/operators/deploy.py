"""One fitted model for batch and stream: from the columns of Silver to a fraud probability.

The indexer is part of the model, fitted once on all training inputs, so a row gets the same inputs and the same
score whatever rows come with it; a category that the model has not seen gets the position behind the known ones.
Models are stored by name and version and read back by any session.
"""

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.operators import ml
from lakerisk.session import shared_dir

KINDS = {"logistic": ml.LOGISTIC_NAME, "forest": ml.FOREST_NAME}
PROBABILITY = "probability_of_fraud"


def fit(inputs: DataFrame, kind: str) -> PipelineModel:
    """Indexer, assembler and classifier fitted on ``ml.stored_inputs``: categories on all rows, the rest on training rows."""
    positions = [f"{c}_position" for c in ml.CATEGORIES]
    indexer = StringIndexer(
        inputCols=list(ml.CATEGORIES), outputCols=positions, stringOrderType="alphabetAsc", handleInvalid="keep").fit(inputs)
    # Plain numbers without the indexer's labels: the forest then splits a position as the number it is.
    plain = ", ".join(f"{p} + 0.0D AS {name}" for p, name in zip(positions, ml.CATEGORIES.values()))
    numbers = SQLTransformer(statement=f"SELECT *, {plain} FROM __THIS__")
    assembler = VectorAssembler(inputCols=ml.FEATURES, outputCol="features", handleInvalid="keep")
    front = PipelineModel([indexer, numbers, assembler])
    train = ml.add_balanced_weights(inputs.filter(~F.col("is_test")))
    model = (ml.fit_logistic if kind == "logistic" else ml.fit_forest)(front.transform(train))
    return PipelineModel([*front.stages, *model.stages])


def save(model: PipelineModel, folder: str, version: int) -> str:
    """Store a version; one that is there already is never replaced."""
    path = f"{folder}/version={version}"
    model.save(path)
    return path


def load(spark: SparkSession, folder: str, version: int | None = None) -> PipelineModel:
    """The given version, or the newest one."""
    if version is None:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(place)
        version = max(int(s.getPath().getName().split("=")[1]) for s in found if s.getPath().getName().startswith("version="))
    return PipelineModel.load(f"{folder}/version={version}")


def scored(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """The rows with their ``probability_of_fraud``; no probability where an input is missing."""
    kept = [c for c in rows.columns if c != PROBABILITY]
    known = F.expr(" AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in ml.NUMERIC))
    return model.transform(rows).select(*kept, F.when(known, vector_to_array("probability")[1]).alias(PROBABILITY))


def score_sides(silver: DataFrame) -> tuple[dict[str, PipelineModel], DataFrame, DataFrame]:
    """Both models, trained once; the inputs; and the test rows' scores ``logistic`` and ``forest``, computed once and stored."""
    inputs = ml.stored_inputs(silver)
    models = {kind: fit(inputs, kind) for kind in KINDS}
    rows = inputs.filter("is_test").select("transaction_id", "label", *ml.NUMERIC, *ml.CATEGORIES)
    for kind, model in models.items():
        rows = scored(rows, model).withColumnRenamed(PROBABILITY, kind)
    path = shared_dir(silver.sparkSession, "test-scores")
    rows.select("transaction_id", "label", *KINDS).write.parquet(path)
    return models, inputs, silver.sparkSession.read.schema("transaction_id long, label double, logistic double, forest double").parquet(path)


def train_models(silver: DataFrame) -> dict[str, DataFrame]:
    """Metrics, confusion, coefficients and importances of both classifiers."""
    spark = silver.sparkSession
    models, _, scores = score_sides(silver)
    metrics = [ml.roc_auc(scores, kind, "label").select(F.lit(name).alias("modelo"), "auc") for kind, name in KINDS.items()]
    return {
        "metrics": metrics[0].unionByName(metrics[1]),
        "confusion": ml.confusion(ml.predict(scores, "logistic"), "label", "predicted"),
        "coefficients": ml.coefficients(spark, models["logistic"]),
        "importances": ml.importances(spark, models["forest"]),
    }


def gradient(train: DataFrame, logistic: PipelineModel) -> DataFrame:
    """The derivative of the training loss by each coefficient and the constant: all near 0 at the optimum."""
    last = logistic.stages[-1]
    weighted = ml.add_balanced_weights(train)
    rows = logistic.transform(weighted).select(
        "weight", (vector_to_array("probability")[1] - F.col("label")).alias("off"), vector_to_array("scaled").alias("x"))
    total = F.sum("weight")
    names = [*ml.FEATURES, "intercept"]
    reg = last.getRegParam()
    parts = [F.sum(F.col("weight") * F.col("off") * F.col("x")[i]) / total + reg * float(b) for i, b in enumerate(last.coefficients)]
    parts.append(F.sum(F.col("weight") * F.col("off")) / total)
    return rows.agg(F.array(*[F.struct(F.lit(n).alias("feature"), p.alias("gradient")) for n, p in zip(names, parts)]).alias("all")).select(F.inline("all"))
