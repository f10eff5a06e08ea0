"""The stored model: equal scores alone and together, in batch and on a stream; unseen and missing inputs."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from lakerisk.operators import deploy, ml
from lakerisk.streaming import stream
from tests.test_incremental import same


@pytest.fixture(scope="module")
def inputs(lake):
    return ml.stored_inputs(lake.silver)


@pytest.fixture(scope="module", params=["logistic", "forest"])
def stored(request, spark, inputs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("models") / request.param)
    deploy.save(deploy.fit(inputs, request.param), folder, 1)
    deploy.save(deploy.fit(inputs, request.param), folder, 12)
    with pytest.raises(Py4JJavaError):
        deploy.save(deploy.load(spark, folder, 1), folder, 12)
    return deploy.load(spark, folder)


def test_a_part_is_scored_as_the_whole(inputs, stored):
    both = lambda rows: deploy.scored(rows, stored).select("transaction_id", "channel", deploy.PROBABILITY)
    whole = both(inputs)
    for channel in ("web", "atm"):
        same(both(inputs.filter(F.col("channel") == channel)), whole.filter(F.col("channel") == channel))
    assert whole.count() == inputs.count()


def test_unseen_and_missing_inputs(spark, lake, inputs, stored):
    row = lake.silver.limit(1)
    odd = row.withColumn("channel", F.lit("fax")).withColumn("segment", F.lit(None).cast("string"))
    assert 0 <= deploy.scored(odd, stored).first()[deploy.PROBABILITY] <= 1
    bare = row.withColumn("credit_score", F.lit(None).cast("int"))
    assert deploy.scored(bare, stored).first()[deploy.PROBABILITY] is None
    assert stream.stream_deployed_decision(bare, stored).first()["decisao"] == "review"


def test_stream_and_batch_agree(spark, lake, stored, scratch):
    lake.silver.repartition(3).write.parquet(scratch("in"))
    source = spark.readStream.schema(lake.silver.schema).parquet(scratch("in"))
    got = stream.run_available(stream.stream_deployed_decision(source, stored), spark, "t")
    same(got, stream.stream_deployed_decision(lake.silver, stored))


def test_same_tables_as_by_parts(spark, lake):
    """The deployable models are those that the single steps fit."""
    train, test = ml.split_sides(ml.training_table(lake.silver))
    whole = deploy.train_models(lake.silver)
    by_parts = ml.coefficients(spark, ml.fit_logistic(train)).collect()
    for a, b in zip(whole["coefficients"].collect(), by_parts):
        assert a["feature"] == b["feature"] and a["coefficient"] == pytest.approx(b["coefficient"], rel=1e-4, abs=1e-6)
    assert sum(r[1] + r[2] for r in whole["confusion"].collect()) == test.count()
