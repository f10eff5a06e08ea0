"""Session settings and the shared scratch folder."""

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# What every query relies on at scale. A hot customer's partition may be split over tasks, also where
# the next operator would have liked the join's partitioning (it then shuffles its pre-aggregated
# rows). Stream state lives on disk and in the checkpoint, not on the heap.
QUERY_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Settings worth having on a cluster; none of them changes a result.
CLUSTER_CONF = QUERY_CONF | {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # Adaptive execution merges small partitions but does not split those of a distinct: begin with
    # about one per GB of the largest shuffled input (here for some 20 TB) and let it merge.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.parquet.compression.codec": "zstd",
}


def prepare(spark: SparkSession) -> None:
    """Apply the settings that the queries of this session rely on."""
    for key, value in QUERY_CONF.items():
        spark.conf.set(key, value)


@cache
def _local_dir(application: str) -> str:
    """The scratch folder of a local session, which goes with the process."""
    folder = tempfile.mkdtemp(prefix="run-")
    atexit.register(shutil.rmtree, folder, True)
    return folder


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path under the folder every executor can reach.

    The folder is the session's ``spark.checkpoint.dir``. A local session without one gets a
    temporary folder; a cluster session without one is an error, because a path on the driver's
    own disk cannot be read back by the executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_dir(spark.sparkContext.applicationId)
    return f"{base.rstrip('/')}/lakerisk/{name}-{uuid.uuid4().hex}"
