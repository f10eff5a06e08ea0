"""What the operators of this subpackage share."""

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.session import shared_dir

ASCII_SPACE = " \t\n\x0b\x0c\r"


ROWS_PER_BATCH = 1000
BYTES_PER_BATCH = 16 << 20
HOME = str(Path(__file__).resolve().parents[2])


def ready(spark: SparkSession) -> SparkSession:
    """Python workers find this package where the driver found it; on a cluster it is installed there.

    Texts reach the workers in batches bounded by rows and by bytes, so many long ones at once do not fill them.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if HOME not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([HOME, *filter(None, paths)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_PER_BATCH)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, and survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def discard(df: DataFrame) -> None:
    """Remove a table that ``stored`` wrote, once nothing that is still to run reads it."""
    spark = df.sparkSession
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(key: str = "doc_id") -> Column:
    """Remainder by 3 of the CRC-32 of the id as text; rows of remainder 1 are held out."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 3


def held_out(key: str = "doc_id") -> Column:
    """True where a row must not be learned from. A row without an id counts as held out."""
    return F.coalesce(fold(key) == 1, F.lit(True))
