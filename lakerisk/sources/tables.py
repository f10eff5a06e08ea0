"""Transactions and customers derived from the given ``events`` and ``customer`` tables.

The mapping is stateless apart from one join, so the same function serves a batch read and a
stream of events. Events are read once: the repeated copies come from an explode, not a union.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of the given tables, and how transactions and customers follow from them.
EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


CUSTOMER_TABLE_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()),
    T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()),
])

SEGMENT = """CASE c_mktsegment WHEN 'MACHINERY' THEN 'High-Risk' WHEN 'AUTOMOBILE' THEN 'Standard'
    ELSE 'Premium' END"""
CREDIT_SCORE = "300 + int(floor((c_acctbal + 1000) * 600 / 11000))"

# The first number in ``props``; NULL without one.
SCORE = "try_cast(regexp_extract(props, '([0-9]+)', 1) AS INT)"

EVENT_INPUTS = [
    "event_id", "user_id", "event_type", "ts", "floor(value * 100 + 0.5D) AS cents",
    f"{SCORE} AS k",
    "event_id % 10 AS tens", "floor(event_id / 10) % 20 AS block",
]

RAW_TRANSACTION = [
    "event_id AS transaction_id",
    """CASE WHEN event_id % 809 = 0 THEN NULL WHEN event_id % 1200 = 7 THEN user_id + 1000000
       ELSE user_id END AS customer_id""",
    "CASE WHEN event_id % 401 = 0 THEN -cents / 100D ELSE cents / 10D END AS amount",
    """CASE event_type WHEN 'purchase' THEN 'compra' WHEN 'signup' THEN 'saque'
       WHEN 'click' THEN 'transferencia' ELSE 'pagamento' END AS transaction_type""",
    """CASE WHEN tens < 4 THEN 'app' WHEN tens < 7 THEN 'web' WHEN tens < 9 THEN 'pos'
       ELSE 'atm' END AS channel""",
    """CASE WHEN block < 6 THEN 'varejo' WHEN block < 10 THEN 'alimentacao'
       WHEN block < 13 THEN 'eletronico' WHEN block < 16 THEN 'servicos'
       WHEN block < 18 THEN 'viagem' ELSE 'saude' END AS merchant_category""",
    "ts AS timestamp",
    """CASE WHEN event_id % 503 = 0 THEN 'pending' WHEN k % 12 = 0 THEN 'declined'
       ELSE 'approved' END AS status""",
    "double(CASE WHEN event_id % 601 = 0 THEN 150 ELSE k END) AS risk_score",
    "CASE WHEN k = 13 THEN 'Standard' ELSE owner_segment END AS segment",
    """CASE WHEN event_id % 701 = 0 THEN 950 WHEN owner_score IS NULL THEN NULL ELSE greatest(300, owner_score - k % 5) END
       AS credit_score""",
    """k >= 99 OR (owner_segment = 'High-Risk' AND k >= 94) OR (tens < 4 AND k = 50)
       OR (block IN (16, 17) AND k BETWEEN 60 AND 62) AS is_fraud""",
]

RAW_CUSTOMER = [
    "c_custkey AS customer_id",
    "c_name AS name",
    "lpad(string(c_custkey), 11, '0') AS cpf",
    "concat('user', string(c_custkey), '@example.com') AS email",
    f"{SEGMENT} AS segment",
    f"CASE WHEN c_custkey % 97 = 5 THEN 950 ELSE {CREDIT_SCORE} END AS credit_score",
    "date_add(DATE '2021-01-01', int(c_custkey * 7 % 1460)) AS created_at",
]


def _repeated(df: DataFrame, twice: str) -> DataFrame:
    """One output row, or two where ``twice`` holds."""
    copies = f"explode(CASE WHEN {twice} THEN array(1, 2) ELSE array(1) END) AS copy"
    return df.selectExpr("*", copies).drop("copy")


def transactions_from_events(events: DataFrame, customer: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """Raw transactions, with the defects the quality rules look for, and ``more`` columns of the events as they are."""
    owner = customer.selectExpr(
        "c_custkey AS user_id", f"{SEGMENT} AS owner_segment", f"{CREDIT_SCORE} AS owner_score")
    joined = events.selectExpr(*EVENT_INPUTS, *more).join(owner, "user_id", "left")  # the rules judge missing owners
    return _repeated(joined.selectExpr(*RAW_TRANSACTION, *more), "transaction_id % 250 = 3")


def customers_from_table(customer: DataFrame) -> DataFrame:
    return _repeated(customer.selectExpr(*RAW_CUSTOMER), "customer_id % 100 = 1")


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{folder}/events.parquet")


def read_customer(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(CUSTOMER_TABLE_SCHEMA).parquet(f"{folder}/customer.parquet")


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a file stream, with the time each file arrived; the glob matches a single file as well as a directory."""
    events = spark.readStream.schema(EVENTS_SCHEMA).parquet(f"{folder}/events.parquet*")
    return events.select("*", F.col("_metadata.file_modification_time").alias("arrived"))
