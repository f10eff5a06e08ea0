"""The layers as lazy frames over the given tables, and a stored copy of them."""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from lakerisk.functions.derive import add_raw_date_parts
from lakerisk.operators import deploy, layers, risk
from lakerisk.operators.rules import LAB
from lakerisk.plans.incremental import incremental_gold, read_base, silver_table
from lakerisk.plans.paths import LakePaths
from lakerisk.schemas import BRONZE_COLUMNS, BRONZE_SCHEMA, SILVER_COLUMNS
from lakerisk.sources.files import read_layer, write_csv, write_layer, write_raw_partitioned
from lakerisk.sources.tables import (
    customers_from_table,
    read_customer,
    read_events,
    transactions_from_events,
)
from lakerisk.sources.versions import VersionedTable

FULL = "full"  # the batch that a full run stores


class Lake:
    """Raw frames and the layers derived from them. Nothing runs until a result is asked for."""

    def __init__(self, raw: DataFrame, raw_customers: DataFrame, folder: str | None = None):
        self.spark = raw.sparkSession
        self.folder = folder
        self.raw = raw
        self.raw_customers = raw_customers

    @classmethod
    def from_tables(cls, spark: SparkSession, folder: str) -> "Lake":
        customer = read_customer(spark, folder)
        events = read_events(spark, folder)
        return cls(
            transactions_from_events(events, customer), customers_from_table(customer), folder)

    @cached_property
    def raw_parts(self) -> DataFrame:
        return add_raw_date_parts(self.raw)

    @cached_property
    def bronze(self) -> DataFrame:
        return layers.bronze_transactions(self.raw)

    @cached_property
    def bronze_lab(self) -> DataFrame:
        return layers.bronze_tx_lab(self.raw, LAB)

    @cached_property
    def customers(self) -> DataFrame:
        return layers.bronze_customers(self.raw_customers)

    @cached_property
    def silver(self) -> DataFrame:
        return layers.silver_transactions(self.bronze, self.customers)

    @cached_property
    def silver_lab(self) -> DataFrame:
        return layers.silver_transactions(self.bronze_lab, self.customers, attrs_from="customer")


def bronze_table(spark: SparkSession, paths: LakePaths) -> VersionedTable:
    return VersionedTable(spark, paths.layer("bronze", "transactions_by_month"), BRONZE_SCHEMA)


class StoredLake(Lake):
    """The layers read back from their stored Parquet, so queries prune columns at the scan.

    Bronze and Silver are the tables by month that incremental runs go on with.
    """

    def __init__(self, spark: SparkSession, paths: LakePaths):
        read = lambda layer, table: read_layer(spark, paths.layer(layer, table))
        super().__init__(read("raw", "transactions"), read("raw", "customers"))
        self.bronze = bronze_table(spark, paths).read().select(*BRONZE_COLUMNS)
        self.customers = read("bronze", "customers")
        self.silver = silver_table(spark, paths).read().select(*SILVER_COLUMNS)


def build_layers(lake: Lake, paths: LakePaths) -> StoredLake:
    """Write Raw, Bronze, Silver and Gold in turn, each from the stored layer before it.

    Silver is the first batch of the table that later batches are added to, and Gold comes from its additive base, so
    a full run and incremental runs end in the same tables.
    """
    spark = lake.spark
    write_layer(lake.raw, paths.layer("raw", "transactions"))
    write_layer(lake.raw_customers, paths.layer("raw", "customers"))
    raw = read_layer(spark, paths.layer("raw", "transactions"))
    write_raw_partitioned(add_raw_date_parts(raw), paths.layer("raw", "transactions_partitioned"))
    staged = Lake(raw, read_layer(spark, paths.layer("raw", "customers")))
    bronze_table(spark, paths).replace(FULL, staged.bronze)
    write_layer(staged.customers, paths.layer("bronze", "customers"))
    bronze = bronze_table(spark, paths).read().select(*BRONZE_COLUMNS)
    incremental_gold(paths, layers.silver_transactions(bronze, read_layer(spark, paths.layer("bronze", "customers"))), FULL)
    write_gold(spark, paths)
    return StoredLake(spark, paths)


def write_gold(spark: SparkSession, paths: LakePaths) -> None:
    """The four Gold tables, as Parquet and CSV, from the base that full and incremental runs keep."""
    base = read_base(spark, paths)
    for name, table in risk.GOLD_FROM_BASE.items():
        write_layer(table(base), paths.layer("gold", name))
        write_csv(read_layer(spark, paths.layer("gold", name)), paths.layer("output", name), single_file=True)


# The names of the exported tables.
ANALYSES = {
    "analise_segmento": risk.analysis_segment,
    "analise_canal": risk.analysis_channel,
    "analise_categoria": risk.analysis_category,
    "analise_temporal": risk.analysis_daily,
    "analise_periodo": risk.analysis_period,
    "analise_pergunta_negocio": risk.analysis_period_band,
    "analise_heatmap": risk.analysis_segment_band,
}
MODEL_TABLES = {
    "metricas_modelos": "metrics",
    "matriz_confusao_logistica": "confusion",
    "coeficientes_logistica": "coefficients",
    "importancias_random_forest": "importances",
}


def export_analyses(lake: Lake, paths: LakePaths) -> dict[str, DataFrame]:
    """The seven analyses and the indicators as CSV under ``output``; returns what was exported."""
    tables = {name: table(lake.silver) for name, table in ANALYSES.items()}
    return _exported(tables | {"kpis": risk.kpi_long(lake.raw, lake.silver)}, paths)


def export_models(lake: Lake, paths: LakePaths) -> dict[str, DataFrame]:
    """The four model tables as CSV under ``output``; both models are trained once."""
    trained = deploy.train_models(lake.silver)
    return _exported({name: trained[table] for name, table in MODEL_TABLES.items()}, paths)


def _exported(tables: dict[str, DataFrame], paths: LakePaths) -> dict[str, DataFrame]:
    for name, table in tables.items():
        write_csv(table, paths.layer("output", name), single_file=True)
    return tables
