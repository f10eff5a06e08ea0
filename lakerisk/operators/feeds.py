"""Tables behind the dashboard's blocks: indicators, series with labels, heat map, detail."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakerisk.functions.measures import fraud_rate_pct
from lakerisk.operators import risk


def _labelled(table: DataFrame) -> DataFrame:
    """Add the rate as display text, such as ``2.50%``."""
    return table.withColumn("rotulo", F.format_string("%.2f%%", F.col("taxa_fraude_pct")))


def feed_kpis(raw: DataFrame, silver: DataFrame) -> DataFrame:
    return risk.kpi_long(raw, silver)


def feed_channel(silver: DataFrame) -> DataFrame:
    return _labelled(risk.analysis_channel(silver))


def feed_period(silver: DataFrame) -> DataFrame:
    return _labelled(risk.analysis_period(silver))


def feed_category(silver: DataFrame) -> DataFrame:
    return _labelled(risk.analysis_category(silver))


def feed_segment(silver: DataFrame) -> DataFrame:
    return _labelled(risk.analysis_segment(silver))


def feed_heatmap(silver: DataFrame) -> DataFrame:
    return risk.pivot_band_segment(silver)


def feed_trend(silver: DataFrame) -> DataFrame:
    return risk.analysis_daily(silver).select("dia", "fraudes")


def feed_gold_panel(gold: DataFrame) -> DataFrame:
    """The four blocks of the Gold panel as (bloco, segment, metrica, valor) rows.

    Totals and details come from one pass over Gold: one group per segment and one for all.
    """
    columns = [c for c in gold.columns if c != "segment"]
    segment = F.col("segment")
    grouped = gold.groupingSets([[segment], []], segment).agg(
        F.grouping("segment").alias("everything"),
        F.sum("total_transacoes").alias("total"), F.sum("qtd_fraudes").alias("fraudes"),
        *[F.max(c).alias(c) for c in columns])

    def row(block: str, metric: str, value: Column) -> Column:
        return F.struct(
            F.lit(block).alias("bloco"), segment.alias("segment"), F.lit(metric).alias("metrica"),
            value.cast("double").alias("valor"))

    totals = F.array(
        row("kpi", "total_transacoes", F.col("total")),
        row("kpi", "taxa_geral", fraud_rate_pct(F.col("fraudes"), F.col("total"))))
    details = F.array(
        row("composicao", "taxa_fraude_pct", F.col("taxa_fraude_pct")),
        *[row("detalhe", c, F.col(c)) for c in columns])
    blocks = F.when(F.col("everything") == 1, totals).otherwise(details)
    return grouped.select(F.inline(blocks))


def feed_segment_filter(silver: DataFrame, segments: list[str]) -> DataFrame:
    """The segment panel restricted to the chosen segments."""
    return risk.gold_fraud_risk(silver.filter(F.col("segment").isin(segments)))
