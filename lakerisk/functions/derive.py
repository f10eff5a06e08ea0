"""Derived columns: date parts, day periods, amount bands, tenure cohorts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakerisk.schemas import COHORT_NEW, COHORT_OLD


def add_raw_date_parts(raw: DataFrame) -> DataFrame:
    """Raw plus the year, month and day of its timestamp."""
    ts = F.col("timestamp")
    return raw.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})


def date_parts(ts: Column, dow_base: int = 0) -> dict[str, Column]:
    """Calendar columns of ``ts``; Sunday is weekday ``dow_base``."""
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "day_of_week": F.dayofweek(ts) - F.lit(1 - dow_base),
        "hour": F.hour(ts),
    }


def add_date_parts(df: DataFrame, ts: str = "ts", dow_base: int = 0) -> DataFrame:
    return df.withColumns(date_parts(F.col(ts), dow_base))


def add_iso_weekday(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Year as text and the ISO weekday (Monday 1 .. Sunday 7), as older date formatting gave them."""
    return df.withColumns({
        "year_text": F.date_format(ts, "yyyy"),
        "iso_weekday": F.weekday(ts) + 1,
    })


def time_period(hour: Column) -> Column:
    return (
        F.when(hour.between(6, 11), "manha")
        .when(hour.between(12, 17), "tarde")
        .when(hour.between(18, 23), "noite")
        .otherwise("madrugada")
    )


def amount_band(amount: Column, cuts: tuple[float, float] = (100, 1000)) -> Column:
    low, high = cuts
    return F.when(amount < low, "baixo").when(amount < high, "medio").otherwise("alto")


def cohort(created_at: Column, as_of: Column, days: int = 365) -> Column:
    """Customers older than ``days`` on ``as_of``; an unknown creation date counts as new."""
    return F.when(F.datediff(as_of, created_at) > days, COHORT_OLD).otherwise(COHORT_NEW)


def normalize_bool(text: Column) -> Column:
    """Text such as ``True``/``False`` to a boolean; anything but true is false, NULL stays NULL."""
    return F.lower(F.trim(text)) == "true"


def utc_instant(ts: str) -> Column:
    """The zoned timestamp of a zoneless one read as UTC, whatever the session's zone."""
    return F.expr(
        f"make_timestamp(year({ts}), month({ts}), day({ts}), hour({ts}), minute({ts}), "
        f"extract(SECOND FROM {ts}), 'UTC')")


def utc_wall_clock(instant: str) -> Column:
    """The zoneless UTC time of a zoned timestamp, whatever the session's zone."""
    seconds = f"CAST(unix_micros({instant}) AS DECIMAL(18,0)) / 1000000"
    return F.expr(f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds})")
