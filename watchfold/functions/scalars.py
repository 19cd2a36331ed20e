"""Row-level expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchfold import settings as cfg


def hour_sin(hour: str | Column = "login_hour") -> Column:
    return F.sin(F.lit(2 * math.pi) * _c(hour) / F.lit(24.0))


def hour_cos(hour: str | Column = "login_hour") -> Column:
    return F.cos(F.lit(2 * math.pi) * _c(hour) / F.lit(24.0))


def is_weekend(ts: str | Column = "event_ts") -> Column:
    return F.weekday(_c(ts)).isin(5, 6).cast("int")


def micros(ts: str | Column = "event_ts") -> Column:
    """Microseconds since the epoch, for both timestamp flavours."""
    return F.unix_micros(_c(ts).cast("timestamp"))


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(6e7)


def clip(x: Column, limit: float = cfg.ZSCORE_LIMIT) -> Column:
    return F.least(F.lit(limit), F.greatest(F.lit(-limit), x))


def nonzero_std(std: Column) -> Column:
    """A spread usable as a divisor: missing and zero both count as 1."""
    return F.coalesce(F.nullif(std, F.lit(0.0)), F.lit(1.0))


def finite(x: Column) -> Column:
    """Missing, NaN and infinite values become 0."""
    d = x.cast("double")
    bad = F.isnan(d) | (F.abs(d) == F.lit(float("inf")))
    return F.coalesce(F.when(bad, F.lit(0.0)).otherwise(d), F.lit(0.0))


def parse_ts(text: str | Column, fmt: str | None = None) -> Column:
    """Lenient parse: anything unreadable becomes null."""
    if fmt is None:
        return F.try_to_timestamp(_c(text))
    return F.try_to_timestamp(_c(text), F.lit(fmt))


def truthy(x: Column) -> Column:
    return F.coalesce(F.lower(x.cast("string")).isin("true", "1", "1.0"), F.lit(False))


def is_failed(status: str | Column = "login_status") -> Column:
    return F.coalesce(_c(status) == F.lit("Failed"), F.lit(False)).cast("int")


def clean_browser(df: DataFrame) -> DataFrame:
    return df.withColumn("browser", F.coalesce("browser", F.lit(cfg.BROWSER_DEFAULT)))


def clamp_sessions(df: DataFrame) -> DataFrame:
    """Negative durations become 0; a missing one stays missing here."""
    s = F.col("session_duration_min")
    return df.withColumn("session_duration_min", F.when(s < 0, F.lit(0.0)).otherwise(s))


def fill_numeric(df: DataFrame) -> DataFrame:
    """Null -> 0 in every numeric column that is not a key."""
    names = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name != "event_id"
    ]
    return df.fillna(0, subset=names)


def calendar(df: DataFrame) -> DataFrame:
    """Cyclical hour, weekend flag, month and day of month."""
    new = {}
    if "login_hour" in df.columns:
        new |= {"hour_sin": hour_sin(), "hour_cos": hour_cos()}
    if "event_ts" in df.columns:
        new |= {
            "is_weekend": is_weekend(),
            "month": F.month("event_ts"),
            "day_of_month": F.dayofmonth("event_ts"),
        }
    return df.withColumns(new) if new else df


def title_words(name: Column) -> Column:
    """Underscores to blanks, each word (also after a hyphen) capitalised."""
    words = F.replace(name, F.lit("_"), F.lit(" "))
    by_hyphen = F.transform(F.split(words, "-"), lambda part: F.initcap(part))
    return F.array_join(by_hyphen, "-")


def human_name(feature: Column) -> Column:
    """Analyst-facing name of a feature (22 fixed names, else title case)."""
    pairs = [F.lit(v) for item in cfg.FEATURE_NAMES.items() for v in item]
    return F.coalesce(F.create_map(*pairs)[feature], title_words(feature))


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x
