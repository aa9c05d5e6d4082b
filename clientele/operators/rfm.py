"""Purchase histories: frequency, recency, age and mean value per customer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.config import DAYS_PER_PERIOD, check_frequency
from clientele.functions.dates import period_start
from clientele.functions.money import exact


def purchase_periods(train: DataFrame, frequency: str = "M",
                     observation_end: dt.date | None = None) -> DataFrame:
    """Per customer the number of periods with a purchase, the first and last, and the amounts.

    Orders of one period count as one purchase.  Rows after ``observation_end`` are left out.
    """
    period = period_start(F.col("order_date"), frequency)
    if observation_end is not None:
        train = train.where(period <= period_start(F.lit(observation_end), frequency))
    return (train.groupBy("userId", period.alias("period"))
            .agg(F.sum(exact(F.col("order_value"))).alias("amount"))
            .groupBy("userId")
            .agg(F.count(F.lit(1)).alias("periods"),
                 F.min("period").alias("first_period"),
                 F.max("period").alias("last_period"),
                 F.sum("amount").alias("revenue"),
                 F.min_by("amount", "period").alias("first_amount")))


def history(profiles: DataFrame, frequency: str = "M",
            observation_end: dt.date | None = None, unit: str = "mean") -> DataFrame:
    """Add frequency, recency, T and monetary_value to per-customer purchase periods.

    The first purchase is left out of frequency and of the mean value.  The
    observation ends with the latest period in the input unless given; finding it
    reads ``profiles`` a second time, so pass a written or cached frame then.
    ``unit='calendar'`` counts whole months instead of mean-length ones.
    """
    tag = check_frequency(frequency)
    if observation_end is None:
        end = profiles.agg(F.max("last_period")).scalar()
    else:
        end = period_start(F.lit(observation_end), tag)
    repeats = F.col("periods") - 1
    later = (F.col("revenue") - F.col("first_amount")).cast("double")
    return (profiles
            .withColumn("frequency", repeats.cast("double"))
            .withColumn("recency", _span(F.col("first_period"), F.col("last_period"), tag, unit))
            .withColumn("T", _span(F.col("first_period"), end, tag, unit))
            .withColumn("monetary_value",
                        F.coalesce(F.try_divide(later, repeats.cast("double")), F.lit(0.0))))


def _span(start: Column, end: Column, tag: str, unit: str) -> Column:
    if unit == "calendar" and tag == "M":
        return F.round(F.months_between(end, start)).cast("double")
    if unit not in ("mean", "calendar"):
        raise ValueError(f"unit must be mean or calendar, not {unit!r}")
    return F.date_diff(end, start) / F.lit(DAYS_PER_PERIOD[tag])


def rfm_summary(train: DataFrame, frequency: str = "M",
                observation_end: dt.date | None = None, unit: str = "mean") -> DataFrame:
    """(userId, frequency, recency, T, monetary_value) of every customer in the training rows."""
    periods = purchase_periods(train, frequency, observation_end)
    return (history(periods, frequency, observation_end, unit)
            .select("userId", "frequency", "recency", "T", "monetary_value"))


def repeat_buyers(rfm: DataFrame) -> DataFrame:
    """Customers the models can score: at least one repeat purchase of positive value."""
    return rfm.where((F.col("monetary_value") > 0) & (F.col("frequency") > 0))


def with_revenue(rfm: DataFrame, revenue: DataFrame) -> DataFrame:
    return rfm.join(revenue, "userId")
