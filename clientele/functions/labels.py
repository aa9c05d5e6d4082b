"""Segment labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and cut points of the published segments.
LOWEST, LOW_MEDIUM, HIGH_MEDIUM, TOP = (
    "Lowest 25% Customers", "Low Medium Value", "High Medium Value", "Top 25% Customers")
LOW_RISK, MEDIUM_RISK, HIGH_RISK = "Low Risk", "Medium Risk", "High Risk"
LOW_CUT, HIGH_CUT = 0.25, 0.70
NO_SEGMENT = ""


def without_nan(value: Column) -> Column:
    """NULL for NaN: Spark orders NaN above every number, so it would land in the top segment."""
    return F.nanvl(value, F.lit(None).cast("double"))


def clv_segment(clv: Column, cuts: Column) -> Column:
    """Value segment from the array (p25, p50, p75); a value on a border takes the lower label."""
    p25, p50, p75 = (F.get(cuts, F.lit(i)) for i in range(3))
    return (F.when(clv < p25, LOWEST)
            .when(clv.between(p25, p50), LOW_MEDIUM)
            .when(clv.between(p50, p75), HIGH_MEDIUM)
            .when(clv > p75, TOP)
            .otherwise(NO_SEGMENT))


def churn_segment(churn: Column) -> Column:
    """Risk segment; both cut points belong to the medium segment."""
    return (F.when(churn < LOW_CUT, LOW_RISK)
            .when(churn.between(LOW_CUT, HIGH_CUT), MEDIUM_RISK)
            .when(churn > HIGH_CUT, HIGH_RISK)
            .otherwise(NO_SEGMENT))
