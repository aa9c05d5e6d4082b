"""Value and risk segments of the scored base, and the merge of fresh scores into it."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.labels import churn_segment, clv_segment, without_nan
from clientele.schemas import PREDICTION
from clientele.session import written

COLUMNS = PREDICTION.fieldNames()
CUTS = (0.25, 0.5, 0.75)
#: Values that a quantile sketch keeps at each of its levels.
SKETCH_SIZE = 4096


# Rows between the bounds of a percentile from which they are simply sorted.
_SORTED = 1_000


def exact_percentiles(df: DataFrame, column: Column, shares: Sequence[float]) -> list[float | None]:
    """For each share the smallest value with at least that share of the values up to it.

    NULLs do not count; without values the result is NULL.  A sketch proposes two bounds close
    to each value, one pass counts what lies below, on and between them, and so on inside until few
    rows are left or the value itself was proposed.  Every pass is one aggregate; no rows are
    moved, and at most ``_SORTED`` values for each share reach the driver.
    """
    values = df.select(column.alias("v")).where("v IS NOT NULL")
    total = values.count()
    if not total:
        return [None] * len(shares)
    found: list[float | None] = [None] * len(shares)
    # Per open share: its rank, the open interval it lies in, the rows up to the interval and in it.
    open_shares = {i: [max(1, math.ceil(round(s * total, 6))), -math.inf, math.inf, 0, total]
                   for i, s in enumerate(shares)}
    while open_shares:
        small = {i: o for i, o in open_shares.items() if o[4] <= _SORTED}
        if small:
            lists = values.agg(*[F.sort_array(F.collect_list(F.when(_inside(o), F.col("v")))).alias(str(i))
                                 for i, o in small.items()]).first()
            for i, (rank, _, _, below, _) in small.items():
                found[i] = lists[str(i)][rank - below - 1]
                del open_shares[i]
            continue
        guesses = values.agg(*[F.approx_percentile(
            F.when(_inside(o), F.col("v")),
            F.array(*[F.lit(min(1.0, max(0.0, (o[0] - o[3]) / o[4] + d))) for d in (-0.001, 0.0, 0.001)]),
            F.lit(10_000)).alias(str(i)) for i, o in open_shares.items()]).first()
        points = {i: sorted(set(guesses[str(i)])) for i in open_shares}
        counts = values.agg(*[F.count_if(test).alias(f"{i}_{k}_{name}")
                              for i, p in points.items() for k, x in enumerate(p)
                              for name, test in (("less", F.col("v") < x), ("most", F.col("v") <= x))]).first()
        for i, p in points.items():
            rank, low, high, below, inside = open_shares[i]
            upto = below + inside
            for k, x in enumerate(p):
                less, most = counts[f"{i}_{k}_less"], counts[f"{i}_{k}_most"]
                if less < rank <= most:
                    found[i] = x
                    del open_shares[i]
                    break
                if most < rank:
                    low, below = x, most
                else:
                    high, upto = x, less
                    break
            if i in open_shares:
                open_shares[i] = [rank, low, high, below, upto - below]
    return found


def _inside(bounds: list) -> Column:
    _, low, high, _, _ = bounds
    inside = F.lit(True)
    if low > -math.inf:
        inside = inside & (F.col("v") > low)
    if high < math.inf:
        inside = inside & (F.col("v") < high)
    return inside


def value_sketch(predictions: DataFrame) -> DataFrame:
    """One row with a quantile sketch of the values (``sketch``), mergeable with others; one pass."""
    return predictions.agg(sketch_of(F.col("clv")).alias("sketch"))


def sketch_of(value: Column) -> Column:
    return F.kll_sketch_agg_double(without_nan(value), F.lit(SKETCH_SIZE))


def sketched_percentiles(sketches: DataFrame, shares: Sequence[float]) -> list[float | None]:
    """Percentiles of everything that some sketches have seen, without reading it again.

    A share is off by about 1.33 / SKETCH_SIZE (99 % of the time); up to that many values it is exact.
    """
    merged = sketches.where("sketch IS NOT NULL").agg(
        F.kll_merge_agg_double("sketch", F.lit(SKETCH_SIZE)).alias("sketch"))
    known = merged.where(F.kll_sketch_get_n_double("sketch") > 0)
    row = known.select(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(s))) for s in shares]).first()
    return list(row) if row is not None else [None] * len(shares)


def clv_quantiles(predictions: DataFrame, buckets: int = 100, approximate: bool = False) -> DataFrame:
    """One row with the boundaries of equally filled buckets (minimum and maximum included).

    Exact, or by a sketch in one pass.
    """
    shares = [i / buckets for i in range(buckets + 1)]
    bounds = (sketched_percentiles(value_sketch(predictions), shares) if approximate
              else exact_percentiles(predictions, without_nan(F.col("clv")), shares))
    row = None if bounds[0] is None else bounds
    return predictions.sparkSession.createDataFrame([(row,)], "percentiles array<double>")


def clv_percentiles(predictions: DataFrame) -> DataFrame:
    """One row (p25, p50, p75)."""
    cuts = exact_percentiles(predictions, without_nan(F.col("clv")), CUTS)
    return predictions.sparkSession.createDataFrame([tuple(cuts)], "p25 double, p50 double, p75 double")


def segment(predictions: DataFrame, cuts: Sequence[float | None] | None = None) -> DataFrame:
    """Predictions with both segment labels; the cuts come from the predictions themselves unless given.

    Finding the cuts reads ``predictions`` a few times, so pass a written frame when it is costly.  The
    cuts are constants then, and the rows are labelled where they lie: no join.
    """
    if cuts is None:
        cuts = exact_percentiles(predictions, without_nan(F.col("clv")), CUTS)
    bounds = F.array(*[F.lit(c).cast("double") for c in cuts])
    return predictions.select(
        *COLUMNS,
        clv_segment(without_nan(F.col("clv")), bounds).alias("clv_segment"),
        churn_segment(without_nan(F.col("churn_probability")))
        .alias("churn_probability_segment"))


def kept_predictions(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing predictions of customers without a new one."""
    return existing.select(*COLUMNS).join(new.select("userId"), "userId", "left_anti")


def merged_predictions(existing: DataFrame, new: DataFrame) -> DataFrame:
    """New predictions and the kept ones, repeated rows once."""
    return new.select(*COLUMNS).unionByName(kept_predictions(existing, new)).distinct()


def merge_and_segment(existing: DataFrame, new: DataFrame) -> DataFrame:
    """The merged rows, written once, with labels."""
    return segment(written(merged_predictions(existing, new), "merged"))
