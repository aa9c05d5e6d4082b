"""Join helpers for keys that may be very unevenly filled."""

from __future__ import annotations

from pyspark.sql import DataFrame


def semi_join(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys`` (distinct).

    Nothing is salted in advance: where a key turns out to be hot, AQE splits its rows by their measured
    size (``forceOptimizeSkewedJoin``) and repeats only that key's partition of the list.
    """
    return df.join(keys.select(*on), on, "left_semi")
