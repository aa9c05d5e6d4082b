"""Version selection on a change-captured table.

A key's version is the whole second of its change time.  The first (or last)
second is found by an aggregate, which combines on the map side, and joined back
on (key, second).  A window over the key would give the same rows but would pull
all versions of a hot key into one task; here its versions spread by second, and
what still piles up is an ordinary join that AQE can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The role of a ledger row is the sign of its amount.
ORDER, RETURN = 1, -1


def version_second(ts: str = "__ts_ms") -> Column:
    return F.unix_seconds(F.col(ts))


def pick_versions(df: DataFrame, key: str, which: str = "first",
                  ts: str = "__ts_ms", ties: str = "keep") -> DataFrame:
    """Rows of the first or last version of every key; NULL keys never match.

    ``ties='keep'`` returns all rows of that second, ``'one'`` a single row.
    """
    if which not in ("first", "last"):
        raise ValueError(f"which must be first or last, not {which!r}")
    keyed = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    if ties == "one":
        row = F.struct(*df.columns)
        order = F.struct(version_second(ts), F.col(ts), *df.columns)
        chosen = F.min_by(row, order) if which == "first" else F.max_by(row, order)
        return (keyed.groupBy(F.col(key).alias("_key")).agg(chosen.alias("_row"))
                .select("_row.*"))
    if ties != "keep":
        raise ValueError(f"ties must be keep or one, not {ties!r}")
    bound = F.min if which == "first" else F.max
    wanted = (keyed.groupBy(F.col(key).alias("_key"))
              .agg(bound(version_second(ts)).alias("_second")))
    return (df.join(wanted, (F.col(key) == F.col("_key"))
                    & (version_second(ts) == F.col("_second")))
            .select(*df.columns))


def version_bounds(df: DataFrame, key: str, ts: str = "__ts_ms") -> DataFrame:
    """Per key the second of its first version, which orders want, and of its last, which returns want.

    One pass over the table serves both roles.  A join on the key alone takes these rows where they are:
    they are not shuffled again, and the versions of a key stream past the one row of its bounds.
    """
    return (df.where(F.col(key).isNotNull())
            .groupBy(F.col(key).alias("_key"))
            .agg(F.min(version_second(ts)).alias("_first"),
                 F.max(version_second(ts)).alias("_last")))
