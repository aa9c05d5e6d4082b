"""Compare registered queries with their SQL: ``python -m checks.compare SF_DIR [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.queries import ORACLES, QUERIES


def session(cpus: int = 8) -> SparkSession:
    return (SparkSession.builder.master(f"local[{cpus}]")
            .config("spark.sql.shuffle.partitions", str(cpus))
            .config("spark.driver.memory", "8g")
            .config("spark.ui.enabled", "false")
            # Recording the Python call site of every column costs more than planning.
            .config("spark.python.sql.dataFrameDebugging.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .getOrCreate())


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values in a common form, rows in a fixed order."""
    out = pd.DataFrame({c: df[c].map(_plain) for c in sorted(df.columns)})
    return out.sort_values(list(out.columns), ignore_index=True)


def _plain(value) -> str:
    if value is None or value is pd.NaT or value != value:
        return "NULL"
    if isinstance(value, str):
        return value
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).tz_localize(None).isoformat()
    return f"{float(value):.9g}" if not isinstance(value, bool) else str(value)


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str,
                sf_dir: str) -> str | None:
    """What is wrong with a query's result, or None when it equals its SQL's."""
    ours = canonical(QUERIES[name](spark, sf_dir).toPandas())
    if name not in ORACLES:
        return None if len(ours) else "no rows"
    theirs = canonical(con.execute(ORACLES[name]).df())
    if list(ours.columns) != list(theirs.columns):
        return f"columns {list(ours.columns)} and {list(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows and {len(theirs)}"
    unequal = (ours != theirs).any(axis=1)
    if unequal.any():
        return f"{unequal.sum()} rows differ, first\n{ours[unequal].head(2)}\n{theirs[unequal].head(2)}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    spark, con = session(), database(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = differences(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{name}: {problem or 'ok'} ({time.time() - start:.1f}s)", flush=True)
    print(f"{failed} of {len(names or QUERIES)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
