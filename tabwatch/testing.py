"""Test helpers: a local session, a DuckDB oracle connection, frame compare."""

from __future__ import annotations

import math
import os

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def spark_session(cores: int | str = "*", shuffle_partitions: int = 8):
    from pyspark.sql import SparkSession
    from tabwatch.session import ensure_checkpoint_dir
    spark = (SparkSession.builder.master(f"local[{cores}]")
             .appName("tabwatch-tests")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", os.environ.get("TABWATCH_TEST_TZ", "UTC"))
             .config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    try:
        import pandas as pd
        if v is pd.NaT or v is pd.NA:
            return None
    except Exception:  # noqa: BLE001
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:  # noqa: BLE001
            return v
    if isinstance(v, bool):
        return int(v)
    return v


def compare_frames(a, b):
    """Order-insensitive compare of two pandas frames (columns by name)."""
    ca, cb = sorted(a.columns), sorted(b.columns)
    if ca != cb:
        return False, f"columns differ: {ca} vs {cb}"
    if len(a) != len(b):
        return False, f"row count {len(a)} vs {len(b)}"
    ra = sorted((tuple(_norm(x) for x in r) for r in a[ca].itertuples(index=False)), key=repr)
    rb = sorted((tuple(_norm(x) for x in r) for r in b[cb].itertuples(index=False)), key=repr)
    for x, y in zip(ra, rb):
        if x != y:
            return False, f"first diff: {x} vs {y}"
    return True, ""


# Physical operators that must not appear in any registered query: row or
# Arrow Python evaluation in the hot path, and joins that pair every row
# with every row.
FORBIDDEN_PLAN_NODES = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                        "BroadcastNestedLoopJoin")


def plan_text(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def forbidden_nodes(df) -> list[str]:
    text = plan_text(df)
    return [n for n in FORBIDDEN_PLAN_NODES if n in text]
