"""Session helpers: building a session, the shared scratch folder, lineage cuts.

Everything that is written by an operator (baseline files, run logs, models,
stream sinks) goes under the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (unit tests on a
laptop) do we create a local folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "tabwatch",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session or build one with sane analytics defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only if none is configured."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions have no SparkContext
        if not conf_dir:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        conf_dir = tempfile.mkdtemp(prefix="tabwatch-ckpt-")   # one machine, as in tests
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def shared_root(spark: SparkSession) -> str:
    """Base folder for tables written by operators (shared by all executors)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = os.path.dirname(ensure_checkpoint_dir(spark).rstrip("/"))
    return base.rstrip("/") + "/tabwatch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Cut lineage by writing a written table in the shared folder and
    reading it back: computed exactly once, identical on every later read,
    and it survives the loss of the executors that computed it.  Used for
    small intermediate tables that are read more than once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _sql_lit(v, dtype) -> str:
    from pyspark.sql import types as T

    from tabwatch.functions.search import sql_double
    if v is None:
        return f"CAST(NULL AS {dtype.simpleString()})"
    if isinstance(dtype, T.StringType):
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(dtype, T.BooleanType):
        return "TRUE" if v else "FALSE"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return sql_double(float(v))
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return f"CAST({int(v)} AS {dtype.simpleString()})"
    if isinstance(dtype, T.ArrayType):
        if len(v) == 0:
            return f"CAST(array() AS {dtype.simpleString()})"
        return f"CAST(array({', '.join(_sql_lit(x, dtype.elementType) for x in v)}) AS {dtype.simpleString()})"
    raise TypeError(f"unsupported literal type {dtype}")


def local_frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small table of configuration-sized rows as an inline (local) relation.

    Unlike ``createDataFrame`` on a list (a parallelized RDD), the result is
    planned as a local table scan: reading or collecting it runs no job, its
    size is known to the optimizer, and joins against it broadcast it.
    """
    from pyspark.sql import types as T
    st = T._parse_datatype_string(schema)
    names = [f.name for f in st.fields]
    rows = list(rows)
    cols = ", ".join(f"`{n}`" for n in names)
    if not rows:
        sel = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in st.fields)
        return spark.sql(f"SELECT {sel} WHERE FALSE")
    vals = ", ".join("(" + ", ".join(_sql_lit(v, f.dataType) for v, f in zip(r, st.fields)) + ")"
                     for r in rows)
    df = spark.sql(f"SELECT * FROM VALUES {vals} AS t({cols})")
    return df.select(*[df[f"`{f.name}`"].cast(f.dataType).alias(f.name) for f in st.fields])
