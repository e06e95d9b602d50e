"""Scoring with fitted pipelines: batch (inputs kept), records, and the
current production version from a version table."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.functions.search import quoted


#: Settings of a stage that name what it reads and what it adds.
_READ, _ADDED = ("inputCol", "inputCols", "featuresCol"), ("outputCol", "outputCols", "predictionCol", "probabilityCol", "rawPredictionCol")


def _named(stage, settings: tuple[str, ...]) -> list[str]:
    found = [stage.getOrDefault(s) for s in settings if stage.hasParam(s) and stage.isDefined(s)]
    return [c for x in found for c in ([x] if isinstance(x, str) else x)]


def added_columns(model: PipelineModel) -> list[str]:
    """The columns that the pipeline's stages add.  An input column of such a name is
    not the model's: no stage reads it before one adds it."""
    added: list[str] = []
    read: set[str] = set()
    for stage in model.stages:
        read.update(c for c in _named(stage, _READ) if c not in added)
        added += _named(stage, _ADDED)
    return [c for c in added if c not in read]


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def batch_score(model: PipelineModel, df: DataFrame, out_col: str = "prediction") -> DataFrame:
    """All input columns, with the caller's own values, plus an integer prediction.

    The row goes along as one column that no stage of the pipeline touches, since a
    stage may clean a column in place."""
    row = "_input"
    while row in df.columns:
        row = "_" + row
    bare = df.withColumn(row, F.struct(*(F.col(quoted(c)).alias(c) for c in df.columns))).drop(*added_columns(model))
    scored = model.transform(bare)
    kept = [F.col(f"{row}.{quoted(c)}").alias(c) for c in df.columns if c != out_col]
    return scored.select(*kept, F.col("prediction").cast("int").alias(out_col))


def production_model_path(versions: DataFrame, name: str, stage: str = "Production") -> str:
    """Path of the highest version of ``name`` in ``stage`` (one row comes back)."""
    row = (versions.where((F.col("name") == name) & (F.col("stage") == stage))
                   .orderBy(F.col("version").cast("bigint").desc()).select("path").first())
    if row is None:
        raise ValueError(f"no {stage} version of {name}")
    return row["path"]


def score_record(model: PipelineModel, spark, payload: dict, schema) -> int:
    """One record (a dict of raw fields) -> integer class.  Missing fields
    are null and take the pipeline's null handling (median fill, extra
    category slot).  A convenience: it runs a job per record; many records are a
    table for batch_score()."""
    from pyspark.sql import types as T
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    row = tuple(payload.get(f.name) for f in st.fields)
    df = spark.createDataFrame([row], st)
    return int(batch_score(model, df).first()["prediction"])
