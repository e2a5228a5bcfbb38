"""Model and run-record sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RUNS_SCHEMA = T.StructType([
    T.StructField("run_name", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("artifacts", T.MapType(T.StringType(), T.StringType())),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()),
])


def save_model(model: PipelineModel, path: str) -> str:
    """Save a fitted pipeline, replacing an older one at ``path``."""
    model.write().overwrite().save(path)
    return path


def model_params(model: PipelineModel) -> dict[str, str]:
    """Parameters actually set on the fitted stages (``stage.param`` -> value)."""
    out = {}
    for st in model.stages:
        for p, v in st.extractParamMap().items():
            if isinstance(v, (str, int, float, bool)):
                out[f"{type(st).__name__}.{p.name}"] = str(v)
    return out


def write_runs(spark: SparkSession, runs_path: str, runs: list[tuple], mode: str = "overwrite") -> DataFrame:
    """Write run records (name, params, metrics, artifact paths, start, end) as a table."""
    rows = [(name, {k: str(v) for k, v in params.items()}, {k: float(v) for k, v in metrics.items()}, dict(artifacts),
             start, end) for name, params, metrics, artifacts, start, end in runs]
    df = spark.createDataFrame(rows, RUNS_SCHEMA)
    df.write.mode(mode).parquet(runs_path)
    return df


def track_run(spark: SparkSession, runs_path: str, run_name: str, params: dict[str, str],
              metrics: dict[str, float], artifacts: dict[str, str],
              start_time: dt.datetime, end_time: dt.datetime | None = None) -> DataFrame:
    """Append one run record (name, params, metrics, artifact paths, times) to a table."""
    end_time = end_time or dt.datetime.now(dt.timezone.utc)
    return write_runs(spark, runs_path, [(run_name, params, metrics, artifacts, start_time, end_time)], "append")
