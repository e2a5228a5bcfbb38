"""Review CSV source (quoted, multi-line text, pandas-style missing tokens)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.schemas import PANDAS_NULL_TOKENS, RAW_CSV_SCHEMA


def scan_reviews_csv(spark: SparkSession, path: str,
                     null_tokens: list[str] | None = PANDAS_NULL_TOKENS,
                     multi_line: bool = True) -> DataFrame:
    """Read the raw review CSV with an explicit all-string schema.

    ``multiLine`` + ``escape='"'`` handle quoted newlines and doubled quotes.
    Values equal to a ``null_tokens`` entry become null, as pandas does; typing
    is left to ``operators.clean.build_event`` (which uses ``try_cast``).
    A ``multiLine`` file is read by one task (it cannot be split at arbitrary
    offsets): at scale store the raw drop as many files, or pass
    ``multi_line=False`` for input known to have no quoted newlines, which
    Spark splits by ``spark.sql.files.maxPartitionBytes``.
    """
    df = (spark.read.schema(RAW_CSV_SCHEMA)
          .option("header", True).option("multiLine", multi_line)
          .option("quote", '"').option("escape", '"')
          .option("mode", "PERMISSIVE")
          .csv(path))
    if not null_tokens:
        return df
    tokens = list(null_tokens)
    return df.select([
        F.when(F.col(c).isin(tokens), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
        for c in df.columns
    ])
