"""Reusable column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.schemas import PY_WHITESPACE

_WS_CLASS = "[" + "".join(f"\\x{{{ord(c):04x}}}" for c in PY_WHITESPACE) + "]"
_STRIP_RE = f"^{_WS_CLASS}+|{_WS_CLASS}+$"


def strip_py(c: Column | str) -> Column:
    """Strip leading/trailing whitespace exactly as Python ``str.strip()`` does.

    Spark ``trim`` only removes spaces; this removes every ``str.isspace()``
    character (tabs, newlines, no-break space, ...).
    """
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, _STRIP_RE, "")


def hex_hash(*cols: Column | str, salt: str = "") -> Column:
    """Stable md5 hex of the key columns (layout-independent, DuckDB-comparable).

    Several columns are joined with a unit separator; a non-empty ``salt`` is
    prefixed so different draws use independent orders.
    """
    parts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]
    key = parts[0] if len(parts) == 1 else F.concat_ws("\x1f", *parts)
    if salt:
        key = F.concat(F.lit(salt), key)
    return F.md5(key)


def hash_fraction_hex(fraction: float) -> str:
    """8-hex-digit threshold t such that ``md5 < t`` keeps ``fraction`` of keys."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be within [0, 1]")
    if fraction >= 1.0:
        return "g"  # sorts above every hex digest: keep all keys
    return f"{min(int(fraction * (1 << 32)), (1 << 32) - 1):08x}"


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every float/double column (result comparison across engines)."""
    return df.select([
        F.round(F.col(f.name), digits).cast("double").alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def tokens_expr(text: Column | str, keep_empty: bool = False) -> Column:
    """Lower-case and split on single whitespace characters.

    ``keep_empty=True`` reproduces MLlib ``Tokenizer`` (interior empty tokens
    kept, trailing ones dropped); the default drops every empty token.
    """
    t = F.col(text) if isinstance(text, str) else text
    parts = F.split(F.lower(t), r"\s")
    if keep_empty:
        # Java String.split: trailing empty strings are dropped, except that an
        # empty input yields one empty token. Spark's split keeps them all.
        last = F.array_max(F.transform(parts, lambda x, i: F.when(x != "", i + 1).otherwise(0)))
        return F.when(F.lower(t) == "", F.array(F.lit(""))).otherwise(
            F.slice(parts, 1, F.coalesce(last, F.lit(0))))
    return F.array_remove(parts, "")  # a built-in (codegen), not a per-element lambda
