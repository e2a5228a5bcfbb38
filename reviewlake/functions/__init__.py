"""Column-expression helpers (JVM-side, codegen-friendly; no Python UDFs)."""

from reviewlake.functions.exprs import (  # noqa: F401
    strip_py, hex_hash, hash_fraction_hex, round_doubles, tokens_expr,
)
