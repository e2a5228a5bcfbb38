"""Write reviewlake/plans/round_cols.py: the double columns of each oracle query.

Spark queries round every double column to 6 digits; the oracle SQL is
wrapped to round the same columns (DuckDB cannot select columns by type).
Run after adding or changing a query: python tools/gen_round_cols.py
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import types as T  # noqa: E402

from reviewlake.session import get_session  # noqa: E402


def main() -> None:
    from reviewlake import plans
    spark = get_session("local[4]", conf={"spark.sql.shuffle.partitions": "4",
                                          "spark.ui.showConsoleProgress": "false"})
    out = {}
    for name in sorted(plans.oracle_sql()):
        schema = plans.QUERIES[name](spark, "/root/testdata/sf0.001").schema
        cols = [f.name for f in schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
        if cols:
            out[name] = cols
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                        "reviewlake", "plans", "round_cols.py")
    with open(path, "w") as f:
        f.write('"""Double columns per oracle query (generated by tools/gen_round_cols.py)."""\n\n')
        f.write("ROUND_COLS = {\n")
        for k, v in out.items():
            f.write(f"    {k!r}: {v!r},\n")
        f.write("}\n")
    spark.stop()


if __name__ == "__main__":
    main()
