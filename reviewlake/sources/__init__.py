from reviewlake.sources.tables import (  # noqa: F401
    TABLES, table, reviews, texts, activity, scan_table, scan_columns,
)
from reviewlake.sources.csv import scan_reviews_csv  # noqa: F401
from reviewlake.sources.models import load_model  # noqa: F401
