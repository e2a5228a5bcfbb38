"""Sinks: message publishing, table snapshots, reports, predictions, models, runs."""

from reviewlake.sinks.stream import publish_events, event_records  # noqa: F401
from reviewlake.sinks.tables import (  # noqa: F401
    write_silver, latest_snapshot, write_report, export_predictions,
)
from reviewlake.sinks.models import save_model, track_run  # noqa: F401
