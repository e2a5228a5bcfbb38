"""Fitted-model source."""

from pyspark.ml import PipelineModel


def load_model(path: str) -> PipelineModel:
    """Load a fitted pipeline saved by ``sinks.models.save_model``."""
    return PipelineModel.load(path)
