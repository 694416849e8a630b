"""Fitted-model persistence (S7, S8): Spark ML writer/reader on shared storage."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from surveyspark.sources.files import path_exists


def save_model(model, path: str) -> str:
    """Save or replace a fitted model directory."""
    model.write().overwrite().save(path)
    return path


def load_model(spark: SparkSession, path: str, cls=PipelineModel):
    """Load a saved model; a missing path raises FileNotFoundError."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"model not found: {path}")
    return cls.load(path)
