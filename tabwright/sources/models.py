"""Storing fitted pipelines."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def save_model(model: PipelineModel, path: str) -> str:
    """Replace the model at ``path``; gives the path back for the run log."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
