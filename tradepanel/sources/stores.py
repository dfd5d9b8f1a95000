"""Saved models with their feature contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel

from tradepanel.operators.models import feature_names


def save_model(model: PipelineModel, path: str) -> None:
    """Store a fitted pipeline; its assembler carries the ordered feature names."""
    model.write().save(path)


def load_model(path: str, expected: Sequence[str] | None = None) -> PipelineModel:
    """Load a pipeline and check that it wants exactly the expected features, in order."""
    model = PipelineModel.load(path)
    found = feature_names(model)
    if expected is not None and found != list(expected):
        raise ValueError(f"stored model wants {found}, not {list(expected)}")
    return model
