"""Published models: numbered versions with a manifest each; readers pin one or take the newest.

A model is written to a folder of its own first and becomes visible with its manifest, one small file that
the file system shows whole or not at all. A run that dies in between leaves a folder that no reader sees.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tradepanel.operators.models import feature_names
from tradepanel.sources.stores import load_model, save_model

MANIFEST = "name string, version long, features array<string>, metrics map<string,double>, folder string"


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """One row per published version; none where nothing has been published."""
    try:
        return spark.read.schema(MANIFEST).option("recursiveFileLookup", True).json(f"{path}/manifests")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def publish(spark: SparkSession, model: PipelineModel, path: str, name: str, metrics: Mapping[str, float]) -> int:
    """Store a fitted pipeline as the next version of ``name``; returns its number.

    Of two writers that take the same number, the second gets an error and may publish again.
    """
    if not re.fullmatch(r"\w+", name):
        raise ValueError("a model's name has letters, digits and underscores")
    last = manifests(spark, path).where(F.col("name") == name).agg(F.max("version")).first()[0]
    version = (last or 0) + 1
    folder = f"models/{name}-{uuid.uuid4().hex}"
    save_model(model, f"{path}/{folder}")
    row = (name, version, feature_names(model), {k: float(v) for k, v in metrics.items()}, folder)
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("errorifexists").json(f"{path}/manifests/{name}-{version}")
    return version


def pinned(
    spark: SparkSession, path: str, name: str, version: int | None = None, expected: Sequence[str] | None = None
) -> tuple[PipelineModel, Row]:
    """A published model and its manifest: the stated version, or the newest; features are checked as in ``load_model``."""
    found = manifests(spark, path).where(F.col("name") == name)
    if version is not None:
        found = found.where(F.col("version") == version)
    row = found.orderBy(F.desc("version")).first()
    if row is None:
        raise ValueError(f"no published model {name!r}" + (f" of version {version}" if version is not None else ""))
    return load_model(f"{path}/{row['folder']}", row["features"] if expected is None else expected), row
