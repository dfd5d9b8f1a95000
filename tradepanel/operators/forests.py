"""Search over forests: one fit serves every smaller forest and every shallower tree.

With all features at every split, a tree grown to a depth is the top of the same tree grown deeper, and the first trees of a forest are a
smaller forest. So the deepest and largest forest of each minimum node size is fitted once for each fold, and scored at all
its stages in one pass over the test rows, which ends in five sums a stage.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepanel.operators import models
from tradepanel.operators.boosting import SUMS, r2
from tradepanel.session import fresh_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows up to which a fit keeps the node that every row has reached in every tree, 4 bytes each, so that tasks need not get all trees at every level.
# The trees are the same either way.
FEW_ROWS = 1 << 18


def tree_arrays(spark: SparkSession, model: PipelineModel) -> list[tuple[np.ndarray, ...]]:
    """Each tree as (feature or -1, threshold, left, right, value) by node, read from the saved model."""
    path = fresh_path(spark, "forest")
    model.stages[-1].save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild", F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    ).toArrow()
    columns = {c: nodes[c].to_numpy() for c in nodes.column_names}
    order = np.lexsort((columns["id"], columns["treeID"]))
    columns = {c: v[order] for c, v in columns.items()}
    out = []
    for part in np.split(np.arange(nodes.num_rows), np.flatnonzero(np.diff(columns["treeID"])) + 1):
        left = columns["leftChild"][part].astype(np.int32)
        feature = np.where(left >= 0, columns["feature"][part].astype(np.int32), -1)
        threshold = np.nan_to_num(columns["threshold"][part].astype(np.float64))
        out.append((feature, threshold, left, columns["rightChild"][part].astype(np.int32), columns["prediction"][part].astype(np.float64)))
    return out


def staged_sums(model: PipelineModel, rows: DataFrame, label: str, depths: Sequence[int], sizes: Sequence[int]) -> dict[tuple[int, int], tuple[float, ...]]:
    """For every depth and number of trees: rows, squared and absolute errors, sums of labels and of their squares."""
    spark = rows.sparkSession
    inputs = models.feature_names(model)
    sent = spark.sparkContext.broadcast(tree_arrays(spark, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(depths), len(sizes), len(SUMS)))
        for batch in batches:
            x = np.stack([batch[f"_x{k}"].to_numpy() for k in range(len(inputs))], 1)
            y, at = batch["_y"].to_numpy(), np.arange(len(batch))
            total = np.zeros((len(depths), len(y)))
            for t, (feature, threshold, left, right, value) in enumerate(sent.value, 1):
                node = np.zeros(len(y), np.int64)
                for depth in range(1, max(depths) + 1):
                    f = feature[node]
                    go = np.where(x[at, np.maximum(f, 0)] <= threshold[node], left[node], right[node])
                    node = np.where(f >= 0, go, node)
                    if depth in depths:
                        total[depths.index(depth)] += value[node]
                if t in sizes:
                    for d in range(len(depths)):
                        error = y - total[d] / t
                        sums[d, sizes.index(t)] += [len(y), error @ error, np.abs(error).sum(), y.sum(), y @ y]
        rows = [(d, n, *map(float, sums[i, j])) for i, d in enumerate(depths) for j, n in enumerate(sizes)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int32() if k < 2 else pa.float64()) for k, c in enumerate(zip(*rows))], names=["depth", "trees", *SUMS]
        )

    depths, sizes = list(depths), list(sizes)
    data = rows.select(*[F.col(c).cast("double").alias(f"_x{k}") for k, c in enumerate(inputs)], F.col(label).cast("double").alias("_y")).dropna()
    parts = data.mapInArrow(run, "depth int, trees int, " + ", ".join(f"{c} double" for c in SUMS))
    added = parts.groupBy("depth", "trees").agg(*[F.sum(c).alias(c) for c in SUMS]).collect()
    sent.destroy()
    return {(r["depth"], r["trees"]): tuple(r[c] for c in SUMS) for r in added}


def search(folded: DataFrame, features: Sequence[str], label: str, candidates: Sequence[dict], folds: Sequence[int], fold: str = "fold") -> DataFrame:
    """Mean fold R2 of every parameter set (``trees``, ``depth``, ``min_rows``), best first, each trained on the folds before the one it is scored on."""
    from tradepanel.operators.validation import _side_by_side

    how = {"node_ids": True} if folded.count() <= FEW_ROWS else {}
    depths, sizes = sorted({c["depth"] for c in candidates}), sorted({c["trees"] for c in candidates})
    # The latest folds have the most rows to train on; their fits take longest and begin first.
    tries = [(m, k) for k in sorted(folds, reverse=True) for m in sorted({c.get("min_rows", 2) for c in candidates})]

    def one(at: tuple[int, int]) -> dict[tuple[int, int], tuple[float, ...]]:
        least, k = at
        train = folded.where(F.col(fold) < k)
        model = models.fit(train, features, label, "forest", scale=False, trees=sizes[-1], depth=depths[-1], min_rows=least, **how)
        return staged_sums(model, folded.where(F.col(fold) == k), label, depths, sizes)

    found = dict(zip(tries, _side_by_side(one, tries)))
    rows = []
    for i, c in enumerate(candidates):
        score = np.mean([r2(found[c.get("min_rows", 2), k][c["depth"], c["trees"]]) for k in folds])
        rows.append((i, ", ".join(f"{k}={v}" for k, v in c.items()), float(score)))
    return folded.sparkSession.createDataFrame(rows, "candidate int, params string, r2 double").orderBy(F.col("r2").desc(), "candidate")
