"""Regularised histogram boosting, many models side by side.

Features are cut into bins once. Every level of every tree is one Spark job: each task adds up gradients and row counts by
(model, node, feature, bin), Spark sums these histograms, and the driver, which sees nothing else, picks the splits. Models that share the
rows, such as the parameter sets and folds of a search, grow in the same jobs, so a search costs as many jobs as its
longest model. The scores of all models after any number of trees come from the same rows, as sums per model.

The state of a row is its running score in every model. It is written to the shared folder after some trees, which cuts the lineage;
between two writings it is computed from the trees grown since.

With few rows nearly all of that time goes to starting jobs. So where the binned rows of a search take no more than ``WHOLE_BYTES``, every task
gets all of them and grows one model from its first tree to its last, by the same histograms and splits: one job for the whole search.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradepanel.session import materialise

# The functions and trees travel with the tasks, so no executor needs a copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 32
ROW_KEY = "row_key"
WRITTEN_EVERY = 2  # trees between two writings of the scores
ROWS_AT_ONCE = 8192
SIDE_BY_SIDE = 8  # groups of models whose jobs run at the same time
WHOLE_BYTES = 16 << 20  # of binned rows, up to which a task of a search holds all of them; they go through the driver once


@dataclass(frozen=True)
class Setting:
    """Parameters of one model. ``train_below`` and ``test``: it trains on folds below, and is scored on one fold."""

    trees: int = 100
    depth: int = 3
    rate: float = 0.1
    subsample: float = 1.0
    columns: float = 1.0
    l1: float = 0.0
    l2: float = 0.0
    least_rows: int = 1
    seed: int = 42
    train_below: int | None = None
    test: int | None = None


@dataclass
class Tree:
    """A tree as arrays over its nodes; node k has the children 2k + 1 and 2k + 2. A leaf has feature -1."""

    feature: np.ndarray
    cut: np.ndarray  # a row goes right if its bin is above
    value: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        size = 2 ** (depth + 1) - 1
        return Tree(np.full(size, -1, np.int16), np.zeros(size, np.int16), np.zeros(size))


@dataclass
class Boosted:
    """A fitted model: bin edges per feature, the first score, and trees whose values include the rate."""

    features: list[str]
    edges: list[np.ndarray]
    base: float
    setting: Setting
    trees: list[Tree] = field(default_factory=list)
    gains: dict[str, float] = field(default_factory=dict)


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper edges of at most ``bins`` bins for each feature, from quantiles of all rows; few distinct values get a bin each."""
    shares = [k / bins for k in range(bins + 1)]
    found = df.agg(*[F.percentile_approx(F.col(f).cast("double"), shares, 10_000).alias(f"q{i}") for i, f in enumerate(features)]).first()
    # The largest value needs no edge: what lies above all edges is the last bin.
    return [np.unique(np.array(found[f"q{i}"] or [], np.float64))[:-1] for i in range(len(features))]


def _bins(batch: pa.RecordBatch, features: Sequence[str], edges: Sequence[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(batch), len(features)), np.uint8)
    for k, (f, e) in enumerate(zip(features, edges)):
        out[:, k] = np.searchsorted(e, batch[f].to_numpy(zero_copy_only=False), "left")
    return out


def binned(df: DataFrame, features: Sequence[str], edges: Sequence[np.ndarray], label: str, key: Column, fold: Column) -> DataFrame:
    """Complete rows as ``bins`` (one byte a feature), ``label``, ``fold`` and ``key`` (a number that subsampling goes by)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _bins(batch, features, edges)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tobytes() for r in rows], pa.binary()), batch["_label"], batch["_fold"], batch["_key"]], names=["bins", "label", "fold", "key"]
            )

    whole = df.select(
        *[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("double").alias("_label"), fold.cast("int").alias("_fold"),
        key.cast("long").alias("_key"),
    ).dropna(subset=[*features, "_label"])
    return whole.mapInArrow(run, "bins binary, label double, fold int, key long")


def _walk(tree: Tree, bins: np.ndarray, depth: int) -> np.ndarray:
    """The node of every row after ``depth`` levels, or the leaf where it stopped."""
    node = np.zeros(len(bins), np.int64)
    if not depth or tree.feature[0] < 0:
        return node
    # Whatever does not hang on the row is worked out for each node once: its feature's column, and both ways out of it.
    inner, own = tree.feature >= 0, np.arange(len(tree.feature))
    column = np.where(inner, tree.feature, 0).astype(np.int64)
    after = np.stack([np.where(inner, 2 * own + 1, own), np.where(inner, 2 * own + 2, own)], 1).ravel()
    flat, start = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
    for _ in range(depth):
        right = flat.take(column.take(node) + start) > tree.cut.take(node)
        node = after.take(2 * node + right)
    return node


def _uniform(key: np.ndarray, seed: int, turn: int) -> np.ndarray:
    """A number in [0, 1) for each key, seed and turn."""
    with np.errstate(over="ignore"):
        h = key.astype(np.uint64) + np.uint64((seed * 1_000_003 + turn + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return ((h ^ h >> np.uint64(31)) >> np.uint64(11)).astype(np.float64) / 2.0**53


def _leaf(g, n, s: Setting):
    """Value of a leaf for squared errors: ``g`` is the sum of residuals, ``n`` the sum of Hessians, one for each row."""
    return np.sign(g) * np.maximum(np.abs(g) - s.l1, 0.0) / np.maximum(n + s.l2, 1e-300)


def _strength(g, n, s: Setting):
    return np.maximum(np.abs(g) - s.l1, 0.0) ** 2 / np.maximum(n + s.l2, 1e-300)


class _Rows:
    """The rows of one batch with the scores of all models."""

    def __init__(self, batch: pa.RecordBatch, width: int, models: int, bases: np.ndarray, since: list[list[Tree | None]]):
        n = len(batch)
        self.bins = np.frombuffer(b"".join(batch["bins"].to_pylist()), np.uint8).reshape(n, width) if width else np.zeros((n, 0), np.uint8)
        self.label, self.fold, self.key = (batch[c].to_numpy(zero_copy_only=False) for c in ("label", "fold", "key"))
        self.scores = np.tile(bases, (n, 1))
        if "scores" in batch.schema.names:
            self.scores = np.frombuffer(b"".join(batch["scores"].to_pylist()), np.float64).reshape(n, models).copy()
        self.add(since)

    def keep(self, rows: np.ndarray) -> None:
        self.bins, self.label, self.fold, self.key, self.scores = (x[rows] for x in (self.bins, self.label, self.fold, self.key, self.scores))

    def add(self, since: list[list[Tree | None]]) -> None:
        """Bring the scores up to date by the trees grown since."""
        for turn in since:
            for m, tree in enumerate(turn):
                if tree is not None:
                    self.scores[:, m] += tree.value[_walk(tree, self.bins, _depth(tree))]


def _depth(tree: Tree) -> int:
    return (len(tree.feature) + 1).bit_length() - 2


def _added(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Histograms of the same model and node, added up; there are as many as the models have nodes on a level."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in source:
        for m, node, part in zip(batch["model"].to_pylist(), batch["node"].to_pylist(), batch["sums"]):
            values = np.asarray(part.values)
            sums[m, node] = sums[m, node] + values if (m, node) in sums else values
    keys = list(sums)
    columns = [pa.array([m for m, _ in keys], pa.int32()), pa.array([k for _, k in keys], pa.int32()), pa.array([sums[k] for k in keys], pa.list_(pa.float64()))]
    yield pa.RecordBatch.from_arrays(columns, names=["model", "node", "sums"])


def _sums(groups: Iterable[_Rows], partial: dict[int, Tree], settings: Sequence[Setting], turn: int, level: int, most: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """For the nodes that the growing trees ``partial`` have on a level: sums of residuals and row counts by (feature, bin), over these rows."""
    sums: dict[int, np.ndarray] = {}
    first, nodes, width = 2**level - 1, 2**level, 0
    for rows in groups:
        width = rows.bins.shape[1]
        cells = nodes * width * most
        place = np.arange(width) * most + rows.bins
        for m, tree in partial.items():
            s = settings[m]
            take = np.ones(len(rows.label), bool) if s.train_below is None else rows.fold < s.train_below
            if s.subsample < 1:
                take &= _uniform(rows.key, s.seed, turn) < s.subsample
            node = _walk(tree, rows.bins, level)
            take &= node >= first
            if not take.any():
                continue
            at = ((node[take] - first) * (width * most))[:, None] + place[take]
            residual = np.repeat((rows.label - rows.scores[:, m])[take], width)
            both = sums.setdefault(m, np.zeros((2, cells)))
            both[0] += np.bincount(at.ravel(), residual, cells)
            both[1] += np.bincount(at.ravel(), minlength=cells)
    for m, both in sums.items():
        for k in range(nodes):
            part = both[:, k * width * most : (k + 1) * width * most]
            if part[1].any():
                yield m, first + k, part


def _errors(groups: Iterable[_Rows], settings: Sequence[Setting]) -> np.ndarray:
    """Of each model, over its test fold: rows, squared and absolute errors, sums of labels and of their squares."""
    sums = np.zeros((len(settings), len(SUMS)))
    for r in groups:
        for m, s in enumerate(settings):
            take = np.ones(len(r.label), bool) if s.test is None else r.fold == s.test
            y = r.label[take]
            error = y - r.scores[take, m]
            sums[m] += [len(y), error @ error, np.abs(error).sum(), y.sum(), y @ y]
    return sums


def _batches(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        for at in range(0, len(batch), ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


class Table:
    """Binned rows, written once for all models, with the sum of labels of each fold."""

    def __init__(self, df: DataFrame, features: Sequence[str], label: str, key: Column, fold: Column | None = None, bins: int = BINS):
        self.features = list(features)
        complete = df.dropna(subset=[*features, label])
        self.edges = bin_edges(complete, features, bins)
        self.rows = materialise(binned(complete, features, self.edges, label, key, F.lit(0) if fold is None else fold), "binned")
        self.parts = self.rows.rdd.getNumPartitions()
        counts = self.rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("s")).collect()
        self.folds = {r["fold"]: (r["n"], r["s"]) for r in counts}

    def size(self) -> int:
        """Bytes of the binned rows in Arrow: bins with their offset, label, fold and key."""
        return sum(n for n, _ in self.folds.values()) * (len(self.features) + 4 + 8 + 4 + 8)


class _Growing:
    """Models that grow together, a tree at a time; the kinds below differ in where the rows are. It names nothing outside this module, so that it travels."""

    written_every = 1  # trees between two calls of ``_write``

    def __init__(self, features: Sequence[str], edges: Sequence[np.ndarray], folds: dict[int | None, tuple[int, float]], settings: Sequence[Setting]):
        self.features, self.edges, self.settings = list(features), list(edges), list(settings)
        self.most = max([len(e) for e in self.edges], default=0) + 1
        self.models = []
        for s in self.settings:
            part = [x for k, x in folds.items() if s.train_below is None or k is not None and k < s.train_below]
            n = sum(rows for rows, _ in part)
            self.models.append(Boosted(self.features, self.edges, sum(total for _, total in part) / n if n else 0.0, s))
        self.bases = np.array([m.base for m in self.models])
        self.since: list[list[Tree | None]] = []
        self.turn = 0

    def grow(self) -> None:
        """One more tree for every model that has not all of its own."""
        growing = [m for m, s in enumerate(self.settings) if self.turn < s.trees]
        trees = {m: Tree.empty(self.settings[m].depth) for m in growing}
        open_ = {m: {0} for m in growing}
        allowed = {m: self._columns(m) for m in growing}
        for level in range(max((self.settings[m].depth for m in growing), default=0)):
            now = [m for m in growing if level < self.settings[m].depth and open_[m]]
            if not now:
                break
            for m, node, table in self._histograms(now, trees, level):
                if node in open_[m]:
                    open_[m].discard(node)
                    children = self._split(m, trees[m], node, table, allowed[m])
                    open_[m].update(children)
        for m in growing:
            trees[m].value *= self.settings[m].rate
            self.models[m].trees.append(trees[m])
        self.since.append([trees.get(m) for m in range(len(self.models))])
        self.turn += 1
        if len(self.since) >= self.written_every:
            self._write()

    def _columns(self, m: int) -> np.ndarray:
        """Features that this model's next tree may use."""
        s, width = self.settings[m], len(self.features)
        if s.columns >= 1:
            return np.arange(width)
        drawn = np.random.default_rng([s.seed, self.turn]).permutation(width)
        return np.sort(drawn[: max(1, round(s.columns * width))])

    def _split(self, m: int, tree: Tree, node: int, table: np.ndarray, allowed: np.ndarray) -> list[int]:
        """Split a node by its best cut, if one gains; its children, open for the next level."""
        s, model = self.settings[m], self.models[m]
        g, n = table[0][allowed], table[1][allowed]
        total_g, total_n = g[0].sum(), n[0].sum()
        tree.value[node] = _leaf(total_g, total_n, s)
        left_g, left_n = g.cumsum(1)[:, :-1], n.cumsum(1)[:, :-1]
        right_g, right_n = total_g - left_g, total_n - left_n
        gain = _strength(left_g, left_n, s) + _strength(right_g, right_n, s) - _strength(total_g, total_n, s)
        gain[(left_n < s.least_rows) | (right_n < s.least_rows)] = -np.inf
        if not gain.size or not gain.max() > 1e-12 * max(1.0, abs(total_g)):
            return []
        f, cut = np.unravel_index(gain.argmax(), gain.shape)
        tree.feature[node], tree.cut[node] = allowed[f], cut
        name = self.features[allowed[f]]
        model.gains[name] = model.gains.get(name, 0.0) + float(gain[f, cut])
        for child, x, y in ((2 * node + 1, left_g, left_n), (2 * node + 2, right_g, right_n)):
            tree.value[child] = _leaf(x[f, cut], y[f, cut], s)
        return [2 * node + 1, 2 * node + 2]


class Ensemble(_Growing):
    """Models that grow together on one table of binned rows, a job for each level."""

    written_every = WRITTEN_EVERY

    def __init__(self, table: Table, settings: Sequence[Setting]):
        super().__init__(table.features, table.edges, table.folds, settings)
        self.rows, self.parts = table.rows, table.parts

    def _run(self, work, schema: str, since) -> DataFrame:
        width, models, bases, settings = len(self.features), len(self.models), self.bases, self.settings

        def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from work((_Rows(b, width, models, bases, since) for b in _batches(source)), settings)

        return self.rows.mapInArrow(run, schema)

    def _histograms(self, now: list[int], trees: dict[int, Tree], level: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """For every open node of the models ``now``: sums of residuals and row counts by (feature, bin)."""
        most, partial, turn = self.most, {m: trees[m] for m in now}, self.turn

        def work(groups: Iterator[_Rows], settings: list[Setting]) -> Iterator[pa.RecordBatch]:
            out = list(_sums(groups, partial, settings, turn, level, most))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2].ravel() for x in out], pa.list_(pa.float64()))],
                    names=["model", "node", "sums"],
                )

        parts = self._run(work, "model int, node int, sums array<double>", self.since)
        if self.parts > 1:
            parts = parts.repartition("model", "node").mapInArrow(_added, "model int, node int, sums array<double>")
        table = parts.toArrow()
        for m, node, sums in zip(table["model"].to_pylist(), table["node"].to_pylist(), table["sums"]):
            yield m, node, np.asarray(sums.values).reshape(2, len(self.features), most)

    def _write(self) -> None:
        def work(groups: Iterator[_Rows], settings: list[Setting]) -> Iterator[pa.RecordBatch]:
            for r in groups:
                columns = [pa.array([x.tobytes() for x in r.bins], pa.binary()), pa.array(r.label), pa.array(r.fold), pa.array(r.key)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([x.tobytes() for x in r.scores], pa.binary())], names=["bins", "label", "fold", "key", "scores"])

        self.rows = materialise(self._run(work, "bins binary, label double, fold int, key long, scores binary", self.since), "boosted")
        self.since = []

    def test_sums(self) -> dict[int, tuple[float, ...]]:
        """Of each model, over its test fold as the trees stand now: rows, squared and absolute errors, sums of labels and of their squares."""

        def work(groups: Iterator[_Rows], settings: list[Setting]) -> Iterator[pa.RecordBatch]:
            sums = _errors(groups, settings)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(settings), dtype=np.int32)), *[pa.array(c) for c in sums.T.copy()]], names=["model", *SUMS])

        parts = self._run(work, "model int, " + ", ".join(f"{c} double" for c in SUMS), self.since)
        return {r["model"]: tuple(r[c] for c in SUMS) for r in parts.groupBy("model").agg(*[F.sum(c).alias(c) for c in SUMS]).collect()}


class _Whole(_Growing):
    """Models that grow in one task, which holds all the rows that they train on or are scored on."""

    def __init__(self, batches: Iterable[pa.RecordBatch], features: Sequence[str], edges: Sequence[np.ndarray], folds: dict[int | None, tuple[int, float]], settings: Sequence[Setting]):
        super().__init__(features, edges, folds, settings)
        self.groups = [_Rows(b, len(self.features), len(self.models), self.bases, []) for b in _batches(batches)]
        for rows in self.groups:
            used = np.zeros(len(rows.label), bool)
            for s in self.settings:
                used |= (s.train_below is None) | (s.test is None) | (rows.fold < (s.train_below or 0)) | (rows.fold == s.test)
            rows.keep(used)

    def _histograms(self, now: list[int], trees: dict[int, Tree], level: int) -> Iterator[tuple[int, int, np.ndarray]]:
        for m, node, sums in _sums(self.groups, {m: trees[m] for m in now}, self.settings, self.turn, level, self.most):
            yield m, node, sums.reshape(2, len(self.features), self.most)

    def _write(self) -> None:
        for rows in self.groups:
            rows.add(self.since)
        self.since = []

    def test_sums(self) -> dict[int, tuple[float, ...]]:
        return {m: tuple(sums) for m, sums in enumerate(_errors(self.groups, self.settings).tolist())}


SUMS = ["n", "sse", "sae", "sy", "syy"]


def r2(sums: tuple[float, ...]) -> float:
    n, sse, _, sy, syy = sums
    spread = syy - sy * sy / n if n else 0.0
    return 1.0 - sse / spread if spread > 0 else float("nan")


def fit(df: DataFrame, features: Sequence[str], label: str, setting: Setting, key: Column, bins: int = BINS) -> Boosted:
    """One model on all complete rows of ``df``; ``key`` tells rows apart for subsampling.

    Squared error with L1 and L2 penalties in the leaf values, as shrunken sums of residuals; a share of the rows and of the features for each
    tree, both drawn from the seed and thus the same at every run and however the rows are dealt.
    """
    grown = Ensemble(Table(df, features, label, key, None, bins), [setting])
    for _ in range(setting.trees):
        grown.grow()
    return grown.models[0]


def predict(model: Boosted, df: DataFrame, out: str = "prediction") -> DataFrame:
    """``df`` with the model's score; a row with a missing feature has none."""
    features, edges, base, trees = model.features, model.edges, model.base, model.trees
    schema = df.drop(out).schema.add(out, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [batch[f"_x{k}"].to_numpy(zero_copy_only=False) for k in range(len(features))]
            missing = np.logical_or.reduce([np.isnan(v) for v in values], axis=0) if values else np.zeros(len(batch), bool)
            bins = np.stack([np.searchsorted(e, v, "left") for v, e in zip(values, edges)], 1).astype(np.uint8)
            score = np.full(len(batch), base)
            for tree in trees:
                score += tree.value[_walk(tree, bins, _depth(tree))]
            kept = [c for c in batch.schema.names if not c.startswith("_x")]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], pa.array(score, mask=missing)], names=[*kept, out])

    inputs = df.drop(out).withColumns({f"_x{k}": F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))) for k, f in enumerate(model.features)})
    return inputs.mapInArrow(run, schema)


def _shared_stages(table: Table, settings: Sequence[Setting], stages: Sequence[int]) -> list[list[tuple[float, ...]]]:
    """Of each model, the sums over its test fold after so many trees. Groups of models share their jobs, and each task holds its share of the rows."""

    def grown(group: Sequence[Setting]) -> list[list[tuple[float, ...]]]:
        ensemble, out = Ensemble(table, group), [[] for _ in group]
        for turn in range(1, stages[-1] + 1):
            ensemble.grow()
            if turn in stages:
                for m, sums in ensemble.test_sums().items():
                    out[m].append(sums)
        return out

    size = -(-len(settings) // SIDE_BY_SIDE)
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        return [x for out in pool.map(grown, [settings[at : at + size] for at in range(0, len(settings), size)]) for x in out]


def _whole_stages(table: Table, settings: Sequence[Setting], stages: Sequence[int]) -> list[list[tuple[float, ...]]]:
    """The same sums, with a task for each model that holds all rows."""
    spark, features, edges, folds, settings = table.rows.sparkSession, table.features, table.edges, table.folds, list(settings)
    rows = table.rows.toArrow()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as stream:
        stream.write_table(rows)
    sent = spark.sparkContext.broadcast(sink.getvalue().to_pybytes())
    stages = list(stages)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for m in (m for batch in source for m in batch["id"].to_pylist()):
            model, out = _Whole(pa.ipc.open_stream(sent.value), features, edges, folds, [settings[m]]), []
            for turn in range(1, stages[-1] + 1):
                model.grow()
                if turn in stages:
                    out.append((m, turn, *model.test_sums()[0]))
            kinds = [pa.int32(), pa.int32(), *[pa.float64()] * len(SUMS)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["model", "turn", *SUMS])

    each = spark.range(0, len(settings), 1, len(settings)).mapInArrow(run, "model int, turn int, " + ", ".join(f"{c} double" for c in SUMS))
    found = {(r["model"], r["turn"]): tuple(r[c] for c in SUMS) for r in each.collect()}
    sent.destroy()
    return [[found[m, turn] for turn in stages] for m in range(len(settings))]


def search(
    folded: DataFrame, features: Sequence[str], label: str, candidates: Sequence[dict], folds: Sequence[int], key: Column | None = None, fold: str = "fold",
) -> DataFrame:
    """Mean fold R2 of every parameter set, best first, each trained on the folds before the one it is scored on.

    ``key`` tells rows apart for subsampling; without one it is the column ``ROW_KEY``, or a hash of the whole row.
    Sets that differ only in ``trees`` are one model, scored when it has as many trees; models of all folds grow together.
    """
    if key is None:
        key = F.col(ROW_KEY) if ROW_KEY in folded.columns else F.xxhash64(*folded.columns)
    stages = sorted({c["trees"] for c in candidates})
    shapes: list[dict] = []
    for c in candidates:
        shape = {k: v for k, v in c.items() if k != "trees"}
        if shape not in shapes:
            shapes.append(shape)
    settings = [(i, Setting(trees=stages[-1], train_below=k, test=k, **shape)) for i, shape in enumerate(shapes) for k in folds]
    settings.sort(key=lambda x: -x[1].depth)  # models of one depth share their jobs; the deepest take longest and begin first
    table = Table(folded, features, label, key, F.col(fold))
    work = _whole_stages if table.size() <= WHOLE_BYTES else _shared_stages
    scores: dict[tuple[int, int], list[float]] = {}
    for (shape, _), found in zip(settings, work(table, [s for _, s in settings], stages)):
        for turn, sums in zip(stages, found):
            scores.setdefault((shape, turn), []).append(r2(sums))
    rows = []
    for i, c in enumerate(candidates):
        shape = shapes.index({k: v for k, v in c.items() if k != "trees"})
        rows.append((i, ", ".join(f"{k}={v}" for k, v in c.items()), float(np.mean(scores[shape, c["trees"]]))))
    return folded.sparkSession.createDataFrame(rows, "candidate int, params string, r2 double").orderBy(F.col("r2").desc(), "candidate")
