"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its features are shares of kinds of characters, word counts and repeated
words, of the line itself and of its two neighbours; a transition weight ties the labels of
neighbouring lines. Forward-backward gives each line's chance to be good; their mean, weighted by
line length, is mapped to the chance that the document's label is 1 by a logistic curve.

The field is trained on a bounded sample of labelled documents, whose lines take the label of their document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepanel.llm import bytescan
from tradepanel.llm.common import kept, map_batches, slices

SAMPLE = 3000  # labelled documents to train on, at most
SAMPLE_BYTES = 1 << 16  # only texts up to this size and
SAMPLE_LINES = 512  # with up to so many lines are training documents, which bounds the sample
STEPS = 120
RIDGE = 1e-3
BLOCK = 512  # lines of a chain that are gone through one after another

N_OWN = 15


def own_features(texts: list[bytes], tables: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines by themselves, their lengths, and where each text's lines begin. Columns are made one by one."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    stops = np.flatnonzero(data == 10) + 1
    starts = np.concatenate([[0], stops[:-1]])
    n = len(starts)
    begins = np.concatenate([[0], np.searchsorted(stops, ends, "right")])
    length = (stops - starts).astype(np.float64)

    kind = kept("line_kinds", _kinds)[data]
    total = lambda k: np.add.reduceat(kind == k, starts, dtype=np.int64).astype(np.float64)
    w = bytescan.words_of([data.tobytes()], True, tables)
    line = np.searchsorted(stops, w.start, "right")
    words = np.bincount(line, minlength=n).astype(np.float64)

    def repeats(lag: int) -> np.ndarray:
        same = (w.hash[lag:] == w.hash[:-lag]) & (line[lag:] == line[:-lag]) if len(w.hash) > lag else np.zeros(0, bool)
        return np.bincount(line[lag:][same] if len(same) else np.zeros(0, np.int64), minlength=n)

    def again() -> np.ndarray:
        seen = np.bincount(line, (w.hash >> np.uint64(11)).astype(np.float64), n)  # equal lines have equal sums
        doc = np.repeat(np.arange(len(texts)), np.diff(begins))
        order = np.lexsort((np.arange(n), seen, doc))
        out = np.zeros(n)
        out[order[1:]] = (seen[order[1:]] == seen[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]]) & (words[order[1:]] > 0)
        return out

    per_word, per_char = np.maximum(words, 1), np.maximum(length - 1, 1)
    columns = (
        lambda: np.log1p(length - 1), lambda: np.log1p(words), lambda: (length - 1) / per_word / 10, lambda: total(1) / per_char,
        lambda: total(2) / per_char, lambda: total(3) / per_char, lambda: np.minimum(total(4) / per_word, 4),
        lambda: np.minimum(total(5) / per_word, 4), lambda: total(6) / per_word, lambda: total(7) / per_char,
        lambda: repeats(1) / per_word, lambda: repeats(2) / per_word,
        lambda: np.bincount(line, (w.end - w.start) == 1, n) / per_word, again, lambda: words == 0,
    )
    own = np.empty((n, N_OWN), np.float32)
    for k, column in enumerate(columns):
        own[:, k] = column()
    return own, length, begins


def _edges(n: int, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each line is the first, and the last, of its text."""
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    first[begins[:-1]] = True
    last[begins[1:] - 1] = True
    return first, last


def line_features(own: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Features of each line, of the one before and the one after it in its text, and whether it is the first or last."""
    first, last = _edges(len(own), begins)
    before = np.where(first[:, None], np.float32(0), np.roll(own, 1, 0))
    after = np.where(last[:, None], np.float32(0), np.roll(own, -1, 0))
    return np.hstack([own, before, after, first[:, None], last[:, None]]).astype(np.float32)


def _kinds() -> np.ndarray:
    out = np.zeros(256, np.uint8)
    for k, chars in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "#*$%&|<>@^~{}[]\\=_+", "!?", ".,;:"), 1):
        out[[ord(c) for c in chars]] = k
    out[128:] = 7
    return out


@dataclass
class Model:
    """Weights of the good label per feature, of staying in each pair of labels, and the final curve."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    moves: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def emissions(self, own: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Weighted features of each line and its neighbours, from the lines' own features alone."""
        weights = self.weights / self.scale
        here, before, after = (own @ weights[i * N_OWN : (i + 1) * N_OWN] for i in range(3))
        first, last = _edges(len(own), begins)
        here += np.where(first, weights[-2], np.roll(before, 1)) + np.where(last, weights[-1], np.roll(after, -1))
        return here + (self.bias - self.mean @ weights)

    def numbers(self) -> tuple:
        """The model as plain arrays and numbers, which an executor can read without this package."""
        return self.mean, self.scale, self.weights, self.bias, self.moves, self.slope, self.shift


def _together(start: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
    """For each step t, the rows that stand t rows after the start of a run longer than t."""
    order = np.argsort(-length, kind="stable")
    start, length = start[order], length[order]
    most = int(length[0]) if len(length) else 0
    alive = np.searchsorted(-length, -np.arange(1, most + 1), "right")
    return [start[: alive[t]] + t for t in range(most)]


def _blocks(begins: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of the blocks of up to ``most`` lines that chains are cut into, and where each chain's blocks begin."""
    length = np.diff(begins)
    count = -(-length // most)
    firsts = np.concatenate([[0], np.cumsum(count)])
    nth = np.arange(firsts[-1]) - np.repeat(firsts[:-1], count)
    start = np.repeat(begins[:-1], count) + nth * most
    return start, np.minimum(np.repeat(begins[1:], count) - start, most), firsts


def _plus(x: np.ndarray, axis: int) -> np.ndarray:
    return np.logaddexp(np.take(x, 0, axis), np.take(x, 1, axis))


def _centred(x: np.ndarray) -> np.ndarray:
    """Chances only hang on differences, so the greatest entry of each row may be 0."""
    return x - x.max(tuple(range(1, x.ndim)), keepdims=True)


def _products(pot: np.ndarray, start: np.ndarray, length: np.ndarray, opens: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """For each block, the log weights from a label before it to a label at its end; a block that opens a chain has nothing before it."""
    order = np.argsort(-length, kind="stable")
    out = np.empty((len(start), 2, 2))
    out[:] = np.where(opens[:, None, None], 0.0, moves) + pot[start][:, None, :]
    alive = np.searchsorted(-length[order], -np.arange(1, int(length.max()) + 1), "right")
    for t in range(1, len(alive)):
        at = order[: alive[t]]
        x = out[at][:, :, :, None] + moves[None, None]  # (block, from, middle, to)
        out[at] = _centred(_plus(x, 2) + pot[start[at] + t][:, None, :])
    return out


def chances(emission: np.ndarray, begins: np.ndarray, moves: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log potentials, forward and backward weights of all lines.

    All chains take a step together. A chain longer than a block is cut: its blocks' matrices are multiplied side by side,
    then the chain steps from block to block, and at last all blocks step from their known edges. So a chain of n lines
    takes about ``2 block + n / block`` steps, and the result is the same.
    """
    pot = np.stack([np.zeros_like(emission), emission], 1)
    fore, back = np.zeros((len(emission), 2)), np.zeros((len(emission), 2))
    start, length, firsts = _blocks(begins, block)
    before, entered = np.zeros((len(start), 2)), np.zeros(len(start), bool)  # weights of the line before a block, if there is one
    if len(start) > len(begins) - 1:
        many = np.flatnonzero(np.diff(firsts) > 1)
        chosen = np.concatenate([np.arange(firsts[c], firsts[c + 1]) for c in many])
        nth = np.concatenate([np.arange(firsts[c + 1] - firsts[c]) for c in many])
        size = np.diff(firsts)[many]
        product = _products(pot, start[chosen], length[chosen], nth == 0, moves)
        steps = _together(np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        end = np.zeros((len(chosen), 2))  # forward weights of a block's last line
        for t, at in enumerate(steps):
            end[at] = _centred(_plus(end[at - 1][:, :, None] + product[at], 1)) if t else product[at][:, 0]
            if t:
                before[chosen[at]], entered[chosen[at]] = end[at - 1], True
        last = start[chosen] + length[chosen] - 1
        for at in reversed(steps[1:]):
            back[last[at - 1]] = _centred(_plus(product[at] + back[last[at]][:, None, :], 2))
    rows_of = _together(start, length)
    for t, rows in enumerate(rows_of):
        if t:
            fore[rows] = _centred(_plus(fore[rows - 1][:, :, None] + moves, 1) + pot[rows])
        else:
            fore[start] = _centred(np.where(entered[:, None], _plus(before[:, :, None] + moves, 1), 0.0) + pot[start])
    for rows in reversed(rows_of[1:]):
        back[rows - 1] = _centred(_plus(moves + (pot[rows] + back[rows])[:, None, :], 2))
    return pot, fore, back


def marginals(emission: np.ndarray, begins: np.ndarray, moves: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Chance of each line to be good, by forward-backward."""
    _, fore, back = chances(emission, begins, moves, block)
    both = fore + back
    return 1 / (1 + np.exp(-np.clip(both[:, 1] - both[:, 0], -500, 500)))


def label_pairs(emission: np.ndarray, begins: np.ndarray, moves: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Chance of each line to be good, and expected numbers of pairs of neighbouring labels over all chains."""
    pot, fore, back = chances(emission, begins, moves, block)
    both = fore + back
    inner = np.ones(len(emission), bool)
    inner[begins[1:] - 1] = False
    here, pairs = np.flatnonzero(inner), np.zeros((2, 2))
    for at in range(0, len(here), 1 << 16):
        rows = here[at : at + (1 << 16)]
        x = np.exp(_centred(fore[rows][:, :, None] + moves + (pot[rows + 1] + back[rows + 1])[:, None, :]))
        pairs += (x / x.sum((1, 2), keepdims=True)).sum(0)
    return 1 / (1 + np.exp(-np.clip(both[:, 1] - both[:, 0], -500, 500))), pairs


def document_odds(model: Model, own: np.ndarray, length: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Log-odds of the length-weighted mean marginal of each text."""
    good = marginals(model.emissions(own, begins), begins, model.moves)
    mean = np.add.reduceat(good * length, begins[:-1]) / np.add.reduceat(length, begins[:-1])
    mean = np.clip(mean, 1e-6, 1 - 1e-6)
    return np.log(mean / (1 - mean))


def fit(features: list[np.ndarray], lengths: list[np.ndarray], labels: np.ndarray, steps: int = STEPS, ridge: float = RIDGE) -> Model:
    """Maximise the penalised likelihood of the line labels by Adam, then fit the logistic curve on document odds."""
    n_features = 3 * N_OWN + 2
    if not len(labels) or len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)  # nothing to tell apart: the same score for all texts
        return Model(np.zeros(n_features), np.ones(n_features), np.zeros(n_features), 0.0, np.zeros((2, 2)), 0.0, float(np.log(share / (1 - share))))
    own, length = np.vstack(features), np.concatenate(lengths)
    begins = np.concatenate([[0], np.cumsum([len(f) for f in features])])
    y = np.repeat(labels, np.diff(begins)).astype(np.float64)
    z = line_features(own, begins)
    mean, scale = z.mean(0, np.float64), z.std(0, np.float64)
    scale[scale < 1e-9] = 1
    z -= mean.astype(np.float32)
    z /= scale.astype(np.float32)
    inner = np.ones(len(y), bool)
    inner[begins[1:] - 1] = False
    here = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[here].astype(int), y[here + 1].astype(int)), 1)
    theta = np.zeros(n_features + 5)
    first, second, lines = np.zeros_like(theta), np.zeros_like(theta), len(y)
    for step in range(1, steps + 1):
        weights, bias, moves = theta[:n_features], theta[n_features], theta[n_features + 1 :].reshape(2, 2)
        good, pairs = label_pairs(z @ weights.astype(np.float32) + bias, begins, moves)
        gap = y - good
        slope = np.concatenate([z.T @ gap.astype(np.float32), [gap.sum()], (seen - pairs).ravel()]) / lines - ridge * theta
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta = theta + 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    model = Model(mean, scale, theta[:n_features], float(theta[n_features]), theta[n_features + 1 :].reshape(2, 2))
    odds, target = document_odds(model, own, length, begins), labels.astype(np.float64)
    a, b = 1.0, 0.0
    for _ in range(25):  # Newton steps for the curve, with a little penalty
        p = 1 / (1 + np.exp(-(a * odds + b)))
        w = p * (1 - p)
        grad = np.array([((target - p) * odds).sum() - 0.1 * (a - 1), (target - p).sum() - 0.1 * b])
        hess = np.array([[(w * odds * odds).sum() + 0.1, (w * odds).sum()], [(w * odds).sum(), w.sum() + 0.1]])
        move = np.linalg.solve(hess, grad)
        a, b = a + float(np.clip(move[0], -1, 1)), b + float(np.clip(move[1], -1, 1))
    model.slope, model.shift = max(a, 1e-3), b
    return model


def held_out(doc_id):
    """Whether a document is kept from training: CRC-32 of its id as text leaves 1 modulo 3. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents that are not held out, the same ones on every run.

    Ids with contradicting labels, and labels other than 0 and 1, are left out; of several texts of one id the
    first in order is taken. What reaches the driver
    is bounded by ``sample`` times ``SAMPLE_LINES`` feature rows.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    usable = usable.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Twice the sample by a hash of the id, of which those are taken that are there and not too long.
    drawn = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * sample).select("doc_id", "quality")
    small = (F.octet_length("text") <= SAMPLE_BYTES) & (F.size(F.split("text", "\n")) <= SAMPLE_LINES)
    rows = texts.join(F.broadcast(drawn), "doc_id").where(small).groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        tables = kept("bytescan", lambda: bytescan._tables(True))
        for part in slices(batch, "text"):
            x, length, begins = own_features([t.encode() for t in part["text"].to_pylist()], tables)
            cut = list(zip(begins[:-1].tolist(), begins[1:].tolist()))
            yield {
                "quality": part["quality"], "x": [x[i:j].tobytes() for i, j in cut], "length": [length[i:j].tobytes() for i, j in cut]
            }

    schema = T.StructType([T.StructField("quality", T.IntegerType()), T.StructField("x", T.BinaryType()), T.StructField("length", T.BinaryType())])
    found = map_batches(rows, run, schema).collect()
    features = [np.frombuffer(r["x"], np.float32).reshape(-1, N_OWN) for r in found]
    lengths = [np.frombuffer(r["length"], np.float64) for r in found]
    return fit(features, lengths, np.array([r["quality"] for r in found], np.int64))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` plus ``score``, the chance that the quality label is 1; a column of that name gives way.

    Only the text is looked at. A null text counts as empty, which is one empty line. Texts of any
    length are scored whole, in time linear in their length; every row gets its own score, repeated rows
    the same one. An empty table gives an empty one. No shuffle.
    """
    names = [c for c in docs.columns if c.lower() != "score"]
    own = docs.select(*[docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(names)], F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in own.schema if f.name != "text"], T.StructField("score", T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(model.numbers())  # a few hundred numbers

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        tables, m = kept("bytescan", lambda: bytescan._tables(True)), Model(*sent.value)
        for part in slices(batch, "text"):
            own, length, begins = own_features([t.encode() for t in part["text"].to_pylist()], tables)
            odds = document_odds(m, own, length, begins)
            yield {f"c{i}": part[f"c{i}"] for i in range(len(names))} | {"score": 1 / (1 + np.exp(-(m.slope * odds + m.shift)))}

    return map_batches(own, run, schema).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "score")


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 if score >= 0.5) of every row of ``docs``."""
    model = train(docs, labels, sample)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
