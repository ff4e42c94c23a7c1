"""Quality by a factorisation machine over hashed words and structure.

score = sigmoid(b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j).  The pairwise part is
computed in time linear in the features, as half the sum over factors of
(sum v_if x_i)^2 - sum (v_if x_i)^2.  The model is fitted in the driver on a bounded sample
of labelled rows and has a fixed size; scoring is one pass without a shuffle.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, keyed_texts, slices

WORD_SPACE = 1 << 16
BINS = 16
# Upper edges of equal steps; each statistic is scaled to 0..1 first.
STATS = (
    "letters", "upper", "digits", "blanks", "symbols", "non_ascii", "word_length", "words", "lines", "line_length",
    "repeated_lines", "repeated_words", "commonest_word", "sentence_ends",
)
SPACE = WORD_SPACE + len(STATS) * BINS
MAX_LABELLED = 4096
THRESHOLD = 0.3

_CLASS = np.zeros((256, 6), np.int64)
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = (
        _b < 128 and _c.isalpha(), _b < 128 and _c.isupper(), _b < 128 and _c.isdigit(), _c in " \t\r\n",
        32 < _b < 127 and not _c.isalnum() and _c not in ".,", _b >= 128,
    )


def _stats(raw: bytes, lines: list[str], words: list[str], counts: Counter) -> list[float]:
    n, n_words = max(1, len(raw)), max(1, len(words))
    letters, upper, digits, blanks, symbols, non_ascii = (np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASS).tolist()
    top = counts.most_common(1)
    return [
        letters / n, upper / max(1, letters), digits / n, blanks / n, symbols / n, non_ascii / n,
        n / n_words / 24, np.log2(1 + len(words)) / 20, np.log2(1 + len(lines)) / 16, np.log2(n / len(lines)) / 16 if raw else 0,
        1 - len(set(lines)) / len(lines), 1 - len(counts) / n_words, top[0][1] / n_words if top else 0,
        4 * sum(w.endswith((".", "!", "?")) for w in words) / n_words,
    ]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values: words by hash (damped counts of unit length) and one bin per
    statistic.  An empty text has no words and its own bins."""
    text = text or ""
    raw, lines, words = text.encode(), text.split("\n"), text.lower().split()
    counts = Counter(words)
    slots = np.fromiter((zlib.crc32(w.encode()) % WORD_SPACE for w in counts), np.int64, len(counts))
    values = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    slots, place = np.unique(slots, return_inverse=True)  # words that share a slot are one feature
    values = np.bincount(place, values, len(slots))
    values = values / max(1e-12, np.sqrt(values @ values))
    bins = np.clip(np.array(_stats(raw, lines, words, counts)) * BINS, 0, BINS - 1).astype(np.int64)
    return np.concatenate([slots, WORD_SPACE + BINS * np.arange(len(STATS)) + bins]), np.concatenate([values, np.full(len(STATS), 0.5)])


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margins(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """b + w.x + pairs for rows laid end to end (each has at least one feature)."""
        vx = self.factors[index] * value[:, None]
        total = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat((vx * vx).sum(axis=1), starts)
        return self.bias + np.add.reduceat(self.linear[index] * value, starts) + 0.5 * ((total * total).sum(axis=1) - squares)


    def scores(self, texts: list[str | None]) -> np.ndarray:
        found = [features(t) for t in texts]
        sizes = np.array([len(f[0]) for f in found])
        index, value = (np.concatenate(x) for x in zip(*found))
        return sigmoid(self.margins(index, value, np.cumsum(sizes) - sizes))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, weights: np.ndarray, rank: int = 8, epochs: int = 12,
    batch: int = 64, rate: float = 0.08, decay: float = 1e-4, seed: int = 7,
) -> Machine:
    """Weighted logistic loss by AdaGrad over small batches; the same rows give the same model."""
    rng = np.random.default_rng(seed)
    machine = Machine(0.0, np.zeros(SPACE), rng.normal(0, 0.05, (SPACE, rank)))
    seen = np.full((SPACE, rank + 1), 1e-6)
    seen_bias = 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            chosen = order[at : at + batch]
            sizes = np.array([len(rows[k][0]) for k in chosen])
            starts = np.cumsum(sizes) - sizes
            index = np.concatenate([rows[k][0] for k in chosen])
            value = np.concatenate([rows[k][1] for k in chosen])
            error = (sigmoid(machine.margins(index, value, starts)) - labels[chosen]) * weights[chosen] / len(chosen)
            vx = machine.factors[index] * value[:, None]
            total = np.add.reduceat(vx, starts, axis=0)
            each = np.repeat(error, sizes) * value
            step = np.concatenate([each[:, None], each[:, None] * (np.repeat(total, sizes, axis=0) - vx)], axis=1)
            touched, where = np.unique(index, return_inverse=True)
            grad = np.stack([np.bincount(where, step[:, f], len(touched)) for f in range(rank + 1)], axis=1)
            own = np.concatenate([machine.linear[touched, None], machine.factors[touched]], axis=1)
            grad += decay * own
            seen[touched] += grad * grad
            own -= rate * grad / np.sqrt(seen[touched])
            machine.linear[touched], machine.factors[touched] = own[:, 0], own[:, 1:]
            seen_bias += error.sum() ** 2
            machine.bias -= rate * error.sum() / np.sqrt(seen_bias)
    return machine


def held_out(doc_id) -> F.Column:
    """Rows whose labels are never learned."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def train(
    docs: DataFrame, labels: DataFrame, max_rows: int = MAX_LABELLED, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality",
) -> Machine:
    """Fit on at most ``max_rows`` labelled rows that aren't held out, half of it per class.

    Of each class the rows with the smallest hashed ids are taken and weighted to the class's
    share of all such labels.  The sampled labels (``max_rows`` ids) are broadcast, so texts
    aren't shuffled but for those of sampled ids; their features come to the driver: one row
    an id, at most ``SPACE`` numbers each.  Null ids and labels are left out, an id with both
    labels counts as 0, of several texts of an id the least one counts.  With one class or none the score
    is that class's smoothed share everywhere.
    """
    usable = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    usable = usable.dropna().where(F.col("y").isin(0, 1) & ~held_out("doc_id")).groupBy("doc_id").agg(F.min("y").alias("y"))
    totals = {r["y"]: r["n"] for r in usable.groupBy("y").agg(F.count("*").alias("n")).collect()}
    picked = None
    for y in (0, 1):
        some = usable.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows // 2)
        picked = some if picked is None else picked.unionByName(some)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            found = [features(t) for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), batch.column("y"), pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "y", "index", "value"])

    texts = keyed_texts(docs, id_col, text_col).join(F.broadcast(picked), "doc_id")
    texts = texts.groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    sampled = texts.mapInArrow(run, "doc_id long, y int, index array<long>, value array<double>").toArrow()
    sampled = sampled.sort_by([("doc_id", "ascending")])
    y = sampled.column("y").to_numpy().astype(float)
    share = (totals.get(1, 0) + 1) / (sum(totals.values()) + 2)
    if len(np.unique(y)) < 2:
        return Machine(float(np.log(share / (1 - share))), np.zeros(SPACE), np.zeros((SPACE, 1)))
    # Views of the received buffers: boxed numbers would take the driver several times their size.
    index, value = (sampled.column(c).combine_chunks() for c in ("index", "value"))
    ends, index, value = index.offsets.to_numpy(), index.values.to_numpy(), value.values.to_numpy()
    rows = [(index[a:b], value[a:b]) for a, b in zip(ends, ends[1:])]
    sizes = np.array([(y == 0).sum(), (y == 1).sum()])
    weights = np.array([totals[0], totals[1]]) / sizes
    weights *= len(y) / (totals[0] + totals[1])
    return fit(rows, y, weights[y.astype(int)])


def score(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and predicted of every row; only the text is looked at.

    The model (4.7 MB at rank 8, whatever the corpus) goes to the workers as a broadcast
    variable.  Null texts score like empty ones; null ids and repeated rows come back as
    they are.
    """
    model = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.linear, machine.factors))
    schema = arrow_schema("doc_id long, score double, predicted int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Machine(*model.value)
        for batch in slices(batches, 128):
            p = own.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], schema=schema)

    texts = keyed_texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return texts.mapInArrow(run, "doc_id long, score double, predicted int")


def accepted(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text scores ``threshold`` or more.

    Rows are judged where they are read, so nothing is shuffled and ids play no part.
    """
    model = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.linear, machine.factors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Machine(*model.value)
        for batch in slices(batches, 128):
            yield batch.filter(pa.array(own.scores(batch.column(text_col).to_pylist()) >= threshold))

    return docs.mapInArrow(run, docs.schema)
