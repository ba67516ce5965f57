"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded as a vector; gated attention weighs the
passages; the weighted sum is scored. Only documents have labels, so the attention learns from them
which passages decide.

    a_k = softmax_k( w . (tanh(V h_k) * sigmoid(U h_k)) ),   score = sigmoid( c . sum_k a_k h_k + b )
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shoptrail.llm.common import add_columns, id_remainder, slices, texts_of

#: Words of a passage.
PASSAGE_WORDS = 64
#: Learning takes at most this many labelled rows of each label, those with the smallest digests of id and text, with
#: all their passages. Scoring takes all passages of all texts.
DOCUMENTS_PER_LABEL = 2_000
THRESHOLD = 0.3
HIDDEN = 16
EPOCHS = 40
DECAY = 5e-3

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: Classes of bytes whose shares describe a passage.
_CLASSES = ("upper", "lower", "digit", "mark", "symbol", "break", "high")
_HASHED = 24
FEATURES = len(_CLASSES) + 6 + _HASHED


def _byte_table() -> np.ndarray:
    table = np.full(256, -1)
    for code in range(256):
        char = chr(code)
        if code >= 128:
            table[code] = 6
        elif char.isupper():
            table[code] = 0
        elif char.islower():
            table[code] = 1
        elif char.isdigit():
            table[code] = 2
        elif char in ".,;:'\"-?()":
            table[code] = 3
        elif char == "\n":
            table[code] = 5
        elif not char.isspace() and code > 32:
            table[code] = 4
    return table


_TABLE = _byte_table()


def encode(text: str | None) -> np.ndarray:
    """Vectors of a text's passages, one row for 64 words; one row of zeros without words."""
    words = _WORDS.findall(text or "")
    if not words:
        return np.zeros((1, FEATURES), np.float32)
    rows = []
    for begin in range(0, len(words), PASSAGE_WORDS):
        part = words[begin : begin + PASSAGE_WORDS]
        joined = " ".join(part)
        data = np.frombuffer(joined.encode("utf-8", "replace"), np.uint8)
        kinds = np.bincount(_TABLE[data] + 1, minlength=len(_CLASSES) + 1)[1:]
        upper = sum(map(str.isupper, part))
        same = sum(a == b for a, b in zip(part, part[1:]))
        few = len(part) / PASSAGE_WORDS
        pairs = (data[:-1].astype(np.int64) * 31 + data[1:]) % _HASHED
        rows.append(
            np.concatenate(
                [
                    kinds / len(data),
                    [len(set(part)) / len(part), same / len(part), upper / len(part), few, len(data) / len(part) / 10, min(1.0, len(data) / 2_000)],
                    np.bincount(pairs, minlength=_HASHED) / max(1, len(pairs)),
                ]
            )
        )
    return np.asarray(rows, np.float32)


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def standard(self, passages: np.ndarray) -> np.ndarray:
        """Features in standard units; what lies far out is brought in, so no rare feature decides alone."""
        return np.clip((passages - self.mean) / self.scale, -3, 3)

    def attention(self, h: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, ...]:
        w = self.weights
        gate, hidden = 1 / (1 + np.exp(-np.clip(h @ w["U"], -30, 30))), np.tanh(h @ w["V"])
        energy = (gate * hidden) @ w["w"]
        sizes = np.diff([*begins, len(h)])
        energy = np.exp(energy - np.repeat(np.maximum.reduceat(energy, begins), sizes))
        share = energy / np.repeat(np.add.reduceat(energy, begins), sizes)
        return share, gate, hidden, sizes

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        begins = np.cumsum([0, *map(len, bags)])[:-1]
        h = self.standard(np.concatenate(bags))
        share, *_ = self.attention(h, begins)
        z = np.add.reduceat(share[:, None] * h, begins)
        return 1 / (1 + np.exp(-np.clip(z @ self.weights["c"] + self.weights["b"], -30, 30)))


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 7, epochs: int = EPOCHS) -> Model:
    """Minimise log loss by Adam on batches of bags; both labels weigh as they occur."""
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags) if bags else np.zeros((1, FEATURES), np.float32)
    mean, scale = every.mean(axis=0), every.std(axis=0) + 1e-3
    weights = {
        "V": rng.normal(0, 0.2, (FEATURES, HIDDEN)), "U": rng.normal(0, 0.2, (FEATURES, HIDDEN)),
        "w": rng.normal(0, 0.2, HIDDEN), "c": np.zeros(FEATURES), "b": np.zeros(()),
    }
    model = Model(mean, scale, weights)
    if not bags:
        return model
    first, second = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), 64):
            chosen = order[at : at + 64]
            part = [bags[i] for i in chosen]
            begins = np.cumsum([0, *map(len, part)])[:-1]
            h = model.standard(np.concatenate(part))
            share, gate, hidden, sizes = model.attention(h, begins)
            z = np.add.reduceat(share[:, None] * h, begins)
            out = 1 / (1 + np.exp(-np.clip(z @ weights["c"] + weights["b"], -30, 30)))
            wrong = (out - labels[chosen]) / len(chosen)
            per_row = np.repeat(wrong, sizes)
            pull = h @ weights["c"] - np.repeat(z @ weights["c"], sizes)
            d_energy = per_row * share * pull
            d_joint = d_energy[:, None] * weights["w"]
            grads = {
                "c": z.T @ wrong + DECAY * weights["c"], "b": wrong.sum(),
                "w": (gate * hidden).T @ d_energy,
                "V": h.T @ (d_joint * gate * (1 - hidden**2)), "U": h.T @ (d_joint * hidden * gate * (1 - gate)),
            }
            step += 1
            for name, grad in grads.items():
                first[name] = 0.9 * first[name] + 0.1 * grad
                second[name] = 0.999 * second[name] + 0.001 * grad**2
                weights[name] = weights[name] - 0.01 * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
    return model


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id", per_label: int = DOCUMENTS_PER_LABEL) -> Model:
    """Fit on a bounded sample: up to ``per_label`` rows of each label, those with the smallest
    digests of their ids (then texts), whole. Passages are encoded in tasks. Null labels and ids do not count; of several
    labels of an id the lowest counts. The classes' shares among all labelled documents are kept by a
    shift of the bias, so scores are probabilities for the whole corpus."""
    known = labels.where(F.col("quality").isNotNull() & F.col(id_column).isNotNull()).groupBy(id_column).agg(
        (F.min("quality") > 0).cast("int").alias("label")
    )
    totals = {row["label"]: row["n"] for row in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    # Ids first: a top-n per label, of which each task sends its n smallest. Then rows: an id may repeat without bound.
    digest = F.xxhash64(F.lit(11), id_column)
    picked = None
    for label in (0, 1):
        top = known.where(F.col("label") == label).orderBy(digest, id_column).limit(per_label)
        picked = top if picked is None else picked.unionByName(top)
    joined = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).join(picked.withColumnRenamed(id_column, "id"), "id")
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64(F.lit(11), "id"), "id", F.xxhash64("text")))
    # The window keeps ``per_label`` rows of each task before the shuffle.
    sample = joined.withColumn("place", place).where(F.col("place") <= per_label).select("place", "label", "text")

    def bags_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 256):
            bags = pa.array([encode(x).tobytes() for x in texts_of(part.column(2))], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), bags], names=["place", "label", "bag"])

    rows = sample.mapInArrow(bags_of, "place int, label int, bag binary").toPandas().sort_values(["place", "label"])
    bags = [np.frombuffer(x, np.float32).reshape(-1, FEATURES) for x in rows["bag"]]
    y = rows["label"].to_numpy(np.float64)
    model = fit(bags, y)
    got = {label: max(1, int((y == label).sum())) for label in (0, 1)}
    if len(totals) == 2:
        shift = np.log(totals[1] / totals[0]) - np.log(got[1] / got[0])
        model.weights["b"] = model.weights["b"] + shift
    return model


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Add ``score`` (0 to 1, higher: better) and ``predicted`` (1 if score >= ``threshold``).

    Whole texts, null and empty ones as one passage without words. Columns of ``docs`` with these names
    are replaced. Rows are scored alone, so repeated ones have one score; no shuffle. The model, some thousand numbers, is broadcast.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable:
        held = sent.value

        def scored(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            values = held.scores([encode(x) for x in texts_of(column)])
            return values, (values >= threshold).astype("int32")

        return scored

    return add_columns(docs, [text], {"score": ("double", pa.float64()), "predicted": ("int", pa.int32())}, make)


def classify(docs: DataFrame, labels: DataFrame, parts: int = 5, held_out: int = 0) -> DataFrame:
    """Learn from labels outside the held-out fold and score all documents:
    (doc_id, held_out, score, predicted)."""
    model = learn(docs, labels.where(id_remainder("doc_id", parts) != held_out))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (id_remainder("doc_id", parts) == held_out).alias("held_out"), "score", "predicted")
