"""Quality by attention-based multiple-instance learning over passages (operator 5).

A document is a bag of passages of ``PASSAGE`` words. Every passage is encoded: measured (kinds of
characters, word lengths, repeated words, line and sentence ends), standardised, and passed through
a tanh layer to h. Gated attention weighs it by a = softmax(w . (tanh(V h) * sigmoid(U h))), and a
logistic unit scores sum(a h). All weights are learnt from document labels by back propagation.

The sample holds at most ``max_rows`` labelled rows; scoring reads whole texts of all rows. Null
and empty texts are one passage without words. With labels of one kind only, every score is their
share. Repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import word_hashes
from .labelled import held_out, training_sample

PASSAGE, HIDDEN, GATE, MAX_ROWS = 64, 16, 8, 8000
KINDS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:", "!?", "#*$%&", "|", "<>=",
         "\n", " \t\r\v\f"]
_KIND = np.full(256, len(KINDS), np.uint8)  # other ASCII
_KIND[128:] = len(KINDS) + 1
for _k, _chars in enumerate(KINDS):
    for _c in _chars:
        _KIND[ord(_c)] = _k
N_KINDS = len(KINDS) + 2
FEATURES = N_KINDS + 8


def passages(text: str | None) -> np.ndarray:
    """One row of measures per passage."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    starts, ends, hashes = word_hashes(text)
    n = len(starts)
    if not n:
        return np.zeros((1, FEATURES))
    first = np.arange(0, n, PASSAGE)
    count, words = len(first), np.diff(np.append(first, n))
    edges = np.append(starts[first], len(data))
    edges[0] = 0
    sizes = np.diff(edges)
    kinds = np.bincount(np.repeat(np.arange(count) * N_KINDS, sizes) + _KIND[data],
                        minlength=count * N_KINDS).reshape(count, N_KINDS) / sizes[:, None]
    of = np.arange(n) // PASSAGE
    order = np.lexsort((hashes, of))
    fresh = np.ones(n, bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (of[order][1:] != of[order][:-1])
    distinct = np.bincount(of[order], fresh, minlength=count) / words
    again = np.zeros(n, bool)
    again[1:] = hashes[1:] == hashes[:-1]
    length = (ends - starts).astype(float)
    mean = np.add.reduceat(length, first) / words
    spread = np.sqrt(np.maximum(np.add.reduceat(length ** 2, first) / words - mean ** 2, 0))
    last = _KIND[data[ends - 1]]
    odd_end = np.add.reduceat(np.isin(last, (5, 6, 7)).astype(float), first) / words
    whole = len(np.unique(hashes)) / n
    return np.column_stack((kinds, distinct, np.add.reduceat(again.astype(float), first) / words, mean / 10, spread / 10,
                            odd_end, np.full(count, whole), np.log1p(words) / 4, np.full(count, np.log1p(n) / 10)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


class Model:
    """Standardisation, passage encoder, gated attention and the document unit."""

    def __init__(self, shift: np.ndarray, scale: np.ndarray, seed: int = 0) -> None:
        draw = np.random.default_rng(seed)
        self.shift, self.scale = shift, scale
        self.p = {"E": draw.normal(0, FEATURES ** -0.5, (FEATURES, HIDDEN)), "e": np.zeros(HIDDEN),
                  "V": draw.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)), "U": draw.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)),
                  "w": draw.normal(0, GATE ** -0.5, GATE), "c": draw.normal(0, HIDDEN ** -0.5, HIDDEN), "b": np.zeros(1)}

    def forward(self, x: np.ndarray, bag: np.ndarray, n: int) -> dict[str, np.ndarray]:
        """Everything backward needs; ``bag`` numbers each passage's document, in order."""
        p = self.p
        x = np.clip((x - self.shift) / self.scale, -8, 8)
        h = np.tanh(x @ p["E"] + p["e"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        s = (t * g) @ p["w"]  # bounded by |w|, so exp is safe without a maximum per bag
        a = np.exp(np.clip(s, -50, 50))
        a /= np.bincount(bag, a, minlength=n)[bag]
        starts = np.searchsorted(bag, np.arange(n))
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "y": _sigmoid(z @ p["c"] + p["b"]), "starts": starts}

    def gradients(self, f: dict[str, np.ndarray], bag: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, len(y)
        d = (f["y"] - y) / n
        dz = d[:, None] * p["c"]
        per = (dz[bag] * f["h"]).sum(axis=1)
        mean = np.bincount(bag, f["a"] * per, minlength=n)
        ds = f["a"] * (per - mean[bag])
        dt = ds[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2)
        dg = ds[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T
        du = dh * (1 - f["h"] ** 2)
        return {"E": f["x"].T @ du, "e": du.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ dg,
                "w": (f["t"] * f["g"]).T @ ds, "c": f["z"].T @ d, "b": np.array([d.sum()])}


def fit(texts: list[str], y: np.ndarray, *, steps: int = 400, rate: float = 0.02, decay: float = 1e-4) -> Model | float:
    """Model of the labels; their share where they are all alike (0.5 without any)."""
    y = np.asarray(y, float)
    if not len(y) or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.5
    bags = [passages(t) for t in texts]
    x, bag = np.concatenate(bags), np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    model = Model(x.mean(axis=0), x.std(axis=0) + 1e-3)
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    for step in range(1, steps + 1):
        grads = model.gradients(model.forward(x, bag, len(y)), bag, y)
        for k, g in grads.items():
            g = g + decay * model.p[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            model.p[k] = model.p[k] - rate * (first[k] / (1 - 0.9 ** step)) / (
                np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-9)
    return model


def score_texts(texts: list[str | None], model: Model | float) -> np.ndarray:
    if isinstance(model, float) or not texts:
        return np.full(len(texts), model if isinstance(model, float) else 0.0)
    bags = [passages(t) for t in texts]
    bag = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    return model.forward(np.concatenate(bags), bag, len(bags))["y"]


def trained(docs: DataFrame, labels: DataFrame, *, label: str = "quality", max_rows: int = MAX_ROWS,
            **options: float) -> Model | float:
    sample = training_sample(docs, labels, label, max_rows).collect()
    return fit([r["text"] for r in sample], np.array([r["y"] for r in sample]), **options)


def scored(docs: DataFrame, model: Model | float, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of whole texts."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in (frame.iloc[at:at + 256] for at in range(0, len(frame), 256)):
                yield pd.DataFrame({"doc_id": part["doc_id"].array,
                                    "score": score_texts(part["text"].tolist(), model)})

    return docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(
        run, "doc_id string, score double").withColumn("doc_id", F.col("doc_id").cast("long"))


def op5_passage_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from the labels that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs, model).select("doc_id", held_out().alias("held_out"), "score",
                                      (F.col("score") >= 0.3).cast("int").alias("predicted"))
