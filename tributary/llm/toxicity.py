"""Toxicity by multiple-instance learning over sentences (operator 3).

A document is a bag of sentences. A sentence's probability is a logistic function of its words; the
document's is the noisy-or 1 - prod(1 - p). Words and bias are learnt from document labels alone,
by gradient descent on the document likelihood; sentences need no labels. The same sentence
probabilities then locate the offending sentences.

Words are runs of letters and digits, A-Z lower-cased; sentences end at ``.``, ``!``, ``?`` or a line
end. A word's features are itself and its first 4 to 8 bytes, as insults are inflected and
compounded. Only features whose document frequencies in the two classes differ by more than
``min_z`` standard errors are weighted. The sample holds at most ``max_rows`` labelled rows; scoring reads
whole texts of all rows. Null and empty texts have no sentence and score 0. Without any positive or
any negative label every score is 0. Repeated rows get equal scores; rows with a null id are scored as they come.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import held_out, training_sample

MAX_ROWS = 8000
_PLAIN = bytearray(range(256))
for _c in range(128):
    if chr(_c) in ".!?\n":
        _PLAIN[_c] = 10
    elif not chr(_c).isalnum():
        _PLAIN[_c] = 32
    else:
        _PLAIN[_c] = ord(chr(_c).lower())
_PLAIN = bytes(_PLAIN)


PREFIXES = (4, 5, 6, 7, 8)


class Model(NamedTuple):
    """Weights of features and the bias of a sentence."""

    weights: dict[bytes, float]
    bias: float


def _features(word: bytes) -> list[bytes]:
    """The word, and its first bytes as stems that inflected or compounded words share."""
    return [word, *[word[:n] + b"*" for n in PREFIXES if len(word) > n]]


class _WordWeights(dict):
    """Weight of a word: the sum of its features' weights, kept once computed, within a bound."""

    def __init__(self, weights: dict[bytes, float], bound: int = 300_000) -> None:
        super().__init__()
        self.weights, self.bound = weights, bound

    def __missing__(self, word: bytes) -> float:
        if len(self) >= self.bound:
            self.clear()
        get = self.weights.get
        self[word] = found = sum(get(f, 0.0) for f in _features(word))
        return found


def _sentences(text: str | None) -> list[list[bytes]]:
    plain = (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN)
    return [words for words in map(bytes.split, plain.split(b"\n")) if words]


def _telling(texts: list[str], y: np.ndarray, min_z: float, min_docs: int) -> list[bytes]:
    """Features whose document frequencies in the classes differ clearly."""
    seen, toxic = Counter(), Counter()
    for text, label in zip(texts, y):
        bag = {f for words in _sentences(text) for w in words for f in _features(w)}
        seen.update(bag)
        if label:
            toxic.update(bag)
    n1, n = int(y.sum()), len(y)
    out = []
    for feature, count in seen.items():
        if count >= min_docs:
            share, a = count / n, toxic[feature] / n1
            b = (count - toxic[feature]) / (n - n1)
            if abs(a - b) > min_z * (share * (1 - share) * (1 / n1 + 1 / (n - n1))) ** 0.5:
                out.append(feature)
    return sorted(out)


def fit(texts: list[str], y: np.ndarray, *, min_z: float = 4.0, min_docs: int = 5, steps: int = 300,
        rate: float = 0.1, decay: float = 1e-4) -> Model:
    """Weights that maximise the noisy-or likelihood of document labels (Adam, whole batch)."""
    y = np.asarray(y, bool)
    if not y.any() or y.all():
        return Model({}, -60.0)
    names = _telling(texts, y, min_z, min_docs)
    number = {f: i for i, f in enumerate(names)}
    doc_of, sentence, feature = array("q"), array("q"), array("q")
    for d, text in enumerate(texts):
        for words in _sentences(text):
            for f in [number[f] for w in set(words) for f in _features(w) if f in number]:
                sentence.append(len(doc_of))
                feature.append(f)
            doc_of.append(d)
    doc_of, sentence, feature = (np.array(x, np.int64) for x in (doc_of, sentence, feature))
    theta = np.zeros(len(names) + 1)
    theta[-1] = -4.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        z = theta[-1] + np.bincount(sentence, theta[feature], minlength=len(doc_of))
        total = np.bincount(doc_of, np.logaddexp(0, z), minlength=len(y))
        # d loss / d total: 1 for a clean document, -1 / (exp(total) - 1) for a toxic one
        slope = np.where(y, -1 / np.expm1(np.clip(total, 1e-6, 50)), 1.0) / len(y)
        g = slope[doc_of] / (1 + np.exp(-z))
        grad = np.append(np.bincount(feature, g[sentence], minlength=len(names)) + decay * theta[:-1], g.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        theta -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-9)
    return Model({f: float(x) for f, x in zip(names, theta) if abs(x) > 1e-3}, float(theta[-1]))


def sentence_logits(text: str | None, bias: float, weights: _WordWeights) -> list[float]:
    get = weights.__getitem__
    return [bias + sum(map(get, set(words))) for words in _sentences(text)]


def judged(text: str | None, model: Model, weights: _WordWeights) -> tuple[float, int | None, float | None]:
    """Score of a document, and place and probability of its worst sentence (the first of equal ones)."""
    logits = sentence_logits(text, model.bias, weights) if text and model.weights else []
    if not logits:
        return 0.0, None, None
    worst = int(np.argmax(logits))
    return float(-np.expm1(-np.logaddexp(0, logits).sum())), worst, float(1 / (1 + np.exp(-logits[worst])))


def trained(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", max_rows: int = MAX_ROWS,
            **options: float) -> Model:
    sample = training_sample(docs, labels, label, max_rows).collect()
    return fit([r["text"] for r in sample], np.array([r["y"] for r in sample]), **options)


def scored(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, worst_sentence, worst_probability) of whole texts; the last two are null without a sentence."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = _WordWeights(model.weights)
        for frame in frames:
            found = [judged(t, model, weights) for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "score": [f[0] for f in found],
                                "worst_sentence": pd.array([f[1] for f in found], dtype="Int32"),
                                "worst_probability": pd.array([f[2] for f in found], dtype="Float64")})

    return docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(
        run, "doc_id string, score double, worst_sentence int, worst_probability double").withColumn("doc_id", F.col("doc_id").cast("long"))


def offending_sentences(docs: DataFrame, model: Model, *, threshold: float = 0.5, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """(doc_id, sentence, probability, text) of the sentences at or above ``threshold``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = _WordWeights(model.weights)
        for frame in frames:
            rows = []
            for number, text in zip(frame["doc_id"], frame["text"]):
                raw = (text or "").encode("utf-8", "surrogatepass")
                spans, at = [], 0
                for piece in raw.translate(_PLAIN).split(b"\n"):
                    if piece.split():
                        spans.append(raw[at:at + len(piece)])
                    at += len(piece) + 1
                for i, (z, span) in enumerate(zip(sentence_logits(text, model.bias, weights), spans)):
                    p = float(1 / (1 + np.exp(-z)))
                    if p >= threshold:
                        rows.append((number, i, p, span.decode("utf-8", "replace").strip()))
            yield pd.DataFrame(rows, columns=["doc_id", "sentence", "probability", "text"])

    return docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(
        run, "doc_id string, sentence int, probability double, text string").withColumn(
        "doc_id", F.col("doc_id").cast("long"))


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    """Noisy-or toxicity of every document and its worst sentence, learnt from the labels that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs, model).select("doc_id", held_out().alias("held_out"), "score",
                                      (F.col("score") >= 0.5).cast("int").alias("predicted"),
                                      "worst_sentence", "worst_probability")
