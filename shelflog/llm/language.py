"""Language identification: sparse logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflog.llm.common import append_column, column, slices
from shelflog.llm.training import Parameters, averaged_rounds
from shelflog.session import materialize

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SAMPLE_PER_LANGUAGE, SAMPLE = 1500, 8000
SHARDS, ROUNDS, EPOCHS = 4, 2, 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.3, 1.0
UNKNOWN = "und"

PREDICTION = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of the whole text in small letters: buckets and counts."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    total = np.zeros(BUCKETS, np.int64)
    gram = np.zeros(len(codes), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        if len(codes) < order:
            break
        n = len(codes) - order + 1
        gram = (gram[:n] * np.uint64(0x9E3779B97F4A7C15)) + codes[order - 1 :] + np.uint64(1)
        if order in ORDERS:
            mixed = (gram + np.uint64(order)) * np.uint64(0xD6E8FEB86659FD93)
            total += np.bincount((mixed >> np.uint64(48)).astype(np.int64), minlength=BUCKETS)
    at = np.flatnonzero(total)
    return at, total[at]


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float

    def predict(self, texts: list[bytes | None]) -> list[dict]:
        return [self.one(None if t is None else t.decode("utf-8", "replace")) for t in texts]

    def one(self, text: str | None) -> dict:
        if not self.languages or not has_letter(text):
            return {"lang": UNKNOWN, "score": 0.0}
        at, x = tf_idf(*gram_counts(text), self.idf)
        p = softmax((x @ self.weights[at] + self.bias) / self.temperature)
        best = int(p.argmax())
        return {"lang": self.languages[best], "score": min(1.0, float(p[best]))}


def tf_idf(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = (1 + np.log(counts)) * idf[at]
    return at, x / max(1e-12, math.sqrt(float(x @ x)))


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _weights(p: Parameters, at=slice(None)) -> np.ndarray:
    """The closed form of follow-the-regularised-leader: exact zeros below L1."""
    z, n = p["z"][at], p["n"][at]
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _bags(pdf: pd.DataFrame, idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    return [
        tf_idf(np.frombuffer(a, np.int32).astype(np.int64), np.frombuffer(c, np.int32), idf)
        for a, c in zip(pdf["buckets"], pdf["counts"])
    ]


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """How many of all ``rows`` hold each bucket, and the number of rows.

    Each task adds up its rows; the sums meet by bucket, so the driver gets one number per
    bucket whatever the input.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                for text in part.column(0).to_pylist():
                    seen[gram_counts(text)[0]] += 1
                    seen[BUCKETS] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int64()), "docs": pa.array(seen[at], pa.int64())})

    counted = rows.select("text").mapInArrow(count, "bucket long, docs long").groupBy("bucket").agg(F.sum("docs").alias("docs"))
    found = np.zeros(BUCKETS + 1, np.int64)
    for row in counted.collect():
        found[row.bucket] = row.docs
    return found[:BUCKETS], int(found[BUCKETS])


def fit_language(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
    sample: int = SAMPLE,
) -> LanguageModel:
    """Fit on the rows of ``docs`` that have a language and a text with a letter.

    Document frequencies cover all of these rows. The regression is fitted on a bounded
    sample: the rows with the least hashes, at most ``sample_per_language`` of a language and
    ``sample`` in all. Of the sample's five shards four are trained on (follow the
    regularised leader, L1 and L2 penalties, states averaged after each round); the fifth
    sets the temperature that makes the scores probabilities.
    """
    rows = docs.select(
        column(id_col).alias("doc_id"), column(text_col).alias("text"), column(lang_col).cast("string").alias("lang")
    ).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    frequency, n_docs = document_frequencies(rows)
    idf = np.log((1 + n_docs) / (1 + frequency)) + 1
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    in_language = Window.partitionBy("lang").orderBy(*order)
    chosen = (
        rows.where("doc_id is not null").select("doc_id", "lang")
        .withColumn("rank", F.row_number().over(in_language))
        .where(F.col("rank") <= sample_per_language)
        .orderBy("rank", *order)
        .limit(sample)
        .select("doc_id", "lang")
        .distinct()
    )

    def make():
        def work(texts):
            grams = [gram_counts(t.decode("utf-8", "replace")) for t in texts]
            return [{"buckets": a.astype(np.int32).tobytes(), "counts": c.astype(np.int32).tobytes()} for a, c in grams]

        return work

    kind = T.StructType([T.StructField("buckets", T.BinaryType()), T.StructField("counts", T.BinaryType())])
    taken = rows.join(F.broadcast(chosen), ["doc_id", "lang"])
    shard = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SHARDS + 1))
    features = materialize(
        append_column(taken, "text", "grams", kind, make).select("doc_id", "lang", "grams.*", shard.alias("shard")),
        "language-sample",
    )
    languages = sorted(r.lang for r in features.select("lang").distinct().collect())
    k = len(languages)
    if not k:
        return LanguageModel([], idf, np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    number = {name: i for i, name in enumerate(languages)}

    def train(p: Parameters, pdf: pd.DataFrame, turn: int) -> Parameters:
        pdf = pdf.sort_values(["doc_id", "lang"], kind="stable")
        bags, labels = _bags(pdf, idf), [number[name] for name in pdf["lang"]]
        rng = np.random.default_rng(turn)
        for _ in range(EPOCHS):
            for i in rng.permutation(len(bags)):
                at, x = np.append(bags[i][0], BUCKETS), np.append(bags[i][1], 1.0)
                w = _weights(p, at)
                error = softmax(x @ w)
                error[labels[i]] -= 1
                g = np.outer(x, error)
                n = p["n"][at]
                grown = n + g * g
                p["z"][at] += g - (np.sqrt(grown) - np.sqrt(n)) / ALPHA * w
                p["n"][at] = grown
        return p

    start = {"z": np.zeros((BUCKETS + 1, k)), "n": np.zeros((BUCKETS + 1, k))}
    w = _weights(averaged_rounds(features.where(F.col("shard") < SHARDS), start, train, ROUNDS))
    weights, bias = w[:BUCKETS], w[BUCKETS]

    def calibrate(pdf: pd.DataFrame) -> pd.DataFrame:
        logits = np.array([x @ weights[at] + bias for at, x in _bags(pdf, idf)])
        labels = np.array([number[name] for name in pdf["lang"]])

        def loss(log_t: float) -> float:
            p = softmax(logits / math.exp(log_t))
            return -float(np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-300)).mean())

        grid = np.linspace(-4, 4, 161)
        return pd.DataFrame({"temperature": [math.exp(min(grid, key=loss))]})

    found = features.where(F.col("shard") == SHARDS).groupBy("shard").applyInPandas(calibrate, "temperature double").first()
    return LanguageModel(languages, idf, weights.astype(np.float32), bias, found.temperature if found else 1.0)


def identify_language(docs: DataFrame, model: LanguageModel, text_col: str = "text", name: str = "language") -> DataFrame:
    """``docs`` with a struct column ``name``: lang and its calibrated probability.

    The model has a fixed size (buckets times languages) and goes to every task; documents
    don't shuffle. Only the text is read, all of it.

    Cases: a null text and a text without a letter are ``und`` with score 0, as is every text
    when nothing could be learned. Equal texts get equal results; ties go to the language that
    comes first by name. All columns of ``docs`` stay as they are.
    """
    parts = (model.languages, model.idf, model.weights, model.bias, model.temperature)
    held = docs.sparkSession.sparkContext.broadcast(parts)
    return append_column(docs, text_col, name, PREDICTION, lambda: LanguageModel(*held.value).predict)
