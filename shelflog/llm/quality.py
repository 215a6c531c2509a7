"""Quality scores by attention-based multiple-instance learning over passages."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflog.llm.common import append_column, column
from shelflog.llm.hashing import Powers, symbols, word_hashes
from shelflog.llm.training import Parameters, averaged_rounds
from shelflog.session import materialize

PASSAGE_WORDS = 64
SAMPLE_PER_LABEL = 3000
HIDDEN, ATTENTION = 24, 12
SHARDS, ROUNDS, STEPS, BATCH, RATE = 4, 3, 150, 32, 0.01
# Byte classes: small and large letters, digits, space, other white space, other bytes, and
# each of these signs on its own.
_SIGNS = b".,!|*$%&#@:;?()-\"'/<>=_[]{}+"


def _classes() -> tuple[np.ndarray, int]:
    table = np.full(256, 5, np.int64)
    table[128:] = 0
    table[97:123], table[65:91], table[48:58] = 0, 1, 2
    table[32] = 3
    table[9:14] = 4
    for i, sign in enumerate(_SIGNS):
        table[sign] = 6 + i
    return table, 6 + len(_SIGNS)


CLASS_OF, N_CLASSES = _classes()
N_PAIRS = N_CLASSES * N_CLASSES
N_FEATURES = N_PAIRS + 4


def passages(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of the texts, and the passages per text (one at least).

    A passage is ``PASSAGE_WORDS`` words. Its features are the square roots of the shares of
    its byte-class pairs, its mean word length, how full it is, and the shares of its words
    that are distinct and that repeat the word before.
    """
    sizes = np.array([len(t) if t else 0 for t in texts])
    sizes += sizes > 0  # a line end after each text keeps the words of two texts apart
    raw = np.frombuffer(b"".join(t + b"\n" for t in texts if t), np.uint8)
    first = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(texts)), sizes)
    kind = CLASS_OF[raw]
    space = (kind == 3) | (kind == 4)
    start = ~space
    start[1:] &= space[:-1]
    begins = first[sizes > 0]
    start[begins] = ~space[begins]
    word = np.cumsum(start)
    base = np.zeros(len(texts), np.int64)
    base[sizes > 0] = word[begins] - start[begins]
    within = np.maximum(word - base[doc] - 1, 0) // PASSAGE_WORDS
    counts = np.ones(len(texts), np.int64)
    ends = (first + sizes - 1)[sizes > 0]
    counts[sizes > 0] = within[ends] + 1
    offset = np.cumsum(counts) - counts
    at = offset[doc] + within
    n = int(counts.sum())
    if not len(raw):
        return np.zeros((n, N_FEATURES), np.float32), counts
    same = at[1:] == at[:-1]
    pair = (at[:-1] * N_PAIRS + kind[:-1] * N_CLASSES + kind[1:])[same]
    table = np.bincount(pair, minlength=n * N_PAIRS).reshape(n, N_PAIRS).astype(np.float32)
    out = np.zeros((n, N_FEATURES), np.float32)
    out[:, :N_PAIRS] = 3 * np.sqrt(table / np.maximum(table.sum(1, keepdims=True), 1))
    letters = np.bincount(at[~space], minlength=n)
    starts = np.bincount(at[start], minlength=n)
    out[:, N_PAIRS] = np.minimum(letters / np.maximum(starts, 1), 30) / 10
    out[:, N_PAIRS + 1] = starts / PASSAGE_WORDS
    begin, _, ids = word_hashes(raw, ~space, Powers(), symbols())
    bag = at[begin]
    order = np.lexsort((ids, bag))
    fresh = np.ones(len(ids), bool)
    fresh[1:] = (ids[order][1:] != ids[order][:-1]) | (bag[order][1:] != bag[order][:-1])
    words = np.maximum(np.bincount(bag, minlength=n), 1)
    out[:, N_PAIRS + 2] = 3 * np.bincount(bag[order][fresh], minlength=n) / words
    again = (ids[1:] == ids[:-1]) & (bag[1:] == bag[:-1])
    out[:, N_PAIRS + 3] = 3 * np.bincount(bag[1:][again], minlength=n) / words
    return out, counts


def new_parameters(seed: int = 1) -> Parameters:
    rng = np.random.default_rng(seed)

    def weights(a: int, b: int) -> np.ndarray:
        return rng.normal(0, 1 / math.sqrt(a), (a, b))

    return {
        "encode": weights(N_FEATURES, HIDDEN) * 3,
        "encode_bias": np.zeros(HIDDEN),
        "value": weights(HIDDEN, ATTENTION),
        "gate": weights(HIDDEN, ATTENTION),
        "attend": weights(ATTENTION, 1)[:, 0],
        "score": weights(HIDDEN, 1)[:, 0],
        "score_bias": np.zeros(1),
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def forward(p: Parameters, x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    first = np.cumsum(counts) - counts
    bag = np.repeat(np.arange(len(counts)), counts)
    h = np.tanh(x @ p["encode"] + p["encode_bias"])
    value, gate = np.tanh(h @ p["value"]), _sigmoid(h @ p["gate"])
    e = (value * gate) @ p["attend"]
    e = np.exp(e - np.maximum.reduceat(e, first)[bag])
    a = e / np.add.reduceat(e, first)[bag]
    z = np.add.reduceat(a[:, None] * h, first)
    return {"h": h, "value": value, "gate": gate, "a": a, "z": z, "bag": bag, "first": first, "logit": z @ p["score"] + p["score_bias"]}


def gradients(p: Parameters, x: np.ndarray, counts: np.ndarray, label: np.ndarray) -> Parameters:
    f = forward(p, x, counts)
    error = (_sigmoid(f["logit"]) - label) / len(label)
    dz = error[:, None] * p["score"]
    da = (dz[f["bag"]] * f["h"]).sum(1)
    de = f["a"] * (da - np.add.reduceat(f["a"] * da, f["first"])[f["bag"]])
    dvalue = de[:, None] * p["attend"] * f["gate"] * (1 - f["value"] ** 2)
    dgate = de[:, None] * p["attend"] * f["value"] * f["gate"] * (1 - f["gate"])
    dh = f["a"][:, None] * dz[f["bag"]] + dvalue @ p["value"].T + dgate @ p["gate"].T
    dh *= 1 - f["h"] ** 2
    return {
        "encode": x.T @ dh,
        "encode_bias": dh.sum(0),
        "value": f["h"].T @ dvalue,
        "gate": f["h"].T @ dgate,
        "attend": (f["value"] * f["gate"]).T @ de,
        "score": f["z"].T @ error,
        "score_bias": np.array([error.sum()]),
    }


def train_locally(p: Parameters, pdf: pd.DataFrame, number: int) -> Parameters:
    """Adam over the documents of one shard."""
    pdf = pdf.sort_values("doc_id", kind="stable")
    bags = [np.frombuffer(b, np.float16).reshape(-1, N_FEATURES).astype(np.float32) for b in pdf["features"]]
    labels = pdf["quality"].to_numpy(float)
    rng = np.random.default_rng(number)
    mean = {k: np.zeros_like(v) for k, v in p.items()}
    square = {k: np.zeros_like(v) for k, v in p.items()}
    order = np.zeros(0, np.int64)
    for step in range(1, STEPS + 1):
        if len(order) < BATCH:
            order = np.concatenate([order, rng.permutation(len(bags))])
        chosen, order = order[:BATCH], order[BATCH:]
        counts = np.array([len(bags[i]) for i in chosen])
        found = gradients(p, np.concatenate([bags[i] for i in chosen]), counts, labels[chosen])
        for k, g in found.items():
            g = g + 1e-4 * p[k]
            mean[k] += 0.1 * (g - mean[k])
            square[k] += 0.001 * (g * g - square[k])
            move = mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
            p[k] = p[k] - RATE / (number + 1) * move
    return p


@dataclass(frozen=True)
class QualityModel:
    parameters: Parameters
    prior: float  # log odds of label 1 in the labelled rows against the sample

    def scores(self, texts: list[bytes | None]) -> list[float]:
        if not texts:
            return []
        x, counts = passages(texts)
        return _sigmoid(forward(self.parameters, x, counts)["logit"] + self.prior).tolist()


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_per_label: int = SAMPLE_PER_LABEL,
) -> QualityModel:
    """Fit on a bounded sample of ``labels``: at most ``sample_per_label`` ids of each label.

    The ids with the least hashes are taken and their whole texts read. The sample is even
    between the labels; the share of label 1 among all given labels is put back as a prior.
    Several labels of one document count as their largest; null ids and labels are left out.
    Without both labels the model scores every text by the prior alone.
    """
    known = labels.select(column(id_col).alias("doc_id"), (column(label_col) > 0).cast("int").alias("quality"))
    known = known.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    totals = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("quality") == label).orderBy(*order).limit(sample_per_label)
        chosen = part if chosen is None else chosen.unionByName(part)
    # The sample's bound is its parameter, so it goes to all tasks.
    rows = docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text"))
    rows = rows.join(F.broadcast(chosen), "doc_id")

    def make():
        def work(texts):
            x, counts = passages(texts)
            cuts = np.cumsum(counts)[:-1]
            return [part.astype(np.float16).tobytes() for part in np.split(x, cuts)] if texts else []

        return work

    features = append_column(rows, "text", "features", T.BinaryType(), make).drop("text")
    features = materialize(features.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS))), "quality-sample")
    used = {r.quality: r["count"] for r in features.groupBy("quality").count().collect()}
    if len(used) < 2:
        share = (totals.get(1, 0) + 1) / (sum(totals.values()) + 2)
        flat = {k: np.zeros_like(v) for k, v in new_parameters().items()}
        return QualityModel(flat, math.log(share / (1 - share)))
    parameters = averaged_rounds(features, new_parameters(), train_locally, ROUNDS)
    prior = math.log(totals[1] / totals[0]) - math.log(used[1] / used[0])
    return QualityModel(parameters, prior)


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a double column ``name`` between 0 and 1: how likely label 1 is.

    Every passage of the whole text is encoded; gated attention weighs the passages; the
    weighted mean is scored. Nothing but the text is read, nothing shuffles.

    Cases: null, empty and wordless texts are one passage without features and get that
    passage's score. A text is split by words, so very long texts only have more passages.
    Equal texts have equal scores. All columns of ``docs`` stay as they are.
    """
    held = docs.sparkSession.sparkContext.broadcast((model.parameters, model.prior))
    return append_column(docs, text_col, name, T.DoubleType(), lambda: QualityModel(*held.value).scores)
