"""Toxicity by a classifier chain of linear models.

The categories are predicted one after the other; the model of a category
sees the text's features and the probabilities of all earlier categories.
For training, those probabilities are out of fold: each labelled row's come
from a model that did not see it.

1. A bounded sample of labelled documents is turned into sets of hashed
   features (words without a final mark, and word beginnings).
2. Per category, one task per fold and one for all rows selects the features
   whose log-odds stand out and fits a logistic regression.  The folds give
   the out-of-fold probabilities for the next category.
3. All documents are scored in one pass over their whole texts, category by
   category.  A document is toxic if the last probability reaches the cutoff
   with the best F1 on the out-of-fold probabilities.

The last category is the label itself; earlier ones are weak labels by word
lists.  Fitting is in doubles with a fixed number of steps, so a given sample
gives a given model.

Defined results
  null or empty text: no features, the models' base rates; null id: scored like
  any other, never in the sample; null label: not in the sample; repeated
  rows: each is scored, a repeated label counts once (toxic if any is);
  very long text: whole, in slices of bounded size; no labels at all:
  probability 0 everywhere; empty table: empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prioritext.llm.tables import table, written
from prioritext.llm.words import Words, slices, split_words

# Labelled documents that the chain is fitted on (the ones with the smallest hash of their id).
LABELLED_ROWS = 6_000
FOLDS = 3
FEATURE_BITS = 18
SELECTED = 600
PREFIXES = (5, 6, 7)

# Weak labels of the earlier categories: words that mark them.
INSULT = ("idiot", "moron", "clown", "loser", "stupid", "fool", "dumb")
DEGRADING = ("trash", "scum", "worthless", "pathetic", "disgusting", "garbage", "vermin")
CHAIN = ("insult", "degrading", "toxic")

_MARKS = np.zeros(256, dtype=bool)
_MARKS[list(b".,!?;:\"')")] = True
_MASK = np.uint64((1 << FEATURE_BITS) - 1)


def feature_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(text, feature)`` pairs, sorted and distinct: hashed words and word beginnings."""
    words = split_words(texts)
    of = words.text_of_word()
    last = words.data[words.ends - 1] if len(words.ends) else words.data[:0]
    ends = words.ends - (_MARKS[last] & (words.ends - words.starts > 1))
    found = []
    for i, size in enumerate((None, *PREFIXES)):
        use = np.ones(len(ends), dtype=bool) if size is None else ends - words.starts >= size
        stop = ends[use] if size is None else words.starts[use] + size
        part = Words(words.data, words.offsets, words.starts[use], stop, words.first)
        feature = (part.hashes() + np.uint64(i)) & _MASK
        found.append((of[use].astype(np.uint64) << np.uint64(FEATURE_BITS)) | feature)
    pairs = np.unique(np.concatenate(found))
    return (pairs >> np.uint64(FEATURE_BITS)).astype(np.int64), (pairs & _MASK).astype(np.int32)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression by accelerated gradient steps: weights and bias."""
    n, d = x.shape
    if not 0 < y.sum() < n:
        return np.zeros(d), -30.0 if y.sum() == 0 else 30.0
    # a bound of the curvature by power iteration
    v = np.ones(d) / np.sqrt(max(d, 1))
    for _ in range(20):
        v = x.T @ (x @ v)
        v /= max(np.linalg.norm(v), 1e-12)
    rate = 1.0 / (0.3 * np.linalg.norm(x @ v) ** 2 + penalty + 0.3 * n)
    rate_bias = rate
    w, b = np.zeros(d), float(np.log(y.mean() / (1 - y.mean())))
    w_look, b_look, t = w, b, 1.0
    for _ in range(steps):
        error = _sigmoid(x @ w_look + b_look) - y
        w_new = w_look - rate * (x.T @ error + penalty * w_look)
        b_new = b_look - rate_bias * error.sum()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w_look, b_look = w_new + (t - 1) / t_new * (w_new - w), b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = w_new, b_new, t_new
    return w, float(b)


def select_features(rows: np.ndarray, features: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The features whose document frequencies in the two classes differ most (log-odds over its error)."""
    width = 1 << FEATURE_BITS
    pos = np.bincount(features, weights=y[rows], minlength=width)
    neg = np.bincount(features, minlength=width) - pos
    n_pos, n_neg = y.sum(), len(y) - y.sum()
    odds = np.log((pos + 0.5) / (n_pos - pos + 0.5)) - np.log((neg + 0.5) / (n_neg - neg + 0.5))
    error = np.sqrt(1 / (pos + 0.5) + 1 / (n_pos - pos + 0.5) + 1 / (neg + 0.5) + 1 / (n_neg - neg + 0.5))
    z = np.where(pos + neg >= 3, np.abs(odds) / error, 0.0)
    chosen = np.argsort(-z, kind="stable")[:SELECTED]
    return np.sort(chosen[z[chosen] > 2.5]).astype(np.int32)


def _design(n: int, rows: np.ndarray, features: np.ndarray, chosen: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    at = np.searchsorted(chosen, features)
    hit = (at < len(chosen)) & (np.take(chosen, np.minimum(at, len(chosen) - 1)) == features) if len(chosen) else at < 0
    x = np.zeros((n, len(chosen) + earlier.shape[1]))
    x[rows[hit], at[hit]] = 1.0
    x[:, len(chosen) :] = earlier
    return x


class ChainModel:
    """Per category: selected features, their weights, the weights of earlier probabilities, the bias."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray, float]], cutoff: float):
        self.parts, self.cutoff = parts, cutoff

    def predict(self, texts: pa.Array) -> np.ndarray:
        """Probabilities, texts x categories."""
        rows, features = feature_sets(texts)
        out = np.zeros((len(texts), len(self.parts)))
        for c, (chosen, weights, bias) in enumerate(self.parts):
            z = np.full(len(texts), bias) + out[:, :c] @ weights[len(chosen) :]
            if len(chosen):
                at = np.minimum(np.searchsorted(chosen, features), len(chosen) - 1)
                hit = chosen[at] == features
                z += np.bincount(rows[hit], weights=weights[at[hit]], minlength=len(texts))
            out[:, c] = _sigmoid(z)
        return out


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """``(doc_id, fold, features, insult, degrading, toxic)`` of at most ``rows`` labelled documents."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # the bound is on labelled documents: labels of others don't count
    known = known.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # so it is safe to broadcast
    sample = (
        docs.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text"))  # rows of one id: one of their texts
        .withColumn("lowered", F.lower("text"))
    )
    sample = sample.select(
        "doc_id",
        F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(FOLDS)).cast("int").alias("fold"),
        "text",
        *(
            F.coalesce(F.rlike("lowered", F.lit(f"(?<![a-z])({'|'.join(t)})(?![a-z])")).cast("int"), F.lit(0)).alias(c)
            for c, t in (("insult", INSULT), ("degrading", DEGRADING))
        ),
        "toxic",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows_, features = feature_sets(part.column("text"))
                bounds = np.searchsorted(rows_, np.arange(part.num_rows + 1)).tolist()
                sets = [features[a:b].tobytes() for a, b in pairwise(bounds)]
                out = {c: part.column(c) for c in ("doc_id", "fold", *CHAIN)}
                yield pa.RecordBatch.from_pydict(out | {"features": pa.array(sets, pa.binary())})

    return written(
        sample.mapInArrow(run, "doc_id long, fold int, insult int, degrading int, toxic int, features binary"), "labelled"
    )


def fit_chain(sample: DataFrame) -> ChainModel:
    """The chain fitted on a sample from :func:`labelled_sample`."""
    out_of_fold: dict[int, list[float]] = {}  # of the bounded sample
    parts: list[tuple[np.ndarray, np.ndarray, float]] = []
    fits = sample.withColumn("fit", F.explode(F.sequence(F.lit(0), F.lit(FOLDS))))  # the last one holds nothing out
    truth: dict[int, int] = {}
    for c, category in enumerate(CHAIN):
        known = dict(out_of_fold)

        def fit(rows: pa.Table) -> pa.Table:
            rows = rows.sort_by("doc_id")
            number = rows.column("fit")[0].as_py()
            ids, fold = rows.column("doc_id").to_pylist(), rows.column("fold").to_numpy()
            y = rows.column(category).to_numpy().astype(float)
            raw = rows.column("features").to_pylist()
            at = np.repeat(np.arange(len(raw)), [len(r) // 4 for r in raw])
            features = np.frombuffer(b"".join(raw), dtype=np.int32)
            earlier = np.array([known[i] for i in ids], dtype=float).reshape(len(ids), c) if c else np.zeros((len(ids), 0))
            train = fold != number
            inside = train[at]
            new = np.cumsum(train) - 1
            chosen = select_features(new[at[inside]], features[inside], y[train]) if train.any() else np.zeros(0, np.int32)
            x = _design(len(ids), at, features, chosen, earlier)
            w, b = fit_linear(x[train], y[train]) if train.any() else (np.zeros(x.shape[1]), -30.0)
            held = ~train
            p = _sigmoid(x[held] @ w + b)
            out_ids = [i for i, h in zip(ids, held.tolist(), strict=True) if h]
            return pa.table(
                {
                    "fit": pa.array([number] * (len(out_ids) + 1), pa.int32()),
                    "doc_id": pa.array([None, *out_ids], pa.int64()),
                    "p": pa.array([b, *p.tolist()], pa.float64()),
                    "y": pa.array([0, *y[held].astype(int).tolist()], pa.int32()),
                    "chosen": pa.array([chosen.tobytes()] + [None] * len(out_ids), pa.binary()),
                    "weights": pa.array([w.tobytes()] + [None] * len(out_ids), pa.binary()),
                }
            )

        schema = "fit int, doc_id long, p double, y int, chosen binary, weights binary"
        fitted = fits.groupBy("fit").applyInArrow(fit, schema).toArrow().to_pylist()  # bounded by the sample
        model = (np.zeros(0, np.int32), np.zeros(c), -30.0)
        for row in fitted:
            if row["doc_id"] is not None:
                out_of_fold.setdefault(row["doc_id"], []).append(row["p"])
                truth[row["doc_id"]] = row["y"]
            elif row["fit"] == FOLDS:
                model = (np.frombuffer(row["chosen"], np.int32), np.frombuffer(row["weights"]), row["p"])
        parts.append(model)
    ids = sorted(out_of_fold)
    p = np.array([out_of_fold[i][-1] for i in ids])
    return ChainModel(parts, best_cutoff(p, np.array([truth[i] for i in ids])))


def best_cutoff(p: np.ndarray, y: np.ndarray) -> float:
    """The cutoff with the best F1, half-way to the next lower probability (ties: the highest; 0.5 without positives)."""
    if not len(y) or not y.sum():
        return 0.5
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    i = int(f1.argmax())
    below = p[order[i + 1]] if i + 1 < len(y) else 0.0
    return float((p[order[i]] + below) / 2)


def score_toxicity(docs: DataFrame, model: ChainModel) -> DataFrame:
    """``(doc_id, p_<category>..., toxic)`` of every row of ``docs(doc_id, text)``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                p = shared.value.predict(part.column("text"))
                out = {"doc_id": part.column("doc_id")} | {f"p_{c}": p[:, i] for i, c in enumerate(CHAIN)}
                yield pa.RecordBatch.from_pydict(out | {"toxic": pa.array(p[:, -1] >= shared.value.cutoff)})

    schema = "doc_id long, " + ", ".join(f"p_{c} double" for c in CHAIN) + ", toxic boolean"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def keep_clean(docs: DataFrame, model: ChainModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) that the model does not call toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                yield part.filter(pa.array(shared.value.predict(part.column(text_col))[:, -1] < shared.value.cutoff))

    return docs.mapInArrow(run, docs.schema)


def fitted_model(docs: DataFrame, labels: DataFrame) -> ChainModel:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return fit_chain(labelled_sample(docs, labels))


def op1_classifier_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chain probabilities (six decimals) and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = score_toxicity(docs, fitted_model(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", *(F.round(f"p_{c}", 6).alias(f"p_{c}") for c in CHAIN), "toxic")
