"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

The features of a text count, for every n-gram (see ``ngrams``; ``LENGTHS`` bytes, ``BUCKETS`` buckets),
the different words of the text that hold it. Each feature is scaled by the logarithm of how much more
often texts of the one label show it than texts of the other, and logistic regression is trained on the
scaled features. A text's score is then a sum over its different words, so each word is weighed once
for a whole batch of texts.

The classifier is fitted on at most ``most`` rows of each label, those of least hash; a sample of that
bound is all that meets in one task, and only its ids are broadcast. Rows of the sample are weighed by
the share of their label among all training labels, so scores follow the true share. Labels come from
rows whose crc32(doc_id as text) leaves another remainder than ``held`` modulo ``folds`` only.

Null and empty texts get the score of a text without words. Rows without a label are scored like any
other; labels that are neither 0 nor 1 are not learned from; a document with several labels is learned
from once for each. With one label only, or none, the score is that label's share, 0.5 for none. An
empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mendtable.functions.columns import ref

from .common import batch_bytes, fold_of, prepared, ranges, slim, task, text_groups
from .ngrams import distinct_words, ngrams

LENGTHS = (3, 4, 5, 6)
BUCKETS = 1 << 18
THRESHOLD = 0.3
#: Bytes of text whose features are found together in training.
GROUP = 1 << 18


def features(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, bucket and count of every feature."""
    folded, starts, sizes, text, word, _ = distinct_words(raw, ends)
    found, owner = ngrams(folded, starts, sizes, LENGTHS, BUCKETS)
    order = np.argsort(owner, kind="stable")
    found, count = found[order], np.bincount(owner, minlength=len(starts))
    begins = np.cumsum(count) - count
    cell = np.repeat(text, count[word]) * BUCKETS + found[ranges(begins[word], count[word])]
    cell, times = np.unique(cell, return_counts=True)
    return cell // BUCKETS, cell % BUCKETS, times


def _sample_features(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The features of many texts, a group at a time and in small numbers."""
    parts: tuple[list, list, list] = ([], [], [])
    at = 0
    while at < len(ends) - 1:
        stop = min(len(ends) - 1, max(at + 1, int(np.searchsorted(ends, ends[at] + GROUP))))
        text, bucket, times = features(raw[ends[at] : ends[stop]], ends[at : stop + 1] - ends[at])
        for part, values, kind in zip(parts, (text + at, bucket, times), (np.int32, np.int32, np.float32)):
            part.append(values.astype(kind))
        at = stop
    out = []
    for part in parts:
        out.append(np.concatenate(part))
        part.clear()
    return out[0], out[1], out[2]


def train(raw: np.ndarray, ends: np.ndarray, label: np.ndarray, weight: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Weight of each bucket, the ratio included, and the intercept."""
    n = len(label)
    share = float((label * weight).sum() / weight.sum()) if n else 0.5
    if not n or share in (0.0, 1.0):
        return np.zeros(BUCKETS), float(np.log((share + 1e-9) / (1 - share + 1e-9)))
    text, bucket, times = _sample_features(raw, ends)
    toxic = label[text] == 1
    seen = [np.bincount(bucket[m], minlength=BUCKETS) + 1.0 for m in (toxic, ~toxic)]
    ratio = np.log(seen[0] / (label.sum() + 2)) - np.log(seen[1] / ((label == 0).sum() + 2))
    value = times * ratio.astype(np.float32)[bucket]
    begins = np.searchsorted(text, np.arange(n + 1))
    w, grown, b, b_grown = np.zeros(BUCKETS), np.full(BUCKETS, 1e-8), float(np.log(share / (1 - share))), 1e-8
    shuffled = np.random.default_rng(0)
    for _ in range(rounds):
        for part in np.array_split(shuffled.permutation(n), -(-n // 64)):
            size = begins[part + 1] - begins[part]
            cells, own = ranges(begins[part], size), np.repeat(np.arange(len(part)), size)
            z = np.bincount(own, w[bucket[cells]] * value[cells], minlength=len(part)) + b
            off = (sigmoid(z) - label[part]) * weight[part]
            at, back = np.unique(bucket[cells], return_inverse=True)
            slope = np.bincount(back, off[own] * value[cells], minlength=len(at)) / len(part) + 1e-3 * w[at]
            grown[at] += slope**2
            w[at] -= 0.1 * slope / np.sqrt(grown[at])
            b_grown += off.mean() ** 2
            b -= 0.1 * off.mean() / np.sqrt(b_grown)
    return w * ratio, b


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def scores(raw: np.ndarray, ends: np.ndarray, weights: np.ndarray, intercept: float) -> np.ndarray:
    folded, starts, sizes, text, word, _ = distinct_words(raw, ends)
    found, owner = ngrams(folded, starts, sizes, LENGTHS, BUCKETS)
    of_word = np.bincount(owner, weights[found], minlength=len(starts))
    return sigmoid(np.bincount(text, of_word[word], minlength=len(ends) - 1) + intercept)


def _training_rows(docs: DataFrame, labels: DataFrame, label: str, held: int, folds: int, most: int) -> DataFrame:
    """Text, label and weight of the sample."""
    known = labels.select(ref("doc_id").cast("bigint").alias("doc_id"), ref(label).cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).filter(fold_of("doc_id", folds) != held)
    sizes = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    picked = None
    for value, size in sizes.items():
        of_label = known.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        of_label = of_label.withColumn("weight", F.lit(size / min(size, most)))
        picked = of_label if picked is None else picked.unionByName(of_label)
    if picked is None:
        picked = known.withColumn("weight", F.lit(1.0))
    # two labels of ``most`` rows each at most
    return docs.join(F.broadcast(picked.withColumnRenamed("doc_id", "labelled")), F.col("doc_id") == F.col("labelled"))


def toxicity(
    docs: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id", label: str = "toxic",
    held: int = 2, folds: int = 4, most: int = 3000,
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    prepared(docs.sparkSession)
    rows = slim(docs, text, id_column)
    sample = _training_rows(rows, labels, label, held, folds, most).select("doc_id", "text", "label", "weight")

    def fit(t: pa.Table) -> pa.Table:
        t = t.sort_by([("doc_id", "ascending"), ("text", "ascending"), ("label", "ascending")])
        raw, ends = batch_bytes(t.column("text").combine_chunks())
        weight = t.column("weight").to_numpy()
        w, b = train(raw, ends, t.column("label").to_numpy(), weight / weight.mean())
        return pa.table({"weights": pa.array([w.astype("<f4").tobytes()], pa.binary()), "intercept": pa.array([b])})

    fitted = sample.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(fit, "weights binary, intercept double").first()
    weights = np.frombuffer(fitted.weights, "<f4").astype(np.float64) if fitted else np.zeros(BUCKETS)
    model = docs.sparkSession.sparkContext.broadcast((weights, fitted.intercept if fitted else 0.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for ids, raw, ends in text_groups(batch):
                held_out = batch.column(2)[at : at + len(ids)]
                at += len(ids)
                found = scores(raw, ends, *model.value)
                predicted = pa.array((found >= THRESHOLD).astype(np.int32))
                yield pa.RecordBatch.from_arrays([ids, held_out, pa.array(found), predicted], names=["doc_id", "held_out", "score", "predicted"])

    tested = rows.select("doc_id", "text", (fold_of("doc_id", folds) == held).alias("held_out"))
    return tested.mapInArrow(task(run), "doc_id bigint, held_out boolean, score double, predicted int")
