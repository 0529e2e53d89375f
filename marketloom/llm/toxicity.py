"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the presence of lower-cased words (runs of letters and digits), of neighbouring
pairs and of pairs with one word between. Each coordinate has its own learning rate, and L1
keeps only buckets with evidence, so the weights that are broadcast are a short list of
(bucket, weight), at most ``2 ** bits`` of them at any corpus size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm import grams
from marketloom.llm.base import Bags, Slice, give_back, labelled_sample, slices
from marketloom.llm.scoring import SLICE_CHARS, held_out, scored, with_prediction

HOLDOUT_MOD, HOLDOUT_REST = 4, 2


@dataclass(frozen=True)
class Settings:
    """Parameters of the model. ``rows`` and ``max_chars`` bound the training sample.

    ``min_docs``: a feature of fewer training texts is no feature, so single texts cannot be
    learned by heart.
    """

    bits: int = 20
    rows: int = 12_000
    max_chars: int = 50_000
    min_docs: int = 4
    updates: int = 40_000
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 7.0
    l2: float = 0.0
    seed: int = 11
    threshold: float = 0.3


@dataclass(frozen=True)
class Model:
    """Weights that are not zero, by ascending bucket."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def dense(self, bits: int) -> np.ndarray:
        table = np.zeros(1 << bits, np.float32)
        table[self.buckets] = self.weights
        return table


def _features(part: Slice, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text index (in the slice) of every word, pair and skip-pair."""
    # lower() may change a text's length, which matters only where a part has its own end
    lowered = [t.lower() for t in part.texts]
    own = [len(low) if n >= len(t) else len(t[:n].lower()) for low, t, n in zip(lowered, part.texts, part.own)]
    words, owner, counts = grams.Joined.of(lowered, grams.no_letters(), own).words()
    found, owners = [words[counts]], [owner[counts]]
    for step in (1, 2):
        pairs, same = grams.paired(words, owner, step, step)
        same &= counts[: len(same)]
        found.append(pairs[same])
        owners.append(owner[: len(same)][same])
    return grams.bucket(np.concatenate(found), s.bits), np.concatenate(owners)


def _weights(z: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    shrunk = z - np.sign(z) * s.l1
    return np.where(np.abs(z) <= s.l1, 0.0, -shrunk / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))


def train(sample: Iterable[tuple[str, int]], s: Settings) -> Model:
    """Learn from (text, label) rows; without rows of both labels there are no weights, only the prior."""
    bags, labels, texts_with = Bags(), [], np.zeros(1 << s.bits, np.int32)
    for text, label in sample:
        found = [_features(part, s)[0] for part in slices([text], SLICE_CHARS)]
        bag = np.unique(np.concatenate(found))
        texts_with[bag] += 1
        bags.add(bag)
        labels.append(label)
    share = (sum(labels) + 1) / (len(labels) + 2)
    bias = float(np.log(share / (1 - share)))
    if len(set(labels)) < 2:
        return Model(np.zeros(0, np.int64), np.zeros(0, np.float32), bias)
    common = texts_with >= s.min_docs
    z, n, seen = np.zeros(1 << s.bits), np.zeros(1 << s.bits), 0.0
    rng = np.random.default_rng(s.seed)
    for _ in range(max(1, -(-s.updates // len(bags)))):
        for i in rng.permutation(len(bags)):
            ids = bags.ids(i)
            ids = ids[common[ids]]
            z_i, n_i = z[ids], n[ids]
            w = _weights(z_i, n_i, s)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - labels[i]
            z[ids] = z_i + g - (np.sqrt(n_i + g * g) - np.sqrt(n_i)) / s.alpha * w
            n[ids] = n_i + g * g
            seen += g * g
            bias -= 0.1 * g / np.sqrt(1 + seen)
    w = _weights(z, n, s)
    kept = np.flatnonzero(w)
    return Model(kept, w[kept].astype(np.float32), float(bias))


def probabilities(parts: Iterator[Slice], n: int, table: np.ndarray, bias: float, s: Settings) -> np.ndarray:
    """Probability of label 1 for n texts given in slices; each feature counts once per text."""
    rows, hits = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for part in parts:
        buckets, owner = _features(part, s)
        hit = np.flatnonzero(table[buckets])
        rows.append(np.array(part.owners)[owner[hit]])
        hits.append(buckets[hit])
    found = np.unique(np.concatenate(rows) << s.bits | np.concatenate(hits))
    total = np.bincount(found >> s.bits, weights=table[found & ((1 << s.bits) - 1)], minlength=n)
    return 1 / (1 + np.exp(-np.clip(total + bias, -500, 500)))


def _scorer(docs: DataFrame, labels: DataFrame, s: Settings):
    sample = labelled_sample(docs, labels, "toxic", HOLDOUT_MOD, HOLDOUT_REST, s.rows, s.max_chars)
    shared = docs.sparkSession.sparkContext.broadcast(train(sample, s))
    give_back()

    def score(parts: Iterator[Slice], n: int) -> np.ndarray:
        model = shared.value
        return probabilities(parts, n, model.dense(s.bits), model.bias, s)

    return score


def predict(docs: DataFrame, labels: DataFrame, name: str, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs``, each with its own prediction as column ``name``."""
    return with_prediction(docs, name, settings.threshold, _scorer(docs, labels, settings))


def score_documents(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs`` (doc_id, text).

    Learns ``labels.toxic`` from a bounded sample of rows that are not held out and scores
    every whole text. A null or empty text gets the score of the bias, a null id is not held
    out; repeated rows are scored one by one, an empty table gives an empty result.
    """
    return scored(docs, "doc_id", _scorer(docs, labels, settings)).select(
        "doc_id",
        held_out("doc_id", HOLDOUT_MOD, HOLDOUT_REST).alias("held_out"),
        "score",
        (F.col("score") >= settings.threshold).cast("int").alias("predicted"),
    )
