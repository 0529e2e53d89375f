"""Quality classifier: supervised subword embeddings.

Every text is a bag of hashed n-grams: words, word pairs and character n-grams inside words.
Each bucket has a learned vector; a text is the average of its n-grams' vectors, and a softmax
over two outputs gives the probability of either label. All weights are learned by stochastic
gradient descent in numpy.

A pair of equal neighbouring words falls into one bucket of its own whatever the word is, so
that repetition is an n-gram, too.

Since the softmax of two outputs depends only on the difference of its two inputs, and the
average is linear, scoring needs one number per bucket (the vector times the difference of
the output weights). That table is what is broadcast: ``2 ** bits`` floats at any corpus size.
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

HOLDOUT_MOD, HOLDOUT_REST = 5, 0


@dataclass(frozen=True)
class Settings:
    """Parameters of the model. ``rows`` and ``max_chars`` bound the training sample."""

    bits: int = 18
    dims: int = 8
    sizes: tuple[int, ...] = (3, 4)
    rows: int = 5_000
    max_chars: int = 50_000
    updates: int = 30_000
    rate: float = 0.5
    seed: int = 7
    threshold: float = 0.3


def _bags(part: Slice, s: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per kind of n-gram: bucket and text index (in the slice) of every n-gram."""
    joined = grams.Joined.of(part.texts, grams.blanks(), part.own)
    for n in s.sizes:
        yield joined.character_grams(n, s.bits)
    words, owner, counts = joined.words()
    yield grams.bucket(words[counts], s.bits), owner[counts]
    pairs, same = grams.paired(words, owner, 1, 1)
    same &= counts[: len(same)]
    again = words[1:] == words[:-1]
    yield np.where(again, 0, grams.bucket(pairs, s.bits))[same], owner[: len(same)][same]


def train(sample: Iterable[tuple[str, int]], s: Settings) -> tuple[np.ndarray, float]:
    """Learn from (text, label) rows; returns the score of each bucket and the bias.

    Without rows of both labels the table is zero and the bias follows the smoothed share of
    label 1, so every text gets that share as its score.
    """
    bags, labels = Bags(), []
    for text, label in sample:
        found = [b for part in slices([text], SLICE_CHARS) for b, _ in _bags(part, s)]
        ids, counts = np.unique(np.concatenate(found).astype(np.int32), return_counts=True)
        bags.add(ids, counts / max(1, counts.sum()))
        labels.append(label)
    share = (sum(labels) + 1) / (len(labels) + 2)
    if len(set(labels)) < 2:
        return np.zeros(1 << s.bits, np.float32), float(np.log(share / (1 - share)))
    rng = np.random.default_rng(s.seed)
    vectors = rng.uniform(-1 / s.dims, 1 / s.dims, (1 << s.bits, s.dims)).astype(np.float32)
    output = np.zeros((2, s.dims), np.float32)
    bias = np.array([np.log(1 - share), np.log(share)], np.float32)
    done, epochs = 0, max(1, -(-s.updates // len(bags)))
    total = epochs * len(bags)
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            ids, part = bags.ids(i), bags.weights(i)
            rate = s.rate * (1 - done / total)
            done += 1
            hidden = part @ vectors[ids]
            logits = output @ hidden + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            step = output.T @ p
            output -= rate * np.outer(p, hidden)
            bias -= 0.1 * rate * p
            # every n-gram of the text moves by the same step, as in averaged bags of subwords
            vectors[ids] -= (rate * np.minimum(1, part * len(ids)))[:, None] * step
    return (vectors @ (output[1] - output[0])).astype(np.float32), float(bias[1] - bias[0])


def probabilities(parts: Iterator[Slice], n: int, table: np.ndarray, bias: float, s: Settings) -> np.ndarray:
    """Probability of label 1 for n texts given in slices; a text without n-grams gets the bias alone."""
    total, count = np.zeros(n), np.zeros(n)
    for part in parts:
        owners, size = np.array(part.owners), len(part.owners)
        for buckets, owner in _bags(part, s):
            np.add.at(total, owners, np.bincount(owner, weights=table[buckets], minlength=size))
            np.add.at(count, owners, np.bincount(owner, minlength=size))
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + bias, -500, 500)))


def _scorer(docs: DataFrame, labels: DataFrame, s: Settings):
    sample = labelled_sample(docs, labels, "quality", HOLDOUT_MOD, HOLDOUT_REST, s.rows, s.max_chars)
    shared = docs.sparkSession.sparkContext.broadcast(train(sample, s))
    give_back()
    return lambda parts, n: probabilities(parts, n, *shared.value, s)


def predict(docs: DataFrame, labels: DataFrame, name: str, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs``, each with its own prediction as column ``name``."""
    return with_prediction(docs, name, settings.threshold, _scorer(docs, labels, settings))


def score_documents(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs`` (doc_id, text).

    Learns ``labels.quality`` from a bounded sample of rows that are not held out and scores
    every whole text. A null or empty text gets the score of the bias, a null id is not held
    out; repeated rows are scored one by one, an empty table gives an empty result.
    """
    return scored(docs, "doc_id", _scorer(docs, labels, settings)).select(
        "doc_id",
        held_out("doc_id", HOLDOUT_MOD, HOLDOUT_REST).alias("held_out"),
        "score",
        (F.col("score") >= settings.threshold).cast("int").alias("predicted"),
    )
