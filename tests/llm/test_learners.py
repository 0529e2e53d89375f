"""The learning of both classifiers against plain Python."""

from __future__ import annotations

import math

import numpy as np
import pytest

from marketloom.llm import quality, toxicity
from marketloom.llm.base import Slice

WORD = (1 << 64) - 1
PRIME = 0x9E3779B97F4A7C15


def mixed(h):
    for _ in range(2):
        h = ((h ^ (h >> 32)) * 0xD6E8FEB86659FD93) & WORD
    return h ^ (h >> 32)


def word_hash(word):
    return mixed(sum((ord(c) + 1) * pow(PRIME, k, 1 << 64) for k, c in enumerate(word)) & WORD)


def pair_hash(a, b, step):
    return mixed((a * 3 + b * 0xA24BAED4963EE407 + step) & WORD)


def features(text, bits):
    """Buckets of words, neighbours and words with one between, of lower-cased runs of letters and digits."""
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    hashes = [word_hash(w) for w in words]
    out = list(hashes)
    for step in (1, 2):
        out += [pair_hash(a, b, step) for a, b in zip(hashes, hashes[step:])]
    return [h >> (64 - bits) for h in out]


TEXTS = ["you are a fool", "A kind, kind word!", "fool fool", "", "  ...", "one", "the fool is a fool is", "kind words are kind", "x1 Été x1"]


def test_skip_gram_features():
    s = toxicity.Settings(bits=20)
    buckets, owner = toxicity._features(Slice(list(range(len(TEXTS))), TEXTS, [len(t) for t in TEXTS]), s)
    for row, text in enumerate(TEXTS):
        assert sorted(buckets[owner == row].tolist()) == sorted(features(text, s.bits)), text


def plain_ftrl(sample, s):
    bags = [sorted(set(features(t, s.bits))) for t, _ in sample]
    labels = [y for _, y in sample]
    texts_with = {}
    for bag in bags:
        for b in bag:
            texts_with[b] = texts_with.get(b, 0) + 1
    share = (sum(labels) + 1) / (len(labels) + 2)
    bias, seen, z, n = math.log(share / (1 - share)), 0.0, {}, {}

    def weight(b):
        if abs(z.get(b, 0.0)) <= s.l1:
            return 0.0
        return -(z[b] - math.copysign(s.l1, z[b])) / ((s.beta + math.sqrt(n[b])) / s.alpha + s.l2)

    rng = np.random.default_rng(s.seed)
    for _ in range(max(1, -(-s.updates // len(bags)))):
        for i in rng.permutation(len(bags)):
            known = [b for b in bags[i] if texts_with[b] >= s.min_docs]
            weights = [weight(b) for b in known]
            g = 1 / (1 + math.exp(-(sum(weights) + bias))) - labels[i]
            for b, w in zip(known, weights):
                sigma = (math.sqrt(n.get(b, 0.0) + g * g) - math.sqrt(n.get(b, 0.0))) / s.alpha
                z[b] = z.get(b, 0.0) + g - sigma * w
                n[b] = n.get(b, 0.0) + g * g
            seen += g * g
            bias -= 0.1 * g / math.sqrt(1 + seen)
    return {b: weight(b) for b in z if weight(b)}, bias


@pytest.mark.parametrize("l1,l2", [(0.3, 0.0), (0.05, 0.5)])
def test_ftrl_updates(l1, l2):
    s = toxicity.Settings(bits=16, l1=l1, l2=l2, min_docs=2, updates=200)
    sample = [(t, int("fool" in t)) for t in TEXTS * 3]
    model = toxicity.train(iter(sample), s)
    weights, bias = plain_ftrl(sample, s)
    assert model.buckets.tolist() == sorted(weights) and weights
    np.testing.assert_allclose(model.weights, [weights[b] for b in sorted(weights)], rtol=1e-5)
    assert model.bias == pytest.approx(bias, rel=1e-9)
    # scoring: the sum of the weights of the distinct features, and the bias
    slices = iter([Slice(list(range(len(TEXTS))), TEXTS, [len(t) for t in TEXTS])])
    got = toxicity.probabilities(slices, len(TEXTS), model.dense(s.bits), model.bias, s)
    want = [1 / (1 + math.exp(-(sum(weights.get(b, 0.0) for b in set(features(t, s.bits))) + bias))) for t in TEXTS]
    np.testing.assert_allclose(got, want, rtol=1e-5)


def plain_sgd(bags, labels, s):
    """Averaged n-gram vectors, softmax of two outputs, one text at a time, all in lists."""
    share = (sum(labels) + 1) / (len(labels) + 2)
    rng = np.random.default_rng(s.seed)
    start = rng.uniform(-1 / s.dims, 1 / s.dims, (1 << s.bits, s.dims)).astype(np.float32).tolist()
    output, bias = [[0.0] * s.dims for _ in range(2)], [math.log(1 - share), math.log(share)]
    done, epochs = 0, max(1, -(-s.updates // len(bags)))
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            bag, size = bags[i], len(bags[i])
            rate = s.rate * (1 - done / (epochs * len(bags)))
            done += 1
            hidden = [sum(share_of * start[b][d] for b, share_of in bag.items()) for d in range(s.dims)]
            logits = [sum(o * h for o, h in zip(output[c], hidden)) + bias[c] for c in range(2)]
            total = sum(math.exp(x) for x in logits)
            error = [math.exp(x) / total - (c == labels[i]) for c, x in enumerate(logits)]
            step = [sum(output[c][d] * error[c] for c in range(2)) for d in range(s.dims)]
            for c in range(2):
                output[c] = [o - rate * error[c] * h for o, h in zip(output[c], hidden)]
                bias[c] -= 0.1 * rate * error[c]
            for b, share_of in bag.items():
                start[b] = [v - rate * min(1, share_of * size) * g for v, g in zip(start[b], step)]
    difference = [b - a for a, b in zip(*output)]
    return [sum(v * d for v, d in zip(row, difference)) for row in start], bias[1] - bias[0]


def test_sgd_updates():
    s = quality.Settings(bits=8, dims=3, updates=150)
    texts = [t for t in TEXTS if t.strip()]
    sample = [(t, int("kind" in t)) for t in texts]
    bags = []
    for text in texts:
        found = np.concatenate([b for b, _ in quality._bags(Slice([0], [text], [len(text)]), s)])
        ids, counts = np.unique(found, return_counts=True)
        bags.append({int(b): float(n) / len(found) for b, n in zip(ids, counts)})
    table, bias = quality.train(iter(sample), s)
    want, want_bias = plain_sgd(bags, [y for _, y in sample], s)
    np.testing.assert_allclose(table, want, atol=2e-3)
    assert bias == pytest.approx(want_bias, abs=2e-3)


def test_one_label_only_gives_the_share():
    table, bias = quality.train(iter([("a b", 1), ("c", 1)]), quality.Settings(bits=4))
    assert not table.any() and bias == pytest.approx(math.log(3))
    model = toxicity.train(iter([("a b", 0)]), toxicity.Settings(bits=4))
    assert len(model.buckets) == 0 and model.bias == pytest.approx(math.log((1 / 3) / (2 / 3)))
