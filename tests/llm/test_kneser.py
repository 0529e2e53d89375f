from __future__ import annotations

import re
from collections import Counter, defaultdict
from math import log10
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketloom.llm import kneser
from marketloom.llm.kneser import Settings

SCHEMA = "doc_id long, text string, score string, n_tokens int, range int"
BEGIN, END = "<begin>", "<end>"


def words(text):
    small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", small)


def is_held_out(doc_id):
    return doc_id is not None and crc32(str(doc_id).encode()) % 7 == 2


class Plain:
    """The model by its formulas, in dictionaries."""

    def __init__(self, texts):
        self.pair = Counter()
        self.word = Counter()
        for text in texts:
            line = words(text) + [END]
            self.word.update(line)
            self.pair.update(zip([BEGIN, *line], line))
        self.n, self.v = sum(self.word.values()), len(self.word)
        self.before = Counter(w for _, w in self.pair)
        self.follows = defaultdict(list)
        for (v, _), c in self.pair.items():
            self.follows[v].append(c)
        self.high, self.low = (self.found(c.values()) for c in (self.pair, self.before))

    @staticmethod
    def found(counts):
        n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
        return (0, *kneser.discounts(n))

    def alone(self, w):
        a, total = self.before[w], sum(self.before.values())
        left = sum(self.low[min(c, 3)] for c in self.before.values()) / total if total else 1
        return max(a - self.low[min(a, 3)], 0) / max(total, 1) + left / (self.v + 1)

    def p(self, v, w):
        if v not in self.follows:
            return self.alone(w)
        c, total = self.pair[v, w], sum(self.follows[v])
        left = sum(self.high[min(x, 3)] for x in self.follows[v]) / total
        return max(c - self.high[min(c, 3)], 0) / total + left * self.alone(w)

    def row(self, text):
        line = words(text) + [END]
        base = sum(log10((self.word[w] + 1) / (self.n + self.v + 1)) for w in line)
        score = sum(log10(self.p(v, w)) for v, w in zip([BEGIN, *line], line))
        return len(line), sum(self.word[w] > 0 for w in line), self.n, base, score


def check(spark, rows, settings=Settings()):
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)
    found = kneser.score_documents(docs, settings)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    model = Plain([t for i, t in rows if not is_held_out(i)])
    key = lambda r: (str(r[0]), r[2], r[5])
    got = sorted(map(tuple, found.collect()), key=key)
    want = sorted([(i, is_held_out(i), *model.row(t)) for i, t in rows], key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    np.testing.assert_allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9, atol=1e-12)
    return model


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(2)
    vocabulary = [f"w{i}" for i in range(80)] + ["The", "THE", "é x", "a,b", "東"]
    weights = 1 / np.arange(1, len(vocabulary) + 1)
    rows = [(i, " ".join(rng.choice(vocabulary, int(rng.integers(1, 60)), p=weights / weights.sum()))) for i in range(250)]
    rows += [(900, None), (901, ""), (902, " \n\t\r\x0b\x0c "), (None, "no id here"), (903, "tab\tline\nfeed " * 700), (904, "same row"), (904, "same row")]
    return rows + [(i, f"only here {i}") for i in range(2000, 2030)]


def test_against_the_formulas(spark, corpus):
    check(spark, corpus)


@pytest.mark.parametrize("small", [Settings(slice_chars=50, flush=40, range_tokens=200), Settings(slice_chars=7, flush=1000, range_tokens=30)])
def test_any_cut_gives_the_same(spark, corpus, small):
    check(spark, corpus, small)


def test_probabilities_sum_to_one(corpus):
    model = Plain([t for _, t in corpus])
    for v in (BEGIN, "the", "w3", "never seen"):
        assert abs(sum(model.p(v, w) for w in [*model.word, "unknown word"]) - 1) < 1e-9


def test_small_and_empty_tables(spark):
    check(spark, [(1, "one word"), (2, "one word")])
    held = next(i for i in range(100) if is_held_out(i))
    check(spark, [(held, "nothing to learn from")])
    assert kneser.score_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_held_out_texts_are_likelier_than_by_the_base(spark):
    rng = np.random.default_rng(3)

    def walk(size):
        at, out = 0, []
        for _ in range(size):
            at = (3 * at + int(rng.choice([1, 2, 7], p=[0.7, 0.2, 0.1]))) % 50
            out.append(f"w{at}")
        return " ".join(out)

    docs = spark.createDataFrame([(i, walk(int(rng.integers(5, 40))), "x", 1, 2) for i in range(250)], SCHEMA)
    rows = kneser.score_documents(docs).where("held_out").collect()
    assert len(rows) > 20 and sum(r["score"] for r in rows) > 0.6 * sum(r["base_score"] for r in rows)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aB \n\x0b\x1f é"), max_size=30)), max_size=5), st.integers(1, 12))
def test_slices_hold_all_tokens_once(texts, limit):
    at_once = {}
    for hashes, owner, fresh, _ in kneser.streams(texts, 10**6):
        for row in range(len(texts)):
            at_once[row] = hashes[owner == row].tolist()
    cut, begins = defaultdict(list), 0
    for hashes, owner, fresh, goes_on in kneser.streams(texts, limit):
        begins += len(fresh)
        for row in range(len(texts)):
            cut[row] += hashes[owner == row].tolist()
        assert goes_on or 0 in fresh
    assert begins == len(texts) and dict(cut) == at_once
    assert [len(at_once[r]) for r in range(len(texts))] == [len(words(t)) + 1 for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1))
def test_packed_numbers_come_back(values):
    assert kneser.unpacked(kneser.packed(np.array(values, np.uint64))).tolist() == values


def test_discounts():
    assert kneser.discounts([10, 5, 3, 2]) == pytest.approx((1 - 2 * 0.5 * 5 / 10, 2 - 3 * 0.5 * 3 / 5, 3 - 4 * 0.5 * 2 / 3))
    assert kneser.discounts([5, 0, 0, 0]) == kneser.FALLBACK == kneser.discounts([10, 1, 9, 5])
