from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marketloom.llm import packing

SCHEMA = "doc_id long, text string, row string, part int"
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def pieces_of(text, length=2048):
    ids = np.array(TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
    return [(n, at, len(ids[at : at + length]), zlib.crc32(ids[at : at + length].tobytes())) for n, at in enumerate(range(0, len(ids), length))]


def check(found, rows):
    want = Counter((i, *piece) for i, text in rows for piece in pieces_of(text))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 2048
    return len(sequences)


def test_round_trip(spark):
    rng = np.random.default_rng(3)
    words = ["alpha", "beta,", "Gamma's", "été", "東京", "x1y2", "<|endoftext|>", "!!", "é", "̈a"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(1, 900)))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, " \n\t "), (None, "null id"), (903, "word\n" * 9000), (904, "a\tb c d\r\ne")]
    rows += [(905, "same row")] * 700
    docs = spark.createDataFrame([(i, t, "r", 1) for i, t in rows], SCHEMA)
    found = packing.pack(docs, packing.Settings(part_rows=100)).collect()
    number = check(found, rows)
    lengths = sorted((p[2] for _, t in rows for p in pieces_of(t)), reverse=True)
    at_once = len(packing.best_fit(lengths, 2048)[2])
    assert packing.lower_bound(np.array(lengths), 2048) <= number <= at_once + len(lengths) / 100
    assert packing.pack(spark.createDataFrame([], SCHEMA)).collect() == []


def test_exchange_saves_sequences(spark):
    rows = [(i, "w " * 1200) for i in range(40)] + [(100 + i, "w " * 700) for i in range(40)]
    docs = spark.createDataFrame([(i, t, "r", 1) for i, t in rows], SCHEMA)
    alone = check(packing.pack(docs, packing.Settings(part_rows=6, rounds=1)).collect(), rows)
    exchanged = check(packing.pack(docs, packing.Settings(part_rows=6, rounds=6)).collect(), rows)
    assert 40 <= exchanged <= alone


def test_a_whole_at_its_bound_is_not_dealt_anew(spark, monkeypatch):
    """Long pieces only: one to a sequence is the fewest, far above their volume, and the bound proves it."""
    rows = [(i, "w " * (1100 + i)) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "r", 1) for i, t in rows], SCHEMA)
    rounds, real = [], packing._packing

    def counted(pieces, number_of_rows, number, s):
        rounds.append(number)
        return real(pieces, number_of_rows, number, s)

    monkeypatch.setattr(packing, "_packing", counted)
    found = packing.pack(docs, packing.Settings(part_rows=10)).collect()
    lengths = [r["length"] for r in found]
    assert packing.lower_bound(np.array(lengths), 2048) == 60 > -(-sum(lengths) // 2048)
    assert check(found, rows) == 60 and rounds == [1] and all(r["certified"] for r in found)


def test_certificates(spark):
    """What a part's certificate says holds: no packing of its pieces has fewer sequences."""
    rng = np.random.default_rng(5)
    rows = [(i, "w " * int(rng.integers(200, 1500))) for i in range(300)]
    found = packing.pack(spark.createDataFrame([(i, t, "r", 1) for i, t in rows], SCHEMA), packing.Settings(part_rows=60)).collect()
    number = check(found, rows)
    lengths = sorted((r["length"] for r in found), reverse=True)
    assert packing.lower_bound(np.array(lengths), 2048) <= number <= len(packing.best_fit(lengths, 2048)[2]) + 3
    parts = defaultdict(list)
    for r in found:
        parts[r["sequence_id"] >> 26].append(r)
    assert all(len({r["certified"] for r in part}) == 1 for part in parts.values())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=9), st.integers(30, 40))
def test_lower_bound_never_exceeds_the_optimum(lengths, capacity):
    def fits(bins):
        rooms = [capacity] * bins

        def place(k):
            if k == len(order):
                return True
            for b in range(bins):
                if rooms[b] >= order[k] and rooms[b] not in rooms[:b]:
                    rooms[b] -= order[k]
                    if place(k + 1):
                        return True
                    rooms[b] += order[k]
            return False

        order = sorted(lengths, reverse=True)
        return place(0)

    optimum = next(n for n in range(len(lengths) + 1) if fits(n))
    bound = packing.lower_bound(np.array(lengths, np.int64), capacity)
    bins, places, left = packing.best_fit(sorted(lengths, reverse=True), capacity)
    assert bound <= optimum <= len(left)
    filled = Counter()
    for b, place, n in zip(bins, places, sorted(lengths, reverse=True)):
        assert place == filled[b]
        filled[b] += n
    assert all(capacity - filled[b] == room >= 0 for b, room in enumerate(left))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aZéÉÀſßµªİıΣσǅn'.,!?-1٣ \n\t\x85\u0308\u0958<|>東")))
def test_word_by_word_ids_of_any_text(text):
    got = packing._tokens(None).ids(text)
    assert got == np.array(TOKENIZER.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("text", ["It's  a​test don't", "ÀÉ ß ǅ İstanbul ΣΑΣ", "a" * 500 + " 123 4.5", "\x1c\x1d a\x85b"])
def test_word_by_word_ids(text):
    got = packing.WordTokens(None).ids(text)
    assert got == np.array(TOKENIZER.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
