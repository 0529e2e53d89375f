"""The fingerprint's published examples, and random texts against plain whole-number arithmetic."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException

from marketloom.functions.fingerprint import K0, K2, fingerprint

WRAP = 1 << 64


def mixed(u, v, by):
    a = (u ^ v) * by % WRAP
    b = (v ^ a ^ a >> 47) * by % WRAP
    return (b ^ b >> 47) * by % WRAP


def plain(text):
    data = text.encode()
    n = len(data)

    def word(at, width):
        return int.from_bytes(data[at : at + width], "little")

    def turned(x, bits):
        return x >> bits | x << 64 - bits & WRAP - 1

    by = K2 + 2 * n
    if n >= 8:
        a, b = (word(0, 8) + K2) % WRAP, word(n - 8, 8)
        found = mixed((turned(b, 37) * by + a) % WRAP, (turned(a, 25) + b) * by % WRAP, by)
    elif n >= 4:
        found = mixed(n + 8 * word(0, 4), word(n - 4, 4), by)
    elif n:
        a = (data[0] + 256 * data[n // 2]) * K2 % WRAP ^ (n + 4 * data[-1]) * K0 % WRAP
        found = (a ^ a >> 47) * K2 % WRAP
    else:
        found = K2
    return found - WRAP if found >= WRAP // 2 else found


def hashed(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    return [r["h"] for r in frame.select("i", fingerprint("t").alias("h")).orderBy("i").collect()]


def test_published_examples(spark):
    examples = {"1footrue": -1541654101129638711, "2applefalse": 2794438866806483259, "3true": -4880158226897771312}
    assert hashed(spark, list(examples)) == list(examples.values())


def test_against_plain_arithmetic(spark):
    rng = random.Random(3)
    texts = ["", "0", "\x00", "é", "日本", "01001", "99990", "ÿ" * 8, "\x7f" * 16]
    texts += ["".join(rng.choices("0123456789-aZé", k=rng.randint(1, 8))) for _ in range(300)]
    texts += ["".join(rng.choices("0123456789", k=rng.randint(1, 16))) for _ in range(300)]
    assert all(len(t.encode()) <= 16 for t in texts)
    assert hashed(spark, texts) == [plain(t) for t in texts]


def test_missing_and_long_texts(spark):
    assert hashed(spark, [None, "12345"]) == [None, plain("12345")]
    with pytest.raises(PySparkException, match="more than 16 bytes"):
        hashed(spark, ["12345678901234567"])
