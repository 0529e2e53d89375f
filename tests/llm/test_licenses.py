from __future__ import annotations

import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from marketloom.llm import license_rules, licenses

SCHEMA = "doc_id long, text string, labels string, score double"
BASE = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}


def brute(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places = [(i, label) for label, phrase in BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def base_of(found):
    return tuple(found[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels"))


TOKENS = st.sampled_from(["under", "The", "MIT", "license", "Apache", "version", "2", "2.0", "cc", "BY-NC", "by", "nc", "sa", "é", "ſ", "_", "\n", "--", " ", "GPL", "v3", "K", "x"])


@settings(max_examples=300, deadline=None)
@given(st.lists(TOKENS, max_size=40), st.sampled_from([" ", "-", "", "\n"]))
def test_base_against_brute_force(tokens, glue):
    text = glue.join(tokens)
    found = licenses.scan(text)
    assert base_of(found) == brute(text)
    assert set(found["base_labels"].split(",")) - {""} <= set(found["labels"].split(","))
    assert 0 <= found["score"] <= 1


def test_prefilter_never_decides():
    texts = [
        "Licensed under the Apache License, Version 2.0 (the License)",
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: MIT OR BSD-3-Clause",
        "GPLv2 or later; LGPL-2.1; Mozilla Public License, v. 2.0; all rights reserved",
        "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    ]
    for text in texts:
        line = b" " + b" ".join(text.encode().translate(licenses._WORDS).split()) + b" "
        every = []
        for rule in license_rules.rules():
            for m in rule.pattern.finditer(line):
                first = line.count(b" ", 0, m.start())
                every.append((-rule.priority, first, first + m.group().count(b" "), rule.label, rule.confidence))
        want = {(d[3], d[1], d[2]) for d in licenses.resolve(every)}
        assert want == {(d["label"], d["first"], d["end"]) for d in licenses.scan(text)["detections"]} and want


def test_labels():
    def labels(text):
        return licenses.scan(text)["labels"]

    assert labels("This work is licensed under the GNU General Public License, version 3.") == "gpl-3"
    assert labels("Released under the MIT License.") == "mit"
    assert labels("Licensed under CC BY-NC 4.0.") == "cc-by-nc"
    assert labels("cc by nc sa 4.0") == "cc-by-nc,cc-by-nc-sa"
    assert labels("SPDX-License-Identifier: GPL-3.0-or-later") == "gpl-3-or-later"
    assert labels("GNU Lesser General Public License version 2.1") == "lgpl-2.1"
    assert labels("a licence to write clean prose, permitted by nobody") == ""


def test_every_licence_of_an_spdx_expression():
    def labels(text):
        return licenses.scan(f"SPDX-License-Identifier: {text}")["labels"]

    assert labels("Apache-2.0 OR MIT") == "apache-2,mit"
    assert labels("MIT OR Apache-2.0 OR Zlib") == "apache-2,mit,zlib"
    for tag in ("ISC", "Zlib", "PostgreSQL", "NCSA", "OpenSSL"):
        assert labels(f"MIT OR {tag}") == ",".join(sorted(["mit", tag.lower()]))
    assert labels("(GPL-2.0-only WITH Classpath-exception-2.0) OR MIT") == "gpl-2,mit"
    assert labels("GPL-2.0-or-later OR MIT") == "gpl-2-or-later,mit"
    assert labels("CC-BY-4.0 OR MIT") == "cc-by,mit"
    assert labels("Foo-1.0 OR MIT AND Zlib") == "mit,zlib"
    assert labels("Foo-1.0 OR GPL-3.0-or-later") == "gpl-3-or-later"
    assert labels("ISC OR MIT-0 OR MIT") == "isc,mit,mit-0"
    assert labels("MIT OR GPL-2.0-or-later OR ISC") == "gpl-2-or-later,isc,mit"
    assert labels("MIT\n// Uses curl and openssl") == "mit"


def test_containment():
    kept = licenses.resolve([(-80, 0, 9, "a", 1.0), (-60, 2, 5, "b", 1.0), (-50, 0, 12, "c", 1.0), (-50, 7, 11, "d", 1.0), (-80, 0, 9, "a", 1.0)])
    assert [d[3] for d in kept] == ["a", "d"]


def one_by_one(detections):
    """Suppression as it is defined: best first, each against all that are kept."""
    kept = []
    for d in sorted(set(detections), key=lambda d: (d[0], d[1] - d[2], d[1], d[3], -d[4])):
        inside = any(k[1] <= d[1] and d[2] <= k[2] for k in kept)
        around = any(d[1] <= k[1] and k[2] <= d[2] and k[0] < d[0] for k in kept)
        if not inside and not around:
            kept.append(d)
    return kept


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([-90, -80, -50]), st.integers(0, 12), st.integers(1, 6), st.sampled_from("ab"), st.sampled_from([0.5, 1.0])), max_size=14))
def test_suppression(found):
    detections = [(p, first, first + size, label, score) for p, first, size, label, score in found]
    assert sorted(licenses.resolve(detections)) == sorted(one_by_one(detections))


def test_long_repetitive_texts_take_linear_time():
    phrase = "under the mit license "
    licenses.scan(phrase)  # rules are compiled
    began = time.process_time()
    found = licenses.scan(phrase * 200_000)  # 4.4 MB
    assert time.process_time() - began < 60
    assert (found["n_words"], found["n_base"], found["first_word"], found["last_word"]) == (800_000, 200_000, 0, 799_996)
    assert len(found["detections"]) >= 200_000 and found["labels"] == "mit"


def test_rules():
    found = license_rules.rules()
    assert len(found) >= 300 and all(r.words for r in found)
    # the words that gate a rule occur in whatever its pattern can match
    for rule in found:
        assert all(w in rule.pattern.pattern for w in rule.words), rule


def test_parts_of_a_long_text(monkeypatch):
    text = ("filler words here " * 500 + "Released under the MIT License. ") * 30
    whole = licenses.scan(text)
    monkeypatch.setattr(licenses, "PART", 10_000)
    assert licenses.scan(text) == whole and whole["n_base"] == 30


def test_rows(spark):
    rows = [(1, "under the MIT license"), (2, None), (3, ""), (None, "cc by nc"), (1, "under the MIT license"), (4, "é" * 100_000)]
    docs = spark.createDataFrame([(i, t, "x", 0.5) for i, t in rows], SCHEMA)
    found = licenses.scan_documents(docs).collect()
    assert sorted(((r["doc_id"], *base_of(r)) for r in found), key=str) == sorted(((i, *brute(t)) for i, t in rows), key=str)
    assert licenses.scan_documents(spark.createDataFrame([], SCHEMA)).collect() == []
