"""Licence scan: ordered signature rules over the words of every text.

1. Prefilter: only rules whose words all occur in the text are tried, found by the rarest of
   those words.
2. Each tried rule gives detections, intervals of words; a rule with a group ``own`` those of the group.
3. Detections are taken by priority, then length, then place. One that lies inside a detection
   already taken, or contains one of higher priority, is suppressed; so are overlapping ones of lower
   priority by containment only, partial overlaps stay side by side.
4. The places of the fixed base phrases always count.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marketloom.llm.base import give_back, text_runs
from marketloom.llm.license_rules import BASE, Rule, rules

PART = 4_000_000  # bytes of a text handled at once
AHEAD = 8_192  # bytes of the next part a detection may reach into

# bytes of words stay, capital letters become small ones, all others separate words
_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


@cache
def _by_word() -> dict[bytes, list[Rule]]:
    """Rules under the word of theirs that fewest rules need."""
    needed = Counter(w for r in rules() for w in r.words)
    out = defaultdict(list)
    for rule in rules():
        out[min(rule.words, key=lambda w: (needed[w], w))].append(rule)
    return dict(out)


def _parts(text: bytes) -> Iterator[tuple[bytes, int]]:
    """The text with only words and blanks, in parts that overlap, and each part's own bytes."""
    words = text.translate(_WORDS)
    begin = 0
    while len(words) - begin > PART + AHEAD:
        cut = words.find(b" ", begin + PART)
        if cut < 0:
            break
        yield words[begin : cut + AHEAD], cut - begin
        begin = cut
    yield words[begin:], len(words) - begin


def resolve(detections: Iterable[tuple[int, int, int, str, float]]) -> list[tuple[int, int, int, str, float]]:
    """Detections (-priority, first word, end, label, confidence) that no better one suppresses.

    Of what is kept no detection lies inside another, so ordered by their first words they are ordered by
    their ends, too, and one look at a neighbour tells whether a detection lies inside a kept one or around
    one. Detections of one priority are first held against the kept ones of higher priority; those
    left suppress each other by containment alone, seen in one sweep.
    """
    groups = defaultdict(list)
    for d in set(detections):
        groups[d[0]].append(d)
    starts, ends, kept = np.zeros(0, np.int64), np.zeros(0, np.int64), []
    for priority in sorted(groups):
        group = sorted(groups[priority], key=lambda d: (d[1], -d[2], d[3], -d[4]))
        first, end = (np.array([d[k] for d in group], np.int64) for k in (1, 2))
        if len(starts):
            before, after = np.searchsorted(starts, first, "right") - 1, np.searchsorted(starts, first, "left")
            inside = (before >= 0) & (ends[np.maximum(before, 0)] >= end)
            around = (after < len(starts)) & (ends[np.minimum(after, len(starts) - 1)] <= end)
            left = np.flatnonzero(~(inside | around))
            first, end = first[left], end[left]
        else:
            left = np.arange(len(group))
        if len(left):
            reached = np.concatenate(([np.iinfo(np.int64).min], np.maximum.accumulate(end)[:-1]))
            alone = np.flatnonzero(end > reached)
            kept += [group[k] for k in left[alone]]
            starts, ends = np.concatenate((starts, first[alone])), np.concatenate((ends, end[alone]))
            order = np.argsort(starts, kind="stable")
            starts, ends = starts[order], ends[order]
    return kept


def scan(text: str | None) -> dict:
    """Result columns of one text; null counts as empty."""
    n_words, base, detections = 0, [], []
    anchors = _by_word()
    for raw, own in _parts((text or "").encode("utf-8", "surrogatepass")):
        listed = raw.split()
        own_words = len(listed) if own == len(raw) else len(raw[:own].split())
        present = anchors.keys() & set(listed)
        if present:
            words = set(listed)
            line = b" " + b" ".join(listed) + b" "
            # places of all blanks: a place's word is the number of blanks before it
            blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20).tolist()
            for phrase, label in BASE:
                sought, at = f" {phrase} ".encode(), -1
                while (at := line.find(sought, at + 1)) >= 0:
                    first = bisect_left(blanks, at)
                    if first < own_words:
                        base.append((n_words + first, label))
            for rule in (r for w in present for r in anchors[w] if r.words <= words):
                for m in rule.pattern.finditer(line):
                    first = bisect_left(blanks, m.start())
                    if first < own_words:
                        end = bisect_left(blanks, m.end(), first)
                        if "own" in rule.pattern.groupindex:
                            first = end - m["own"].count(b" ") - 1
                        detections.append((-rule.priority, n_words + first, n_words + end, rule.label, rule.confidence))
        n_words += own_words
    kept = resolve(detections)
    base_labels = {label for _, label in base}
    places = [first for first, _ in base]
    return {
        "n_words": n_words,
        "n_base": len(base),
        "first_word": min(places, default=None),
        "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(base_labels | {d[3] for d in kept})),
        "score": max([0.9 if base else 0.0, *(d[4] for d in kept)]),
        "detections": [{"label": d[3], "first": d[1], "end": d[2], "priority": -d[0]} for d in sorted(kept, key=lambda d: (d[1], d[2], d[3]))],
    }


_TYPES = {
    "n_words": pa.int64(),
    "n_base": pa.int64(),
    "first_word": pa.int64(),
    "last_word": pa.int64(),
    "base_labels": pa.string(),
    "labels": pa.string(),
    "score": pa.float64(),
    "detections": pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("priority", pa.int32())])),
}
_SCHEMA = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, "
    "detections array<struct<label: string, first: bigint, end: bigint, priority: int>>"
)


def scan_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts, labels, score and the detections' places.

    A null or empty text has no words and no labels; repeated rows and null ids are scanned like
    any other; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in text_runs(batch.column(1)):
                found = [scan(text) for text in texts]
                columns = [pa.array([f[name] for f in found], kind) for name, kind in _TYPES.items()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(texts)), *columns], ["doc_id", *_TYPES])
        give_back()

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, {_SCHEMA}")
