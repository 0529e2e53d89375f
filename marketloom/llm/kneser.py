"""Language-model scoring: interpolated modified Kneser-Ney over word pairs.

Counting is one Spark job per table of the model; what moves between tasks are sorted, run-length
counted and compressed arrays, cut by range, so that a frequent word or pair is one entry per task:

1. words: 64-bit hashes of all training tokens with their counts, by ranges of the hash. A word's rank in
   the sorted array is its number.
2. pairs: key (number of the word before) << 32 | (number of the word), in order of the key; a word that is
   followed by very many others is cut over several ranges.
3. facts of every word: the number of different words before it, and how many words follow it once,
   twice and more often.

The tasks that merge a range write it as plain sorted arrays into the shared folder, under a draft name
first, so a task that runs again replaces its own files. Scoring tasks map these files into memory: pages
are shared between the workers of a machine and belong to the file system's cache, not to the task.

With c the pair's count, a(w) the number of different words before w, A their sum, and the discounts D of
modified Kneser-Ney (for counts 1, 2 and more, from the numbers of pairs or words of count 1 to 4):

    p(w | v) = max(c(v w) - D(c), 0) / c(v .) + g(v) p(w)
    p(w)     = max(a(w) - D'(a), 0) / A + g' / (V + 1)

where g gives the discounted mass of a context to the level below and V + 1 counts one unknown word. A
text is <start> word ... word <end>; an unknown context leaves p(w) alone.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.llm import grams
from marketloom.llm.base import parts_for, stored, text_runs
from marketloom.session import scratch_path

END, START = np.uint64(1), np.uint64(2)  # hashes of the two marks; no word of a text has them but by chance of 2**-63
HOLDOUT_MOD, HOLDOUT_REST = 7, 2
FALLBACK = (0.5, 1.0, 1.5)  # discounts where the counts of counts give none, as in very small corpora
_GAP = re.compile(r"[\x20\x09-\x0D]")
_U64 = np.uint64


@dataclass(frozen=True)
class Settings:
    """``slice_chars``: characters handled at once; ``flush``: tokens a task counts before it hands them
    on; ``range_tokens``: about as many tokens are merged in one task."""

    slice_chars: int = 500_000
    flush: int = 2_000_000
    range_tokens: int = 3_000_000


# ---- texts as tokens


def _pieces(texts: list[str | None], limit: int) -> Iterator[tuple[list[int], list[str], bool, bool]]:
    """Texts in slices of about ``limit`` characters: rows, parts, and whether the slice's first
    part goes on from the slice before and its last part goes on in the next. Cuts are between words."""
    rows, parts, size, goes_on = [], [], 0, False
    for row, text in enumerate(texts):
        text, begin = text or "", 0
        while True:
            end, more = len(text), False
            if end - begin > limit and (gap := _GAP.search(text, begin + limit)):
                end, more = gap.end(), True
            rows.append(row)
            parts.append(text[begin:end])
            size += end - begin
            if more or size >= limit:
                yield rows, parts, goes_on, more
                rows, parts, size, goes_on = [], [], 0, more
            if not more:
                break
            begin = end
    if rows:
        yield rows, parts, goes_on, False


def _gaps(points: np.ndarray) -> np.ndarray:
    return (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))


def tokens(parts: list[str], ends_open: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of each part and of its end (unless the last one stays open), their part, and where parts begin."""
    joined = " " + " ".join(parts) + "  "
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").copy()
    capital = (points >= 0x41) & (points <= 0x5A)
    points[capital] += 0x20
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    words, owner, _ = grams.Joined(points, _gaps(points), starts, starts + lengths).words()
    after = np.searchsorted(owner, np.arange(len(parts)), side="right")
    closed = len(parts) - ends_open
    hashes = np.insert(words, after[:closed], END)
    owner = np.insert(owner, after[:closed], np.arange(closed))
    return hashes, owner, np.searchsorted(owner, np.arange(len(parts)))


def streams(texts: list[str | None], limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """Per slice: token hashes, their rows, the places that follow a start mark, and whether the slice goes on
    from the one before."""
    unbegun = False  # the text that is cut had no word so far
    for rows, parts, goes_on, open_ in _pieces(texts, limit):
        goes_on = goes_on and not unbegun
        hashes, owner, begins = tokens(parts, open_)
        unbegun = open_ and begins[-1] == len(hashes) and not (goes_on and len(parts) == 1)
        if len(hashes):
            fresh = begins[int(goes_on) :]
            yield hashes, np.array(rows, np.int64)[owner], fresh[fresh < len(hashes)], goes_on


def befores(ranks: np.ndarray, fresh: np.ndarray, start: int, carried: int) -> np.ndarray:
    """The number of the word before each token."""
    out = np.empty_like(ranks)
    out[1:] = ranks[:-1]
    out[0] = carried
    out[fresh] = start
    return out


# ---- sorted arrays: in messages, in files, mapped


def counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and their counts or the sums of ``counts``."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    if counts is None:
        return keys[new], np.diff(np.append(new, len(keys)))
    return keys[new], np.add.reduceat(counts, new) if len(new) else np.zeros(0, np.int64)


def packed(values: np.ndarray) -> bytes:
    """Numbers as bytes: differences of neighbours, equal bytes of all numbers together, compressed."""
    moved = np.diff(values.astype(_U64), prepend=_U64(0))
    planes = np.ascontiguousarray(moved.view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    planes = np.frombuffer(pa.decompress(blob[8:], decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    with np.errstate(over="ignore"):
        return np.cumsum(np.ascontiguousarray(planes.reshape(8, n).T).view(_U64).ravel(), dtype=_U64)


def _local(folder: str) -> str:
    path = "/" + folder.removeprefix("file:").lstrip("/") if folder.startswith("file:") else folder
    if "://" in path:
        raise ValueError(f"workers map the model's files: spark.checkpoint.dir must be a mounted shared folder, not {folder}")
    return path


def _save(folder: str, name: str, values: np.ndarray) -> None:
    """Under a draft name first; a task that runs again writes the same values."""
    base = _local(folder)
    os.makedirs(base, exist_ok=True)
    draft = os.path.join(base, f".{name}.{TaskContext.get().taskAttemptId()}")
    values.tofile(draft)
    os.replace(draft, os.path.join(base, name))


def _mapped(folder: str, name: str, kind: str) -> np.ndarray:
    return np.memmap(os.path.join(_local(folder), name), kind, "r")


@dataclass(frozen=True)
class Words:
    """The vocabulary in ranges of the hash's first ``bits`` bits; ``starts``: number of each range's first word."""

    folder: str
    bits: int
    starts: tuple[int, ...]
    tokens: int

    @property
    def size(self) -> int:
        return self.starts[-1]


class MappedWords:
    def __init__(self, words: Words):
        self.words = words
        held = [b > a for a, b in zip(words.starts, words.starts[1:])]
        self.hashes, self.counts = (
            [_mapped(words.folder, f"words-{k}.{part}", kind) if full else np.zeros(0, kind) for k, full in enumerate(held)]
            for part, kind in (("hash", "<u8"), ("count", "<i8"))
        )

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers (-1: unknown) and counts of words, given in order of their hash."""
        ranks, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        cuts = np.searchsorted(_range_of(hashes, self.words.bits), np.arange(len(self.hashes) + 1))
        for k in range(len(self.hashes)):
            span = slice(cuts[k], cuts[k + 1])
            if cuts[k + 1] > cuts[k] and len(known := self.hashes[k]):
                at = np.minimum(np.searchsorted(known, hashes[span]), len(known) - 1)
                hit = known[at] == hashes[span]
                ranks[span] = np.where(hit, at + self.words.starts[k], -1)
                counts[span] = np.where(hit, self.counts[k][at], 0)
        return ranks, counts


def _range_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> _U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


@lru_cache(maxsize=2)
def _words(words: Words) -> MappedWords:
    return MappedWords(words)


# ---- counting


def _messages(ranges: np.ndarray, keys: np.ndarray, counts: np.ndarray, n: int) -> pa.RecordBatch:
    """Sorted keys and their counts, cut by their (rising) range."""
    cuts = np.searchsorted(ranges, np.arange(n + 1))
    held = np.flatnonzero(cuts[1:] > cuts[:-1])
    spans = [slice(cuts[k], cuts[k + 1]) for k in held]
    columns = [pa.array(held, pa.int64()), *(pa.array([packed(x[span]) for span in spans], pa.binary()) for x in (keys, counts))]
    return pa.RecordBatch.from_arrays(columns, ["range", "keys", "counts"])


_MESSAGES = "range bigint, keys binary, counts binary"


def _merged(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([unpacked(b) for b in group.column("keys").to_pylist()])
    counts = np.concatenate([unpacked(b) for b in group.column("counts").to_pylist()])
    keys, counts = counted(keys, counts)
    return keys, counts.astype(np.int64)


def _word_counts(bits: int, s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flushed() -> pa.RecordBatch:
            keys, counts = counted(np.concatenate(held))
            return _messages(_range_of(keys, bits), keys, counts, 1 << bits)

        for batch in batches:
            for _, texts in text_runs(batch.column(0)):
                for hashes, _, fresh, _ in streams(texts, s.slice_chars):
                    held += [hashes, np.full(len(fresh), START)]
                    size += len(hashes)
                    if size >= s.flush:
                        yield flushed()
                        held, size = [], 0
        if held:
            yield flushed()

    return run


_WORD_RANGE = "range bigint, words bigint, tokens bigint, frequent array<struct<at: bigint, count: bigint>>"


def _word_range(folder: str, frequent: int):
    """Write a range of the vocabulary; tells its size and its frequent words."""

    def run(group: pa.Table) -> pa.Table:
        hashes, counts = _merged(group)
        k = group.column("range")[0].as_py()
        _save(folder, f"words-{k}.hash", hashes.astype("<u8"))
        _save(folder, f"words-{k}.count", counts.astype("<i8"))
        often = [{"at": int(at), "count": int(counts[at])} for at in np.flatnonzero(counts > frequent)]
        kinds = pa.schema([("range", pa.int64()), ("words", pa.int64()), ("tokens", pa.int64()), ("frequent", pa.list_(pa.struct([("at", pa.int64()), ("count", pa.int64())])))])
        return pa.table([[k], [len(hashes)], [int(counts.sum())], [often]], schema=kinds)

    return run


def count_words(texts: DataFrame, folder: str, s: Settings) -> tuple[Words, list[tuple[int, int]]]:
    """Count the tokens of ``texts`` (text) and the frequent ones (number, count): at most as many as there are ranges."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = (parts_for(size // 6, s.range_tokens) - 1).bit_length()
    found = texts.mapInArrow(_word_counts(bits, s), _MESSAGES).groupBy("range").applyInArrow(_word_range(folder, s.range_tokens), _WORD_RANGE)
    ranges = {r["range"]: r for r in stored(found, "kneser-words").collect()}
    starts, frequent = [0], []
    for k in range(1 << bits):
        if k in ranges:
            frequent += [(starts[-1] + f["at"], f["count"]) for f in ranges[k]["frequent"]]
        starts.append(starts[-1] + (ranges[k]["words"] if k in ranges else 0))
    if starts[-1] >= 1 << 32:
        raise OverflowError("more than 2**32 distinct words: numbers of words have 32 bits")
    return Words(folder, bits, tuple(starts), sum(r["tokens"] for r in ranges.values())), frequent


def pair_bounds(words: Words, frequent: list[tuple[int, int]], s: Settings) -> np.ndarray:
    """First keys of the ranges of pairs: equal ranges of the word before, and several for a frequent one."""
    parts = parts_for(words.tokens, s.range_tokens)
    bounds = {(k * words.size // parts) << 32 for k in range(parts)}
    for rank, count in frequent:
        cut = parts_for(count, s.range_tokens)
        bounds |= {rank << 32 | (j * words.size // cut) for j in range(cut)} | {(rank + 1) << 32}
    return np.array(sorted(bounds), _U64)


def _pair_counts(words: Words, bounds: np.ndarray, s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _words(words)
        start = int(vocabulary.look_up(np.array([START]))[0][0])
        held, size = [], 0

        def flushed() -> pa.RecordBatch:
            keys, counts = counted(np.concatenate(held))
            return _messages(np.searchsorted(bounds, keys, side="right") - 1, keys, counts, len(bounds))

        for batch in batches:
            for _, texts in text_runs(batch.column(0)):
                last = -1
                for hashes, _, fresh, _ in streams(texts, s.slice_chars):
                    distinct, inverse = np.unique(hashes, return_inverse=True)
                    ranks = vocabulary.look_up(distinct)[0][inverse]
                    held.append(befores(ranks, fresh, start, last).astype(_U64) << _U64(32) | ranks.astype(_U64))
                    last = int(ranks[-1])
                    size += len(ranks)
                    if size >= s.flush:
                        yield flushed()
                        held, size = [], 0
        if held:
            yield flushed()

    return run


#: ``kind`` "range": a range of pairs was written, ``n`` holds numbers of pairs by count (1 to 4);
#: "facts": partial facts of words for the range ``range`` of word numbers.
_PAIR_RANGE = "kind string, range bigint, ranks binary, before binary, once binary, twice binary, more binary, n array<bigint>"


def _of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def _pair_range(folder: str, words: int, word_range: int):
    def run(group: pa.Table) -> pa.Table:
        keys, counts = _merged(group)
        k = group.column("range")[0].as_py()
        _save(folder, f"pairs-{k}.key", keys.astype("<u8"))
        _save(folder, f"pairs-{k}.count", counts.astype("<i8" if counts.max(initial=0) >> 32 else "<u4" if counts.max(initial=0) >> 16 else "<u2"))
        rows = [("range", k, b"", b"", b"", b"", b"", _of_counts(counts))]
        after, before = (keys & _U64(0xFFFFFFFF)), keys >> _U64(32)
        followed, many = counted(after)
        context, at = np.unique(before, return_inverse=True)
        classes = [np.bincount(at, weights=hit, minlength=len(context)).astype(np.int64) for hit in (counts == 1, counts == 2, counts >= 3)]
        ranks = np.union1d(followed, context)
        facts = np.zeros((4, len(ranks)), np.int64)
        facts[0, np.searchsorted(ranks, followed)] = many
        facts[1:, np.searchsorted(ranks, context)] = classes
        target = (ranks // _U64(word_range)).astype(np.int64)
        cuts = np.searchsorted(target, np.arange(parts_for(words, word_range) + 1))
        for part in np.flatnonzero(cuts[1:] > cuts[:-1]):
            span = slice(cuts[part], cuts[part + 1])
            rows.append(("facts", int(part), packed(ranks[span]), *(packed(f[span]) for f in facts), []))
        kinds = [pa.string(), pa.int64(), *[pa.binary()] * 5, pa.list_(pa.int64())]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[f.split()[0] for f in _PAIR_RANGE.split(", ")])

    return run


def _fact_range(folder: str, words: int, word_range: int):
    """Write the facts of a range of words; tells the numbers of words by words before them."""

    def run(group: pa.Table) -> pa.Table:
        part = group.column("range")[0].as_py()
        first = part * word_range
        facts = np.zeros((4, min(word_range, words - first)), np.int64)
        for row in group.select(["ranks", "before", "once", "twice", "more"]).to_batches(64):
            for blobs in row.to_pylist():
                at = unpacked(blobs.pop("ranks")).astype(np.int64) - first
                for k, blob in enumerate(blobs.values()):
                    facts[k, at] += unpacked(blob).astype(np.int64)
        _save(folder, f"facts-{part}", facts.astype("<u4"))
        many = facts[0]
        return pa.table({"range": [part], "n": pa.array([[*_of_counts(many), int((many >= 3).sum()), int(many.sum())]], pa.list_(pa.int64()))})

    return run


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Of counts 1, 2 and more, from the numbers of entries of count 1 to 4."""
    if min(n[:4]) > 0:
        y = n[0] / (n[0] + 2 * n[1])
        found = tuple(k + 1 - (k + 2) * y * n[k + 1] / n[k] for k in range(3))
        if all(0 < d <= k + 1 for k, d in enumerate(found)):
            return found
    return FALLBACK


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the few numbers that hold for all of them."""

    words: Words
    bounds: tuple[int, ...]
    word_range: int
    documents: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    pairs: int  # distinct ones
    leftover: float  # mass of the lower level that goes to all words alike

    @property
    def train_tokens(self) -> int:
        return self.words.tokens - self.documents

    @property
    def vocabulary(self) -> int:
        return max(0, self.words.size - 1)  # without the start mark


def train(texts: DataFrame, settings: Settings = Settings()) -> Model:
    """Count the model of ``texts`` (text; null: empty) and store it in the shared folder."""
    s = settings
    folder = scratch_path(texts.sparkSession, "kneser-model")
    documents = texts.count()
    words, frequent = count_words(texts, folder, s)
    bounds = pair_bounds(words, frequent, s)
    word_range = max(1, s.range_tokens // 2)
    found = texts.mapInArrow(_pair_counts(words, bounds, s), _MESSAGES).groupBy("range").applyInArrow(_pair_range(folder, words.size, word_range), _PAIR_RANGE)
    found = stored(found, "kneser-pairs")
    sums = [F.coalesce(F.sum(F.col("n")[k]), F.lit(0)) for k in range(4)]
    written = found.where("kind = 'range'")
    of_pairs = list(written.agg(*sums).first())
    held = {r["range"] for r in written.select("range").collect()}
    facts = found.where("kind = 'facts'").groupBy("range").applyInArrow(_fact_range(folder, words.size, word_range), "range bigint, n array<bigint>")
    ones, twos, threes, fours, more, pairs = stored(facts, "kneser-facts").agg(*sums, *[F.coalesce(F.sum(F.col("n")[k]), F.lit(0)) for k in (4, 5)]).first()
    lower = discounts([ones, twos, threes, fours])
    leftover = (lower[0] * ones + lower[1] * twos + lower[2] * more) / pairs if pairs else 1.0
    # an empty range has no file; its first key goes to the range before it
    kept = tuple(-1 if k not in held else int(b) for k, b in enumerate(bounds.tolist()))
    return Model(words, kept, word_range, documents, discounts(of_pairs), lower, pairs, leftover)


# ---- scoring


class Scorer:
    """The model's arrays, mapped."""

    def __init__(self, model: Model):
        self.model, folder = model, model.words.folder
        self.words = _words(model.words)
        held = [k for k, b in enumerate(model.bounds) if b >= 0]
        self.bounds = np.array([model.bounds[k] for k in held], _U64)
        self.keys = [_mapped(folder, f"pairs-{k}.key", "<u8") for k in held]
        self.counts = []
        for k, keys in zip(held, self.keys):
            width = os.path.getsize(os.path.join(_local(folder), f"pairs-{k}.count")) // max(1, len(keys))
            self.counts.append(_mapped(folder, f"pairs-{k}.count", {8: "<i8", 4: "<u4"}.get(width, "<u2")))
        n = model.words.size
        self.facts = [_mapped(folder, f"facts-{k}", "<u4").reshape(4, -1) for k in range(parts_for(n, model.word_range) if n else 0)]
        self.start = int(self.words.look_up(np.array([START]))[0][0])

    def facts_of(self, ranks: np.ndarray) -> np.ndarray:
        """Words before, followers met once, twice and more of words in order of their number (-1: none)."""
        out = np.zeros((4, len(ranks)), np.int64)
        cuts = np.searchsorted(ranks, np.arange(len(self.facts) + 1) * self.model.word_range)
        for k, facts in enumerate(self.facts):
            if cuts[k + 1] > cuts[k]:
                out[:, cuts[k] : cuts[k + 1]] = facts[:, ranks[cuts[k] : cuts[k + 1]] - k * self.model.word_range]
        return out

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of pairs in order of their key."""
        out = np.zeros(len(keys), np.int64)
        cuts = np.append(np.searchsorted(keys, self.bounds), len(keys))
        for k, (known, counts) in enumerate(zip(self.keys, self.counts)):
            span = slice(cuts[k], cuts[k + 1])
            if cuts[k + 1] > cuts[k] and len(known):
                at = np.minimum(np.searchsorted(known, keys[span]), len(known) - 1)
                out[span] = np.where(known[at] == keys[span], counts[at], 0)
        return out

    def score(self, texts: list[str | None], limit: int) -> list[np.ndarray]:
        """Per text: tokens, known tokens, base score and the model's score."""
        m, n = self.model, len(texts)
        out = [np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)]
        last, last_count = -1, 0
        high, low = (np.array([0.0, *d]) for d in (m.pair_discounts, m.word_discounts))
        for hashes, owner, fresh, goes_on in streams(texts, limit):
            distinct, inverse = np.unique(hashes, return_inverse=True)
            ranks, counts = self.words.look_up(distinct)
            base = np.log10((counts + 1) / (m.train_tokens + m.vocabulary + 1))
            order = np.argsort(ranks, kind="stable")
            facts = np.empty((4, len(ranks)), np.int64)
            facts[:, order] = self.facts_of(ranks[order])
            many = facts[0]
            alone = np.maximum(many - low[np.minimum(many, 3)], 0) / max(1, m.pairs) + m.leftover / (m.vocabulary + 1)

            word = ranks[inverse]
            before = befores(word, fresh, self.start, last if goes_on else self.start)
            contexts, at = np.unique(before, return_inverse=True)
            once, twice, more = self.facts_of(contexts)[1:]
            seen = np.zeros(len(contexts), np.int64)
            known = {int(r): int(c) for r, c in ((self.start, m.documents), (last, last_count)) if r >= 0}
            place = np.searchsorted(ranks[order], contexts)
            place[place == len(ranks)] = 0
            here = ranks[order][place] == contexts
            seen[here] = counts[order][place[here]]
            for rank, count in known.items():
                seen[contexts == rank] = count
            seen[contexts < 0] = 0
            rest = np.where(seen > 0, (high[1] * once + high[2] * twice + high[3] * more) / np.maximum(seen, 1), 1.0)

            keys = before.astype(_U64) << _U64(32) | word.astype(_U64)
            both = (before >= 0) & (word >= 0)
            found = np.zeros(len(keys), np.int64)
            asked, back = np.unique(keys[both], return_inverse=True)
            found[both] = self.pair_counts(asked)[back]
            p = np.maximum(found - high[np.minimum(found, 3)], 0) / np.maximum(seen, 1)[at] + rest[at] * alone[inverse]
            for values, weights in zip(out, (None, counts[inverse] > 0, base[inverse], np.log10(p))):
                values += np.bincount(owner, weights, minlength=n).astype(values.dtype)
            last, last_count = int(word[-1]), int(counts[inverse[-1]])
        return out


@lru_cache(maxsize=1)
def _scorer(model: Model) -> Scorer:
    return Scorer(model)


def _scored(model: Model, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for batch in batches:
            for begin, texts in text_runs(batch.column(1)):
                columns = [batch.column(0).slice(begin, len(texts)), *map(pa.array, scorer.score(texts, limit))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return run


def held_out():
    """Whether crc32 of the id as text leaves the held-out rest; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % HOLDOUT_MOD == HOLDOUT_REST, F.lit(False))


def score_documents(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs`` (doc_id, text).

    Learns from the rows that are not held out; a null id is not. A null or empty text is its end alone. Repeated
    rows count and are scored one by one. Without training rows every word is unknown and all are equally
    likely. An empty table gives an empty result.
    """
    model = train(docs.where(~held_out()).select("text"), settings)
    schema = T.StructType(
        [docs.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known")), *(T.StructField(c, T.DoubleType()) for c in ("base_score", "score"))]
    )
    scored = docs.select("doc_id", "text").mapInArrow(_scored(model, settings.slice_chars), schema)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.train_tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )
