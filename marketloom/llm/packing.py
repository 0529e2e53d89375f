"""Best-fit packing of tokenized documents into sequences, certified by lower bounds.

Pieces shorter than a sequence are dealt to parts of bounded size. Each part is packed by
best-fit decreasing, and dual-feasible functions give a lower bound on its number of
sequences; a part at its bound is certified to have the fewest. The same bound over the lengths of all
pieces tells when the whole has the fewest: then nothing is dealt anew. Else parts exchange pieces: a part
above its bound, and one whose bound is above its volume, since its long pieces may be filled up
elsewhere. What lies in their sequences with room left, and in sequences less than half full anywhere, is dealt
anew, to fewer and larger parts, and packed again, as long as that saves sequences.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.base import give_back, parts_for, stored, text_runs

WORD_CACHE = 600_000  # words, and parts of words, a worker remembers before it starts anew


@dataclass(frozen=True)
class Settings:
    """``tokenizer``: path of a tokenizers file on every executor, or null for the public
    ``word_bpe_49k.json``, which is faster; ``part_rows``: pieces packed in one task of the first round, four times
    as many in each later one; ``rounds`` at most, the first included."""

    length: int = 2048
    end_id: int = 0
    tokenizer: str | None = None
    part_rows: int = 20_000
    rounds: int = 4


class WordTokens:
    """Token ids of texts; with the default tokenizer they are remembered per word.

    That one drops white space and never joins characters across it, so the ids of a text are
    those of its words between blanks and line ends, in order. It also never joins letters and
    punctuation, and it lower-cases: a word of Latin letters with marks behind it has the ids of its
    small letters, then those of the marks. Such letters need no further preparation, so they go to a
    copy of the tokenizer that only splits at blanks. Other words are given to it as they are.
    """

    def __init__(self, path: str | None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.by_word = path is None
        path = path or public_tokenizers.path("word_bpe_49k.json")
        self.tokenizer, self.prepared = Tokenizer.from_file(path), Tokenizer.from_file(path)
        if self.by_word:
            self.prepared.normalizer = normalizers.Sequence([])
            self.prepared.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
            )
        self.words: dict[str, bytes] = {}
        self.stems: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if not self.by_word:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words = text.replace("\n", " ").split(" ")
        if new := set(words).difference(self.words):
            if len(self.words) + len(new) > WORD_CACHE:
                self.words.clear()
                new = set(words)
            self._learn(list(new))
        return b"".join(map(self.words.__getitem__, words))

    def _learn(self, new: list[str]) -> None:
        if len(self.stems) > WORD_CACHE:
            self.stems.clear()
        cut, letters, rest = [], set(), set()
        for word in new:
            stem = word.rstrip(".,;:!?")
            if stem.isalpha() and (stem.isascii() or max(stem) < "\u0130"):
                stem, tail = stem.lower(), word[len(stem) :]
                letters.add(stem)
            else:
                stem, tail = word, ""
                rest.add(stem)
            rest.add(tail)
            cut.append((stem, tail))
        if letters := list(letters.difference(self.stems)):
            found = self.prepared.encode(" ".join(letters), add_special_tokens=False)
            ids, owner = np.array(found.ids, "<u4").tobytes(), np.array(found.word_ids)
            ends = (4 * np.searchsorted(owner, np.arange(len(letters)), side="right")).tolist()
            for part, begin, end in zip(letters, [0, *ends], ends):
                self.stems[part] = ids[begin:end]
        if rest := list(rest.difference(self.stems)):
            for part, found in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
                self.stems[part] = np.array(found.ids, "<u4").tobytes()
        for word, (stem, tail) in zip(new, cut):
            self.words[word] = self.stems[stem] + self.stems[tail] if tail else self.stems[stem]


@cache
def _tokens(path: str | None) -> WordTokens:
    return WordTokens(path)


def _pieces(s: Settings, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, width, end = _tokens(s.tokenizer), 4 * s.length, np.array([s.end_id], "<u4").tobytes()
        for batch in batches:
            for begin, texts in text_runs(batch.column(1)):
                rows, out = [], {"piece": [], "start": [], "length": [], "ids_crc32": []}
                for row, text in enumerate(texts, begin):
                    ids = encoder.ids(text or "") + end
                    for piece, at in enumerate(range(0, len(ids), width)):
                        part = ids[at : at + width]
                        rows.append(row)
                        for column, value in zip(out.values(), (piece, at // 4, len(part) // 4, zlib.crc32(part))):
                            column.append(value)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
                arrays = [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(v, k) for v, k in zip(out.values(), kinds))]
                yield pa.RecordBatch.from_arrays(arrays, names)
        give_back()

    return run


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and place of each length, taken in the given order, and the room left in every bin."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    bins, places, left = [], [], []
    for n in lengths:
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(left)
            left.append(capacity)
        bins.append(b)
        places.append(capacity - room)
        left[b] = room - n
        by_room[room - n].append(b)
        rooms |= 1 << (room - n)
    return bins, places, left


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: the best bound of two families of dual-feasible functions.

    f is dual feasible if numbers that sum to the capacity at most have images that do, too; so the
    images of all lengths fill at least their sum over the capacity.
    """
    return bound_of_counts(np.bincount(lengths, minlength=capacity + 1)[: capacity + 1].astype(np.int64), capacity)


def bound_of_counts(counts: np.ndarray, capacity: int) -> int:
    """The same from the number of pieces of every length."""
    x = np.arange(capacity + 1, dtype=np.int64)
    number, volume = np.cumsum(counts), np.cumsum(counts * x)
    best = -(-int(volume[-1]) // capacity)
    # lengths above capacity - e count as whole, those below e as nothing
    e = np.arange(1, capacity // 2 + 1)
    whole = (number[-1] - number[capacity - e]) * capacity
    between = volume[capacity - e] - volume[e - 1]
    best = max(best, int((-(-(whole + between) // capacity)).max(initial=0)))
    # lengths rounded to multiples of capacity / k, scaled by k
    for k in range(1, 41):
        scaled = (k + 1) * x
        image = np.where(scaled % capacity == 0, k * x, scaled // capacity * capacity)
        best = max(best, -(-int((counts * image).sum()) // (k * capacity)))
    return best


def _packed(s: Settings):
    """Pack the pieces of one part; ``open`` marks pieces to exchange."""

    def run(group: pa.Table) -> pa.Table:
        lengths = group.column("length").to_numpy()
        row = group.column("row").to_numpy()
        order = np.lexsort((row, -lengths))
        bins, places, left = best_fit(lengths[order].tolist(), s.length)
        bound = lower_bound(lengths, s.length)
        bins = np.array(bins, np.int64)
        table = group.select(["row", "length", "part"]).take(pa.array(order))
        room = np.array(left, np.int64)[bins]
        wasteful = len(left) > bound or bound > -(-int(lengths.sum()) // s.length)
        loose = (room > 0) & wasteful | (2 * room > s.length)
        certified = np.full(len(bins), len(left) == bound)
        for name, values in (("bin", bins), ("offset", np.array(places, np.int64)), ("open", loose), ("certified", certified)):
            table = table.append_column(name, pa.array(values))
        return table

    return run


def _packing(pieces: DataFrame, rows: int, number: int, s: Settings) -> DataFrame:
    # later rounds have fewer pieces and may gather more of them in a part
    parts = parts_for(rows, s.part_rows * 4 ** (number - 1))
    dealt = pieces.select("row", "length", F.pmod(F.xxhash64("row", F.lit(number)), F.lit(parts)).alias("part"))
    done = dealt.groupBy("part").applyInArrow(
        _packed(s), "row bigint, length bigint, part bigint, bin bigint, offset bigint, open boolean, certified boolean"
    )
    # round, part and bin in one number
    sequence = F.shiftleft(F.lit(number).cast("bigint"), 58) + F.shiftleft("part", 26) + F.col("bin")
    return stored(done.withColumn("sequence_id", sequence).select("row", "length", "offset", "sequence_id", "open", "certified"), "packing-round")


def _sequences(packed: DataFrame) -> int:
    return packed.where("offset = 0").count()


def certified_whole(short: DataFrame, capacity: int) -> int:
    """No packing of all these pieces has fewer sequences; from a count per length, as many as a sequence has places."""
    counts = np.zeros(capacity + 1, np.int64)
    for row in short.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    return bound_of_counts(counts, capacity)


def pack(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset and certified of every piece of ``docs``.

    ``certified`` tells whether the part that the piece was packed in last has provably the fewest sequences for its pieces.

    A null text is empty: its one piece holds the end id alone. Rows are packed one by one, also
    repeated ones and those with a null doc_id. An empty table gives an empty result.
    """
    s = settings
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    pieces = stored(
        docs.select("doc_id", "text").mapInArrow(_pieces(s, names), f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint")
        .withColumn("row", F.monotonically_increasing_id()),
        "packing-pieces",
    )
    short = pieces.where(F.col("length") < s.length)
    now = _packing(short, short.count(), 1, s)
    fixed: list[DataFrame] = []
    fewest, total = certified_whole(short, s.length), _sequences(now)
    for number in range(2, s.rounds + 1):
        loose = now.where("open")
        rows = loose.count()
        if not rows or total <= fewest:
            break
        again = _packing(loose, rows, number, s)
        saved = _sequences(loose) - _sequences(again)
        if saved <= 0:
            break
        total -= saved
        fixed.append(now.where("NOT open"))
        now = again
    for part in fixed:
        now = now.union(part)
    placed = now.select("row", "sequence_id", "offset", "certified")
    whole = pieces.where(F.col("length") == s.length)
    return (
        pieces.where(F.col("length") < s.length)
        .join(placed, "row")
        .select(*names, "sequence_id", "offset", "certified")
        .union(whole.select(*names, -F.col("row") - 1, F.lit(0).cast("bigint"), F.lit(True)))
    )
