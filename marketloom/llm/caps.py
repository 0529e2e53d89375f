"""Near-duplicate embeddings by spherical-cap filters.

A filter is a direction; a vector passes it if its cosine with it is at least ``height``, so it
lies in a cap around that direction. Directions come from a random product code: after a
random rotation a vector is cut in two halves, each half has its own codebook of random unit
vectors, and every pair of codewords is a direction. The cosine is the mean of the halves' sums, so
all filters a vector passes are listed from two short sorted lists, without trying the others.
Vectors of one label that share a filter are candidates; 64 signs of random projections rule
most of them out, the rest is verified by cosine in double precision. A filter that many vectors pass is
taken in blocks, and there, too, only pairs with similar signs go on; vectors with many of them in one
block, such as near copies, are put in clusters and compared inside these.

The height follows from the width, so that a vector of any width passes about as many filters;
narrow vectors have fewer and wider caps. A vector that passes few filters has its best ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm import pairing
from marketloom.llm.base import stored
from marketloom.llm.components import connected


@dataclass(frozen=True)
class Settings:
    """``words``: codewords of a half; ``apart``: signs in which a candidate pair may differ (at
    cosine 0.93 one pair in 100,000 differs in more); ``small``, ``block`` and ``many`` as in the pairing
    (of two unrelated vectors in a cap about one pair in 30 has similar signs, so a block of 1,024 holds about 35).
    ``height`` and ``words`` hold as they are if a height is given; else the height follows from
    the width, and narrow vectors have fewer words. A vector has at least its ``least`` best filters."""

    threshold: float = 0.93
    words: int = 1024
    height: float | None = None
    least: int = 64
    apart: int = 20
    small: int = 16
    block: int = 1024
    many: int = 128
    seed: int = 19


KNOWN = (64, 0.44)  # a width and its height; other widths have the same share of directions in a cap
HIGHEST = 0.6  # narrower caps hold too little of the directions that a pair at the threshold shares


@dataclass(frozen=True)
class Code:
    """Random rotation, the halves' codebooks and the sign directions for vectors of one width."""

    rotation: np.ndarray
    books: tuple[np.ndarray, np.ndarray]
    signs: np.ndarray
    height: float


def _caps(width: int) -> tuple[np.ndarray, np.ndarray]:
    """Falling heights and the share of all directions in a cap of each."""
    angles = np.linspace(0, np.pi, 100_001)
    shares = np.cumsum(np.sin(angles) ** (width - 2)) if width > 2 else np.arange(1.0, len(angles) + 1)
    return np.cos(angles), shares / shares[-1]


def fitted(width: int, s: Settings) -> tuple[float, int]:
    """Height and number of words for vectors of one width."""
    if s.height is not None:
        return s.height, s.words
    heights, shares = _caps(KNOWN[0])
    share = shares[np.searchsorted(-heights, -KNOWN[1])]
    heights, shares = _caps(max(2, width))
    if width == KNOWN[0]:
        return KNOWN[1], s.words
    height = float(heights[np.searchsorted(shares, share)])
    if height <= HIGHEST:
        return height, s.words
    held = shares[np.searchsorted(-heights, -HIGHEST)]
    return HIGHEST, int(np.ceil(s.words * np.sqrt(share / held)))


@lru_cache(maxsize=8)
def code(width: int, s: Settings) -> Code:
    rng = np.random.default_rng([s.seed, width])
    size = max(2, width)
    rotation = np.linalg.qr(rng.normal(size=(size, size)))[0][:width]
    height, words = fitted(width, s)
    books = []
    for part in (size // 2, size - size // 2):
        book = rng.normal(size=(words, part)) if part > 1 else np.array([[1.0], [-1.0]])
        books.append(book / np.linalg.norm(book, axis=1, keepdims=True))
    return Code(rotation, (books[0], books[1]), rng.normal(size=(width, 64)), height)


def filters(units: np.ndarray, s: Settings) -> list[np.ndarray]:
    """Numbers of all filters that each unit vector passes, or of its best ones where those are few."""
    c = code(units.shape[1], s)
    turned = units @ c.rotation
    cut = c.books[0].shape[1]
    left, right = turned[:, :cut] @ c.books[0].T, turned[:, cut:] @ c.books[1].T
    need = c.height * np.sqrt(2)  # both codewords have length 1, so their pair has length sqrt(2)
    out = []
    for x, y in zip(left, right):
        i, j = np.flatnonzero(x >= need - y.max()), np.flatnonzero(y >= need - x.max())
        a, b = np.nonzero(x[i][:, None] + y[j] >= need)
        if len(a) < s.least:
            # the best sums are made of the best words of both halves
            i, j = np.argsort(-x)[: s.least], np.argsort(-y)[: s.least]
            sums = x[i][:, None] + y[j]
            a, b = np.unravel_index(np.argsort(-sums, axis=None)[: s.least], sums.shape)
        out.append(i[a] * np.int64(s.words) + j[b])
    return out


def sketches(units: np.ndarray, s: Settings) -> np.ndarray:
    """The signs of 64 random projections as one number."""
    bits = np.packbits(units @ code(units.shape[1], s).signs > 0, axis=1)
    return bits.view(np.int64).ravel()


def _vector(values: list | None) -> np.ndarray | None:
    """As doubles; None for a vector that links with nothing."""
    if not values or any(v is None for v in values):
        return None
    vector = np.array(values, np.float64)
    return vector if np.isfinite(vector).all() and vector.any() else None


def _unit(vector: np.ndarray) -> np.ndarray:
    scaled = vector / np.abs(vector).max()  # so that no square overflows
    return scaled / np.linalg.norm(scaled)


def _classes():
    """Key of the equal vectors of a label, and the vector as unit doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, units = [], []
            for label, values in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                vector = None if label is None else _vector(values)
                units.append(None if vector is None else _unit(vector).tobytes())
                nodes.append(None if vector is None else md5(repr(label).encode() + b"|" + units[-1], usedforsecurity=False).digest())
            columns = [batch.column(0), batch.column(1), pa.array(nodes, pa.binary()), pa.array(units, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "node", "unit"])

    return run


def _passed(s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                units = [np.frombuffer(u, np.float64) for u in part.column("unit").to_pylist()]
                lists: list = [None] * len(units)
                marks = np.zeros(len(units), np.int64)
                widths = np.array([len(u) for u in units])
                for width in np.unique(widths):
                    at = np.flatnonzero(widths == width)
                    matrix = np.stack([units[k] for k in at])
                    marks[at] = sketches(matrix, s)
                    for k, found in zip(at, filters(matrix, s)):
                        lists[k] = found
                columns = [
                    part.column("node"),
                    part.column("label"),
                    pa.array(widths, pa.int32()),
                    pa.array(lists, pa.list_(pa.int64())),
                    pa.array(marks, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["node", "label", "width", "filters", "sketch"])

    return run


def _verified(s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                float(np.frombuffer(x, np.float64) @ np.frombuffer(y, np.float64)) >= s.threshold
                for x, y in zip(batch.column("unit_a").to_pylist(), batch.column("unit_b").to_pylist())
            ]
            yield batch.select(["a", "b", "copies_a", "copies_b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _compared(s: Settings):
    """Links between two blocks of a cluster (or inside one): all members have one label and width."""

    def run(group: pa.Table) -> pa.Table:
        left, right, one = pairing.sides(group)
        units = [np.frombuffer(u, np.float64) for u in group.column("unit").to_pylist()]
        i = j = np.zeros(0, np.int64)
        if len(left) and len(right):
            near = np.stack([units[k] for k in left]) @ np.stack([units[k] for k in right]).T >= s.threshold
            i, j = np.nonzero(np.triu(near, 1) if one else near)
        return pairing.summary(left[i], right[j], group.column("node").to_pylist(), group.column("copies").to_numpy())

    return run


def link_near(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """vec_id, n_links, component_id, n_copies and kept for every row of ``vectors`` (vec_id, embedding, label).

    Vectors link when their labels are equal and their cosine is at least the threshold. Vectors that are
    null, empty, zero or hold null or non-finite components, vectors of different width and rows
    without a label link with nothing; such a row is its own component. Equal vectors of a label
    are one class until the end, so that copies are counted and never paired. Repeated rows are
    copies of each other. A row with a null id can link; a component without any id has a null
    component_id and its rows are kept. An empty table gives an empty result.
    """
    s = settings
    kinds = {c: vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    base = stored(
        vectors.select("vec_id", "label", "embedding").mapInArrow(
            _classes(), f"vec_id {kinds['vec_id']}, label {kinds['label']}, node binary, unit binary"
        ),
        "caps-rows",
    )
    classes = stored(
        base.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.min("label").alias("label"), F.min("unit").alias("unit")),
        "caps-classes",
    )
    passed = classes.select("node", "label", "unit").mapInArrow(
        _passed(s), f"node binary, label {kinds['label']}, width int, filters array<bigint>, sketch bigint"
    )
    rows = passed.select("node", "sketch", "label", "width", F.explode("filters").alias("filter")).select(
        "node", "sketch", F.xxhash64("label", "width", "filter").alias("bucket")
    )
    found = pairing.members(rows, "caps-members")
    crowds = stored(pairing.crowds(found, s.small, s.block, s.apart, s.many).distinct(), "caps-crowds")
    clustered = connected(crowds.where("NOT listed").select("a", "b")).select("node", F.col("root").alias("cluster"))
    likely = F.expr(f"bit_count(x.sketch ^ y.sketch) <= {s.apart}")
    few = pairing.few_pairs(found, clustered, s.small, likely)
    pairs = few.union(pairing.outside(crowds.where("listed").select("a", "b"), clustered)).distinct()
    for side in ("a", "b"):
        named = classes.select(*[F.col(c).alias(n) for c, n in (("node", side), ("unit", f"unit_{side}"), ("copies", f"copies_{side}"), ("label", f"label_{side}"))])
        pairs = pairs.join(named, side)
    # a bucket is a hash of label, width and filter, so equal labels and widths are checked here
    pairs = pairs.where("label_a = label_b AND octet_length(unit_a) = octet_length(unit_b)")
    links = stored(pairs.mapInArrow(_verified(s), "a binary, b binary, copies_a bigint, copies_b bigint"), "caps-links")
    within = stored(
        pairing.blocks(clustered, s.block)
        .join(classes.select("node", "copies", "unit"), "node")
        .groupBy("cluster", "low", "high")
        .applyInArrow(_compared(s), pairing.WITHIN),
        "caps-within",
    )
    facts = pairing.facts(links, within, classes, "vec_id")
    return (
        base.select("vec_id", "node")
        .join(facts, "node", "left")
        .select(
            "vec_id",
            (F.coalesce("n", F.lit(0)) + F.coalesce(F.col("copies"), F.lit(1)) - 1).alias("n_links"),
            F.coalesce("group_id", "first_id", "vec_id").alias("component_id"),
            F.coalesce("copies", F.lit(1)).cast("bigint").alias("n_copies"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))
    )
