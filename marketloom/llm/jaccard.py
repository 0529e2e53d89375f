"""Join of texts by the Jaccard similarity of their word n-grams, with Bayesian pruning.

1. Texts of equal words form a class; from here on only classes count, with their number of copies.
2. Each class has a signature of MinHash values. Classes that agree on a band of values meet in
   a bucket. Pairs come from buckets of few classes directly.
3. The classes of large buckets form clusters (connected over large buckets). A cluster is cut
   into blocks, and every two blocks are compared in one task, in memory: what leaves the task
   is a number of links per class and a spanning forest, never all pairs of the cluster.
4. Candidates are compared by MinHash values in steps. After n values with m matches and a
   uniform prior, the similarity reaches the threshold t with probability
   P(Binomial(n + 1, t) <= m); a pair below the tolerance is dropped.
5. The rest is verified on the exact n-gram sets.
6. Connected components of the links give the groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm import grams, pairing
from marketloom.llm.base import give_back, slices, stored, text_runs

SLICE_CHARS = 500_000


@dataclass(frozen=True)
class Settings:
    """``bands`` x ``rows`` MinHash values; at similarity t a pair meets in no band with
    probability (1 - t ** rows) ** bands, 0.00007 at 0.8. ``small``: classes of a bucket whose
    pairs are listed; ``block``: classes of one side of a comparison in memory."""

    words: int = 5
    threshold: float = 0.8
    bands: int = 24
    rows: int = 5
    step: int = 24
    tolerance: float = 1e-5
    small: int = 16
    block: int = 256
    seed: int = 5

    @property
    def values(self) -> int:
        return self.bands * self.rows


@cache
def least_matches(s: Settings) -> list[int]:
    """For each number of compared values the least number of matches that goes on."""
    out = []
    for n in range(s.values + 1):
        below, m = 0.0, 0
        while m <= n:
            below += comb(n + 1, m) * s.threshold**m * (1 - s.threshold) ** (n + 1 - m)
            if below >= s.tolerance:
                break
            m += 1
        out.append(m)
    return out


def shingle_sets(texts: Iterable[str | None], n: int, words: int) -> tuple[list[bytes | None], list[np.ndarray]]:
    """Per text a fingerprint of its words and the sorted set of its n-gram hashes.

    A text of fewer words has one n-gram, all its words; one without words has no fingerprint.
    """
    seen: list[list[np.ndarray]] = [[] for _ in range(n)]
    found: list[list[np.ndarray]] = [[] for _ in range(n)]
    for part in slices(texts, SLICE_CHARS):
        hashes, owner, counts = grams.Joined.of(part.texts, grams.blanks(), part.own).words()
        size = max(0, len(hashes) - words + 1)
        joint = np.zeros(size, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(words):
                joint = joint * np.uint64(0xD1B54A32D192ED03) + hashes[k : k + size]
        whole = (owner[words - 1 :][:size] == owner[:size]) & counts[:size]
        joint, joint_owner = grams.mixed(joint[whole]), owner[:size][whole]
        hashes, owner = hashes[counts], owner[counts]
        cuts, joint_cuts = (np.searchsorted(o, np.arange(len(part.owners) + 1)) for o in (owner, joint_owner))
        for i, row in enumerate(part.owners):
            seen[row].append(hashes[cuts[i] : cuts[i + 1]])
            found[row].append(joint[joint_cuts[i] : joint_cuts[i + 1]])
    prints, sets = [], []
    for row_words, row_grams in zip(seen, found):
        all_words = np.concatenate(row_words) if row_words else np.zeros(0, np.uint64)
        digest = hashlib.md5(all_words.tobytes(), usedforsecurity=False).digest() if len(all_words) else None
        grams_of = np.unique(np.concatenate(row_grams)) if row_grams else np.zeros(0, np.uint64)
        if digest and not len(grams_of):
            grams_of = np.frombuffer(digest[:8], np.uint64)
        prints.append(digest)
        sets.append(grams_of)
    return prints, sets


def signature(shingles: np.ndarray, s: Settings) -> bytes:
    """MinHash values of a set, each hashed down to 16 bits."""
    rng = np.random.default_rng(s.seed)
    odd = rng.integers(0, 1 << 63, s.values, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    salt = rng.integers(0, 1 << 63, s.values, dtype=np.uint64)
    least = np.full(s.values, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for begin in range(0, len(shingles), 2048):
            part = (shingles[begin : begin + 2048, None] ^ salt) * odd
            least = np.minimum(least, part.min(axis=0))
    return (grams.mixed(least) >> np.uint64(48)).astype("<u2").tobytes()


def _signatures(s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in text_runs(batch.column(1)):
                prints, sets = shingle_sets(texts, len(texts), s.words)
                known: dict[bytes, bytes] = {}
                for p, x in zip(prints, sets):
                    if p is not None and p not in known:
                        known[p] = signature(x, s)
                columns = [batch.column(0).slice(begin, len(texts)), pa.array(prints, pa.binary()), pa.array([known.get(p) for p in prints], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "sig"])
        give_back()

    return run


def _bodies(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_runs(batch.column(0)):
                prints, sets = shingle_sets(texts, len(texts), words)
                columns = [pa.array(prints, pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["node", "shingles"])
        give_back()

    return run


def _matrix(column: pa.Array, s: Settings) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, s.values)


def _likely(s: Settings):
    """Keep the pairs that no step of MinHash values rules out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = least_matches(s)
        for batch in batches:
            a, b = (_matrix(batch.column(name), s) for name in ("sig_a", "sig_b"))
            alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
            for begin in range(0, s.values, s.step):
                end = min(begin + s.step, s.values)
                matches[alive] += (a[alive, begin:end] == b[alive, begin:end]).sum(axis=1)
                alive = alive[matches[alive] >= least[end]]
            yield batch.select(["a", "b", "copies_a", "copies_b"]).take(pa.array(alive))

    return run


def _similar(common: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    return common >= threshold * (left + right - common) - 1e-9


def _verified(s: Settings):
    """Keep the pairs whose exact n-gram sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("shingles_a").to_pylist(), batch.column("shingles_b").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(bool(_similar(common, len(x), len(y), s.threshold)))
            yield batch.select(["a", "b", "copies_a", "copies_b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each left with each right set, from slices of a 0/1 matrix."""
    def flat(sets):
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])

    (x, x_owner), (y, y_owner) = flat(left), flat(right)
    shared = np.intersect1d(x, y)
    out = np.zeros((len(left), len(right)), np.float64)
    places = []
    for values, owner in ((x, x_owner), (y, y_owner)):
        at = np.searchsorted(shared, values)
        at[at == len(shared)] = 0
        hit = shared[at] == values if len(shared) else np.zeros(len(values), bool)
        order = np.argsort(at[hit], kind="stable")
        places.append((at[hit][order], owner[hit][order]))
    for begin in range(0, len(shared), 4096):
        sides = []
        for (at, owner), size in zip(places, (len(left), len(right))):
            lo, hi = np.searchsorted(at, (begin, begin + 4096))
            side = np.zeros((size, min(4096, len(shared) - begin)), np.float32)
            side[owner[lo:hi], at[lo:hi] - begin] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def _compared(s: Settings):
    """Links between the classes of two blocks of a cluster (or inside one)."""

    def run(group: pa.Table) -> pa.Table:
        least = least_matches(s)
        left, right, one = pairing.sides(group)
        sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
        sig = _matrix(group.column("sig"), s)
        x, y = sig[left], sig[right]
        if one:
            i, j = np.triu_indices(len(left), 1)
        else:
            i, j = (k.ravel() for k in np.meshgrid(np.arange(len(left)), np.arange(len(right)), indexing="ij"))
        matches = np.zeros(len(i), np.int64)
        for begin in range(0, s.values, s.step):
            end = min(begin + s.step, s.values)
            for k in range(begin, end):
                matches += x[i, k] == y[j, k]
            go_on = matches >= least[end]
            i, j, matches = i[go_on], j[go_on], matches[go_on]
        if len(i):
            sizes = np.array([len(v) for v in sets], np.float64)
            common = _common([sets[k] for k in left], [sets[k] for k in right])
            good = _similar(common[i, j], sizes[left[i]], sizes[right[j]], s.threshold)
            i, j = i[good], j[good]
        return pairing.summary(left[i], right[j], group.column("node").to_pylist(), group.column("copies").to_numpy())

    return run


def join_similar(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, class_id, n_links, n_copies and kept for every row of ``docs`` (doc_id, text).

    ``n_links`` counts the other rows whose word n-grams are similar enough, copies included;
    ``class_id`` is the smallest doc_id reachable by links; ``kept`` marks the row that has it.
    A null text and one without words links with nothing and is its own class. Repeated rows
    are copies of each other. A row with a null id can link; if its whole class has no id,
    class_id is null and kept is true. An empty table gives an empty result.
    """
    s = settings
    rows = docs.select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    base = stored(rows.mapInArrow(_signatures(s), f"doc_id {id_type}, node binary, sig binary"), "jaccard-rows")
    classes = stored(
        base.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.min("sig").alias("sig")),
        "jaccard-classes",
    )
    width = 2 * s.rows
    bands = F.array(*[F.xxhash64(F.lit(b), F.substring("sig", 1 + b * width, width)) for b in range(s.bands)])
    found = pairing.members(classes.select("node", F.explode(bands).alias("bucket")), "jaccard-members")
    clustered = pairing.clusters(found, s.small)
    pairs = pairing.few_pairs(found, clustered, s.small)
    for side in ("a", "b"):
        named = classes.select(F.col("node").alias(side), F.col("sig").alias(f"sig_{side}"), F.col("copies").alias(f"copies_{side}"))
        pairs = pairs.join(named, side)
    pair_type = "a binary, b binary, copies_a bigint, copies_b bigint"
    likely = stored(pairs.mapInArrow(_likely(s), pair_type), "jaccard-likely")

    # n-gram sets of the classes that are still compared
    needed = likely.select(F.col("a").alias("node")).union(likely.select("b")).union(clustered.select("node")).distinct()
    needed = stored(needed, "jaccard-needed")
    sources = classes.join(needed, "node", "left_semi").select("doc_id").distinct()
    texts = rows.join(sources, rows["doc_id"].eqNullSafe(sources["doc_id"]), "left_semi")
    bodies = stored(
        texts.select("text").mapInArrow(_bodies(s.words), "node binary, shingles binary")
        .join(needed, "node", "left_semi")
        .groupBy("node")
        .agg(F.min("shingles").alias("shingles")),
        "jaccard-bodies",
    )
    for side in ("a", "b"):
        likely = likely.join(bodies.select(F.col("node").alias(side), F.col("shingles").alias(f"shingles_{side}")), side)
    links = stored(likely.mapInArrow(_verified(s), pair_type), "jaccard-links")
    within = stored(
        pairing.blocks(clustered, s.block)
        .join(classes.select("node", "copies", "sig"), "node")
        .join(bodies, "node")
        .groupBy("cluster", "low", "high")
        .applyInArrow(_compared(s), pairing.WITHIN),
        "jaccard-within",
    )
    facts = pairing.facts(links, within, classes, "doc_id")
    return (
        base.select("doc_id", "node")
        .join(facts, "node", "left")
        .select(
            "doc_id",
            F.coalesce("group_id", "first_id", "doc_id").alias("class_id"),
            (F.coalesce("n", F.lit(0)) + F.coalesce(F.col("copies"), F.lit(1)) - 1).alias("n_links"),
            F.coalesce("copies", F.lit(1)).cast("bigint").alias("n_copies"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.col("class_id").isNull()))
    )
