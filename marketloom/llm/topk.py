"""Exact top-k search by inner product with an impact-ordered index.

Vectors become integers. The candidates are cut into blocks, and a task builds the index of a
block: per dimension the candidates ordered by their component, cut into segments of equal
quantised component. A segment's impact on a query is the query's component times how far the segment lies above
the dimension's lowest component (below the highest, for a negative query component), so
impacts are never negative and a candidate's score is the sum of its impacts plus a constant.

Segments are processed score at a time, in falling order of impact, a round down to each of a few
levels. After a round a candidate's score lies between what it has collected and that plus, for
every dimension still to come, the least of the round's level and the dimension's highest impact.
Processing stops as soon as the k-th best lower bound proves that few candidates can still be among the
best; these are scored exactly. After the last round only the quantisation is left between the bounds.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.llm.base import parts_for, stored

LARGEST = 1 << 20  # of a component in the index, so that sums of impacts stay within 64 bits; others are scored one by one


@dataclass(frozen=True)
class Settings:
    """``levels``: rounds end at these shares of the highest impact; ``few``: share of a block
    that is scored exactly instead of processing on; ``grades`` of a quantised component."""

    k: int = 5
    scale: int = 256
    block: int = 8192
    queries: int = 4096
    grades: int = 256
    levels: tuple[float, ...] = (0.2, 0.0)
    few: float = 0.1


class Index:
    """Impact-ordered segments of a block of integer vectors."""

    def __init__(self, vectors: np.ndarray, grades: int):
        self.vectors = vectors
        self.low, self.high = vectors.min(axis=0), vectors.max(axis=0)
        self.step = np.maximum(1, -(-(self.high - self.low + 1) // grades))
        # ordered from the highest component for positive, from the lowest for negative queries
        self.sides = []
        for distance in (vectors - self.low, self.high - vectors):
            grade = (distance // self.step).T
            order = np.argsort(-grade, axis=1, kind="stable")
            self.sides.append((order, -np.take_along_axis(grade, order, axis=1).astype(np.float32)))

    def best(self, query: np.ndarray, k: int, levels: tuple[float, ...], few: float, own: np.ndarray) -> np.ndarray:
        """Rows of this block that may be among the ``k`` best for the query, but for the rows ``own``."""
        n = len(self.vectors)
        weight = np.abs(query) * self.step  # impact of one grade
        dims = np.flatnonzero(weight)
        grades = (self.high - self.low) // self.step
        top = weight * grades
        # a component lies up to step - 1 above its grade
        slack = int((np.abs(query) * np.minimum(self.step - 1, self.high - self.low)).sum())
        # impacts are whole numbers; single precision is exact while their sums stay below 2**24
        exact = np.float32 if int(top.sum()) < 1 << 24 else np.float64
        collected, seen = np.zeros(n, exact), np.zeros(n, np.int16)
        done = dict.fromkeys(dims.tolist(), 0)
        for share in levels:
            level = int(share * top.max()) if len(dims) else 0
            for d, begin in done.items():
                order, fall = (side[d] for side in self.sides[0 if query[d] > 0 else 1])
                # grades fall along the list, so the segments down to the level are its next stretch
                end = n if level <= 0 else int(np.searchsorted(fall, -(level / weight[d]), side="right"))
                if end > begin:
                    stretch = order[begin:end]
                    collected[stretch] -= fall[begin:end] * exact(weight[d])
                    if level > 0:
                        seen[stretch] += 1
                    done[d] = end
            lower = collected.astype(np.float64)
            lower[own] = -1
            # every dimension that may still come adds at most the level, or its own highest impact
            open_ = 0
            if level > 0:
                large = top[dims] >= level
                open_ = level * (int(large.sum()) - seen.astype(np.int64)) + int(top[dims][~large].sum())
            upper = lower + slack + open_
            possible = np.ones(n, bool)
            if n - len(own) > k:
                possible = upper >= np.partition(lower, n - k)[n - k]
            possible[own] = False
            if possible.sum() <= max(4 * k, few * n):
                break
        return np.flatnonzero(possible)


def _wide_scores(out: dict[str, list], vectors: np.ndarray, ids: np.ndarray, asks: np.ndarray, wide: np.ndarray, k: int) -> None:
    """Best candidates of the pairs with a component beyond ``LARGEST``, whose sums could leave the index's numbers.

    Scores are whole numbers of any size here; only one that is among the best of its block must fit in 64 bits.
    """
    for number in np.flatnonzero(asks if wide[~asks].any() else asks & wide):
        rows = np.flatnonzero(~asks & (ids != ids[number]) & (wide | wide[number]))
        scores = (vectors[rows].astype(object) @ vectors[number].astype(object)).tolist() if len(rows) else []
        for score, vec_id in sorted(zip(scores, ids[rows].tolist()), key=lambda x: (-x[0], x[1]))[:k]:
            if not -(1 << 63) <= score < 1 << 63:
                raise OverflowError(f"the score of {ids[number]} and {vec_id} does not fit in 64 bits")
            out["query_id"].append(int(ids[number]))
            out["vec_id"].append(vec_id)
            out["score"].append(score)


def _searched(s: Settings):
    """The best candidates of a block for each query of a group."""

    def run(group: pa.Table) -> pa.Table:
        ids = group.column("vec_id").to_numpy()
        asks = group.column("ask").to_numpy(zero_copy_only=False).astype(bool)
        lists = group.column("ints")
        widths = np.diff(np.concatenate([c.offsets.to_numpy() for c in [lists.combine_chunks()]]))
        vectors = np.zeros((len(ids), int(widths.max(initial=1))), np.int64)
        vectors[np.arange(vectors.shape[1]) < widths[:, None]] = lists.combine_chunks().flatten().to_numpy()
        out = {"query_id": [], "vec_id": [], "score": []}
        wide = ((vectors > LARGEST) | (vectors < -LARGEST)).any(axis=1)
        _wide_scores(out, vectors, ids, asks, wide, s.k)
        block, block_ids = vectors[~asks & ~wide], ids[~asks & ~wide]
        asks = asks & ~wide
        if len(block):
            index = Index(block, s.grades)
            order = np.argsort(block_ids, kind="stable")
            for query, query_id in zip(vectors[asks], ids[asks]):
                span = np.searchsorted(block_ids[order], (query_id, query_id), side="left")[0], np.searchsorted(block_ids[order], query_id, side="right")
                rows = index.best(query, s.k, s.levels, s.few, order[span[0] : span[1]])
                scores = block[rows] @ query
                first = np.lexsort((block_ids[rows], -scores))[: s.k]
                out["query_id"] += [int(query_id)] * len(first)
                out["vec_id"] += block_ids[rows][first].tolist()
                out["score"] += scores[first].tolist()
        return pa.table({name: pa.array(values, pa.int64()) for name, values in out.items()})

    return run


def integers(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id and ``ints``, floor(scale * x) per component, of the vectors that take part.

    Vectors that are null or hold null or non-finite components, and rows without an id, take no part. A
    component beyond 64 bits after scaling is an error: its product with any other does not fit either.
    """
    x = F.col("embedding")
    usable = F.col("vec_id").isNotNull() & x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))

    def whole(v):
        scaled = F.floor(v.cast("double") * scale)
        return F.when(F.abs(v.cast("double") * scale) < float(1 << 63), scaled).otherwise(F.raise_error(F.lit("component beyond 64 bits")).cast("bigint"))

    return vectors.where(usable).select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform("embedding", whole).alias("ints"))


def search(vectors: DataFrame, asking, settings: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best other rows for each row where ``asking`` holds.

    ``asking`` is a condition on vec_id. A query meets every block of candidates, queries in groups; the
    results of the blocks are ranked by score, ties to the smaller vec_id. Rows of the query's own
    vec_id are no candidates; equal rows ask once and are candidates each. Shorter vectors count as filled up with zeros. An
    empty table gives an empty result.
    """
    s = settings
    rows = stored(integers(vectors, s.scale), "topk-integers")
    queries = rows.where(asking).distinct()
    size = rows.agg(F.count("*"), F.count(F.when(asking, 1))).first()
    parts, groups = parts_for(size[0], s.block), parts_for(size[1], s.queries)
    candidates = rows.withColumns(
        {
            "ask": F.lit(False),
            "part": F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int"),
            "batch": F.explode(F.sequence(F.lit(0), F.lit(groups - 1))),
        }
    )
    asked = queries.withColumns(
        {
            "ask": F.lit(True),
            "part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1))),
            "batch": F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups)).cast("int"),
        }
    )
    found = (
        candidates.unionByName(asked)
        .groupBy("part", "batch")
        .applyInArrow(_searched(s), "query_id bigint, vec_id bigint, score bigint")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= s.k).select("query_id", "rank", "vec_id", "score")
