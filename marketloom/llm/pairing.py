"""Candidate pairs from shared buckets, without all pairs of a large bucket.

Nodes that share a bucket are candidates. Buckets of few nodes give their pairs directly. The
nodes of large buckets form clusters (connected over large buckets); a cluster is cut into
blocks, and every two blocks meet in one task. A pair inside a cluster is left to its blocks, so
each pair is looked at once.

Where rows carry a sketch, a large bucket need not become one cluster: ``crowds`` lists its likely pairs and
clusters only the nodes that have many likely partners in it, such as a group of near copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.base import stored
from marketloom.llm.components import connected

WITHIN = "a binary, b binary, n bigint"


def members(rows: DataFrame, label: str) -> DataFrame:
    """The rows (node, bucket, ...) of buckets that at least two rows share, with their number ``n``."""
    meeting = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    return stored(rows.join(meeting, "bucket"), label)


def clusters(found: DataFrame, small: int) -> DataFrame:
    """``node`` and ``cluster`` of the nodes in buckets of more than ``small`` rows."""
    large = found.where(F.col("n") > small).select("bucket", "node")
    hubs = large.groupBy("bucket").agg(F.min("node").alias("b"))
    return connected(large.join(hubs, "bucket").select(F.col("node").alias("a"), "b")).select("node", F.col("root").alias("cluster"))


def _crowded(apart: int, many: int):
    """Likely pairs and crowd edges of the groups (bucket, low, high), which come one after another, ordered by node."""

    def look(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sketch, block = group.column("sketch").to_numpy().view(np.uint64), group.column("block").to_numpy()
        likely = np.bitwise_count(sketch[:, None] ^ sketch[None, :]) <= apart
        if group.column("low")[0] != group.column("high")[0]:
            likely &= block[:, None] != block[None, :]
        np.fill_diagonal(likely, False)
        crowded = likely.sum(axis=1) > many
        i, j = np.nonzero(np.triu(likely & ~(crowded[:, None] & crowded[None, :])))
        hubs, others, fresh = [], [], crowded.copy()
        for hub in np.flatnonzero(crowded):
            if not fresh[hub]:
                continue
            fresh[hub], reach = False, [hub]
            while reach:
                near = np.flatnonzero(likely[reach.pop()] & fresh)
                fresh[near] = False
                reach += near.tolist()
                hubs += [hub] * len(near)
                others += near.tolist()
        listed = np.arange(len(i) + len(hubs)) < len(i)
        return np.concatenate([i, np.array(hubs, np.int64)]), np.concatenate([j, np.array(others, np.int64)]), listed

    def told(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        found, waiting = [], 0
        for begin, end in zip(starts, [*starts[1:], table.num_rows]):
            a, b, listed = look(table.slice(begin, end - begin))
            found.append((a + begin, b + begin, listed))
            waiting += len(a)
            if waiting > 1 << 18 or end == table.num_rows:
                a, b, listed = (np.concatenate(c).astype(t) for c, t in zip(zip(*found), (np.int64, np.int64, bool)))
                node = table.column("node").combine_chunks()
                yield pa.RecordBatch.from_arrays([node.take(pa.array(a)), node.take(pa.array(b)), pa.array(listed)], ["a", "b", "listed"])
                found, waiting = [], 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]) if held is not None else table
            keys = [held.column(c).to_numpy() for c in ("bucket", "low", "high")]
            starts = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)]))
            if len(starts) > 1:  # the last group may go on in the next batch
                yield from told(held.slice(0, starts[-1]), starts[:-1])
                held = held.slice(starts[-1])
        if held is not None:
            yield from told(held, np.zeros(1, np.int64))

    return run


def crowds(found: DataFrame, small: int, size: int, apart: int, many: int) -> DataFrame:
    """What buckets of more than ``small`` rows come to: a, b and ``listed``, with repeats.

    A large bucket is cut into blocks of about ``size`` rows (node, sketch), and every two blocks meet. Nodes whose
    sketches differ in at most ``apart`` bits are likely partners. A pair of which one node has up to
    ``many`` likely partners there is listed, so a bucket lists at most ``many`` pairs a row and block. Nodes with more are a
    crowd; for these the other rows are the edges of a forest over their likely pairs, of which
    the clusters are made. So every likely pair is listed or lies inside one cluster.
    """
    parts = F.ceil(F.col("n") / size).cast("int")
    rows = (
        found.where(F.col("n") > small)
        .withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), parts).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "node", "sketch", "block")
    )
    key = ["bucket", "low", "high"]
    return (
        rows.repartition(*key)
        .sortWithinPartitions(*key, "node")
        .mapInArrow(_crowded(apart, many), "a binary, b binary, listed boolean")
        .where("a <> b")
    )


def outside(pairs: DataFrame, clustered: DataFrame) -> DataFrame:
    """The pairs (a, b) whose nodes do not lie in one cluster."""
    for side in ("a", "b"):
        named = clustered.select(F.col("node").alias(side), F.col("cluster").alias(f"cluster_{side}"))
        pairs = pairs.join(named, side, "left")
    return pairs.where("cluster_a IS NULL OR cluster_b IS NULL OR cluster_a <> cluster_b").select("a", "b")


def few_pairs(found: DataFrame, clustered: DataFrame, small: int, likely: Column | None = None) -> DataFrame:
    """Distinct pairs a < b of nodes that share a small bucket and no cluster. ``likely`` may
    rule pairs out by other columns of the rows, named x.* and y.*."""
    few = found.where(F.col("n") <= small).join(clustered, "node", "left")
    apart = "x.node < y.node AND (x.cluster IS NULL OR y.cluster IS NULL OR x.cluster <> y.cluster)"
    met = F.expr(f"x.bucket = y.bucket AND {apart}")
    return (
        few.alias("x")
        .join(few.alias("y"), met if likely is None else met & likely)
        .select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        .distinct()
    )


def blocks(clustered: DataFrame, size: int) -> DataFrame:
    """A row per node and pair of blocks (low, high) that it takes part in, with its own ``block``."""
    counted = clustered.groupBy("cluster").agg(F.ceil(F.count("*") / size).cast("int").alias("_blocks"))
    return (
        clustered.join(counted, "cluster")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .select("cluster", "node", "block", F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high"))
    )


def sides(group: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """Row numbers of the two blocks of a group, and whether they are one."""
    block = group.column("block").to_numpy()
    low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
    return np.flatnonzero(block == low), np.flatnonzero(block == high), low == high


def summary(i: np.ndarray, j: np.ndarray, nodes: list[bytes], copies: np.ndarray) -> pa.Table:
    """What the links i-j of a group come to: (node, null, linked rows) and the edges of a forest."""
    n = len(nodes)
    linked_rows = np.bincount(i, weights=copies[j], minlength=n) + np.bincount(j, weights=copies[i], minlength=n)
    root = list(range(n))

    def top(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    edges = []
    for x, y in zip(i.tolist(), j.tolist()):
        a, b = top(x), top(y)
        if a != b:
            root[b] = a
            edges.append((nodes[x], nodes[y]))
    linked = np.flatnonzero(linked_rows)
    return pa.table(
        {
            "a": pa.array([nodes[k] for k in linked] + [a for a, _ in edges], pa.binary()),
            "b": pa.array([None] * len(linked) + [b for _, b in edges], pa.binary()),
            "n": pa.array(linked_rows[linked].astype(np.int64).tolist() + [None] * len(edges), pa.int64()),
        }
    )


def facts(links: DataFrame, within: DataFrame, classes: DataFrame, id_column: str) -> DataFrame:
    """Per class (node, id, copies): linked rows ``n`` of other classes and the smallest id reachable.

    ``links`` are verified pairs (a, b, copies_a, copies_b), ``within`` the summaries of blocks.
    """
    counts = (
        links.select("a", F.col("copies_b").alias("n"))
        .union(links.select("b", "copies_a"))
        .union(within.where("n IS NOT NULL").select("a", "n"))
        .groupBy(F.col("a").alias("node"))
        .agg(F.sum("n").alias("n"))
    )
    groups = connected(links.select("a", "b").union(within.where("b IS NOT NULL").select("a", "b")))
    smallest = groups.join(classes.select("node", id_column), "node").groupBy("root").agg(F.min(id_column).alias("group_id"))
    grouped = stored(groups.join(smallest, "root").select("node", "group_id"), "pairing-groups")
    return (
        classes.select("node", F.col(id_column).alias("first_id"), "copies")
        .join(counts, "node", "left")
        .join(grouped, "node", "left")
    )
