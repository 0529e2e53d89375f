"""Mixing sources to target weights by hierarchical budgeting.

The leaves of a tree domain -> language -> source hold documents. A token budget flows down the
tree: every node splits its budget among its children by weight, no child gets more than its
tokens times ``max_epochs``, and what a child cannot take goes to its siblings. Since a node is
never given more than its whole subtree holds, a shortage leaves a node only when all of its
children are full: siblings come before ancestors.

A leaf's budget is spent in seeded epochs. Each epoch has its own seeded order of the leaf's
documents; whole epochs come first, the last one gives the longest prefix within the budget. A
prefix of a hash order is a threshold on the hash, so documents are chosen by comparison with
one cut per leaf. The cut is found from token sums per range of hashes, then inside one range,
so no task orders a whole leaf.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from itertools import chain
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.llm.base import stored

LEVELS = ("_domain", "_lang", "_source")
EPOCH = "mix_epoch"


@dataclass(frozen=True)
class Settings:
    """``weights`` gives children at a level ("domain", "lang", "source") their share of the
    parent by name; the other children split the rest by tokens to the power ``smoothing``.
    ``budget_share`` is the budget as a share of all tokens. Leaves are broadcast only up to
    ``broadcast_leaves`` of them, about 10 MB."""

    budget_share: float = 1.0
    max_epochs: int = 2
    smoothing: float = 0.7
    weights: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    domains: int = 4
    seed: int = 3
    range_rows: int = 20_000
    broadcast_leaves: int = 50_000


def with_leaf(docs: DataFrame, s: Settings) -> DataFrame:
    """Add the leaf's names; a null name is the empty one. ``documents`` names no domain, so
    sources are dealt to ``domains`` of them by their name's checksum."""
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    return docs.withColumns(
        {
            "_domain": F.concat(F.lit("domain"), F.crc32(source.cast("binary")) % s.domains),
            "_lang": F.coalesce(F.col("lang").cast("string"), F.lit("")),
            "_source": source,
        }
    )


def tokens(text: Column) -> Column:
    """Tokens are runs of characters other than blanks; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("bigint")


def _split(nodes: DataFrame, parents: DataFrame | float, level: int, s: Settings) -> DataFrame:
    """Give the nodes of a level (name columns, tokens) their budget out of their parents'.

    At the first level the parent is the root, whose budget is a number.
    """
    up, name = list(LEVELS[:level]), LEVELS[level]
    named = s.weights.get(name.removeprefix("_"), {})
    share = F.create_map(*map(F.lit, chain(*named.items())))[F.col(name)].cast("double") if named else F.lit(None).cast("double")
    family = Window.partitionBy("_parent")
    order = family.orderBy(F.try_divide("cap", "weight").asc_nulls_last(), name)
    before, onwards = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    if up:
        joined = nodes.join(parents.select(*up, F.col("budget").alias("given")), up)
    else:
        joined = nodes.withColumn("given", F.lit(float(parents)))
    return (
        joined.withColumns(
            {
                "_parent": F.struct(*up) if up else F.lit(0),
                "share": share,
                "smooth": F.when(share.isNull(), F.pow("tokens", F.lit(s.smoothing))),
                "cap": F.col("tokens") * float(s.max_epochs),
            }
        )
        .withColumns(
            {
                "open": F.greatest(F.lit(0.0), 1 - F.coalesce(F.sum("share").over(family), F.lit(0.0))),
                "smooth_all": F.sum("smooth").over(family),
            }
        )
        .withColumn("weight", F.coalesce("share", F.col("open") * F.try_divide("smooth", "smooth_all"), F.lit(0.0)))
        # children in the order in which they fill up: the level at which the next one would stand
        .withColumns(
            {
                "level": F.try_divide(
                    F.col("given") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)), F.sum("weight").over(onwards)
                )
            }
        )
        .withColumn("level", F.max(F.when(F.try_divide("cap", "weight") > F.col("level"), F.col("level"))).over(family))
        .withColumn("budget", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.when(F.col("weight") > 0, F.col("cap")), F.lit(0.0))))
        .select(*up, name, "tokens", "rows", "budget")
    )


def budgets(leaves: DataFrame, s: Settings) -> DataFrame:
    """Budget in tokens of every leaf (name columns, tokens, rows)."""
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    parents: DataFrame | float = total * min(s.budget_share, float(s.max_epochs))
    for level in range(len(LEVELS)):
        nodes = leaves.groupBy(*LEVELS[: level + 1]).agg(F.sum("tokens").alias("tokens"), F.sum("rows").alias("rows"))
        parents = _split(nodes, parents, level, s)
    return parents


def cuts(base: DataFrame, s: Settings) -> tuple[DataFrame, int, int]:
    """Per leaf its whole epochs and the cut of the last one; number of leaves; bits of a range."""
    leaves = stored(base.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows")), "mixing-leaves")
    size = leaves.agg(F.count("*"), F.coalesce(F.sum("rows"), F.lit(0))).first()
    bits = max(1, ceil(log2(max(2, size[1] / s.range_rows))))
    plan = stored(
        budgets(leaves, s)
        # a leaf without tokens costs nothing and is taken once
        .withColumn("whole", F.when(F.col("tokens") == 0, 1).otherwise(F.floor(F.col("budget") / F.col("tokens") + 1e-9)).cast("int"))
        .withColumn("rest", F.when(F.col("tokens") > 0, F.floor(F.col("budget") + 1e-6) - F.col("whole") * F.col("tokens")).otherwise(0).cast("bigint"))
        .select(*LEVELS, "tokens", "budget", "whole", "rest"),
        "mixing-plan",
    )
    near = F.broadcast(plan) if size[0] <= s.broadcast_leaves else plan
    ranked = _ranked(base.select("doc_id", *LEVELS, F.col("tokens").alias("_tokens")).join(near.where("rest > 0"), [*LEVELS]), bits, s)
    by_range = ranked.groupBy(*LEVELS, "_range", "rest").agg(F.sum("_tokens").alias("held"))
    running = Window.partitionBy(*LEVELS).orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    last = (
        by_range.withColumn("through", F.sum("held").over(running))
        .where("through > rest AND through - held <= rest")
        .select(*LEVELS, F.col("_range").alias("last_range"), (F.col("rest") - F.col("through") + F.col("held")).alias("left"))
    )
    # one row per leaf: sent to the rows of a hot leaf instead of gathering them
    ranges = last.withColumnRenamed("last_range", "_range")
    inside = (
        ranked.join(F.broadcast(ranges) if size[0] <= s.broadcast_leaves else ranges.repartition(*LEVELS, "_range"), [*LEVELS, "_range"])
        .groupBy(*LEVELS, "_hash", "left")
        .agg(F.sum("_tokens").alias("held"))
    )
    running = Window.partitionBy(*LEVELS).orderBy("_hash").rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        inside.withColumn("through", F.sum("held").over(running))
        .where(F.col("through") <= F.col("left"))
        .groupBy(*LEVELS)
        .agg(F.max("_hash").alias("cut"))
    )
    return stored(plan.join(last.drop("left"), [*LEVELS], "left").join(cut, [*LEVELS], "left"), "mixing-cuts"), size[0], bits


def _ranked(rows: DataFrame, bits: int, s: Settings) -> DataFrame:
    return rows.withColumn("_hash", F.xxhash64(F.lit(s.seed), "whole", "doc_id")).withColumn("_range", F.shiftright("_hash", 64 - bits))


def mix(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang, source, ...) once per epoch that takes them.

    All columns stay and ``mix_epoch`` (from 0) is added; a column of that name is replaced. Null names are the empty name, a null text has no
    tokens. Rows of equal doc_id stand at one place of the order and are taken or left together.
    An empty table gives an empty result.
    """
    s = settings
    kept = [c for c in docs.columns if c != EPOCH]
    used = {*LEVELS, "_hash", "_range", "whole", "rest", "last_range", "cut"}
    clashing = {c: f"_kept_{i}" for i, c in enumerate(kept) if c.lower() in used or c.startswith("_kept_")}
    inner = docs.drop(EPOCH).withColumnsRenamed(clashing)
    base = stored(with_leaf(inner, s).select("doc_id", *LEVELS, tokens(F.col("text")).alias("tokens")), "mixing-base")
    chosen, leaves, bits = cuts(base, s)
    chosen = chosen.select(*LEVELS, "whole", "rest", "last_range", "cut")
    if leaves <= s.broadcast_leaves:
        chosen = F.broadcast(chosen)
    rows = _ranked(with_leaf(inner, s).join(chosen, [*LEVELS]), bits, s)
    part = (F.col("rest") > 0) & (
        F.col("last_range").isNull() | (F.col("_range") < F.col("last_range")) | ((F.col("_range") == F.col("last_range")) & (F.col("_hash") <= F.col("cut")))
    )
    epochs = F.col("whole") + F.coalesce(part, F.lit(False)).cast("int")
    return rows.withColumn(
        EPOCH, F.explode(F.when(epochs > 0, F.sequence(F.lit(0), epochs - 1)).otherwise(F.array().cast("array<int>")))
    ).select(*[F.col(clashing.get(c, c)).alias(c) for c in kept], EPOCH)
