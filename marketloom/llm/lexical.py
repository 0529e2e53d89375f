"""Ranked lexical search with a length-stratified index.

A document's score depends on its length only through an integer normaliser m. Documents of equal m
form a stratum; inside it a term's postings stand by their term frequency tf, in runs of equal tf. All
postings of a run have one impact, computed once. So the highest tf of a term in a stratum gives the
most the term can add there, and the sum over a query's terms bounds every score of the stratum.

Strata lie on shelves of about equal size: small ones share a shelf, a large one is cut over several. The index
is stored once, a row per shelf and stratum. A query first visits the few shelves of the highest bounds,
which gives it a least score; then only shelves whose bound reaches that are visited. On a shelf its
strata are taken in falling order of their bounds, until no bound reaches the k-th best score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.llm.base import parts_for, stored, text_runs

PART = 4_000_000  # bytes of a text handled at once
NO_ID = -(1 << 63)  # stands for a null document id inside the index

# bytes of terms stay, capital letters become small ones, all others separate terms
_TERMS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


@dataclass(frozen=True)
class Settings:
    """``shelf``: documents of a shelf; ``first``: shelves that give a query its least score;
    ``batch``: queries that meet a shelf in one task; ``known``: up to so many distinct query terms are sent to
    the tasks that count terms, which then index these only; with more of them all terms are indexed."""

    k: int = 50
    shelf: int = 20_000
    first: int = 2
    batch: int = 4_096
    known: int = 500_000


def terms_of(text: str | None) -> Counter[bytes]:
    """Occurrences of the terms of a whole text; null has none."""
    found: Counter[bytes] = Counter()
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_TERMS)
    begin = 0
    while begin < len(raw):
        end = raw.find(b" ", begin + PART) if len(raw) - begin > PART else -1
        end = len(raw) if end < 0 else end
        found.update(raw[begin:end].split())
        begin = end
    return found


def term_key(term: bytes) -> int:
    """A term's 64-bit key, signed."""
    return xxhash.xxh3_64_intdigest(term) - (1 << 63)


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    """What a term of weight 1 adds at frequency tf, rounded down."""
    return 1_000_000_000 * tf // (1_000 * tf + 20 * m)


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, texts in text_runs(batch.column(1)):
            found = [list(terms_of(text)) for text in texts]
            rows = pa.array(np.repeat(np.arange(len(texts)) + begin, [len(f) for f in found]), pa.int64())
            listed = [t for f in found for t in f]
            columns = [batch.column(0).take(rows), pa.array(listed, pa.binary()), pa.array(map(term_key, listed), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["item_id", "term", "key"])


def _counted(known):
    """doc_id, number of terms, and the keys and frequencies of the ``known`` ones (null: of all)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if known is None else known.value
        for batch in batches:
            for begin, texts in text_runs(batch.column(1)):
                sizes, keys, counts = [], [], []
                for text in texts:
                    found = terms_of(text)
                    sizes.append(sum(found.values()))
                    listed = list(found if wanted is None else wanted.keys() & found.keys())
                    keys.append([term_key(t) if wanted is None else wanted[t] for t in listed])
                    counts.append([found[t] for t in listed])
                columns = [
                    batch.column(0).slice(begin, len(texts)),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(counts, pa.list_(pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "keys", "tfs"])

    return run


INDEX = "shelf bigint, m bigint, docs array<bigint>, places array<int>, run_key array<bigint>, run_tf array<int>, run_end array<int>, key array<bigint>, best array<bigint>"


def stratum(docs: np.ndarray, keys: np.ndarray, tfs: np.ndarray, places: np.ndarray, m: int) -> dict[str, np.ndarray]:
    """Postings (key, tf, place of the document) of a stratum as runs of equal key and tf, tf falling."""
    order = np.lexsort((places, -tfs, keys))
    keys, tfs, places = keys[order], tfs[order], places[order]
    new = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (tfs[1:] != tfs[:-1])))) if len(keys) else np.zeros(0, np.int64)
    run_key, run_tf = keys[new], tfs[new]
    top = np.flatnonzero(np.concatenate(([True], run_key[1:] != run_key[:-1]))) if len(new) else new
    return {
        "docs": docs,
        "places": places.astype(np.int32),
        "run_key": run_key,
        "run_tf": run_tf.astype(np.int32),
        "run_end": np.append(new[1:], len(keys)).astype(np.int32)[: len(new)],
        "key": run_key[top],
        "best": impact(run_tf[top].astype(np.int64), m),
    }


def _indexed(group: pa.Table) -> pa.Table:
    """The strata of a shelf, a row each."""
    group = group.combine_chunks()
    ms, ids = group.column("m").to_numpy(), group.column("doc_id").to_numpy()
    lists = {name: group.column(name).combine_chunks() for name in ("keys", "tfs")}
    lengths = np.diff(lists["keys"].offsets.to_numpy())
    keys, tfs = (x.flatten().to_numpy().astype(np.int64) for x in lists.values())
    owner = np.repeat(np.arange(len(ids)), lengths)
    order = np.lexsort((ids, ms))
    place = np.empty(len(ids), np.int64)
    out: dict[str, list] = {f.split()[0]: [] for f in INDEX.split(", ")}
    bounds = np.flatnonzero(np.concatenate(([True], np.diff(ms[order]) != 0, [True])))
    stratum_of = np.empty(len(ids), np.int64)
    for at, (begin, end) in enumerate(zip(bounds[:-1], bounds[1:])):
        place[order[begin:end]] = np.arange(end - begin)
        stratum_of[order[begin:end]] = at
    by_stratum = np.argsort(stratum_of[owner], kind="stable")
    cuts = np.searchsorted(stratum_of[owner][by_stratum], np.arange(len(bounds)))
    for at, (begin, end) in enumerate(zip(bounds[:-1], bounds[1:])):
        postings, m = by_stratum[cuts[at] : cuts[at + 1]], int(ms[order[begin]])
        found = stratum(ids[order[begin:end]], keys[postings], tfs[postings], place[owner[postings]], m)
        out["shelf"].append(group.column("shelf")[0].as_py())
        out["m"].append(m)
        for name, values in found.items():
            out[name].append(values)
    kinds = {"shelf": pa.int64(), "m": pa.int64()} | {k: pa.list_(pa.int32() if k in ("places", "run_tf", "run_end") else pa.int64()) for k in out if k not in ("shelf", "m")}
    return pa.table({name: pa.array(values, kinds[name]) for name, values in out.items()})


class Shelf:
    """The strata of a shelf in memory, and for every term its strata with the most it can add there."""

    def __init__(self, rows: pa.Table):
        self.strata, keys, best, owner = [], [], [], []
        for at, row in enumerate(_arrays(rows)):
            starts = np.concatenate(([0], row["run_end"][:-1])) if len(row["run_end"]) else row["run_end"]
            # impacts once per run, then for each of its postings
            impacts = np.repeat(impact(row["run_tf"].astype(np.int64), row["m"]), row["run_end"] - starts)
            self.strata.append((row["docs"], row["places"], row["run_key"], starts, row["run_end"], impacts))
            keys.append(row["key"])
            best.append(row["best"])
            owner.append(np.full(len(row["key"]), at))
        order = np.argsort(np.concatenate(keys), kind="stable")
        self.key, self.best, self.owner = (np.concatenate(x)[order] for x in (keys, best, owner))

    def search(self, keys: np.ndarray, weights: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and scores of the k best documents with at least the score ``least``, and the strata visited."""
        bounds = np.zeros(len(self.strata), np.int64)
        for w, lo, hi in zip(weights, np.searchsorted(self.key, keys, "left"), np.searchsorted(self.key, keys, "right")):
            bounds[self.owner[lo:hi]] += w * self.best[lo:hi]
        ids, scores, visited = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for at in np.argsort(-bounds, kind="stable"):
            if bounds[at] < max(1, least):
                break
            visited += 1
            docs, places, run_key, starts, ends, impacts = self.strata[at]
            total = np.zeros(len(docs), np.int64)
            for w, lo, hi in zip(weights, np.searchsorted(run_key, keys, "left"), np.searchsorted(run_key, keys, "right")):
                if hi > lo:
                    span = slice(starts[lo], ends[hi - 1])
                    total[places[span]] += w * impacts[span]
            hit = np.flatnonzero(total >= max(1, least))
            if len(hit):
                ids, scores = np.concatenate((ids, docs[hit])), np.concatenate((scores, total[hit]))
                if len(ids) > k:
                    best = np.lexsort((ids, -scores))[:k]
                    ids, scores = ids[best], scores[best]
                if len(ids) == k:
                    least = max(least, int(scores.min()))
        return ids, scores, visited


def _arrays(rows: pa.Table) -> Iterator[dict]:
    columns = {name: rows.column(name).combine_chunks() for name in rows.column_names if name not in ("batch",)}
    for at in range(rows.num_rows):
        yield {name: c[at].as_py() if name in ("shelf", "m") else c[at].values.to_numpy() for name, c in columns.items()}


def _searched(s: Settings):
    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list] = {"item": [], "doc_id": [], "score": []}
        if index.num_rows and queries.num_rows:
            shelf = Shelf(index)
            keys, weights = (queries.column(c).combine_chunks() for c in ("keys", "weights"))
            for at, (item, least) in enumerate(zip(queries.column("item").to_pylist(), queries.column("least").to_pylist())):
                ids, scores, _ = shelf.search(keys[at].values.to_numpy(), weights[at].values.to_numpy(), least, s.k)
                out["item"] += [item] * len(ids)
                out["doc_id"] += ids.tolist()
                out["score"] += scores.tolist()
        return pa.table({name: pa.array(values, pa.int64()) for name, values in out.items()})

    return run


def build(docs: DataFrame, known, settings: Settings) -> tuple[DataFrame, DataFrame, int]:
    """The stored index of ``docs`` (doc_id, text), the number of documents per key, and N.

    ``known`` is a broadcast map of terms to keys outside of which nothing is indexed, or null.
    """
    s = settings
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc_id"), "text")
    counted = stored(
        rows.mapInArrow(_counted(known), "doc_id bigint, n bigint, keys array<bigint>, tfs array<int>")
        .where("n > 0")
        .withColumn("row", F.monotonically_increasing_id()),
        "lexical-counted",
    )
    number, total = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = stored(counted.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("df")), "lexical-frequency")
    measured = counted.withColumn("m", F.expr(f"50 + (50 * n * {number}L) div {max(1, total)}L"))
    held = stored(measured.groupBy("m").agg(F.count("*").alias("held")), "lexical-strata")
    shelves = parts_for(number, s.shelf)
    cut = F.ceil(F.col("held") / s.shelf).cast("int")
    shelf = F.when(F.col("held") > s.shelf, F.xxhash64("m", F.pmod(F.xxhash64("row"), cut))).otherwise(F.pmod(F.xxhash64("m"), F.lit(shelves)))
    index = stored(
        measured.join(held, "m")
        .select("doc_id", "m", "keys", "tfs", shelf.alias("shelf"))
        .groupBy("shelf")
        .applyInArrow(_indexed, INDEX),
        "lexical-index",
    )
    return index, frequency, number


def search(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best rows of ``docs`` (doc_id, text) for each of ``items`` (item_id, text).

    Rows of one item_id are one item, whose terms are those of all of them; an item without terms, or
    whose terms no document holds, has no result. Repeated documents are documents each; ties go to the smaller
    doc_id, a null one first. A null text has no terms. An empty table on either side gives an empty result.
    """
    s = settings
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    terms = stored(
        items.select("item_id", "text").mapInArrow(_asked, f"item_id {kind}, term binary, key bigint").distinct(), "lexical-asked"
    )
    names = stored(terms.select("item_id").distinct().withColumn("item", F.monotonically_increasing_id()), "lexical-items")
    vocabulary = terms.select("term", "key").distinct()
    known = None
    if vocabulary.count() <= s.known:
        known = spark.sparkContext.broadcast({bytes(r["term"]): r["key"] for r in vocabulary.toLocalIterator()})
    index, frequency, number = build(docs, known, s)

    weight = F.floor(1000 * F.log((F.lit(2 * number + 2).cast("double")) / (2 * F.col("df") + 1).cast("double"))).cast("bigint")
    asked = stored(
        terms.join(names, terms["item_id"].eqNullSafe(names["item_id"]))
        .select("item", "key")
        .join(frequency.withColumn("w", weight).where("w > 0"), "key")
        .select("item", "key", "w"),
        "lexical-weights",
    )
    queries = stored(
        asked.groupBy("item").agg(F.collect_list(F.struct("key", "w")).alias("terms")).select("item", F.col("terms.key").alias("keys"), F.col("terms.w").alias("weights")),
        "lexical-queries",
    )
    batches = parts_for(queries.count(), s.batch)
    most = index.select("shelf", F.explode(F.arrays_zip("key", "best")).alias("x")).groupBy(F.col("x.key").alias("key"), "shelf").agg(F.max("x.best").alias("best"))
    bounds = stored(asked.join(most, "key").groupBy("item", "shelf").agg(F.sum(F.col("w") * F.col("best")).alias("bound")), "lexical-bounds")
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "shelf")
    bounds = stored(bounds.withColumn("turn", F.row_number().over(order)), "lexical-turns")

    def visited(pairs: DataFrame, label: str) -> DataFrame:
        """Results of the pairs (item, shelf, least)."""
        asking = pairs.join(queries, "item").withColumn("batch", F.pmod(F.xxhash64("item"), F.lit(batches)).cast("int"))
        needed = index.join(pairs.select("shelf").distinct(), "shelf", "left_semi")
        shelved = needed.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))
        found = shelved.groupBy("shelf", "batch").cogroup(asking.groupBy("shelf", "batch"))
        return stored(found.applyInArrow(_searched(s), "item bigint, doc_id bigint, score bigint"), label)

    best = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    early = visited(bounds.where(F.col("turn") <= s.first).select("item", "shelf", F.lit(0).cast("bigint").alias("least")), "lexical-early")
    least = early.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == s.k).select("item", F.col("score").alias("least"))
    others = bounds.where(F.col("turn") > s.first).join(least, "item", "left").withColumn("least", F.coalesce("least", F.lit(0).cast("bigint")))
    late = visited(others.where("bound >= least").select("item", "shelf", "least"), "lexical-late")
    return (
        early.union(late)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= s.k)
        .join(names, "item")
        .select("item_id", "rank", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score")
    )
