"""Near-duplicate documents by BagMinHash: weighted Jaccard on word shingles.

A document is the multiset of its five-word shingles.  Every shingle carries a tree
of Poisson processes over discretised weights: the unit weight, then doublings
[1, 2), [2, 4), [4, 8), ... whose points fall on one unit step each.  A document
whose shingle has the count c sees the points on the steps below c, and component i
of its signature is the smallest point that falls on i.  Two signatures agree in a
component with exactly the probability of the weighted Jaccard likeness.  Points
beyond a limit that falls with the size of the document cannot be minima, so a
signature needs about as many points as it has components, whatever the size
(documents with a component left open are done again with twice the limit).

Signatures are cut into bands (32 of 7 components: a pair with likeness 0.8 meets in a
band with probability 0.9995, one with 0.5 in one of five).  Documents with equal multisets form
a class, and only its first document goes on.  Within a band bucket every class is compared
with one of them; links so found are joined to components; this is done again
with other centres while many pairs of classes meet in a bucket but lie in different
components.  The classes that are left in buckets of several components go through an exact
set-similarity join: their items are ordered from rare to frequent, and two of them are compared if they
share an item of their prefixes, lie in different components and pass the filters by size and place.  Edits
make rare items, so near copies of one text that are not alike enough share none.  Pairs inside a
component need no test, so a bucket of n alike texts costs a few n tests and no link
between components is lost.  All tests compare the whole multisets.

Defined results: words are runs of bytes that are no ASCII white space, case counts; a
text of one to four words has one shingle; null and empty texts and texts of white space
have none, link with nothing and are kept; repeated rows are copies of one another;
repeated or null ids, and ids that are no whole numbers, get numbers of their own, in ``uid``, which class and
component then name; ties are settled by the smaller uid; very long texts count whole, each in one task; an empty
table gives an empty result; extra columns are dropped, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import binary_rows, list_rows, pieces, prepare, stage_table, texts_of, utf8, with_uid
from wardline.llm.components import components
from wardline.llm.hashing import mix, shingles, sorted_sets, words
from wardline.llm.overlap import identity, numbered, verify

_STEP = 0x9E3779B97F4A7C15
_GOLD = np.uint64(_STEP)


def signatures(h: np.ndarray, seg: np.ndarray, count: np.ndarray, docs: int, size: int) -> np.ndarray:
    """[document, component] BagMinHash values (infinite for documents without items)."""
    weight = np.bincount(seg, count, docs)
    out = np.full((docs, size), np.inf)
    open_ = weight > 0
    limit = np.zeros(docs)
    limit[open_] = (np.log(size) + 5) / weight[open_]
    while open_.any():
        out[open_] = np.inf
        own = open_[seg]
        hh, ss, cc = h[own], seg[own], count[own]
        low, step, block = 0, 1, 0
        while len(hh):  # the blocks [0, 1), [1, 2), [2, 4), ... of the weight axis
            state = mix(hh + np.uint64((block + 1) * _STEP & 0xFFFFFFFFFFFFFFFF))
            s, c, x = ss, cc, np.zeros(len(hh))
            while len(state):
                state = state + _GOLD
                r = mix(state)
                x = x - np.log(((r >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / (size * step)
                go = x <= limit[s]
                state, s, c, x = state[go], s[go], c[go], x[go]
                r = mix(state ^ np.uint64(0x632BE59BD9B4E019))
                part = ((r >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
                level = low + (((r & np.uint64(0xFFFFFFFF)) * np.uint64(step)) >> np.uint64(32)).astype(np.int64)
                hit = level < c
                np.minimum.at(out.reshape(-1), s[hit] * size + part[hit].astype(np.int64), x[hit])
            low, step, block = low + step, max(step, low + step), block + 1
            more = cc > low
            hh, ss, cc = hh[more], ss[more], cc[more]
        open_ &= np.isinf(out).any(1)
        limit[open_] *= 2
    return out


def multisets(p: pa.RecordBatch, size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted shingles, their rows and their counts for a batch of texts."""
    buf, off = utf8(p.column("text"))
    return sorted_sets(*shingles(*words(buf, off), size))


def item_sets(rows: DataFrame, size: int = 5) -> DataFrame:
    """(key, items): the numbered shingles of each text, sorted.  ``rows`` has (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in pieces(batches):
            h, seg = numbered(*multisets(p, size))
            off = np.searchsorted(seg, np.arange(p.num_rows + 1))
            yield pa.RecordBatch.from_arrays([p.column("key"), binary_rows(h, off)], ["key", "items"])

    return rows.select("key", "text").mapInArrow(run, "key long, items binary")


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, bands: int = 32,
           rows: int = 7) -> DataFrame:
    """(id, uid, c1, c2, n_items, bands) of each document; no bands where there are no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in pieces(batches):
            n = p.num_rows
            h, seg, count = multisets(p, size)
            sig = signatures(h, seg, count, n, bands * rows).view(np.uint64).reshape(n * bands, rows)
            key = np.zeros(n * bands, np.uint64)
            for k in range(rows):
                key = mix(key + sig[:, k])
            key = mix(key + np.tile(np.arange(bands, dtype=np.uint64), n)).view(np.int64).reshape(n, bands)
            items, of = numbered(h, seg, count)
            off = np.searchsorted(of, np.arange(n + 1))
            c1, c2 = identity(items, off)
            full = np.diff(off) > 0
            yield pa.RecordBatch.from_arrays(
                [*p.columns[:2], pa.array(c1), pa.array(c2), pa.array(np.diff(off)),
                 list_rows(pa.array(key[full].reshape(-1)), np.append(0, np.cumsum(full * bands)))],
                [id_col, "uid", "c1", "c2", "n_items", "bands"])

    kind = docs.schema[id_col].dataType.simpleString()
    return texts_of(docs, id_col, "uid", text_col=text_col).mapInArrow(
        run, f"`{id_col}` {kind}, uid long, c1 long, c2 long, n_items long, bands array<long>")


def _verified(met: DataFrame, other: str, sets: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) among the pairs of ``uid`` and the other column, after the filter by size."""
    n, m = F.col("n_items"), F.col(f"{other}n_items")
    pairs = (met.filter(F.least(n, m) >= F.lit(threshold) * F.greatest(n, m))
             .select(F.least("uid", f"{other}uid").alias("a"), F.greatest("uid", f"{other}uid").alias("b")).distinct())
    return stage_table(verify(pairs, sets, threshold).select("a", "b"), "links")


def _rarity(sets: DataFrame, buckets: int) -> np.ndarray:
    """How many of the sets' items fall into each of ``buckets`` hash buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            items = np.frombuffer(b"".join(b.column("items").to_pylist()), np.uint64)
            at, n = np.unique((items % np.uint64(buckets)).astype(np.int64), return_counts=True)
            total[at] += n
        at = np.flatnonzero(total)
        for k in range(0, len(at), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[k:k + 50_000]), pa.array(total[at[k:k + 50_000]])], ["bucket", "n"])

    rows = sets.select("items").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # ``buckets`` at most
    out = np.zeros(buckets, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def _prefixes(sets: DataFrame, threshold: float, buckets: int = 1 << 20) -> DataFrame:
    """(uid, n_items, item, place, indexed): the rarest items of each set, by one order for all sets.

    Sets with a likeness of ``threshold`` share one of the first n - ceil(threshold n) + 1 items of the larger
    and the first m - ceil(2 threshold / (1 + threshold) m) + 1 (``indexed``) of the smaller, whatever the order.
    """
    shared = sets.sparkSession.sparkContext.broadcast(_rarity(sets, buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            uid, n, item, place, indexed = [], [], [], [], []
            for key, x in zip(b.column("key").to_pylist(), b.column("items").to_pylist(), strict=True):
                h = np.frombuffer(x, np.uint64)
                most = len(h) - int(np.ceil(threshold * len(h) - 1e-9)) + 1
                first = np.lexsort((h, shared.value[(h % np.uint64(buckets)).astype(np.int64)]))[:most]
                uid.append(np.full(len(first), key))
                n.append(np.full(len(first), len(h)))
                item.append(h[first].view(np.int64))
                place.append(np.arange(1, len(first) + 1))
                indexed.append(place[-1] <= len(h) - int(np.ceil(2 * threshold / (1 + threshold) * len(h) - 1e-9)) + 1)
            if uid:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (uid, n, item, place, indexed)], ["uid", "n_items", "item", "place", "indexed"])

    return sets.mapInArrow(run, "uid long, n_items long, item long, place long, indexed boolean")


def _rest(sets: DataFrame, open_: DataFrame, threshold: float) -> DataFrame:
    """(a, b): pairs of texts in ``open_`` that may be alike and lie in different components.

    An exact set-similarity join: common prefix items, then the filters by size and place.
    """
    group = open_.select("uid", "component").distinct()
    own = sets.join(group.select(F.col("uid").alias("key")), "key").select("key", "items")
    rows = stage_table(_prefixes(own, threshold).join(group, "uid"), "prefixes")
    index = rows.filter("indexed").select("item", *[F.col(c).alias(f"e_{c}") for c in ("uid", "n_items", "place", "component")])
    n, m, t = F.col("n_items"), F.col("e_n_items"), F.lit(threshold)
    need = F.ceil(t / (1 + t) * (n + m) - F.lit(1e-9))
    alike = (rows["item"] == index["item"]) & (F.col("e_component") != F.col("component")) & (m >= t * n - F.lit(1e-9))
    alike &= (m < n) | ((m == n) & (F.col("e_uid") < F.col("uid")))
    alike &= F.lit(1) + F.least(n - F.col("place"), m - F.col("e_place")) >= need
    return rows.join(index, alike).select(F.least("uid", "e_uid").alias("a"), F.greatest("uid", "e_uid").alias("b")).distinct()


def near_duplicates(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
                    size: int = 5, bands: int = 32, rows: int = 7, most_rounds: int = 2) -> DataFrame:
    """(id, uid, n_items, class_id, component_id, kept) of every document.

    ``class_id`` is the smallest uid with the same multiset, ``component_id`` the smallest
    uid that links of likeness >= ``threshold`` reach; ``kept`` marks that document itself.
    """
    prepare(docs.sparkSession)
    docs = with_uid(docs.select(id_col, text_col), id_col)
    sketches = stage_table(sketch(docs, id_col, text_col, size, bands, rows), "sketch")
    narrow = sketches.select(id_col, "uid", "c1", "c2", "n_items")
    classes = stage_table(narrow.filter("n_items > 0").groupBy("c1", "c2").agg(F.min("uid").alias("class_id")), "class")
    first = classes.select(F.col("class_id").alias("uid"))
    met = sketches.join(first, "uid").select(F.explode("bands").alias("key"), "uid", "n_items")
    w = Window.partitionBy("key").orderBy("uid")
    met = stage_table(met.select("*", F.lag("uid").over(w).alias("p"), F.lead("uid").over(w).alias("q"))
                      .filter(F.col("p").isNotNull() | F.col("q").isNotNull()).drop("p", "q"), "met")
    sets = stage_table(item_sets(docs.join(met.select("uid").distinct(), "uid")
                                 .select(F.col("uid").alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text")), size), "sets")

    # Rounds of stars: one class of each bucket, another in every bucket and round, is
    # compared with those that it is not connected to yet.
    links, open_ = None, met.withColumn("component", F.col("uid"))
    for turn in range(most_rounds):
        w = Window.partitionBy("key").orderBy(F.xxhash64(F.lit(turn), "key", "uid"))
        star = open_.select("*", *[F.first(c).over(w).alias(f"head_{c}") for c in ("uid", "n_items", "component")])
        found = _verified(star.filter("component != head_component"), "head_", sets, threshold)
        links = found if links is None else links.union(found)
        group = components(links)
        open_ = met.join(group.withColumnRenamed("node", "uid"), "uid", "left").withColumn("component", F.coalesce("component", "uid"))
        spread = (open_.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
                  .filter("low < high").select("key"))
        open_ = stage_table(open_.join(spread, "key"), "open")
        # Pairs that are left: in each bucket, those of different components.
        n = F.col("n")
        left = (open_.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("key")
                .agg((F.sum(n) * F.sum(n) - F.sum(n * n)).alias("twice"), F.sum(n).alias("n"))
                .agg(F.sum("twice"), F.sum("n")).first())
        if (left[0] or 0) <= 8 * (left[1] or 0):
            break
    # Whatever still lies in different components of a bucket goes through an exact join by rare items.
    rest = stage_table(verify(_rest(sets, open_, threshold), sets, threshold).select("a", "b"), "links")
    group = components(links.union(rest))

    found = classes.join(group.select(F.col("node").alias("class_id"), "component"), "class_id", "left").select(
        "c1", "c2", "class_id", F.coalesce("component", "class_id").alias("component_id"))
    out = narrow.join(found, ["c1", "c2"], "left").select(
        id_col, "uid", "n_items", F.coalesce("class_id", "uid").alias("class_id"),
        F.coalesce("component_id", "uid").alias("component_id"))
    return out.withColumn("kept", F.col("uid") == F.col("component_id"))
