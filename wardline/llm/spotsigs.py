"""Document fingerprints by SpotSigs: chains of content words after common-word anchors.

Wherever a common word (an anchor) stands, the next ``chain`` content words form a spot
signature together with it.  The fingerprint of a text is the set of its spot
signatures, written as sorted 48-bit hex values.  Running text has many anchors, menus
and lists have few, so the fingerprint follows the prose.

``fingerprints`` and ``with_neighbours`` work in one pass; the latter deals the texts
once, in id order, into ranges, and hands each range the first text of the range after
it.  ``matches`` compares all texts: sets are partitioned by length so that only
neighbouring partitions can hold alike sets, meet by their rarest signatures, and are
compared by a Jaccard count that stops once the bound cannot be reached.

Defined results: words are runs of ASCII letters, digits and characters beyond ASCII, in
lower case; a text without spots but with words has one signature for its words; null
and empty texts and texts without words have the empty fingerprint; two empty fingerprints have likeness 1,
an empty and another one 0; equal texts have equal fingerprints.  Neighbours follow by
descending id, null ids last, repeated ids by the text's hash; the last row's neighbour is the first
one, and a single row is its own.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import pieces, prepare, stage_table, texts_of, utf8, with_uid
from wardline.llm.hashing import mix, words

#: Frequent function words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be but by for from had has have he in is it its not of on or that the their this to was were which with you "
    "als am auch auf aus bei das dem den der des die durch ein eine einen einer es im ist mit nach nicht sich sie sind so und von war wie zu zum "
    "au aux avec ce ces dans de du elle en est et il la le les leur mais ne nous ou par pas plus pour que qui sa se son sur un une "
    "al como con cual del el ella entre era esta las lo los mas no nos o para pero por si sin sobre su sus y ya"
)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_KEPT = np.uint64(0xFFFFFFFFFFFF)


def _anchors() -> np.ndarray:
    listed = " ".join(sorted(set(ANCHORS.split()))).encode()
    return np.sort(words(np.frombuffer(listed, np.uint8), np.array([0, len(listed)]))[0])


def spots(column: pa.Array, chain: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct signatures of each text, and the row offsets into them."""
    buf, off = utf8(column)
    n = len(off) - 1
    word, row = words(_LOWER[buf], off, _WORD)
    common = _anchors()
    is_anchor = common[np.minimum(np.searchsorted(common, word), len(common) - 1)] == word
    content = np.flatnonzero(~is_anchor)
    anchor = np.flatnonzero(is_anchor)
    first = np.searchsorted(content, anchor)  # the first content word after each anchor
    fits = first + chain <= len(content)
    anchor, first = anchor[fits], first[fits]
    fits = row[content[first + chain - 1]] == row[anchor] if len(anchor) else np.zeros(0, bool)
    anchor, first = anchor[fits], first[fits]
    sig = mix(word[anchor])
    for k in range(chain):
        sig = mix(sig + word[content[first + k]])
    at = row[anchor]
    # Texts without a spot: all their words, as one signature.
    bare = np.flatnonzero(np.bincount(row, minlength=n)[:n] * (np.bincount(at, minlength=n)[:n] == 0))
    if len(bare):
        pos = np.arange(len(word), dtype=np.uint64) - np.searchsorted(row, row).astype(np.uint64)
        total = np.append(np.uint64(0), np.cumsum(mix(word + mix(pos))))
        begin, end = np.searchsorted(row, bare), np.searchsorted(row, bare, "right")
        sig, at = np.append(sig, mix(total[end] - total[begin])), np.append(at, bare)
    sig = sig & _KEPT
    order = np.lexsort((sig, at))
    sig, at = sig[order], at[order]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (at[1:] != at[:-1])
    sig, at = sig[new], at[new]
    return sig, np.searchsorted(at, np.arange(n + 1))


def _hex(sig: np.ndarray, off: np.ndarray) -> list[str]:
    text = sig.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes().hex()
    return [text[12 * a:12 * b] for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard of two sorted sets; 0 without counting where the sizes rule out ``least``."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    common = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return common / (len(a) + len(b) - common)


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", chain: int = 2) -> DataFrame:
    """``keep`` columns, ``n_spots`` and ``fingerprint`` of each whole text."""
    rows = texts_of(docs, *keep, text_col=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in pieces(batches):
            sig, off = spots(p.column("text"), chain)
            yield pa.RecordBatch.from_arrays([*p.columns[:-1], pa.array(np.diff(off)), pa.array(_hex(sig, off), pa.string())],
                                             [*keep, "n_spots", "fingerprint"])

    prepare(docs.sparkSession)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema[:-1])
    return rows.mapInArrow(run, schema + "n_spots long, fingerprint string")


def with_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chain: int = 2,
                    range_bytes: int = 16 << 20) -> DataFrame:
    """Each text's fingerprint, that of its edited text (the last third of its code points
    replaced by as many of the next document's first ones) and both likenesses.

    The texts are dealt once, by ranges of ids of about ``range_bytes`` each; the bounds of the ranges
    come from quantiles of the ids (one number per range reaches the driver).
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    ranges = max(1, min(100_000, int((size[0] or 0) // range_bytes)))
    cuts = sorted(set(rows.approxQuantile("id", [k / ranges for k in range(1, ranges)], 0.2 / ranges))) if ranges > 1 else []
    # Ids as doubles only place a row; order inside and between ranges is exact because rounding keeps it.
    place = F.coalesce(F.lit(len(cuts)) - _rank(F.col("id").cast("double"), cuts), F.lit(len(cuts) + 1)).cast("long")
    rows = rows.withColumn("place", place)
    # The first row of each range also closes the range before it; the first of all closes the last.
    top = rows.groupBy("place").agg(F.max(F.struct("id", F.xxhash64("text").alias("h"))).alias("top"))
    found = sorted((r.place, r.top) for r in top.collect())  # one row per range
    heads = [(found[k - 1][0], p, t.id, t.h) for k, (p, t) in enumerate(found)]
    small = F.broadcast(spark.createDataFrame(heads, "closes long, place long, id long, h long"))
    r, s = rows.alias("r"), small.alias("s")
    extra = (r.join(s, (F.col("r.place") == F.col("s.place")) & F.col("r.id").eqNullSafe(F.col("s.id")) & (F.xxhash64("r.text") == F.col("s.h")))
             .select(F.col("s.closes").alias("place"), F.col("r.id").alias("id"), F.col("r.text").alias("text"))
             .dropDuplicates(["place"]).withColumn("last", F.lit(True)))
    dealt = (rows.select("place", "id", "text").withColumn("last", F.lit(False)).unionByName(extra)
             .repartitionById(len(cuts) + 2, F.col("place").cast("int"))  # one range per partition
             .sortWithinPartitions("place", "last", F.col("id").desc_nulls_last(), F.xxhash64("text").desc()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple[int, int | None, str] | None = None
        for p in pieces(batches):
            place, last = p.column("place").to_pylist(), p.column("last").to_pylist()
            ids, texts = p.column("id").to_pylist(), p.column("text").to_pylist()
            own: list[tuple[int | None, str, str]] = []
            for k in range(p.num_rows):
                if before is not None:
                    own.append((before[1], before[2], texts[k]))
                before = None if last[k] else (place[k], ids[k], texts[k])
            if own:
                yield _compared(own, chain)

    return dealt.mapInArrow(run, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                 "near_edited double, near_next double").withColumnRenamed("id", id_col)


def _compared(rows: list[tuple[int | None, str, str]], chain: int) -> pa.RecordBatch:
    edited = [edit(t, after) for _, t, after in rows]
    own, edit_, after = (spots(pa.array(x, pa.string()), chain) for x in ([r[1] for r in rows], edited, [r[2] for r in rows]))
    near = [[likeness(own[0][a:b], x[0][c:d]) for a, b, c, d in zip(own[1][:-1], own[1][1:], x[1][:-1], x[1][1:], strict=True)]
            for x in (edit_, after)]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([len(r[1]) for r in rows], pa.int64()),
         pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]), pa.array(_hex(*own), pa.string()),
         pa.array(_hex(*edit_), pa.string()), pa.array(near[0], pa.float64()), pa.array(near[1], pa.float64())],
        ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def edit(text: str, after: str) -> str:
    """The last third of the code points replaced by the first as many (or all) of ``after``."""
    k = len(text) // 3
    return text[: len(text) - k] + after[:k]


def _rank(c, cuts: list[float]):
    """How many cuts lie at or below the value: a search tree of comparisons."""
    def node(a: int, b: int):
        if a == b:
            return F.lit(a)
        m = (a + b) // 2
        return F.when(c >= F.lit(cuts[m]), node(m + 1, b)).otherwise(node(a, m))

    return F.when(c.isNotNull(), node(0, len(cuts)))


def matches(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", chain: int = 2) -> DataFrame:
    """(a, b, likeness) of all pairs of different fingerprints with a Jaccard of ``threshold`` or
    more, as the smallest uids that have them.  Equal fingerprints count as one text;
    empty ones match nothing."""
    prints = fingerprints(with_uid(docs.select(id_col, text_col), id_col), ("uid",), text_col, chain).filter("n_spots > 0")
    sets = stage_table(prints.groupBy("fingerprint").agg(F.min("uid").alias("key"), F.first("n_spots").alias("n")), "prints")
    value = F.expr("transform(sequence(0, cast(n as int) - 1), i -> substr(fingerprint, 12 * i + 1, 12))")
    each = sets.select("key", "n", F.explode(value).alias("spot"))
    often = each.groupBy("spot").agg(F.count(F.lit(1)).alias("f")).filter("f > 1")
    w = Window.partitionBy("key").orderBy("f", "spot")
    # Rarest first; signatures of one text only come before all of these and are counted as skipped.
    shared = each.join(often, "spot").select("*", F.row_number().over(w).alias("nth"), F.count(F.lit(1)).over(Window.partitionBy("key")).alias("m"))
    t = F.lit(threshold)
    front = (shared.filter(F.col("n") - F.col("m") + F.col("nth") <= F.col("n") - F.ceil(t * F.col("n") - 1e-9) + 1)
             .withColumn("part", F.floor(F.log(F.col("n").cast("double")) / -np.log(threshold)).cast("long")))
    # A set meets sets of its own length partition and of the one above.
    low = front.withColumn("part", F.explode(F.array("part", F.col("part") + 1)))
    pairs = (low.select("spot", "part", F.col("key").alias("p"), F.col("n").alias("pn"))
             .join(front.select("spot", "part", F.col("key").alias("q"), F.col("n").alias("qn")), ["spot", "part"])
             .filter((F.col("p") != F.col("q")) & (F.col("pn") <= F.col("qn")) & (F.col("pn") >= t * F.col("qn") - 1e-9))
             .select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct())
    items = sets.select("key", "fingerprint", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = ([np.frombuffer(bytes.fromhex(v), "S6") for v in b.column(c).to_pylist()] for c in ("x", "y"))
            near = pa.array([likeness(p, q, threshold) for p, q in zip(x, y, strict=True)], pa.float64())
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), near], ["a", "b", "likeness"]).filter(
                pa.compute.greater_equal(near, threshold))

    return (pairs.join(items.select(F.col("key").alias("a"), F.col("fingerprint").alias("x")), "a")
            .join(items.select(F.col("key").alias("b"), F.col("fingerprint").alias("y")), "b").select("a", "b", "x", "y")
            .mapInArrow(run, "a long, b long, likeness double"))
