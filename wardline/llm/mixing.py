"""Mixing sources to target weights over a domain-language-source tree.

A budget of tokens goes down the tree by the weights of the nodes.  A node whose
documents cannot fill its share (its tokens times ``max_epochs``) gives the rest back
to its siblings, in proportion to their weights, and only what all siblings together
cannot take goes to the siblings of the parent.  Each leaf then reads its documents
in seeded order, epoch after epoch with a new order each, and takes the longest
prefix that stays within its budget.  With ``fill`` it goes on behind a document that does
not fit and takes each later one that does, so that less is left than any document not taken.

The tree has one row per leaf, so the budgets are worked out on the driver
(``max_leaves`` bounds it, and more leaves raise an error).  The order inside a leaf
is the seeded hash of (epoch, doc id, text length); the hash range of each leaf is cut into
slices by the number of its rows, only sums per slice are gathered, and running
sums are taken inside the one slice where a leaf's budget ends.  A leaf that holds most
rows is therefore spread over many tasks.

Defined results: null domain, language or source are values of their own (nodes named
``(null)``); empty or null texts have 0 tokens and are taken with the prefix that
they stand in; repeated rows are selected one by one; equal hashes are ordered by
(doc_id, n_tokens, uid); very long texts are counted whole, and with ``fill`` one that exceeds its leaf's budget
is passed over; weights default to 1 for nodes that are not listed, and a weight of
0 takes nothing; an empty table or budget 0 selects nothing; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import pieces, prepare, stage_table, texts_of, utf8
from wardline.llm.hashing import SPACE, runs

Path = tuple[str, ...]


def share(budget: int, weights: Mapping[Path, float], room: Mapping[Path, int]) -> dict[Path, int]:
    """Split ``budget`` among siblings by weight; what one cannot hold goes to the others.

    Whole tokens only: fractions go to the largest remainders, ties to the smaller name.
    """
    given = dict.fromkeys(weights, 0)
    left = min(budget, sum(room[k] for k in weights if weights[k] > 0))
    open_ = sorted(k for k in weights if weights[k] > 0 and room[k] > 0)
    while left > 0 and open_:
        total = sum(weights[k] for k in open_)
        full = [k for k in open_ if left * weights[k] >= total * (room[k] - given[k])]
        if full:
            for k in full:
                left -= room[k] - given[k]
                given[k] = room[k]
            open_ = [k for k in open_ if k not in full]
            continue
        exact = {k: left * weights[k] / total for k in open_}
        for k in open_:
            given[k] += int(exact[k])
        rest = left - sum(int(x) for x in exact.values())
        for k in sorted(open_, key=lambda k: (int(exact[k]) - exact[k], k))[:rest]:
            given[k] += 1
        left = 0
    return given


def leaf_budgets(budget: int, tokens: Mapping[Path, int], weights: Mapping[Path, float], max_epochs: int = 1) -> dict[Path, int]:
    """Tokens for each leaf.  ``tokens`` are those present per leaf path, ``weights`` those of
    any node path (default 1)."""
    room: dict[Path, int] = {}
    for leaf, n in tokens.items():
        for k in range(len(leaf) + 1):
            room[leaf[:k]] = room.get(leaf[:k], 0) + (n * max_epochs if _open(leaf, weights) else 0)
    given = {(): min(budget, room.get((), 0))}
    for depth in range(max(map(len, tokens), default=0)):
        for node in [k for k in given if len(k) == depth]:
            children = {k: float(weights.get(k, 1.0)) for k in room if len(k) == depth + 1 and k[:-1] == node}
            given |= share(given[node], children, room)
    return {leaf: given[leaf] for leaf in tokens}


def _open(leaf: Path, weights: Mapping[Path, float]) -> bool:
    return all(weights.get(leaf[:k], 1.0) > 0 for k in range(1, len(leaf) + 1))


def with_word_count(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The columns other than the text, and ``n_tokens``: its words (runs of bytes that are no
    ASCII white space)."""
    rest = [c for c in docs.columns if c != text_col]
    rows = texts_of(docs, *rest, text_col=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in pieces(batches):
            buf, off = utf8(p.column("text"))
            start, _ = runs(~SPACE[buf], off)
            n = np.bincount(np.searchsorted(off, start, "right") - 1, minlength=p.num_rows)
            yield pa.RecordBatch.from_arrays([*p.columns[:-1], pa.array(n)], [*rest, "n_tokens"])

    prepare(docs.sparkSession)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema[:-1])
    return rows.mapInArrow(run, schema + "n_tokens long")


def mix(docs: DataFrame, levels: list[Column], weights: Mapping[Path, float], *, tokens: Column | None = None,
        budget: int | None = None, budget_share: float | None = None, max_epochs: int = 1, seed: int = 7,
        id_col: str = "doc_id", uid_col: str | None = None, slice_rows: int = 50_000, max_leaves: int = 100_000, fill: bool = False) -> DataFrame:
    """(id, uid, path, n_tokens, epochs) of every selected document; ``uid`` is the column ``uid_col``, or
    the id where none is named.

    ``levels`` are the columns of the tree from the root down.  Give ``budget`` tokens, or ``budget_share`` of
    the tokens present, or neither for as many tokens as are present.  ``epochs`` says how often a document is read.
    """
    path = F.array(*[F.coalesce(c.cast("string"), F.lit("(null)")) for c in levels])
    uid = F.col(uid_col if uid_col is not None else id_col).cast("long")
    rows = docs.select(F.col(id_col), uid.alias("uid"), path.alias("path"), F.col("text") if tokens is None else tokens.alias("n_tokens"))
    rows = stage_table(with_word_count(rows) if tokens is None else rows, "mix")
    present = rows.groupBy("path").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("n")).limit(max_leaves + 1).collect()
    if len(present) > max_leaves:
        raise ValueError(f"more than {max_leaves} leaves: the tree is no longer small")
    have = {tuple(r.path): r.t for r in present}
    if budget is None:
        budget = int(sum(have.values()) * (1.0 if budget_share is None else budget_share))
    given = leaf_budgets(budget, have, weights, max_epochs)

    # Whole epochs need no order; the last one ends inside a slice of the hash range.
    plan = [(list(leaf), *divmod(b, have[leaf]), max(1, -(-r.n // slice_rows)))
            for r in present for leaf in [tuple(r.path)] for b in [given[leaf]] if b > 0]
    order = F.xxhash64(F.lit(seed), "whole", id_col, "n_tokens")
    rows = _with_leaves(rows, [r[:2] for r in plan], "whole long").withColumn("order", order)
    columns = (id_col, "uid", "path", "n_tokens", (F.col("whole") + F.col("extra")).alias("epochs"))
    leaves = [(path, rest, slices) for path, _, rest, slices in plan]
    if not fill:
        return _prefix(rows, leaves, id_col).select(*columns).filter("epochs > 0")
    # Every round writes what it takes: the plans of all rounds together would fill the driver.
    done, kept = [], rows.columns
    while True:
        out = stage_table(_prefix(rows, leaves, id_col), "mix-fill")
        left = F.col("extra") == 0
        found = out.groupBy("path", "rest").agg(
            F.sum(F.when(~left, F.col("n_tokens"))).alias("taken"), F.min(F.when(left, F.col("n_tokens"))).alias("least"),
            F.count(F.when(left, F.lit(1))).alias("n")).collect()
        # What does not fit now never will: the room of a leaf only shrinks.
        leaves = [(r.path, room, max(1, -(-r.n // slice_rows))) for r in found for room in [r.rest - (r.taken or 0)]
                  if room > 0 and r.least is not None and r.least <= room]
        if not leaves:
            return reduce(DataFrame.unionByName, [*done, out.select(*columns).filter("epochs > 0")])
        out = _with_leaves(out.drop("rest"), [r[:2] for r in leaves], "rest long", "left")
        fits = F.coalesce(left & (F.col("n_tokens") <= F.col("rest")), F.lit(False))
        done.append(stage_table(out.filter(~fits).select(*columns).filter("epochs > 0"), "mix-done"))
        rows = out.filter(fits).select(*kept)


def _with_leaves(rows: DataFrame, values: list[tuple], columns: str, how: str = "inner") -> DataFrame:
    """``rows`` with the values of their leaf, one row per leaf."""
    small = rows.sparkSession.createDataFrame(values, f"path array<string>, {columns}")
    return rows.join(F.broadcast(small), "path", how)


def _prefix(rows: DataFrame, leaves: list[tuple], id_col: str) -> DataFrame:
    """The rows of ``leaves`` (path, rest, slices) with ``rest``, and ``extra`` 1 for those in the longest
    prefix of their leaf within ``rest``.  The driver gets the slice where each leaf's prefix ends."""
    place = ((F.col("order").cast("double") / F.lit(2.0**64) + F.lit(0.5)) * F.col("slices")).cast("long")
    sums = (_with_leaves(rows, leaves, "rest long, slices long").filter("rest > 0")
            .groupBy("path", "rest", place.alias("slice")).agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("t")))
    start = F.sum("t").over(Window.partitionBy("path").orderBy("slice")) - F.col("t")
    ends = {tuple(r.path): (r.slice, r.start) for r in sums.withColumn("start", start).filter(
        (F.col("start") <= F.col("rest")) & (F.col("start") + F.col("t") > F.col("rest"))).select("path", "slice", "start").collect()}
    known = [(*x, *ends.get(tuple(x[0]), (None, None))) for x in leaves]
    placed = _with_leaves(rows, known, "rest long, slices long, end long, start long").withColumn("slice", place)
    inside = F.col("slice").eqNullSafe(F.col("end"))
    before = (F.col("rest") > 0) & (F.col("end").isNull() | (F.col("slice") < F.col("end")))
    run = F.sum("n_tokens").over(Window.partitionBy("path").orderBy("order", id_col, "n_tokens", "uid")
                                 .rowsBetween(Window.unboundedPreceding, 0))
    whole = placed.filter(~inside).withColumn("extra", before.cast("long"))
    cut = placed.filter(inside).withColumn("extra", F.coalesce(F.col("start") + run <= F.col("rest"), F.lit(True)).cast("long"))
    return whole.unionByName(cut).select(*rows.columns, "rest", "extra")
