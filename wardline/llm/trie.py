"""Conversation prefix trie by range minima over sorted common prefixes.

A turn becomes 16 bytes of the SHA-256 of its role and text, a conversation the string of
its turns' digests.  One range sort by (string, id) brings the conversations in order; the
trie is then in the array of common prefix lengths (LCP) of neighbours: a node of depth d is
a longest run of conversations whose inner LCPs are d or more.  Each task holds one range (a
block): it builds a sparse table of range minima over its LCPs, and every candidate, a
conversation and a depth at which its prefix first occurs, finds its right end by binary
search over the table, and the two ends of its parent likewise; no candidate waits for
another and there is no stack.  Members, children, leaves and saved tokens of an interval are
differences of running sums, its smallest id a range minimum.

A node that holds the first or the last conversation of a block may go on in the next one.
Those nodes are the prefixes of these two; the block reports them as pieces with partial
sums.  One small task joins the pieces of all blocks (``most_blocks`` at most, which does not
grow with the input) by the same table and searches over the LCPs between and within blocks.

Copies of one conversation, and conversations that share a first turn, are spread over as many
blocks as they fill, since the sort goes by string and id.  Memory: a task holds a few numbers
per turn of its block, and one conversation is one row of 16 bytes a turn.  Ids that end in
one node are hashed in numeric order; a chain of SHA-256 cannot be split, so the ids of a node
that several blocks share come joined, some thousands a row.

Defined results: rows with a null conversation id belong to none and are left out; turns go
in order of turn (null first), then role, then text; null roles and texts are empty; repeated rows
are turns of their own; long texts count whole (as digests); conversations without turns are members of the root
only; an empty table gives an empty trie; extra columns are dropped, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import prepare, stage_table

#: Bytes of a turn's digest.
SIZE = 16
_EMPTY = hashlib.sha256(b"").hexdigest()


class RangeMinimum:
    """Sparse table: level k holds the minima of 2^k neighbours."""

    def __init__(self, values: np.ndarray):
        self.levels = [np.asarray(values, np.int64)]
        width = 1
        while 2 * width <= len(values):
            low = self.levels[-1]
            self.levels.append(np.minimum(low[:-width], low[width:]))
            width *= 2

    def least(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Minima of [start, end), none empty."""
        k = np.frexp((end - start).astype(float))[1] - 1
        out = np.empty(len(start), np.int64)
        for level in np.unique(k).tolist():
            at = k == level
            row = self.levels[level]
            out[at] = np.minimum(row[start[at]], row[end[at] - (1 << level)])
        return out

    def right(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first position from ``start`` on whose value is below ``least`` (the length, if none)."""
        at = start.astype(np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            row = self.levels[level]
            fits = at + (1 << level) <= len(self.levels[0])
            go = fits & (row[np.where(fits, at, 0)] >= least)
            at = at + (go << level)
        return at

    def left(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The last position up to ``start`` whose value is below ``least`` (-1, if none)."""
        at = start.astype(np.int64) + 1  # values [at, start] are known to be large enough
        for level in range(len(self.levels) - 1, -1, -1):
            row = self.levels[level]
            fits = at >= 1 << level
            go = fits & (row[np.where(fits, at - (1 << level), 0)] >= least)
            at = at - (go << level)
        return at - 1


def common(a: bytes, b: bytes) -> int:
    """Turns at the start that two conversations share."""
    n = min(len(a), len(b)) // SIZE
    x, y = (np.frombuffer(s, np.uint8, n * SIZE).reshape(n, SIZE) for s in (a, b))
    differ = np.flatnonzero((x != y).any(1))
    return int(differ[0]) if len(differ) else n


def _before(values: np.ndarray) -> np.ndarray:
    """Running sums; entry i is the sum of the values before i."""
    return np.append(0, np.cumsum(values)).astype(np.int64)


class Occurrences:
    """How often a value occurs in a range of positions."""

    def __init__(self, values: np.ndarray):
        self.span = len(values) + 1
        self.key = np.sort(values.astype(np.int64) * self.span + np.arange(len(values)))

    def count(self, value: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        a, b = (np.searchsorted(self.key, value.astype(np.int64) * self.span + x) for x in (start, end))
        return b - a


def digest(role: str | Column = "role", text: str | Column = "text") -> Column:
    """32 hex digits that stand for a turn."""
    role, text = (F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in (role, text))
    return F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * SIZE)


def ordered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns) of each conversation; turns are structs of digest and code points, in
    order of turn (null first), then digest."""
    rows = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), digest(role_col, text_col).alias("digest"),
        F.length(F.coalesce(text_col, F.lit(""))).alias("chars"))
    turns = F.sort_array(F.collect_list(F.struct("turn", "digest", "chars")))  # turns of one conversation
    return rows.groupBy("conv_id").agg(F.transform(turns, lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns"))


def with_shared_heads(convs: DataFrame, base: Column, head: Column, is_base: Column, most: int) -> DataFrame:
    """Each conversation with its first ``head`` turns replaced by those of conversation ``base``.

    ``is_base`` marks the conversations that serve as bases; ``most`` bounds ``head``.
    """
    heads = convs.filter(is_base).select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most).alias("_head"))
    joined = convs.select("*", base.alias("_base"), head.cast("int").alias("_h")).join(heads, "_base", "left")
    front = F.coalesce(F.slice("_head", F.lit(1), F.col("_h")), F.slice("turns", 1, 0))
    return joined.select("conv_id", F.concat(front, F.slice("turns", F.col("_h") + 1, F.size("turns"))).alias("turns"))


_BLOCK = ("kind int, block int, side int, depth long, conv_id long, parent_conv_id long, parent_side int, n_convs long, n_children long, "
          "n_leaves long, saved_tokens long, ends_sha256 string, deeper boolean, whole boolean, chars long, part long, ids string, "
          "least long, first binary, last binary")
_NODE, _PIECE, _SUMMARY, _ENDS = range(4)


def _table(schema: str, n: int, **cols) -> pa.RecordBatch:
    """A batch of n rows with the given columns and nulls elsewhere."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    out, names = [], []
    for name, kind in (x.split(" ") for x in schema.split(", ")):
        value = cols.get(name)
        if value is None:
            value = pa.nulls(n, kinds[kind])
        elif not isinstance(value, pa.Array):
            value = pa.array(np.full(n, value) if np.isscalar(value) else value, kinds[kind])
        out.append(value)
        names.append(name)
    return pa.RecordBatch.from_arrays(out, names)


def _blocks(sorted_: DataFrame, ids_a_row: int) -> DataFrame:
    """Nodes, pieces, summaries and shared ends of each partition of (seq, chars, conv_id), in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids, length, lcp, chars, first, last = [], [], [], [], None, None
        for b in batches:
            ids.append(b.column("conv_id").to_numpy())
            points = b.column("chars").flatten().to_numpy()
            at = 0
            for seq in b.column("seq").to_pylist():
                n = len(seq) // SIZE
                same = -1 if last is None else common(last, seq)
                length.append(n)
                lcp.append(same)
                # The root, which has no text, is the first candidate of the block.
                chars.append(np.append(0, points[at:at + n]) if last is None else points[at + same:at + n])
                first, last, at = (seq if first is None else first), seq, at + n
        if last is not None:
            yield from _block(TaskContext.get().partitionId(), np.concatenate(ids), np.array(length), np.array(lcp),
                              np.concatenate(chars).astype(np.int64), first, last, ids_a_row)

    return sorted_.mapInArrow(run, _BLOCK)


def _block(block: int, ids: np.ndarray, length: np.ndarray, lcp: np.ndarray, chars: np.ndarray, first: bytes, last: bytes,
           ids_a_row: int) -> Iterator[pa.RecordBatch]:
    n = len(ids)
    copy = lcp == length  # of the conversation before; the first of the block counts as new
    start = _before(length - lcp)
    at = np.repeat(np.arange(n), length - lcp)
    depth = np.arange(start[-1]) - start[at] + lcp[at] + 1
    table, low = RangeMinimum(lcp), RangeMinimum(ids)
    end = table.right(at + 1, depth)
    whole = end == n
    node = (at > 0) & ~whole
    members = end - at
    saved = _before(np.where(node, (members - 1) * chars, 0))
    leaf = _before(np.append(lcp[1:] < length[:-1], True))
    deeper = length[at] > depth
    children = Occurrences(np.where(copy, -2, lcp)).count(depth, at + 1, end)
    up, up_end = table.left(at, depth - 1), table.right(at + 1, depth - 1)
    known = (up > 0) & (up_end < n)
    parent = np.zeros(len(at), np.int64)
    parent[known] = low.least(up[known], up_end[known])
    new = np.append(np.flatnonzero(~copy), n)
    run_end = new[np.searchsorted(new, at, "right")]
    cols = {"depth": depth, "conv_id": low.least(at, end), "n_convs": members, "n_leaves": leaf[end] - leaf[at],
            "saved_tokens": saved[start[end]] - saved[:-1], "chars": chars}

    for k in range(0, len(at), 50_000):
        i = k + np.flatnonzero(node[k:k + 50_000])
        ends = [_EMPTY if x else hashlib.sha256(",".join(map(str, ids[a:z].tolist())).encode()).hexdigest()
                for x, a, z in zip(deeper[i].tolist(), at[i].tolist(), run_end[i].tolist(), strict=True)]
        yield _table(_BLOCK, len(i), kind=_NODE, block=block, n_children=children[i] + deeper[i], ends_sha256=ends,
                     parent_conv_id=pa.array(parent[i], mask=~known[i]), parent_side=pa.array((up[i] > 0).astype(np.int32), mask=known[i]),
                     **{c: v[i] for c, v in cols.items()})
    i = np.flatnonzero(~node)
    yield _table(_BLOCK, len(i), kind=_PIECE, block=block, side=(at[i] > 0).astype(np.int32), n_children=children[i], deeper=deeper[i], whole=whole[i],
                 parent_side=(up[i] > 0).astype(np.int32), **{c: v[i] for c, v in cols.items()})
    inner = int(lcp[1:].min()) if n > 1 else np.iinfo(np.int64).max
    yield _table(_BLOCK, 1, kind=_SUMMARY, block=block, side=-1, depth=0, least=inner, first=pa.array([first], pa.binary()), last=pa.array([last], pa.binary()))
    for k in i[~deeper[i]].tolist():
        for a in range(int(at[k]), int(run_end[k]), ids_a_row):
            text = ",".join(map(str, ids[a:min(a + ids_a_row, int(run_end[k]))].tolist()))
            yield _table(_BLOCK, 1, kind=_ENDS, block=block, side=int(at[k] > 0), depth=int(depth[k]), part=a, ids=[text])


_PIECES = "block int, side int, depth long, conv_id long, top boolean, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def _join_pieces(rows: DataFrame) -> DataFrame:
    """The node of every piece; ``top`` marks a node's first piece, which has the sums of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches([b for b in batches if b.num_rows] or [_table(_BLOCK, 0)])
        if t.num_rows:
            yield _joined(t.combine_chunks())

    few = rows.filter(F.col("kind").isin(_PIECE, _SUMMARY)).coalesce(1).sortWithinPartitions("block", "side", "depth")
    return few.mapInArrow(run, _PIECES)


def _joined(t: pa.Table) -> pa.RecordBatch:
    s = t.filter(pa.compute.equal(t.column("kind"), _SUMMARY))
    p = t.filter(pa.compute.equal(t.column("kind"), _PIECE))
    ends = list(zip(s.column("first").to_pylist(), s.column("last").to_pylist(), strict=True))
    first, last = (np.array([len(x[k]) // SIZE for x in ends]) for k in (0, 1))
    between = np.array([-1, *[common(a[1], b[0]) for a, b in zip(ends, ends[1:], strict=False)]], np.int64)
    lcp = np.stack([between, s.column("least").to_numpy()], 1).reshape(-1)  # before a block, within it
    names = s.column("block").to_numpy()
    get = {c: p.column(c).to_numpy() for c in ("block", "side", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "chars", "parent_side")}
    deeper, whole = (p.column(c).to_numpy().astype(bool) for c in ("deeper", "whole"))
    at, side, depth = np.searchsorted(names, get["block"]), get["side"].astype(np.int64), get["depth"]
    code = 2 * at + side
    after = np.append(between[1:], -1)
    n_leaves = get["n_leaves"] - (((side == 1) | whole) & (after[at] >= last[at]))
    top = (side == 1) | (lcp[code] < depth)
    n_children = get["n_children"] + np.where(top, deeper, (lcp[code] == depth) & (first[at] > depth))

    # Every first piece finds its last block; the pieces between lie side by side, by depth.
    table, span = RangeMinimum(lcp), len(names) + 1
    i = np.flatnonzero(top)
    end = table.right(code[i] + 1, depth[i])
    order = np.flatnonzero(side == 0)
    order = order[np.lexsort((at[order], depth[order]))]
    key = depth[order] * span + at[order]
    a, z = np.searchsorted(key, depth[i] * span + at[i] + 1), np.searchsorted(key, depth[i] * span + (end + 1) // 2)
    total = {}
    for c, v in (("n_convs", get["n_convs"]), ("n_children", n_children), ("n_leaves", n_leaves), ("saved_tokens", get["saved_tokens"])):
        before = _before(v[order])
        total[c] = v[i] + before[z] - before[a]
    low = get["conv_id"][i].copy()
    more = z > a
    low[more] = np.minimum(low[more], RangeMinimum(get["conv_id"][order]).least(a[more], z[more]))
    own = _before((total["n_convs"] - 1) * get["chars"][i])
    total["saved_tokens"] = total["saved_tokens"] + own[np.searchsorted(code[i], end)] - own[:-1]

    # A later piece finds its first one to the left; a parent is the node of a piece.
    deep = int(depth.max()) + 2
    place = code[i] * deep + depth[i]  # ascending, as the pieces are
    node = np.searchsorted(place, table.left(code, depth) * deep + depth)
    node[side == 1] = np.searchsorted(place, (code * deep + depth)[side == 1])
    pieces = code * deep + depth
    child = depth[i] > 0
    up = np.searchsorted(pieces, (2 * at[i] + get["parent_side"][i]) * deep + depth[i] - 1)
    parent = low[node[np.where(child, up, 0)]]
    full = {c: np.zeros(len(code), np.int64) for c in total}
    for c, v in total.items():
        full[c][i] = v
    parents = np.zeros(len(code), np.int64)
    parents[i] = parent
    none = np.ones(len(code), bool)
    none[i] = ~child
    return _table(_PIECES, len(code), block=get["block"], side=get["side"], depth=depth, conv_id=low[node], top=top,
                  parent_conv_id=pa.array(parents, mask=none), **full)


def _hashed(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) from rows (conv_id, depth, block, part, ids), each node's in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        row = lambda: _table("conv_id long, depth long, ends_sha256 string", 1, conv_id=key[0], depth=key[1], ends_sha256=[state.hexdigest()])
        for b in batches:
            for *now, ids in zip(*(b.column(c).to_pylist() for c in ("conv_id", "depth", "ids")), strict=True):
                if now != key:
                    if key is not None:
                        yield row()
                    key, state = now, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if key is not None:
            yield row()

    ordered = ends.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "block", "part").select("conv_id", "depth", "ids")
    return ordered.mapInArrow(run, "conv_id long, depth long, ends_sha256 string")


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_trie(convs: DataFrame, *, block_rows: int = 1 << 17, most_blocks: int = 4096, ids_a_row: int = 4096) -> DataFrame:
    """One row (``NODE``) for each distinct sequence of first turns of ``convs`` (conv_id, turns), whose
    ids are distinct; ``ordered_turns`` makes them."""
    spark = convs.sparkSession
    prepare(spark, rows=2000)
    rows = stage_table(convs.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("seq"),
                                    F.transform("turns", lambda t: t["chars"]).alias("chars")), "conversations")
    n = rows.count()
    # Blocks of ``block_rows``; smaller ones while there are few, so that small tables spread too.
    blocks = max(1, min(most_blocks, max(-(-n // block_rows), min(-(-n // 2048), 32))))
    ordered = rows.repartitionByRange(blocks, "seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    rows = stage_table(_blocks(ordered.select("seq", "chars", "conv_id"), ids_a_row), "blocks")
    pieces = stage_table(_join_pieces(rows), "pieces")

    at = pieces.select("block", F.col("side").alias("parent_side"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("up"))
    nodes = rows.filter(F.col("kind") == _NODE).select("block", "parent_side", *NODE).join(at, ["block", "parent_side", "depth"], "left")
    nodes = nodes.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up")).select(*NODE)
    ends = rows.filter(F.col("kind") == _ENDS).select("block", "side", "depth", "part", "ids")
    ends = _hashed(ends.join(pieces.select("block", "side", "depth", "conv_id"), ["block", "side", "depth"]))
    tops = (pieces.filter("top").join(ends, ["conv_id", "depth"], "left")
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY))).select(*NODE))
    return nodes.unionByName(tops)
