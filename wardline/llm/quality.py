"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics come from the whole text and nothing else.  The trees are fitted
on a bounded sample of labelled rows (``max_rows``, the smallest seeded hashes of
the ids), grown level by level on histograms of binned statistics, and flattened
into arrays: node ``i`` of a tree has the children ``2i+1`` and ``2i+2``, so that a
batch of documents walks all trees with a few numpy steps.  Scoring is one pass
over the documents without a shuffle.

Defined results: null text counts as empty; empty texts get a score like any
other; documents with equal texts get equal scores; extra columns are ignored;
labels that are null are skipped, several labels of one id count as their
maximum; without a labelled row of both classes every score is 0.5 (of one
class: its label, smoothed); an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import prepare, pieces, texts_of

STATISTICS = (
    "log_chars", "log_words", "word_length", "distinct_words", "top_word", "repeated_next", "upper", "lower",
    "digits", "white", "plain_punctuation", "symbols", "not_ascii", "line_length", "distinct_lines",
    "unfinished_lines", "words_per_stop", "longest_word", "symbol_words", "pipes", "title_words", "short_words",
)
_KIND = np.zeros((256, 8))
for _i in range(256):
    _c = chr(_i)
    _KIND[_i] = [_i < 128 and _c.isupper(), _i < 128 and _c.islower(), _c.isdigit() and _i < 128, _c in " \t\r\n",
                 _c in ".,;:'\"-()?", _i < 128 and _c.isprintable() and not _c.isalnum() and _c not in " .,;:'\"-()?",
                 _i >= 128, _c in "|<>{}[]=\\"]


def statistics(text: str) -> list[float]:
    """The statistics of one text, in the order of ``STATISTICS``."""
    words = text.split()
    raw = text.encode("utf-8", "surrogatepass")
    n, chars, size = max(len(words), 1), len(text), max(len(raw), 1)
    seen = Counter(words)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower, digits, white, plain, symbols, high, pipes = counts @ _KIND / size
    lines = [x for x in text.split("\n") if x]
    ends = sum(1 for x in lines if x[-1] not in ".!?:\"'")
    lengths = list(map(len, words))
    return [
        np.log1p(chars), np.log1p(len(words)), sum(lengths) / n, len(seen) / n, max(seen.values(), default=0) / n,
        sum(map(eq, words, words[1:])) / n, upper, lower, digits, white, plain, symbols, high,
        chars / max(len(lines), 1), len(set(lines)) / max(len(lines), 1), ends / max(len(lines), 1),
        n / (1 + counts[46] + counts[33] + counts[63]), max(lengths, default=0),
        sum(v for w, v in seen.items() if not w[-1].isalnum() and w[-1] not in ".,;:") / n, pipes,
        sum(v for w, v in seen.items() if w[0].isupper()) / n, lengths.count(1) / n,
    ]


def feature_matrix(texts: list[str]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], float).reshape(len(texts), len(STATISTICS))


@dataclass
class Forest:
    """Flattened trees: arrays of [tree, node]; a node without a split sends all rows left."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        total = np.full(len(x), self.base)
        if len(self.feature) and len(x):
            tree = np.arange(len(self.feature))[None, :]
            row = np.arange(len(x))[:, None]
            at = np.zeros((len(x), len(self.feature)), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[row, self.feature[tree, at]] > self.threshold[tree, at])
            total += self.leaf[tree, at - (2**self.depth - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
               smooth: float = 1.0, least: int = 10) -> Forest:
    """Boost on the logistic loss; each level adds one histogram of gradients per node."""
    inner, leaves = 2**depth - 1, 2**depth
    none = Forest(0.0, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)), depth)
    if not len(y):
        return none
    share = (y.sum() + 0.5) / (len(y) + 1)
    none.base = float(np.log(share / (1 - share)))
    if y.min() == y.max():
        return none
    cuts = [np.unique(np.quantile(x[:, j], np.arange(1, bins) / bins)) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
    feature, threshold, leaf = [], [], []
    total = np.full(len(y), none.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feat, thr = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best = np.zeros(width)
            cut = np.full(width, bins)
            for j in range(x.shape[1]):
                cell = (node - first) * bins + binned[:, j]
                g, h, c = (np.bincount(cell, w, width * bins).reshape(width, bins).cumsum(1)
                           for w in (grad, hess, np.ones(len(y))))
                gain = g**2 / (h + smooth) + (g[:, -1:] - g)**2 / (h[:, -1:] - h + smooth) - g[:, -1:]**2 / (h[:, -1:] + smooth)
                gain[(c < least) | (c[:, -1:] - c < least)] = 0
                gain[:, len(cuts[j]):] = 0
                at = gain.argmax(1)
                value = gain[np.arange(width), at]
                better = value > best + 1e-9
                best[better], cut[better] = value[better], at[better]
                feat[first:first + width][better] = j
                for k in np.flatnonzero(better):
                    thr[first + k] = cuts[j][at[k]]
            own = feat[node]
            node = 2 * node + 1 + (binned[np.arange(len(y)), own] > cut[node - first])
        slot = node - inner
        value = -rate * np.bincount(slot, grad, leaves) / (np.bincount(slot, hess, leaves) + smooth)
        total += value[slot]
        feature.append(feat), threshold.append(thr), leaf.append(value)
    return Forest(none.base, np.stack(feature), np.stack(threshold), np.stack(leaf), depth)


def sample_labels(labels: DataFrame, max_rows: int, seed: int, id_col: str = "doc_id",
                  label_col: str = "quality") -> DataFrame:
    """At most ``max_rows`` labelled ids of the training folds: those with the smallest seeded hashes."""
    own = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
           .groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label_col).cast("double").alias("label")))
    share = min(1.0, 1.1 * max_rows / max(own.count(), 1))
    rank = F.xxhash64(F.lit(seed), "doc_id")
    return (own.filter((rank.cast("double") / F.lit(2.0**64) + F.lit(0.5)) <= F.lit(share))
            .orderBy(rank, "doc_id").limit(max_rows))


def held_out(id_col: str = "doc_id"):
    """Rows that are never learnt from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(5) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, seed: int = 8, **options) -> Forest:
    """Fit on a sample of at most ``max_rows`` labelled documents (a bound on what the
    driver gathers: one row of statistics each)."""
    chosen = F.broadcast(sample_labels(labels, max_rows, seed))  # at most max_rows rows

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = feature_matrix(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("label"), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    prepare(docs.sparkSession)
    rows = (texts_of(docs, "doc_id").join(chosen, "doc_id")
            .mapInArrow(measured, "doc_id long, label double, x array<double>").collect())
    rows.sort(key=lambda r: (r.doc_id, r.x))
    x = np.array([r.x for r in rows], float).reshape(len(rows), len(STATISTICS))
    return fit_forest(x, np.array([r.label for r in rows]), **options)


def score(docs: DataFrame, forest: Forest, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, text (null: empty) and ``score`` of every document."""
    out = texts_of(docs, *keep)
    shared = docs.sparkSession.sparkContext.broadcast(forest)  # trees x 2**depth numbers

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in pieces([b]):
                s = shared.value.score(feature_matrix(p.column("text").to_pylist()))
                yield pa.RecordBatch.from_arrays([*p.columns, pa.array(s)], [*p.schema.names, "score"])

    prepare(docs.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    return out.mapInArrow(scored, f"{schema}, score double")
