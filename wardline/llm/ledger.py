"""Quality rules as a bitmask ledger.

Every rule is evaluated once: one pass over the texts takes the measurements, and each
rule, an integer comparison of them, sets its bit in ``failed``.  The ledger (measurements
and bits, no texts) is stored; policies are versioned masks over it, so that a new policy,
an old one or one rule less needs no text again.  Ablations come from bitwise aggregates:
documents are counted per ``failed`` value (at most 2 ** rules rows, whatever the input),
and each policy and rule is then a test of bits on that histogram.

Measurements: words are runs of code points other than U+0020 and U+0009 to U+000D, lines
are split at U+000A and count where they hold a word.  Windows of eight words are compared
within a text by 64-bit hashes.

Defined results: a null text is empty; an empty text, or one of white space, has zero of
everything and fails ``few_words``; very long texts are measured whole, each in one task;
equal or repeated rows and null ids are rows of their own with equal measurements (a repeated
line counts for its own text only); an empty table gives an empty ledger, and ablations of
zeros; extra columns are dropped, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import pieces, prepare, texts_of, utf8
from wardline.llm.hashing import SPACE, mix, runs, word_hashes

#: Words in a window that is looked for twice.
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ellipsis_lines", "n_upper", "n_digits",
            "n_letter_words")


@dataclass(frozen=True)
class Rule:
    """A named reason to reject: a SQL condition over ``MEASURES`` that is never null."""

    name: str
    fails: str


#: The position of a rule is its bit: append new rules, never reorder.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("long_words", "word_chars > 10 * n_words"),
    Rule("short_words", "word_chars < 3 * n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("capitals", "10 * n_upper > 4 * word_chars"),
    Rule("digits", "2 * n_digits > word_chars"),
    Rule("words_without_letters", "10 * n_letter_words < 8 * n_words"),
    Rule("ellipses", "10 * n_ellipsis_lines > 3 * n_lines"),
)


def mask_of(*names: str, rules: tuple[Rule, ...] = RULES) -> int:
    place = {r.name: k for k, r in enumerate(rules)}
    return sum(1 << place[n] for n in set(names))


#: Versions of the policy, oldest first: masks of the rules that reject.
POLICIES = {
    "v1": mask_of("few_words", "repeated_windows"),
    "v2": mask_of("few_words", "repeated_windows", "symbols", "long_words", "short_words", "repeated_lines"),
    "v3": mask_of(*(r.name for r in RULES)),
}

_SYMBOL, _UPPER, _DIGIT, _LETTER = (np.zeros(256, bool) for _ in range(4))
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER[ord("A"):ord("Z") + 1] = True
_DIGIT[ord("0"):ord("9") + 1] = True
_LETTER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1] = True
_LETTER[128:] = True  # any character beyond ASCII counts as a letter


def _per_row(flag: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of true values in each row [off[i], off[i+1])."""
    out = np.zeros(len(off) - 1, np.int64)
    full = off[1:] > off[:-1]
    if full.any():
        out[full] = np.add.reduceat(flag.view(np.uint8), off[:-1][full], dtype=np.int64)
    return out


def repeated_words(h: np.ndarray, row: np.ndarray, rows: int, window: int = WINDOW) -> np.ndarray:
    """Words of each row that lie in a window of ``window`` words found at least twice in the row."""
    n = len(h) - window + 1
    if n < 2:
        return np.zeros(rows, np.int64)
    key = np.zeros(n, np.uint64)
    for k in range(window):
        key = mix(key + h[k:n + k])
    own = row[:n]
    whole = np.flatnonzero(own == row[window - 1:])
    # Rows are apart in the key too, so that one sort finds equal windows of one row.
    key = mix(key[whole] + own[whole].astype(np.uint64))
    order = np.argsort(key)
    at, key = whole[order], key[order]
    same = (key[1:] == key[:-1]) & (own[at[1:]] == own[at[:-1]])
    twice = np.zeros(len(at), bool)
    twice[1:] |= same
    twice[:-1] |= same
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + window, -1)
    return np.bincount(row[np.cumsum(cover[:-1]) > 0], minlength=rows)


def _line_counts(text: bytes) -> tuple[int, int, int]:
    """Lines with a word, those equal to an earlier one, those that end in an ellipsis."""
    seen: set[bytes] = set()
    lines = again = dots = 0
    for line in text.split(b"\n"):
        if end := line.rstrip():
            lines += 1
            again += line in seen
            dots += end.endswith((b"...", "…".encode()))
            seen.add(line)
    return lines, again, dots


def measure(p: pa.RecordBatch) -> dict[str, np.ndarray]:
    """``MEASURES`` of a batch of texts."""
    buf, off = utf8(p.column("text"))
    n = p.num_rows
    mark = ~SPACE[buf]
    start, end = runs(mark, off)
    row = np.searchsorted(off, start, "right") - 1
    starts_letter = np.zeros(len(start), bool)
    if len(start):
        # reduceat reads up to the next word's start: what lies between is white space.
        starts_letter = np.add.reduceat(_LETTER[buf].view(np.uint8), start, dtype=np.int64) > 0
    raw = buf.tobytes()
    lines = np.array([_line_counts(raw[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], np.int64).reshape(n, 3)
    return {
        "n_words": np.bincount(row, minlength=n),
        "word_chars": _per_row(mark & ((buf & 0xC0) != 0x80), off),
        "n_symbols": _per_row(_SYMBOL[buf], off),
        "n_dup_lines": lines[:, 1],
        "n_repeat_words": repeated_words(word_hashes(buf, start, end), row, n),
        "n_lines": lines[:, 0],
        "n_ellipsis_lines": lines[:, 2],
        "n_upper": _per_row(_UPPER[buf], off),
        "n_digits": _per_row(_DIGIT[buf], off),
        "n_letter_words": np.bincount(row[starts_letter], minlength=n),
    }


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, measurements..., failed): the bits of the rules that each document fails."""
    if len(rules) > 63:
        raise ValueError("a ledger has 63 rules at most")
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in pieces(batches):
            got = measure(p)
            yield pa.RecordBatch.from_arrays([p.column(0), *[pa.array(got[k], pa.int64()) for k in MEASURES]], ["id", *MEASURES])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = texts_of(docs, F.col(id_col).alias("id"), text_col=text_col).mapInArrow(run, f"id {kind}, " + ", ".join(f"{k} long" for k in MEASURES))
    bits = [F.when(F.expr(r.fails), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, r in enumerate(rules)]
    return rows.select(F.col("id").alias(id_col), *MEASURES, reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0).cast("long")).alias("failed"))


def _caught(mask) -> F.Column:
    return F.col("failed").bitwiseAND(F.lit(mask) if isinstance(mask, int) else mask)


def apply_policies(rows: DataFrame, policies: Mapping[str, int] = POLICIES) -> DataFrame:
    """The ledger with ``kept_by`` (names of the policies that keep the document, in order)
    and ``caught`` (the bits that the last policy rejects it for)."""
    last = list(policies.values())[-1]
    verdicts = F.filter(F.array(*[F.when(_caught(m) == 0, F.lit(name)) for name, m in policies.items()]), lambda x: x.isNotNull())
    return rows.withColumns({"kept_by": verdicts, "caught": _caught(last)})


def ablations(rows: DataFrame, policies: Mapping[str, int] = POLICIES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(policy, rule, bit, n_docs, n_kept, n_failed, n_alone, with_rules) for each rule of each policy.

    ``n_alone`` documents fail this rule and no other of the policy, so without it
    ``n_kept + n_alone`` would be kept; ``with_rules`` are the bits of the policy that
    documents failing this rule fail as well.
    """
    spark = rows.sparkSession
    pairs = [(name, mask, r.name, 1 << k) for name, mask in policies.items() for k, r in enumerate(rules) if mask >> k & 1]
    wanted = spark.createDataFrame(pairs, "policy string, mask long, rule string, bit long")
    seen = rows.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))  # 2 ** rules rows at most
    n, hit = F.col("n"), _caught(F.col("bit")) != 0
    total = lambda when: F.coalesce(F.sum(F.when(when, n)), F.lit(0)).alias
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(m).cast("long").alias("mask"), F.lit(b).cast("long").alias("bit"))
                               for p, m, _, b in pairs]))
    counts = (seen.select("failed", "n", each.alias("e")).select("failed", "n", "e.*").groupBy("policy", "bit").agg(
        F.sum("n").alias("n_docs"), total(_caught(F.col("mask")) == 0)("n_kept"), total(hit)("n_failed"),
        total(_caught(F.col("mask")) == F.col("bit"))("n_alone"),
        F.coalesce(F.bit_or(F.when(hit, _caught(F.col("mask")))), F.lit(0)).alias("with_rules")))
    return F.broadcast(wanted).join(counts, ["policy", "bit"], "left").select(
        "policy", "rule", "bit", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_docs", "n_kept", "n_failed", "n_alone", "with_rules")])
