"""Hard negatives, rule ledger and prefix trie against brute force, and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_cases import docs_of, odd_rows, prose
from wardline.llm import ledger, negatives, trie
from wardline.llm.queries import op11_hard_negatives, op12_rule_ledger, op13_prefix_trie


def as_table(df, folder, name):
    df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


# -- 11 hard negatives
@settings(max_examples=60, deadline=None)
@given(st.integers(0, 700), st.integers(1, 6), st.sampled_from([3, 255, 4095, 10**6, 2**30]), st.integers(0, 2**32))
def test_scores_are_exact(width, rows, top, seed):
    rng = np.random.default_rng(seed)
    a, b = (rng.integers(-top, top + 1, (rows, width)) for _ in range(2))
    a[0] = top  # the largest products there are
    bound = max(int((x.astype(object) ** 2).sum(1).max()) if width else 0 for x in (a, b))
    if bound >= 2**62:
        return
    want = (a.astype(object) @ b.T.astype(object)).astype(np.int64) if width else np.zeros((rows, rows), np.int64)
    assert (negatives.scores(a, b, negatives.primes_for(bound)) == want).all()


def test_primes_cover_the_bound():
    assert len(negatives.primes_for(70_000)) == 3 and len(negatives.primes_for(0)) == 1
    assert math.prod(negatives.primes_for(2**62 - 1)) > 2**64
    with pytest.raises(ValueError):
        negatives.primes_for(2**70)
    assert max(negatives.PRIMES) < 512 and negatives.CHUNK * (max(negatives.PRIMES) // 2) ** 2 < 2**24


def brute_negatives(rows, positives=5, negatives_=3, low=50, high=95):
    ok = []
    for k, (i, v, lab) in enumerate(rows):
        if lab is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * x) for x in v]
        if sum(x * x for x in q) < 2**62:
            ok.append((k, i, q, (lab + 1) % 10 if i is not None and i % 7 == 0 else lab))
    order = lambda p: (-p[0], p[1] is None, p[1] or 0)
    out = Counter()
    for k, i, q, lab in ok:
        if i is None or i % 50:
            continue
        met = [(sum(x * y for x, y in zip(q, r, strict=True)), j, other) for m, j, r, other in ok if m != k and len(r) == len(q)]
        for s, pid, _ in sorted((m for m in met if m[2] == lab), key=order)[:positives]:
            hard = sorted((m for m in met if m[2] != lab and low * s <= 100 * m[0] <= high * s), key=order)[:negatives_]
            out.update((i, pid, n + 1, m[1], s, m[0]) for n, m in enumerate(hard))
    return out


def vectors(n, seed):
    r = random.Random(seed)
    base = [[r.gauss(0, 0.2) for _ in range(6)] for _ in range(4)]
    rows = [(k, [x + r.gauss(0, 0.1) for x in base[k % 4]], r.randrange(4)) for k in range(n)]
    rows += [(None, base[0], 1), (0, base[1], 2), (0, base[1], 2), (50, base[2], 2), (100, base[2], None), (150, None, 1), (200, [0.0, None], 1),
             (250, [math.nan, 1.0], 1), (300, [math.inf, 1.0], 1), (350, [1.0, 2.0], 1), (351, [1.0, 2.0], 1), (352, [0.7, 1.4], 3),
             (400, [], 1), (401, [], 1), (402, [], 5), (450, [1e300] * 6, 1), (-50, base[3], 1), (500, [0.0] * 6, 3)]
    return rows + rows[5:9]  # repeated rows


def test_hard_negatives_equal_brute_force(spark, tmp_path):
    rows = vectors(260, 1)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns(
        {c: F.lit("x") for c in ("uid", "id", "anchor", "score", "place", "q")})
    want = brute_negatives(rows)
    assert len(want) > 50
    got = op11_hard_negatives(spark, as_table(df, tmp_path, "embeddings"))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(map(tuple, got.collect())) == want
    shifted = df.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    many = negatives.hard_negatives(shifted, F.col("vec_id") % 50 == 0, block=3, part_rows=40)  # many cells
    assert Counter(map(tuple, many.collect())) == want


def test_hard_negatives_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert op11_hard_negatives(spark, as_table(none, tmp_path, "embeddings")).count() == 0
    lone = spark.createDataFrame([(7, [1.0], 1), (8, [1.0], 2)], "vec_id long, embedding array<float>, label int")
    assert negatives.hard_negatives(lone, F.col("vec_id") % 50 == 0).count() == 0


# -- 12 rule ledger
def brute_measures(text):
    t = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", t)
    windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    twice = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if twice[w] > 1 for j in range(8)}
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in t),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
            "n_ellipsis_lines": sum(bool(re.search("(\\.\\.\\.|…)[\x20\x09-\x0d]*$", x)) for x in lines),
            "n_upper": len(re.findall("[A-Z]", t)), "n_digits": len(re.findall("[0-9]", t)),
            "n_letter_words": sum(bool(re.search("[A-Za-z]|[^\x00-\x7f]", w)) for w in words)}


def brute_failed(m):
    return sum(1 << k for k, r in enumerate(ledger.RULES) if eval(r.fails, {}, m))


def ledger_texts():
    eight = " ".join(f"w{k}" for k in range(8))
    return [eight + " " + eight, eight + " x " + eight, "a " * 9, "a " * 8, ("one two " * 40), "a\x0bb\x0cc\x1cd\x85e f　g", "x\r\ny\r\nx\r\nx",
            "# * $ % & | < >", "Wait...\nand… \nthen.", "SHOUT " * 30, "1234 " * 30, "| a | b | c |" * 9, "Thue" + "ab" * 5000, prose(5, 3000) + " \n" + prose(5, 3000)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \n\t\x0b\x1c.é…#1A"), max_size=80), max_size=6))
def test_measures_equal_brute_force(texts):
    import pyarrow as pa
    got = ledger.measure(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"]))
    for k, t in enumerate(texts):
        assert {m: int(got[m][k]) for m in ledger.MEASURES} == brute_measures(t), t


def test_ledger_equals_brute_force(spark, tmp_path):
    rows = odd_rows() + [(100 + k, t) for k, t in enumerate(ledger_texts() * 2)]
    df = docs_of(spark, rows).withColumns({c: F.lit("x") for c in ("id", "failed", "n_words", "n_lines", "caught", "kept", "bit")})
    got = op12_rule_ledger(spark, as_table(df, tmp_path, "documents")).collect()
    want, alone = [], Counter()
    last = ledger.POLICIES["v3"]
    for r in rows:
        m = brute_measures(r[1])
        failed = brute_failed(m)
        caught = failed & last
        only = next((x.name for k, x in enumerate(ledger.RULES) if caught == 1 << k), None)
        alone[only] += 1
        want.append((r[0], m["n_words"], m["word_chars"], m["n_symbols"], m["n_dup_lines"], m["n_repeat_words"],
                     m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"], caught == 0, failed,
                     ",".join(p for p, x in ledger.POLICIES.items() if not failed & x), only))
    assert Counter(tuple(r)[:-1] for r in got) == Counter(want)
    assert all(r.only_rule_docs == (alone[r.only_rule] if r.only_rule else None) for r in got)
    assert all(r.kept <= (not r.base_failed) for r in got)


def test_ablations_equal_brute_force(spark):
    df = docs_of(spark, [(k, t) for k, t in enumerate(ledger_texts() + [prose(3, 50), prose(4, 60)])])
    rows = ledger.ledger(df)
    bits = [r.failed for r in rows.collect()]
    got = {(r.policy, r.rule): r for r in ledger.ablations(rows).collect()}
    assert len(got) == sum(m.bit_count() for m in ledger.POLICIES.values())
    for (policy, _), r in got.items():
        mask = ledger.POLICIES[policy]
        hit = [b & mask for b in bits if b & r.bit]
        union = 0
        for b in hit:
            union |= b
        assert (r.n_docs, r.n_kept, r.n_failed, r.with_rules) == (len(bits), sum(not b & mask for b in bits), len(hit), union)
        # Without the rule, so many documents more are kept.
        assert r.n_alone == sum(not b & mask & ~r.bit for b in bits) - r.n_kept


def test_ledger_of_nothing(spark, tmp_path):
    none = docs_of(spark, []).limit(0)
    assert op12_rule_ledger(spark, as_table(none, tmp_path, "documents")).count() == 0
    empty = ledger.ablations(ledger.ledger(none)).collect()
    assert empty and all(r.n_docs == r.n_kept == r.n_failed == r.n_alone == r.with_rules == 0 for r in empty)
    assert [r.name for r in ledger.RULES][:2] == ["few_words", "repeated_windows"]  # bits must not move


# -- 13 prefix trie
@given(st.lists(st.integers(-1, 6), min_size=1, max_size=40), st.data())
def test_range_minimum_equals_scan(values, data):
    table = trie.RangeMinimum(np.array(values))
    at = data.draw(st.integers(0, len(values)))
    least = data.draw(st.integers(-2, 7))
    right = next((k for k in range(at, len(values)) if values[k] < least), len(values))
    assert table.right(np.array([at]), np.array([least]))[0] == right
    if at < len(values):
        left = next((k for k in range(at, -1, -1) if values[k] < least), -1)
        assert table.left(np.array([at]), np.array([least]))[0] == left
        assert table.least(np.array([at]), np.array([len(values)]))[0] == min(values[at:])


def brute_trie(seqs):
    """seqs: {conv_id: [(role, text), ...]}"""
    members = defaultdict(list)
    for c in sorted(seqs):
        for d in range(len(seqs[c]) + 1):
            members[tuple(seqs[c][:d])].append(c)
    children, out = defaultdict(list), []
    for p in members:
        if p:
            children[p[:-1]].append(p)
    total = {}
    for p in sorted(members, key=len, reverse=True):
        kids = children[p]
        saved = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        total[p] = (sum(total[k][0] for k in kids) or 1, saved + sum(total[k][1] for k in kids))
        ends = ",".join(str(c) for c in members[p] if len(seqs[c]) == len(p))
        out.append((members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(kids), *total[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def brute_rebuilt(turns):
    own = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            pair = (role or "", text or "")
            digest = hashlib.sha256(f"{len(pair[0].encode())}:{pair[0]}{pair[1]}".encode()).hexdigest()[:32]
            own[c].append(((turn is not None, turn or 0), digest, pair))
    own = {c: [x[2] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        base = c - int(math.fmod(c, 100))
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(base, [])[:h] + v[h:]
    return out


def conversations(seed):
    r = random.Random(seed)
    rows = []
    for c in [*range(0, 60), *range(100, 180), 350, 351, -5, -150, -200]:
        rows += [(c, t, r.choice(["user", "assistant"]), r.choice(["hi", "yes", "no", "ünï 😀", ""])) for t in range(r.randrange(1, 9))]
    rows += [(201, 1, "user", "x" * 200_000), (201, None, None, None), (201, 1, "user", "x"), (201, 1, "user", "x"), (None, 1, "user", "lost")]
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1040) for t in range(7)]  # copies
    rows += [(2000 + k, t, "user", f"long {t}") for k in range(3) for t in range(150 + k)]
    r.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def test_trie_equals_brute_force(spark, tmp_path):
    rows = conversations(1)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("depth", "digest", "chars", "seq", "block", "_h")})
    want = brute_trie(brute_rebuilt(rows))
    got = op13_prefix_trie(spark, as_table(df, tmp_path, "conversations"))
    assert tuple(got.columns) == trie.NODE
    assert Counter(map(tuple, got.collect())) == want


@pytest.mark.parametrize("block_rows, ids_a_row", [(1, 1), (3, 2), (16, 4), (10_000, 4096)])
def test_trie_is_the_same_whatever_the_blocks(spark, monkeypatch, block_rows, ids_a_row):
    rows = [x for x in conversations(2) if x[0] is not None]
    rows += [(c, 0, "user", "hi") for c in range(5000, 5030)] + [(c, 0, "user", "hi") for c in range(6000, 6009)] + [(c, 1, "user", "yes") for c in range(6000, 6009)]
    convs = trie.ordered_turns(spark.createDataFrame(rows, SCHEMA))
    # Turnless conversations are members of the root.
    convs = convs.withColumn("turns", F.when(F.col("conv_id").between(1000, 1010), F.slice("turns", 1, 0)).otherwise(F.col("turns")))
    seqs = defaultdict(list)
    for c, turn, role, text in rows:
        digest = hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()[:32]
        seqs[c].append(((turn is not None, turn or 0), digest, (role or "", text or "")))
    seqs = {c: [] if 1000 <= c <= 1010 else [x[2] for x in sorted(v, key=lambda x: x[:2])] for c, v in seqs.items()}
    got = trie.prefix_trie(convs, block_rows=block_rows, most_blocks=64, ids_a_row=ids_a_row)
    assert Counter(map(tuple, got.collect())) == brute_trie(seqs)


def test_trie_of_little(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    assert op13_prefix_trie(spark, as_table(none, tmp_path / "none", "conversations")).count() == 0
    # Its head is absent and it has no turn beyond the head's: only the root is left.
    assert zlib.crc32(b"707") % 6 > 1
    lone = spark.createDataFrame([(707, 0, "user", "hi")], SCHEMA)
    rows = op13_prefix_trie(spark, as_table(lone, tmp_path / "lone", "conversations")).collect()
    assert [tuple(r) for r in rows] == [(707, 0, None, 1, 0, 1, 0, hashlib.sha256(b"707").hexdigest())]
