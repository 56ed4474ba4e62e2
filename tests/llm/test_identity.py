"""Rows and texts that are easily taken for one another: hash collisions, repeated and null ids."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import docs_of, odd_rows, prose
from wardline.llm import lines, metric_join, minhash, mixing, spotsigs, suffix
from wardline.llm.common import with_uid
from wardline.llm.hashing import prefix, spans, strong_prefix, strong_spans, word_hashes


def morse(n, letters="ab"):
    return "".join(letters[bin(k).count("1") % 2] for k in range(n))


PAIR = morse(1024), morse(1024, "ba")  # their running sums modulo 2^64 agree in every base


def test_the_pair_collides_where_it_may_and_only_there():
    a, b = (np.frombuffer(x.encode(), np.uint8) for x in PAIR)
    ends = np.array([0]), np.array([1024])
    assert spans(prefix(a), *ends)[0] == spans(prefix(b), *ends)[0]
    for family in range(4):
        assert strong_spans(strong_prefix(a, family), *ends)[0] != strong_spans(strong_prefix(b, family), *ends)[0]
        assert word_hashes(a, *ends, family)[0] != word_hashes(b, *ends, family)[0]


def test_strong_spans_are_polynomials():
    from wardline.llm import hashing as H
    buf = np.random.default_rng(1).integers(0, 256, 3000).astype(np.uint8)
    buf[2000:2300] = buf[100:400]
    pre = strong_prefix(buf, 1)
    at = np.arange(100, 300)
    assert (strong_spans(pre, at, at + 100) == strong_spans(pre, at + 1900, at + 2000)).all()
    p = 2**31 - 1
    part = [sum(int(H._bases[k].chars[c]) * pow(H._bases[k].base, i, p) for i, c in enumerate(buf[77:500])) % p for k in (2, 3)]
    want = H.mix(np.array([part[0] << 31 | part[1]], np.uint64))[0]
    assert strong_spans(pre, np.array([77]), np.array([500]))[0] == want


def test_line_dedup_keeps_distinct_long_lines(spark):
    df = docs_of(spark, [(1, PAIR[0]), (2, PAIR[1]), (3, PAIR[0])])
    got = {r.doc_id: (r.text, r.n_removed) for r in lines.dedup_lines(df).collect()}
    assert got == {1: (PAIR[0], 0), 2: (PAIR[1], 0), 3: ("", 1)}


def test_near_duplicates_keep_distinct_long_words(spark):
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs_of(spark, [(1, PAIR[0]), (2, PAIR[1]), (3, PAIR[0])])).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_fingerprints_of_distinct_long_words(spark):
    df = docs_of(spark, [(k, f"the {w} walks on and the {w} sleeps") for k, w in enumerate(PAIR)])
    prints = {r.fingerprint for r in spotsigs.fingerprints(df).collect()}
    assert len(prints) == 2


def test_suffix_dedup_of_long_spans(spark):
    a, b = morse(2048), morse(2048, "ba")
    tail = prose(1, 500)
    df = docs_of(spark, [(1, tail[:700] + a + tail[700:1500]), (2, tail[1500:2200] + b + tail[2200:3000])])
    got = {r.doc_id: len(r.spans) for r in suffix.remove_repeats(df, 2048).collect()}
    assert got == {1: 0, 2: 0}


# -- ids
def test_ids_that_are_no_numbers_get_numbers(spark):
    df = spark.createDataFrame([("1", "a"), ("01", "b"), ("x", "c")], "doc_id string, text string")
    assert len({r.uid for r in with_uid(df).collect()}) == 3
    got = lines.dedup_lines(spark.createDataFrame([("1", "a b"), ("01", "c d"), ("x", "a b")], "doc_id string, text string")).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got if r.doc_id == "01") == [("01", 0)] and sum(r.n_removed for r in got) == 1


def brute_components(rows, threshold=0.9):
    unit = []
    for _, v in rows:
        ok = v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None)
    link = [[a is not None and b is not None and i != j and len(a) == len(b) and float(a @ b) >= threshold for j, b in enumerate(unit)]
            for i, a in enumerate(unit)]
    out = []
    for k in range(len(rows)):
        seen, todo = {k}, [k]
        while todo:
            x = todo.pop()
            new = {j for j in range(len(rows)) if link[x][j]} - seen
            seen |= new
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        low = min(ids, default=None)
        out.append((rows[k][0], sum(link[k]), low, rows[k][0] == low))
    return Counter(out)


@pytest.mark.parametrize("ids", ["unique", "repeated", "null"])
def test_components_of_repeated_and_null_ids(spark, ids):
    r = np.random.default_rng(4)
    base = r.normal(size=(8, 5))
    rows = [(k + 10, (base[k % 8] + r.normal(scale=0.18, size=5)).tolist()) for k in range(60)]
    rows += [(200, None), (201, []), (202, [0.0] * 5), (203, [None, 1.0]), (204, [math.nan, 1.0]), (205, [1.0, 2.0]), (206, rows[3][1])]
    if ids != "unique":
        rows += [(20, rows[0][1]), (20, rows[7][1]), (10, None), (rows[5][0], rows[5][1]), (300, [9.0, 1.0]), (300, [-9.0, 1.0])]
    if ids == "null":
        rows += [(None, rows[2][1]), (None, [3.0, -4.0, 5.0]), (None, [3.0, -4.0, 5.0]), (None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("id", "uid", "unit", "class", "v")})
    got = metric_join.near_vectors(df, block=16).select("vec_id", "n_links", "component_id", "kept").collect()
    assert Counter(map(tuple, got)) == brute_components(rows)


def test_a_column_named_uid_is_no_identity_of_a_mix(spark):
    rows = [(k, prose(k, 10)) for k in range(12)]
    df = docs_of(spark, rows).withColumn("uid", F.lit("same"))
    got = mixing.mix(df, [F.col("lang")], {}, budget=60)
    assert sorted(r.uid for r in got.collect()) == sorted(r.doc_id for r in got.collect()) and got.count() == 6
    odd = docs_of(spark, odd_rows()).withColumn("uid", F.lit(None).cast("long"))
    assert mixing.mix(odd, [F.col("lang")], {}, budget_share=1.0).count() == len(odd_rows())
