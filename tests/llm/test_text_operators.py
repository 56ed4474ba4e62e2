"""Each operator against a brute-force version, and on odd rows."""

import hashlib
from collections import Counter
from math import ceil

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_cases import SCHEMA, docs_of, odd_rows, prose
from wardline.llm import bpe, licenses, lines, metric_join, minhash, mixing, packing, quality, spotsigs, suffix
from wardline.llm.components import components
from wardline.llm.queries import PATTERN, RANKS


@pytest.fixture(scope="module")
def odd(spark):
    return docs_of(spark, odd_rows())


@pytest.fixture(scope="module")
def none(spark):
    return docs_of(spark, []).limit(0)


def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


# -- 1 packing
@given(st.lists(st.integers(1, 20), max_size=40))
def test_best_fit_equals_search_of_all_rows(lengths):
    rows, room = [], []
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        fits = [(room[r], r) for r in range(len(rows)) if room[r] >= lengths[k]]
        if fits:
            r = min(fits)[1]
        else:
            rows.append([]), room.append(20)
            r = len(rows) - 1
        rows[r].append(lengths[k])
        room[r] -= lengths[k]
    got = packing.best_fit(lengths, 20)
    assert sorted(k for r in got for k in r) == list(range(len(lengths)))
    assert sorted(20 - sum(lengths[k] for k in r) for r in got) == sorted(room)


def test_packed_rows_hold_every_token(spark, odd, none):
    tok, got = library(), {}
    for r in packing.pack(odd, RANKS, PATTERN, size=64, shard_bytes=4096).collect():
        ids = np.frombuffer(r.tokens, "<u2")
        assert len(ids) == 64 and r.cu_seqlens[-1] == r.n_tokens
        assert r.resets == r.cu_seqlens[:-1] + ([r.n_tokens] if r.n_tokens < 64 else [])
        assert set(ids[r.n_tokens:].tolist()) <= {50256}
        for k, u in enumerate(r.uids):
            got.setdefault((u, r.doc_ids[k]), {})[r.starts[k]] = ids[r.cu_seqlens[k]:r.cu_seqlens[k + 1]].tolist()
    texts = sorted(([x for _, p in sorted(v.items()) for x in p], str(k[1])) for k, v in got.items())
    assert texts == sorted((tok.encode_ordinary(r[1]), str(r[0])) for r in odd_rows() if r[1])
    assert packing.pack(none, RANKS, PATTERN).count() == 0


# -- 2 BPE
@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks(RANKS), PATTERN)


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from("aeinorst '.\n\t\x1c\x85\u3000\u00e9\u6f22\U0001f6000123"), st.characters(exclude_categories=("Cs",))), max_size=60))
def test_ids_equal_the_library(encoder, text):
    got = np.frombuffer(encoder(text, all(c <= "\uffff" for c in text)), np.int32).tolist()
    assert got == library_cached.encode_ordinary(text)


library_cached = library()


def test_long_pieces_and_round_trip(spark, odd, none, encoder):
    for text in ("a" * 3000, "thth" * 500, "!?" * 700, " " * 999 + "x"):
        assert np.frombuffer(encoder(text, True), np.int32).tolist() == library_cached.encode_ordinary(text)
    rows = bpe.decode(bpe.encode(odd, RANKS, PATTERN, ("doc_id", "key")), RANKS).collect()
    assert sorted(bytes(r.decoded) for r in rows) == sorted((r[1] or "").encode() for r in odd_rows())
    out = bpe.digests(bpe.encode(odd, RANKS, PATTERN, decoded=True), "doc_id").where("doc_id = 5").first()
    ids = library_cached.encode_ordinary(prose(2, 80))
    assert (out.n_tokens, out.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    assert bpe.encode(none, RANKS, PATTERN, decoded=True).count() == 0


# -- 3 repeated strings
def brute_removed(texts, length):
    starts = Counter(t[p:p + length] for t in texts for p in range(len(t) - length + 1))
    kept = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if starts[t[p:p + length]] > 1:
                gone[p:p + length] = True
        kept.append((np.frombuffer(t, np.uint8)[~gone].tobytes(), int(np.diff(np.append(0, gone.astype(int))).clip(0).sum())))
    return kept


def test_repeats_equal_brute_force(spark, odd, none):
    shared = prose(50, 60)
    texts = [r[1] for r in odd_rows()] + [prose(k, 30) + shared[k:] + prose(100 + k, 20) for k in range(8)]
    texts += ["ab" * 300, "x" * 199, "x" * 200, "y" * 201, shared[:230] + "|" + shared[:230], prose(77, 100) + shared[:199]]
    df = docs_of(spark, list(enumerate(texts)))
    for length in (200, 31):
        got = {r.doc_id: (bytes(r.kept), len(r.spans) // 2) for r in suffix.remove_repeats(df, length).collect()}
        assert [got[k] for k in range(len(texts))] == brute_removed([(t or "").encode() for t in texts], length)
    assert suffix.remove_repeats(odd).count() == len(odd_rows())
    assert suffix.remove_repeats(none).count() == 0


# -- 4 licenses
def test_licenses(spark, odd, none):
    long = prose(3, 4000) + " Licensed under the Apache License, Version 2.0. " + prose(4, 4000)
    rows = [(1, "Title\nLicensed under CC BY-NC 4.0.\nmore"), (2, "licensed under CC BY 4.0"), (3, "He lost his driving licence in " + prose(1, 9)),
            (4, "This work is licenced under the GNU General Public License, version 3."), (5, long), (6, "All rights reserved.")]
    got = {r.doc_id: [(m.line, m.license, m.differences) for m in r.matches] for r in licenses.scan(docs_of(spark, rows)).collect()}
    assert got == {1: [(1, "CC-BY-NC-4.0", 0)], 2: [(0, "CC-BY-4.0", 0)], 3: [], 4: [(0, "GPL-3.0", 1)], 5: [(0, "Apache-2.0", 0)],
                   6: [(0, "all-rights-reserved", 0)]}
    assert licenses.scan(odd).count() == len(odd_rows()) and licenses.scan(none).count() == 0


def best_license():
    match = licenses.Matcher(licenses.TEMPLATES)
    return lambda text: min((m[1:3] for m in match(licenses.wording(text))), key=lambda m: m[1])


def test_license_at_the_end_of_a_line_of_any_length():
    text = ("The town council met on Tuesday evening to discuss the new bridge over the river, whose costs have risen since spring; "
            "several members asked why nobody had foreseen the price of steel, and the mayor promised figures before the next session. ") * 10
    match = best_license()
    for n in (0, 40, 100, 120, 200, 320, 350, 430, 600, 1000, 2000):
        for name, notices in licenses.TEMPLATES.items():
            for notice in notices:
                assert match(f"{text[:n]} {notice}") == (name, 0) == match(f"{text[:n]} {notice.upper()} {text[n:]}")


@given(st.data())
def test_license_reduction_loses_no_confirmed_wording(data):
    match = licenses.Matcher(licenses.TEMPLATES)
    k = data.draw(st.integers(0, len(match.templates) - 1))
    _, wanted, most, *_ = match.templates[k]
    words = list(wanted)
    for _ in range(data.draw(st.integers(0, most))):
        # Words that set licenses apart stay: without them nothing is confirmed.
        free = [i for i, w in enumerate(words) if not licenses.marks(words[i:i + 2]) | licenses.marks(words[max(0, i - 1):i + 1])] or [None]
        at, kind = data.draw(st.sampled_from(free)), data.draw(st.integers(0, 2))
        if at is None:
            break
        words[at:at + (kind > 0)] = [data.draw(st.sampled_from(["any", "the", "foo"]))] * (kind < 2)
    around = [prose(data.draw(st.integers(0, 99)), data.draw(st.integers(0, 60))) for _ in range(2)]
    assert best_license()(" ".join([around[0], *words, around[1]]))[1] <= most


def named_together(notices):
    """What the notices are called in one paragraph: the grant of the BSD licenses is that of the one with the further clause."""
    return ["BSD-3-Clause" if t in licenses.BEGINS else name for name, t in notices]


@pytest.mark.parametrize("text, want", [
    ("under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License", []),
    *[(licenses._FREE.format(work="program", license=f"GNU {kind}General Public License", version=v), [name]) for name, kind, v in (
        ("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-3.0", "Lesser ", "3"), ("LGPL-2.1", "Lesser ", "2.1"), ("AGPL-3.0", "Affero ", "3"))],
    (licenses._FREE.format(work="library", license="GNU General Public License", version="2"), ["GPL-2.0"]),
    (licenses._FREE.format(work="library", license="GNU Library General Public License", version="2"), []),
    (licenses._FREE.format(work="program", license="GNU General Public License", version="4"), []),
    ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0"]),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", ["LGPL-3.0"]),
    ("This work is not licensed under the GNU General Public License, version 3.", []),
    ("It was never released under the MIT License.", []),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", ["BSD-2-Clause"]),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: and so on. "
     + licenses.TEMPLATES["BSD-3-Clause"][-1], ["BSD-3-Clause", "BSD-3-Clause"]),
    ("Licensed under CC BY 3.0.", ["CC-BY-3.0"]), ("Licensed under CC BY 2.5.", []), ("Licensed under CC BY-NC-SA 4.0.", ["CC-BY-NC-SA-4.0"]),
    ("Licensed under CC BY-SA 4.0.", ["CC-BY-SA-4.0"]),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", ["CC-BY-NC-SA-4.0"]),
    ("This work is licensed under a Creative Commons Attribution 3.0 International License.", ["CC-BY-3.0"]),
    ("Distributed under the MIT License", ["MIT"]), ("MIT License", ["MIT"]), ("SPDX-License-Identifier: MIT", ["MIT"]), ("ISC License", ["ISC"]),
    ("Apache License 2.0", ["Apache-2.0"]), ("Apache License, Version 1.1", []), ("SPDX-License-Identifier: GPL-2.0-or-later", ["GPL-2.0"]),
    ("SPDX-License-Identifier: LGPL-2.1-only", ["LGPL-2.1"]), ("SPDX-License-Identifier: GPL-4.0", []),
])
def test_licenses_that_are_easily_confused(text, want):
    match = licenses.Matcher(licenses.TEMPLATES)
    around = prose(1, 12)
    for whole in (text, f"{around} {text}", f"{around} {text} {around}"):
        assert [m[1] for m in match(licenses.wording(whole))] == want


@settings(max_examples=40, deadline=None)
@given(st.data())
def test_licenses_equal_every_template_against_every_window(data):
    notices = [t for ts in licenses.TEMPLATES.values() for t in ts]
    words = []
    for _ in range(data.draw(st.integers(1, 2))):
        part = licenses.wording(data.draw(st.sampled_from(notices)))
        for _ in range(data.draw(st.integers(0, 2))):
            at = data.draw(st.integers(0, len(part) - 1))
            part[at:at + data.draw(st.integers(0, 1))] = [data.draw(st.sampled_from(["any", "not", "3", "lesser", "2.0", "foo"]))]
        words += part + prose(data.draw(st.integers(0, 9)), 3).split()
    match = licenses.Matcher(licenses.TEMPLATES)
    best = []
    for k, (name, wanted, most, *_) in enumerate(match.templates):
        for a in range(len(words)):
            for z in range(max(a + 1, a + len(wanted) - most), min(len(words), a + len(wanted) + most) + 1):
                found = licenses.differences(wanted, words[a:z])
                if found <= most and match._fits(k, words, a, z):
                    best.append((found, a, z, name))
    got = match(words)
    # Every license found is one of the windows', and every exact window is covered by what was found.
    assert all(any(a <= start < z and found >= f for f, a, z, _ in best) for start, _, found, _ in got)
    for f, a, z, _ in best:
        if f == 0:
            assert any(a - 40 <= start < z for start, *_ in got)


def test_every_license_of_a_line(spark):
    notices = [(name, t) for name, ts in licenses.TEMPLATES.items() for t in ts]
    two = "Licensed under the MIT License. Licensed under the Apache License, Version 2.0. All rights reserved."
    all_ = " ".join(f"{t} {prose(k, k)}" for k, (_, t) in enumerate(notices))
    rows = [(1, two), (2, all_), (3, "All rights reserved. " * 30), (4, f"Title\n{two}\n{two}")]
    got = {r.doc_id: [(m.line, m.word, m.license) for m in r.matches] for r in licenses.scan(docs_of(spark, rows)).collect()}
    first = [(0, "MIT"), (5, "Apache-2.0"), (12, "all-rights-reserved")]
    assert got[1] == [(0, *m) for m in first]
    assert [m[2] for m in got[2]] == named_together(notices)
    assert got[3] == [(0, 3 * k, "all-rights-reserved") for k in range(30)]
    assert got[4] == [(line, *m) for line in (1, 2) for m in first]


def test_wrapped_licenses(spark):
    import textwrap

    notices = [(name, t) for name, ts in licenses.TEMPLATES.items() for t in ts]
    marks = ("", "# ", "// ", " * ", "dnl ", "REM ", "C ", "> ", "; ", "-- ")
    rows, wanted = [], {}
    for k, (name, t) in enumerate(notices):
        for j, mark in enumerate(marks):
            for i, width in enumerate((12, 30, 72, 80)):
                text = "\n".join(mark + x for x in textwrap.wrap(t, width, break_long_words=False, break_on_hyphens=True))
                above = "\n".join(mark + x for x in textwrap.wrap(prose(k, 30), width)) + ("\n" if i % 2 else "\n\n")
                key = len(rows)
                rows.append((key, f"{above}{text}\n{mark}{prose(j, 3)}"))
                wanted[key] = [(above.count("\n"), name, 0)]
    rows.append((-1, "All rights\n\nreserved.\n\nAll rights\nreserved.\n\nLi-\ncensed un-\nder CC BY-\nSA 4.0"))
    wanted[-1] = [(4, "all-rights-reserved", 0), (7, "CC-BY-SA-4.0", 0)]
    rows.append((-2, "\r\n".join(f"{m}{t}" for t in textwrap.wrap(" ".join(t for _, t in notices), 75) for m in ("# ",))))
    got = {r.doc_id: (r.n_blocks, [(m.line, m.license, m.differences) for m in r.matches]) for r in licenses.scan(docs_of(spark, rows)).collect()}
    assert [m[1:] for m in got.pop(-2)[1]] == [(name, 0) for name in named_together(notices)]
    assert {k: m for k, (_, m) in got.items()} == wanted and min(n for n, _ in got.values()) > 0


# -- 5 lines
def line_set(line):
    w = line.encode().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_lines(texts):
    before, out = [], []
    for t in texts:
        kept = []
        for line in t.split("\n"):
            s = line_set(line)
            if s and any(len(s & o) >= 0.8 * len(s | o) for o in before):
                before.append(s)
                continue
            if s:
                before.append(s)
            kept.append(line)
        out.append("\n".join(kept))
    return out


def test_lines_equal_brute_force(spark, odd, none):
    base = [prose(k, 40) for k in range(6)]
    near = [" ".join(w if i != 3 * k % 40 else f"new{k}" for i, w in enumerate(base[k % 3].split())) for k in range(30)]
    texts = ["\n".join(base), "\n".join(near[:10] + ["", "x y", "x y"]), "\n".join(near[10:]), "\n".join(reversed(base)), None, "", "x y\nz"]
    got = {r.doc_id: r.text for r in lines.dedup_lines(docs_of(spark, list(enumerate(texts)))).collect()}
    assert [got[k] for k in range(len(texts))] == brute_lines([t or "" for t in texts])
    out = lines.dedup_lines(odd, keep=("lang", "key"))
    assert out.count() == len(odd_rows()) and out.columns == ["doc_id", "lang", "key", "uid", "text", "n_lines", "n_removed"]
    assert lines.dedup_lines(none).count() == 0


# -- 6 near duplicates
def test_near_duplicates_equal_brute_force(spark, odd, none):
    def edit(k, n):
        w = prose(k % 4, 120).split()
        for j in range(n):
            w[(k * 7 + j * 23) % 120] = f"new{k}x{j}"
        return " ".join(w)

    texts = [edit(k, k % 5) for k in range(40)] + [prose(200 + k, 60) for k in range(20)] + ["dup dup dup dup dup dup " * 20] * 2
    sets = [Counter(tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)) for t in texts]
    low = list(range(len(texts)))
    while True:
        new = [min(low[j] for j in range(len(texts)) if sum((sets[i] & sets[j]).values()) >= 0.8 * sum((sets[i] | sets[j]).values())) for i in low_range(texts)]
        if new == low:
            break
        low = new
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs_of(spark, list(enumerate(texts)))).collect()}
    assert [got[k] for k in range(len(texts))] == low
    out = minhash.near_duplicates(odd).collect()
    kept = Counter(r.doc_id for r in out if r.kept)
    assert len(out) == len(odd_rows()) and kept[1] == kept[2] == kept[3] == 1 and kept[9] == 1 and kept[5] + kept[6] == 1 and kept[7] + kept[8] == 1
    assert minhash.near_duplicates(none).count() == 0


def low_range(texts):
    return range(len(texts))


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(5)
    h = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    a, b = rng.integers(1, 9, 60), rng.integers(1, 9, 60)
    sig = minhash.signatures(np.tile(h, 2), np.repeat([0, 1], 60), np.concatenate([a, b]), 2, 4096)
    assert (sig[0] == sig[1]).mean() == pytest.approx(np.minimum(a, b).sum() / np.maximum(a, b).sum(), abs=0.03)


def test_components(spark):
    df = spark.createDataFrame([(1, 2), (3, 2), (9, 9), (4, 5), (5, 4), (None, 1)] + [(k, k + 1) for k in range(20, 60)], "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, **{k: 20 for k in range(20, 61)}}


# -- 7 mixing
def test_budgets():
    have = {("a", "x"): 10, ("a", "y"): 100, ("b", "x"): 1000}
    assert mixing.leaf_budgets(100, have, {("a",): 3, ("b",): 1}) == {("a", "x"): 10, ("a", "y"): 65, ("b", "x"): 25}
    assert mixing.leaf_budgets(200, have, {("a",): 3, ("b",): 1}) == {("a", "x"): 10, ("a", "y"): 100, ("b", "x"): 90} or \
        sum(mixing.leaf_budgets(200, have, {("a",): 3, ("b",): 1}).values()) == 200
    assert mixing.leaf_budgets(10**6, have, {("b",): 0}, 2) == {("a", "x"): 20, ("a", "y"): 200, ("b", "x"): 0}


@pytest.mark.parametrize("slice_rows", [3, 10_000])
def test_selected_prefix_equals_brute_force(spark, slice_rows):
    rows = [(k, " ".join(["w"] * (1 + k % 7)), "en" if k % 3 else "de", f"s{k % 2}", 0) for k in range(60)]
    df = docs_of(spark, rows)
    got = {r.doc_id: r.epochs for r in mixing.mix(df, [F.col("lang"), F.col("source")], {("en",): 3}, budget=300, max_epochs=3, slice_rows=slice_rows).collect()}
    have = Counter()
    for r in rows:
        have[r[2], r[3]] += 1 + r[0] % 7
    given_ = mixing.leaf_budgets(300, have, {("en",): 3}, 3)
    order = {r.doc_id: r for r in df.select("doc_id", *[F.xxhash64(F.lit(7), F.lit(e).cast("long"), "doc_id", ((F.col("doc_id") % 7) + 1)).alias(f"e{e}") for e in range(4)]).collect()}
    want = Counter()
    for leaf, budget in given_.items():
        own = [r[0] for r in rows if (r[2], r[3]) == leaf]
        whole, rest = divmod(budget, have[leaf])
        for i in own:
            want[i] += whole
        for i in sorted(own, key=lambda i: order[i][f"e{whole}"]):
            rest -= 1 + i % 7
            if rest < 0:
                break
            want[i] += 1
    assert got == {k: v for k, v in want.items() if v}


@pytest.mark.parametrize("slice_rows", [3, 10_000])
def test_a_long_document_does_not_end_its_leaf(spark, slice_rows):
    rows = [(k, " ".join(["w"] * (400 if k == 0 else 5 + k % 11)), "en", "s0", 0) for k in range(61)]  # id 0: 40 % or more of the leaf
    rows += [(k, " ".join(["w"] * (1 + k % 7)), "de", "s0", 0) for k in range(100, 130)]
    df = docs_of(spark, rows)
    size, have = {r[0]: len(r[1].split()) for r in rows}, Counter()
    for r in rows:
        have[r[2], r[3]] += size[r[0]]
    assert size[0] >= 0.4 * have["en", "s0"]
    levels, long_first = [F.col("lang"), F.col("source")], 0
    for seed in range(4):
        budget, order = 500, {r.doc_id: r.h for r in docs_of(spark, [(r[0], "") for r in rows]).select("doc_id", F.col("doc_id").alias("d")).join(
            spark.createDataFrame(list(size.items()), "doc_id long, n_tokens long"), "doc_id").select(
            "doc_id", F.xxhash64(F.lit(seed), F.lit(0).cast("long"), "doc_id", "n_tokens").alias("h")).collect()}
        got = {r.doc_id for r in mixing.mix(df, levels, {}, budget=budget, seed=seed, slice_rows=slice_rows, fill=True).collect()}
        want = set()
        for leaf, room in mixing.leaf_budgets(budget, have, {}).items():
            for i in sorted((r[0] for r in rows if (r[2], r[3]) == leaf), key=order.get):
                if size[i] <= room:
                    want.add(i)
                    room -= size[i]
            if leaf[0] == "en":
                assert room < 5 + 11
        prefix = {r.doc_id for r in mixing.mix(df, levels, {}, budget=budget, seed=seed, slice_rows=slice_rows).collect()}
        assert got == want and prefix <= got
        long_first += sum(size[i] for i in got) > sum(size[i] for i in prefix) + 16
    assert long_first


def test_rounds_of_a_fill_leave_no_work_in_the_plan(spark):
    """The result reads what the rounds have written; joins and sorts of all rounds in one plan filled the driver."""
    size = {k: 2 ** (k % 11) + k % 5 for k in range(120)}
    df = docs_of(spark, [(k, " ".join(["w"] * n), "en", "s0", 0) for k, n in size.items()])
    budget = sum(size.values()) * 5 // 3
    out = mixing.mix(df, [F.col("lang")], {}, budget=budget, max_epochs=3, fill=True, slice_rows=7)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan and "Aggregate" not in plan
    got, rest = {r.doc_id: r.epochs for r in out.collect()}, budget - sum(size.values())
    order = {r.doc_id: r.h for r in spark.createDataFrame(list(size.items()), "doc_id long, n long").select(
        "doc_id", F.xxhash64(F.lit(7), F.lit(1).cast("long"), "doc_id", "n").alias("h")).collect()}
    want = {}
    for k in sorted(size, key=order.get):
        want[k] = 1 + (size[k] <= rest)
        rest -= size[k] * (want[k] - 1)
    assert got == want and out.count() == len(size)


def test_mixing_odd_rows(spark, odd, none):
    out = mixing.mix(odd, [F.col("lang"), F.col("source")], {}, budget_share=1.0).collect()
    assert len(out) == len(odd_rows()) and {tuple(r.path) for r in out} >= {("(null)", "s"), ("en", "(null)")}
    assert mixing.mix(none, [F.col("lang")], {}, budget=10).count() == 0


# -- 8 quality
def test_flattened_trees_equal_node_by_node_walk():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 4))
    f = quality.fit_forest(x, (x[:, 0] + x[:, 1] ** 2 > 0.5).astype(float), trees=12, depth=3)
    total = []
    for row in x:
        s = f.base
        for t in range(len(f.feature)):
            at = 0
            for _ in range(3):
                at = 2 * at + (2 if row[f.feature[t, at]] > f.threshold[t, at] else 1)
            s += f.leaf[t, at - 7]
        total.append(1 / (1 + np.exp(-s)))
    assert np.allclose(f.score(x), total)


def test_quality_on_held_out_rows(spark, odd, none):
    good = [(k, ". ".join(prose(100 * k + j, 9) for j in range(6))) for k in range(150)]
    bad = [(k, "spam spam " * 20 + prose(k, 3)) for k in range(150, 300)]
    docs = docs_of(spark, good + bad)
    labels = spark.createDataFrame([(k, int(k < 150)) for k in range(300)] + [(5, None), (None, 1)], "doc_id long, quality int")
    forest = quality.train(docs, labels, max_rows=200)
    out = quality.score(docs, forest).withColumn("held", quality.held_out()).collect()
    held = [r for r in out if r.held]
    assert 30 < len(held) < 90 and np.mean([(r.score >= 0.3) == (r.doc_id < 150) for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in quality.score(odd, forest).collect()) and quality.score(none, forest).count() == 0
    assert {r.score for r in quality.score(odd, quality.train(odd, labels.limit(0))).collect()} == {0.5}
    assert quality.sample_labels(labels, 50, 8).count() <= 50


# -- 9 vectors
def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(12, 8))
    x = [(base[k % 12] + rng.normal(size=8) * (0.25 if k % 2 else 0.02)).tolist() for k in range(240)]
    x += [x[0]] * 5 + [None, [0.0] * 8, [float("nan")] * 8, [1.0, None] * 4, [], [1e-200] * 8, [1.0, 2.0], [2.0, 4.0]]
    df = spark.createDataFrame([(k, v, "x") for k, v in enumerate(x)], "vec_id long, embedding array<double>, label string")
    for block in (16, 4096):
        got = {r.vec_id: r for r in metric_join.near_vectors(df, block=block).collect()}
        ok = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and np.abs(v).max() > 0 for v in x]
        unit = [np.array(v) / np.abs(v).max() if o else None for v, o in zip(x, ok, strict=True)]
        near = np.array([[bool(i != j and ok[i] and ok[j] and len(x[i]) == len(x[j]) and unit[i] @ unit[j] >= 0.9 * np.linalg.norm(unit[i]) * np.linalg.norm(unit[j]))
                          for j in range(len(x))] for i in range(len(x))])
        low = np.arange(len(x))
        for _ in x:
            low = np.array([min([low[i], *low[near[i]]]) for i in range(len(x))])
        assert [got[k].n_links for k in range(len(x))] == near.sum(1).tolist()
        assert [got[k].component_id for k in range(len(x))] == low.tolist()
        assert all(got[k].kept == (got[k].component_id == k) for k in got)
    twice = metric_join.near_vectors(df.union(df.limit(1))).collect()
    assert len(twice) == len(x) + 1
    assert metric_join.near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize(("kind", "width"), [("float", 3), ("double", 3), ("float", 40)])
def test_vectors_are_stored_once_and_meet_where_they_lie(spark, monkeypatch, kind, width):
    rng = np.random.default_rng(width)
    x = (rng.normal(size=(40, width))[rng.integers(0, 40, 500)] + rng.normal(size=(500, width)) * 0.25) * np.exp(rng.normal(size=(500, 1)))
    x = np.vstack([x.astype(np.float32), x[:20].astype(np.float32) * np.float32(4), np.eye(width)[:2]]).astype(float)
    df = spark.createDataFrame([(1000 - k, v) for k, v in enumerate(x.tolist())], f"vec_id long, embedding array<{kind}>")
    staged, stage = {}, metric_join.stage_table

    def told(df, name):
        staged[name] = df._jdf.queryExecution().executedPlan().toString(), stage(df, name)
        return staged[name][1]

    monkeypatch.setattr(metric_join, "stage_table", told)
    got = {r.vec_id: r for r in metric_join.near_vectors(df, block=16).collect()}
    # Comparing deals and copies no vectors, and each is in one block.
    assert "Exchange" not in staged["found"][0] and "CartesianProduct" in staged["found"][0]
    blocks = staged["blocks"][1].collect()
    members = np.concatenate([np.frombuffer(b.uid, np.int64) for b in blocks])
    assert len(set(members.tolist())) == len(members) == staged["class"][1].count() == 502
    assert all(len(b.raw) == len(b.uid) // 8 * width * (4 if kind == "float" else 8) for b in blocks) and len({b.block for b in blocks}) == len(blocks) > 30
    # Every two blocks meet once at most, each one with itself; in three dimensions most are too far apart.
    met = [(r.a_block, r.b_block) for r in metric_join._pairs(staged["blocks"][1], np.sqrt(0.2)).select("a_block", "b_block").collect()]
    pairs = {tuple(sorted(m)) for m in met}
    assert len(pairs) == len(met) and {(b.block, b.block) for b in blocks} <= pairs
    assert len(pairs) < len(blocks) ** 2 / 4 or width > 3
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    assert near.sum() > 2000
    low = 1000 - np.arange(len(x))
    for _ in x:
        low = np.array([low[n].min() for n in near])
    assert [got[1000 - k].n_links for k in range(len(x))] == (near.sum(1) - 1).tolist()
    assert [got[1000 - k].component_id for k in range(len(x))] == low.tolist()


# -- 10 fingerprints
def test_neighbours_and_likeness(spark, odd, none):
    rows = [(k, "The cat of the house is on " + prose(k, 40 + k)) for k in range(40)] + [(100, ""), (101, None), (102, "!!"), (103, "zebra")]
    df = docs_of(spark, rows)
    whole = {k: t or "" for k, t in rows}
    order = sorted(whole, reverse=True)
    prints = {r.doc_id: r.fingerprint for r in spotsigs.fingerprints(df).collect()}
    assert prints[100] == prints[101] == prints[102] == "" and prints[103] != ""
    for size in (300, 1 << 24):
        got = {r.doc_id: r for r in spotsigs.with_neighbours(df, range_bytes=size).collect()}
        assert len(got) == len(rows)
        for at, k in enumerate(order):
            after = order[(at + 1) % len(order)]
            cut = len(whole[k]) // 3
            edited = whole[k][:len(whole[k]) - cut] + whole[after][:cut]
            assert got[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[k].n_chars == len(whole[k])
            assert got[k].fingerprint == prints[k]
            a, b, c = ({s[i:i + 12] for i in range(0, len(s), 12)} for s in (prints[k], prints[after], got[k].edited_fingerprint))
            assert got[k].near_next == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
            assert got[k].near_edited == pytest.approx(len(a & c) / len(a | c) if a | c else 1.0)
    assert spotsigs.with_neighbours(odd).count() == len(odd_rows())
    one = spotsigs.with_neighbours(df.limit(1)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert spotsigs.with_neighbours(none).count() == 0


def test_matches_equal_brute_force(spark):
    rows = [(k, " ".join(f"the {w} {w}x" if i != k else f"the new{k} x" for i, w in enumerate(prose(k % 3, 60).split()))) for k in range(30)]
    df = docs_of(spark, rows)
    sets = {r.doc_id: frozenset(r.fingerprint[i:i + 12] for i in range(0, len(r.fingerprint), 12)) for r in spotsigs.fingerprints(df).collect()}
    want = {(a, b) for a in sets for b in sets if a < b and sets[a] != sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert want and {(r.a, r.b) for r in spotsigs.matches(df).collect()} == want


def test_texts_schema():
    assert SCHEMA.startswith("doc_id")
