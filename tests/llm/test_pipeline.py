"""The pipeline on a small table: columns, planted cases, decisions of each stage."""

import hashlib
from collections import Counter

import pytest

import corpus_pipeline as P
import __spark_entry__ as E
from llm_cases import docs_of, odd_rows, prose
from wardline.llm.queries import PATTERN, RANKS
from wardline.llm import bpe


def test_stages(spark, tmp_path):
    good = [(k, "\n".join(". ".join(prose(1000 * k + 10 * i + j, 9) for j in range(3)) for i in range(3))) for k in range(120)]
    bad = [(k, "spam spam " * 30) for k in range(200, 240)]
    near = [(k + 500, t.replace(" ", " new ", 1)) for k, t in good[:5]]
    copies = [(k + 600, t) for k, t in good[5:10]]
    docs = docs_of(spark, good + bad + near + copies, extra=False)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(k, 1) for k, _ in good] + [(k, 0) for k, _ in bad], "doc_id long, quality int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    seen, now = {}, docs
    for name, stage in P.STAGES:
        now = spark.createDataFrame(stage(spark, now, str(tmp_path)).toPandas()) if name == "encode" else stage(spark, now, str(tmp_path)).cache()
        seen[name] = {r.doc_id for r in now.collect()}
        if name != "encode":
            assert now.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert seen["quality_filter"] == {k for k, _ in good + near + copies}
    assert not seen["line_dedup"] & {k for k, _ in copies} and {k for k, _ in good} <= seen["line_dedup"]
    assert {k for k, _ in good} <= seen["near_dedup"]
    assert seen["mix_sources"] == seen["near_dedup"]  # one domain: nothing to balance
    assert seen["encode"] == seen["mix_sources"]
    assert {r.doc_id for r in P.run(spark, str(tmp_path)).collect()} == seen["encode"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Labels for some of the odd rows, with null, repeated and unknown ids."""
    at = tmp_path_factory.mktemp("tables")
    rows = [(5, 1), (6, 1), (7, 1), (8, 0), (9, 0), (9, 1), (None, 1), (5, None), (999, 0)]
    spark.createDataFrame(rows, "doc_id long, quality int").write.parquet(str(at / "labels.parquet"))
    return str(at)


@pytest.mark.parametrize("name, stage", P.STAGES)
def test_every_stage_on_odd_rows(spark, folder, name, stage):
    rows = odd_rows()
    got = stage(spark, docs_of(spark, rows), folder)  # with extra columns that operators use inside
    out = got.collect()
    texts = Counter(r[1] or "" for r in rows)
    if name == "encode":
        assert Counter(r.decoded_sha256 for r in out) == Counter(hashlib.sha256((r[1] or "").encode()).hexdigest() for r in rows)
        assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
        return
    assert got.columns == list(P.COLUMNS)
    ids = Counter(r.doc_id for r in out)
    present = Counter(r[0] for r in rows)
    assert set(ids) <= set(present) and (name == "mix_sources" or not ids - present)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out)
    if name == "near_dedup":
        # One of each group: the copies of 5 and 9 go, and 8, which only has a word more than 7.
        assert ids == Counter([1, 2, 3, 4, 5, 7, 9, None, 10])
    if name == "line_dedup":
        kept = Counter(r.text or "" for r in out)
        assert kept[""] == texts[""] and kept["one"] == 1 and kept["a\n\nb"] == 1 and sum(kept.values()) < len(rows)
    if name == "mix_sources":
        assert all(n <= 4 * present[k] for k, n in ids.items())  # epochs
        tokens = sum(len((r[1] or "").split()) for r in rows)
        assert 0.5 * tokens < sum(len((r.text or "").split()) for r in out) <= tokens
    if name == "quality_filter":
        assert len(out) <= len(rows)


@pytest.mark.parametrize("name, stage", P.STAGES)
def test_every_stage_on_an_empty_table(spark, folder, name, stage):
    got = stage(spark, docs_of(spark, []).limit(0), folder)
    assert got.count() == 0 and (name == "encode" or got.columns == list(P.COLUMNS))


def test_entry_registers_everything():
    names = E.queries()
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert bpe.read_ranks(RANKS) and PATTERN
