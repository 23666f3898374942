"""The pipeline against its stages done by brute force, and every query of the subpackage over the smallest tables."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from hustings.llm import queries as llm

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(llm.queries()))
def test_query_runs_whole(spark, name):
    result = llm.queries()[name](spark, SF)
    if name != "op9_packing":
        assert result.count() == (50 if name == "op4_url_filter" else 200)


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = llm.queries()[name](spark, SF).toPandas(), con.sql(llm.oracle_sql()[name]).df()
    rows = lambda df: sorted(map(str, df[sorted(df.columns)].astype(object).where(df[sorted(df.columns)].notna(), None).astype(str).values.tolist()))
    assert rows(got) == rows(want)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        assert set(after) <= set(before) and after
        if name == "SimHash near-dedup":
            assert len({hashlib.md5(t.encode()).digest() for t in after.values()}) == len(after)
        if name == "language ID":
            assert len(before) - len(after) <= 2
        before = after
    assert "pipeline" in __spark_entry__.queries()
    assert corpus_pipeline.run(spark, SF).count() > len(before)


def test_wrong_labels_change_what_stays(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    right = corpus_pipeline.language(spark, docs, SF).count()
    mixed = docs.withColumn("lang", F.element_at(F.array(*map(F.lit, "abcd")), (F.abs(F.hash("doc_id")) % 4 + 1).cast("int")))
    assert right >= 0.98 * docs.count() and corpus_pipeline.language(spark, mixed, SF).count() < 0.8 * right
    none = docs.withColumn("lang", F.lit(None).cast("string")).union(spark.createDataFrame([(-1, "12 - 3", None, "s", 6), (-2, None, None, "s", 0)], docs.schema))
    assert corpus_pipeline.language(spark, none, SF).count() == docs.count()


def test_languages_can_be_chosen(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "LANGUAGES", ("fr",))
    got = {r.lang: r["count"] for r in corpus_pipeline.language(spark, docs, SF).groupBy("lang").count().collect()}
    assert got["fr"] >= 0.9 * docs.filter("lang = 'fr'").count() and sum(got.values()) <= 1.1 * got["fr"]


def by_brute_force(rows, spoken, benchmark):
    """doc_id and text of what the four filtering stages leave, from (doc_id, text) and the ids whose language is told."""
    from test_llm import alnum_of, words_of
    from test_near_copies import kept_by_brute_force

    rows = sorted((i, t) for i, t in rows if i in spoken)
    rows = [rows[k] for k in kept_by_brute_force([t for _, t in rows])]
    first = {}
    for i, t in rows:
        w = words_of(t)
        for a in range(len(w) - 49):
            first.setdefault(tuple(w[a : a + 50]), i)
    cut = []
    for i, t in rows:
        w = words_of(t)
        gone = {p for a in range(len(w) - 49) if first[tuple(w[a : a + 50])] < i for p in range(a, a + 50)}
        if not gone:
            cut.append((i, t))
        elif len(gone) < len(w):
            cut.append((i, " ".join(x for p, x in enumerate(w) if p not in gone)))
    windows = set()
    for t in benchmark:
        w = alnum_of(t)
        windows |= {tuple(w[a : a + min(10, len(w))]) for a in range(max(0, len(w) - 9) or bool(w))}
    sizes = {len(w) for w in windows}
    holds = lambda w: any(tuple(w[a : a + n]) in windows for n in sizes for a in range(len(w) - n + 1))
    return [(i, t) for i, t in cut if not holds(alnum_of(t))]


def test_whole_pipeline_against_brute_force(spark):
    from hustings.llm import language_id, tokens

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    told = language_id.identify(docs).filter(f"lang_pred <> 'und' and score >= {corpus_pipeline.LEAST_SCORE}")
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.text is not None]
    benchmark = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = by_brute_force(rows, {r.doc_id for r in told.select("doc_id").collect()}, benchmark)
    encoder = tokens.WordEncoder(tokens.vocabulary(), 2)
    want = []
    for i, t in left:
        ids = np.frombuffer(encoder.encode([t.encode()])[0], "<u2").astype("<u4")
        at = 0
        for n in [4096] * (len(ids) // 4096) + [1 << b for b in reversed(range(12)) if len(ids) % 4096 >> b & 1]:
            want.append((i, at, n, zlib.crc32(ids[at : at + n].tobytes()), len(ids)))
            at += n
    got = [(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in corpus_pipeline.run(spark, SF).collect()]
    assert 0 < len(left) < len(rows) and sorted(got) == sorted(want)


def test_stages_on_awkward_rows(spark):
    from test_llm import DOCS, corpus

    rows = corpus()
    docs = spark.createDataFrame([(i, t, "en" if (i or 0) % 2 else "fr", "extra", 1, "clash") for i, t in rows], DOCS)
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and {r.score for r in out.collect()} == {"extra"} and {r.spans for r in out.collect()} == {"clash"}, name
        assert stage(spark, empty, SF).count() == 0
        docs = spark.createDataFrame(out.collect(), docs.schema)
    texts = [r.text for r in docs.collect()]
    assert None not in texts and "" not in texts
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= len(texts)
