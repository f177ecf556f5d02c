"""Each stage of the pipeline on its own input, against plain Python, and the run as a whole."""

import duckdb
import pytest
from test_decontaminate import brute_force as leaks
from test_minhash import brute_force as near

import corpus_pipeline
from millrace.llm import sql
from millrace.llm.quality import score_documents, train_quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs.cache())]
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, stage(spark, out[-1][1], SF).cache()))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_and_order(steps):
    names = ["documents", "quality", "line_dedup", "near_dedup", "decontaminate", "packing"]
    assert [n for n, _ in steps] == names
    assert all(df.schema == steps[0][1].schema for _, df in steps[:5])
    assert 0 < steps[5][1].select("doc_id").distinct().count() < steps[0][1].count()


def test_quality_drops_what_the_classifier_rejects(spark, steps):
    docs = steps[0][1]
    forest = train_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in score_documents(docs, forest).where("predicted = 1").collect()}
    assert texts(steps[1][1]).keys() == good and len(good) < docs.count()


def test_line_dedup_equals_sql(steps):
    documents = steps[1][1].toPandas()  # noqa: F841  read by name
    expected = duckdb.sql(sql.OP4_LINE_DEDUP).fetchall()
    expected = {d: (n, h) for d, _, removed, n, h in expected if n or not removed}
    duckdb.register("cleaned", steps[2][1].toPandas())
    got = {d: (n, h) for d, n, h in duckdb.sql("SELECT doc_id, n_chars, md5(text) FROM cleaned").fetchall()}
    assert got == expected


def test_near_dedup_keeps_one_of_each_group(steps):
    before = texts(steps[2][1])
    assert texts(steps[3][1]) == {d: before[d] for d, (_, c) in near(list(before.items()), percent=corpus_pipeline.NEAR_PERCENT).items() if d == c}


def test_near_dedup_links_from_80_hundredths(spark, steps):
    before = texts(steps[2][1])
    rows = [(d, t, len(t)) for d, t in before.items()]
    first = max(before) + 1
    for k in range(40):  # 200 words, so 196 shingles; a changed word takes 5 of them, the last k % 5 only one each
        words = [f"w{k}x{i}" for i in range(200)]
        rows.append((first + 2 * k, " ".join(words), 0))
        changed = [f"y{k}x{i}" if i in (20, 60, 100, 140) or i >= 200 - k % 5 else w for i, w in enumerate(words)]
        rows.append((first + 2 * k + 1, " ".join(changed), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    expected = near([(d, t) for d, t, _ in rows], percent=80)
    got = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()}
    assert got == {d for d, (_, c) in expected.items() if d == c}
    # At 85 they would all have stayed.
    assert {first + 2 * k + 1 for k in range(0, 40, 5)}.isdisjoint(got)


def test_near_dedup_bands_miss_at_most_one_in_a_million():
    rows, bands = corpus_pipeline.NEAR_ROWS, corpus_pipeline.NEAR_BANDS
    assert (1 - (corpus_pipeline.NEAR_PERCENT / 100) ** rows) ** bands < 1e-6


def test_decontaminate_drops_documents_with_items(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = texts(steps[3][1])
    bad = {d for d, _ in leaks(list(before.items()), items)}
    assert bad and texts(steps[4][1]) == {d: t for d, t in before.items() if d not in bad}


def test_run_packs_what_is_left(spark, steps):
    got = corpus_pipeline.run(spark, SF).collect()
    assert {(r.doc_id, r.piece, r.ids_crc32) for r in got} == {(r.doc_id, r.piece, r.ids_crc32) for r in steps[5][1].collect()}
    assert {r.doc_id for r in got} == texts(steps[4][1]).keys()
