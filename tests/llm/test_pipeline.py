"""The stages of the pipeline over small samples, each held against what it must keep."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from churnkit.llm.quality_rules import judge
from tests.llm.samples import PASSAGE, some_rows, table
from tests.llm.test_dedup import expected_leaks, expected_lines, expected_single

ITEMS = [(1, " ".join(PASSAGE.split()[5:20])), (2, "something else that no document has in it at all")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    table(spark, some_rows(n=120)).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_each_stage_works_on_what_the_one_before_kept(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, folder)
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("own"), F.col("lang").alias("l"), F.col("source").alias("s"))
    same = "d.doc_id <=> v.doc_id and own = v.digest and l <=> v.lang and s <=> v.source"
    verdicts = judge(docs).select("doc_id", "digest", "lang", "source", "kept").distinct()
    judged = hashed.alias("d").join(verdicts.alias("v"), F.expr(same)).select("d.doc_id", "d.text", "kept")
    assert judged.count() == docs.count()
    assert pairs(kept) == pairs(judged.where("kept"))

    lines = corpus_pipeline.line_dedup(spark, kept, folder)
    assert lines.columns == docs.columns and lines.dtypes == docs.dtypes
    assert pairs(lines) == sorted(((d, t) for d, _, _, t in expected_lines(pairs(kept))), key=str)
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    single = corpus_pipeline.near_duplicates(spark, lines, folder)
    assert pairs(single) == expected_single(spark, pairs(lines)) and single.columns == docs.columns

    clean = corpus_pipeline.decontamination(spark, single, folder)
    assert pairs(clean) == [p for p in pairs(single) if not expected_leaks([p], ITEMS)[0][5]] and clean.columns == docs.columns
    assert len(pairs(clean)) < len(pairs(single)) < len(pairs(kept)) < len(pairs(docs))

    whole = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in whole} == {d for d, _ in pairs(clean)}
    assert sorted(r.ids_crc32 for r in whole) == sorted(r.ids_crc32 for r in corpus_pipeline.best_fit_packing(spark, clean, folder).collect())


def test_each_row_is_judged_by_its_own_text(spark):
    """Rows of one id, with and without a name: what is wrong with one takes no other away."""
    good = " ".join(f"Word{i} stands here," for i in range(60))
    bad = " ".join(["the same passage again and again for ever"] * 20)
    docs = table(spark, [(5, good), (5, bad), (None, bad), (None, good), (6, "few words")])
    kept = corpus_pipeline.quality_rules(spark, docs, "")
    assert pairs(kept) == sorted([(5, good), (None, good)], key=str) and kept.columns == docs.columns


def test_no_documents(spark, folder):
    empty = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id = -99")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).collect() == []


def test_workers_of_every_stage_hand_freed_memory_back(spark, folder, monkeypatch):
    """The stages' operators are made with the settings, and what the caller has set stays."""
    monkeypatch.setattr(spark.sparkContext, "environment", {"MALLOC_ARENA_MAX": "7"})
    for _, stage in corpus_pipeline.STAGES:
        spark.sparkContext.environment.pop("MALLOC_MMAP_THRESHOLD_", None)
        stage(spark, spark.read.parquet(f"{folder}/documents.parquet").limit(0), folder)
        assert spark.sparkContext.environment["MALLOC_MMAP_THRESHOLD_"] == "1048576"
    assert spark.sparkContext.environment["MALLOC_ARENA_MAX"] == "7"
