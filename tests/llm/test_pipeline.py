"""The pipeline on tables that hold nothing, nothing but nulls, and one text many times."""

import shutil

import pytest

import corpus_pipeline
from tessella.llm import near_duplicates
from tests.llm.test_operators import SF, prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def folder(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(2).write.parquet(f"{path}/documents.parquet")
    shutil.copy(f"{SF}/benchmark.parquet", f"{path}/benchmark.parquet")
    return str(path)


@pytest.mark.parametrize("rows", [[], [(i, None, "en", "s", None) for i in range(20)], [(None, "", None, None, 0)]])
def test_nothing_to_keep(spark, tmp_path, rows):
    out = corpus_pipeline.run(spark, folder(spark, tmp_path, rows))
    assert out.count() == 0 and "ids_crc32" in out.columns


def test_one_text_many_times(spark, tmp_path):
    text = prose(200, 77)
    out = corpus_pipeline.run(spark, folder(spark, tmp_path, [(i, text, "en", "s", len(text)) for i in range(300, 0, -1)])).collect()
    assert {r["doc_id"] for r in out} == {1} and sum(r["length"] for r in out) == out[0]["doc_tokens"]


def test_the_row_that_stays_is_the_same_each_time(spark):
    text = prose(60, 5)
    rows = [(1, text, "en", f"s{i}", 1) for i in range(30)] + [(2, text, "de", "z", 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("more", corpus_pipeline.F.create_map(corpus_pipeline.F.lit("a"), corpus_pipeline.F.col("source")))
    kept = {tuple(r["source"] for r in near_duplicates.keep_one(df.repartition(n)).collect()) for n in (1, 3, 7)}
    assert len(kept) == 1 and len(next(iter(kept))) == 1
