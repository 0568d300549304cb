"""The corpus pipeline on the smallest tables, and the registered queries."""

import __spark_entry__
import corpus_pipeline
from tenderlake.llm import ppm_language, queries
from test_texts import classes_by_hand, contamination_by_hand

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert "pipeline" in __spark_entry__.queries() and set(queries.SQL) <= set(__spark_entry__.oracle_sql())


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    first = corpus_pipeline.known_languages(spark, docs, FOLDER)
    model = ppm_language.fit(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 5 != 0"))
    readable = {r.doc_id for r in ppm_language.predict_language(docs, model).where("lang_pred <> 'und'").collect()}
    assert {r.doc_id for r in first.collect()} == readable
    second = corpus_pipeline.first_of_near_copies(spark, first, FOLDER)
    texts = [(r.doc_id, r.text) for r in first.collect()]
    assert {r.doc_id for r in second.collect()} == {i for i, (_, c) in classes_by_hand(texts).items() if i == c}
    third = corpus_pipeline.without_benchmark(spark, second, FOLDER)
    texts = [(r.doc_id, r.text) for r in second.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert {r.doc_id for r in third.collect()} == {i for i, (_, hit, _) in contamination_by_hand(texts, items).items() if not hit}
    fourth = corpus_pipeline.mixed_sources(spark, third, FOLDER)
    assert first.columns == second.columns == third.columns == fourth.columns == docs.columns
    last = corpus_pipeline.sharded(spark, fourth, FOLDER)
    assert sorted(r.doc_id for r in last.collect()) == sorted(r.doc_id for r in fourth.collect())


def test_run_makes_whole_shards(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    for shard in {r.shard for r in rows}:
        own = sorted(r.slot for r in rows if r.shard == shard)
        assert own == list(range(len(own)))
