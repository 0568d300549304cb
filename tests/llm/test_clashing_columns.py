"""Further columns pass every operator that adds to its rows, whatever their names."""

import pytest
from pyspark.sql import functions as F

from tenderlake.llm import decontaminate, entropy_mix, html_wrappers, jaccard_join, ppm_language, reshard, url_templates

HELPERS = (
    "row", "tree", "wrapper", "template_", "root", "first", "label", "key", "hash", "old", "block", "before", "part", "number", "found",
    "items", "kind", "id", "component", "copy", "priority", "l_hash", "c_old", "threshold", "full", "mean", "with.dot",
    "__root", "__host", "__tree", "__url", "__id", "__row", "__t_host", "__label", "__first", "__l_hash", "__hash", "__old", "__block",
    "__s_source", "__key", "__copy", "__block_0",
)
BODY = "some words of an article that nobody else has written about the sea and the hills number {}"


def documents(spark):
    rows = [(i, BODY.format(i) if i else None, f"s{i % 2}", "en", i * 10) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, extra int")
    return docs.select("*", *[F.concat_ws(":", F.lit(h), "doc_id").alias(h) for h in HELPERS])


def pages(spark):
    rows = [(i, f"http://a.example.net/p{i}/x", f"<html><body><p>{BODY.format(i)}</p></body></html>" if i else None) for i in range(5)]
    found = spark.createDataFrame(rows, "page_id long, url string, html string")
    return found.select("*", *[F.concat_ws(":", F.lit(h), "page_id").alias(h) for h in HELPERS])


def mixed(docs):
    return entropy_mix.plan_mix(docs).copies(docs)


def taken(docs):
    return entropy_mix.plan_mix(docs).take(docs).distinct()


def assigned(docs):
    return reshard.plan_resharding(docs, shards=2, old_shards=2).assign(docs)


def contamination(docs, **more):
    bench = docs.sparkSession.createDataFrame([(1, BODY.format(3)), (2, "a b c")], "item_id long, text string")
    return decontaminate.find_contamination(docs, bench, **more)


OPERATORS = {
    "html": (pages, html_wrappers.extract_main_text), "url": (pages, url_templates.judge_urls), "mix": (documents, mixed),
    "take": (documents, taken), "assign": (documents, assigned), "reshard": (documents, lambda d: reshard.reshard(d, shards=2, old_shards=2)),
    "windows": (documents, contamination), "windows_in_blocks": (documents, lambda d: contamination(d, block_windows=2)),
    "near_copies": (documents, jaccard_join.keep_first), "language": (documents, ppm_language.keep_known),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_helper_names_may_be_columns(spark, name):
    make, operator = OPERATORS[name]
    given = make(spark)
    key = given.columns[0]
    got = {r[key]: r for r in operator(given).collect()}
    sent = {r[key]: r for r in given.collect()}
    assert got and set(got) <= set(sent)
    assert name in ("take", "near_copies", "language") or set(got) == set(sent)
    for k, r in got.items():
        assert all(r[h] == f"{h}:{k}" for h in HELPERS)
        assert r["html" if make is pages else "lang"] == sent[k]["html" if make is pages else "lang"]
