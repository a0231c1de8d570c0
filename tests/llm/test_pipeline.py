"""Each stage of the pipeline, on what its predecessor kept, against plain Python."""

from collections import Counter

import corpus_pipeline
from plain_text import closest, kept_lines, plain_measures
from pyspark.sql import functions as F

from filingloom.llm.mixing import WEIGHTS, mix_sources
from filingloom.llm.rules import MEASURES, POLICIES, RULES


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    near = docs.filter("doc_id % 10 = 3").select((F.col("doc_id") + 100_000).alias("doc_id"), F.regexp_replace("text", " [a-z]+ ([a-z]+\\.)$", " changed $1").alias("text"), "lang", "source", "n_chars")
    docs = docs.unionByName(near).withColumn("n_chars", F.length("text").cast("bigint"))
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        before = docs
        step(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "best_fit_packing":
            assert docs.columns == before.columns
        given = {r.doc_id: r for r in before.collect()} if name != "best_fit_packing" else {}
        got = docs.collect()
        if name == "quality_rules":
            good = {i for i, r in given.items() if not any(eval(RULES[x].replace("OR", "or"), {}, dict(zip(MEASURES, plain_measures(r.text), strict=True))) for x in POLICIES["v2"])}  # noqa: S307
            assert {r.doc_id for r in got} == good and len(good) < len(given)
        elif name == "line_dedup":
            expected = kept_lines([(i, r.text) for i, r in given.items()], 10)
            assert {r.doc_id: r.text for r in got} == {i: v[0][0] for i, v in expected.items()}
            assert all(r.n_chars == len(r.text) for r in got)
        elif name == "jaccard_join":
            groups = closest([(i, r.text) for i, r in given.items()], 5, 80, 100)
            assert {r.doc_id for r in got} == {i for i, (_, first) in groups.items() if first == i}
        elif name == "mixing_sources":
            draws = Counter(r.doc_id for r in mix_sources(before, WEIGHTS)[0].select("doc_id").collect())
            assert Counter(r.doc_id for r in got) == draws
            assert all(r.text == given[r.doc_id].text for r in got)
            kept = draws
        else:
            assert Counter(r.doc_id for r in got if r.piece == 0) == kept
            room = Counter()
            for r in got:
                room[r.sequence_id] += r.length
            assert max(room.values()) <= 4096 and len(room) <= 1.05 * sum(room.values()) / 4096 + 2


def test_run_reads_the_folder(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None
