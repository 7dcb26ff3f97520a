"""The stages of the pipeline against plain versions, and on odd rows."""

import collections
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from kinspark.llm import decontaminate, quality, toxicity
from kinspark.llm.common import cut

from .test_copies import plain_groups
from .test_operators import plain_targets, plain_tiles

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def rows_of(df):
    return collections.Counter((r.doc_id, r.text) for r in df.collect())


@pytest.mark.parametrize("stage, module, label, keep", [(P.without_toxic, toxicity, "toxic", lambda s: s < 0.5), (P.of_quality, quality, "quality", lambda s: s >= 0.3)])
def test_filters_keep_what_the_model_says(spark, sf, docs, stage, module, label, keep):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = module.fit(docs, labels)
    want = collections.Counter((r.doc_id, r.text) for r in docs.collect() if keep(module.train and float(model.scores([r.text or ""])[0])))
    out = stage(spark, docs, sf)
    assert rows_of(out) == want and out.columns == docs.columns
    clashing = docs.withColumns({"score": F.lit("x"), "predicted": F.lit("y")})
    assert {(r.score, r.predicted) for r in stage(spark, clashing, sf).collect()} == {("x", "y")}


def test_one_of_each_group_is_the_least_of_all_pairs(spark, sf, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    group = plain_groups(rows)
    want = {d for d, _ in rows if group[d] == d}
    got = [r.doc_id for r in P.one_of_each_group(spark, docs, sf).collect()]
    assert len(got) == len(set(got)) and want <= set(got)
    assert len(set(got) - want) <= 0.05 * max(1, len(rows) - len(want))


def test_benchmark_documents_go(spark, sf, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rng = random.Random(3)
    rows = []
    for i, (_, text) in enumerate(items[:12]):
        words = text.split()
        half = len(words) // 2
        rows += [(i * 10, " ".join(["zq"] * 9 + words[half:] + ["zq"] + words[:half]), "en", "a", 1), (i * 10 + 1, " ".join(words[: len(words) // 4] + ["zq"] * 30), "en", "a", 1), (i * 10 + 2, " ".join(rng.sample(words, len(words))), "en", "a", 1)]
    made = spark.createDataFrame(rows, DOCS)
    want = set()
    for d, t, *_ in rows:
        w = decontaminate.words_of(t)
        if not any(own and plain_tiles(w, own, min(5, len(own))) >= 0.5 * len(own) for own in (decontaminate.words_of(x) for _, x in items if set(decontaminate.words_of(x)) & set(w)) if len(own) < 400):
            want.add(d)
    got = {r.doc_id for r in P.without_benchmark(spark, made, sf).collect()}
    assert got == want and not any(d % 10 == 0 for d in got)


def test_run(spark, sf, docs):
    out = P.run(spark, sf).collect()
    assert set(out[0].asDict()) == {*docs.columns, "shard", "copy", "position"}
    left = cut(docs)
    for _, stage in P.STAGES[:-1]:
        left = cut(stage(spark, left, sf))
    kept = {r.doc_id: len((r.text or "").split()) for r in left.collect()}
    source = {r.doc_id: r.source for r in left.collect()}
    sizes, taken = collections.Counter(), collections.Counter()
    for d, n in kept.items():
        sizes[source[d]] += n
    for r in out:
        taken[r.source] += len((r.text or "").split())
    assert {r.doc_id for r in out} <= set(kept) and max(collections.Counter(r.doc_id for r in out).values()) <= 3
    most = max(kept.values())
    assert all(abs(taken[s] - t) <= most for s, t in plain_targets(dict(sizes)).items())


def test_odd_rows(spark, tmp_path):
    rows = [(1, None, None, None, 0), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (None, "w " * 5000, None, "a", 0), (4, "one two", "fr", None, 0), (4, "three four", "fr", "b", 0), (5, " \t\n", "en", "b", 0)]
    made = spark.createDataFrame(rows, DOCS).withColumns({"score": F.lit(1), "__key": F.lit(2), "shard": F.lit(3)})
    sf = str(tmp_path)
    made.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, "a b c d e f"), (2, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in P.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0
        out = stage(spark, docs, sf)
        if name != "mixing":
            assert out.columns == docs.columns
            assert out.count() == (4 if name == "near_duplicates" else len(rows)), name
    assert P.run(spark, sf).count() > 0
