"""The pipeline's stages, one by one and together."""

import itertools
import re

import corpus_pipeline as P
from clickscope.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_groups(docs):
    """Smallest ids of the groups under five-word shingles and 0.75."""
    sets = {}
    for r in docs.select("doc_id", "text").collect():
        w = WORD.findall((r["text"] or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[r["doc_id"]] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    low = {i: i for i in sets}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for i, j in itertools.combinations(sets, 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            low[b] = a
    return {i for i in sets if find(i) == i}


def test_stages_keep_columns_and_their_decisions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    at = docs
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, at, sf_dir)
        assert out.columns == docs.columns, name
        ids = {r["doc_id"] for r in at.select("doc_id").collect()}
        left = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert left <= ids
        if name == "jaccard_join":
            assert left == plain_groups(at)
        if name == "decontamination":
            assert ids - left == {r["doc_id"] for r in queries.decontamination.leaks(at, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
        at = out
    final = P.run(spark, sf_dir)
    assert {r["doc_id"] for r in final.collect()} == {r["doc_id"] for r in at.select("doc_id").collect()}


def test_registered():
    import __spark_entry__ as E
    names = set(E.queries())
    assert "pipeline" in names and {int(m[1]) for m in (re.match(r"op(\d+)_", n) for n in names) if m} == set(range(1, 14))


def test_empty_documents(spark, sf_dir):
    at = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        at = stage(spark, at, sf_dir)
        assert at.count() == 0
