import __spark_entry__
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from starloom.llm import decontaminate, langid, mixing, queries

from .conftest import SF
from .test_line_dedup import plain as plain_lines
from .test_mixing import water
from .test_simhash import jaccard


def test_registered():
    names = __spark_entry__.queries()
    assert sorted(n.split("_")[0] for n in names if n.startswith("op")) == sorted(f"op{i}" for i in range(1, 11)) and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)


@pytest.fixture(scope="module")
def stages(spark):
    """(name, input, output) of every stage over the smallest table."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, f in corpus_pipeline.STAGES:
        found = corpus_pipeline.materialise(f(spark, docs, SF), name)
        out.append((name, docs, found))
        docs = found
    return out


def test_against_brute_force(spark, stages):
    rows = {r["doc_id"]: r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kept = {i: r["text"] for i, r in rows.items() if langid.has_letter(r["text"])}
    assert {r["doc_id"] for r in stages[0][2].collect()} == set(kept)
    short = plain_lines(kept.items())
    kept = {i: short[i, t] for i, t in kept.items() if short[i, t] == t or short[i, t].strip()}
    assert {r["doc_id"]: r["text"] for r in stages[1][2].collect()} == kept
    near, before = jaccard(kept), kept
    kept = {r["doc_id"]: r["text"] for r in stages[2][2].collect()}
    assert kept.items() <= before.items() and not any(a in kept and b in kept for (a, b), j in near.items() if j >= 0.8)
    assert set(before) - set(kept) <= {i for pair, j in near.items() if j >= 0.5 for i in pair}
    items = [decontaminate.normalise(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    gone = {i for i, t in kept.items() if any(p in decontaminate.normalise(t) for p in items)}
    after = {r["doc_id"]: r["text"] for r in stages[3][2].collect()}
    assert gone and set(after) <= set(kept) - gone and len(kept) - len(gone) - len(after) <= 1
    mixed = stages[4][2].collect()
    sizes = {}
    for i in sorted(after, key=lambda i: rows[i]["source"]):
        sizes[rows[i]["source"]] = sizes.get(rows[i]["source"], 0) + len(after[i].encode().split())
    want = water(sizes)
    for s in sizes:
        assert abs(sum(r["taken"] for r in mixed if r["source"] == s) - want[s]) <= 0.01 * want[s] + 10
    assert {r["doc_id"] for r in mixed} <= set(after)


def test_columns(stages):
    first = stages[0][1].columns
    assert all(out.columns == first for _, _, out in stages[:4]) and stages[4][2].columns == [*first, *mixing.OUT]
    assert all(out.dtypes == stages[0][1].dtypes for _, _, out in stages[:4])


def test_run(spark, stages):
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, stages[-1][2].collect()))


def test_odd_rows(spark, odd, none):
    docs = odd.withColumn("lang_pred", F.lit("x")).withColumn("taken", F.lit(3))
    for name, f in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(f(spark, docs, SF), name)
    # Copies go (4 and 5 are one text, and 4 was there twice), and what has no letter; two-word texts and the like stay unless the mix takes nothing.
    left = {r["doc_id"] for r in docs.collect()}
    assert {7} <= left <= {None, 4, 7, 8, 9}
    docs = none
    for name, f in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(f(spark, docs, SF), name)
    assert docs.count() == 0


def test_language_model_learns_from_the_rest_only(docs):
    assert queries.language_model(docs).families == ("germanic", "romance")
