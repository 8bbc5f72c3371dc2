import os
import re

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import line_dedup

from .conftest import SCHEMA, SF


def units(text):
    return re.split(line_dedup.CUT, text)


def plain(rows):
    """Distinct (doc_id, text) -> shortened text."""
    first, covered = {}, {}
    order = sorted({(i is not None, i or 0, t) for i, t in rows if t is not None})
    windows = []
    for known, i, t in order:
        u = units(t)
        keys = [(p, x.strip(" \t\r\n"), (p == 0 or u[p - 1].endswith("\n")) and (p == len(u) - 1 or x.endswith("\n"))) for p, x in enumerate(u)]
        keys = [x for x in keys if x[1]]
        for a in range(len(keys) - 2):
            part = keys[a : a + 3]
            if all(x[2] for x in part) or sum(len(x[1]) for x in part) >= 80:
                windows.append(((known, i, t), part[0][0], tuple(k for _, k, _ in part), range(part[0][0], part[2][0] + 1)))
    for doc, p, k, _ in windows:
        first.setdefault(k, (doc, p))
    for doc, p, k, at in windows:
        if first[k] != (doc, p):
            covered.setdefault(doc, set()).update(at)
    return {(i if known else None, t): "".join(x for p, x in enumerate(units(t)) if p not in covered.get((known, i, t), ())) for known, i, t in order}


def run(spark, rows):
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    return sorted(((r["doc_id"], r["text"]) for r in line_dedup.dedup(df).collect()), key=str)


def test_small_cases(spark):
    rows = [
        (1, "a\nb\nc\nd"),
        (2, "x\na\nb\nc\ny"),
        (2, "x\na\nb\nc\ny"),
        (3, "a\n\n b \n\t\nc\r\nz"),
        (4, "a\nb"),
        (5, None),
        (6, ""),
        (7, "q\nq\nq\nq\nq"),
        (None, "d\ne\nf"),
        (8, "d\ne\nf"),
        (9, "a\nb\nc\nd"),
    ]
    want = plain(rows)
    got = run(spark, rows)
    assert got == sorted(((i, None if t is None else want[i, t]) for i, t in rows), key=str)
    assert (2, "x\ny") in got and (9, "") in got and (7, "q\n") in got and (3, "z") in got and (8, "") in got


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.lists(st.sampled_from(["a", "b", "c", "", " a"]), max_size=9)), min_size=1, max_size=25))
def test_random_tables(spark, rows):
    rows = [(n // 2 if i < 2 else n, "\n".join(x)) for n, (i, x) in enumerate(rows)]
    rows = list({i: (i, t) for i, t in rows}.values())
    rows += rows[::3]  # repeated rows
    want = plain(rows)
    assert run(spark, rows) == sorted(((i, want[i, t]) for i, t in rows), key=str)


def test_against_sql(docs, spark):
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    want = sorted(c.sql(line_dedup.SQL).fetchall())
    got = sorted(tuple(r) for r in line_dedup.dedup(docs).select("doc_id", "text", "n_lines", "n_removed").collect())
    assert got == want and any(r[3] for r in got)


def test_odd_rows(odd, none):
    out = line_dedup.dedup(odd.withColumn("n_removed", F.lit("x")).withColumn("covered", F.lit(0)))
    assert out.count() == odd.count() and out.where("n_removed > 0").count() == 0
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in out.collect()) == sorted((r["doc_id"] or 0, r["text"] or "") for r in odd.collect())
    assert line_dedup.dedup(none).count() == 0


def test_passages_inside_long_lines(spark):
    """A passage in the middle of texts without line feeds goes from all but the first; short phrases that recur stay."""
    own = lambda i: " ".join(f"w{i}x{j}" + (",", "", ".", "")[j % 4] for j in range(60))
    passage = ". ".join(" ".join(f"p{k}n{j}" for j in range(9)) for k in range(6)) + ". "
    rows = [(i, f"{own(i)} end. {passage}{own(i + 100)}") for i in range(5)] + [(9, "And so, on. Yes. And so, on. Yes. And so, on.")]
    got = dict(run(spark, rows))
    assert got == {i: plain(rows)[i, t] for i, t in rows} and got[9] == rows[-1][1]
    assert "p1n0" in got[0] and not any("p3n0" in got[i] or "p5n3" in got[i] for i in range(1, 5)) and all(own(i) in got[i] for i in range(5))


def test_long_text_is_linear(spark):
    """200,000 units in one document, all of them repeated."""
    text = "".join(f"line number {i} of many lines that a text has, and then more of them.\n" for i in range(100_000))
    got = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    assert {r["doc_id"]: len(r["text"]) for r in line_dedup.dedup(got).collect()} == {1: len(text), 2: 0}


def test_texts_with_the_mark(spark):
    """The byte that marks ends inside the operator is a character like any other."""
    passage = "some words that are long enough for this, and for that; and then. "
    rows = [(1, f"a\x01b. {passage * 3}end"), (2, f"x. y\x01, {passage * 3}z"), (3, "q\x01\nq\x01\nq\x01\nq\x01\nq\x01\n")]
    assert dict(run(spark, rows)) == {i: plain(rows)[i, t] for i, t in rows}


def test_every_column_stays(docs):
    names = "row d t gone_d gone_t covered h1 h2 p0 p2 first known _l _t _t2 _d w p".split()
    more = docs.select("*", *[F.lit(n).alias(n) for n in names])
    out = line_dedup.dedup(more)
    assert out.columns == [*more.columns, *line_dedup.OUT] and all(r[n] == n for r in out.collect() for n in names)


def test_windows_are_made_once(spark, docs):
    """Each text is cut once on the way to the covered positions."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(text):
        seen.add(1)
        return text

    texts = docs.where("text IS NOT NULL").select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("t"), "text")
    found = line_dedup.covered(texts.withColumn("text", read.asNondeterministic()("text")))
    assert found.count() and seen.value == texts.count()


def test_a_window_in_very_many_places(spark):
    """More occurrences than a window function holds in memory, repeated rows and a null id among them."""
    rows = [(i % 6000 if i % 6000 else None, f"own {i % 6000}\na\nb\nc\nrest {i % 6000}") for i in range(9000)]
    want = plain(rows)
    assert run(spark, rows) == sorted(((i, want[i, t]) for i, t in rows), key=str) and want[rows[0]] == rows[0][1] and want[rows[1]] == "own 1\nrest 1"
