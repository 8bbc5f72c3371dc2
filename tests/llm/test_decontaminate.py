from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import decontaminate

from .conftest import SF


def best(pattern, text):
    """Least edit distance of the pattern to any part of the text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


@settings(max_examples=300, deadline=None)
@given(st.text("abc", min_size=1, max_size=70), st.text("abc", min_size=1, max_size=90))
def test_myers_equals_the_table(pattern, text):
    got = decontaminate.myers(decontaminate._masks(pattern), len(pattern), text, len(pattern))
    assert got[0] == best(pattern, text) if best(pattern, text) < len(pattern) else got is None or got[0] == len(pattern)


WORDS = st.sampled_from("the cat sat on a mat with one dog and two birds near some old green tree".split())


@settings(max_examples=150, deadline=None)
@given(st.lists(WORDS, min_size=6, max_size=14), st.lists(WORDS, max_size=10), st.lists(WORDS, max_size=10), st.lists(st.tuples(st.integers(0, 60), st.sampled_from("xyz ")), max_size=7))
def test_found_exactly_when_within_budget(item, before, after, edits):
    passage = list(" ".join(item))
    for at, ch in edits:
        passage[at % len(passage)] = ch
    text = " ".join([*before, "".join(passage), *after])
    pattern = decontaminate.normalise(" ".join(item))
    found = decontaminate.Matcher([(1, pattern)], 0.1).leaks(text)
    distance, budget = best(pattern, decontaminate.normalise(text)), int(0.1 * len(pattern))
    assert (found[0][1:3] == (distance, budget)) if distance <= budget else not found
    if found:
        start, stop = found[0][3:]
        assert best(pattern, decontaminate.normalise(text)[start:stop]) == distance


def test_table_against_brute_force(spark, docs, texts):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r["item_id"]: decontaminate.normalise(r["text"]) for r in benchmark.collect()}
    few = dict(list(texts.items())[::4])
    want = set()
    for d, t in few.items():
        t = decontaminate.normalise(t)[:6000]
        want |= {(d, i) for i, p in items.items() if p in t}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaked(docs, benchmark).collect()}
    assert {x for x in got if x[0] in few} >= want
    clean = {r["doc_id"] for r in decontaminate.clean(docs, benchmark).collect()}
    assert clean == set(texts) - {d for d, _ in got}


def test_edits_are_found_and_clean_texts_kept(spark, none):
    item = "What is the capital of the country that lies between the two rivers in the east?"
    noisy = "Intro. what is the CAPITAL of a country that lies betwen the two rivers, in the east! More."
    rows = [(1, noisy), (2, "Nothing of the sort is asked here, only other words about rivers and the east."), (3, None), (4, ""), (1, noisy)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("leaks", F.lit(7)).withColumn("item_id", F.lit(0))
    bench = spark.createDataFrame([(5, item), (6, None), (7, ""), (8, "too short"), (9, item)], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.leaked(docs, bench).collect())
    assert got == [(1, 5), (1, 5), (1, 9), (1, 9)]
    assert sorted(r["doc_id"] for r in decontaminate.clean(docs, bench).collect()) == [2, 3, 4]
    assert decontaminate.clean(docs, bench.limit(0)).count() == 5 and decontaminate.leaked(none, bench).count() == 0


def test_blocks_cover_all_items(spark):
    bench = spark.createDataFrame([(i, f"item number {i} has several words in it") for i in range(50)], "item_id long, text string")
    blocks = list(decontaminate.blocks(bench, block_chars=200))
    assert len(blocks) > 5 and sorted(i for b in blocks for i, _ in b) == list(range(50))


def test_odd_rows(odd, spark):
    bench = spark.createDataFrame([(1, "the same words in this text")], "item_id long, text string")
    assert sorted(r["doc_id"] for r in decontaminate.leaked(odd, bench).collect()) == [4, 4, 5]


def test_short_items_match_whole_words(spark):
    bench = spark.createDataFrame([("x1", "Blue moon?"), ("x2", "42"), ("x3", "?!"), ("x4", "a much longer item with enough words")], "item_id string, text string")
    rows = [(1, "once in a BLUE, moon."), (2, "blue moons"), (3, "it is 42"), (4, "it is 421"), (5, "a much longr item with enough words here"), (6, "nothing")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for size in (4_000_000, 10):
        got = sorted((r["doc_id"], r["item_id"], r["budget"]) for r in decontaminate.leaked(docs, bench, block_chars=size).collect())
        assert got == [(1, "x1", 0), (3, "x2", 0), (5, "x4", 2)]
        assert sorted(r["doc_id"] for r in decontaminate.clean(docs, bench, block_chars=size).collect()) == [2, 4, 6]


def test_several_blocks_equal_one(spark, docs, odd):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    for frame in (docs, odd):
        names = [f for f in "row d t n leak found item_id distance budget start stop".split()]
        more = frame.select("*", *[F.lit(n).alias(n) for n in names])
        one, many = (sorted(map(tuple, decontaminate.leaked(more, benchmark, block_chars=c).collect()), key=str) for c in (4_000_000, 1500))
        assert one == many
        kept = [decontaminate.clean(more, benchmark, block_chars=c) for c in (4_000_000, 1500)]
        assert kept[0].columns == kept[1].columns == more.columns
        a, b = (sorted((tuple(r) for r in k.collect()), key=str) for k in kept)
        assert a == b and all(r[len(frame.columns) :] == tuple(names) for r in a)
        x, y = (sorted(((r["doc_id"], sorted(map(tuple, r["leaks"]))) for r in decontaminate.with_leaks(more, benchmark, block_chars=c).collect()), key=str) for c in (4_000_000, 1500))
        assert x == y


def test_whole_table_against_sellers(spark, docs, texts):
    """Every document, whole, against every item by the full table of edit distances, a row at a time in NumPy."""
    import numpy as np

    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r["item_id"]: decontaminate.normalise(r["text"]) for r in benchmark.collect()}
    items = {i: items[i] for i in sorted(items)[:3]}
    few = benchmark.where(F.col("item_id").isin(list(items)))
    want = set()
    for d, t in texts.items():
        text = np.frombuffer(decontaminate.normalise(t).encode("utf-32-le"), np.uint32)
        ramp = np.arange(len(text) + 1)
        for i, p in items.items():
            row = np.zeros(len(text) + 1, np.int64)
            for k, ch in enumerate(map(ord, p), 1):
                new = np.concatenate(([k], np.minimum(row[1:] + 1, row[:-1] + (text != ch))))
                row = np.minimum.accumulate(new - ramp) + ramp  # insertions carry over from the left
            if row.min() <= int(0.08 * len(p)):
                want.add((d, i, int(row.min())))
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in decontaminate.leaked(docs, few).collect()} == want
