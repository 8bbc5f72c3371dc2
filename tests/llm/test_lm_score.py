import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starloom.llm import lm_score
from starloom.llm.common import crc_mod


def held():
    return crc_mod(F.col("doc_id"), 7) == 2


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def expected(rows, crc):
    c = Counter()
    for i, t in rows:
        if crc(i, 7) != 2:
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    return c, n, v, lambda t: sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t))


@pytest.mark.parametrize("dictionary", [60, 200_000])
def test_base_is_exact_and_the_model_beats_it(docs, texts, crc, dictionary):
    got = lm_score.score(docs, held(), vocabulary=300, dictionary=dictionary).toPandas()
    c, n, _, base = expected(texts.items(), crc)
    assert len(got) == len(texts) and (got.train_tokens == n).all()
    for r in got.itertuples():
        words = tokens(texts[r.doc_id])
        assert abs(r.base_score - base(texts[r.doc_id])) < 1e-6 and r.n_tokens == len(words) and r.n_known == sum(c[w] > 0 for w in words)
        assert r.held_out == (crc(r.doc_id, 7) == 2)
    unseen = got[got.held_out]
    assert unseen.score.sum() > unseen.base_score.sum()


def test_distribution_sums_to_one(docs):
    train = docs.where(~held())
    counts = lm_score.word_counts(train).cache()
    scorer, _, class_log = lm_score.train(train, counts, vocabulary=50, dictionary=400)
    s = np.exp(scorer.near[:, None, :].astype(float) + scorer.far[None, :, :] - scorer.z.T[:, :, None]).sum(2)
    assert np.allclose(s, 1, atol=1e-4)
    # Inside a rare class, the shares of its words and of the unseen sum to 1.
    own = set(scorer.words[:50])
    total = Counter()
    for r in counts.collect():
        w = bytes(r["word"])
        if w and w not in own:
            total[lm_score.rare_class(w)] += r["c"] + 1
    assert all(abs((n + 1) / 10 ** class_log[k] - 1) < 1e-9 for k, n in total.items())


def test_odd_rows(odd, crc):
    got = lm_score.score(odd, held(), vocabulary=5).toPandas()
    assert len(got) == odd.count() and np.isfinite(got.score).all() and np.isfinite(got.base_score).all()
    by = {(None if np.isnan(r.doc_id) else int(r.doc_id)): r for r in got.itertuples()}
    assert by[1].n_tokens == by[2].n_tokens == by[3].n_tokens == 1 and by[7].n_tokens == 200_001
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    *_, base = expected(rows, crc)
    assert abs(by[7].base_score - base("word " * 200_000)) < 1e-3


def test_empty_tables(none, odd):
    assert lm_score.score(none, held()).count() == 0
    untrained = lm_score.score(odd, F.lit(True)).toPandas()
    assert (untrained.train_tokens == 0).all() and (untrained.base_score == 0).all() and np.isfinite(untrained.score).all()


def test_extra_columns(docs):
    assert lm_score.score(docs.withColumn("score", F.lit("x")).withColumn("word", F.lit(1)).limit(20), held()).count() == 20


def test_every_document_teaches(spark):
    """What stands in one very long text only is learnt."""
    cycle = [f"p{i}" for i in range(10)]
    rows = [(i, " ".join(f"q{(i * 7 + j * j) % 50}" for j in range(20)), False) for i in range(300)]
    rows += [(1000, " ".join(cycle * 20_000), False), (1001, " ".join(cycle * 20), True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held boolean")
    got = lm_score.score(docs, F.col("held")).where("held_out").first()
    assert got["score"] > 0.5 * got["base_score"]


def test_tables_equal_the_softmax():
    """Scores and normalisers of every context, one at a time."""
    rng = np.random.default_rng(4)
    k, d = 7, 3
    m = lm_score.LogBilinear(rng.normal(size=(k + 1, d)), rng.normal(size=(d, d)), rng.normal(size=(d, d)), rng.normal(size=(k, d)), rng.normal(size=k))
    near, far, z = m.tables(block=2)
    for h1 in range(k + 1):
        for h2 in range(k + 1):
            s = [(m.contexts[h1] @ m.first + m.contexts[h2] @ m.second) @ m.targets[w] + m.bias[w] for w in range(k)]
            total = math.log(sum(math.exp(x) for x in s))
            assert all(abs(near[h1, w] + far[h2, w] - z[h2, h1] - (s[w] - total)) < 1e-4 for w in range(k))


@pytest.mark.parametrize("dictionary", [60, 200_000])
def test_every_score_against_plain_loops(docs, texts, crc, dictionary):
    """The model's probability of every token: its class given the two classes before, times the word's share of its class, with counts from a plain dictionary."""
    train = docs.select("doc_id", "text", held().alias("held_out")).where("NOT held_out")
    counts = lm_score.word_counts(train).cache()
    scorer, _, _ = lm_score.train(train, counts, vocabulary=40, dictionary=dictionary)
    own = {w: i + 1 + lm_score.RARE for i, w in enumerate(scorer.words[:40])}
    c, *_ = expected(texts.items(), crc)
    in_class = {}
    for w, n in c.items():
        if w and w not in own:
            k = lm_score.rare_class(w)
            in_class[k] = in_class.get(k, 0) + n + 1
    start = len(scorer.near) - 1
    got = {r["doc_id"]: r["score"] for r in lm_score.score(docs, held(), vocabulary=40, dictionary=dictionary).collect()}
    for i, text in texts.items():
        h1 = h2 = start
        want = 0.0
        for w in tokens(text):
            k = 0 if not w else own.get(w) or lm_score.rare_class(w)
            want += float(scorer.near[h1, k] + scorer.far[h2, k] - scorer.z[h2, h1]) / math.log(10)
            if w and w not in own:
                want += math.log10((c[w] + 1) / (in_class.get(k, 0) + 1))
            h1, h2 = k, h1
        assert abs(got[i] - want) < 1e-4 * max(1, abs(want)), i


def test_remembered_classes(monkeypatch):
    """Classes are the same whether or not there is room to remember them."""
    monkeypatch.setattr(lm_score, "MEMO", 3)
    got, words = lm_score._Classes({b"own": 70}), [b"own", b"abc", b"xbc", b"q", b"abc", b"last", b"own"]
    assert [*map(got.__getitem__, words)] == [70 if w == b"own" else lm_score.rare_class(w) for w in words] and len(got) == 3


ODD = [None, b"", b" \t", b"a", b"One two\nONE  a\x00b\x0b\xc3\x89t\xc3\xa9 \x1c\x85 \xff\xfe", b"x", b"  lead and trail\r\n", b"b " * 50, b"long" * 500 + b" a"]


@pytest.mark.parametrize("chunk", [1, 40, 1 << 22])
def test_words_by_array_equal_words_one_by_one(monkeypatch, chunk):
    """Cut, looked up and counted by array, in chunks of any size, words are what bytes.split() gives, and so are their counts."""
    monkeypatch.setattr(lm_score, "CHUNK", chunk)
    monkeypatch.setattr(lm_score, "FLUSH", 5)
    plain = [(t or b"").lower().split() for t in ODD]
    own = [b"one", b"a", b"long" * 500]
    classes = lm_score._Classes({w: i + 1 + lm_score.RARE for i, w in enumerate(own)})
    parts = [*lm_score._chunks(pa.array(ODD, pa.binary()))]
    assert [t for part in parts for t in part] == ODD and (len(parts) > 1) == (chunk < 1 << 22)
    cut = [lm_score.Words(part) for part in parts]
    assert [w for x in cut for w in x.words.to_pylist()] == [w for words in plain for w in words]
    assert [n for x in cut for n in x.sizes] == [*map(len, plain)]
    assert [k for x in cut for k in x.classes(lm_score.binaries(own))] == [classes[w] for words in plain for w in words]
    counted = Counter()
    for out in lm_score._count(iter([pa.record_batch([pa.array(ODD[i : i + 4], pa.binary())], names=["text"]) for i in range(0, len(ODD), 4)])):
        for w, n in zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True):
            counted[w] += n
    assert counted == Counter(w for words in plain for w in (*words, b""))


def test_training_step_against_plain_gradients():
    """One batch of training, token by token: gradients of the noise-contrastive objective, then Adagrad."""
    rng = np.random.default_rng(2)
    texts = [np.array([*rng.integers(1, 8, n), 0], np.int32) for n in (0, 1, 2, 9)]
    weights = np.arange(8, 0, -1.0)
    model, rng = lm_score.Nce(lm_score.start_weights(weights, dim=5), weights, 3, noise=4), np.random.default_rng(3)
    r, c1, c2, t, b = (x.astype(float) for x in model.params)
    model.learn(texts)
    total = sum(map(len, texts))
    rng.permutation(total)
    p = (weights + 1) / (weights + 1).sum()
    drawn = np.searchsorted(np.cumsum(p)[:-1], rng.random(4), side="right")
    want = [np.zeros_like(x) for x in (r, c1, c2, t, b)]
    for text in texts:
        for at, w in enumerate(text):
            h1, h2 = (text[at - i] if at >= i else 8 for i in (1, 2))
            q, gq = r[h1] @ c1 + r[h2] @ c2, np.zeros(5)
            for k, is_data in [(w, 1), *((k, 0) for k in drawn)]:
                g = (is_data - 1 / (1 + np.exp(-(q @ t[k] + b[k] - np.log(4 * p[k]))))) / total
                gq += g * t[k]
                want[3][k] += g * q
                want[4][k] += g
            want[0][h1] += c1 @ gq
            want[1] += np.outer(r[h1], gq)
            want[2] += np.outer(r[h2], gq)
    for got, x, g in zip(model.params, (r, c1, c2, t, b), want, strict=True):
        assert np.allclose(got, x + 0.05 * g / np.sqrt(1e-6 + g * g), atol=1e-4)
