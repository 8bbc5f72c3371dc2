import numpy as np
from pyspark.sql import functions as F

from starloom.llm import langid, queries
from starloom.llm.common import crc_mod


def test_held_out_accuracy(docs, crc):
    model = queries.language_model(docs)
    got = langid.identify(docs.withColumn("score", F.lit("x")), model).where(crc_mod(F.col("doc_id"), 4) == 2).toPandas()
    assert len(got) > 20 and (got.lang == got.lang_pred).mean() >= 0.95 and got.score.between(0, 1).all()


def test_labels_and_ids_are_no_inputs(docs):
    model = queries.language_model(docs)
    a = langid.identify(docs, model).select("text", "lang_pred", "score")
    b = langid.identify(docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string")).withColumn("doc_id", -F.col("doc_id")), model).select("text", "lang_pred", "score")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_odd_rows(docs, odd, none):
    model = queries.language_model(docs)
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(odd, model).collect()]
    assert {i: (p, s) for i, p, s in got if i in (1, 2, 3, 6)} == dict.fromkeys((1, 2, 3, 6), ("und", 0.0))
    assert all(p in ("de", "en", "es", "fr") for i, p, _ in got if i not in (1, 2, 3, 6)) and len(got) == odd.count()
    assert langid.identify(none, model).count() == 0
    untaught = langid.fit_profiles(langid.sample(none))
    assert {r["lang_pred"] for r in langid.identify(odd, untaught).collect()} == {"und"}


def test_profile_does_not_depend_on_slices(monkeypatch):
    text = "abc dé fgh " * 300
    want = langid.profile(text)
    monkeypatch.setattr(langid, "SLICE", 37)
    assert np.allclose(langid.profile(text), want)


def test_many_languages_of_one_family():
    alphabets = {"sv": "abc", "da": "abd", "no": "xyz", "ru": "жзи", "uk": "жзї", "qq": "123k"}
    rng = np.random.default_rng(0)
    text = lambda s, n: " ".join("".join(rng.choice(list(s), 5)) for _ in range(n))
    model = langid.fit([(text(s, 30), lang) for lang, s in alphabets.items() for _ in range(8)])
    assert model.families == ("germanic", "only qq", "slavic")
    assert all(model.predict(text(s, 20))[0] == lang for lang, s in alphabets.items())


def test_letters():
    assert not langid.has_letter(None) and not langid.has_letter("12 ½ ² _ \n") and langid.has_letter("12 漢")


def test_every_prediction_against_plain_loops(docs, texts):
    """Each step again, without matrix products over blocks: trigrams from a dictionary, family by softmax, votes of every pair."""
    model = queries.language_model(docs)
    index = {f: i for i, f in enumerate(model.families)}
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(docs, model).collect()}
    for i, text in texts.items():
        if not text or not any(c.isalpha() for c in text):
            assert got[i] == ("und", 0.0)
            continue
        data, counts = f" {text.lower()} ".encode(), {}
        for k in range(len(data) - 2):
            h = int.from_bytes(data[k : k + 3], "little") * 2654435761 % 2**32 >> 32 - langid.BITS
            counts[h] = counts.get(h, 0) + 1
        norm = sum(counts.values()) ** 0.5
        z = model.bias.astype(float) + sum(model.weights[h].astype(float) * c**0.5 / norm for h, c in counts.items())
        odds = np.exp(z[: len(index)])
        family = int(odds.argmax())
        names, score = model.members[family], odds[family] / odds.sum()
        wins, sure = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0)
        for (f, a, b), m in zip(model.pairs, z[len(index) :], strict=True):
            if f == family:
                wins[names[a] if m >= 0 else names[b]] += 1
                sure[names[a]] += 1 / (1 + np.exp(-4 * m))
                sure[names[b]] += 1 / (1 + np.exp(4 * m))
        assert max(wins.values()) == len(names) - 1 or len(names) > 2
        if list(wins.values()).count(max(wins.values())) == 1:
            best = max(names, key=wins.get)
            assert got[i][0] == best and abs(got[i][1] - score * (sure[best] / (len(names) - 1) if len(names) > 1 else 1)) < 1e-3


def test_long_texts_teach(spark):
    """A language that only very long texts have is learnt."""
    rows = [(i, "abc def " * 30, "xx") for i in range(20)] + [(100 + i, "жзи клм " * 30_000, "yy") for i in range(3)]
    model = langid.fit_profiles(langid.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    assert model.predict("жзи клм жзи")[0] == "yy" and model.predict("def abc")[0] == "xx"


def test_every_column_stays(docs):
    names = "row found _p p lang_predx text2".split()
    more = docs.select("*", *[F.lit(n).alias(n) for n in names])
    out = langid.identify(more, queries.language_model(docs))
    assert out.columns == [*more.columns, "lang_pred", "score"] and all(r[n] == n for r in out.collect() for n in names)


def test_batches_without_letters(spark):
    """Rows that teach nothing, alone in their batch, are no error."""
    rows = [(i, "12345 67890 !!!", "en") for i in range(4)] + [(9, "abc def", "xx")]
    found = langid.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5))
    assert {lang for lang, _ in found} == {"xx"}
    assert langid.sample(spark.createDataFrame(rows[:4], "doc_id long, text string, lang string")) == []
