"""Language identification by hierarchical discrimination: the family first, then one-versus-one linear SVMs inside it.

Features are hashed byte trigrams of the lower-cased text, square-rooted and scaled to unit length. A softmax over
the families picks one; in a family with several languages, every pair has its own squared-hinge linear support vector machine,
and the language with most votes wins (ties: larger margins, then code point). The score is the family's probability times the mean
squashed margin of the winner over its rivals, 0 to 1.

Learning uses a bounded, hash-chosen sample (about `per_language` rows a language), of which whole texts are profiled in the executors; prediction reads whole texts.
Null text, and text without any letter, is `und` with score 0; so is everything if nothing was there to learn from. Labels that are
null, and rows with such texts, teach nothing. Languages that FAMILIES lacks form a family each. Equal texts get equal results, repeated rows each their own; ties
go by votes, margins, then code point. An empty table gives an empty one. Other columns stay, whatever their names; only `lang_pred` and `score` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, hash31, id_text, sample_below, without

UNDETERMINED = "und"
BITS = 13
SLICE = 1 << 20
# Families of common languages by code.
FAMILIES = {
    **dict.fromkeys(("af", "da", "de", "en", "is", "nl", "no", "sv"), "germanic"),
    **dict.fromkeys(("ca", "es", "fr", "gl", "it", "pt", "ro"), "romance"),
    **dict.fromkeys(("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"), "slavic"),
    **dict.fromkeys(("et", "fi", "hu"), "uralic"),
    **dict.fromkeys(("az", "kk", "tr", "uz"), "turkic"),
}


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def profile(text: str) -> np.ndarray:
    """Unit vector of hashed byte trigrams, counted over the whole text a slice at a time."""
    data = np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.zeros(1 << BITS, np.float32)
    for at in range(0, max(1, len(data) - 2), SLICE):
        b = data[at : at + SLICE + 2].astype(np.uint32)
        tri = b[:-2] | b[1:-1] << 8 | b[2:] << 16
        counts += np.bincount(tri * np.uint32(2654435761) >> np.uint32(32 - BITS), minlength=1 << BITS)
    np.sqrt(counts, out=counts)
    return counts / (np.linalg.norm(counts) or 1)


@dataclass(frozen=True)
class LanguageModel:
    families: tuple[str, ...]
    members: tuple[tuple[str, ...], ...]
    weights: np.ndarray  # columns: families, then every pair inside a family
    bias: np.ndarray
    pairs: tuple[tuple[int, int, int], ...]  # family, member, member

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]

    def predict_all(self, texts: list[str | None], block: int = 256) -> list[tuple[str, float]]:
        """One matrix product for each block of texts."""
        out = [(UNDETERMINED, 0.0)] * len(texts)
        if not self.families:
            return out
        known = [i for i, t in enumerate(texts) if has_letter(t)]
        for at in range(0, len(known), block):
            some = known[at : at + block]
            z = np.stack([profile(texts[i]) for i in some]) @ self.weights + self.bias
            for i, row in zip(some, z, strict=True):
                out[i] = self._decide(row)
        return out

    def _decide(self, z: np.ndarray) -> tuple[str, float]:
        f = z[: len(self.families)]
        p = np.exp(f - f.max())
        family = int(f.argmax())
        score, names = float(p[family] / p.sum()), self.members[family]
        if len(names) == 1:
            return names[0], score
        votes, margins, sure = np.zeros(len(names)), np.zeros(len(names)), np.zeros(len(names))
        for (fam, a, b), m in zip(self.pairs, z[len(self.families) :], strict=True):
            if fam == family:
                votes[a if m >= 0 else b] += 1
                margins[a] += m
                margins[b] -= m
                s = 1 / (1 + np.exp(-4 * np.clip(m, -20, 20)))
                sure[a] += s
                sure[b] += 1 - s
        best = max(range(len(names)), key=lambda i: (votes[i], margins[i], -i))
        return names[best], score * float(sure[best] / (len(names) - 1))


def _descend(x: np.ndarray, grad_of, outputs: int, steps: int, rate: float, decay: float) -> tuple[np.ndarray, np.ndarray]:
    """Nesterov's accelerated gradient on a linear model; grad_of(z) is the loss's gradient by output, averaged over rows."""
    w, b = np.zeros((x.shape[1], outputs), np.float32), np.zeros(outputs, np.float32)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(steps):
        g = grad_of(x @ (w + 0.9 * vw) + b + 0.9 * vb).astype(np.float32)
        vw = 0.9 * vw - rate * (x.T @ g + decay * w)
        vb = 0.9 * vb - rate * 0.1 * g.sum(0)
        w, b = w + vw, b + vb
    return w, b


def lessons(text: str) -> list[np.ndarray]:
    """Profiles that a text teaches: its own, and that of its first 2 to 10 words alone (by a hash), so that short texts are known too."""
    short = " ".join(text.split()[: 2 + crc32(text.encode("utf-8", "surrogatepass")) % 9])
    return [profile(t) for t in (text, short) if has_letter(t)]


def fit(rows: list[tuple[str, str]], families: dict[str, str] = FAMILIES, steps: int = 150) -> LanguageModel:
    """From (text, language) pairs."""
    return fit_profiles([(lang, x) for text, lang in rows if lang is not None and has_letter(text) for x in lessons(text)], families, steps)


def fit_profiles(rows: list[tuple[str, np.ndarray]], families: dict[str, str] = FAMILIES, steps: int = 150) -> LanguageModel:
    """From (language, profile) pairs, in any order."""
    if not rows:
        return LanguageModel((), (), np.zeros((1 << BITS, 0), np.float32), np.zeros(0, np.float32), ())
    rows = sorted(rows, key=lambda r: (r[0], r[1].tobytes()))
    x = np.stack([v for _, v in rows])
    langs = sorted({lang for lang, _ in rows})
    family_of = {lang: families.get(lang, f"only {lang}") for lang in langs}
    names = sorted(set(family_of.values()))
    members = [tuple(lang for lang in langs if family_of[lang] == f) for f in names]
    y = np.array([names.index(family_of[lang]) for lang, _ in rows])
    # Every language weighs the same, however many rows it has.
    lang_of = np.array([langs.index(lang) for lang, _ in rows])
    weight = (1 / np.bincount(lang_of))[lang_of] / len(langs)
    target = np.eye(len(names))[y]

    def softmax_grad(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(1, keepdims=True))
        return (e / e.sum(1, keepdims=True) - target) * weight[:, None]

    ws, bs = [], []
    w, b = _descend(x, softmax_grad, len(names), steps, 20.0, 1e-5)
    ws.append(w)
    bs.append(b)
    pairs = []
    for f, group in enumerate(members):
        for i, j in combinations(range(len(group)), 2):
            keep = np.isin(lang_of, (langs.index(group[i]), langs.index(group[j])))
            sign = np.where(lang_of[keep] == langs.index(group[i]), 1.0, -1.0)[:, None]
            rate = weight[keep][:, None] / weight[keep].sum()
            w, b = _descend(x[keep], lambda z, s=sign, r=rate: -s * np.maximum(0, 1 - s * z) * r, 1, steps, 5.0, 1e-4)
            ws.append(w)
            bs.append(b)
            pairs.append((f, i, j))
    return LanguageModel(tuple(names), tuple(members), np.hstack(ws), np.concatenate(bs), tuple(pairs))


def sample(docs: DataFrame, per_language: int = 250, seed: int = 8) -> list[tuple[str, np.ndarray]]:
    """(lang, profile) of about `per_language` rows of each language, by a hash of the id; the counts come from all rows. Texts stay in the executors."""
    arrow_batches(docs.sparkSession)
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    counts = known.groupBy("lang").count()
    below = {r["lang"]: sample_below(r["count"], per_language) for r in counts.collect()}  # a row a language
    threshold = F.element_at(F.create_map(*[F.lit(x) for kv in below.items() for x in kv]), F.col("lang")) if below else F.lit(0)
    picked = known.where(hash31(F.lit(seed), id_text(F.col("doc_id"))) < threshold)

    def teach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(lang, x) for lang, text in zip(batch["lang"], batch["text"], strict=True) if has_letter(text) for x in lessons(text)]
            if not found:  # texts without letters teach nothing, and columns without values have no type that Arrow turns into text
                continue
            at = [np.flatnonzero(x) for _, x in found]
            yield pd.DataFrame({"lang": [lang for lang, _ in found], "at": [i.astype(np.int32).tobytes() for i in at], "x": [x[i].tobytes() for i, (_, x) in zip(at, found, strict=True)]})

    out = []
    for r in picked.select("lang", "text").mapInPandas(teach, "lang string, at binary, x binary").collect():
        x = np.zeros(1 << BITS, np.float32)
        x[np.frombuffer(r["at"], np.int32)] = np.frombuffer(r["x"], np.float32)
        out.append((r["lang"], x))
    return out


def predicted(docs: DataFrame, model: LanguageModel, text: str = "text") -> Column:
    """struct<lang_pred, score> of every text; the model goes to the executors as a broadcast of fixed size."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame(sent.value.predict_all(batch.tolist()), columns=["lang_pred", "score"])

    return F.pandas_udf(predict, "struct<lang_pred string, score double>").asNondeterministic()(F.col(text))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """All rows and columns, with lang_pred and score; input columns of those names are replaced."""
    arrow_batches(docs.sparkSession)
    kept = without(docs, "lang_pred", "score")
    rows = kept.select(F.struct("*").alias("row"), predicted(docs, model, text).alias("found"))
    return rows.select("row.*", F.col("found.lang_pred").alias("lang_pred"), F.col("found.score").alias("score"))
