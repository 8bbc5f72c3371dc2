"""Language-model scores: a log-bilinear neural model trained with noise-contrastive estimation, beside a unigram base.

Words are ASCII-lower-cased runs without white space; an end token closes every text. Training tokens are counted over all training documents: the
table (word, c) is as large as the vocabulary and stays distributed.

The model predicts the class of a token from the classes of the two before it. The most frequent words (`vocabulary`) are classes of
their own; every other word belongs to one of 64 classes by its last two bytes and has, inside its class, the add-one share of its count,
with one share for the unseen. The score of a token given its context h is (C1 r1 + C2 r2) . t + b, normalised over all classes. Its weights are
learnt in NumPy by NCE with noise from the class counts, from every token of every training document: in each of two passes, each partition starts from the
same weights and walks through its texts, and the weights are averaged by tokens (so they depend a little on how the table is partitioned). Since there are few classes, batched matrix products give the normaliser of every context once; scoring gathers from these tables.

Words are cut, looked up and counted by array: a chunk of texts is one array of words, whatever their length, and no word becomes an object of its own.
Counts of the `dictionary` most frequent words (a bound in rows) travel to the executors; the other words of a document meet the count
table in one join by word, after being pre-aggregated by document.

Null text is empty: it has the end token alone. A null doc_id counts as an empty text for hashes. Repeated rows each get their result and each train; long texts are
learnt and scored whole. An empty table gives an empty result; with nothing to learn from, base and score still are defined: one count of one, and equal classes. Words
of equal count are ordered by their bytes; where the `dictionary` ends among equal counts, all of these are left to the join. Only doc_id, text and what `held_out` names
are read: other columns are not returned, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, materialise

RARE = 64
END = b""
#: Tokens that are counted together, and bytes of text (or one text) that are cut together.
FLUSH, CHUNK = 1 << 21, 1 << 22
#: Training: tokens shuffled together, and tokens a partition should have at least.
BUFFER, LEAST = 1 << 18, 1 << 19
#: Words whose class a task remembers.
MEMO = 100_000


def rare_class(word: bytes) -> int:
    """1 .. RARE, by the last two bytes; 0 is the end token."""
    return 1 + crc32(word[-2:]) % RARE


class _Classes(dict):
    """Words of own classes, and the rare classes of up to MEMO words met: Words.classes() in plain form."""

    def __missing__(self, word: bytes) -> int:
        k = rare_class(word)
        if len(self) < MEMO:
            self[word] = k
        return k


@cache
def _rare_classes() -> np.ndarray:
    """rare_class() by the last byte plus 256 times the one before, then by the byte of words that have one."""
    return np.array([rare_class(bytes((i >> 8, i & 255))) for i in range(1 << 16)] + [rare_class(bytes((i,))) for i in range(256)], np.int32)


class Words:
    """The words of some texts: `words` (one array), `sizes` (words of each text) and `ends` (of the words, in `data`)."""

    def __init__(self, texts: list[bytes | None]) -> None:
        joined = b"".join((b" ", *(x for t in texts for x in (t or b"", b" ")))).lower()
        every = np.frombuffer(joined, np.uint8)
        space = (every == 32) | ((every - np.uint8(9)) < 5)
        edges = np.flatnonzero(space[1:] != space[:-1])  # a word begins after an even one and ends with an odd one
        borders = np.cumsum([0, *(len(t or b"") + 1 for t in texts)])
        self.sizes = np.diff(np.searchsorted(edges[::2], borders))
        self.data = every[~space]
        self.ends = np.cumsum(edges[1::2] - edges[::2])
        offsets = np.concatenate((np.zeros(1, np.int64), self.ends.astype(np.int64)))
        self.words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.ends), [None, pa.py_buffer(offsets), pa.py_buffer(self.data)])

    def find(self, known: pa.Array) -> np.ndarray:
        """Each word's place among the `known`, or -1."""
        return pc.fill_null(pc.index_in(self.words, value_set=known), -1).to_numpy(zero_copy_only=False)

    def rare(self) -> np.ndarray:
        """Each word's rare class."""
        last = self.ends - 1
        single = np.diff(self.ends, prepend=0) == 1
        return _rare_classes()[self.data[last] + np.where(single, 1 << 16, self.data[last - 1].astype(np.int64) << 8)]

    def classes(self, own: pa.Array) -> np.ndarray:
        """Each word's class: that of its own, or its rare one."""
        found = self.find(own)
        return np.where(found < 0, self.rare(), found + 1 + RARE)

    def places(self) -> np.ndarray:
        """Each word's place among all tokens, when an end token follows each text."""
        return np.arange(len(self.ends)) + np.repeat(np.arange(len(self.sizes)), self.sizes)


def binaries(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.large_binary())


def _chunks(texts: pa.Array) -> Iterator[list[bytes | None]]:
    """Texts in order, in lists of up to CHUNK bytes or of one text."""
    part, size = [], 0
    for text in texts.to_pylist():
        if part and size + len(text or b"") > CHUNK:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text or b"")
    if part:
        yield part


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def counted() -> pa.RecordBatch:
        found = pc.value_counts(pa.chunked_array(held, pa.large_binary()))
        words, c = pa.concat_arrays([found.field(0), binaries([END])]), pa.concat_arrays([found.field(1), pa.array([ends], pa.int64())])
        return pa.record_batch([words.cast(pa.binary()), c], names=["word", "c"])

    held, ends, size = [], 0, 0
    for batch in batches:
        for part in _chunks(batch.column(0)):
            held.append(Words(part).words)
            ends, size = ends + len(part), size + len(held[-1])
            if size >= FLUSH:
                yield counted()
                held, ends, size = [], 0, 0
    if ends:
        yield counted()


def word_counts(train: DataFrame) -> DataFrame:
    """(word, c) over all tokens, ends included (as the empty word); partial counts are made before the shuffle."""
    return train.select(F.col("text").cast("binary").alias("text")).mapInArrow(_count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class LogBilinear:
    """Context vectors of two positions, a matrix for each, target vectors and biases; context row K is the start of a text."""

    contexts: np.ndarray  # (K + 1, d)
    first: np.ndarray  # (d, d): the token just before
    second: np.ndarray
    targets: np.ndarray  # (K, d)
    bias: np.ndarray

    def tables(self, block: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores by (previous, class), by (one before, class), and the log normaliser by (one before, previous)."""
        near = (self.contexts @ self.first @ self.targets.T + self.bias).astype(np.float32)
        far = (self.contexts @ self.second @ self.targets.T).astype(np.float32)
        # exp(near + far) summed over classes is a product of exponentials: one matrix product a block.
        shift_n, shift_f = near.max(1, keepdims=True), far.max(1, keepdims=True)
        en, ef = np.exp(near - shift_n).astype(np.float64), np.exp(far - shift_f).astype(np.float64)
        z = np.concatenate([np.log(ef[i : i + block] @ en.T) for i in range(0, len(ef), block)])
        return near, far, (z + shift_f + shift_n.T).astype(np.float32)


def start_weights(weights: np.ndarray, dim: int = 32, seed: int = 1) -> list[np.ndarray]:
    """Parameters before training, in the order of LogBilinear; `weights`: class counts."""
    rng, k = np.random.default_rng(seed), len(weights)
    return [
        rng.normal(0, 0.1, (k + 1, dim)).astype(np.float32),
        np.eye(dim, dtype=np.float32),
        0.5 * np.eye(dim, dtype=np.float32),
        rng.normal(0, 0.1, (k, dim)).astype(np.float32),
        np.log((weights + 1.0) / (weights + 1.0).sum()).astype(np.float32),
    ]


def _sums(rows: int, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of `values` (a matrix) by row number `at`."""
    out = np.zeros((rows, values.shape[1]), np.float32)
    kind = np.float32 if values.shape[1] % 2 else np.complex64  # as complex numbers, two columns are added at once
    into, values = out.view(kind), np.ascontiguousarray(values, np.float32).view(kind)
    width = into.shape[1]
    np.add.at(into.reshape(-1), (at[:, None] * width + np.arange(width)).ravel(), values.ravel())
    return out


class Nce:
    """Noise-contrastive estimation from given parameters on; the noise are the class counts."""

    def __init__(self, params: list[np.ndarray], weights: np.ndarray, seed, batch: int = 2048, noise: int = 64, rate: float = 0.05) -> None:
        self.params = [x.copy() for x in params]
        self.square = [np.full_like(x, 1e-6) for x in params]
        self.rng, self.batch, self.noise, self.rate = np.random.default_rng(seed), batch, noise, rate
        p = (weights + 1.0) / (weights + 1.0).sum()
        self.sums, self.logp = np.cumsum(p)[:-1], np.log(p).astype(np.float32)

    def learn(self, texts: list[np.ndarray]) -> None:
        """One pass in random order over class sequences, ends included. A batch shares its noise, so that scores are matrix products."""
        k, log_noise = len(self.logp), np.float32(np.log(self.noise))
        target = np.concatenate(texts)
        first = np.cumsum([0, *map(len, texts[:-1])])
        before, further = np.roll(target, 1), np.roll(target, 2)
        before[first] = further[first] = k
        further[first[np.diff(first, append=len(target)) > 1] + 1] = k
        order = self.rng.permutation(len(target))
        for at in range(0, len(order), self.batch):
            i = order[at : at + self.batch]
            w, h1, h2 = (x.take(i).astype(np.intp) for x in (target, before, further))
            r, c1, c2, t, b = self.params
            # Products by context, of which there are fewer than tokens; q has a last column of ones, for biases.
            q = np.column_stack((r @ c1, np.ones(k + 1, np.float32))).take(h1, 0)
            q += np.column_stack((r @ c2, np.zeros(k + 1, np.float32))).take(h2, 0)
            tw = t.take(w, 0)
            drawn = np.searchsorted(self.sums, self.rng.random(self.noise), side="right")
            tn = t[drawn]
            # The odds that a token is data and not one of the noise: s - log(noise * p).
            data = 1 / (1 + np.exp(-np.clip(np.einsum("ij,ij->i", q[:, :-1], tw) + b[w] - log_noise - self.logp[w], -30, 30)))
            gf = q @ -np.column_stack((tn, b[drawn] - log_noise - self.logp[drawn])).T
            with np.errstate(over="ignore"):  # beyond all numbers: odds of 0
                np.exp(gf, out=gf)
            gf += 1
            np.divide(np.float32(-1 / len(i)), gf, out=gf)  # minus the odds of the noise, by token
            gd = (1 - data) / np.float32(len(i))
            gq = gf @ tn
            tw *= gd[:, None]
            gq += tw
            by_noise = gf.T @ q
            near, far = _sums(k + 1, h1, gq), _sums(k + 1, h2, gq)
            grads = [
                near @ c1.T,
                r.T @ near,
                r.T @ far,
                _sums(k, w, gd[:, None] * q[:, :-1]) + _sums(k, drawn, by_noise[:, :-1]),
                (np.bincount(w, gd, k) + np.bincount(drawn, by_noise[:, -1], k)).astype(np.float32),
            ]
            for x, g, s in zip(self.params, grads, self.square, strict=True):
                s += g * g
                step = np.sqrt(s)
                np.divide(g, step, out=step)
                step *= self.rate
                x += step


def _mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (n, weights) -> their mean by n, and the sum of n."""
    total, mean = 0, np.zeros(0)
    for batch in batches:
        for n, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x = np.frombuffer(w, np.float32).astype(np.float64)
            total += n
            mean = mean + (x - mean) * (n / total) if len(mean) else x
    if total:
        yield pa.record_batch([pa.array([total], pa.int64()), pa.array([mean.astype(np.float32).tobytes()], pa.binary())], names=["n", "weights"])


def train_nce(texts: DataFrame, own: list[bytes], weights: np.ndarray, tokens: int, epochs: int = 2, seed: int = 1) -> LogBilinear:
    """`texts` (text: binary), all of which teach; `own`: words with a class of their own; `weights`: class counts; `tokens` in all."""
    params = start_weights(weights, seed=seed)
    context = texts.sparkSession.sparkContext
    parts = texts.coalesce(max(1, tokens // LEAST))
    for epoch in range(epochs):
        sent = context.broadcast((params, weights, own))

        def learn(batches: Iterator[pa.RecordBatch], sent=sent, epoch=epoch) -> Iterator[pa.RecordBatch]:
            task = TaskContext.get()
            params, weights, own = sent.value
            model = Nce(params, weights, (seed, epoch, task.partitionId() if task else 0))
            own = binaries(own)
            seen, held, waiting = 0, 0, []
            for batch in batches:
                for part in _chunks(batch.column(0)):
                    words = Words(part)
                    tokens = np.zeros(len(words.ends) + len(part), np.int32)
                    tokens[words.places()] = words.classes(own)
                    for text in np.split(tokens, np.cumsum(words.sizes + 1)[:-1]):
                        waiting.append(text)
                        held += len(text)
                        if held >= BUFFER:
                            model.learn(waiting)
                            seen, held, waiting = seen + held, 0, []
            if waiting:
                model.learn(waiting)
                seen += held
            if seen:
                flat = np.concatenate([x.ravel() for x in model.params]).tobytes()
                yield pa.record_batch([pa.array([seen], pa.int64()), pa.array([flat], pa.binary())], names=["n", "weights"])

        schema = "n long, weights binary"
        found = parts.mapInArrow(learn, schema).repartition(8).mapInArrow(_mean, schema).collect()
        sent.unpersist()
        if found:
            flat = sum(np.frombuffer(r["weights"], np.float32) * (r["n"] / sum(x["n"] for x in found)) for r in found).astype(np.float32)
            cuts = np.cumsum([x.size for x in params])[:-1]
            params = [x.reshape(p.shape) for x, p in zip(np.split(flat, cuts), params, strict=True)]
    return LogBilinear(*params)


@dataclass
class Scorer:
    """What the executors need: the dictionary with its counts, and the model's tables."""

    words: list[bytes]  # by falling count; the first `own` have classes of their own
    counts: np.ndarray
    own: int
    base_log: float  # log10 of the base's denominator
    class_log: np.ndarray  # log10 of each class's denominator
    near: np.ndarray
    far: np.ndarray
    z: np.ndarray
    known_end: bool
    end_log: float

    def ready(self) -> Scorer:
        self.known = binaries(self.words)
        rare = np.array([rare_class(w) for w in self.words], np.int32)
        mine = np.arange(len(self.words), dtype=np.int32)
        self.classes = np.where(mine < self.own, mine + 1 + RARE, rare)
        lc = np.log10(self.counts + 1.0)
        # The last of these is for words that the dictionary lacks.
        self.base = np.append(lc - self.base_log, 0.0)
        self.inner = np.append(np.where(mine < self.own, 0.0, lc - self.class_log[rare]), 0.0)
        return self

    def texts(self, texts: list[bytes | None]) -> tuple[list[np.ndarray], pa.Array]:
        """Of each text its tokens, known tokens, base and score as far as the dictionary goes; and the words that it lacks, with class and number."""
        words = Words(texts)
        found, rare, places = words.find(self.known), words.rare(), words.places()
        tokens = words.sizes + 1
        ends = np.cumsum(tokens)
        first = ends - tokens
        classes = np.zeros(ends[-1], np.int64)
        classes[places] = np.where(found < 0, rare, np.append(self.classes, 0)[found])
        start = len(self.near) - 1
        before, further = np.roll(classes, 1), np.roll(classes, 2)
        before[first] = further[first] = further[first[tokens > 1] + 1] = start
        k = self.near.shape[1]
        by_token = self.near.ravel()[before * k + classes] + self.far.ravel()[further * k + classes] - self.z.ravel()[further * (k + 1) + before]

        def sums(of_words: np.ndarray) -> np.ndarray:
            """By text, of a value a word."""
            full = np.zeros(ends[-1])
            full[places] = of_words
            return np.add.reduceat(full, first)

        known = sums(found >= 0).astype(np.int64) + self.known_end
        model = np.add.reduceat(by_token.astype(np.float64), first) / np.log(10)
        lacks = np.flatnonzero(found < 0)
        missing = pc.dictionary_encode(words.words.take(pa.array(lacks)))
        code, several = missing.indices.to_numpy().astype(np.int64), max(1, len(missing.dictionary))
        pair, one, n = np.unique((places[lacks] - lacks) * several + code, return_index=True, return_counts=True)
        row = pa.StructArray.from_arrays(
            [missing.dictionary.take(pa.array(pair % several)).cast(pa.binary()), pa.array(rare[lacks[one]], pa.int32()), pa.array(n, pa.int32())], names=["w", "k", "n"]
        )
        offsets = np.searchsorted(pair // several, np.arange(len(texts) + 1))
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), row)
        return [tokens, known, sums(self.base[found]) + self.end_log, model + sums(self.inner[found])], lists


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words above a count, as low as `most` words allow: found by counting words by the logarithm of their counts (some thousand rows),
    so that no task sends more than its part of the result."""
    step = F.floor(F.log2("c") * 64).cast("int")
    left, cut = most, None
    for r in sorted(counts.groupBy(step.alias("s")).count().collect(), key=lambda r: -r["s"]):
        if (left := left - r["count"]) < 0:
            break
        cut = r["s"]
    return counts.where(step >= cut) if cut is not None else counts.limit(0)


def train(docs: DataFrame, counts: DataFrame, vocabulary: int = 900, dictionary: int = 200_000, seed: int = 1) -> tuple[Scorer, int, np.ndarray]:
    """A scorer from training documents and their count table; also the training tokens and log10 of the classes' denominators."""
    last = F.crc32(F.substring("word", -2, 2))
    by_class = counts.where(F.length("word") > 0).groupBy((1 + last % RARE).cast("int").alias("k")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    ends = int(counts.where(F.length("word") == 0).agg(F.sum("c")).first()[0] or 0)
    top = sorted(most_frequent(counts.where(F.length("word") > 0), dictionary).collect(), key=lambda r: (-r["c"], r["word"]))
    words, c = [bytes(r["word"]) for r in top], np.array([r["c"] for r in top], np.int64)
    total = ends + sum(r["n"] for r in by_class)
    distinct = (ends > 0) + sum(r["v"] for r in by_class)
    own = min(vocabulary, len(words))
    k = 1 + RARE + own
    n, v = np.zeros(1 + RARE), np.zeros(1 + RARE)
    for r in by_class:
        n[r["k"]], v[r["k"]] = r["n"], r["v"]
    for w, x in zip(words[:own], c[:own], strict=True):
        n[rare_class(w)] -= x
        v[rare_class(w)] -= 1
    class_log = np.log10(n + v + 1)
    n[0] = ends

    texts = docs.select(F.col("text").cast("binary").alias("text"))
    near, far, z = train_nce(texts, words[:own], np.concatenate([n, c[:own]]), int(total), seed=seed).tables()
    base_log = float(np.log10(total + distinct + 1))
    return Scorer(words, c, own, base_log, class_log, near, far, z, ends > 0, float(np.log10(ends + 1)) - base_log), total, class_log


_PARTS = "doc_id {id}, held_out boolean, n_tokens long, known long, base double, model double, rare array<struct<w: binary, k: int, n: int>>"


def score(docs: DataFrame, held_out, vocabulary: int = 900, dictionary: int = 200_000, seed: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row; learnt from rows where the column `held_out` is false."""
    spark = docs.sparkSession
    arrow_batches(spark)
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    training = rows.where(~F.col("held_out"))
    counts = materialise(word_counts(training), "counts")
    scorer, total, class_log = train(training, counts, vocabulary, dictionary, seed=seed)
    sent = spark.sparkContext.broadcast(scorer)
    made: list[Scorer] = []

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            made.append(sent.value.ready())
        for batch in batches:
            at = 0
            for part in _chunks(batch.column(2)):
                (tokens, known, base, model), rare = made[0].texts(part)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(at, len(part)),
                        batch.column(1).slice(at, len(part)),
                        pa.array(tokens, pa.int64()),
                        pa.array(known, pa.int64()),
                        pa.array(base, pa.float64()),
                        pa.array(model, pa.float64()),
                        rare,
                    ],
                    names=["doc_id", "held_out", "n_tokens", "known", "base", "model", "rare"],
                )
                at += len(part)

    kind = docs.schema["doc_id"].dataType.simpleString()
    done = rows.select("doc_id", "held_out", F.col("text").cast("binary")).mapInArrow(parts, _PARTS.format(id=kind))
    done = materialise(done.withColumn("uid", F.monotonically_increasing_id()), "scored")

    denominators = F.element_at(F.array(*[F.lit(float(x)) for x in class_log]), F.col("x.k") + 1)
    rare = done.select("uid", F.explode("rare").alias("x")).select("uid", F.col("x.w").alias("word"), F.col("x.n").alias("n"), denominators.alias("d"))
    seen = rare.join(counts, "word", "left").withColumn("lc", F.log10(F.coalesce("c", F.lit(0)) + 1.0))
    sums = seen.groupBy("uid").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known2"),
        F.sum(F.col("n") * (F.col("lc") - scorer.base_log)).alias("base2"),
        F.sum(F.col("n") * (F.col("lc") - F.col("d"))).alias("model2"),
    )
    return done.drop("rare").join(sums, "uid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("known2", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("base2", F.lit(0.0))).alias("base_score"),
        (F.col("model") + F.coalesce("model2", F.lit(0.0))).alias("score"),
    )
