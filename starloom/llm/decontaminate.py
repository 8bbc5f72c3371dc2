"""Benchmark decontamination by pigeonhole edit matching.

A benchmark item of m characters (normalised: lower case, runs of ASCII other than letters and digits become one space) may occur in a text with up
to k = floor(rate * m) edits. It is split into k + 1 pieces: k edits leave at least one piece intact. One Aho-Corasick automaton finds the exact hits of
all pieces of all items in a text; around each hit the item is verified with Myers' bit-parallel distance (semi-global: anywhere in the
window). Before that comes the q-gram lemma, which only drops windows that cannot be within the budget.

Items of fewer than `min_words` words have a budget of 0 and count where they stand as whole words.

The items are a stated set matched against all documents. They are read in blocks of at most `block_chars` characters; each block is broadcast and has a pass over
the documents of its own, whose findings are written before the next block is read. So what is broadcast, and what a worker holds, is bounded at any benchmark size.

Null or empty texts match nothing; null items and items without a letter or digit are no evidence and are left out. Equal items match alike, each under
its own id, whose type is the benchmark's. Repeated rows each get their result; rows with equal doc_id and text are one document. Of equally good places of an item the
first counts. Empty tables give empty results, an empty benchmark leaves all documents. Other columns stay, whatever their names, but for `leaks` in with_leaks().
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, materialise, text_key, without

Q = 4
_GAP = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
FIELDS = ("item_id", "distance", "budget", "start", "stop")
MIN_WORDS = 5


def normalise(text: str | None) -> str:
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_GAP).split()).decode() if text else ""


def myers(pattern_masks: dict[str, int], m: int, text: str, most: int) -> tuple[int, int] | None:
    """(distance, end) of the best approximate occurrence of a pattern of m characters in the text, the first of equals; None if beyond `most`."""
    full, last = (1 << m) - 1, 1 << m - 1
    pv, mv, score, best, at = full, 0, m, most + 1, -1
    get = pattern_masks.get
    for i, ch in enumerate(text):
        eq = get(ch, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & last:
            score += 1
        elif mh & last:
            score -= 1
        ph, mh = ph << 1 & full, mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        if score < best:
            best, at = score, i + 1
    return (best, at) if best <= most else None


def _masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, ch in enumerate(pattern):
        out[ch] = out.get(ch, 0) | 1 << i
    return out


class Matcher:
    """All items of one block, ready for matching."""

    def __init__(self, items: list[tuple[object, str]], rate: float, min_words: int = MIN_WORDS) -> None:
        self.items = []
        self.short: list[bool] = []
        where: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            m = len(text)
            self.short.append(text.count(" ") + 1 < min_words)
            k = 0 if self.short[-1] else min(int(rate * m), m - 1)
            cuts = [m * i // (k + 1) for i in range(k + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                where.setdefault(text[a:b], []).append((len(self.items), a))
            grams = {text[i : i + Q] for i in range(m - Q + 1)}
            self.items.append((item_id, text, k, _masks(text), _masks(text[::-1]), grams))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()
        self.empty = not where

    def leaks(self, text: str | None) -> list[tuple[object, int, int, int, int]]:
        """(item_id, distance, budget, start, end) of the best occurrence of each item, in the normalised text."""
        text = normalise(text)
        if self.empty or not text:
            return []
        found: dict[int, tuple[int, int]] = {}
        tried: dict[int, set[int]] = {}
        for end, (size, places) in self.automaton.iter(text):
            for i, offset in places:
                item_id, pattern, k, masks, _, grams = self.items[i]
                if i in found and found[i][0] == 0:
                    continue
                m, start = len(pattern), end + 1 - size - offset
                if self.short[i]:
                    if (start == 0 or text[start - 1] == " ") and (start + m == len(text) or text[start + m] == " "):
                        found[i] = (0, start + m)
                    continue
                a, b = max(0, start - k), min(len(text), start + m + k)
                if b - a < m - k or start in tried.get(i, ()):
                    continue
                if text[max(0, start) : start + m] == pattern:
                    found[i] = (0, start + m)
                    continue
                window = text[a:b]
                need = m - Q + 1 - k * Q
                if need > 0 and sum(window[j : j + Q] in grams for j in range(len(window) - Q + 1)) < need:
                    continue
                hit = myers(masks, m, window, k)
                # The same alignment need not be verified again for its other pieces.
                tried.setdefault(i, set()).add(start)
                if hit and (i not in found or (hit[0], a + hit[1]) < found[i]):
                    found[i] = (hit[0], a + hit[1])
        out = []
        for i, (distance, stop) in found.items():
            item_id, pattern, k, _, back, _ = self.items[i]
            m = len(pattern)
            # The start is the end of the reversed item's best occurrence in the reversed window.
            lead = text[max(0, stop - m - k) : stop][::-1]
            start = stop - (m if distance == 0 else self._length(back, m, lead, distance))
            out.append((item_id, distance, k, start, stop))
        return sorted(out, key=lambda x: (str(x[0]), x[3], x[4]))

    @staticmethod
    def _length(masks: dict[str, int], m: int, text: str, most: int) -> int:
        hit = myers(masks, m, text, most)
        return hit[1] if hit else m


def blocks(benchmark: DataFrame, block_chars: int = 4_000_000) -> Iterator[list[tuple[object, str]]]:
    """Normalised items (id, text) in blocks that fit a broadcast; streamed through the driver, never all at once."""
    block, size = [], 0
    for r in benchmark.select("item_id", "text").toLocalIterator():
        text = normalise(r["text"])
        if not text:
            continue
        block.append((r["item_id"], text))
        size += len(text)
        if size >= block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def leaks_of(docs: DataFrame, items: list[tuple[object, str]], rate: float, min_words: int, id_type: str) -> Column:
    """Array of the block's items that the column `text` contains within their budgets."""
    sent = docs.sparkSession.sparkContext.broadcast(items)
    made: list[Matcher] = []

    def match(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if not made:
            made.append(Matcher(sent.value, rate, min_words))
        for batch in texts:
            yield pd.Series([[dict(zip(FIELDS, x, strict=True)) for x in made[0].leaks(t)] for t in batch], dtype=object)

    return F.pandas_udf(match, f"array<struct<item_id {id_type}, distance int, budget int, start int, stop int>>").asNondeterministic()(F.col("text"))


def passes(docs: DataFrame, benchmark: DataFrame, rate: float, min_words: int, block_chars: int) -> tuple[str, list[Column] | list[DataFrame]]:
    """("column", one expression over `text`) for a benchmark of one block, else ("tables", a written table (d, t, leak) a block)."""
    arrow_batches(docs.sparkSession)
    id_type = benchmark.schema["item_id"].dataType.simpleString()
    parts, waiting = [], None
    found = blocks(benchmark, block_chars)
    for block in found:
        if waiting is None and not parts:
            waiting = block
            continue
        for some in [b for b in (waiting, block) if b]:
            keyed = docs.select(F.col("doc_id").alias("d"), text_key(F.col("text")).alias("t"), "text")
            leak = F.explode(leaks_of(docs, some, rate, min_words, id_type)).alias("leak")
            parts.append(materialise(keyed.select("d", "t", leak), "leaks"))
        waiting = None
    if parts:
        return "tables", parts
    return "column", [leaks_of(docs, waiting or [], rate, min_words, id_type)]


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def with_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = 0.08, min_words: int = MIN_WORDS, block_chars: int = 4_000_000) -> DataFrame:
    """All rows and columns, with `leaks`; a column of that name is replaced."""
    kept = without(docs, "leaks")
    kind, parts = passes(docs, benchmark, rate, min_words, block_chars)
    if kind == "column":
        return kept.withColumn("leaks", parts[0])
    found = _all(parts).distinct().groupBy("d", "t").agg(F.collect_list("leak").alias("found"))
    rows = kept.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("d")) & (text_key(F.col("row.text")) == F.col("t"))
    leaks = F.coalesce("found", F.array().cast(found.schema["found"].dataType))
    return rows.join(found, same, "left").select("row.*", leaks.alias("leaks"))


def leaked(docs: DataFrame, benchmark: DataFrame, rate: float = 0.08, min_words: int = MIN_WORDS, block_chars: int = 4_000_000) -> DataFrame:
    """A row for each document and item it contains: doc_id, item_id, distance, budget, start, stop."""
    kind, parts = passes(docs, benchmark, rate, min_words, block_chars)
    found = docs.select(F.col("doc_id").alias("d"), F.explode(parts[0]).alias("leak")) if kind == "column" else _all(parts)
    return found.select(F.col("d").alias("doc_id"), "leak.*")


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = 0.08, min_words: int = MIN_WORDS, block_chars: int = 4_000_000) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    kind, parts = passes(docs, benchmark, rate, min_words, block_chars)
    rows = docs.select(F.struct("*").alias("row"), F.col("text"))
    if kind == "column":
        return rows.select("row", F.size(parts[0]).alias("n")).where("n = 0").select("row.*")
    same = F.col("row.doc_id").eqNullSafe(F.col("d")) & (text_key(F.col("row.text")) == F.col("t"))
    return rows.join(_all(parts).select("d", "t").distinct(), same, "left_anti").select("row.*")
