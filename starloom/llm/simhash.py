"""SimHash near-duplicates: fingerprints of 3-word shingles, linked at 2 or fewer differing bits, grouped into components.

Candidates: the 64 bits are four blocks of 16. Two fingerprints that differ in at most 2 bits agree in at least two blocks,
so each distinct fingerprint goes into one bucket for every pair of blocks (6 tables, keys of 32 bits). A bucket of more than
`LIMIT` members is dealt anew by pairs of the four bytes that are still free (6 more tables): such a bucket has 16 free bits,
hence never more than 65,536 members. So no bucket is capped and none is unbounded.

Comparison, bit-sliced: a bucket's fingerprints stand as bit planes, one long integer a bit position, one bit a member. A member is compared with
all others at once: each plane, inverted where the member has a 1, is added to vertical carry-save counters (ones, twos, over),
and the bucket is abandoned as soon as every member is over the radius. A bucket yields a spanning forest, not all its pairs.

Components: minimum labels over the links with pointer jumping, a written table each round. Equal fingerprints are
one node from the start, so copies never meet in a group.

For the similarity of five-word shingles, 0.8 or more, 64 bits are too few: there similar() compares prints of 256 bits in the same way, with buckets
from bands of least shingle hashes. These prints only propose: inside the groups that they chain together, each link is verified by the exact Jaccard
similarity of the two shingle sets. keep_one() goes by the verified groups.

Null text, empty text and text without words have fingerprint zero, which links like any other; in similar() they are one node. Rows with equal doc_id and text
are one document; a component's id is its smallest doc_id that is not null. Ties and repeated rows: all rows of a document get its result, and keep_one() returns
one of them. Empty tables give empty results. Other columns are never read, whatever their names; keep_one() returns them as they are.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, ascii_words, discard, materialise, text_key

RADIUS = 2
SHINGLE = 3
LIMIT = 2048
CHUNK = 1 << 16
#: Of the wide prints: words of 64 bits, shingle, radius (at 0.8 some 39 bits differ, with a deviation of 6), and 20 bands of 5 rows (a pair at 0.8
#: shares one with 99.97 %).
WORDS, WIDE_SHINGLE, WIDE_RADIUS = 4, 5, 72
BANDS, ROWS = 20, 5
#: Members of a bucket that are compared in one task, bits around a pivot within which members of a larger one go, and bytes of text of a group in one task.
WIDE_LIMIT, TIGHT, GROUP_BYTES, PER_TEXT = 1 << 15, 24, 64 << 20, 64


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the shingles' XXH64 (seed 42)."""
    words = ascii_words(text)
    if not words:
        return 0
    ones, n = np.zeros(64, np.int64), max(1, len(words) - size + 1)
    hashed = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        part = words[at : at + CHUNK + size - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(size)), strict=False)) if n > 1 or len(words) >= size else [b" ".join(words)]
        h = np.fromiter((hashed(s, 42) for s in shingles), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))


def fingerprint_of(text: Column) -> Column:
    """The 64 bits as a signed long."""
    return F.pandas_udf(_fingerprints, "long")(text)


class BitPlanes:
    """Fingerprints of one bucket, a row of 64-bit words each, stored by bit position."""

    def __init__(self, prints: np.ndarray) -> None:
        self.n = len(prints)
        self.full = (1 << self.n) - 1
        rows = np.ascontiguousarray(prints).view(np.uint8).reshape(self.n, -1)
        self.values = [int.from_bytes(x.tobytes(), "little") for x in rows]
        planes = np.packbits(np.unpackbits(rows, axis=1, bitorder="little").T, axis=1, bitorder="little")
        # A plane in which all members agree can't tell them apart.
        self.planes = [(b, x) for b in range(len(planes)) if (x := int.from_bytes(planes[b].tobytes(), "little")) not in (0, self.full)]

    def near(self, value: int, radius: int = RADIUS) -> int:
        """Members within `radius` of a member's value, as a bit set."""
        # Counters start so far below their capacity that they overflow at the first bit beyond the radius.
        size = max(1, radius.bit_length())
        start = (1 << size) - 1 - radius
        counters = [self.full if start >> i & 1 else 0 for i in range(size)]
        over = 0
        for b, plane in self.planes:
            carry = self.full ^ plane if value >> b & 1 else plane
            for i in range(size):
                counters[i], carry = counters[i] ^ carry, counters[i] & carry
                if not carry:
                    break
            else:
                over |= carry
                if over == self.full:
                    return 0
        return self.full & ~over


def forest(prints: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links (member, root), by position, that connect exactly the members which chains of near ones connect."""
    if len(prints) < 2:
        return []
    planes = BitPlanes(prints)
    left, found = planes.full, []
    while left:
        root = (left & -left).bit_length() - 1
        left &= left - 1
        stack = [root]
        while stack and left:
            new = planes.near(planes.values[stack.pop()], radius) & left
            left &= ~new
            while new:
                i = (new & -new).bit_length() - 1
                new &= new - 1
                stack.append(i)
                found.append((i, root))
    return found


def _bucket_links(batches: Iterator[pd.DataFrame], words: tuple[str, ...] = ("fp",), radius: int = RADIUS) -> Iterator[pd.DataFrame]:
    """Rows (key, fp, words of the fingerprint) sorted by key -> links. What a batch leaves of its last bucket waits for the next."""

    def links(keys: np.ndarray, nodes: np.ndarray, prints: np.ndarray) -> pd.DataFrame:
        found, bounds = [], [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for a, b in zip(bounds, bounds[1:], strict=False):
            found += [(a + i, a + j) for i, j in forest(prints[a:b], radius)]
        at = np.array(found, np.int64).reshape(-1, 2)
        return pd.DataFrame({"fp": nodes[at[:, 0]], "root": nodes[at[:, 1]]})

    rest: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        keys, nodes = batch["key"].to_numpy(), batch["fp"].to_numpy(np.int64)
        prints = np.stack([batch[w].to_numpy(np.int64) for w in words], axis=1).view(np.uint64)
        if not len(keys):
            continue
        if rest and rest[-1][0][-1] != keys[0]:
            yield links(*map(np.concatenate, zip(*rest, strict=True)))
            rest = []
        start = int(np.searchsorted(keys, keys[-1]))
        if start:
            yield links(*map(np.concatenate, zip(*rest, (keys[:start], nodes[:start], prints[:start]), strict=True)))
            rest = []
        rest.append((keys[start:], nodes[start:], prints[start:]))
    if rest:
        yield links(*map(np.concatenate, zip(*rest, strict=True)))


def _pairs(value: Column, width: int) -> Column:
    """The 6 pairs of four blocks of `width` bits, each tagged with its number: tag * 4**width + pair."""
    mask = (1 << width) - 1
    block = [F.shiftrightunsigned(value, width * i).bitwiseAND(F.lit(mask)) for i in range(4)]
    found = [(i, j) for i in range(4) for j in range(i)]
    return F.array(*[(F.lit(t << 2 * width) + block[i] * (1 << width) + block[j]).cast("bigint") for t, (i, j) in enumerate(found)])


def _free_bits(value: Column, key: Column) -> Column:
    """The 16-bit blocks that a first-level key leaves open, as 32 bits."""
    block = [F.shiftrightunsigned(value, 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    tag, out = F.shiftright(key, 32), F.lit(0)
    for t, used in enumerate((i, j) for i in range(4) for j in range(i)):
        a, b = [i for i in range(4) if i not in used]
        out = F.when(tag == t, block[a] * 65536 + block[b]).otherwise(out)
    return out.cast("bigint")


def near_links(prints: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Distinct fingerprints (fp) -> links (fp, root) that span every component at the radius."""
    keyed = prints.select("fp", F.explode(_pairs(F.col("fp"), 16)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = keyed.join(sizes, "key")
    finer = F.transform(_pairs(_free_bits(F.col("fp"), F.col("key")), 8), lambda x: F.lit(1 << 62) + F.col("key") * (1 << 19) + x)
    dealt = shared.select("fp", F.explode(F.when(F.col("n") <= limit, F.array("key")).otherwise(finer)).alias("key"))
    return dealt.repartition("key").sortWithinPartitions("key").mapInPandas(_bucket_links, "fp long, root long")


def components(links: DataFrame) -> DataFrame:
    """Links (fp, root) -> (fp, label), the smallest fp of each component; only nodes that have a link."""
    edges = materialise(links.select(F.explode(F.array(F.struct("fp", "root"), F.struct(F.col("root").alias("fp"), F.col("fp").alias("root")))).alias("e")).select("e.fp", F.col("e.root").alias("to")).distinct(), "links")
    labels = materialise(edges.groupBy("fp").agg(F.least(F.col("fp"), F.min("to")).alias("label")), "labels")
    while True:
        seen = edges.join(labels.withColumnRenamed("fp", "to"), "to").groupBy("fp").agg(F.min("label").alias("near"))
        hooked = labels.join(seen, "fp", "left").select("fp", F.col("label").alias("old"), F.least("label", "near").alias("via"))
        jump = labels.select(F.col("fp").alias("via"), F.col("label").alias("far"))
        nxt = materialise(hooked.join(jump, "via", "left").select("fp", "old", F.least("via", "far").alias("label")), "labels")
        discard(labels)
        if not nxt.where("label < old").limit(1).count():
            discard(edges)
            return nxt.select("fp", "label")
        labels = nxt.select("fp", "label")


def near_duplicates(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Every row's (doc_id, text_key, fingerprint, component_id); copies are not expanded into pairs."""
    arrow_batches(docs.sparkSession)
    rows = materialise(docs.select("doc_id", text_key(F.col("text")).alias("text_key"), fingerprint_of(F.col("text")).alias("fp")), "prints")
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    labels = components(near_links(prints.select("fp"), limit))
    rooted = materialise(prints.join(labels, "fp", "left").select("fp", "first", F.coalesce("label", "fp").alias("root")), "roots")
    found = rooted.join(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("fp", "root", "component_id")
    return rows.join(found, "fp").select("doc_id", "text_key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root")


def _wide(texts: pd.Series) -> pd.Series:
    return pd.Series([signature(t) for t in texts], dtype=object)


def shingle_set(text: str | None, size: int = WIDE_SHINGLE) -> np.ndarray:
    """The hashes of a text's shingles, each once, sorted; a text shorter than a shingle is one."""
    words = ascii_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)) if len(words) >= size else [b" ".join(words)]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), np.uint64))


def wide_print(h: np.ndarray) -> np.ndarray:
    """The 256-bit SimHash of a shingle set as four longs."""
    ones = np.zeros(64 * WORDS, np.int64)
    for at in range(0, len(h), 4096):
        bits = _mixed(h[at : at + 4096, None] + _STEPS[None, :WORDS])
        ones += np.unpackbits(bits.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.uint16)
    return np.packbits(ones * 2 > len(h), bitorder="little").view(np.int64)


def signature(text: str | None, size: int = WIDE_SHINGLE) -> np.ndarray:
    """The print of a text's shingle set, a key for each band of least shingle hashes, and a hash that names the set. No words: all zero."""
    h = shingle_set(text, size)
    if not len(h):
        return np.zeros(WORDS + BANDS + 1, np.int64)
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(h), 4096):
        np.minimum(least, ((h[at : at + 4096, None] ^ _STEPS[None, WORDS:]) * _ODD).min(0), out=least)
    mixed = _mixed(least + _STEPS[WORDS:]).reshape(BANDS, ROWS)
    name = np.array([xxhash.xxh64_intdigest(h.tobytes())], np.uint64)
    return np.concatenate([wide_print(h), np.bitwise_xor.reduce(mixed, axis=1).view(np.int64), name.view(np.int64)])


def _mixed(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


#: Fixed offsets, all different, for the words of the print and the rows of the bands; odd factors for the latter.
_STEPS = _mixed(np.arange(1, WORDS + BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ODD = _mixed(_STEPS[WORDS:]) | np.uint64(1)


def _dealt(rows: DataFrame, buckets: DataFrame, member: str) -> DataFrame:
    """`rows` (key, ...) of the `buckets` (key, m), dealt so that each two members of a bucket still share a key: a bucket is cut into m chunks by a hash of
    `member`, and every two chunks form a bucket of their own."""
    chunk = F.pmod(F.xxhash64(F.lit("chunk"), member), F.col("m"))
    pairs = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("m") - 1), lambda j: F.xxhash64("key", F.least(chunk, j), F.greatest(chunk, j)))
    keys = F.when(F.col("m") == 1, F.array("key")).otherwise(pairs)
    return rows.join(buckets.select("key", F.col("m").cast("bigint").alias("m")), "key").withColumn("key", F.explode(keys)).drop("m")


def similar_links(keyed: DataFrame, limit: int = WIDE_LIMIT, radius: int = WIDE_RADIUS, tight: int = TIGHT) -> DataFrame:
    """(key, fp: node, f0 .. f3) -> links (fp, root) whose chains join all nodes that share a key and differ in at most `radius` bits.

    A bucket of up to `limit` members is compared whole; buckets with the same members are compared once. A larger one first gives up those within `tight` bits
    of its smallest member, after all within `radius` + `tight` bits of that were linked to it: whatever is near one that goes is among them, so nothing is lost.
    What still is larger is cut into chunks, and every two chunks meet.
    """
    words = [f"f{i}" for i in range(WORDS)]
    whole, found = functools.partial(_bucket_links, words=tuple(words), radius=radius), None
    for last in (False, False, True):
        sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("fp").alias("x"), F.min("fp").alias("fp")).where("n > 1")
        once = materialise(sizes.groupBy("n", "x").agg(F.min("key").alias("key"), F.min_by("fp", "key").alias("fp")), "buckets")
        chunks = F.when(F.col("n") > limit, F.ceil(F.col("n") * 2 / limit)).otherwise(1)
        some = _dealt(keyed, once.where(F.lit(last) | (F.col("n") <= limit)).withColumn("m", chunks), "fp")
        some = some.repartition("key").sortWithinPartitions("key").mapInPandas(whole, "fp long, root long")
        found = some if found is None else found.unionByName(some)
        hot = once.where(F.col("n") > limit).select("key", "fp")
        if last or hot.isEmpty():
            return found
        pivots = keyed.join(hot, ["key", "fp"]).select("key", F.struct("fp", *words).alias("pivot"))
        apart = sum((F.bit_count(F.col(w).bitwiseXOR(F.col(f"pivot.{w}"))) for w in words), F.lit(0))
        dealt = materialise(keyed.join(pivots, "key").withColumn("apart", apart), "hot")
        around = dealt.where(F.col("apart") <= radius + tight).where(F.col("fp") != F.col("pivot.fp"))
        found = found.unionByName(around.select("fp", F.col("pivot.fp").alias("root")))
        keyed = dealt.where(F.col("apart") > tight).select("key", "fp", *words)
    raise AssertionError


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two shingle sets have a Jaccard similarity of 0.8 or more, in integers."""
    if 5 * min(len(a), len(b)) < 4 * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * common >= 4 * (len(a) + len(b) - common)


def verified_forest(sets: list[np.ndarray], radius: int = WIDE_RADIUS, known: int = 0) -> list[tuple[int, int]]:
    """Links (member, root), by position, that connect exactly the members which chains of alike ones connect; prints only rule out.

    The first `known` members are connected already, so that they meet the others only.
    """
    planes = BitPlanes(np.stack([wide_print(h) for h in sets]).view(np.uint64))
    left, found = planes.full >> known << known, []
    waiting = list(range(known))
    while left or waiting:
        root = 0 if waiting else (left & -left).bit_length() - 1
        if not waiting:
            left &= left - 1
        stack, waiting = waiting or [root], []
        while stack and left:
            at = stack.pop()
            new = planes.near(planes.values[at], radius) & left
            while new:
                i = (new & -new).bit_length() - 1
                new &= new - 1
                if alike(sets[at], sets[i]):
                    left ^= 1 << i
                    stack.append(i)
                    found.append((i, root))
    return found


def _verified(batches: Iterator[pd.DataFrame], radius: int = WIDE_RADIUS) -> Iterator[pd.DataFrame]:
    """Rows (key, open, fp, text) sorted by key and open -> links (fp, root) between the members of a key; those that are not open are connected already."""

    def links(nodes: list[int], sets: list[np.ndarray], known: int) -> pd.DataFrame:
        at = np.array(verified_forest(sets, radius, known), np.int64).reshape(-1, 2)
        names = np.array(nodes, np.int64)
        return pd.DataFrame({"fp": names[at[:, 0]], "root": names[at[:, 1]]})

    key, nodes, sets, known = None, [], [], 0
    for batch in batches:
        for to, is_open, fp, text in zip(batch["key"], batch["open"], batch["fp"], batch["text"], strict=True):
            if nodes and to != key:
                yield links(nodes, sets, known)
                nodes, sets, known = [], [], 0
            key = to
            known += not is_open
            nodes.append(fp)
            sets.append(shingle_set(text))
    if nodes:
        yield links(nodes, sets, known)


def _like_pivot(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (fp, text, pivot: text) -> (fp, like): whether a text is alike to its group's pivot."""
    last, pivot = None, None
    for batch in batches:
        like = []
        for text, other in zip(batch["text"], batch["pivot"], strict=True):
            if pivot is None or other != last:
                last, pivot = other, shingle_set(other)
            like.append(alike(shingle_set(text), pivot))
        yield pd.DataFrame({"label": batch["label"], "fp": batch["fp"], "root": batch["root"], "open": [not x for x in like]})


def verified_links(texts: DataFrame, sizes: DataFrame, group_bytes: int = GROUP_BYTES, radius: int = WIDE_RADIUS) -> DataFrame:
    """(label: group, fp, text) and each group's (label, bytes, root: smallest fp) -> links (fp, root) whose chains join all members of a group that chains
    of alike pairs join.

    A group of up to `group_bytes` of text is compared in one task. In a larger one, the members alike to its smallest are linked to that; the others, open
    still, are cut into chunks that meet each other and chunks of the linked ones, so that a task never holds more than about twice those bytes.
    """
    check, links = functools.partial(_verified, radius=radius), "fp long, root long"
    large = materialise(sizes.where(F.col("bytes") > group_bytes), "large")
    some = not large.isEmpty()
    small = texts.join(large, "label", "left_anti") if some else texts
    small = small.select(F.col("label").alias("key"), F.lit(True).alias("open"), "fp", "text")
    found = small.repartition("key").sortWithinPartitions("key", "fp").mapInPandas(check, links)
    if not some:
        return found
    texts = materialise(texts.join(large.select("label"), "label"), "groups")
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + PER_TEXT)
    pivots = texts.join(large.select("label", F.col("root").alias("fp")), ["label", "fp"]).select("label", F.col("fp").alias("root"), F.col("text").alias("pivot"))
    state = materialise(texts.join(pivots, "label").mapInPandas(_like_pivot, "label long, fp long, root long, open boolean"), "state")
    found = found.unionByName(state.where(~F.col("open") & (F.col("fp") != F.col("root"))).select("fp", "root"))
    rows = texts.join(state.select("label", "fp", "open"), ["label", "fp"])
    counts = rows.groupBy("label", "open").agg(F.ceil(size / group_bytes).alias("m"))
    pairs = counts.groupBy("label").agg(F.coalesce(F.max(F.when(F.col("open"), F.col("m"))), F.lit(0)).alias("mo"), F.coalesce(F.max(F.when(~F.col("open"), F.col("m"))), F.lit(0)).alias("ml"))
    chunk = lambda m: F.pmod(F.xxhash64(F.lit("chunk"), "fp"), F.greatest(F.col(m), F.lit(1)))
    to = lambda m: F.sequence(F.lit(0).cast("bigint"), F.col(m) - 1)
    with_open = F.transform(to("mo"), lambda j: F.xxhash64(F.lit("open"), "label", F.least(chunk("mo"), j), F.greatest(chunk("mo"), j)))
    open_keys = F.concat(with_open, F.when(F.col("ml") > 0, F.transform(to("ml"), lambda j: F.xxhash64(F.lit("linked"), "label", chunk("mo"), j))).otherwise(F.array()))
    linked_keys = F.transform(to("mo"), lambda j: F.xxhash64(F.lit("linked"), "label", j, chunk("ml")))
    dealt = rows.join(pairs.where("mo > 0"), "label").select(F.explode(F.when(F.col("open"), open_keys).otherwise(linked_keys)).alias("key"), "open", "fp", "text")
    return found.unionByName(dealt.repartition("key").sortWithinPartitions("key", "open", "fp").mapInPandas(check, links))


def similar(docs: DataFrame, limit: int = WIDE_LIMIT, radius: int = WIDE_RADIUS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Every row's (doc_id, text_key, root): documents whose sets of five-word shingles are 0.8 similar or more share a root.

    Equal sets are one node. Nodes meet in buckets of equal bands of least hashes and are compared there, bit-sliced, by their prints; what lies within the
    radius is chained to groups of candidates. Inside a group only pairs of an exact similarity of 0.8 or more are linked, and chains of those are followed.
    """
    arrow_batches(docs.sparkSession)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + PER_TEXT
    rows = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), size.alias("bytes"), F.pandas_udf(_wide, "array<long>")(F.col("text")).alias("a"))
    words = [F.col("a")[i].alias(f"f{i}") for i in range(WORDS)]
    rows = materialise(rows.withColumn("fp", F.col("a")[WORDS + BANDS]), "signatures")
    nodes = rows.groupBy("fp").agg(F.min("a").alias("a"))
    keys = F.transform(F.slice("a", WORDS + 1, BANDS), lambda k, i: F.xxhash64(k, i))
    keyed = nodes.select("fp", *words, F.explode(keys).alias("key"))
    groups = components(similar_links(keyed, limit, radius))
    # One row stands for each node of a group and brings its text.
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id").alias("d"), F.col("text_key").alias("t"), "bytes")
    chosen = rows.join(groups, "fp").groupBy("fp", "label").agg(F.min(place).alias("at")).select("fp", "label", "at.d", "at.t", "at.bytes")
    chosen = materialise(chosen, "chosen")
    texts = docs.select("doc_id", "text", text_key(F.col("text")).alias("k"))
    texts = texts.join(chosen, texts["doc_id"].eqNullSafe(chosen["d"]) & (texts["k"] == chosen["t"])).select("label", "fp", "text")
    if not rows.groupBy("doc_id", "text_key").count().where("count > 1").isEmpty():
        texts = texts.dropDuplicates(["fp"])  # repeated rows
    sizes = chosen.groupBy("label").agg(F.sum("bytes").alias("bytes"), F.min("fp").alias("root"))
    labels = components(verified_links(texts, sizes, group_bytes, radius))
    return rows.select("doc_id", "text_key", "fp").join(labels, "fp", "left").select("doc_id", "text_key", F.coalesce("label", "fp").alias("root"))


def keep_one(docs: DataFrame, limit: int = WIDE_LIMIT, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One document of each group of similar() stays: the smallest doc_id (null comes last), of equal ids the smallest text key, and of rows that agree in
    both the one with the smallest hash of all its columns. Every column stays, whatever its name."""
    found = similar(docs, limit, group_bytes=group_bytes)
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_key")
    first = found.groupBy("root").agg(F.min(place).alias("k"), F.count(F.lit(1)).alias("rows")).select("root", F.col("k.doc_id").alias("d"), F.col("k.text_key").alias("t"), "rows")
    first = materialise(first.select("d", "t", (F.col("rows") > 1).alias("several")), "kept")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("doc_id"), text_key(F.col("text")).alias("text_key"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t"))
    kept = rows.join(first, same).select("row", "d", "t", "several")
    # Only a root with several rows can have its document more than once.
    once = kept.where(~F.col("several")).select("row")
    chosen = kept.where("several").groupBy("d", "t").agg(F.min_by("row", F.struct(F.xxhash64("row"), F.to_json("row"))).alias("row")).select("row")
    return once.unionByName(chosen).select("row.*")
