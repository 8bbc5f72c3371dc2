import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import simhash


def plain(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(prints, radius=2):
    """component by index, from all pairs."""
    a, root = np.array(prints, np.uint64), list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= radius):
            x, y = find(i), find(int(j))
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(a))]


def grams(text, size=5):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def jaccard(texts):
    """Similarity by pair of ids, where it is above 0."""
    sets, out = {i: grams(t) for i, t in texts.items()}, {}
    for a in sets:
        for b in sets:
            if a < b and (common := len(sets[a] & sets[b])):
                out[a, b] = common / len(sets[a] | sets[b])
    return out


@settings(max_examples=50, deadline=None)
@given(st.lists(st.sampled_from("a b C dd É".split()), max_size=12))
def test_fingerprint(words):
    assert simhash.fingerprint(" ".join(words)) == plain(" ".join(words))


def test_fingerprint_in_chunks(monkeypatch, texts):
    long = " ".join(list(texts.values())[:5])
    want = simhash.fingerprint(long)
    monkeypatch.setattr(simhash, "CHUNK", 17)
    assert simhash.fingerprint(long) == want == plain(long)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=4), st.lists(st.tuples(st.integers(0, 3), st.lists(st.integers(0, 63), max_size=3)), min_size=1, max_size=40))
def test_bit_planes_and_forest(centers, flips):
    prints = sorted({centers[c % len(centers)] ^ sum(1 << b for b in set(bits)) for c, bits in flips})
    a = np.array(prints, np.uint64)
    planes = simhash.BitPlanes(a)
    for radius in (0, 1, 2):
        for v in prints:
            near = planes.near(v, radius) if planes.planes else planes.full
            assert [i for i in range(len(a)) if near >> i & 1] == [i for i, x in enumerate(prints) if (x ^ v).bit_count() <= radius]
    got = {x: x for x in prints} | {prints[i]: prints[j] for i, j in simhash.forest(a)}
    want = groups(prints)
    assert len({(want[i], got[x]) for i, x in enumerate(prints)}) == len(set(want)) == len(set(got.values()))


def test_components(docs, texts):
    ids = sorted(texts)
    want = groups([plain(texts[i]) for i in ids])
    for limit in (2048, 1):
        got = simhash.near_duplicates(docs, limit).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == {i: ids[w] for i, w in zip(ids, want, strict=True)}
        assert all(r["fingerprint"] == f"{plain(texts[r['doc_id']]):016x}" for r in got)


def test_chains_and_hot_buckets(spark):
    """A walk of single bit flips, far longer than the radius, is one component, through either level of buckets."""
    rng, value, prints = np.random.default_rng(0), 0x0123456789ABCDEF, []
    for bit in rng.permutation(64):
        prints.append(value)
        value ^= 1 << int(bit)
    prints += [0xFFFF0000FFFF0000 ^ (x * 7) for x in range(300)]
    df = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in set(prints)], "fp long")
    by = {x: w for x, w in zip(sorted(set(prints)), groups(sorted(set(prints))), strict=True)}
    for limit in (4, 2048):
        label = {r["fp"] % 2**64: r["label"] for r in simhash.components(simhash.near_links(df, limit)).collect()}
        assert len({(by[p], label.get(p, p)) for p in by}) == len(set(by.values())) == len({label.get(p, p) for p in by})


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.lists(st.integers(0, 255), max_size=70)), min_size=1, max_size=20))
def test_wide_planes(rows):
    rng = np.random.default_rng(3)
    centers = rng.integers(0, 2**63, (3, 4)).astype(np.uint64)
    prints = np.array([centers[c] ^ np.array([sum(1 << b % 64 for b in set(bits) if b // 64 == w) for w in range(4)], np.uint64) for c, bits in rows])
    planes = simhash.BitPlanes(prints)
    for radius in (5, 48):
        for value, row in zip(planes.values, prints, strict=True):
            near = planes.near(value, radius)
            assert [i for i in range(len(prints)) if near >> i & 1] == np.flatnonzero(np.bitwise_count(prints ^ row).sum(1) <= radius).tolist()


def test_similar(docs, texts):
    """Against the similarity of all pairs: from 0.8 on documents share a root, and no member of a group is far from all others."""
    found = jaccard(texts)
    for limit in (2048, 2):
        root = {r["doc_id"]: r["root"] for r in simhash.similar(docs, limit).collect()}
        assert len(root) == len(texts)
        assert all(root[a] == root[b] for (a, b), j in found.items() if j >= 0.8)
        near = {i for pair, j in found.items() if j >= 0.5 for i in pair} | {i for i, t in texts.items() if not (t or "").split()}
        alone = [i for i in root if list(root.values()).count(root[i]) > 1 and i not in near]
        assert not alone


def test_hot_near_copies(spark):
    """Hundreds of near copies of one text, beyond the limit of a bucket, and others that only share a passage with it."""
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(200)]
    copies = [" ".join(base[:k] + [f"x{k}"] + base[k + 1 :]) for k in rng.integers(0, 200, 300)]
    others = [" ".join(base[:40] + [f"o{i}n{j}" for j in range(160)]) for i in range(50)]
    df = spark.createDataFrame(list(enumerate([*copies, *others])), "doc_id long, text string")
    root = {r["doc_id"]: r["root"] for r in simhash.similar(df, 16).collect()}
    assert len({root[i] for i in range(300)}) == 1 and len(set(root.values())) == 51
    assert simhash.keep_one(df, 16).count() == 51


def test_one_of_each_stays(docs, odd, none):
    found = {}
    for r in sorted(simhash.similar(docs).collect()):
        found.setdefault(r["root"], r["doc_id"])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(found.values())
    rows = simhash.keep_one(odd.withColumn("root", F.lit(1)).withColumn("first", F.lit(2))).collect()
    assert sorted((r["doc_id"] or 0) for r in rows) == [0, 1, 4, 6, 7, 8, 9]
    assert simhash.near_duplicates(none).count() == simhash.keep_one(none).count() == 0
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(odd).collect()}
    assert got[2] == got[3] == 1 and got[5] == 4


def test_links_are_verified(spark, docs, texts):
    """Groups are exactly the chains of pairs of 0.8 or more: pairs below it stay apart, a lone pair at it is found, repeats of a shingle count once."""
    base = [f"w{i}" for i in range(300)]
    rows = {}
    for i in range(40):
        mine = [f"{i}{w}" for w in base]
        rows[3 * i], rows[3 * i + 1] = " ".join(mine), " ".join(mine[:262] + [f"y{i}n{j}" for j in range(38)])  # 258 of 334 shingles: 0.77
        rows[3 * i + 2] = " ".join(mine[33:] + [f"z{i}n{j}" for j in range(32)])  # 263 of 328 shingles: 0.801
    rows |= {1000 + i: " ".join(["same"] * 400 + [f"{c}{j}" for j in range(100)]) for i, c in enumerate("abcd")}
    for frame, by in ((spark.createDataFrame(list(rows.items()), "doc_id long, text string"), rows), (docs, texts)):
        parent = {i: i for i in by}

        def find(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for (a, b), j in jaccard(by).items():
            if j >= 0.8:
                parent[find(a)] = find(b)
        blank = [i for i in by if not (by[i] or "").split()]
        for i in blank:
            parent[find(i)] = find(blank[0])
        root = {r["doc_id"]: r["root"] for r in simhash.similar(frame).collect()}
        assert len({(root[i], find(i)) for i in by}) == len(set(root.values())) == len({find(i) for i in by})


def test_links_do_not_depend_on_limits(spark):
    """Chains, hot buckets and many unlike members: small limits of buckets and groups give the very groups of large ones, those of all pairs."""
    rng = np.random.default_rng(5)
    base, rows = [f"w{i}" for i in range(120)], {}
    words = list(base)
    for i in range(60):  # a chain: each text replaces two more words, so that its ends have little in common
        words[2 * i : 2 * i + 2] = [f"c{i}", f"d{i}"]
        rows[i] = " ".join(words)
    for i in range(60, 260):  # near copies of one text
        k = int(rng.integers(0, 120))
        rows[i] = " ".join([*base[:k], f"n{i}", *base[k + 1 :]])
    for i in range(260, 460):  # half of the text in common
        rows[i] = " ".join([*base[:70], *(f"u{i}x{j}" for j in range(50))])
    parent = {i: i for i in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), j in jaccard(rows).items():
        if j >= 0.8:
            parent[find(a)] = find(b)
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    found = []
    for limit, group_bytes in ((4, 1500), (2048, 64 << 20), (40, 20_000)):
        root = {r["doc_id"]: r["root"] for r in simhash.similar(df, limit, group_bytes=group_bytes).collect()}
        first = {}
        for i in sorted(root):
            first.setdefault(root[i], i)
        found.append({i: first[root[i]] for i in root})
    assert found[0] == found[1] == found[2]
    assert len({(found[0][i], find(i)) for i in rows}) == len(set(found[0].values())) == len({find(i) for i in rows})


def test_chunks_of_a_bucket_meet():
    """Every two members of a bucket share one of its keys, however many chunks it has."""
    from starloom.llm.simhash import verified_forest

    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 2**63, 50).astype(np.uint64)) for _ in range(6)]
    sets += [np.unique(np.concatenate([s[1:], rng.integers(0, 2**63, 1).astype(np.uint64)])) for s in sets]
    plain = {frozenset(x) for x in verified_forest(sets, 256)}
    assert plain == {frozenset((i, i + 6)) for i in range(6)}
    # The first six are connected already: their partners join the first one's component.
    assert sorted(i for i, _ in verified_forest(sets, 256, known=6)) == list(range(6, 12))


def test_unlike_members_of_a_hot_bucket(spark):
    """20,000 unlike prints under one key, and two near ones among them: found, in chunks as in one piece."""
    prints = np.random.default_rng(9).integers(-(2**63), 2**63, (20_000, 4))
    prints[777] = prints[19_000] ^ 0b111
    rows = [(1, i, *map(int, p)) for i, p in enumerate(prints)]
    df = spark.createDataFrame(rows, "key long, fp long, f0 long, f1 long, f2 long, f3 long")
    for limit in (8000, 1 << 15):
        links = simhash.similar_links(df, limit, radius=48).collect()
        assert {frozenset((r["fp"], r["root"])) for r in links if r["fp"] != r["root"]} == {frozenset((777, 19_000))}


def test_every_column_stays(docs):
    names = [f for f in "root d t k n row text_key several label fp key open bytes a f0 count at pivot m _t _d".split()]
    more = docs.select("*", *[F.lit(n).alias(n) for n in names])
    kept = simhash.keep_one(more)
    assert kept.columns == more.columns and kept.count() == simhash.keep_one(docs).count()
    assert all(r[n] == n for r in kept.collect() for n in names)
    found = simhash.near_duplicates(more)
    assert found.count() == docs.count()


def test_rows_that_differ_in_other_columns(spark):
    """Of rows with one id and text one stays, and always the same one."""
    rows = [(1, "one two three four five six", x) for x in "abcdef"] + [(2, "other words are here in this one", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {tuple(sorted(tuple(r) for r in simhash.keep_one(df.repartition(n)).collect())) for n in (1, 3)}
    assert len(got) == 1 and len(next(iter(got))) == 2
