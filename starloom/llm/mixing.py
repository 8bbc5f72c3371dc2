"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks. DataFrame functions only.

1. Targets: each source has its weight's share of all tokens, at most `max_epochs` times its own size; what is cut
   off goes to the others by weight (a water level over the sources ordered by size / weight).
2. Blocks: the tokens to take, cut into blocks of `block_tokens`, go to the sources by the highest quotients
   target / (2 seats + 1), then, inside a source, to its shards by the quotients of the shards' sizes.
   Only the last seats are in dispute (a Webster seat count differs from the proportional one by less than the
   number of parties), so quotients are made for those alone, never for every seat.
   A source with a target under `FEW` blocks has smaller blocks of its own, and one with few blocks has fewer shards, so that each holds at
   least `FULL`. Words that a shard's cap refuses go to the shards of its source that have room.
3. Selection: a shard's documents stand in a seeded order and form one stream of words, cut into near-equal blocks.
   A quota of q out of n blocks takes every block floor(q/n) times and the rest at seeded even spacing; F(x), the words
   taken out of the first x, has a closed form, so no row per block is made. A document gets F(end) - F(start).

Rows: null text has size 0; a null source is a source of its own, after all others; repeated rows count each, and rows with one id stand in the order of
their sizes and text hashes; an empty table gives an empty result. Other columns stay, whatever their names; those named as an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, id_text, materialise, text_key, without

OUT = ("size", "source_size", "target", "taken")
FEW, FULL = 100, 8


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_key(source: Column) -> Column:
    """Never null: a null source sorts last and equals itself."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("a"), source.cast("string")))


def targets(sizes: DataFrame, max_epochs: int, n_weights: int) -> DataFrame:
    """`sizes` (_k, source_size), one row a source -> with `target`. The frames hold one row a source, not a document."""
    by_name = Window.orderBy("_k")
    ranked = sizes.withColumn("_w", (F.row_number().over(by_name) - 1) % n_weights + 1)
    level = Window.orderBy(F.col("source_size") / F.col("_w"), "_k")
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    total, weights = F.sum("source_size").over(Window.partitionBy()), F.sum("_w").over(Window.partitionBy())
    left = ranked.select(
        "*",
        (total - max_epochs * F.coalesce(F.sum("source_size").over(before), F.lit(0))).alias("_left"),
        (weights - F.coalesce(F.sum("_w").over(before), F.lit(0))).alias("_wleft"),
    )
    capped = F.col("_left").cast("double") / F.col("_wleft") * F.col("_w") >= max_epochs * F.col("source_size")
    # The sources whose cap lies below the level form a prefix of this order; the first one after them fixes the level.
    free = left.withColumn("_level", F.when(~capped, F.col("_left").cast("double") / F.col("_wleft")))
    water = F.first("_level", ignorenulls=True).over(level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return free.select(
        "_k",
        "source_size",
        F.when(capped, F.col("source_size") * float(max_epochs)).otherwise(water * F.col("_w")).alias("target"),
    )


def apportion(parties: DataFrame, claim: str, seats: str, group: list[str], key: list[str], out: str) -> DataFrame:
    """Sainte-Lague: `seats` (a column, the same in a group) to the rows of each group by highest claim / (2 k + 1).

    Ties go to the smaller key. Rows without a claim get no seat.
    """
    g = Window.partitionBy(*group)
    x = parties.withColumn("_n", F.count(F.lit(1)).over(g)).withColumn("_c", F.sum(F.col(claim).cast("double")).over(g))
    share = F.when(F.col("_c") > 0, F.col(claim).cast("double") / F.col("_c")).otherwise(F.lit(0.0))
    # With (seats - n/2) to deal, rounding gives away seats at most; so these are certain, and at most n are left.
    low = F.greatest(F.floor(share * (F.col(seats) - F.col("_n") / 2.0) + 0.5 - 1e-9), F.lit(0)).cast("bigint")
    high = F.floor(share * (F.col(seats) + F.col("_n") / 2.0) + 1.5).cast("bigint")
    x = x.withColumn("_low", low).withColumn("_high", F.greatest(high, low))
    x = x.withColumn("_open", F.col(seats) - F.sum("_low").over(g))
    quotients = x.where((F.col("_high") > F.col("_low")) & (F.col("_open") > 0) & (F.col(claim) > 0)).select(
        *group, *[c for c in key if c not in group], "_open", F.col(claim).cast("double").alias("_claim"), F.explode(F.sequence("_low", F.col("_high") - 1)).alias("_seat")
    )
    order = Window.partitionBy(*group).orderBy((F.col("_claim") / (2 * F.col("_seat") + 1)).desc(), *key, "_seat")
    names = list(dict.fromkeys([*group, *key]))
    won = quotients.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= F.col("_open")).groupBy(*names).agg(F.count(F.lit(1)).alias("_won"))
    return x.join(won, names, "left").withColumn(out, F.col("_low") + F.coalesce("_won", F.lit(0))).drop("_n", "_c", "_low", "_high", "_open", "_won")


def mix(docs: DataFrame, seed: int = 11, max_epochs: int = 3, n_weights: int = 3, block_tokens: int = 1024, blocks_per_source: int = 1000, shard_root: int = 1000) -> DataFrame:
    """All rows of `docs` (doc_id, text, source, ...) with size, source_size, target and taken.

    Blocks have `block_tokens` words, or fewer where an average source would have fewer than `blocks_per_source`.
    Shards number sqrt(words / shard_root), so that both they and the documents in one stay few at any size; fewer where a source is small.
    """
    rows = without(docs, *OUT).select(F.struct("*").alias("row"))
    base = rows.select(
        "row",
        word_count(F.col("row.text")).alias("size"),
        source_key(F.col("row.source")).alias("_k"),
        F.md5(F.concat(F.lit(f"{seed}:"), id_text(F.col("row.doc_id"))).cast("binary")).alias("_h"),
    )
    sizes = materialise(base.groupBy("_k").agg(F.sum("size").alias("source_size")), "sources")  # one row a source
    found = sizes.agg(F.sum("source_size").alias("t"), F.count(F.lit(1)).alias("n")).first()
    total, sources = int(found["t"] or 0), max(int(found["n"]), 1)
    block = max(1, min(block_tokens, total // (sources * blocks_per_source)))
    shards = max(1, int((total / shard_root) ** 0.5))
    by_source = targets(sizes, max_epochs, n_weights).withColumn("_small", F.col("target") < FEW * block)
    own = F.greatest(F.lit(1), F.floor(F.col("target") / blocks_per_source)).cast("bigint")
    by_source = by_source.withColumn("_block", F.when(F.col("_small"), F.least(own, F.lit(block))).otherwise(F.lit(block)))
    # What the small sources take leaves so many blocks for the others.
    taken_by_small = F.coalesce(F.sum(F.when(F.col("_small"), F.col("target"))).over(Window.partitionBy()), F.lit(0.0))
    by_source = by_source.withColumn("_seats", F.floor((F.lit(float(total)) - taken_by_small) / block).cast("bigint")).withColumn("_all", F.lit(0))
    by_source = by_source.withColumn("_claim", F.when(F.col("_small"), F.lit(0.0)).otherwise(F.col("target")))
    seated = apportion(by_source.withColumnRenamed("_claim", "_wish"), "_wish", "_seats", ["_all"], ["_k"], "_blocks")
    seated = seated.withColumn("_blocks", F.when(F.col("_small"), F.round(F.col("target") / F.col("_block")).cast("bigint")).otherwise(F.col("_blocks")))
    full = F.floor(F.col("source_size") / (F.col("_block") * FULL)).cast("bigint")
    seated = seated.withColumn("_shards", F.least(F.lit(shards), F.greatest(F.lit(1), full)).cast("bigint"))
    seated = materialise(seated.select("_k", "source_size", "target", "_block", "_blocks", "_shards"), "sources")
    base = base.join(seated.select("_k", "_shards"), "_k").withColumn("_s", F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint") % F.col("_shards")).drop("_shards")

    parts = base.groupBy("_k", "_s").agg(F.sum("size").alias("_shard_size"))
    quotas = apportion(parts.join(seated, "_k"), "_shard_size", "_blocks", ["_k"], ["_k", "_s"], "_quota")
    # Words of the quota, at most max_epochs passes; what is over goes to the shards with room. Then near-equal blocks of this shard, numbered 0 .. _n - 1.
    whole, cap = Window.partitionBy("_k"), F.col("_shard_size") * max_epochs
    quotas = quotas.withColumn("_words", F.least(F.col("_quota") * F.col("_block"), cap)).withColumn("_room", cap - F.col("_words"))
    over, room = F.sum(F.col("_quota") * F.col("_block") - F.col("_words")).over(whole), F.sum("_room").over(whole)
    words = F.col("_words") + F.when(over > 0, F.floor(F.col("_room") * F.least(F.lit(1.0), over / room))).otherwise(F.lit(0))
    quotas = quotas.withColumn("_words", F.coalesce(words, F.col("_words")))
    quotas = quotas.withColumn("_n", F.greatest(F.lit(1), F.round(F.col("_shard_size") / F.col("_block").cast("double"))).cast("bigint"))
    quotas = quotas.select(
        "_k",
        "_s",
        "_n",
        F.when(F.col("_shard_size") > 0, F.round(F.col("_words").cast("double") * F.col("_n") / F.col("_shard_size"))).otherwise(F.lit(0)).cast("bigint").alias("_q"),
        F.col("_shard_size"),
        F.col("source_size"),
        F.col("target"),
        (F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), "_k", F.col("_s").cast("string")).cast("binary")), 1, 7), 16, 10).cast("bigint") % F.col("_n")).alias("_u"),
    )
    order = "_h", id_text(F.col("row.doc_id")), "size", text_key(F.col("row.text"))
    stream = Window.partitionBy("_k", "_s").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = base.withColumn("_end", F.sum("size").over(stream)).join(quotas, ["_k", "_s"])
    taken = F.expr(f"({taken_before('_end')}) - ({taken_before('(_end - size)')})")
    placed = placed.withColumn("taken", F.when(F.col("_shard_size") > 0, taken).otherwise(F.lit(0)).cast("bigint"))
    return placed.select("row.*", *OUT)


def taken_before(x: str) -> str:
    """SQL: words that the mix takes out of the first x of a shard's stream of _shard_size words.

    Block j spans words j * size / n up to (j + 1) * size / n. It is taken as often as (j q + u) div n steps up from j to
    j + 1, so the blocks before j are taken (j q + u) div n times together. All of it is exact integer arithmetic.
    """
    j = f"(({x} * _n) div _shard_size)"
    before, after = f"(({j} * _q + _u) div _n)", f"((({j} + 1) * _q + _u) div _n)"
    return f"(_shard_size * {before} + ({x} * _n - {j} * _shard_size) * ({after} - {before})) div _n"


#: mix() with its default parameters, with every quotient of every seat written out; for tables in which no source is small and no shard is full.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    CASE WHEN source IS NULL THEN 'n' ELSE 'a' || source END AS k, md5('11:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), g AS (SELECT coalesce(sum(size), 0)::BIGINT AS total, greatest(count(DISTINCT k), 1)::BIGINT AS n FROM d
), o AS (SELECT total, n, greatest(1, least(1024, total // (n * 1000)))::BIGINT AS block, greatest(1, floor(sqrt(total / 1000.0)))::BIGINT AS shards FROM g
), b AS (SELECT d.*, ('0x' || substr(h, 1, 8))::BIGINT % shards AS s FROM d, o
), parts AS (SELECT k, s, sum(size)::BIGINT AS ss FROM b GROUP BY k, s
), r AS (SELECT k, sum(ss)::BIGINT AS source_size, ((row_number() OVER (ORDER BY k) - 1) % 3 + 1)::BIGINT AS w FROM parts GROUP BY k
), l AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER v, 0))::DOUBLE AS lft, (sum(w) OVER () - coalesce(sum(w) OVER v, 0))::DOUBLE AS wl
  FROM r WINDOW v AS (ORDER BY source_size / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), c AS (SELECT *, lft / wl * w >= 3 * source_size AS capped FROM l
), t AS (
  SELECT k, source_size, CASE WHEN capped THEN source_size * 3.0::DOUBLE ELSE (SELECT lft / wl FROM c WHERE NOT capped ORDER BY source_size / w, k LIMIT 1) * w END AS target FROM c
), x AS (
  SELECT k, row_number() OVER (ORDER BY target / (2 * seat + 1) DESC, k, seat) AS place FROM (
    SELECT k, target, unnest(range(0, (target / (SELECT sum(target) FROM t) * (total // block))::BIGINT + n + 2)) AS seat FROM t, o WHERE target > 0)
), q1 AS (SELECT k, count(*) AS blocks FROM x, o WHERE place <= total // block GROUP BY k
), y AS (
  SELECT k, s, blocks, row_number() OVER (PARTITION BY k ORDER BY ss / (2 * seat + 1) DESC, s, seat) AS place FROM (
    SELECT k, s, ss, blocks, unnest(range(0, (ss / source_size * blocks)::BIGINT + shards + 2)) AS seat FROM parts JOIN r USING (k) JOIN q1 USING (k), o WHERE ss > 0)
), q2 AS (SELECT k, s, count(*) AS quota FROM y WHERE place <= blocks GROUP BY k, s
), z AS (
  SELECT k, s, ss, source_size, target, greatest(1, round(ss / block::DOUBLE))::BIGINT AS n, least(coalesce(quota, 0) * block, ss * 3) AS words
  FROM parts JOIN t USING (k) LEFT JOIN q2 USING (k, s), o
), f AS (
  SELECT *, CASE WHEN ss > 0 THEN round(words::DOUBLE * n / ss) ELSE 0 END::BIGINT AS q, ('0x' || substr(md5('11:' || k || ':' || s), 1, 7))::BIGINT % n AS u FROM z
), p AS (
  SELECT doc_id, source, size, source_size, target, ss, n, q, u,
    (sum(size) OVER (PARTITION BY k, s ORDER BY h, coalesce(doc_id::VARCHAR, ''), size ROWS UNBOUNDED PRECEDING))::BIGINT AS e FROM b JOIN f USING (k, s)
), j AS (SELECT *, (e * n) // greatest(ss, 1) AS j1, ((e - size) * n) // greatest(ss, 1) AS j0, e - size AS a FROM p)
SELECT doc_id, source, size, source_size, target, CASE WHEN ss = 0 THEN 0 ELSE
  (ss * ((j1 * q + u) // n) + (e * n - j1 * ss) * (((j1 + 1) * q + u) // n - (j1 * q + u) // n)) // n
  - (ss * ((j0 * q + u) // n) + (a * n - j0 * ss) * (((j0 + 1) * q + u) // n - (j0 * q + u) // n)) // n END::BIGINT AS taken
FROM j
"""
