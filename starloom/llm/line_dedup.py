"""Line dedup by overlapping three-line windows.

A line ends at a line feed; inside it, a new unit begins after each mark (. ! ? , ; :) that a space follows and after 。！？, so that a passage inside a long
line has units of its own. A unit's key is the unit without leading and trailing spaces, tabs, carriage returns and line feeds. Units whose key is empty belong
to no window. Each three consecutive other units form a window, named by two 64-bit hashes of its keys, if they are whole lines or their keys have
`LEAST` characters or more together (shorter ones recur by chance). Of all occurrences of a window in the table, the first by (doc_id, hash of the text, position)
stays; every later one covers the units from its first to its last. Covered positions are merged and those units removed, each with the space or line feed at its end.

A null text stays null; texts of fewer than three units stay as they are. Rows with equal doc_id and text are one document and all get its result.
A null doc_id comes first. An empty table gives an empty one. Every column stays, whatever its name; only those named as an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_key, without

OUT = ("n_lines", "n_removed")
WIDTH = 3
LEAST = 80
#: What ends a unit, and the same as an expression for texts that hold the byte that else marks the ends.
ENDS = ("\n", *(mark + " " for mark in ".!?,;:"), "。", "！", "？")
CUT = r"(?<=\n)|(?<=[.!?,;:] )|(?<=[。！？])"
MARK = "\x01"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once a row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _units(text: Column) -> Column:
    """A text's units with what ends them: marks are set by plain search, which is twice as fast as an expression."""
    marked = text
    for end in ENDS:
        marked = F.replace(marked, F.lit(end), F.lit(end + MARK))
    return F.when(F.instr(text, MARK) > 0, F.split(text, CUT, -1)).otherwise(F.split(marked, MARK, -1))


def _windows(units: Column) -> Column:
    """array<struct<h1, h2, p0, p2>>: a text's windows with their first and last position."""

    def known(keys: Column) -> Column:
        def one(k: Column, i: Column) -> Column:
            begins = (i == 0) | F.get(units, i - 1).endswith("\n")
            ends = (i == F.size(units) - 1) | F.get(units, i).endswith("\n")
            return F.struct(i.alias("p"), F.length(k).alias("n"), (begins & ends).alias("whole"), F.xxhash64(k).alias("a"), F.xxhash64(F.lit(WIDTH), k).alias("b"))

        return F.filter(F.transform(keys, one), lambda x: x["n"] > 0)

    def at(full: Column, i: Column) -> Column:
        x = [F.get(full, i + k) for k in range(WIDTH)]
        valid = (x[0]["n"] + x[1]["n"] + x[2]["n"] >= LEAST) | (x[0]["whole"] & x[1]["whole"] & x[2]["whole"])
        found = F.struct(F.xxhash64(*[y["a"] for y in x]).alias("h1"), F.xxhash64(*[y["b"] for y in x]).alias("h2"), x[0]["p"].alias("p0"), x[2]["p"].alias("p2"))
        return F.when(valid, found)

    def of(full: Column) -> Column:
        places = F.when(F.size(full) >= WIDTH, F.sequence(F.lit(0), F.size(full) - WIDTH))
        return F.array_compact(F.transform(places, lambda i: at(full, i)))

    return _let(_let(F.transform(units, lambda u: F.trim(u, F.lit(" \t\r\n"))), known), of)


def windows(docs: DataFrame) -> DataFrame:
    """(d, t, h1, h2, p0, p2), a row for each window of (d: id, t: text key, text)."""
    full = docs.where(F.col("text").isNotNull()).select("d", "t", F.explode(_let(_units(F.col("text")), _windows)).alias("w"))
    return full.select("d", "t", "w.*")


def covered(docs: DataFrame) -> DataFrame:
    """(d, t, covered: positions to remove) for each document (d, t, text) that has any.

    Windows are made and shuffled once; all occurrences of one are sorted together, and a group that does not fit in memory is read from disk.
    """
    # Repeated rows are one document: their windows have the same places, so those of the first one all rank first.
    place = Window.partitionBy("h1", "h2").orderBy(F.col("d").asc_nulls_first(), "t", "p0")
    later = windows(docs).withColumn("nth", F.rank().over(place)).where("nth > 1")
    return later.select("d", "t", F.explode(F.sequence("p0", "p2")).alias("p")).groupBy("d", "t").agg(F.collect_set("p").alias("covered"))


def dedup(docs: DataFrame) -> DataFrame:
    """All rows with the shortened text, n_lines (before, by line feeds) and n_removed (units)."""
    kept = without(docs, *OUT)
    rows = kept.select(F.struct("*").alias("row"))
    rows = rows.select("row", F.col("row.doc_id").alias("d"), F.col("row.text").alias("text"), text_key(F.col("row.text")).alias("t"))
    gone = covered(rows.select("d", "t", "text")).select(F.col("d").alias("gone_d"), F.col("t").alias("gone_t"), "covered")
    joined = rows.join(gone, F.col("d").eqNullSafe(F.col("gone_d")) & (F.col("t") == F.col("gone_t")), "left")

    def shorter(units: Column) -> Column:
        left = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(units) - 1), F.col("covered")))
        return F.array_join(F.transform(left, lambda i: F.get(units, i)), "")

    text = F.when(F.col("covered").isNull(), F.col("text")).otherwise(_let(_units(F.col("text")), shorter))
    out = {c: F.col("row")[c] for c in kept.columns} | {"text": text}
    feeds = F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(feeds + 1).cast("bigint")
    n_removed = F.when(F.col("covered").isNull(), 0).otherwise(F.size("covered")).cast("bigint")
    return joined.select(*[out[c].alias(c) for c in kept.columns], n_lines.alias("n_lines"), n_removed.alias("n_removed"))


SQL = r"""
WITH u AS (
  SELECT doc_id, string_split(regexp_replace(text, '(\n|[.!?,;:] |[。！？])', '\1' || chr(1), 'g'), chr(1)) AS units FROM documents WHERE text IS NOT NULL
), l AS (SELECT doc_id, generate_subscripts(units, 1) - 1 AS pos, unnest(units) AS line, len(units) AS n FROM u
), k AS (
  SELECT doc_id, pos, trim(line, chr(32) || chr(9) || chr(13) || chr(10)) AS k,
    (pos = 0 OR ends_with(lag(line) OVER d, chr(10))) AND (pos = n - 1 OR ends_with(line, chr(10))) AS whole FROM l WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), w AS (
  SELECT doc_id, pos AS p0, lead(pos, 2) OVER d AS p2, k AS k0, lead(k, 1) OVER d AS k1, lead(k, 2) OVER d AS k2,
    whole AND lead(whole, 1) OVER d AND lead(whole, 2) OVER d AS whole FROM k WHERE k <> '' WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), f AS (
  SELECT doc_id, p0, p2, row_number() OVER (PARTITION BY k0, k1, k2 ORDER BY doc_id, p0) AS nth FROM w
  WHERE p2 IS NOT NULL AND (whole OR length(k0) + length(k1) + length(k2) >= 80)
), c AS (
  SELECT DISTINCT doc_id, unnest(range(p0, p2 + 1)) AS pos FROM f WHERE nth > 1
), r AS (
  SELECT l.doc_id, string_agg(line, '' ORDER BY l.pos) FILTER (c.pos IS NULL) AS text, count(c.pos) AS n_removed
  FROM l LEFT JOIN c ON l.doc_id = c.doc_id AND l.pos = c.pos GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(r.text, '') END AS text, 
  CASE WHEN d.text IS NULL THEN 0 ELSE length(d.text) - length(replace(d.text, chr(10), '')) + 1 END::BIGINT AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM documents d LEFT JOIN r ON d.doc_id = r.doc_id
"""
