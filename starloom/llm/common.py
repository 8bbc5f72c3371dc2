"""What the operators of this subpackage share: words, row identity, shared scratch tables, bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import discard, materialise, shared_dir

__all__ = ["WORD", "arrow_batches", "ascii_words", "crc_mod", "discard", "hash31", "id_text", "materialise", "sample_below", "shared_dir", "table", "text_key", "without"]

#: A word is a run of anything but ASCII white space; Python's bytes.split() cuts at the same bytes.
WORD = r"[^\x20\x09-\x0D]+"


def ascii_words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8, with A-Z lower-cased and nothing else changed."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as an empty text."""
    return F.pmod(F.crc32(id_text(col).cast("binary")), F.lit(n))


def text_key(text: Column) -> Column:
    """With doc_id this names a row; rows that agree in both are one document."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def sample_below(total: int, wanted: int) -> int:
    """Threshold on a 31-bit hash that keeps about `wanted` of `total` rows."""
    return 2**31 if total <= wanted else int(2**31 * wanted / total)


def hash31(*cols: Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(2**31))


def arrow_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts may be long: hand Python fewer rows at once than Spark's 10,000. Spark itself ends a batch at spark.sql.execution.arrow.maxBytesPerBatch (64 MB), so that
    a batch holds that and one text more at most. The setting stays for the session, since results are read later."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def without(df: DataFrame, *names: str) -> DataFrame:
    """Input columns whose names the operator uses for its own output give way."""
    return df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])
