"""What several operators share: words, shares of documents by checksum, small helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def lower_words(text: str | None) -> list[bytes]:
    """UTF-8 words between ASCII white space, A-Z lower-cased; ``bytes`` methods touch ASCII only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def checksum(ident: Column) -> Column:
    """CRC-32 of an id written as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary"))


def word_count(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("bigint")


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
