"""What removing repeated passages by words and by bytes has in common.

Texts are told apart by a digest. Rows with equal texts are one class with a count, so copies
are worked on once, however many there are. A class takes part in the exact step only if an
earlier step suspects a passage of it; for these, texts are brought together by a filter of
fixed size, so that the others never leave the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import cut_lineage

#: Bits of the filter: 1 MB, whatever the tables hold. Beyond some million keys it passes more
#: than it should, which costs a larger shuffle and changes no result.
FILTER_BITS = 23


def digest_of(text: Column) -> Column:
    """16 bytes that stand for a text; a null text is an empty one."""
    return F.substring(F.unhex(F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256)), 1, 16)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, key: a 64-bit hash of the text that costs little."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("key"))


def thinned(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Without most of the rows whose key is not wanted, and with all that are, by a bit map of
    key hashes that is at most 2^FILTER_BITS bits and can therefore be broadcast."""

    def place(column: str) -> Column:
        return F.pmod(F.xxhash64(F.col(column)), F.lit(1 << FILTER_BITS)) + 1

    maps = (
        wanted.select(place(key).alias("p")).distinct()
        .groupBy(F.bitmap_bucket_number("p").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("_bits"))
    )
    at = F.bitmap_bit_position(place(key))
    byte = F.conv(F.hex(F.expr("substring(_bits, int(_at div 8) + 1, 1)")), 16, 10).cast("int")
    return (
        rows.withColumns({"_bucket": F.bitmap_bucket_number(place(key)), "_at": at})
        .join(F.broadcast(maps), "_bucket")
        .filter(F.getbit(byte, F.col("_at") % 8) == 1)
        .drop("_bucket", "_at", "_bits")
    )


def suspects(docs: DataFrame, found: DataFrame) -> DataFrame:
    """digest, copies, text, runs of the texts with suspected runs, as a stored table. `found`
    has key and runs, a row for each key."""
    found = cut_lineage(found, "runs")
    near = thinned(docs.select("text", "key"), found, "key").join(found, "key")
    return cut_lineage(
        near.groupBy(digest_of(F.col("text")).alias("digest")).agg(
            F.count("*").alias("copies"), F.first("text").alias("text"), F.first("runs").alias("runs")
        ),
        "suspects",
    )


def by_key(runs: DataFrame) -> DataFrame:
    """key, runs from rows of key, lo, hi (first and last suspected window start)."""
    return runs.distinct().groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
