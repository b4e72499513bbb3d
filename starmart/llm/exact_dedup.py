"""Exact dedup: two-pass Bloom filtering finds possibly repeated hashes; only those rows shuffle.

Pass 1 sets two bits of a blocked Bloom filter for every text and counts how often each bit is set. The bits set at
least twice make the second filter, whose size is bounded by ``filter_bits`` whatever the input. Pass 2 tests every
text against it: a text one of whose bits was set once occurs once and passes straight through; the others shuffle by
their full SHA-256 and are grouped exactly. A filter that is too full only sends more rows to the exact grouping; it
never changes a result.

Two texts are equal when they are identical after deleting white space (space and U+0009 to U+000D); a null text
counts as empty. Of equal texts the one with most code points stays, then the smallest id (null ids last), then one of
the rows that still tie. Empty tables give empty results. Other columns are carried and never read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.session import checkpointed

#: Bits in a block: one bitmap of Spark's bitmap functions.
BLOCK = 32_768
#: Bits for each row, and the bound of the whole filter: 2**28 bits are 32 MB on an executor.
BITS_PER_ROW = 16
MAX_FILTER_BITS = 1 << 28


def squeezed(text: Column) -> Column:
    """The text that is compared."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def filter_blocks(rows: int, max_bits: int = MAX_FILTER_BITS) -> int:
    return max(1, min(max_bits, rows * BITS_PER_ROW) // BLOCK)


def bit_columns(digest: str, blocks: int) -> dict[str, Column]:
    """Block and two bit positions of a hex digest, from disjoint digits of it."""
    part = lambda at, n: F.conv(F.substring(digest, at, n), 16, 10).cast("bigint")
    return {
        "_block": part(1, 12) % blocks,
        "_bit1": (part(13, 8) % BLOCK).cast("int"),
        "_bit2": (part(21, 8) % BLOCK).cast("int"),
    }


def repeated_filter(digests: DataFrame, blocks: int, digest: str = "text_sha256") -> DataFrame:
    """Pass 1: (block, bitmap) of the bits that were set at least twice; at most ``blocks`` rows of 4 KB."""
    bits = digests.select(F.col(digest).alias("_d")).select(*[c.alias(n) for n, c in bit_columns("_d", blocks).items()])
    # A text whose two bits coincide sets its bit once.
    bits = bits.select("_block", F.explode(F.array_distinct(F.array("_bit1", "_bit2"))).alias("_bit"))
    twice = bits.groupBy("_block", "_bit").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return twice.groupBy("_block").agg(F.bitmap_construct_agg(F.col("_bit").cast("bigint")).alias("_bitmap"))


def is_set(bitmap: str, bit: str) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("bigint")
    return F.getbit(byte, F.col(bit) % 8) == 1


def marked(rows: DataFrame, filters: DataFrame, blocks: int, digest: str = "text_sha256") -> DataFrame:
    """Pass 2: ``rows`` with ``_maybe``, false only where the text occurs once."""
    tested = rows.withColumns(bit_columns(digest, blocks))
    # Bounded: at most `blocks` bitmaps of 4 KB, blocks * 4 KB <= MAX_FILTER_BITS / 8.
    tested = tested.join(F.broadcast(filters), "_block", "left")
    maybe = F.coalesce(is_set("_bitmap", "_bit1") & is_set("_bitmap", "_bit2"), F.lit(False))
    return tested.withColumn("_maybe", maybe).drop("_block", "_bit1", "_bit2", "_bitmap")


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id (that of the row that stays), group_size, kept, text_sha256.

    The texts are read once; what follows works on their digests. Of rows with the same id and equal texts exactly
    one is kept.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    narrow = checkpointed(
        narrow.select(
            "doc_id",
            F.coalesce(F.length("_text"), F.lit(0)).alias("_length"),
            F.sha2(squeezed(F.col("_text")).cast("binary"), 256).alias("text_sha256"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    blocks = filter_blocks(narrow.count())
    rows = marked(narrow, repeated_filter(narrow, blocks), blocks)
    alone = rows.where(~F.col("_maybe")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    maybe = rows.where("_maybe").drop("_maybe")
    order = F.struct(-F.col("_length"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row"))
    groups = maybe.groupBy("text_sha256").agg(F.min(order).alias("_best"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.select(
        "text_sha256", F.col("_best.doc_id").alias("keep_id"), F.col("_best._row").alias("_keep"), "group_size"
    )
    grouped = maybe.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size", (F.col("_row") == F.col("_keep")).alias("kept"), "text_sha256"
    )
    return alone.unionByName(grouped)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, whole. Rows that the filter finds alone do not shuffle."""
    columns = docs.columns
    rows = docs.select(
        F.struct("*").alias("_doc"), F.sha2(squeezed(F.col(text_col).cast("string")).cast("binary"), 256).alias("_sha")
    )
    blocks = filter_blocks(docs.count())
    rows = marked(rows, checkpointed(repeated_filter(rows, blocks, "_sha")), blocks, "_sha")
    text, key = F.col(f"_doc.`{text_col}`").cast("string"), F.col(f"_doc.`{id_col}`")
    order = F.struct(-F.coalesce(F.length(text), F.lit(0)), key.isNull(), key, text.isNull(), text)
    best = rows.where("_maybe").groupBy("_sha").agg(F.min_by("_doc", order).alias("_doc"))
    kept = rows.where(~F.col("_maybe")).select("_doc").unionByName(best.select("_doc"))
    return kept.select(*[F.col(f"_doc.`{c}`").alias(c) for c in columns])
