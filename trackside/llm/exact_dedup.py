"""Exact deduplication by two passes over a Bloom filter of text digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackside.llm import filters
from trackside.llm.groups import attach
from trackside.llm.store import keep, packed, unpacked

#: The characters that do not count when texts are compared.
BLANKS = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without any blank; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def _best() -> Column:
    """Of equal texts: the longest original first, then the smallest id, nulls last."""
    return F.min(F.struct(-F.col("n_chars"), F.col("id").isNull(), "id", "row"))


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: ``id, keep_id, group_size, kept, digest``.

    Pass one reads every text once and stores its digest (SHA-256 of the text without blanks);
    the digests are counted into the cells of a filter. Pass two flags the digests whose cells were
    hit twice. Only the flagged rows shuffle, to be grouped by their digest; the rest are known
    to be unique and pass straight through. A group of any size moves as one row per task,
    and its rows are joined to the group's verdict without meeting in one task.

    A null text is an empty one; a null id is kept last; of rows that repeat id and text
    exactly one is kept. An empty table gives an empty result.
    """
    text = F.col(f"`{text_col}`")
    digests = keep(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            F.coalesce(F.char_length(text), F.lit(0)).alias("n_chars"),
            F.sha2(normalised(text), 256).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    total = digests.count()
    blocks = filters.blocks_for(total)
    marked = filters.flagged(
        digests, filters.seen_twice(digests, "digest", blocks), F.col("digest"), blocks, "suspect"
    )
    suspects = keep(marked.filter("suspect").drop("suspect"), "suspects")
    groups = keep(
        suspects.groupBy("digest").agg(
            F.count(F.lit(1)).alias("group_size"), _best().alias("best")
        ),
        "groups",
    )
    repeated = attach(suspects, groups, "digest", "group_size", total).select(
        "id", F.col("best.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), "digest",
    )
    single = marked.filter("not suspect").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), "digest",
    )
    return single.unionByName(repeated)


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; texts that cannot be copies never shuffle."""
    text = F.col(f"`{text_col}`")
    rows = packed(
        docs, id=F.col(f"`{id_col}`"), digest=F.sha2(normalised(text), 256),
        size=F.coalesce(F.char_length(text), F.lit(0)),
    )
    narrow = keep(rows.select("digest"), "digests")
    blocks = filters.blocks_for(narrow.count())
    marked = filters.flagged(
        rows, filters.seen_twice(narrow, "digest", blocks), F.col("digest"), blocks, "suspect"
    )
    order = F.struct(-F.col("size"), F.col("id").isNull(), "id")
    best = marked.filter("suspect").groupBy("digest").agg(F.min(order).alias("best"))
    stay = best.select(F.col("digest"), F.col("best").alias("__best"))
    # A copy's row equals the group's best in length and id; of rows that repeat both, one stays.
    among = marked.filter("suspect").join(
        stay, (marked["digest"] == stay["digest"]) & order.eqNullSafe(F.col("__best")), "left_semi"
    ).dropDuplicates(["digest"])
    return unpacked(marked.filter("not suspect").unionByName(among))
