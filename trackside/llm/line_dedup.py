"""Line deduplication: two Bloom filters find the lines that may repeat, and only those shuffle."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackside.llm import filters, tables
from trackside.llm.groups import attach
from trackside.llm.store import keep

BLANKS = " \t\n\x0b\x0c\r"
#: Cells of each filter: 64 million bits, 8 MB. More lines than about ten million fill it
#: up; then more lines than necessary are checked, and none is missed.
FILTER_BITS = 1 << 26


def line_key(line: str, least: int) -> bytes | None:
    """The digest of a line that counts: stripped of blanks, A-Z lower-cased, ``least`` code points."""
    line = line.strip(BLANKS)
    if len(line) < least:
        return None
    return blake2b(line.encode().lower(), digest_size=16).digest()


def _keys(texts: pd.Series, least: int) -> list[set[bytes]]:
    """The distinct keys of each text."""
    found = []
    for text in texts:
        keys = {line_key(line, least) for line in (text or "").split("\n")}
        keys.discard(None)
        found.append(keys)
    return found


def _places(keys: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each key."""
    halves = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2) & np.uint64(bits - 1)
    return halves[:, 0].astype(np.int64), halves[:, 1].astype(np.int64)


def _fold(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Filters of two tasks (bit 0 seen, bit 1 seen twice): what both have seen is seen twice."""
    return a | b | ((a & b & 1) << 1)


def _seen_twice(texts: DataFrame, least: int, bits: int) -> np.ndarray:
    """The packed filter of the keys that may stand in two rows."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = np.zeros(bits, np.uint8)
        for batch in batches:
            for at in range(0, len(batch), 512):
                rows = _keys(batch["text"].iloc[at : at + 512], least)
                keys = [k for row in rows for k in row]
                if not keys:
                    continue
                once = list(set(keys))
                number = {k: i for i, k in enumerate(once)}
                counts = np.bincount([number[k] for k in keys], minlength=len(once))
                first, second = _places(once, bits)
                again = (counts > 1) | ((cells[first] & cells[second] & 1) == 1)
                cells[first] |= 1
                cells[second] |= 1
                cells[first[again]] |= 2
                cells[second[again]] |= 2
        yield from tables.segments(cells)

    made = texts.mapInPandas(build, tables.SCHEMA)
    return np.packbits(tables.whole(made, bits, "uint8", _fold) & 2 > 0)


def _suspects(docs: DataFrame, least: int, bits: int) -> DataFrame:
    """(id, key) of every line that may repeat, once for each row."""
    spark = docs.sparkSession
    twice = spark.sparkContext.broadcast(_seen_twice(docs.select("text"), least, bits))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = twice.value
        for batch in batches:
            rows = _keys(batch["text"], least)
            keys = [k for row in rows for k in row]
            if not keys:
                continue
            ids = batch["id"].repeat([len(row) for row in rows]).reset_index(drop=True)
            hit = np.ones(len(keys), bool)
            for place in _places(keys, bits):
                hit &= (cells[place >> 3] >> (7 - (place & 7))) & 1 == 1
            yield pd.DataFrame({"id": ids[hit], "key": np.array(keys, object)[hit]})

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInPandas(run, f"id {kind}, key binary")


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 10,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """``docs`` with repeated lines left out of the text, ``n_lines`` before and ``n_dropped``.

    Lines are what stands between line breaks; a null or empty text is one empty line. A line
    counts by its key: blanks stripped at both ends, A-Z lower-cased, ``least`` code points
    at least. A key held by two documents or more keeps its lines only in the smallest id that holds
    it; there all of them stay. Rows that repeat an id are one document, and so are all rows
    without id, which comes after the others.

    Every task notes in two Bloom filters the keys it has seen and those it has seen twice; what
    two tasks have seen is seen twice as well. Only (id, key) of lines in the second
    filter shuffle, to confirm the repeat and find the smallest id. Texts shuffle only for
    documents that lose lines, found by a filter of their ids; the others pass straight.
    ``n_lines`` and ``n_dropped`` replace columns of these names.
    """
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    found = keep(_suspects(narrow, least, filter_bits), "suspects")
    total = found.count()
    holders = keep(
        found.groupBy("key").agg(
            F.min("id").alias("first"), F.max("id").alias("last"),
            F.count(F.lit(1)).alias("holders"), F.count("id").alias("named"),
        ).filter("first <> last or (named > 0 and named < holders)"),
        "holders",
    )
    lost = keep(
        attach(found, holders.select("key", "first", "holders"), "key", "holders", total)
        .filter(~F.col("id").eqNullSafe(F.col("first")))
        .groupBy("id").agg(F.collect_set("key").alias("__lost")),
        "lost",
    )
    blocks = filters.blocks_for(lost.count())
    bloom = filters.seen(lost.select("id"), "id", blocks)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")]
    rows = docs.select(F.struct(*rest).alias("__rest"), F.col(f"`{id_col}`").alias("__id"),
                       text.alias("__text"))
    marked = filters.flagged(rows, bloom, F.col("__id"), blocks, "__may_lose")
    breaks = F.char_length("__text") - F.char_length(F.replace("__text", F.lit("\n"), F.lit("")))
    straight = marked.filter("not __may_lose").select(
        "__rest", "__text", (breaks + 1).cast("bigint").alias("n_lines"),
        F.lit(0).cast("bigint").alias("n_dropped"),
    )

    @F.pandas_udf("text string, n_lines bigint, n_dropped bigint")
    def cleaned(texts: pd.Series, lost_keys: pd.Series) -> pd.DataFrame:
        rows = []
        for text, keys in zip(texts, lost_keys, strict=True):
            lines = text.split("\n")
            gone = set(keys) if keys is not None else set()
            kept = [x for x in lines if line_key(x, least) not in gone] if gone else lines
            rows.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
        return pd.DataFrame(rows, columns=["text", "n_lines", "n_dropped"])

    changed = (
        marked.filter("__may_lose")
        .join(lost, F.col("__id").eqNullSafe(lost["id"]), "left")
        .select("__rest", cleaned("__text", "__lost").alias("made"))
        .select("__rest", F.col("made.text").alias("__text"), "made.n_lines", "made.n_dropped")
    )
    result = straight.unionByName(changed)
    columns = [
        F.col("__text").alias(c) if c == text_col else F.col("__rest")[c].alias(c)
        for c in docs.columns if c not in ("n_lines", "n_dropped")
    ]
    return result.select(*columns, "n_lines", "n_dropped")
