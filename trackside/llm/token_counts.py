"""Token counts of documents in flat token files, found by scanning for the end-of-document id."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackside.llm.store import keep
from trackside.llm.tokens import tokenizer_path, word_tokenizer

#: The end-of-document id of the word tokenizer.
END_ID = 49407
WIDTH = 2
BLOCK_TOKENS = 1 << 20
_NO_ID = -(2**63)


def write_token_files(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    tokenizer: str | None = None, end_id: int = END_ID,
) -> None:
    """Write ``path/kind=tokens``: flat files of 16-bit ids, each document ended by ``end_id``.

    ``path/kind=ids`` gets the documents' integer ids in the same order, in files of the same
    part numbers. The token files hold ids and nothing else: Spark's text writer writes a document's
    bytes and, as its line separator, those of ``end_id``. Strings of special tokens in a text are
    ordinary text, so no text holds ``end_id``.
    """
    tokenizer = tokenizer or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(tokenizer, True)
        for batch in batches:
            made = pa.array([ids.tobytes() for ids in words.arrays(batch.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("seq"), made],
                ["id", "seq", "ids"],
            )

    rows = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(_NO_ID)).alias("id"),
        F.monotonically_increasing_id().alias("seq"), F.col(f"`{text_col}`").alias("text"),
    ).mapInArrow(run, "id bigint, seq bigint, ids binary")
    both = rows.select("seq", F.explode(F.create_map(
        F.lit("ids"), F.unhex(F.lpad(F.hex("id"), 16, "0")), F.lit("tokens"), F.col("ids"),
    )).alias("kind", "value"))
    separator = end_id.to_bytes(WIDTH, "little").decode("latin-1")
    (
        both.sortWithinPartitions("kind", "seq")
        .select("kind", F.col("value").cast("string").alias("value"))
        .write.partitionBy("kind").option("lineSep", separator).option("encoding", "ISO-8859-1")
        .text(path)
    )


def _blocks(spark: SparkSession, path: str, size: int) -> DataFrame:
    """(file, block, at, size): the files below ``path`` in blocks of ``size`` bytes."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        .select(F.col("path").alias("file"), "length").filter("length > 0")
    )
    last = F.ceil(F.col("length") / size).cast("bigint") - 1
    blocks = files.select("file", "length", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("block"))
    return blocks.select(
        "file", "block", (F.col("block") * size).alias("at"),
        F.least(F.lit(size).cast("bigint"), F.col("length") - F.col("block") * size).alias("size"),
    ).repartition("file", "block")


def _read(file: str, at: int, size: int) -> bytes:
    """Bytes of a file in any store that Arrow reaches."""
    scheme, _, rest = file.partition(":")
    store, path = fs.FileSystem.from_uri(f"{scheme}://{rest}" if not rest.startswith("//") else file)
    with store.open_input_file(path) as f:
        return f.read_at(size, at)


def scan_token_files(
    spark: SparkSession, path: str, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS,
    dtype: str = "<u2",
) -> DataFrame:
    """One row for each document: ``file, ordinal, start, n_tokens, ended``.

    ``path`` holds flat files of ids of any length without an index; ``end_id`` ends a document and
    is not counted. Each block is searched for it at once and gives its separators' places.
    A prefix scan over the blocks' summaries gives, for each block, how many documents and
    tokens come before it and where the last separator is; so a document that begins in one block and ends
    in another, any number of blocks later, gets its start. What follows a file's last separator is
    a document with ``ended`` false. A last incomplete id does not count.
    """
    width = np.dtype(dtype).itemsize

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                data = _read(row.file, row.at, row.size)
                ids = np.frombuffer(data, dtype, len(data) // width)
                ends = np.flatnonzero(ids == end_id).astype(np.int32)
                yield pd.DataFrame({
                    "file": [row.file], "block": [row.block], "n": [len(ids)], "ends": [ends],
                })

    found = keep(
        _blocks(spark, path, block_tokens * width).mapInPandas(
            search, "file string, block bigint, n bigint, ends array<int>"
        ),
        "blocks",
    )
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    nothing = F.lit(0).cast("bigint")
    summary = found.select("file", "block", "n", F.size("ends").alias("n_ends"),
                           F.try_element_at("ends", F.lit(-1)).alias("last"))
    scanned = (
        summary.withColumn("base", F.coalesce(F.sum("n").over(before), nothing))
        .withColumn("ordinal", F.coalesce(F.sum("n_ends").over(before), nothing))
        .withColumn("open", F.coalesce(F.max(F.col("base") + F.col("last") + 1).over(before), nothing))
        .withColumn("is_last", F.lead("block").over(order).isNull())
    )
    joined = found.select("file", "block", "ends").join(scanned, ["file", "block"])
    ended = joined.select(
        "file", "ordinal", "base", "open", "ends", F.posexplode("ends").alias("i", "end")
    )
    start = F.when(F.col("i") == 0, F.col("open")).otherwise(
        F.col("base") + F.try_element_at("ends", F.greatest("i", F.lit(1))) + 1
    )
    whole = ended.select(
        "file", (F.col("ordinal") + F.col("i")).alias("ordinal"), start.alias("start"),
        (F.col("base") + F.col("end") - start).alias("n_tokens"), F.lit(True).alias("ended"),
    )
    opened = F.greatest("open", F.coalesce(F.col("base") + F.col("last") + 1, nothing))
    rest = scanned.filter("is_last").select(
        "file", (F.col("ordinal") + F.col("n_ends")).alias("ordinal"), opened.alias("start"),
        (F.col("base") + F.col("n") - opened).alias("n_tokens"), F.lit(False).alias("ended"),
    ).filter("n_tokens > 0")
    return whole.unionByName(rest)


def document_ids(spark: SparkSession, path: str, block_records: int = 1 << 16) -> DataFrame:
    """(file, ordinal, id) from the files of ids that ``write_token_files`` has written."""
    record = np.dtype([("id", ">i8"), ("end", f"S{WIDTH}")])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids = np.frombuffer(_read(row.file, row.at, row.size), record)["id"].astype(np.int64)
                first = row.at // record.itemsize
                yield pd.DataFrame(
                    {"file": row.file, "ordinal": np.arange(first, first + len(ids)), "id": ids}
                )

    blocks = _blocks(spark, path, block_records * record.itemsize)
    made = blocks.mapInPandas(read, "file string, ordinal bigint, id bigint")
    return made.withColumn("id", F.when(F.col("id") != _NO_ID, F.col("id")))


def part_number(file: str = "file"):
    """The part number in the name of a file that Spark has written."""
    return F.regexp_extract(file, r"/part-(\d+)-[^/]*$", 1).cast("bigint")
