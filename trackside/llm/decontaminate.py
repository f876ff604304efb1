"""Benchmark decontamination: a prefix-filtered join of item windows with document texts."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackside.llm import textscan
from trackside.llm.store import keep

#: Windows that are searched at once: a block of at most so many is broadcast, more than that
#: are searched in several passes.
BLOCK_WINDOWS = 200_000
#: Words of a shingle, the tokens whose rarity orders a window.
SHINGLE = 3
HITS = "array<struct<start:int,end:int,item:string>>"


def item_windows(items: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(words, items): the distinct windows, words joined by a space, and the items that have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = batch.column("item").to_pylist(), []
            for at, data, offsets in textscan.pieces(batch.column("text")):
                w = textscan.words(data, offsets, textscan.ALPHANUMERIC)
                for i in range(len(offsets) - 1):
                    said = [w.word(j) for j in range(w.first[i], w.first[i + 1])]
                    for j in range(min(1, len(said)) + max(0, len(said) - size)):
                        found.append((b" ".join(said[j : j + size]), ids[at + i]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.binary()),
                 pa.array([x for _, x in found], pa.string())], ["words", "item"],
            )

    texts = items.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("item"),
        F.col(f"`{text_col}`").alias("text"),
    )
    rows = texts.mapInArrow(run, "words binary, item string")
    return rows.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items"))


@dataclass
class Window:
    """A window: the hashes of its words and of its shingles."""

    said: list[bytes]
    items: list[str]
    hashes: np.ndarray
    tokens: np.ndarray


def _window(said: bytes, items: list[str]) -> Window:
    data = np.frombuffer(said, np.uint8)
    w = textscan.words(data, np.array([0, len(data)]), textscan.ALPHANUMERIC)
    tokens = textscan.shingles(w.hashes, min(SHINGLE, len(w.hashes)))
    return Window(said.split(b" "), list(items), w.hashes, tokens)


class Index:
    """The windows of a block by their rarest shingle, the one prefix token that full containment needs."""

    def __init__(self, windows: list[Window], counts: dict[int, int]) -> None:
        self.windows = windows
        self.sizes = sorted({min(SHINGLE, len(w.hashes)) for w in windows})
        by_token = defaultdict(list)
        for i, w in enumerate(windows):
            order = [(counts.get(int(t), 0), int(t)) for t in w.tokens]
            offset = order.index(min(order))
            by_token[order[offset][1]].append((i, offset))
        self.tokens = np.array(sorted(by_token), np.uint64)
        listed = [by_token[int(t)] for t in self.tokens]
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in listed])]).astype(np.int64)
        flat = np.array([x for y in listed for x in y], np.int64).reshape(-1, 2)
        self.window, self.offset = flat[:, 0], flat[:, 1]
        self.lengths = np.array([len(w.hashes) for w in windows], np.int64)
        widest = int(self.lengths.max(initial=1))
        self.hashes = np.zeros((len(windows), widest), np.uint64)
        for i, w in enumerate(windows):
            self.hashes[i, : len(w.hashes)] = w.hashes
        self.coarse = np.zeros(1 << 16, bool)
        self.coarse[(self.tokens >> np.uint64(48)).astype(np.int64)] = True

    def candidates(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, token number) wherever a prefix token stands."""
        at, token = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for size in self.sizes:
            found = textscan.shingles(hashes, size)
            near = np.flatnonzero(self.coarse[(found >> np.uint64(48)).astype(np.int64)])
            place = np.searchsorted(self.tokens, found[near])
            place[place == len(self.tokens)] = 0
            same = self.tokens[place] == found[near]
            at.append(near[same])
            token.append(place[same])
        return np.concatenate(at), np.concatenate(token)

    def occurrences(self, w: textscan.Words) -> Iterator[tuple[int, int, int, list[str]]]:
        """(text, start, end, items) of every occurrence of a window; places count words of the text."""
        at, token = self.candidates(w.hashes)
        if not len(at):
            return
        many = self.first[token + 1] - self.first[token]
        entry = np.repeat(self.first[token] - np.cumsum(many) + many, many) + np.arange(many.sum())
        window = self.window[entry]
        start = np.repeat(at, many) - self.offset[entry]
        end = start + self.lengths[window]
        # Position and length: the whole window has to lie in the text that has the token.
        text = np.searchsorted(w.first, np.repeat(at, many), "right") - 1
        fits = (start >= w.first[text]) & (end <= w.first[text + 1])
        for j in range(self.hashes.shape[1]):
            rows = np.flatnonzero(fits & (self.lengths[window] > j))
            fits[rows] &= w.hashes[start[rows] + j] == self.hashes[window[rows], j]
        order = np.flatnonzero(fits)
        for k in order[np.lexsort((end[order], start[order], text[order]))]:
            known = self.windows[window[k]]
            if all(w.word(start[k] + j) == x for j, x in enumerate(known.said)):
                base = w.first[text[k]]
                yield text[k], int(start[k] - base), int(end[k] - base), known.items


def _token_counts(texts: DataFrame, tokens: np.ndarray, sizes: list[int]) -> dict[int, int]:
    """How often each token of the block stands in all documents."""
    wanted = texts.sparkSession.sparkContext.broadcast(np.unique(tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = wanted.value
        total = np.zeros(len(known) + 1, np.int64)
        coarse = np.zeros(1 << 16, bool)
        coarse[(known >> np.uint64(48)).astype(np.int64)] = True
        for batch in batches:
            for _, data, offsets in textscan.pieces(batch.column("text")):
                w = textscan.words(data, offsets, textscan.ALPHANUMERIC)
                for size in sizes:
                    found = textscan.shingles(w.hashes, size)
                    found = found[coarse[(found >> np.uint64(48)).astype(np.int64)]]
                    place = np.searchsorted(known, found)
                    place[known[np.minimum(place, len(known) - 1)] != found] = len(known)
                    total += np.bincount(place, minlength=len(known) + 1)
        some = np.flatnonzero(total[:-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["token", "n"]
        )

    sums = texts.mapInArrow(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    known = wanted.value
    return {int(known[r.token]): r.n for r in sums.collect()}


def _search(index: Broadcast) -> Column:
    """A column function: the occurrences of the block's windows in a text."""

    @F.arrow_udf(f"struct<n_words:bigint,hits:{HITS}>")
    def search(texts: pa.Array) -> pa.Array:
        n_words, hits = [], []
        for _, data, offsets in textscan.pieces(texts):
            w = textscan.words(data, offsets, textscan.ALPHANUMERIC)
            n_words += np.diff(w.first).tolist()
            found = [[] for _ in range(len(offsets) - 1)]
            for text, start, end, items in index.value.occurrences(w):
                found[text] += [{"start": start, "end": end, "item": x} for x in items]
            hits += found
        hit = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("item", pa.string())])
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), pa.array(hits, pa.list_(hit))], ["n_words", "hits"]
        )

    return search


def words_hit(hits: Column) -> Column:
    """The number of words that lie in any occurrence."""
    state = "struct<reach:int,n:bigint>"
    start = F.struct(F.lit(0).alias("reach"), F.lit(0).alias("n")).cast(state)

    def step(acc: Column, hit: Column) -> Column:
        reach = F.greatest(acc["reach"], hit["end"])
        more = F.greatest(F.lit(0), hit["end"] - F.greatest(acc["reach"], hit["start"]))
        return F.struct(reach.alias("reach"), (acc["n"] + more).alias("n")).cast(state)

    return F.aggregate(F.sort_array(hits), start, step)["n"]


def benchmark_hits(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", size: int = 10, block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (start, end, item), ``n_hit`` and ``items``.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. An item's windows
    are its runs of ``size`` words; a shorter item is one window, one without words has
    none. Every occurrence of a window in a text is a hit, in word positions, end exclusive; ``n_hit``
    counts the words inside any hit, ``items`` are the items with a hit, as strings in order.

    The windows are joined to the texts by a prefix filter. A window's shingles of three words are
    ordered by how often they occur in all documents; as a window must be contained whole, its
    rarest shingle is the prefix that is necessary. Where it stands in a text, the window's
    place follows; it must lie in the text (length and position), have the same word hashes,
    and then the same words. Documents stay where they are. The windows are broadcast in blocks of
    at most ``block_windows``; one more block is one more pass over the documents.

    Null and empty texts have no words. Results replace columns of their names.
    """
    made = ("n_words", "hits", "n_hit", "items")
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (text_col, *made)]
    rows = docs.select(
        F.struct(*rest).alias("__rest") if rest else F.struct(F.lit(0).alias("__none")).alias("__rest"),
        F.col(f"`{text_col}`").alias("text"),
        F.lit(0).cast("bigint").alias("n_words"), F.array().cast(HITS).alias("hits"),
    )
    windows = keep(item_windows(items, item_col, item_text_col, size), "windows")
    blocks = max(1, -(-windows.count() // block_windows))
    context = docs.sparkSession.sparkContext
    for block in range(blocks):
        part = windows.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == block)
        known = [_window(bytes(r["words"]), r["items"]) for r in part.toLocalIterator()]
        counts = {}
        if known:
            sizes = sorted({min(SHINGLE, len(w.hashes)) for w in known})
            counts = _token_counts(rows.select("text"), np.concatenate([w.tokens for w in known]), sizes)
        index = context.broadcast(Index(known, counts))
        rows = rows.withColumn("__found", _search(index)("text")).select(
            "__rest", "text", F.col("__found.n_words").alias("n_words"),
            F.concat("hits", "__found.hits").alias("hits"),
        )
        if block + 1 < blocks:
            rows = keep(rows, "hits")
    columns = [
        F.col("text").alias(c) if c == text_col else F.col("__rest")[c].alias(c)
        for c in docs.columns if c not in made
    ]
    return rows.select(
        *columns, "n_words", "hits", words_hit(F.col("hits")).alias("n_hit"),
        F.array_sort(F.array_distinct(F.col("hits.item"))).alias("items"),
    )
