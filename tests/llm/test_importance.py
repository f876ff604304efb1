"""Importance resampling against plain Python, and exact ranks by regular sampling."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trackside.llm import importance

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def runs_of(text, longest):
    words = WORDS.findall((text or "").translate(LOWER))
    return [(zlib.crc32(" ".join(words[i : i + n]).encode()) % 10_000, n)
            for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("window", [1, 2, 5, 17, 64, 1 << 22])
@pytest.mark.parametrize("longest", [1, 2, 3])
def test_runs_of_texts_cut_anywhere(window, longest):
    draw = random.Random(3)
    texts = [None, "", "Ab", " é zz Q1 " * 7, "a" * 300 + " b", "", None, "ab", "cd", "ABC-def " * 30, "x" * 200]
    texts += ["".join(draw.choice("aB é-\n") for _ in range(draw.randint(0, 60))) for _ in range(40)]
    got = []
    for text, bucket, size in importance.run_buckets(pa.array(texts, pa.string()), longest, 10_000, window):
        got += zip(text.tolist(), bucket.tolist(), size.tolist(), strict=True)
    assert sorted(got) == sorted((i, b, n) for i, t in enumerate(texts) for b, n in runs_of(t, longest))


def brute(docs, target, percent, seed, longest, least):
    corpus, wanted = Counter(), Counter()
    for _, text in docs:
        corpus.update(b for b, _ in runs_of(text, longest))
    for text in target:
        wanted.update(b for b, _ in runs_of(text, longest))
    s, t = corpus.total(), wanted.total()
    made = []
    for n, (doc, text) in enumerate(docs):
        runs = runs_of(text, longest)
        gains = [math.floor(1000 * math.log((wanted[b] + 1) * (s + 10_000) / ((corpus[b] + 1) * (t + 10_000))))
                 for b, _ in runs]
        weight = sum(gains) // len(gains) if gains else 0
        said = f"{seed}:{'' if doc is None else doc}".encode()
        h = int(hashlib.sha256(said).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        made.append([doc, len(runs), weight, score, None, n, sum(size == 1 for _, size in runs)])
    order = sorted((r for r in made if r[6] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[5]))
    for place, row in enumerate(order[: len(order) * percent // 100], 1):
        row[4] = place
    return made


@pytest.mark.parametrize(("longest", "least", "percent"), [(1, 0, 100), (1, 2, 30), (2, 1, 50), (1, 1000, 10)])
def test_resampling_is_that_of_plain_python(spark, odd_docs, stored, longest, least, percent):
    docs = stored(odd_docs, "odd")
    target = spark.createDataFrame([("line of text",), (None,), ("document",)], "text string")
    made = importance.resample(docs, target, percent, 7, longest, least, segment_rows=2).collect()
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    expected = brute(rows, ["line of text", None, "document"], percent, 7, longest, least)
    # Rows that repeat an id and a text tie: which of them has which rank is open.
    assert sorted((tuple(r) for r in made), key=str) == sorted((tuple(r[:5]) for r in expected), key=str)


def test_empty_tables(spark, no_docs, odd_docs, stored):
    target = spark.createDataFrame([("word",)], "text string")
    assert importance.resample(no_docs, target).count() == 0
    assert importance.resample(stored(odd_docs, "odd2"), target.limit(0), least_words=0).count() == 10


def test_ranks_are_exact_with_hot_scores(spark, stored):
    """A third of all rows share a score, ids repeat, and segments are small."""
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 11 != 0, F.expr("id div 2")).alias("id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(500)) - 250).cast("bigint").alias("score"),
        F.monotonically_increasing_id().alias("row"), (F.col("id") % 5).alias("n_words"),
    )
    runs = stored(rows.repartition(7).sortWithinPartitions(*importance._order()), "runs")
    table = runs.toPandas()
    empty = table["id"].isna()
    chosen = table["n_words"] >= 1
    order = np.lexsort((table["row"], table["id"].fillna(0), empty, -table["score"]))
    order = order[chosen.to_numpy()[order]]
    for draw in (0, 1, 1234, len(order)):
        made = importance.ranked(runs, draw, "n_words >= 1", segment_rows=300)
        got = dict(made.filter("rank is not null").select("rank", "row").collect())
        assert got == {i + 1: table["row"][n] for i, n in enumerate(order[:draw])}
        assert made.count() == 20_000
    samples = importance._sample(runs, 50)
    sizes = [r["count"] for r in importance._segmented(runs, samples[::10]).groupBy("segment").count().collect()]
    assert max(sizes) < 3 * 20_000 / len(sizes)
