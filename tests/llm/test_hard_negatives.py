"""Hard negatives: intervals hold for certain, and the result is that of comparing everything."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackside.llm import hard_negatives as hn

KIND = "vec_id bigint, embedding array<float>, label int, row int, score int, vector string, id string"


@pytest.mark.parametrize("dims", [1, 5, 64, 100])
def test_the_true_score_is_in_every_interval(dims):
    draw = np.random.default_rng(dims)
    rows = np.floor(256 * draw.standard_normal((200, dims))).astype(np.int64)
    rows[0], rows[1], rows[2] = 0, 1, rows[3]
    rows[4], rows[5] = -rows[3], rows[3] * 1000
    turn, anchors = hn.rotation(dims), rows[:30]
    codes, queries = hn.coded(rows, turn), hn.Queries(anchors, turn)
    scores, estimate, loose, widths = anchors @ rows.T, 0.0, 0.0, []
    for level in range(hn.LEVELS):
        low, high, estimate, loose = queries.interval(
            level, np.arange(30)[:, None], codes, np.arange(200)[None, :], estimate, loose
        )
        assert (low <= scores).all() and (scores <= high).all()
        widths.append((high - low).mean())
    assert widths == sorted(widths, reverse=True)


def mined_by_comparing(rows, positives, negatives, low, high, anchor):
    rows = [r for r in rows if None not in r[:3] and all(x is not None and math.isfinite(x) for x in r[1])]
    sizes = [len(r[1]) for r in rows]
    dims = max(set(sizes), key=lambda n: (sizes.count(n), n)) if sizes else 0
    rows = [r for r in rows if len(r[1]) == dims and dims]
    rows = [(i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    found = []
    for a, (i, v, label) in enumerate(rows):
        if not anchor(i):
            continue
        scores = [(-sum(x * y for x, y in zip(v, w, strict=True)), j, b) for b, (j, w, _) in enumerate(rows)]
        near = sorted(s for s in scores if s[2] != a and rows[s[2]][2] == label)[:positives]
        far = sorted(s for s in scores if rows[s[2]][2] != label)
        for p, j, _ in near:
            inside = [s for s in far if low * -p <= 100 * -s[0] <= high * -p][:negatives]
            found += [(i, j, k, s[1], -p, -s[0]) for k, s in enumerate(inside, 1)]
    return sorted(found)


def rows_of(n, dims, labels, seed, hot=0):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((labels, dims))
    made = []
    for i in range(n):
        label = int(draw.integers(labels))
        v = centres[label] * 0.7 + draw.standard_normal(dims) if i % 3 or not hot else np.ones(dims)
        made.append((i, np.float32(v).tolist(), label))
    return made


def mine(spark, stored, rows, name, partitions=3, anchor="id % 20 = 0", **options):
    df = spark.createDataFrame([(*r, 1, 2, "v", "i") for r in rows], KIND)
    label = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    wanted = hn.Wanted(**{k: v for k, v in options.items() if k != "block"})
    made = hn.mine(stored(df.repartition(partitions), name), F.expr(anchor), wanted, label, block=options.get("block", 1024))
    return sorted(tuple(r) for r in made.collect())


@pytest.mark.parametrize("hot", [0, 1])
@pytest.mark.parametrize(("dims", "positives", "negatives", "low", "high", "block"), [
    (8, 5, 10, 30, 90, 1024), (3, 1, 3, -50, 100, 5), (64, 50, 200, 0, 300, 7),
])
def test_mining_is_exact(spark, stored, hot, dims, positives, negatives, low, high, block):
    rows = rows_of(200, dims, 4, 5, hot)
    got = mine(spark, stored, rows, f"v{dims}-{hot}", positives=positives, negatives=negatives, low=low, high=high, block=block)
    assert got == mined_by_comparing(rows, positives, negatives, low, high, lambda i: i % 20 == 0)


def test_thresholds_from_few_rows_lose_nothing(spark, stored, monkeypatch):
    monkeypatch.setattr(hn, "SEED_ROWS", 3)
    rows = rows_of(300, 6, 3, 9, hot=1)
    assert mine(spark, stored, rows, "few") == mined_by_comparing(rows, 5, 10, 30, 90, lambda i: i % 20 == 0)


def test_lists_are_cut_to_their_lengths_on_the_way(monkeypatch):
    """Small batches, few pairs held, and a third of all rows equal: ties are cut by id and row."""
    monkeypatch.setattr(hn, "HELD", 40)
    rows = rows_of(300, 6, 3, 9, hot=1)
    vectors = np.floor(256 * np.array([r[1] for r in rows])).astype(np.int64)
    label, ids = np.array([r[2] for r in rows]), np.arange(300)
    turn, n, keep = hn.rotation(6), 12, 4
    shape = (n, 2)
    low, high = np.full(shape, -1000.0), np.full(shape, 50_000.0)
    high[:, 1] = 400_000.0
    block = hn.Block(vectors[:n], label[:n], ids[:n], False, keep, low, high, np.full(shape, -np.inf))
    search = hn._Search(block, turn)
    for at in range(0, 300, 16):
        part = slice(at, at + 16)
        search.add(vectors[part], label[part], ids[part], ids[part], hn.coded(vectors[part], turn))
        assert sum(len(f[0]) for f in search.found) <= 40 + n * 16 + n * 2 * keep
    a, _, row, score = search.results()
    expected = set()
    for i in range(n):
        for top in (50_000, 400_000):
            fits = [(-int(vectors[i] @ vectors[j]), j) for j in range(300) if label[j] != label[i]]
            expected |= {(i, j, -s) for s, j in sorted(f for f in fits if -1000 <= -f[0] <= top)[:keep]}
    assert set(zip(a.tolist(), row.tolist(), score.tolist(), strict=True)) == expected


def test_rows_that_take_no_part(spark, stored):
    nan, inf = float("nan"), float("inf")
    rows = [*rows_of(60, 4, 2, 1), (None, [1.0] * 4, 1), (100, None, 1), (120, [1.0] * 4, None), (140, [nan, 1.0, 1.0, 1.0], 0),
            (160, [inf, 1.0, 1.0, 1.0], 1), (180, [None, 1.0, 1.0, 1.0], 1), (200, [], 1), (220, [1.0, 2.0], 1),
            (240, [0.0] * 4, 1), (260, [-1.5] * 4, 0)]
    assert mine(spark, stored, rows, "odd") == mined_by_comparing(rows, 5, 10, 30, 90, lambda i: i % 20 == 0)
    assert mine(spark, stored, [(1, [3e38, 3e38], 1), (20, [3e38, 3e38], 1)], "long") == []


def test_repeated_ids_and_lone_anchors(spark, stored):
    """A repeated id is a row of its own; an anchor alone in its label has nothing to mine."""
    rows = [(20, [1.0, 0.0], 1), (20, [1.0, 0.0], 1), (1, [0.5, 0.5], 2), (1, [0.5, 0.5], 2), (40, [0.0, 1.0], 3)]
    assert mine(spark, stored, rows, "again") == [
        (20, 20, 1, 1, 65536, 32768), (20, 20, 1, 1, 65536, 32768), (20, 20, 2, 1, 65536, 32768), (20, 20, 2, 1, 65536, 32768),
    ]


def test_no_vectors(spark, stored):
    assert mine(spark, stored, [], "none") == []
    assert mine(spark, stored, rows_of(30, 4, 2, 1), "no anchor", anchor="false") == []
