"""Line and exact deduplication, and the n-gram join, on rows that are easy to get wrong."""

from __future__ import annotations

import random
import re
from itertools import combinations

from pyspark.sql import functions as F

from trackside.llm import exact_dedup, jaccard_join, line_dedup

BITS = 1 << 16


def brute_lines(docs: list[tuple], least: int = 10) -> dict:
    blanks = " \t\n\x0b\x0c\r"

    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(blanks))

    order = lambda i: (i is None, i or 0)
    holders: dict = {}
    for i, text in docs:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    made = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or min(holders[key(x)], key=order) == i]
        made.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(made, key=str)


def test_lines_of_odd_documents(odd_docs, no_docs):
    made = line_dedup.drop_repeated_lines(odd_docs, filter_bits=BITS)
    assert set(made.columns) == {*odd_docs.columns, "n_dropped"}
    rows = [(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in made.collect()]
    docs = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert sorted(rows, key=str) == brute_lines(docs)
    assert line_dedup.drop_repeated_lines(no_docs, filter_bits=BITS).count() == 0


def test_a_full_filter_changes_nothing(odd_docs):
    few = line_dedup.drop_repeated_lines(odd_docs, filter_bits=64).select("doc_id", "text", "n_dropped")
    many = line_dedup.drop_repeated_lines(odd_docs, filter_bits=BITS).select("doc_id", "text", "n_dropped")
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))


def test_exact_verdicts(spark, odd_docs, no_docs):
    rows = [(5, "a b"), (4, "ab "), (3, "a\tb"), (2, None), (1, ""), (7, "x"), (7, "x"), (None, "ab c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = exact_dedup.verdicts(docs).collect()
    by = {}
    for r in found:
        by.setdefault(r.id, []).append((r.keep_id, r.group_size, r.kept))
    assert by[5] == [(3, 3, False)] and by[4] == [(3, 3, False)] and by[3] == [(3, 3, True)]
    assert by[2] == [(1, 2, False)] and by[1] == [(1, 2, True)]
    assert sorted(by[7]) == [(7, 2, False), (7, 2, True)]
    assert by[None] == [(None, 1, True)]
    assert exact_dedup.verdicts(no_docs).count() == 0
    stay = exact_dedup.survivors(odd_docs)
    assert stay.columns == odd_docs.columns
    assert stay.count() == exact_dedup.verdicts(odd_docs).filter("kept").count()
    assert exact_dedup.survivors(docs).count() == 4


def brute_groups(docs: list[tuple], size: int, percent: int) -> dict:
    sets = {}
    for i, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        grams = {tuple(words[j : j + size]) for j in range(len(words) - size + 1)}
        sets[i] = grams or ({tuple(words)} if words else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: (len(sets[i]), root(i)) for i in sets}


def near_texts(seed: int, n: int, words: int) -> list[str]:
    """Copies of some texts in which a few words differ, chains included."""
    rng = random.Random(seed)
    bases = [[f"w{rng.randrange(400)}" for _ in range(words)] for _ in range(4)]
    texts = []
    for _ in range(n):
        text = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            text[rng.randrange(len(text))] = f"v{rng.randrange(5)}"
        texts.append(" ".join(text[: rng.choice([words, words, words - 3, words // 2])]))
    return texts


def test_near_duplicates_are_those_of_all_pairs(spark, stored):
    docs = list(enumerate([*near_texts(1, 90, 60), *near_texts(2, 60, 12), "", None, "a b", "A  b", "a"]))
    df = stored(spark.createDataFrame(docs, "doc_id bigint, text string"), "near")
    for size, percent in ((4, 85), (2, 70)):
        found = jaccard_join.near_duplicates(df, size=size, percent=percent).collect()
        assert {r.id: (r.n_shingles, r.component_id) for r in found} == brute_groups(docs, size, percent)


def test_links_are_all_pairs(spark, stored, monkeypatch):
    """Many different near copies, a chain, equal sets and repeated ids: no pair is left out."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    docs = list(enumerate([*near_texts(3, 70, 60), *near_texts(4, 30, 12), "", None, "a b", "A  b", "a"]))
    docs.append((3, "a b"))
    base = " ".join(f"u{i}" for i in range(60))
    docs += [(200 + i, f"{base} end{i}") for i in range(12)]
    docs += [(300 + i, " ".join(f"c{j}" for j in range(i, i + 80))) for i in range(0, 20, 2)]
    size, percent = 4, 85
    df = stored(spark.createDataFrame(docs, "doc_id bigint, text string"), "linked")
    members, pairs = (x.collect() for x in jaccard_join.links(df, size=size, percent=percent))
    text = {r.row: r.text for r in df.withColumn("row", F.monotonically_increasing_id()).collect()}
    sets = {}
    for row, said in text.items():
        words = (said or "").lower().split()
        grams = {tuple(words[j : j + size]) for j in range(len(words) - size + 1)}
        sets[row] = frozenset(grams or ({tuple(words)} if words else ()))

    def near(x, y):
        return bool(x and y) and 100 * len(x & y) >= percent * len(x | y)

    assert {r.row: r.n_links for r in members} == {
        i: sum(near(sets[i], sets[j]) for j in sets if j != i) for i in sets
    }
    reps = {r.class_row for r in members}
    assert all(sets[r.row] == sets[r.class_row] for r in members)
    found = [(r.a, r.b) for r in pairs]
    assert len(found) == len(set(found))
    assert set(found) == {(i, j) for i, j in combinations(sorted(reps), 2) if near(sets[i], sets[j])}
    groups = {r.row: r.component_id for r in jaccard_join.near_duplicates(df, size=size, percent=percent).collect()}
    assert all(groups[a] == groups[b] for a, b in found)
    ids = {r.row: r.id for r in members}
    assert sum(200 <= ids[a] < 212 and 200 <= ids[b] < 212 for a, b in found) == 12 * 11 // 2


def test_near_duplicates_when_scans_are_dealt_anew(spark, stored, monkeypatch):
    """Each table that is stored changes how the next scan deals its files to tasks."""
    docs = list(enumerate([*near_texts(1, 90, 60), *near_texts(2, 60, 12), "", None]))
    df = stored(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(12), "dealt")
    whole, setting, turn = jaccard_join.keep, "spark.sql.files.maxPartitionBytes", []
    before = spark.conf.get(setting)

    def shifting(made, name):
        out = whole(made, name)
        turn.append(name)
        spark.conf.set(setting, ("1k", "64m", "4m")[len(turn) % 3])
        return out

    monkeypatch.setattr(jaccard_join, "keep", shifting)
    try:
        found = jaccard_join.near_duplicates(df, size=4, percent=85).collect()
        stay = sorted(r.doc_id for r in jaccard_join.survivors(df, size=4, percent=85).collect())
    finally:
        spark.conf.set(setting, before)
    wanted = brute_groups(docs, 4, 85)
    assert {r.id: (r.n_shingles, r.component_id) for r in found} == wanted
    assert stay == sorted({root for _, root in wanted.values()})


def test_near_duplicates_of_odd_documents(odd_docs, no_docs, stored):
    docs = stored(odd_docs, "odd")
    found = jaccard_join.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    by = {(r.id, r.kept): r for r in found}
    assert by[(6, True)].component_id == by[(7, False)].component_id == 6
    assert (4, True) in by and (4, False) in by
    assert by[(1, True)].n_shingles == 0
    stay = jaccard_join.survivors(docs)
    assert stay.columns == odd_docs.columns and stay.count() == sum(r.kept for r in found)
    assert jaccard_join.survivors(stored(no_docs, "none")).count() == 0


def test_regular_words_are_not_taken_for_each_other(spark, stored):
    """A word of 1,024 letters and its complement share nothing."""
    words = ["".join(pair[bin(i).count("1") % 2] for i in range(1024)) for pair in ("ab", "ba")]
    docs = stored(spark.createDataFrame(list(enumerate(words)), "doc_id bigint, text string"), "regular")
    found = jaccard_join.near_duplicates(docs, size=4, percent=85).collect()
    assert {(r.id, r.n_shingles, r.component_id) for r in found} == {(0, 1, 0), (1, 1, 1)}


def test_prefixes_hold_what_a_partner_needs():
    for n in range(1, 200):
        for percent in (80, 85, 100):
            kept = n - jaccard_join._prefix_length(n, percent)
            assert 100 * kept < percent * n


def test_only_some_texts_shuffle(odd_docs):
    stay = exact_dedup.survivors(odd_docs)
    plan = stay._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BroadcastHashJoin" in plan
