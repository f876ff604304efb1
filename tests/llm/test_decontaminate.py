from __future__ import annotations

import random
import re

from trackside.llm import decontaminate


def said(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, size):
    windows = {}
    for i, text in items:
        w = said(text)
        for j in range(len(w) and max(1, len(w) - size + 1)):
            windows.setdefault(tuple(w[j : j + size]), set()).add(str(i))
    made = []
    for i, text in docs:
        w, hit, found = said(text), set(), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit |= set(range(j, j + n))
                    found |= windows[tuple(w[j : j + n])]
        made.append((i, len(w), len(hit), sorted(found)))
    return sorted(made, key=str)


def test_hits_are_those_of_every_window(spark):
    rng = random.Random(3)
    words = ["a", "b", "É", "d1", "the"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 4, 5, 9])))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "..."), (None, "a b a b a b"), (53, "THE-the")]
    docs = [(i, " ".join(rng.choice([*words, "A", "x;"]) for _ in range(rng.randrange(80)))) for i in range(60)]
    docs += [(70, None), (71, ""), (72, "the  The."), (72, "the  The."), (None, "a-b-a-b-a-b")]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    known = [("" if i is None else i, t) for i, t in items]
    for size, block in ((4, 1000), (4, 7), (10, 1000)):
        made = decontaminate.benchmark_hits(table, asked, size=size, block_windows=block)
        rows = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in made.collect()]
        assert sorted(rows, key=str) == brute(docs, known, size)


def test_odd_documents(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "word19999 and its end")], "item_id bigint, text string")
    made = decontaminate.benchmark_hits(odd_docs, items)
    assert set(odd_docs.columns) <= set(made.columns)
    assert {r.doc_id: (r.n_hit, r["items"]) for r in made.filter("n_hit > 0").collect()} == {7: (4, ["1"])}
    assert made.count() == odd_docs.count()
    assert decontaminate.benchmark_hits(no_docs, items).count() == 0
    assert decontaminate.benchmark_hits(odd_docs, items.limit(0)).filter("n_hit > 0").count() == 0
