"""Token counts and packing against the tokenizer itself."""

from __future__ import annotations

import os
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackside.llm import packing, token_counts, tokens

os.environ["TOKENIZERS_PARALLELISM"] = "false"
TEXTS = [
    "The end. THE end, <|endoftext|> it's ÉTÉ été!!", None, "", " \t\n", "don't 'RE x2y 3.14", "a\x1cb c",
    "ﬁne Σας ΣΑΣ 中文字  x y .", "!? . ,a, b,, c.", "word " * 3000, "<|ENDOFTEXT|> <|x",
]


def whole(plain: bool):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.tokenizer_path())
    tokenizer.encode_special_tokens = plain
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("plain", [False, True])
def test_remembered_chunks_give_the_ids_of_whole_texts(plain, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    words, ids = tokens.WordTokenizer(tokens.tokenizer_path(), plain), whole(plain)
    for _ in range(2):
        got = [np.frombuffer(x, "<u2").tolist() for x in words.ids(TEXTS)]
        assert got == [ids(t) for t in TEXTS]


def test_token_files_are_scanned_in_blocks_of_any_size(spark, tmp_path, odd_docs):
    docs = [*enumerate(TEXTS), (None, "no id"), (3, "again"), (3, "again")]
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    table.write.parquet(f"{tmp_path}/docs")
    stored = spark.read.parquet(f"{tmp_path}/docs")
    token_counts.write_token_files(stored, f"{tmp_path}/files")
    ids = whole(True)
    want = sorted([(i, len(ids(t))) for i, t in docs], key=str)
    for block in (1, 3, 64, 1 << 20):
        found = token_counts.scan_token_files(spark, f"{tmp_path}/files/kind=tokens", block_tokens=block)
        part = token_counts.part_number()
        names = token_counts.document_ids(spark, f"{tmp_path}/files/kind=ids", 2)
        both = found.withColumn("part", part).drop("file").join(
            names.withColumn("part", part).drop("file"), ["part", "ordinal"]
        )
        rows = both.collect()
        assert sorted([(r.id, r.n_tokens) for r in rows], key=str) == want
        ends = defaultdict(int)
        for r in sorted(rows, key=lambda r: (r.part, r.ordinal)):
            assert r.start == ends[r.part] and r.ended
            ends[r.part] += r.n_tokens + 1


def test_files_of_others(spark, tmp_path):
    """No separator, nothing at all, an unended document and half an id."""
    end = token_counts.END_ID
    cases = {"none": [1, 2, 3], "empty": [], "open": [1, end, end, 5, 6], "only": [end]}
    (tmp_path / "f").mkdir()
    for name, ids in cases.items():
        (tmp_path / "f" / name).write_bytes(np.array(ids, "<u2").tobytes() + (b"\x01" if name == "open" else b""))
    for block in (1, 2, 100):
        found = token_counts.scan_token_files(spark, f"{tmp_path}/f", block_tokens=block)
        rows = sorted((r.file.rsplit("/")[-1], r.ordinal, r.start, r.n_tokens, r.ended) for r in found.collect())
        assert rows == [
            ("none", 0, 0, 3, False), ("only", 0, 0, 0, True), ("open", 0, 0, 1, True),
            ("open", 1, 2, 0, True), ("open", 2, 3, 2, False),
        ]


def test_no_documents(spark, tmp_path, no_docs):
    token_counts.write_token_files(no_docs, f"{tmp_path}/files")
    assert token_counts.scan_token_files(spark, f"{tmp_path}/files").count() == 0
    assert packing.pack_documents(no_docs).count() == 0


def test_pieces_fill_sequences_without_gap(spark):
    docs = [*enumerate(TEXTS), *((100 + i, "w x " * (i % 90)) for i in range(400)), (None, "n"), (3, "r"), (3, "r")]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = packing.pack_documents(table, window=64).collect()
    ids = whole(False)
    want = defaultdict(list)
    for i, t in docs:
        full = [*ids(t), packing.END_ID]
        for at in range(0, len(full), 64):
            part = np.array(full[at : at + 64], "<u4").tobytes()
            want[i].append((at, len(part) // 4, zlib.crc32(part), len(full)))
    got = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        got[r.id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {i: sorted(x) for i, x in got.items()} == {i: sorted(x) for i, x in want.items()}
    assert sorted(sequences) == list(range(len(sequences)))
    filled = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
        filled += at
    assert filled > 0.97 * 64 * len(sequences)


def test_plans_use_every_length_up():
    rng = np.random.default_rng(1)
    for histogram in (rng.integers(0, 50, 129), rng.integers(0, 10**9, 129), np.eye(129, dtype=int)[7] * 10**6):
        histogram[0] = 0
        used = np.zeros(129, np.int64)
        for lengths, times in packing.plan(histogram, 128):
            assert sum(lengths) <= 128 and times > 0
            for n in lengths:
                used[n] += times
        assert (used == histogram).all()


def test_ids_are_spread_over_part_files(spark, tmp_path):
    table = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("x y").alias("text")).repartition(4)
    token_counts.write_token_files(table, f"{tmp_path}/t")
    assert token_counts.scan_token_files(spark, f"{tmp_path}/t/kind=tokens").filter("n_tokens = 2").count() == 50


def test_all_that_a_worker_remembers_is_bounded_at_once(monkeypatch):
    """Chunks, the words in them and their marks share one bound; what was forgotten is made again."""
    monkeypatch.setattr(tokens, "REMEMBERED", 20)
    tokenizer = tokens.WordTokenizer(tokens.tokenizer_path(), False)
    words = [f"{a}{b}{mark}" for a in "abcdefgh" for b in ("lpha", "eta", "ËÉ", "1x") for mark in ("", ",", "?!", "...")]
    text = " ".join([*words, *map(str.upper, words), *words])
    assert tokenizer.ids([text]) == [tokenizer._encoded(text)]
    memories = [x for x in vars(tokenizer).values() if isinstance(x, tokens._Memory)]
    assert sum(len(x) + len(x.older) for x in memories) <= 20


def test_distinct_chunks_are_looked_up_once(monkeypatch):
    """A text's chunks go to the tokenizer as often as they differ, not as often as they stand there."""
    tokenizer = tokens.WordTokenizer(tokens.tokenizer_path(), False)
    asked = []
    looked_up = tokenizer._looked_up
    monkeypatch.setattr(tokenizer, "_looked_up", lambda strings: asked.extend(strings.to_pylist()) or looked_up(strings))
    texts = ["Alpha beta, BETA! alpha... gamma" * 50, None, "beta gamma 1x " * 100]
    assert tokenizer.ids(texts) == [tokenizer._encoded(t or "") for t in texts]
    assert len(asked) == len(set(asked)) < 12


def test_texts_of_all_kinds_of_characters(monkeypatch):
    """Every character beside letters and marks, in pieces of every size, gives what the tokenizer gives."""
    tokenizer = tokens.WordTokenizer(tokens.tokenizer_path(), False)
    some = [*map(chr, range(0x250)), *"ẞKÅſİıΣςﬁ\u0301\u0307\u2028\u3000\u200b\ufeff中😀"]
    texts = [f"{c}{c} Ab{c}x été{c} {c}É, a{c}" for c in some]
    texts += ["", None, " ", "x" * 3000, "é" * 100 + "!", "<|endoftext|>a <|endoftext|>", "".join(texts)]
    want = [tokenizer._encoded(t or "") for t in texts]
    for at_once in (1, 50, tokens.AT_ONCE):
        monkeypatch.setattr(tokens, "AT_ONCE", at_once)
        assert tokenizer.ids(texts) == want
    for at in range(0, len(texts), 97):
        assert tokenizer.ids(texts[at : at + 97]) == want[at : at + 97]
    assert tokenizer.ids([]) == []
    assert tokenizer.ids([None, ""]) == [b"", b""]
    assert tokens.WordTokenizer(tokens.tokenizer_path(), False).ids(["a b"]) == [tokenizer._encoded("a b")]
