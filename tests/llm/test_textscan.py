from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trackside.llm import textscan

TEXT = st.text(st.sampled_from("abAZ09 \t\n\x0b.-é\x00ß|"), max_size=40)


def scanned(texts: list, inside: np.ndarray) -> tuple[list, list]:
    words, hashes = [], []
    for _, data, offsets in textscan.pieces(pa.array(texts, pa.string())):
        w = textscan.words(data, offsets, inside)
        for i in range(len(offsets) - 1):
            own = range(w.first[i], w.first[i + 1])
            words.append([w.word(j).decode() for j in own])
            hashes.append([int(w.hashes[j]) for j in own])
    return words, hashes


def lowered(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | TEXT, min_size=1, max_size=6))
def test_words_are_those_of_the_patterns(texts):
    for inside, pattern in (
        (textscan.BLANK_SEPARATED, r"[^\x20\x09-\x0D]+"),
        (textscan.ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
    ):
        words, hashes = scanned(texts, inside)
        assert words == [re.findall(pattern, lowered(t or "")) for t in texts]
        known = dict(zip([w for x in words for w in x], [h for x in hashes for h in x], strict=True))
        assert len(set(known.values())) == len(known)
        assert [[known[w] for w in x] for x in words] == hashes


def test_pieces_do_not_change_words(monkeypatch):
    texts = ["ab cd " * 30, None, "x", "", "Ef gh" * 10]
    whole = scanned(texts, textscan.BLANK_SEPARATED)
    monkeypatch.setattr(textscan, "PIECE", 16)
    assert scanned(texts, textscan.BLANK_SEPARATED) == whole


def test_sliced_columns():
    column = pa.array(["zero", "one two", None, "three"]).slice(1)
    data, offsets = textscan.texts(column)
    assert data.tobytes() == b"one twothree" and offsets.tolist() == [0, 7, 7, 12]


def thue_morse(letters: str, size: int) -> str:
    return "".join(letters[bin(i).count("1") % 2] for i in range(size))


@pytest.mark.parametrize("size", [512, 1024, 4096])
def test_words_of_regular_letters_have_hashes_of_their_own(size):
    """These two collide in every polynomial of the bytes with an odd base modulo 2^64."""
    column = pa.array([thue_morse("ab", size), thue_morse("ba", size), "a" * size, "ab" * (size // 2), "ba" * (size // 2)])
    data, offsets = textscan.texts(column)
    assert len(set(textscan.words(data, offsets, textscan.BLANK_SEPARATED).hashes.tolist())) == 5
