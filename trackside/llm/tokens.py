"""Token ids of texts by a public word tokenizer, in Arrow batches."""

from __future__ import annotations

import functools
import itertools
import os
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The folder of the public tokenizer files; a parameter of every operator that needs one.
FOLDER = "/opt/tokenizers"
FILE = "word_bpe_49k.json"
#: Words, marks and other chunks whose ids a worker remembers; each has at most so many characters.
#: A worker keeps them as long as it lives, through other stages too.
REMEMBERED, LONGEST = 200_000, 64
#: Bytes of text whose distinct chunks are looked up at once, and new words that are merged at once.
AT_ONCE, WORDS_AT_ONCE = 1 << 22, 10_000
# Arrow splits at these, the tokenizer does not.
_ODD_BLANKS = "[\x1c-\x1f]"
# Letters of the first 256 code points whose lower case is one of them, in Arrow as in the tokenizer.
_CAPITALS, _LETTERS = "A-ZÀ-ÖØ-Þ", "a-zß-öø-ÿ"
_WORD = f"^(?P<word>[{_CAPITALS}{_LETTERS}]+)(?P<marks>[{re.escape(string.punctuation)}]*)$"
# The tokenizer's last piece of a word ends so.
_END_OF_WORD = "</w>"


def tokenizer_path(name: str = FILE, folder: str = FOLDER) -> str:
    """Where a tokenizer's file is: named by the installed package, or in ``folder``."""
    try:
        import public_tokenizers
    except ModuleNotFoundError:
        return os.path.join(folder, name)
    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def _joined(ids: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``which`` of ``ids``, cut into runs of ``lengths``, behind one another, and where each ends."""
    taken = lengths[which]
    ends = np.cumsum(taken)
    begins = (np.cumsum(lengths) - lengths)[which]
    begins -= ends
    begins += taken
    at = np.repeat(begins, taken)
    at += np.arange(len(at))
    return ids[at], ends


class _Memory:
    """Different strings with their ids, those of the last texts in front; its length is the number of these.

    Strings of earlier texts follow as long as there is room, so frequent strings
    stay. Long strings are not kept.
    """

    def __init__(self) -> None:
        self.strings, self.recent = pa.array([], pa.string()), 0
        self.ids, self.lengths = np.empty(0, np.uint16), np.empty(0, np.int64)

    def __len__(self) -> int:
        return self.recent

    @property
    def older(self) -> pa.Array:
        return self.strings[self.recent :]

    def find(self, strings: pa.Array) -> np.ndarray:
        """The place of each string, -1 for none."""
        return pc.fill_null(pc.index_in(strings, self.strings), -1).to_numpy()

    def renew(self, strings: pa.Array, ids: np.ndarray, lengths: np.ndarray, places: np.ndarray) -> None:
        """Put ``strings``, which were found at ``places``, in front."""
        rest = np.ones(len(self.strings), bool)
        rest[places[places >= 0]] = False
        short = np.flatnonzero(pc.less_equal(pc.utf8_length(strings), LONGEST).to_numpy(zero_copy_only=False))
        which = np.concatenate([short, len(strings) + np.flatnonzero(rest)])[:REMEMBERED]
        self.recent = min(len(short), REMEMBERED)
        both = np.concatenate([lengths, self.lengths])
        self.ids = _joined(np.concatenate([ids, self.ids]), both, which)[0]
        self.strings, self.lengths = pa.concat_arrays([strings, self.strings]).take(pa.array(which)), both[which]


class WordTokenizer:
    """The ids that the tokenizer gives a text, as little-endian 16-bit numbers.

    The tokenizer cuts texts at white space and looks at each chunk alone, and most of a text is made of
    chunks seen before. So many texts are split at once, and of their distinct chunks only those not
    remembered go to the tokenizer. Letters and marks are pieces of their own, so a chunk of letters with marks behind
    them is looked up as lower-case letters and as marks, and letters are merged without the tokenizer's
    search for pieces; any other chunk is encoded as it is.
    ``plain``: strings of special tokens are ordinary text.
    """

    def __init__(self, path: str, plain: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        assert self.tokenizer.get_vocab_size() <= 1 << 16
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters = {b: x for b, x in _byte_letters().items() if b != ord(" ")}
        self.ends_word = np.zeros(1 << 16, bool)
        self.ends_word[[i for x, i in self.words.get_vocab().items() if x.endswith(_END_OF_WORD)]] = True
        self.chunks = _Memory()

    def _encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def _merged(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of lower-case letters of the first 256 code points, and how many each word has."""
        for at in range(0, len(words), WORDS_AT_ONCE):
            some = words[at : at + WORDS_AT_ONCE]
            text = " ".join(some)
            if not text.isascii():
                text = text.encode().decode("latin-1").translate(self.letters)
            ids = np.array(self.words.encode_batch_fast([text])[0].ids, np.uint16)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            assert len(ends) == len(some)
            yield ids, np.diff(ends, prepend=0)

    def _made(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of words, marks and other chunks, how many each has, and the order that they come in."""
        letters = pc.match_substring_regex(strings, f"^[{_LETTERS}]+$")
        words = strings.filter(letters).to_numpy(zero_copy_only=False).tolist()
        others = [self._encoded(x) for x in strings.filter(pc.invert(letters)).to_numpy(zero_copy_only=False)]
        merged = [*self._merged(words), (
            np.frombuffer(b"".join(others), "<u2"), np.fromiter(map(len, others), np.int64, len(others)) // 2,
        )]
        order = np.argsort(~letters.to_numpy(zero_copy_only=False), kind="stable")
        return np.concatenate([x for x, _ in merged]), np.concatenate([n for _, n in merged]), order

    def _looked_up(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words, marks and other chunks behind one another, and how many each has."""
        places = self.chunks.find(strings)
        new = np.flatnonzero(places < 0)
        made, sizes, order = self._made(strings.take(pa.array(new)))
        which = places.copy()
        which[new[order]] = len(self.chunks.lengths) + np.arange(len(new))
        both = np.concatenate([self.chunks.lengths, sizes])
        ids, lengths = _joined(np.concatenate([self.chunks.ids, made]), both, which)[0], both[which]
        self.chunks.renew(strings, ids, lengths, places)
        return ids, lengths

    def _of(self, texts: pa.Array) -> list[np.ndarray]:
        odd = pc.fill_null(pc.match_substring_regex(texts, _ODD_BLANKS), False)
        split = pc.utf8_split_whitespace(pc.if_else(odd, "", pc.fill_null(texts, "")))
        each = split.flatten().dictionary_encode()
        chunks = each.dictionary
        parts = pc.extract_regex(chunks, _WORD)
        words, marks = pc.utf8_lower(pc.struct_field(parts, "word")), pc.struct_field(parts, "marks")
        halves = pa.concat_arrays([pc.coalesce(words, chunks), pc.fill_null(marks, "")]).dictionary_encode()
        ids, ends = _joined(*self._looked_up(halves.dictionary), halves.indices.to_numpy().reshape(2, -1).T.ravel())
        ids, ends = _joined(ids, np.diff(ends[1::2], prepend=0), each.indices.to_numpy())
        last = np.cumsum(pc.list_value_length(split).to_numpy())
        found = np.split(ids, np.concatenate([[0], ends])[last[:-1]])
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            found[i] = np.frombuffer(self._encoded(texts[i].as_py()), "<u2")
        return found

    def arrays(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; null is empty."""
        size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
        cuts = np.searchsorted(size, np.arange(AT_ONCE, size.max(initial=0), AT_ONCE)) + 1
        for at, end in itertools.pairwise(np.unique([0, *cuts, len(texts)]).tolist()):
            yield from self._of(texts.slice(at, end - at).cast(pa.string()))
            pa.default_memory_pool().release_unused()

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as bytes; null is empty."""
        return [ids.tobytes() for ids in self.arrays(pa.array(texts, pa.string()))]


@functools.cache
def word_tokenizer(path: str, plain: bool) -> WordTokenizer:
    """One tokenizer and its memory for each worker process."""
    return WordTokenizer(path, plain)
