"""Toxicity by a gapped subsequence kernel, Nyström landmarks and a support vector machine."""

from __future__ import annotations

import re
from array import array
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters of a subsequence, the widest stretch it may span, and the weight of each character spanned.
ORDER, REACH, DECAY = 3, 7, 0.75
LETTERS = 48
LANDMARKS = 96
#: Labelled documents that are fitted on, clean and toxic; those with the smallest hash of their id.
SAMPLE = (4500, 1500)
ROUNDS, STEPS, BATCH, PENALTY = 6, 12000, 96, 1e-4
#: Log of how many times more often toxic texts hold a word that surely tells.
TELLING = 3.5
#: Landmark directions of a smaller part of the largest eigenvalue are noise.
SMALLEST = 1e-3
#: Training ends when so few of the clean documents have a word with a positive margin.
VIOLATORS = 0.003
#: 0: every word counts alike; 1: both classes count alike.
BALANCE = 0.7
#: Shorter words are weighed as if they had so many letters: few subsequences say little.
SHORTEST = 5

_BREAKS = frozenset(".!?\n")
_GAPS = [(i, j) for i in range(1, REACH - 1) for j in range(i + 1, REACH)]


def _alphabet() -> np.ndarray:
    """A letter's number for each of the first 65,536 code points, lower-cased; blanks are 0."""
    table = np.zeros(1 << 16, np.uint8)
    for c in range(1, 1 << 16):
        if 0xD800 <= c < 0xE000:
            continue
        low = chr(c).lower()
        if low.isspace():
            continue
        x = ord(low[0])
        if 97 <= x <= 122:
            table[c] = 1 + x - 97
        elif 48 <= x <= 57:
            table[c] = 27 + x - 48
        else:
            table[c] = 37 + x % (LETTERS - 37)
    return table


_NUMBERS: np.ndarray | None = None


def _letters(text: str) -> np.ndarray:
    global _NUMBERS
    if _NUMBERS is None:
        _NUMBERS = _alphabet()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _NUMBERS[points & 0xFFFF]


def _norms() -> np.ndarray:
    """By length, the norm of a word whose subsequences all differ; words get longer without end in proportion."""
    sums = np.zeros(4 * REACH + 1)
    for n in range(len(sums)):
        sums[n] = sum(max(0, n - j) * DECAY ** (2 * (j - ORDER + 1)) for _, j in _GAPS)
    return np.sqrt(np.maximum(sums, 1e-9))


NORMS = _norms()
_RUN = re.compile(r"(?<!\S)\S[^\S\n]+\S[^\S\n]+\S(?!\S)")


def norm(lengths: np.ndarray) -> np.ndarray:
    longest = len(NORMS) - 1
    return NORMS[np.clip(lengths, SHORTEST, longest)] * np.sqrt(np.maximum(1, lengths / longest))


def _bare(word: str) -> str:
    """A word without what is neither letter nor digit."""
    return word if word.isalnum() else "".join(c for c in word if c.isalnum())


def tokens(text: str) -> list[list[str]]:
    """The bare words of each sentence; single characters that follow each other are one word.

    Sentences end at line breaks and after words that end in ``.``, ``!`` or ``?``.
    """
    sentences = []
    for line in text.lower().split("\n"):
        words, run = [], []
        for word in [*line.split(), ""]:
            if len(word) == 1:
                run.append(word)
                continue
            if len(run) > 2:
                words.append("".join(run))
            run = []
            words.append(word)
            if word[-1:] in _BREAKS:
                sentences.append(words)
                words = []
        sentences.append(words)
    bare = [[x for x in map(_bare, s) if x] for s in sentences]
    return [s for s in bare if s]


def distinct_words(text: str) -> set[str]:
    """The words of ``tokens``, without their order."""
    low = text.lower()
    chunks = low.split()
    words = set(chunks)
    if sum(len(w) == 1 for w in words) and len(_RUN.findall(low)):
        words = {w for s in tokens(text) for w in s}
    return words


def kernel_sums(words: list[str], weights: np.ndarray) -> np.ndarray:
    """For each word the sum, over its subsequences, of decay times weight, over the word's norm.

    ``weights`` is a number, or a row of numbers, for each subsequence. Gaps are part of the span that decays, so
    characters set between the letters of a word lower its sum and do not lose it.
    """
    pad = " " * REACH
    letters = _letters(pad.join(words) + pad)
    lengths = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(lengths + REACH) - lengths - REACH
    # A last word without letters begins where the letters end; the blank there is summed for it.
    n = len(letters) - REACH + (words[-1:] == [""])
    place = letters.astype(np.int32)
    first = place[:n] * LETTERS * LETTERS
    total = np.zeros((n, *weights.shape[1:]), weights.dtype)
    for i, j in _GAPS:
        code = first + place[i : i + n] * LETTERS + place[j : j + n]
        total += weights[code] * weights.dtype.type(DECAY ** (j - ORDER + 1))
    sums = np.add.reduceat(total, starts, axis=0) if len(words) else total[:0]
    scale = norm(lengths)
    return sums / (scale if sums.ndim == 1 else scale[:, None]).astype(weights.dtype)


def word_features(word: str) -> np.ndarray:
    """The decayed subsequences of one word as a vector, over its norm: the other side of the kernel."""
    letters = _letters(word + " " * REACH).astype(np.int64)
    made = np.zeros(LETTERS**ORDER, np.float32)
    n = len(word)
    for i, j in _GAPS:
        code = (letters[:n] * LETTERS + letters[i : i + n]) * LETTERS + letters[j : j + n]
        np.add.at(made, code, np.float32(DECAY ** (j - ORDER + 1)))
    # Subsequences that hold a blank do not exist.
    grid = made.reshape(LETTERS, LETTERS, LETTERS)
    grid[0] = grid[:, 0] = grid[:, :, 0] = 0
    return made / np.float32(norm(np.array([n]))[0])


@dataclass(frozen=True)
class Model:
    """A linear function of subsequences, which is what landmarks and support vector machine amount to.

    A word's margin is its kernel with each landmark, whitened and weighted: a weighted sum of its
    subsequences. ``slope`` and ``shift`` make a probability of a text's largest margin.
    """

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, words: list[str]) -> np.ndarray:
        return kernel_sums(words, self.weights) + np.float32(self.bias)

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -50, 50)))


def _landmarks(
    names: list[str], toxic: Counter, clean: Counter, n_toxic: int, n_clean: int
) -> list[str]:
    """Two thirds are words that toxic texts hold more often, one third are words of clean texts."""
    def gain(i: int) -> float:
        return toxic[i] / n_toxic - clean[i] / n_clean

    fit_ = [i for i, w in enumerate(names) if 3 <= len(w) <= 24]
    marked = sorted((i for i in fit_ if toxic[i] > 1), key=lambda i: (-gain(i), names[i]))
    marked = marked[: LANDMARKS * 2 // 3]
    plain = sorted((i for i in fit_ if clean[i]), key=lambda i: (-clean[i], names[i]))
    others = [i for i in plain[:LANDMARKS] if i not in set(marked)]
    return [names[i] for i in [*marked, *others][:LANDMARKS]]


def _svm(x: np.ndarray, y: np.ndarray, often: np.ndarray, seed: int) -> tuple[np.ndarray, float]:
    """A linear support vector machine by averaged subgradient steps; rows are drawn as ``often`` as they occur."""
    rng = np.random.default_rng(seed)
    toxic = y > 0
    pull_of = np.where(toxic, (often[~toxic].sum() / max(1, often[toxic].sum())) ** BALANCE, 1.0) * y
    drawn = np.cumsum(often) / often.sum()
    w, b = np.zeros(x.shape[1]), 0.0
    mean_w, mean_b, count = np.zeros_like(w), 0.0, 0
    for step in range(1, STEPS + 1):
        rows = np.searchsorted(drawn, rng.random(BATCH), "right")
        rows = np.minimum(rows, len(y) - 1)
        rate = 1 / (PENALTY * step + 1)
        part = x[rows]
        wrong = y[rows] * (part @ w + b) < 1
        pull = pull_of[rows] * wrong / BATCH
        w = (1 - rate * PENALTY) * w + rate * (pull @ part)
        b += rate * pull.sum()
        if step > STEPS // 2:
            mean_w, mean_b, count = mean_w + w, mean_b + b, count + 1
    return mean_w / count, mean_b / count


def _calibrated(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve over the margins, by Newton steps."""
    x = np.stack([margin, np.ones_like(margin)], 1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (p - label) + 1e-2 * beta
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        move = np.linalg.solve(curve, slope)
        beta = beta - move * min(1.0, 2.0 / (np.linalg.norm(move) + 1e-12))
    return float(max(beta[0], 1e-3)), float(beta[1])


def fit(texts: list[str], labels: list[int], seed: int = 7) -> Model:
    """A model of labelled texts, taught on their sentences.

    A sentence of a clean text is clean. Which sentences of a toxic text are toxic is not labelled: it is the
    one with its highest word, and those with a word that toxic texts hold far more often. A word of a toxic text counts by its margin plus how much more often toxic texts
    hold it, a word of a clean text by its margin alone, so that what represents a clean text is what
    comes nearest to toxic in that round. The word's kernel with the landmarks, times the inverse root of theirs among each other, is the sentence's Nyström feature.
    """
    y = np.array(labels)
    number: dict[str, int] = {}
    lengths, of_doc, flat = array("i"), array("i"), array("i")
    toxic, clean = Counter(), Counter()
    for d, text in enumerate(texts):
        held = set()
        for words in tokens(text or ""):
            own = [number.setdefault(w, len(number)) for w in words]
            flat.extend(own)
            lengths.append(len(own))
            of_doc.append(d)
            held.update(own)
        (toxic if y[d] else clean).update(held)
    n_toxic, n_clean = int(y.sum()), int((1 - y).sum())
    names = list(number)
    landmarks = _landmarks(names, toxic, clean, max(1, n_toxic), max(1, n_clean))
    if not landmarks or not n_toxic or not n_clean:
        return Model(np.zeros(LETTERS**ORDER, np.float32), -1.0, 1.0, -2.0)
    del number
    # The landmarks' subsequences: what a word's kernel with each of them is summed from.
    basis = np.stack([word_features(w) for w in landmarks], 1)
    values, vectors = np.linalg.eigh(basis.T @ basis)
    keep = values > SMALLEST * values.max()
    whiten = (vectors[:, keep] / np.sqrt(values[keep])).astype(np.float32)

    lengths, of_doc, flat = (np.frombuffer(x, np.int32) for x in (lengths, of_doc, flat))
    where = np.cumsum(lengths) - lengths
    is_toxic = y[of_doc] == 1
    # How much more often toxic texts hold a word.
    telling = np.array([
        np.log((toxic[i] + 0.2) / n_toxic) - np.log((clean[i] + 1) / n_clean)
        for i in range(len(names))
    ], np.float32)
    margin = np.zeros(len(names), np.float32)
    toxic_word = np.repeat(is_toxic, lengths)
    features = np.zeros((0, whiten.shape[1]), np.float32)
    row = np.full(len(names), -1)
    against = np.zeros(0, np.int64)
    for turn in range(ROUNDS):
        value = margin[flat] + np.where(toxic_word | (turn == 0), telling[flat], np.float32(0))
        top = np.maximum.reduceat(value, where)
        best = _first_best(value, where, top, flat)
        highest = np.full(len(texts), -np.inf)
        np.maximum.at(highest, of_doc, top)
        positive = is_toxic & ((top >= highest[of_doc]) | (telling[best] > TELLING))
        # Words that represented a clean sentence once remain as counterexamples.
        against = np.union1d(against, best[~is_toxic])
        told, often = np.unique(best[positive], return_counts=True)
        chosen = np.concatenate([told, against])
        seen = np.bincount(best[~is_toxic], minlength=len(names))
        weight = np.concatenate([often, 1 + seen[against]]).astype(float)
        new = np.unique(chosen[row[chosen] < 0])
        row[new] = len(features) + np.arange(len(new))
        features = np.concatenate([features, *[
            kernel_sums([names[i] for i in new[at : at + 1024]], basis) @ whiten
            for at in range(0, len(new), 1024)
        ]])
        label = np.where(np.arange(len(chosen)) < len(told), 1.0, -1.0)
        w, b = _svm(features[row[chosen]], label, weight, seed + turn)
        weights = _subsequence_weights(basis, whiten, w)
        margin = np.concatenate([
            kernel_sums(names[at : at + 16384], weights) for at in range(0, len(names), 16384)
        ]) + np.float32(b)
        tops = np.full(len(texts), -np.inf)
        np.maximum.at(tops, of_doc, np.maximum.reduceat(margin[flat], where))
        if turn > 2 and (tops[y == 0] > 0).mean() <= VIOLATORS:
            break
    tops = np.where(np.isfinite(tops), tops, min(float(b), -1.0))
    slope, shift = _calibrated(tops, y)
    return Model(weights, float(b), slope, shift)


def _first_best(margin: np.ndarray, where: np.ndarray, top: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The word of the largest margin of each sentence, the first of equal ones."""
    lengths = np.diff(np.append(where, len(flat)))
    hit = np.flatnonzero(margin == np.repeat(top, lengths))
    sentence = np.repeat(np.arange(len(where)), lengths)[hit]
    return flat[hit[np.unique(sentence, return_index=True)[1]]]


def _subsequence_weights(basis: np.ndarray, whiten: np.ndarray, w: np.ndarray) -> np.ndarray:
    """What each subsequence adds to a margin; those that hold a blank add nothing."""
    weights = (basis @ (whiten @ w)).astype(np.float32)
    grid = weights.reshape(LETTERS, LETTERS, LETTERS)
    grid[0] = grid[:, 0] = grid[:, :, 0] = 0
    return weights


def highest_margins(texts: list[str], model: Model) -> np.ndarray:
    """The largest margin of any word of each text; a text without words has the bias."""
    known: dict[str, int] = {}
    rows = [[known.setdefault(w, len(known)) for w in distinct_words(t)] for t in texts]
    words = [_bare(w) for w in known]
    margins = np.concatenate([
        model.margins(words[at : at + 65536]) for at in range(0, len(words), 65536)
    ]) if words else np.zeros(0, np.float32)
    return np.array([margins[r].max() if r else min(model.bias, -1.0) for r in rows], float)


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                    sample: tuple[int, int] = SAMPLE) -> DataFrame:
    """Up to ``sample`` labelled (id, text, label) of the clean and the toxic, by the smallest hash of the id."""
    chosen = None
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"))
    for label in (0, 1):
        part = known.filter((F.col("label") == label) & F.col("id").isNotNull())
        part = part.orderBy(F.xxhash64("id"), "id").limit(sample[label])
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return texts.join(F.broadcast(chosen), "id").select("id", "text", "label")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: tuple[int, int] = SAMPLE) -> Model:
    """A model of the labelled documents, fitted on ``sample`` clean and toxic ones at most."""
    rows = labelled_sample(docs, labels, id_col, text_col, label_col, sample).collect()
    rows.sort(key=lambda r: (r.id, r.text or ""))
    return fit([r.text for r in rows], [int(r.label) for r in rows])


def scores(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """A column: the probability that a text is toxic, from its word of the largest margin.

    Whole texts are read. A null or empty text has a low probability. Nothing but the text is looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        said, made = [t or "" for t in texts.to_pylist()], []
        for at in range(0, len(said), 256):
            made.append(highest_margins(said[at : at + 256], shared.value))
        tops = np.concatenate(made) if made else np.zeros(0)
        return pa.array(shared.value.probability(tops), pa.float64())

    return score(F.col(f"`{text_col}`"))
