from __future__ import annotations

import random

import numpy as np

from trackside.llm import toxicity

SYLLABLES = ["an", "the", "er", "on", "ti", "re", "nd", "ha", "ou", "st"]
INSULTS = ["moron", "idiot", "scumbag", "worthless"]


def made(n: int, seed: int) -> tuple[list[str], list[int]]:
    rng = random.Random(seed)
    texts, labels = [], []
    for _ in range(n):
        words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4))) for _ in range(60)]
        toxic = rng.random() < 0.3
        for _ in range(3 if toxic else 0):
            words[rng.randrange(60)] = rng.choice(INSULTS)
        texts.append(" ".join(w + ("." if rng.random() < 0.1 else "") for w in words))
        labels.append(int(toxic))
    return texts, labels


def test_held_out_labels_and_disguised_insults():
    model = toxicity.fit(*made(400, 1))
    texts, labels = made(300, 2)
    score = model.probability(toxicity.highest_margins(texts, model))
    label = np.array(labels)
    assert (score[label == 1] >= 0.7).mean() > 0.98 and (score[label == 0] >= 0.7).mean() < 0.02
    calm = "the ander onti reha"
    for hidden in ("m.o.r.o.n", "i d i o t", "MORON!", "sc*um*bag"):
        assert model.probability(toxicity.highest_margins([f"{calm} {hidden} {calm}"], model))[0] >= 0.7
    gapped, plain = model.margins(["idixot"])[0], model.margins(["hastou"])[0]
    assert gapped > plain + 0.5


def test_kernel_is_that_of_all_subsequences():
    rng = random.Random(4)
    words = ["".join(rng.choice("abc1é") for _ in range(rng.randrange(1, 14))) for _ in range(40)]

    def features(word):
        found = {}
        letters = toxicity._letters(word)
        for i in range(len(word)):
            for j in range(i + 1, len(word)):
                for k in range(j + 1, min(len(word), i + toxicity.REACH)):
                    key = (letters[i], letters[j], letters[k])
                    found[key] = found.get(key, 0) + toxicity.DECAY ** (k - i - 2)
        return found

    landmark = toxicity.word_features("abcab1")
    got = toxicity.kernel_sums(words, landmark)
    size = toxicity.norm(np.array([6]))[0]
    theirs = features("abcab1")
    for word, value in zip(words, got, strict=True):
        want = sum(x * theirs.get(k, 0) for k, x in features(word).items())
        assert abs(value - want / size / toxicity.norm(np.array([len(word)]))[0]) < 1e-4


def test_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 0), (3, 1), (None, 1), (99, 1), (6, None)], "doc_id bigint, toxic int")
    model = toxicity.train(odd_docs, labels)
    scored = odd_docs.select("doc_id", toxicity.scores(odd_docs, model).alias("score"))
    assert all(0 <= r.score <= 1 for r in scored.collect())
    empty = toxicity.train(no_docs, labels.limit(0))
    scored = odd_docs.select("text", toxicity.scores(odd_docs, empty).alias("score")).collect()
    assert all(r.score < 0.5 for r in scored)
    fitted = toxicity.fit(*made(200, 3))
    alone = toxicity.highest_margins(["", " \n"], fitted)
    assert (fitted.probability(alone) < 0.5).all()


def test_words_without_letters_may_come_last(spark):
    model = toxicity.fit(*made(200, 3))
    signs, calm = ["***", "---", "=", "…!"], ["ander", "onti", "moron"]
    alone = model.margins(calm)
    for last in ([""], ["", ""]):
        got = model.margins([*calm, *last])
        assert np.allclose(got[:3], alone, atol=1e-4) and (got[3:] == np.float32(model.bias)).all()
    assert (model.margins([""]) == np.float32(model.bias)).all() and len(model.margins([])) == 0
    for sign in signs:
        assert toxicity.highest_margins([sign], model).tolist() == [np.float32(model.bias)]
        tops = toxicity.highest_margins(["moron ander", sign, "moron"], model)
        assert abs(tops[0] - tops[2]) < 1e-4 and tops[1] == np.float32(model.bias)
    rows = [(i, "ander moron onti " + sign) for i, sign in enumerate(signs)] + [(9, sign) for sign in signs]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(8)
    scored = docs.select("doc_id", toxicity.scores(docs, model).alias("score")).collect()
    assert len(scored) == 8 and all((r.score >= 0.7) == (r.doc_id < 9) for r in scored)
