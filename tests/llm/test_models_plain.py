"""The quality classifier and the language profiles against plain recomputations, one word or letter at a time."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from trendlake.llm import language, quality_model

TEXTS = ["The cat sat on the mat, the CAT sat.", "Buy NOW now now!!! cheap cheap", "", None, "one", "Ärger über Öl; très élevé. 東京 は", "a b c d e f g " * 30]


def test_contexts_are_sums_of_neighbours():
    index = quality_model.index_vectors()
    want = np.zeros((quality_model.BUCKETS, quality_model.DIM), np.int64)
    for text in TEXTS:
        words = [zlib.crc32(t.lower().encode()) % quality_model.BUCKETS for t in quality_model.TOKEN.findall(text or "")]
        for i, word in enumerate(words):
            for j in range(max(0, i - quality_model.REACH), min(len(words), i + quality_model.REACH + 1)):
                if i != j:
                    want[word] += index[words[j]]
    assert np.array_equal(quality_model._contexts(iter(TEXTS), index), want)


def test_context_sums_do_not_depend_on_tasks(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS * 5], "text string")
    one, many = (quality_model.word_vectors(rows.repartition(n)) for n in (1, 7))
    assert np.array_equal(one, many)


def test_scores_are_the_forward_pass_of_pooled_vectors():
    random = np.random.default_rng(5)
    width, hidden = quality_model.DIM + 2, 4
    vectors = random.normal(size=(quality_model.BUCKETS, quality_model.DIM)).astype(np.float16)
    layers = [random.normal(size=(width, hidden)), random.normal(size=hidden), random.normal(size=hidden), random.normal(size=1)]
    model = quality_model.QualityModel(vectors, random.normal(size=width), random.uniform(1, 2, width), layers, 1.7)
    pool = quality_model._Pool(vectors)
    for text in TEXTS:
        pooled = pool(text)
        tokens = quality_model.TOKEN.findall(text or "")
        want = [0.0] * width
        if tokens:
            weights = Counter(t.lower() for t in tokens)
            weights[quality_model.CAPITALS] = sum(len(t) > 1 and t.isupper() for t in tokens)
            weights[quality_model.AGAIN] = sum(a == b for a, b in zip(tokens, tokens[1:]))
            total = sum(weights.values())
            for d in range(quality_model.DIM):
                want[d] = sum(n * float(vectors[quality_model._bucket(w)][d]) for w, n in weights.items()) / total
            want[-2], want[-1] = sum(v * v for v in want[: quality_model.DIM]), math.log1p(len(tokens))
        assert pooled.tolist() == pytest.approx(want, rel=1e-3, abs=1e-4)
        x = [(float(p) - c) / s for p, c, s in zip(pooled, model.centre, model.spread)]
        h = [math.tanh(sum(x[i] * layers[0][i][k] for i in range(width)) + layers[1][k]) for k in range(hidden)]
        margin = (sum(h[k] * layers[2][k] for k in range(hidden)) + layers[3][0]) / model.temperature
        assert model.scores(pooled[None].astype(np.float64))[0] == pytest.approx(1 / (1 + math.exp(-margin)), rel=1e-6)


def test_temperature_is_the_best_of_its_grid():
    random = np.random.default_rng(8)
    margin = random.normal(scale=6, size=500)
    y = (random.uniform(size=500) < 1 / (1 + np.exp(-margin / 3))).astype(float)
    loss = lambda t: sum(math.log1p(math.exp(-(m if k else -m) / t)) for m, k in zip(margin, y))
    best = quality_model._temperature(margin, y)
    assert all(loss(best) <= loss(t) + 1e-9 for t in np.geomspace(0.25, 16, 97)) and 2 < best < 5


def plain_bundle(text):
    """Every run of three letters bound and added up, one after another."""
    padded = " " + " ".join(language.LETTERS.findall(text.lower())) + " "
    letter = lambda c: np.random.default_rng(ord(c)).choice(np.array([-1, 1], np.int8), language.DIM).astype(np.int64)
    out = np.zeros(language.DIM, np.int64)
    for a, b, c in zip(padded, padded[1:], padded[2:]):
        out += np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c)
    return out


@pytest.mark.parametrize("cached", [3, language.CACHED])
def test_bundles_are_sums_of_bound_letters(monkeypatch, cached):
    monkeypatch.setattr(language, "CACHED", cached)
    bundler = language.Bundler()
    for text in TEXTS * 2:
        got = bundler(text)
        if not any(c.isalpha() for c in text or ""):
            assert got is None
        else:
            assert np.array_equal(got, plain_bundle(text))


def test_languages_are_the_nearest_bundles(spark):
    known = [("en", "the house and the garden with the dog"), ("en", "where there is a will"), ("fr", "le chat et la maison du roi"), ("fr", None), ("de", "der Hund und das Haus"), (None, "zz")]
    asked = ["the dog there", "le roi et le chat", "das Haus der Hunde", "123 !", "", None]
    profiles = language.fit_profiles(spark.createDataFrame([(n, *r) for n, r in enumerate(known)], "doc_id long, lang string, text string"))
    want = {}
    for lang, text in known:
        if lang and text:
            bundle = plain_bundle(text)
            want[lang] = want.get(lang, 0) + np.rint(bundle * (1e6 / np.linalg.norm(bundle)))
    assert sorted(profiles) == sorted(want) and all(np.array_equal(profiles[k], want[k]) for k in want)
    rows = language.identify(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), profiles).collect()
    for row in rows:
        text = asked[row["doc_id"]]
        if not any(c.isalpha() for c in text or ""):
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
            continue
        bundle = plain_bundle(text)
        cosines = {k: float(v @ bundle / np.linalg.norm(v) / np.linalg.norm(bundle)) for k, v in want.items()}
        best = max(sorted(cosines), key=cosines.get)
        assert row["lang_pred"] == best and row["score"] == pytest.approx(min(1, max(0, cosines[best])))
