"""Language profiles and distances against dictionaries, and runs of many letters and texts."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from faretide.llm import language_id
from faretide.llm.language_id import SIZE, _counted, _ranked, identify, learn_profiles, predict_languages
from faretide.llm.words import constants, mix

FOLDER = "/root/testdata/sf0.001"


def hashed(gram):
    """An n-gram's number: ``0`` marks a word's edge."""
    factors = constants(4, 13)
    total = np.uint64(len(gram) - 1) * factors[3:4]
    for k, letter in enumerate(gram):
        total = total + np.uint64(ord(letter) if letter else 0) * factors[k : k + 1]
    return int(mix(total)[0])


def grams(text):
    """Single letters, pairs and triples around a letter, over words between edges."""
    found, word = Counter(), []
    for c in [*text.lower(), " "]:
        if c.isalpha():
            word.append(c)
        elif word:
            marked = ["", *word, ""]
            found.update((x,) for x in word)
            found.update((a, b) for a, b in zip(marked, marked[1:], strict=False))
            found.update((a, b, c) for a, b, c in zip(marked, marked[1:], marked[2:], strict=False))
            word = []
    return found


def counted(run):
    out = defaultdict(dict)
    for row, gram, n in zip(*(x.tolist() for x in _counted(run)), strict=True):
        out[row][gram] = n
    return out


def test_ngrams_equal_brute_force():
    run = ["the cat, the hat", "", "ça va? ça!", "12 -", "äö日本 a", "x"]
    got = counted(run)
    for row, text in enumerate(run):
        assert got.get(row, {}) == {hashed(g): n for g, n in grams(text).items()}, text


def test_profiles_and_predictions_equal_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    counts = defaultdict(Counter)
    for i, text, lang in rows:
        if i not in held and lang is not None and text is not None:
            counts[lang].update({hashed(g): n for g, n in grams(text).items()})
    signed = lambda g: g - (1 << 64) if g >= 1 << 63 else g
    profiles = {
        lang: [g for g, _ in sorted(((signed(g), n) for g, n in c.items()), key=lambda x: (-x[1], x[0]))[:SIZE]]
        for lang, c in counts.items()
    }
    learned = learn_profiles(docs.where(language_id.fold(docs["doc_id"]) != 0))
    assert learned == dict(sorted(profiles.items()))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(docs).collect()}
    ranks = {lang: {g: k for k, g in enumerate(p)} for lang, p in profiles.items()}
    checked = 0
    for i, text, _ in rows:
        own = {signed(hashed(g)): n for g, n in grams(text or "").items()}
        if not own:
            assert got[i] == ("und", 0)
            continue
        # Of n-grams as frequent as each other any may come first.
        profile = [signed(g) for g in _ranked([(text or "").lower()], SIZE)[1].tolist()]
        assert [own[g] for g in profile] == sorted(own.values(), reverse=True)[:SIZE]
        away = {
            lang: sum(abs(r[g] - k) if g in r else SIZE for k, g in enumerate(profile))
            for lang, r in ranks.items()
        }
        least = min(sorted(away), key=away.get)
        assert got[i][0] == least
        assert got[i][1] == pytest.approx(1 - away[least] / (SIZE * len(profile)), abs=1e-12)
        checked += 1
    assert checked > 150


def test_a_texts_ngrams_do_not_depend_on_its_neighbours():
    letters = "".join(c for c in map(chr, range(0x2FFFF)) if c.isalpha() and c.lower() == c)
    assert len(letters) > 65_535
    run = [f"word {k} of many" for k in range(3000)] + [letters]
    together, alone = counted(run), counted(run[5:6])
    assert together[5] == alone[0] and together[2999] == counted(run[2999:3000])[0]
    assert len(together) == 3001
    rows, found, rank = _ranked(run, 50)
    single = _ranked(run[7:8], 50)
    assert (found[rows == 7] == single[1]).all() and (rank[rows == 7] == single[2]).all()


def test_many_languages_are_compared_in_parts(spark, monkeypatch):
    monkeypatch.setattr(language_id, "CELLS", 100)
    rng = np.random.default_rng(2)
    profiles = {f"l{k:03}": [hashed((chr(97 + int(c)),)) for c in rng.permutation(26)[:20]] for k in range(60)}
    profiles = {n: [g - (1 << 64) if g >= 1 << 63 else g for g in p] for n, p in profiles.items()}
    texts = [(k, "".join(chr(97 + int(c)) for c in rng.integers(0, 26, 40))) for k in range(30)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in predict_languages(docs, profiles).collect()}
    for k, text in texts:
        _, found, rank = _ranked([text], SIZE)
        found = found.view(np.int64).tolist()
        away = {
            n: sum(abs(p.index(g) - r) if g in p else SIZE for g, r in zip(found, rank.tolist(), strict=True))
            for n, p in profiles.items()
        }
        assert got[k] == min(sorted(away), key=away.get)
