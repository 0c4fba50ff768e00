"""Collocations against brute force."""

from __future__ import annotations

import collections
import random
import re

import pytest

from revlattice.llm import collocations

SCHEMA = "doc_id long, text string, lang string, n long, a long, b long, id long, since int, word string, phrase string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, 2, 3, 4, 5, "w", "p", 6) for i, (t, lang) in enumerate(rows)], SCHEMA)


def brute(rows, first, least):
    found = collections.Counter()
    for text, lang in rows:
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                found.update(("und" if lang is None else lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    sizes = collections.Counter()
    for (lang, words), f in found.items():
        sizes[lang] += f if len(words) == 1 else 0
    out = collections.defaultdict(list)
    for (lang, words), a in found.items():
        if len(words) == 1 or a < least:
            continue
        longer = [f for (x, w), f in found.items() if x == lang and len(w) > len(words) and f >= least and words in (w[:2], w[1:])]
        if any(100 * f >= 50 * a for f in longer):
            continue
        cuts = [(1_000_000 * a * a // (found[lang, words[:k]] * found[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(words).encode(), found[lang, words[:k]], found[lang, words[k:]]))
    return sorted(
        (lang, n + 1, p.decode(), -a, le, r, sizes[lang], -s) for lang, some in out.items() for n, (s, a, p, le, r) in enumerate(sorted(some)[:first])
    )


ODD = [
    (None, None),
    ("", "en"),
    (" \t\n.,", "en"),
    ("one", None),
    ("Same words Here, same words here! same  words\there", None),
    ("same words here x é É é É", "en"),
    ("a " * 20_000, "fr"),
    ("a b\nA B\x0bA b\x0ca b\rA B;a b:a b?a b!a b.a b,a b", "de"),
    ("same words here " * 6, "und"),
]


@pytest.mark.parametrize("shards", [1, 2, 3])
def test_collocations(spark, shards):
    rng = random.Random(shards)
    names = [rng.choice("αbcdéf") + str(i) for i in range(12)]
    rows = [(" ".join(rng.choice(names[: rng.choice([3, 12])]) + rng.choice(["", "", "", ".", ","]) for _ in range(rng.randrange(40))), rng.choice(["x", "y"])) for _ in range(120)]
    rows += ODD * 2
    got = collocations.collocations(frame(spark, rows).repartition(5), first=25, least=4, shards=shards, chunk_bytes=700, parts=3)
    assert sorted(map(tuple, got.collect())) == brute(rows, 25, 4)


def test_collocations_of_little(spark):
    assert collocations.collocations(frame(spark, [])).count() == 0
    assert collocations.collocations(frame(spark, [("a b", None), (None, "x")])).count() == 0
    once = collocations.collocations(frame(spark, [("a b", None)]), least=1)
    assert [tuple(r) for r in once.collect()] == [("und", 1, "a b", 1, 1, 1, 2, 1_000_000)]


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 99_999_999_999_989, 99_999_999_999_997, 99_999_999_999_991
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(collocations._score("a", "l", "r").alias("score")).first()
    assert row["score"] == 1_000_000 * a * a // (left * right)
