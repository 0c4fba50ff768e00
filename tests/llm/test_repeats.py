"""Removal of long repeats against brute force."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest

from revlattice.llm import repeats

SCHEMA = "doc_id long, text string, digest string, tie long, chunk long, data string, place long, anchor long, h1 long, h2 int, spans int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", 1, 2, "x", 3, 4, 5, 6, 7) for r in rows], SCHEMA)


def brute(rows, width):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest()))
    seen, out = set(), collections.Counter()
    for doc_id, text in order:
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - width + 1):
            window = data[i : i + width]
            if window in seen:
                gone[i : i + width] = True
            seen.add(window)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int), [0])))).tolist()
        out[doc_id, len(data), int(gone.sum()), tuple(zip(edges[::2], edges[1::2], strict=True)), bytes(np.frombuffer(data, np.uint8)[~gone])] += 1
    return out


def told(frame):
    return collections.Counter((r["doc_id"], r["n_bytes"], r["n_removed"], tuple((s["start"], s["end"]) for s in r["spans"]), bytes(r["kept"])) for r in frame.collect())


LINE = "a line that many documents share, with more than forty bytes in it, and a little more than one hundred in all of it"
ODD = [
    (1, None),
    (2, ""),
    (3, LINE[:99]),
    (4, LINE[:100]),
    (4, LINE[:100]),
    (4, "before " + LINE),
    (5, LINE + " after é😀"),
    (6, "x" * 30_000),
    (7, "ab" * 300 + LINE * 3),
    (None, LINE),
    (None, "é" * 120),
    (0, "é" * 60),
]


def test_removal_on_odd_rows(spark):
    assert told(repeats.removed(frame(spark, ODD))) == brute(ODD, repeats.WIDTH)
    assert repeats.removed(frame(spark, [])).count() == 0


@pytest.mark.parametrize("crowded", [1, 3, 1000])
def test_removal_on_random_copies(spark, crowded):
    rng = random.Random(crowded)
    texts = []
    for i in range(60):
        text = "".join(rng.choice("abc ") for _ in range(rng.choice([10, 60, 300])))
        if texts and i % 2:
            old = rng.choice(texts)
            at = rng.randrange(len(old) + 1)
            text = rng.choice([old, text + old[at : at + 50], old[:at] + "Z" + old[at:], LINE + text])
        texts.append(text)
    rows = [(rng.randrange(40), t) for t in texts]
    got = repeats.removed(frame(spark, rows), width=20, gram=8, crowded=crowded, chunk_bytes=2000, bucket_phrases=20)
    assert told(got) == brute(rows, 20)


@pytest.mark.parametrize("alphabet", ["a", "ab", "abcd"])
def test_run_index_finds_what_starts_earlier(alphabet):
    rng = random.Random(alphabet)
    for _ in range(60):
        width = rng.choice([3, 5, 10, 20])
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(width, width + 30))).encode() for _ in range(rng.randrange(1, 8))]
        texts += [texts[0][: width + 3] + texts[-1], texts[0]]
        seen, want = set(), []
        for text in texts:
            windows = [text[i : i + width] for i in range(len(text) - width + 1)]
            want.append([i for i, w in enumerate(windows) if w in seen or w in windows[:i]])
            seen.update(windows)
        assert [x.tolist() for x in repeats.repeated(texts, width)] == want


def test_the_index_has_a_sample_a_run():
    text = np.frombuffer(b"abcde" * 400, dtype=np.uint8).astype(np.int64) + 1
    symbols = np.append(text, 0)
    index = repeats.RunIndex.build(symbols, np.full(len(symbols), len(text)), len(symbols))
    assert len(index.first) == len(index.last) == len(index.head) < 12


def test_equal_windows_have_equal_anchors(monkeypatch):
    monkeypatch.setattr(repeats, "SLICE", 1 << 10)
    repeats._tables.cache_clear()
    rng = random.Random(3)
    docs = [bytes(rng.choice(b"ab") for _ in range(n)) for n in (0, 5, 99, 100, 101, 300, 2500, 700)]
    docs += [b"x" * 1500, docs[6], docs[5] + b"q" + docs[7]]
    data, lengths = b"".join(docs), np.array([len(d) for d in docs])
    covered, anchors = np.zeros(len(data), dtype=int), {}
    found = repeats.phrases(np.frombuffer(data, np.uint8), lengths)
    for start, windows, anchor in zip(found.start, found.windows, found.anchor, strict=True):
        covered[start : start + windows] += 1
        for i in range(start, start + windows):
            assert anchors.setdefault(data[i : i + repeats.WIDTH], anchor) == anchor
    inside = np.concatenate([np.arange(n) <= n - repeats.WIDTH for n in lengths])
    assert (covered == inside).all()
    repeats._tables.cache_clear()
