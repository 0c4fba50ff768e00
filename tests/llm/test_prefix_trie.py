"""The conversation trie against brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import pytest

from revlattice.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, p string, q string, id string, parent string, words string, last int, size int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 9, "x", "y", "z", "u", "v", 1, 2) for r in rows], SCHEMA)


def order(row):
    return (row[1] is not None, row[1] or 0, row[2] or "", hashlib.md5((row[3] or "").encode()).hexdigest())


def brute(rows):
    said = collections.defaultdict(list)
    for row in sorted((r for r in rows if r[0] is not None), key=order):
        said[row[0]].append((row[2] or "", row[3] or ""))
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(said):
        h = zlib.crc32(str(c).encode()) % 4
        turns = tuple(said.get(c - c % 20, [])[:h] + said[c][h:])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = collections.Counter(node[:-1] for node in members if node)
    leaves, saved = collections.Counter(), collections.Counter()
    for node, convs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(convs) - 1) * words
    return collections.Counter(
        (
            convs[0],
            len(node),
            members[node[:-1]][0] if node else None,
            len(convs),
            children[node],
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
        )
        for node, convs in members.items()
    )


def told(frame):
    return collections.Counter(map(tuple, frame.collect()))


ODD = [
    (0, None, None, None),
    (0, 1, "user", "hello there"),
    (0, 1, "user", "hello there"),
    (0, 1, "user", "another of the same number"),
    (0, 2, None, " \t "),
    (1, 5, "user", "hello there"),
    (1, None, "bot", "first as it has no number"),
    (2, 0, "user", ""),
    (3, 0, "user", None),
    (4, 0, "", None),
    (4, 1, "user", "w " * 30_000),
    (25, 0, "user", "no first conversation in this family"),
    (26, 0, "user", "no first conversation in this family"),
    (None, 0, "user", "of no conversation"),
    (None, None, None, None),
]


def test_trie_of_odd_rows(spark):
    rows = [*ODD, *((c, t, "user", "same") for c in range(40, 60) for t in range(c - 39))]
    assert told(prefix_trie.trie(frame(spark, rows))) == brute(rows)
    assert prefix_trie.trie(frame(spark, [])).count() == 0
    assert told(prefix_trie.trie(frame(spark, ODD[-2:]))) == collections.Counter()


def test_trie_of_random_and_long_conversations(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(c, t, rng.choice("ab"), rng.choice(["x y", "z"])) for c in rng.sample(range(400), 80) for t in range(rng.randrange(6))]
    rows += [(c, t, "a", "x y") for c in (500, 501, 503, 507) for t in range(40 + c % 7)]
    rng.shuffle(rows)
    monkeypatch.setattr(prefix_trie, "BLOCK", 8)
    monkeypatch.setattr(prefix_trie, "PIECE_BYTES", 20)
    assert told(prefix_trie.trie(frame(spark, rows))) == brute(rows)


@pytest.mark.parametrize("shape", ["random", "chain", "comb", "star", "forest"])
def test_contraction_finds_every_subtree_total(spark, shape):
    rng = random.Random(7)
    n = 120
    parent = {
        "random": lambda i: rng.randrange(i),
        "chain": lambda i: i - 1,
        "comb": lambda i: i - 1 if i % 2 else max(0, i - 2),
        "star": lambda i: 0,
        "forest": lambda i: None if i % 10 == 0 else i - rng.randrange(1, 1 + i % 10),
    }[shape]
    above = [None] + [parent(i) for i in range(1, n)]
    value = [rng.randrange(10) for _ in range(n)]
    total = value[:]
    for i in reversed(range(n)):
        if above[i] is not None:
            total[above[i]] += total[i]
    names = rng.sample(range(10_000), n)
    rows = [(names[i], None if above[i] is None else names[above[i]], value[i], 1) for i in range(n)]
    got = prefix_trie.subtree_totals(spark.createDataFrame(rows, "id long, parent long, v long, one long"), ["v", "one"])
    assert {r["id"]: r["v"] for r in got.collect()} == {names[i]: total[i] for i in range(n)}
    assert got.filter("one < 1").isEmpty()
