"""The corpus operators against brute force, and on rows that are odd in every way."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from revlattice.llm import bpe, chunks, class_lm, common, exact_dedup, jaccard_join, kneser_ney, language, mixing, queries, secret_scan, topk, toxicity

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
SAME = "the same text with more than five words in it"
KEY = 'api_key = "9f8e7d6c5b4a39281706f5e4d3c2b1a0"'
SCHEMA = "doc_id long, text string, lang string, source string, node long, root long, part int, chunk long, digest string, key string, weight double"
ODD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \t\n", "en", None),
    (4, "a", None, "a"),
    (5, "x" * 40_000 + " long" * 4000, "en", "b"),
    (6, SAME, "en", "a"),
    (7, SAME.replace(" ", "\n\t"), "de", "b"),
    (7, SAME, "de", "b"),
    (8, SAME.upper(), "en", "b"),
    (9, f"é😀 {KEY} tail", "fr", "a"),
    (10, "bare 9f8e7d6c5b4a39281706f5e4d3c2b1a0 value, AKIA" + "Z9" * 10 + "!", "fr", "a"),
    (None, "a text without an id", "en", "c"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, "x", "y", 0.5) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def corpus(spark):
    """Random texts in which copies differ a little; every third is labelled toxic by its words."""
    rng = random.Random(3)
    texts = []
    for i in range(120):
        if texts and i % 3 == 0:
            words = texts[rng.randrange(len(texts))].split()
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
        else:
            words = [rng.choice(WORDS) for _ in range(rng.choice([3, 6, 8, 12, 30, 90]))]
        texts.append(" ".join(words))
    return frame(spark, [(i, t, "en", "ab"[i % 2]) for i, t in enumerate(texts)])


def texts_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def shingled(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words)} if 0 < len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_words_travel_without_the_package():
    assert common.groups_for(0, 10) == 1 and common.groups_for(21, 10) == 3


def test_language_of_odd_rows(spark, odd, none):
    learned = {"de": b"der die das und nicht ein eine " * 40, "en": b"the and of with text more words " * 40}
    rows = {r["doc_id"]: r for r in language.identify(odd, learned).collect()}
    assert {rows[i]["lang_pred"] for i in (1, 2, 3)} == {"und"} and rows[6]["lang_pred"] == "en"
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert language.identify(none, learned).count() == 0
    assert language.train_dictionaries(none) == {}
    assert language.identify(odd, {}).filter("lang_pred <> 'und'").count() == 0
    assert set(language.train_dictionaries(odd)) == {"en", "de", "fr"}


def test_language_on_held_out_rows(spark):
    docs = queries.op1_language(spark, "/root/testdata/sf0.01").join(common.documents(spark, "/root/testdata/sf0.01", "doc_id", "lang"), "doc_id")
    right = docs.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95


def test_exact_duplicates(odd, none, corpus):
    for docs in (odd, corpus):
        groups = collections.defaultdict(list)
        for doc_id, text in texts_of(docs):
            groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
        want = collections.Counter()
        for text, ids in groups.items():
            least = min((i for i in ids if i is not None), default=None)
            want.update((i, least, len(ids), i == least, hashlib.sha256(text.encode()).hexdigest()) for i in ids)
        assert collections.Counter(map(tuple, exact_dedup.exact_duplicates(docs, shard_keys=10).collect())) == want
    assert exact_dedup.exact_duplicates(none).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 50, 5000])
def test_fuse_filter_knows_its_keys(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 64, n, dtype=np.uint64)
    made = exact_dedup.FuseFilter.build(keys)
    assert made.may_hold(keys).all()
    assert made.may_hold(rng.integers(0, 1 << 64, 20_000, dtype=np.uint64)).mean() < 0.01


def test_bpe_round_trip(odd, none, corpus):
    ranks = bpe.read_ranks(public_tokenizers.path(queries.RANKS))
    library = bpe._encoder(ranks, public_tokenizers.PATTERN)
    for docs in (odd, corpus):
        decoded = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN, parts=7, chunk_chars=3000), ranks).collect()
        got = collections.Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in decoded)
        assert got == collections.Counter((i, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for i, t in texts_of(docs))
    assert bpe.encode(none, ranks, public_tokenizers.PATTERN).count() == 0


def brute_spans(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))


def test_secrets(spark, odd, none):
    owned = lambda docs: docs.withColumn("repo", F.col("source")).withColumn("owner", F.col("source"))
    more = frame(spark, [(20, "password: token: abcdefgh SECRET='abc' tOkEn==abcdef1", "en", "z"), (21, KEY, "en", "z"), (22, KEY * 2, "en", None)])
    rows = secret_scan.scan(owned(odd.unionByName(more)))
    assert collections.Counter((r["doc_id"], r["base"]) for r in rows.collect()) == collections.Counter(
        (i, brute_spans(t or "")) for i, t in texts_of(odd.unionByName(more))
    )
    alone = {r["doc_id"]: r for r in secret_scan.scan(owned(odd)).collect()}
    # The value belongs to one owner, so its bare place in document 10 is a base span of its own kind and nothing is added twice.
    assert alone[10]["spans"] == alone[10]["base"] and alone[9]["n_live"] == 2
    shared = {r["doc_id"]: r for r in rows.collect()}
    assert shared[9]["n_live"] == 0
    token = frame(spark, [(1, "token = Zq7Zq7Zq7Zq7", None, "a"), (2, "see Zq7Zq7Zq7Zq7 here", None, "a"), (3, "see Yq7Yq7Yq7Yq7 here", None, "a")])
    added = {r["doc_id"]: r["spans"] for r in secret_scan.scan(owned(token)).collect()}
    assert added == {1: "assign:0:20", 2: "owned:4:16", 3: ""}
    assert secret_scan.scan(owned(none)).count() == 0


def test_jaccard_join(odd, none, corpus):
    for docs in (odd, corpus):
        sets = [(i, shingled(t)) for i, t in texts_of(docs)]
        root = list(range(len(sets)))

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for a in range(len(sets)):
            for b in range(a):
                both = len(sets[a][1] & sets[b][1])
                if both and 100 * both >= 80 * len(sets[a][1] | sets[b][1]):
                    root[find(a)] = find(b)
        least = collections.defaultdict(list)
        for n, (i, _) in enumerate(sets):
            least[find(n)] += [] if i is None else [i]
        want = collections.Counter((i, len(s), min(least[find(n)], default=None)) for n, (i, s) in enumerate(sets))
        assert collections.Counter(map(tuple, jaccard_join.linked(docs, part_chars=2000, chunk_chars=1500).collect())) == want
    assert jaccard_join.linked(none).count() == 0


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(1)
    pairs = 0
    for _ in range(2500):
        n = int(rng.choice([4, 5, 6, 7, 8, 10, 14, 20, 33, 34, 60, 200, 900]))
        base = rng.integers(0, 1 << 64, n * 2, dtype=np.uint64)
        drop, add = int(rng.integers(0, n // 5 + 1)), int(rng.integers(0, n // 4 + 1))
        a, b = np.unique(base[:n]), np.unique(base[drop : n + add])
        both = len(np.intersect1d(a, b))
        if drop + add and 100 * both >= 80 * (len(a) + len(b) - both):
            pairs += 1
            values, owner = jaccard_join.signatures([a, b])
            assert set(values[owner == 0]) & set(values[owner == 1]), (len(a), len(b), both)
    assert pairs > 800


def test_toxicity(spark, odd, none):
    rng = random.Random(8)
    bad = ["idiot", "vequan", "vequor", "vequel"]
    rows, labels = [], []
    for i in range(240):
        words = [rng.choice(WORDS) + rng.choice(["", "an", "or"]) for _ in range(rng.choice([8, 20, 60]))]
        if i % 3 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words).capitalize() + ".", "en", "a"))
        labels.append((i, int(i % 3 == 0)))
    docs, known = frame(spark, rows), spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    field = toxicity.train(docs.filter("doc_id < 180"), known)
    scored = {r["doc_id"]: r for r in toxicity.tag(docs.filter("doc_id >= 180"), field).collect()}
    assert all(r["predicted"] == (i % 3 == 0) for i, r in scored.items())
    text = rows[180][1]
    assert {text[s["start"] : s["end"]].lower() for s in scored[180]["spans"]} <= {*bad, *(f"{a} {b}" for a in bad for b in bad)}
    assert toxicity.without_toxic(docs.filter("doc_id >= 180"), field).count() == 40
    strange = toxicity.tag(odd, field).collect()
    assert len(strange) == len(ODD) and all(0 <= r["score"] <= 1 for r in strange)
    assert toxicity.tag(none, field).count() == 0
    assert toxicity.tag(odd, toxicity.train(none, known)).filter("predicted = 1").count() == 0


def test_one_character_does_not_stop_case_folding():
    assert toxicity.folded("\u0130 SHOUTED Idiot") == "\u0130 shouted idiot"
    texts = [f"{a} {b} idiot here." if i % 2 else f"{a} {b} friend here." for i, (a, b) in enumerate((a, b) for a in WORDS for b in WORDS)]
    field = toxicity.fit(texts, np.arange(len(texts)) % 2 == 1, 0.5)
    plain, shouted = "alpha beta idiot here.", "\u0130 alpha beta IDIOT here."
    (score, other), spans = toxicity._scored([plain, shouted], field)
    assert score > toxicity.THRESHOLD and other > toxicity.THRESHOLD
    assert [shouted[x["start"] : x["end"]] for x in spans[1]] == ["IDIOT"]


def test_forward_backward_by_enumeration():
    rng = np.random.default_rng(2)
    unary, links = rng.normal(size=6), rng.normal(size=(2, 2))
    place = np.array([0, 1, 2, 3, 0, 1])
    left, right = toxicity.forward_backward(unary, np.cumsum(place == 0) - 1, place, links)
    for begin, end in ((0, 4), (4, 6)):
        weight = np.zeros((end - begin, 2))
        for path in np.ndindex(*[2] * (end - begin)):
            total = math.exp(sum(unary[begin + t] * s for t, s in enumerate(path)) + sum(links[a, b] for a, b in zip(path, path[1:], strict=False)))
            for t, s in enumerate(path):
                weight[t, s] += total
        assert np.allclose(1 / (1 + np.exp(-(left + right)[begin:end])), weight[:, 1] / weight.sum(axis=1))


def test_class_model(odd, none, corpus):
    for docs in (odd, corpus):
        rows = [(i, t, zlib.crc32(str(i or 0).encode()) % 3 > 0) for i, t in texts_of(docs)]
        counts = collections.Counter(w for _, t, learn in rows if learn for w in class_lm.words(t or ""))
        n, v = sum(counts.values()), len(counts)
        learn = F.crc32(F.coalesce("doc_id", F.lit(0)).cast("string").cast("binary")) % 3 > 0
        got = class_lm.score(docs.withColumn("learn", learn), frequent=8, classes=4, parts=5, chunk_chars=2000).collect()
        want = collections.Counter()
        for i, t, _ in rows:
            words = class_lm.words(t or "")
            base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
            want[i, len(words), sum(counts[w] > 0 for w in words), n, round(base, 6)] += 1
        assert collections.Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
        assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert class_lm.score(none.withColumn("learn", F.lit(True))).count() == 0
    assert class_lm.score(odd.withColumn("learn", F.lit(None).cast("boolean"))).filter("n_known > 0").count() == 0


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(9)
    group = rng.integers(0, 3, 30)
    pairs = rng.poisson(np.where((group[:, None] + 1) % 3 == group, 30, 1)).astype(float)

    def likelihood(assigned):
        member = np.eye(3)[assigned]
        table = member.T @ pairs @ member
        return class_lm._xlogx(table).sum() - class_lm._xlogx(table.sum(0)).sum() - class_lm._xlogx(table.sum(1)).sum()

    start = np.empty(30, dtype=int)
    start[np.argsort(-(pairs.sum(0) + pairs.sum(1)), kind="stable")] = np.arange(30) % 3
    found = likelihood(class_lm.exchange(pairs, classes=3))
    assert found > likelihood(start) and found >= likelihood(group) - 1e-6


def test_words_move_by_their_own_neighbours(spark):
    texts = [f"left u{i}ing right" for i in range(20)] + [f"up v{i}ing down" for i in range(20)]
    rows = [(i, t, True) for i, t in enumerate(texts * 3)] + [(900, "left u3ing right", False), (901, "left v3ing right", False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean")
    scores = {r["doc_id"]: r for r in class_lm.score(docs, frequent=5, classes=8, parts=3, chunk_chars=2000).collect()}
    # Words of one ending and count, which only their neighbours tell apart.
    assert scores[900]["base_score"] == scores[901]["base_score"] and scores[900]["score"] > scores[901]["score"] + 0.5


def test_a_word_moves_where_the_likelihood_is_largest():
    rng = np.random.default_rng(0)
    said, classes = rng.integers(0, 12, 300), 4
    said[50:60] = 3
    last, old = np.roll(said, 1), rng.integers(0, classes, 12)

    def table(of):
        return np.bincount(of[last] * classes + of[said], minlength=classes**2).reshape(classes, classes).astype(float)

    def side(word, own, near):
        values, n = np.unique(old[near[own == word]], return_counts=True)
        return np.zeros(len(values), int), values, n

    for word in range(12):
        selves = np.array([((said == word) & (last == word)).sum()])
        new = class_lm.exchanged(old[[word]], side(word, said, last), side(word, last, said), selves, table(old))[0]
        found = [class_lm.likelihood(table(np.where(np.arange(12) == word, c, old))) for c in range(classes)]
        assert abs(found[new] - max(found)) < 1e-6


def test_kneser_ney(spark, odd, none, corpus):
    trusted = spark.createDataFrame([(i,) for i in range(0, 120, 2)] + [(None,)], "doc_id long")
    junk = frame(spark, [(500, "QX!! ZZ##$$ %%QQ" * 5, "en", "a"), (501, None, None, None)])
    rows = {r["doc_id"]: r for r in kneser_ney.classified(corpus.unionByName(junk), trusted).collect()}
    assert len(rows) == 122 and not rows[500]["kept"] and sum(r["kept"] for r in rows.values()) > 110
    assert len(kneser_ney.classified(odd, trusted).collect()) == len(ODD)
    assert kneser_ney.classified(odd, trusted.limit(0)).filter("not kept").count() == 0
    assert kneser_ney.classified(none, trusted).count() == 0


def test_kneser_ney_learns_from_every_trusted_text(spark, monkeypatch):
    texts = F.concat(F.lit("text "), F.col("id").cast("string"))
    docs = spark.range(-200, 20_900).select(F.col("id").alias("doc_id"), texts.alias("text"), F.lit("en").alias("lang"))
    trusted = docs.filter("doc_id % 50 <> 7").select("doc_id").unionByName(spark.createDataFrame([(1,), (1 << 62,), (None,)], "doc_id long"))
    score, learned = kneser_ney.perplexities, []
    monkeypatch.setattr(kneser_ney, "perplexities", lambda d: learned.append({r[0] for r in d.filter("learn").select("doc_id").collect()}) or score(d))
    assert kneser_ney.classified(docs, trusted).count() == 21_100
    assert learned == [{i for i in range(-200, 20_900) if math.fmod(i, 50) != 7}]


def test_kneser_ney_probabilities_add_up(spark):
    gram = lambda a, b, c: (a << 42) | (b << 21) | c
    rng = random.Random(4)
    seen = {gram(*(rng.randrange(6) for _ in range(3))): rng.choice([1, 1, 2, 3, 9]) for _ in range(60)}
    symbols = {g & kneser_ney.MASK for g in seen}
    asked = {gram(a, b, c) for a in (0, 3, 9) for b in (1, 9) for c in {*symbols, 99}}
    rows = [(0, g, n) for g, n in seen.items()] + [(0, g, 0) for g in asked - set(seen)]
    sums = collections.Counter()
    for r in kneser_ney.probabilities(spark.createDataFrame(rows, "part int, gram long, n long")).collect():
        if r["gram"] in asked:
            sums[r["gram"] >> 21] += 10 ** r["score"]
    assert len(sums) == 6 and all(abs(s - 1) < 1e-9 for s in sums.values())


def test_top_k(spark):
    rng = random.Random(6)
    rows = [(i % 190, [rng.choice([-0.5, 0.0, 0.25, rng.random()]) for _ in range(6)], 7) for i in range(200)]
    rows += [(300, None, 1), (301, [0.1, None, 0.0, 0.0, 0.0, 0.0], 1), (302, [float("nan")] * 6, 1), (303, [0.5], 1), (None, [0.5] * 6, 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int").withColumn("vector", topk.integers("embedding"))
    good = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows if i is not None and v and None not in v and not any(map(math.isnan, v))]
    asked = {}
    for i, v in good:
        if i % 10 == 0:
            asked[i] = min(asked.get(i, v), v)
    want = []
    for q, v in asked.items():
        best = sorted((-sum(a * b for a, b in zip(v, c, strict=False)), i) for i, c in good if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    got = topk.top_k(frame, frame.filter("vec_id % 10 = 0"), block=30, query_block=4)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert topk.top_k(frame.limit(0), frame).count() == 0 and topk.top_k(frame, frame.limit(0)).count() == 0


def test_top_k_leaves_out_cells_below_the_floor(spark):
    rng = random.Random(9)
    centres = [[rng.choice([-200, 200]) for _ in range(8)] for _ in range(12)]
    rows = [(i, [c + rng.randint(-9, 9) for c in centres[i % 12]]) for i in range(1800)]
    frame = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    asked = frame.filter("vec_id % 50 = 0")
    want = []
    for q, v in rows[::50]:
        best = sorted((-sum(a * b for a, b in zip(v, c, strict=True)), i) for i, c in rows if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    for pivots in (1, 24):
        assert sorted(map(tuple, topk.top_k(frame, asked, block=40, query_block=3, pivots=pivots).collect())) == sorted(want)
    dealt, cells = topk.in_cells(frame, 8, 24)
    assert dealt.count() == cells.rows.sum() == len(rows)
    floors = {q: s for q, n, _, s in want if n == 5}
    known = spark.createDataFrame([(q, v, floors[q]) for q, v in rows[::50]], "vec_id long, vector array<long>, floor long")
    at = {(r["vec_id"], r["cell"]) for r in topk.reached(known, cells).collect()}
    homes = {r["vec_id"]: r["cell"] for r in dealt.collect()}
    assert {(q, homes[i]) for q, _, i, _ in want} <= at and len(at) < len(floors) * len(cells.number) / 2


def test_mixing_meets_its_targets(spark, odd, none, corpus):
    weighed = corpus.withColumn("tokens", mixing.tokens("text")).withColumn("kind", F.when(F.col("doc_id") % 5 > 0, F.lit("k")))
    rows = mixing.mixed(weighed, ["source", "kind"], {"source": 0.0, "kind": 0.5}).join(weighed.select("doc_id", "source", "kind"), "doc_id")
    shares = {r["source"]: r["t"] for r in rows.groupBy("source").agg(F.sum(F.col("tokens") * F.col("probability")).alias("t")).collect()}
    assert abs(shares["a"] / shares["b"] - 1) < 1e-3
    cells = collections.Counter()
    for r in weighed.collect():
        cells[r["source"], r["kind"]] += r["tokens"]
    kinds = {k: math.sqrt(sum(n for (_, x), n in cells.items() if x == k)) for k in {k for _, k in cells}}
    weight = dict.fromkeys(cells, 1.0)
    for _ in range(60):
        for at, target in ((0, {"a": 0.5, "b": 0.5}), (1, {k: x / sum(kinds.values()) for k, x in kinds.items()})):
            mass = collections.Counter()
            for cell, n in cells.items():
                mass[cell[at]] += n * weight[cell]
            weight = {c: w * target[c[at]] / mass[c[at]] for c, w in weight.items()}
    top = max(weight.values())
    assert all(abs(r["probability"] - weight[r["source"], r["kind"]] / top) < 1e-3 for r in rows.collect())
    assert all(r["selected"] == (int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:13], 16) / 2**52 < r["probability"]) for r in rows.collect())
    strange = mixing.mixed(odd.withColumn("tokens", mixing.tokens("text")), ["source", "lang"], share=0.8).collect()
    assert len(strange) == len(ODD) and not any(r["selected"] for r in strange if r["doc_id"] in (1, 2, 3))
    assert mixing.mixed(none.withColumn("tokens", mixing.tokens("text")), ["source"]).count() == 0


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = common.written(stage(spark, docs, folder), "stage")
        assert kept.columns == columns and kept.exceptAll(docs).isEmpty(), name
        docs = kept
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert sorted(texts_of(last)) == sorted(texts_of(docs))
    assert sorted(texts_of(corpus_pipeline.run(spark, folder))) == sorted(texts_of(docs))
    near = {r["doc_id"] for r in jaccard_join.linked(docs).collect()}
    assert near == {i for i, _ in texts_of(docs)}


def as_counts(docs):
    return collections.Counter((r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect())


def test_pipeline_stages_on_odd_rows(spark, monkeypatch):
    long = " ".join(WORDS)
    rows = [
        *ODD,
        (None, "another text that has no id at all", "en", "c"),
        (None, "another text that has no id at all", "en", "c"),
        (None, SAME, "en", "c"),
        (60, long, "en", "a"),
        (70, long, "en", "a"),
        (70, "one of a kind though its id is not", "en", "a"),
        (71, long.replace("upsilon", "omega"), "en", "a"),
        (71, "nothing else in here reads like this row", "en", "a"),
        (80, "identical rows with one id are one document", "en", "a"),
        (80, "identical rows with one id are one document", "en", "a"),
    ]
    docs = frame(spark, rows)
    groups = collections.defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r)
    order = lambda r: (r[0] is None, r[0] or 0)
    first = common.written(corpus_pipeline.exact_copies(spark, docs, ""), "stage")
    got = as_counts(first)
    assert sum(got.values()) == len(groups) and max(got.values()) == 1
    norm = lambda text: re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
    assert {(norm(t), i) for i, t, *_ in got} == {(t, min(g, key=order)[0]) for t, g in groups.items()}
    # Near copies: document 71 differs from 60 in one word, 8 from 6 in case only.
    second = as_counts(corpus_pipeline.near_copies(spark, first, ""))
    assert second == collections.Counter({r: 1 for r in got if not (r[0] == 71 and "omega" in r[1]) and r[0] != 8})
    # Near copies alone: also of rows that are equal in every way one stays.
    again = as_counts(corpus_pipeline.near_copies(spark, docs.filter("doc_id in (60, 70, 71, 80)"), ""))
    assert sorted((i, t[:5]) for i, t, *_ in again.elements()) == [(60, long[:5]), (70, "one o"), (71, "nothi"), (80, "ident")]
    # Every row has the verdict of its own cell.
    weighed = mixing.mixed(queries.with_topic(docs).withColumn("tokens", mixing.tokens("text")), list(queries.POWERS), queries.POWERS, share=corpus_pipeline.KEPT_TOKENS)
    third = corpus_pipeline.mixture(spark, docs, "")
    assert third.columns == docs.columns and third.count() == weighed.filter("selected").count()
    monkeypatch.setattr(mixing, "uniform_draw", lambda doc_id: F.lit(0.0))
    assert as_counts(corpus_pipeline.mixture(spark, docs, "")) == collections.Counter(r for r in rows if (r[1] or "").split())


def test_repositories_and_marks_in_the_verdict_on_secrets(spark):
    key = "Zq7Zq7Zq7Zq7"
    rows = [(1, f"token = {key}.", None, "a"), (2, f"see k={key} here", None, "a"), (3, f"and {key}. And", None, "a"), (4, f"x{key}", None, "a")]
    owned = lambda rows: frame(spark, rows).withColumn("owner", F.lit("o")).withColumn("repo", F.col("lang"))
    got = {r["doc_id"]: r for r in secret_scan.scan(owned(rows)).collect()}
    assert {i: r["spans"] for i, r in got.items()} == {1: "assign:0:21", 2: "owned:4:18", 3: "owned:4:17", 4: ""}
    assert (got[1]["n_live"], got[1]["most_owners"], got[1]["most_repos"], got[4]["most_repos"]) == (1, 1, 1, 0)
    # One owner, but more repositories than a live value is kept in; then so many that it must be an example.
    many = lambda n: {r["doc_id"]: r for r in secret_scan.scan(owned([(i, f"token = {key}", f"r{i}", "a") for i in range(n)])).collect()}[0]
    assert [(many(n)["n_live"], many(n)["n_example"]) for n in (2, 3, 9)] == [(1, 0), (0, 0), (0, 1)]


def test_very_many_secrets_in_one_text(spark):
    import time

    text = " ".join(f"token={i:08d}a bare{i:08d}" for i in range(32_000))
    docs = frame(spark, [(1, text, "en", "a")]).withColumn("repo", F.col("lang")).withColumn("owner", F.col("source"))
    secret_scan.scan(docs.limit(1)).collect()
    began = time.time()
    row = secret_scan.scan(docs).collect()[0]
    assert row["n_assign"] == 32_000 and row["base"] == brute_spans(text) and time.time() - began < 20


def test_samples_take_few_more_rows_than_they_keep(spark, monkeypatch):
    docs = spark.range(30_000).selectExpr("id AS doc_id", "concat('some words of text ', id) AS text", "if(id % 3 = 0, 'en', 'de') AS lang").repartition(40)
    ranked = []
    kept = language.below_cutoff
    monkeypatch.setattr(language, "below_cutoff", lambda key, hashed, cut: ranked.append(docs.filter(kept(key, hashed, cut)).count()) or kept(key, hashed, cut))
    learned = language.train_dictionaries(docs, passages=100)
    assert ranked[0] <= 4 * 200 and all(c.count(b"\n") == 99 for c in learned.values())
    order = sorted((r["h"], r["text"]) for r in docs.filter("lang = 'en'").select(F.xxhash64("doc_id").alias("h"), language.letters_only("text").alias("text")).collect())
    assert len(learned["en"].split(b"\n")) == 100 and learned["en"].split(b"\n")[0].decode() in order[0][1]


def test_a_chunk_that_is_read_in_another_order_is_refused(spark):
    words = chunks.by_token(lambda text: text.split())
    pieces = lambda text: chunks.chunked(frame(spark, [(1, text, None, None)]).selectExpr("doc_id", "text", "true AS learn"), words, 4)
    rows = [pieces(t).toArrow() for t in ("a b c d e f", "f e d c b a")]
    keys = [r.filter(chunks.pa.compute.not_equal(r.column("part"), chunks.DOCS)) for r in rows]
    docs, parts, tables = chunks.met(rows[0], keys[0], chunks.KEYS)
    assert sum(map(len, tables)) == 6 and parts == sorted(parts)
    with pytest.raises(ValueError, match="another order"):
        chunks.met(rows[0], keys[1], chunks.KEYS)


def test_cells_of_chunks_grow_with_the_chunks(spark):
    rng = random.Random(1)
    names = [f"w{i}" for i in range(400)]

    def cells(documents):
        rows = [(i, " ".join(rng.choice(names) for _ in range(60)), None, None) for i in range(documents)]
        docs = frame(spark, rows).selectExpr("doc_id", "text", "true AS learn").coalesce(1)
        parts = chunks.part_count(docs)
        found = chunks.chunked(docs, chunks.by_token(lambda text: text.split()), parts, chunk_chars=8000).toArrow()
        return found.num_rows, max(len(d) for p, d in zip(found.column("part").to_pylist(), found.column("data").to_pylist(), strict=True) if p >= 0)

    (few, size), (many, _) = cells(100), cells(400)
    assert many <= 4.5 * few and size < 200


def test_class_scores_against_their_classes(spark):
    """Scores anew from what the model says of its classes: transitions and emissions from plain counts."""
    rng = random.Random(12)
    texts = [" ".join(rng.choice(WORDS[:8] if i % 2 else WORDS[8:]) for _ in range(rng.randrange(1, 20))) for i in range(60)]
    docs = spark.createDataFrame([(i, t, i % 4 > 0) for i, t in enumerate(texts)], "doc_id long, text string, learn boolean")
    placed = {}
    settle = class_lm.placed

    def spy(*given):
        answers, kinds, table, types = settle(*given)
        rows = answers.collect()
        units = given[2]
        placed["of"] = {(r["chunk"], r["part"]): class_lm._classes(chunks.pa.table(chunks.opened(r["data"], kinds)), units) for r in rows}
        return answers, kinds, table, types

    words = {}
    known = class_lm.chunks.chunked

    def keys(docs, number, parts, chars, exchanged):
        cut = known(docs, number, parts, chars, exchanged)
        for r in cut.collect():
            if r["part"] >= 0:
                words[r["chunk"], r["part"]] = chunks.opened(r["data"], chunks.KEYS)["key"].to_pylist()
        return cut

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(class_lm, "placed", spy)
        patch.setattr(class_lm.chunks, "chunked", keys)
        got = {r["doc_id"]: r["score"] for r in class_lm.score(docs.coalesce(1), frequent=6, classes=4, parts=3).collect()}
    of = {w: int(c) for cell, some in words.items() for w, c in zip(some, placed["of"][cell], strict=True)}
    lines = [class_lm.words(t) for t in texts]
    table, counts = np.zeros((4, 4)), collections.Counter()
    for i, line in enumerate(lines):
        if i % 4:
            counts.update(line)
            for a, b in zip([class_lm.END, *line], line, strict=False):
                table[of[a], of[b]] += 1
    types = np.zeros(4)
    for w in counts:
        types[of[w]] += 1
    usual = (table.sum(0) + 1) / (table.sum() + 4)
    moves = (table + 4 * usual) / (table.sum(1, keepdims=True) + 4)
    room = table.sum(0) + types + 1
    for i, line in enumerate(lines):
        want = sum(math.log10(moves[of[a], of[b]]) + math.log10((counts[b] + 1) / room[of[b]]) for a, b in zip([class_lm.END, *line], line, strict=False))
        assert abs(got[i] - want) < 1e-6


def test_kneser_ney_against_dictionaries(spark, corpus):
    texts = texts_of(corpus)[:40]
    docs = spark.createDataFrame([(i, t, i % 3 > 0) for i, t in texts], "doc_id long, text string, learn boolean")
    line = lambda t: [kneser_ney.START, kneser_ney.START, *map(ord, t or ""), kneser_ney.STOP]
    three = collections.Counter(tuple(line(t)[i : i + 3]) for n, t in texts if n % 3 for i in range(len(line(t)) - 2))
    two = collections.Counter(g[1:] for g in three)
    one = collections.Counter(g[1:] for g in two)

    def discounts(level):
        n = [sum(c == i for c in level.values()) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        return [min(i, max(0.05, i - (i + 1) * y * b / a)) if a else 0.5 * i for i, a, b in ((1, n[0], n[1]), (2, n[1], n[2]), (3, n[2], n[3]))]

    def shares(level):
        d = discounts(level)
        total, freed, off = collections.Counter(), collections.Counter(), {}
        for g, c in level.items():
            off[g] = d[min(c, 3) - 1]
            total[g[:-1]] += c
            freed[g[:-1]] += off[g]
        return {g: max(c - off[g], 0) / total[g[:-1]] for g, c in level.items()}, {c: freed[c] / total[c] for c in total}

    (s3, r3), (s2, r2), (s1, r1) = shares(three), shares(two), shares(one)

    def probability(g):
        p1 = s1.get(g[2:], 0) + r1[()] / (len(one) + 1)
        p2 = s2.get(g[1:], 0) + r2.get(g[1:2], 1) * p1
        return s3.get(g, 0) + r3.get(g[:2], 1) * p2

    got = {r["doc_id"]: r["perplexity"] for r in kneser_ney.perplexities(docs, parts=3, chunk_chars=500).collect()}
    for i, t in texts:
        grams = [tuple(line(t)[j : j + 3]) for j in range(len(line(t)) - 2)]
        want = 10 ** -(sum(math.log10(probability(g)) for g in grams) / len(grams))
        assert abs(got[i] / want - 1) < 1e-6


def test_language_choice_against_plain_compression(spark, corpus):
    import zstandard

    learned = {"de": b"der die das und nicht ein eine " * 40, "en": b"alpha beta gamma the and of with text " * 40}
    rows = corpus.select("doc_id", "text").union(spark.createDataFrame([(900, "das ist nicht der text"), (901, "x" * 9000)], "doc_id long, text string"))
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(rows, learned).collect()}
    for i, text in texts_of(rows):
        data = re.sub(r"[\W\d_]+", " ", text).lower().encode()
        sizes = {}
        for lang, content in learned.items():
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=language.LEVEL)
            press = zstandard.ZstdCompressor(dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes[lang] = sum(len(press.compress(data[j : j + language.PIECE_BYTES])) for j in range(0, len(data), language.PIECE_BYTES))
        assert got[i] == min(sizes, key=lambda x: (sizes[x], x))


def test_raking_tells_how_far_it_is_off(spark):
    cells = spark.createDataFrame([("=a", "=x", 10), ("=b", "=y", 10)], "s string, k string, tokens long")
    named = lambda a, b, x, y: {"s": spark.createDataFrame([("=a", a), ("=b", b)], "value string, share double"), "k": spark.createDataFrame([("=x", x), ("=y", y)], "value string, share double")}
    assert mixing.rake(cells, named(0.3, 0.7, 0.3, 0.7)).first()["residual"] <= mixing.TOLERANCE
    # No weights meet both margins, as each source has one kind only.
    assert mixing.rake(cells, named(0.3, 0.7, 0.6, 0.4)).first()["residual"] > 0.1


def test_stages_keep_columns_of_any_name(spark):
    names = ["tokens", "topic", "place", "row", "row_key", "id_key", "text_key", "number", "component", corpus_pipeline.ROW + "2"]
    rows = [(*r, *[f"{c}{i}" for c in names]) for i, r in enumerate([*ODD, (60, "one more text that nothing else here is like", "en", "a")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in names))
    for stage in (corpus_pipeline.exact_copies, corpus_pipeline.near_copies, corpus_pipeline.mixture):
        kept = stage(spark, docs, "")
        assert kept.columns == docs.columns and kept.exceptAll(docs).isEmpty() and kept.count() > 0
        assert stage(spark, docs.limit(0), "").columns == docs.columns and stage(spark, docs.limit(0), "").count() == 0
    folder = "/root/testdata/sf0.001"
    kept = corpus_pipeline.clean(spark, docs, folder)
    assert kept.columns == docs.columns and as_counts(kept) == as_counts(docs) and corpus_pipeline.clean(spark, docs.limit(0), folder).count() == 0
    encoded = corpus_pipeline.encoding(spark, docs, folder)
    assert sorted((r["doc_id"] or 0, r["text"]) for r in encoded.collect()) == sorted((r[0] or 0, r[1] or "") for r in rows)
    assert corpus_pipeline.encoding(spark, docs.limit(0), folder).count() == 0
