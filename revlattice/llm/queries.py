"""The operators over the given tables, with the columns of their contracts, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlattice.llm import bpe, class_lm, collocations, exact_dedup, jaccard_join, kneser_ney, language, mixing, prefix_trie, repeats, secret_scan, topk, toxicity
from revlattice.llm.common import documents, remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Learning rows of classifiers are those whose checksum modulo 4 is not 2.
FOLDS, HELD = 4, 2
RANKS = "byte_bpe_multi_50k.tiktoken"
#: Target shares follow the margins' own token sums to these powers.
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.8}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def held_out(doc_id: str = "doc_id", folds: int = FOLDS):
    return remainder(doc_id, folds) == HELD


@query
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    learned = language.train_dictionaries(docs.filter(~held_out()))
    return language.identify(docs, learned).withColumn("held_out", held_out())


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


ORACLES["op2_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""


@query
def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").select("doc_id")
    return kneser_ney.classified(docs, labels.filter(~held_out())).withColumn("held_out", held_out())


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    encoded = bpe.encode(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "source", "lang")
    owned = docs.select("doc_id", "text", F.concat_ws("/", "source", "lang").alias("repo"), F.col("source").alias("owner"))
    found = secret_scan.scan(owned)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_live", "n_example", "most_owners", "most_repos")


def _matches(kind: int, pattern: str, value: str) -> str:
    """SQL: matches of a pattern with their offsets, from the lengths of matches and of the pieces between them."""
    quoted = "'" + pattern.replace("'", "''") + "'"
    return f"""
  SELECT doc_id, owner, repo, {kind} AS kind, st, st + length(v) AS en, {value.format(quoted)} AS value FROM (
    SELECT doc_id, owner, repo, z[2] AS v, sum(length(z[3])) OVER w + coalesce(sum(length(z[2])) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st
    FROM (SELECT doc_id, owner, repo, unnest(list_zip(range(1, len(vs) + 1), vs, string_split_regex(t, {quoted}))) AS z
          FROM (SELECT doc_id, owner, repo, t, regexp_extract_all(t, {quoted}) AS vs FROM d))
    WHERE z[2] IS NOT NULL WINDOW w AS (PARTITION BY doc_id ORDER BY z[1])) AS found"""


_LISTED = "coalesce(string_agg(['assign', 'access', 'hex', 'owned'][kind] || ':' || CAST(st AS BIGINT) || ':' || CAST(en AS BIGINT), ',' ORDER BY st, kind){}, '')"
_COMPARED = f"regexp_replace(regexp_replace(value, '{secret_scan.END_MARKS}', ''), '{secret_scan.NAME}', '')"
_RANDOM = "length(value) >= 12 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')"

ORACLES["op5_secret_scan"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce('=' || source, '-') AS owner, concat_ws('/', source, lang) AS repo FROM documents),
base AS (SELECT * REPLACE ({_COMPARED} AS value) FROM (SELECT * FROM ({_matches(1, secret_scan.ASSIGN, "regexp_extract(v, {}, 2)")}) WHERE length(value) >= 6
  UNION ALL {_matches(2, secret_scan.ACCESS, "v")} UNION ALL {_matches(3, secret_scan.HEX, "v")})),
bare AS (SELECT * FROM (SELECT * REPLACE ({_COMPARED} AS value) FROM ({_matches(4, secret_scan.BARE, "v")})) x WHERE {_RANDOM}
  AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = x.doc_id AND b.st < x.en AND x.st < b.en)),
spans AS (SELECT * FROM base UNION ALL SELECT * FROM bare),
held AS (SELECT value, count(DISTINCT owner) AS owners, count(DISTINCT repo) AS repos, bool_or(kind < 4) AS named,
  count(DISTINCT owner) <= {secret_scan.LIVE_OWNERS} AND count(DISTINCT repo) <= {secret_scan.LIVE_REPOS} AND {_RANDOM} AS live,
  count(DISTINCT owner) > {secret_scan.EXAMPLE_OWNERS} OR count(DISTINCT repo) > {secret_scan.EXAMPLE_REPOS} AS example
  FROM spans GROUP BY value),
told AS (SELECT s.*, h.owners, h.repos, h.live, h.example FROM spans s JOIN held h ON h.value = s.value WHERE h.named AND (s.kind < 4 OR h.live)),
listed AS (SELECT doc_id, count(*) FILTER (kind = 1) AS n_assign, count(*) FILTER (kind = 2) AS n_access, count(*) FILTER (kind = 3) AS n_hex,
  {_LISTED.format(" FILTER (kind < 4)")} AS base, {_LISTED.format("")} AS spans, count(*) FILTER (live AND kind < 4) AS n_live,
  count(*) FILTER (example AND kind < 4) AS n_example, max(owners) FILTER (kind < 4) AS most_owners, max(repos) FILTER (kind < 4) AS most_repos FROM told GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
  coalesce(most_owners, 0) AS most_owners, coalesce(most_repos, 0) AS most_repos
FROM d LEFT JOIN listed l ON l.doc_id = d.doc_id
"""


@query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked(documents(spark, sf_dir))


ORACLES["op6_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS l FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(l) = 0 THEN [] WHEN len(l) < 5 THEN [array_to_string(l, ' ')]
        ELSE list_transform(range(1, len(l) - 3), lambda i: array_to_string(l[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
r AS (SELECT a AS d, b AS t FROM e UNION SELECT r.d, e.b FROM r JOIN e ON r.t = e.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(min(r.t), w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN r ON r.d = w.doc_id GROUP BY w.doc_id, n.n
"""


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.tag(docs, toxicity_field(spark, docs, sf_dir)).select("doc_id", held_out().alias("held_out"), "score", "predicted", "n_spans")


def toxicity_field(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Field:
    """The field that the labelled rows of ``docs`` teach, but for the held out ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.train(docs.filter(~held_out()), labels)


@query
def op8_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("learn", ~held_out(folds=7))
    scored = class_lm.score(docs)
    return scored.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", topk.integers("embedding").alias("vector"))
    return topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"))


ORACLES["op9_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def with_topic(docs: DataFrame) -> DataFrame:
    """``topic`` by the form of the text: table, shout, notice or prose; a null text has none."""
    text = F.col("text")
    kind = F.when(text.contains(" | "), "table").when(text.contains("!!"), "shout").when(text.rlike("Licens|Copyright"), "notice").otherwise("prose")
    return docs.withColumn("topic", F.when(text.isNotNull(), kind))


@query
def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_topic(documents(spark, sf_dir, "doc_id", "text", "source", "lang"))
    return mixing.mixed(docs.withColumn("tokens", mixing.tokens("text")), list(POWERS), POWERS)


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir, "text", "lang"))


ORACLES["op11_collocations"] = r"""
WITH p AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM p, (VALUES (1), (2), (3)) t(k)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
halves AS MATERIALIZED (SELECT c.*, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS rest FROM c, (VALUES (1), (2)) t(cut) WHERE cut < k),
cuts AS (SELECT h.*, x.f AS l, y.f AS r, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM halves h JOIN f x ON x.lang = h.lang AND x.phrase = h.head JOIN f y ON y.lang = h.lang AND y.phrase = h.rest),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_pairs AS (SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM c WHERE k = 3 UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM c WHERE k = 3),
kept AS (SELECT * FROM lowest b WHERE NOT EXISTS (SELECT 1 FROM inner_pairs i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.a >= 50 * b.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000
"""


@query
def op12_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.removed(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op12_repeat_removal"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS k FROM (SELECT doc_id, h, unnest(range(len(h) // 2 - 99)) AS i FROM d)),
late AS (SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
runs AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
  SELECT doc_id, i, CAST(i - lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) > 100 AS INT) AS new FROM late)),
spans AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM runs GROUP BY doc_id, run)),
kept AS (SELECT s.doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS tail, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS h
  FROM spans s JOIN d ON d.doc_id = s.doc_id GROUP BY s.doc_id)
SELECT d.doc_id, len(d.h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept.h || substr(d.h, 2 * tail + 1), d.h))) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""


@query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: SQL: the unsigned CRC-32 of a number's decimal digits, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)))"""

ORACLES["op13_conversation_trie"] = rf"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT conv_id, max(place) AS n, {_CRC32.format("conv_id")} % 4 AS h, conv_id - conv_id % 20 AS head FROM t GROUP BY conv_id),
c AS (SELECT s.*, least(s.h, coalesce(d.n, 0)) AS k, least(s.h, coalesce(d.n, 0)) + greatest(s.n - s.h, 0) AS size FROM s LEFT JOIN s d ON d.conv_id = s.head),
r AS (SELECT c.conv_id, k + place - h AS depth, role, text FROM c JOIN t ON t.conv_id = c.conv_id WHERE place > h
  UNION ALL SELECT c.conv_id, place, role, text FROM c JOIN t ON t.conv_id = c.head WHERE place <= k),
p AS (SELECT conv_id, depth, md5(string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node,
    len(regexp_extract_all(text, '[^ 	-
]+')) AS words FROM r
  UNION ALL SELECT conv_id, 0, '', 0 FROM c),
n AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words FROM p GROUP BY node, depth),
up AS (SELECT n.node, q.node AS parent FROM n JOIN p q ON q.conv_id = n.conv_id AND q.depth = n.depth - 1),
kids AS (SELECT parent AS node, count(*) AS n_children FROM up GROUP BY parent),
sums AS (SELECT q.node, sum((kids.node IS NULL)::INT) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
  FROM n LEFT JOIN kids ON kids.node = n.node JOIN p q ON q.conv_id = n.conv_id AND q.depth <= n.depth GROUP BY q.node),
ends AS (SELECT node, sha256(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id)) AS digest FROM p JOIN c ON c.conv_id = p.conv_id AND c.size = p.depth GROUP BY node)
SELECT n.conv_id, n.depth, top.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(digest, sha256('')) AS ends_sha256
FROM n JOIN sums ON sums.node = n.node LEFT JOIN kids ON kids.node = n.node LEFT JOIN ends ON ends.node = n.node
LEFT JOIN up ON up.node = n.node LEFT JOIN n top ON top.node = up.parent
"""
