"""One query per operator, over whole tables, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from epigrid.llm import (
    centroid_clusters, collocations, golay_simhash, line_dedup, packing, quality_classifier, quality_rules, sentencepiece_codec,
    substring_dedup, token_counts, topk_search, toxicity, warc,
)
from epigrid.llm.common import learned_rows, table


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), length=2048, added_tokens=True)


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.classes(table(spark, folder, "documents"), threshold=2, least_chars=20, short_equal=True)
    return found.select(
        F.col("id").alias("doc_id"), F.col("at").alias("line"), F.col("class_id").alias("class_doc_id"),
        F.col("class_at").alias("class_line"), "n_links", "kept",
    )


def op3_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.nearest(table(spark, folder, "embeddings"), F.col("id") % 50 == 0, k=5)


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.digests(table(spark, folder, "documents"), window=35)


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels"), parts=4, left_out=2)
    return toxicity.score(docs, model, threshold=0.3, spans=True).withColumn("held_out", ~learned_rows("doc_id", 4, 2))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "good_probability"
    )


def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece_codec.digests(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality_classifier.train(docs, table(spark, folder, "labels"), parts=3, left_out=1)
    return quality_classifier.score(docs, model, threshold=0.5).withColumn("held_out", ~learned_rows("doc_id", 3, 1))


def op9_simhash_golay(spark: SparkSession, folder: str) -> DataFrame:
    return golay_simhash.near_duplicates(table(spark, folder, "documents"), width=4)


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    index = warc.archive(table(spark, folder, "pages"), least_bytes=1000)
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return centroid_clusters.cluster(table(spark, folder, "embeddings"), k=40, rounds=5, width=64, seed="2")


def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.counts(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine(table(spark, folder, "documents"), least=30, percent=80, top=2000)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_best_fit_packing": op1_best_fit_packing,
        "op2_line_dedup": op2_line_dedup,
        "op3_exact_topk": op3_exact_topk,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_toxicity": op5_toxicity,
        "op6_quality_rules": op6_quality_rules,
        "op7_sentencepiece": op7_sentencepiece,
        "op8_quality_classifier": op8_quality_classifier,
        "op9_simhash_golay": op9_simhash_golay,
        "op10_warc": op10_warc,
        "op11_centroid_clusters": op11_centroid_clusters,
        "op12_token_counts": op12_token_counts,
        "op13_collocations": op13_collocations,
    }


EXACT_TOPK = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e::DOUBLE[], c.e::DOUBLE[]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


NEAR_LINES = """
WITH RECURSIVE occurrences AS (
  SELECT doc_id, CAST(i AS INTEGER) AS line, lines[i + 1] AS t
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents) d, range(len(lines)) r(i)
  WHERE length(lines[i + 1]) >= 20 OR translate(lines[i + 1], chr(32) || chr(9) || chr(11) || chr(12) || chr(13), '') <> ''
), lines AS (SELECT t, row_number() OVER () AS k, length(t) AS n FROM (SELECT DISTINCT t FROM occurrences)),
near AS (
  SELECT a.k AS a, b.k AS b FROM lines a JOIN lines b
    ON a.n >= 20 AND b.n >= 20 AND a.n BETWEEN b.n - 2 AND b.n + 2 AND a.k <> b.k AND levenshtein(a.t, b.t) <= 2
), reached(k, other) AS (
  SELECT k, k FROM lines UNION SELECT r.k, n.b FROM reached r JOIN near n ON r.other = n.a
), placed AS (SELECT o.doc_id, o.line, l.k FROM occurrences o JOIN lines l ON o.t = l.t),
firsts AS (
  SELECT r.k, min({'d': p.doc_id, 'l': p.line}) AS f FROM reached r JOIN placed p ON r.other = p.k GROUP BY r.k
)
SELECT p.doc_id, p.line, f.d AS class_doc_id, f.l AS class_line,
  (SELECT count(*) FROM near n WHERE n.a = p.k) AS n_links, p.doc_id = f.d AND p.line = f.l AS kept
FROM placed p JOIN firsts USING (k)
"""

REPEATED_WINDOWS = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i + 1:i + 35], ' ') AS t FROM w, range(len(words) - 34) r(i)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY t) AS n FROM windows) WHERE n > 1
), covered AS (SELECT DISTINCT doc_id, i + j AS i FROM repeated, range(35) r(j)),
kept AS (
  SELECT doc_id, string_agg(words[i + 1], ' ' ORDER BY i) AS t, count(*) AS n
  FROM (SELECT doc_id, words, i FROM w, range(len(words)) r(i)) ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

REVISITS = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
r AS (SELECT page_id, body, strlen(body) AS n, max(page_id) OVER (PARTITION BY body) AS last FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
FROM r
"""


def _rounds(rounds: int = 5, k: int = 40) -> str:
    """Centroid clustering with one row per vector and component; the rounds are written out one after the other."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS (
  SELECT v.rid, c.k, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{r} c USING (j) GROUP BY v.rid, c.k
), a{r} AS (SELECT rid, min({{'d': d, 'k': k}}) AS best FROM d{r} GROUP BY rid)""")
        if r < rounds:
            steps.append(f"""s{r} AS (
  SELECT a.best.k AS k, v.j, sum(v.x) AS s, count(*) AS n FROM a{r} a JOIN v USING (rid) GROUP BY a.best.k, v.j
), c{r + 1} AS (
  SELECT c.k, c.j, CASE WHEN s.n IS NULL THEN c.x ELSE CAST((s.s - ((s.s % s.n) + s.n) % s.n) // s.n AS BIGINT) END AS x
  FROM c{r} c LEFT JOIN s{r} s USING (k, j)
)""")
    return f"""
WITH e AS (
  SELECT row_number() OVER () AS rid, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), v AS (SELECT rid, unnest(q) AS x, generate_subscripts(q, 1) AS j FROM e),
f AS (
  SELECT rid, row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)), q) - 1 AS k FROM e WHERE vec_id IS NOT NULL
), c0 AS (SELECT f.k, v.j, v.x FROM f JOIN v USING (rid) WHERE f.k < {k}),
{", ".join(steps)},
h AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS mark FROM c{rounds} GROUP BY k)
SELECT e.vec_id, CAST(a.best.k AS INTEGER) AS cluster, CAST(a.best.d AS BIGINT) AS distance,
  CAST(sum(a.best.d) OVER (PARTITION BY a.best.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.best.d) OVER () AS BIGINT) AS inertia,
  h.mark AS centroid_sha256
FROM e JOIN a{rounds} a USING (rid) JOIN h ON h.k = a.best.k
"""


COLLOCATIONS = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM texts),
worded AS (SELECT row_number() OVER () AS piece, lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
words AS MATERIALIZED (SELECT piece, lang, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM worded),
led AS MATERIALIZED (
  SELECT lang, a, lead(a) OVER x AS b, lead(a, 2) OVER x AS c, lead(a, 3) OVER x AS d FROM words
  WINDOW x AS (PARTITION BY piece ORDER BY i)
), counted AS (
  SELECT lang, [a] AS p, count(*) AS f FROM led GROUP BY lang, a
  UNION ALL SELECT lang, [a, b], count(*) FROM led WHERE b IS NOT NULL GROUP BY lang, a, b
  UNION ALL SELECT lang, [a, b, c], count(*) FROM led WHERE c IS NOT NULL GROUP BY lang, a, b, c
  UNION ALL SELECT lang, [a, b, c, d], count(*) FROM led WHERE d IS NOT NULL GROUP BY lang, a, b, c, d
), often AS MATERIALIZED (SELECT * FROM counted WHERE f >= 30),
found AS (SELECT lang, p, f AS a FROM often WHERE len(p) > 1),
cuts AS (
  SELECT c.lang, c.p, c.a, k, x.f AS l, y.f AS r, CAST(2000000 AS HUGEINT) * c.a // (x.f + y.f) AS score
  FROM found c JOIN (VALUES (1), (2), (3)) s(k) ON k < len(c.p)
  JOIN often x ON x.lang = c.lang AND x.p = c.p[1:k] JOIN often y ON y.lang = c.lang AND y.p = c.p[k + 1:len(c.p)]
), best AS (SELECT lang, p, a, min({'score': score, 'k': k, 'l': l, 'r': r}) AS b FROM cuts GROUP BY ALL),
inner_parts AS (
  SELECT lang, p[i:i + m - 1] AS p, max(a) AS most
  FROM found JOIN (VALUES (3, 2, 1), (3, 2, 2), (4, 2, 1), (4, 2, 2), (4, 2, 3), (4, 3, 1), (4, 3, 2)) s(n, m, i) ON len(p) = n GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b LEFT JOIN inner_parts i ON i.lang = b.lang AND i.p = b.p
  WHERE i.most IS NULL OR CAST(100 AS HUGEINT) * i.most < CAST(80 AS HUGEINT) * b.a
), ranked AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, b.l AS l, b.r AS r, CAST(b.score AS BIGINT) AS score,
    row_number() OVER (PARTITION BY lang ORDER BY b.score DESC, a DESC, array_to_string(p, ' ')) AS rank FROM kept
)
SELECT k.lang, k.rank, k.phrase, k.a, k.l, k.r, CAST(n.n AS BIGINT) AS n, k.score
FROM ranked k JOIN (SELECT lang, sum(len(w)) AS n FROM worded GROUP BY lang) n ON n.lang = k.lang WHERE k.rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    """SQL can't tokenize, train or hash as the other operators do; those are tested against brute force."""
    return {
        "op2_line_dedup": NEAR_LINES,
        "op3_exact_topk": EXACT_TOPK,
        "op4_substring_dedup": REPEATED_WINDOWS,
        "op10_warc": REVISITS,
        "op11_centroid_clusters": _rounds(),
        "op13_collocations": COLLOCATIONS,
    }
