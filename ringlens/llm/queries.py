"""The registered queries of this package, each with its SQL twin where SQL can say it."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringlens.llm.common import table
from ringlens.llm.decontam import find_hits, is_contaminated
from ringlens.llm.divergence import source_divergence
from ringlens.llm.exact import exact_groups
from ringlens.llm.lm import lm_scores
from ringlens.llm.minhash import minhash_groups
from ringlens.llm.mix import mix_sources, taken_words
from ringlens.llm.labelled import held_out
from ringlens.llm.quality import quality_scores
from ringlens.llm.search import search
from ringlens.llm.shard import shard_rows
from ringlens.llm.simhash import near_groups
from ringlens.llm.substring import remove_repeats
from ringlens.llm.tokens import read_vocabulary, token_counts
from ringlens.llm.toxicity import toxicity_scores

#: The vocabulary that op4 counts with.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"

SQL: dict[str, str] = {}


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


SQL["op1_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
r AS (
  SELECT *, row_number() OVER w AS rn, first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, text_sha256 FROM r
"""


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = taken_words(mix_sources(table(spark, sf_dir, "documents")))
    return taken.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken",
        F.coalesce("first_slot", F.lit(-1)).alias("first_slot"), "n_slots",
    )


SQL["op2_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, md5('2:' || coalesce(doc_id::VARCHAR, '')) AS o,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
n AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS sid,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::BIGINT AS weight
  FROM s),
f AS (
  SELECT *, row_number() OVER w AS rk,
         150 * sum(source_size) OVER () - 200 * (sum(source_size) OVER w - source_size) AS num,
         100 * (sum(weight) OVER () - sum(weight) OVER w + weight) AS den
  FROM n WINDOW w AS (ORDER BY source_size / weight, sid ROWS UNBOUNDED PRECEDING)),
l AS (
  SELECT rk, num, den FROM f
  WHERE num::DOUBLE * weight < den::DOUBLE * 2 * source_size ORDER BY rk LIMIT 1),
t AS (
  SELECT f.*, CASE WHEN l.rk IS NULL OR f.rk < l.rk THEN (2 * source_size)::DOUBLE
              ELSE (weight * l.num)::DOUBLE / l.den::DOUBLE END AS target
  FROM f LEFT JOIN l ON true),
u AS (SELECT *, floor(target + 0.5)::BIGINT AS quota FROM t),
g AS (
  SELECT greatest(sum(quota), 1)::BIGINT AS words,
         greatest(1, least(65536, sum(quota)) + sum(quota) // 1048576)::BIGINT AS slots FROM u),
i AS (
  SELECT sid, floor((upto - quota)::DOUBLE / words::DOUBLE * 4294967296.0)::BIGINT AS low,
         floor(upto::DOUBLE / words::DOUBLE * 4294967296.0)::BIGINT AS high
  FROM (SELECT sid, quota, sum(quota) OVER (ORDER BY sid ROWS UNBOUNDED PRECEDING) AS upto FROM u), g),
z AS (
  SELECT sid, slot, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS rank
  FROM (SELECT slot, (slot * 2654435769) % 4294967296 AS point FROM (SELECT unnest(range(slots)) AS slot FROM g))
  JOIN i ON low <= point AND point < high),
e AS (
  SELECT u.sid, source, source_size, target, words, slots, n,
         CASE WHEN n IS NULL THEN quota ELSE least((n::HUGEINT * words) // slots, 2 * source_size) END::BIGINT AS line_end
  FROM u LEFT JOIN (SELECT sid, count(*) AS n FROM z GROUP BY 1) USING (sid), g),
p AS (
  SELECT d.doc_id, d.size, e.*,
         (sum(d.size) OVER (PARTITION BY e.sid ORDER BY d.o, d.doc_id ROWS UNBOUNDED PRECEDING)
          - d.size)::BIGINT AS a
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source),
x AS (
  SELECT *, CASE WHEN n IS NULL THEN 0 ELSE ((first + 1)::HUGEINT * slots - 1) // words END AS r1,
         CASE WHEN n IS NULL THEN 0 ELSE (fin::HUGEINT * slots - 1) // words END AS r2
  FROM (SELECT *, a + epoch * source_size AS first, least(a + epoch * source_size + size, line_end) AS fin
        FROM p, (VALUES (0), (1)) v(epoch)))
SELECT doc_id, size, source_size, target, sum(greatest(fin - first, 0))::BIGINT AS taken,
       coalesce(min(CASE WHEN first < fin THEN coalesce(slot, x.sid + slots) END), -1)::BIGINT AS first_slot,
       sum(CASE WHEN first < fin THEN r2 - r1 + 1 ELSE 0 END)::BIGINT AS n_slots
FROM x LEFT JOIN z ON z.sid = x.sid AND z.rank = x.r1
GROUP BY doc_id, size, source_size, target, x.sid, a
"""


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lm_scores(table(spark, sf_dir, "documents"))
    per_word = F.col("log_prob") / F.greatest("n_words", F.lit(1))
    return scores.select(F.col("id").alias("doc_id"), "n_words", "log_prob", per_word.alias("mean_log_prob"))


def op4_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(table(spark, sf_dir, "documents"), read_vocabulary(VOCABULARY))
    return counts.withColumnRenamed("id", "doc_id")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    summed = found.combos.select(
        "combo", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
    )
    return found.documents.join(summed, "combo", "left").select(
        F.col("key.id").alias("doc_id"), "n_words", "n_hit",
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


SQL["op5_decontaminate"] = r"""
WITH low AS (
  SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS a, 'abcdefghijklmnopqrstuvwxyz' AS b,
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' AS word),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), a, b), word) AS w
  FROM documents, low),
i AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''), a, b), word) AS w
  FROM benchmark, low),
iw AS (
  SELECT DISTINCT item, least(len(w), 13) AS t, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT t FROM iw),
dw AS (
  SELECT doc_id, t, s, array_to_string(w[s:s + t - 1], ' ') AS win
  FROM (SELECT d.*, t, unnest(range(1, len(w) - t + 2)) AS s FROM d, lens WHERE len(w) >= t)),
hit AS (SELECT doc_id, dw.t, s, item FROM dw JOIN iw USING (win)),
n AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + t)) AS p FROM (SELECT DISTINCT doc_id, s, t FROM hit)) GROUP BY 1),
m AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM hit GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""


def _classified(scores: DataFrame, limit: float) -> DataFrame:
    return scores.select(
        F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score",
        (F.col("score") >= limit).cast("int").alias("predicted"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), 0.5)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), 0.3)


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


SQL["op9_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, s, array_to_string(w[s:s + 12], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - 11)) AS s FROM d WHERE len(w) >= 13)),
hit AS (
  SELECT doc_id, s FROM win JOIN (SELECT win, min(doc_id) AS low FROM win GROUP BY 1) USING (win)
  WHERE doc_id > low),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM hit),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def op10_shard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard_rows(table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


SQL["op11_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
x AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*)::HUGEINT AS n FROM x GROUP BY 1, 2 HAVING count(DISTINCT r) >= 10),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM x SEMI JOIN k USING (lang, term) GROUP BY 1, 2, 3),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM k GROUP BY 1),
g AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN c USING (lang, source) GROUP BY 1, 2),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * v.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 2)) // (v.total + 2 * v.v) AS q
  FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY 1, 2, 3),
u AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INT AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
WHERE part = 'pair' OR rank <= 10
"""


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = minhash_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL["op13_ranked_search"] = r"""
WITH low AS (
  SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS a, 'abcdefghijklmnopqrstuvwxyz' AS b,
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+' AS term),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), a, b), term) AS w FROM documents, low),
s AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
q AS (
  SELECT item_id, term, count(*) AS often
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), a, b), term)) AS term
        FROM benchmark, low) GROUP BY 1, 2),
x AS (
  SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) SEMI JOIN q USING (term) GROUP BY 1, 2, 3),
f AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
      FROM x, s GROUP BY term, n_docs),
g AS (
  SELECT item_id, doc_id,
         sum(often * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM x JOIN f USING (term) JOIN q USING (term), s GROUP BY 1, 2)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM g WHERE score > 0)
WHERE rank <= 20
"""


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_mix_sources,
        op3_lm_score,
        op4_token_count,
        op5_decontaminate,
        op6_toxicity,
        op7_quality,
        op8_simhash_near_dedup,
        op9_substring_dedup,
        op10_shard_rows,
        op11_source_divergence,
        op12_minhash_near_dedup,
        op13_ranked_search,
    )
}


def queries():
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: sql.strip() for name, sql in SQL.items()}
