"""One query per operator of this package, over whole tables, and SQL twins where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    edits, epsgrid, fim, jaccard, langid, ledger, mixing, mtree, packing, quality, shallot,
    toxicity, warc,
)
from ledgerloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"))


@query
def op10_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sizes(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


ORACLES["op10_systematic_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sources
), filled AS (
  SELECT *, 2.0::DOUBLE * source_size / weight AS fill FROM weighed
), levels AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size)::BIGINT FROM sources)
             - 2.0::DOUBLE * coalesce(sum(source_size) OVER before, 0)::BIGINT)
            / ((SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER before, 0))::BIGINT AS level
  FROM filled
  WINDOW before AS (ORDER BY fill, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size,
         CASE WHEN fill <= (SELECT coalesce(max(level) FILTER (WHERE level <= fill), 'infinity'::DOUBLE) FROM levels)
              THEN 2.0::DOUBLE * source_size
              ELSE weight * (SELECT max(level) FILTER (WHERE level <= fill) FROM levels) END AS target,
         ('0x' || substr(md5(source), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS start
  FROM levels
), ranked AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS expected,
         row_number() OVER (PARTITION BY source ORDER BY size, doc_id) AS row_rank
  FROM sized JOIN targets USING (source)
), copied AS (
  SELECT *, least(floor(row_rank * expected + start)::BIGINT
                  - floor((row_rank - 1) * expected + start)::BIGINT, 2)::BIGINT AS copies
  FROM ranked
)
SELECT doc_id, source, size, source_size, target, copies, copies * size AS taken FROM copied
"""


@query
def op2_kneser_ney_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    found = langid.predict(docs.select("doc_id", "text"), langid.fit_languages(docs))
    return found.select("doc_id", "held_out", "lang_pred", "score", "accepted")


@query
def op3_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.quality_model(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model)


@query
def op4_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(spark, table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLES["op4_arc_to_warc"] = """
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS hex
  FROM pages
), coded AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), '')
    AS payload_digest
  FROM hashed
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS response FROM coded
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to
FROM firsts
"""


@query
def op5_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLES["op5_mtree_top_k"] = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
WHERE rank <= 10
"""


@query
def op6_grid_order_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epsgrid.near_vectors(table(spark, sf_dir, "embeddings"))


ORACLES["op6_grid_order_dedup"] = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), reached(a, b) AS (
  SELECT vec_id, vec_id FROM vectors UNION
  SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
)
SELECT a AS vec_id, (SELECT count(*) FROM links WHERE links.a = reached.a)::BIGINT AS n_links,
       min(b) AS component_id, a = min(b) AS kept
FROM reached GROUP BY a
"""


@query
def op7_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A revision of every document, counted from its tree."""
    docs = table(spark, sf_dir, "documents").withColumn("edits", edits.revision(F.col("text")))
    counted = edits.edited(edits.with_trees(docs))
    return counted.select(
        "doc_id", "tokens_before", "tokens_after", "n_edits", "chars_after", "chars_encoded"
    )


@query
def op8_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model)


@query
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op9_ngram_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3
    THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared >= 90 * (p.n + q.n - shared)
), reached(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION
  SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a) LEFT JOIN sizes USING (doc_id)
"""


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    turned = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    return turned.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLES["op11_fill_in_middle"] = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), numbers AS (
  SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS one, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS two,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), cut AS (
  SELECT *, substring(t, 1, least(one, two)) AS prefix, substring(t, greatest(one, two) + 1) AS suffix,
         substring(t, least(one, two) + 1, greatest(one, two) - least(one, two)) AS middle
  FROM numbers
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(one, two) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN greatest(one, two) - least(one, two) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
"""


@query
def op12_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = ledger.with_verdict(ledger.rule_ledger(table(spark, sf_dir, "documents")))
    base = F.lit(ledger.BASE.mask()).cast("long")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("failed").bitwiseAND(base) != 0).alias("base_failed"), "kept", "failed", "policy",
    )


ORACLES["op12_rule_ledger"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS nr, doc_id, coalesce(text, '') AS t FROM documents
), split AS MATERIALIZED (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM docs
), windows AS (
  SELECT nr, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT nr, w, unnest(range(1, len(w) - 3)) AS i FROM split)
), starts AS (
  SELECT nr, i FROM (SELECT *, count(*) OVER (PARTITION BY nr, g) AS times FROM windows) WHERE times > 1
), repeats AS (
  SELECT nr, sum(least(5, coalesce(upto - i, 5)))::BIGINT AS n
  FROM (SELECT nr, i, lead(i) OVER (PARTITION BY nr ORDER BY i) AS upto FROM starts) GROUP BY nr
), measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(lines)::BIGINT AS n_lines, len(regexp_extract_all(t, '\p{L}'))::BIGINT AS n_letters,
         len(regexp_extract_all(t, '\p{Lu}'))::BIGINT AS n_upper,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{L}')))::BIGINT AS n_letter_words,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1]))::BIGINT AS n_stutter
  FROM split LEFT JOIN repeats USING (nr)
), judged AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN 100 * n_upper > 60 * n_letters AND n_letters > 0 THEN 16 ELSE 0 END
    + CASE WHEN 100 * n_letter_words < 70 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 100 * n_stutter > 15 * n_words THEN 64 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 128 ELSE 0 END)::BIGINT AS failed
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed,
       failed = 0 AS kept, failed, 'prose-2' AS policy
FROM judged
"""


@query
def op13_shallot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shallot.cluster_vectors(table(spark, sf_dir, "embeddings"))


def _rounds_in_sql(rounds: int) -> str:
    """The CTEs of each round: vectors by nearest centroid, then the centroids' new components."""
    parts = []
    for t in range(rounds + 1):
        parts.append(
            f"""a{t} AS MATERIALIZED (
  SELECT nr, cluster, distance FROM (
    SELECT *, row_number() OVER (PARTITION BY nr ORDER BY distance, cluster) AS place FROM (
      SELECT nr, cluster,
             list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance
      FROM kept x CROSS JOIN c{t} c)) WHERE place = 1
)"""
        )
        if t < rounds:
            parts.append(
                f"""m{t} AS MATERIALIZED (
  SELECT cluster, i, sum(x)::BIGINT AS s, count(*) AS n
  FROM (SELECT cluster, unnest(v) AS x, unnest(range(64)) AS i FROM kept JOIN a{t} USING (nr)) GROUP BY ALL
), c{t + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(moved, v) AS v FROM c{t} LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS moved FROM m{t} GROUP BY cluster) USING (cluster)
)"""
            )
    return ", ".join(parts)


ORACLES["op13_shallot_clusters"] = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS nr, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), v) - 1)::INT AS cluster, v
  FROM kept QUALIFY cluster < 40
), {_rounds_in_sql(shallot.ROUNDS)}
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM kept JOIN a{shallot.ROUNDS} USING (nr) JOIN c{shallot.ROUNDS} c USING (cluster)
"""
