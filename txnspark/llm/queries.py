"""The operators over their whole tables, and the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from txnspark.llm import (
    bpe,
    cotraining,
    decontamination,
    exact_dedup,
    line_templates,
    link_rank,
    periodic_runs,
    prefix_free_parsing,
    secret_scan,
    simhash,
    token_counts,
    vector_codes,
    warc,
)
from txnspark.llm.tables import table, tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_link_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page; see ``link_rank`` for nulls and other awkward rows."""
    return link_rank.judged_pages(table(spark, sf_dir, "pages"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record written to archives and read back; see ``warc`` for awkward rows."""
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op3_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality and toxicity of every document; see ``cotraining`` for awkward rows."""
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    return cotraining.scored(docs, labels)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; see ``simhash`` for awkward rows."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text; see ``secret_scan`` for awkward rows."""
    return secret_scan.scanned(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text and what they decode to; see ``bpe`` for awkward rows."""
    trips = bpe.round_trips(table(spark, sf_dir, "documents"), tokenizer_path())
    return trips.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


def op7_prefix_free_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without its repeated strings of 400 bytes; see ``prefix_free_parsing`` for awkward rows."""
    found = prefix_free_parsing.without_repeats(table(spark, sf_dir, "documents")).drop("kept")
    return found.withColumn("has_repeats", F.col("n_removed") > 0)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts of every document; see ``exact_dedup`` for awkward rows."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages; see ``decontamination`` for awkward rows."""
    docs, benchmark = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontamination.contaminated(docs, benchmark)


def op10_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, dropped lines and what is left of every text; see ``line_templates`` for awkward rows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = line_templates.without_templates(docs)
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every text; see ``token_counts`` for nulls and other awkward rows."""
    return token_counts.counted(table(spark, sf_dir, "documents"), tokenizer_path())


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of all vectors, the errors of their labels, and a digest of the codebooks."""
    codes, books = vector_codes.compressed(table(spark, sf_dir, "embeddings"))
    rows = vector_codes.with_label_errors(codes).drop("label")
    return rows.withColumn("codebooks_sha256", F.lit(vector_codes.digest(books)))


def looped_words(doc_id: int | None, text: str) -> list[bytes]:
    """Words of a text; in one of ten, by its id, the last part repeats a passage to the end."""
    words = periodic_runs.plain_words(doc_id, text)
    h = 1 if doc_id is None else crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest run of each document, and digests of all its runs and of what is left without them."""
    found = periodic_runs.judged(table(spark, sf_dir, "documents"), looped_words)
    # the longest, then the first, then the shortest period
    order = F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    found = found.withColumn("best", F.array_min(order))
    length, period = -F.col("best.l"), F.col("best.p")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.s").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("(-best.l * 1000) div best.p").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


OP2_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), q AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to,
  TRUE AS intact
FROM q
"""

OP8_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id,
  min(doc_id) OVER (PARTITION BY t) AS keep_id,
  count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY t) AS kept,
  sha256(t) AS text_sha256
FROM n
"""

OP10_SQL = r"""
WITH masked AS (
  SELECT doc_id, text, regexp_replace(trim(regexp_replace(regexp_replace(
    text, '[\x20\x09\x0B-\x0D]+', ' ', 'g'), ' ?\n ?', chr(10), 'g')), '[^ \n]*[0-9][^ \n]*', '<*>', 'g') AS forms
  FROM documents
), lines AS (
  SELECT DISTINCT doc_id, unnest(string_split(forms, chr(10))) AS form
  FROM masked WHERE doc_id IS NOT NULL AND text IS NOT NULL
), tokens AS (
  SELECT doc_id, form, string_split(form, ' ') AS t FROM lines WHERE form <> ''
), leaves AS (
  SELECT doc_id, form, t, len(t) || ' ' || array_to_string(t[1:3], ' ') AS leaf FROM tokens
), busy AS (
  SELECT leaf, count(*) AS lines FROM leaves GROUP BY leaf
  HAVING count(*) >= CASE WHEN CAST(split_part(leaf, ' ', 1) AS INT) >= 20 THEN 2 ELSE 6 END
), forms AS (
  SELECT leaf, form, any_value(t) AS t FROM leaves JOIN busy USING (leaf) WHERE lines >= 6 GROUP BY leaf, form
), places AS (
  SELECT leaf, form, t, unnest(range(4, len(t) + 1)) AS pos FROM forms
), weighed AS (
  SELECT leaf, form, pos, t[pos] AS token, count(*) OVER (PARTITION BY leaf, pos, t[pos]) AS weight FROM places
), supported AS (
  SELECT *, list(weight) OVER (PARTITION BY leaf, form) AS weights FROM weighed
), marked AS (
  SELECT *, list_reverse_sort(weights)[(3 * len(weights) + 4) // 5] AS support FROM supported
), keyed AS (
  SELECT form, 'leaf ' || leaf || string_agg(concat(' ', pos, ' ', token), '' ORDER BY pos) AS template
  FROM marked WHERE support > 1 AND 2 * weight >= support GROUP BY leaf, form
), placed AS (
  SELECT l.doc_id, l.form, len(l.t) >= 20 AS long, coalesce(k.template, 'form ' || l.form) AS template
  FROM leaves l SEMI JOIN busy USING (leaf) LEFT JOIN keyed k USING (form)
), common AS (
  SELECT template, min(doc_id) AS first FROM placed GROUP BY template HAVING count(DISTINCT doc_id) >= 6
), common_long AS (
  SELECT form, min(doc_id) AS first FROM placed WHERE long GROUP BY form HAVING count(DISTINCT doc_id) >= 2
), lost AS (
  SELECT doc_id, form FROM placed JOIN common USING (template) WHERE doc_id <> first
  UNION SELECT doc_id, form FROM placed JOIN common_long USING (form) WHERE doc_id <> first
), gone AS (
  SELECT doc_id, list(form) AS gone FROM lost GROUP BY doc_id
), kept AS (
  SELECT m.doc_id, m.text, string_split(m.text, chr(10)) AS lines, string_split(m.forms, chr(10)) AS forms, g.gone
  FROM masked m LEFT JOIN gone g ON g.doc_id = m.doc_id
), shortened AS (
  SELECT *, CASE WHEN gone IS NULL THEN lines ELSE list_filter(lines, lambda x, i: NOT list_contains(gone, forms[i])) END AS rest
  FROM kept
)
SELECT doc_id, coalesce(len(lines), 0) AS n_lines, coalesce(len(lines) - len(rest), 0) AS n_dropped,
  sha256(array_to_string(rest, chr(10))) AS kept_sha256
FROM shortened
"""


def _op12_sql() -> str:
    """Every distance of every round, without any search."""
    parts = f"""rows AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 4096) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cells AS MATERIALIZED (
  SELECT vec_id, (i - 1) // (n // 8) AS part, (i - 1) % (n // 8) AS pos, x[i] AS v
  FROM (SELECT vec_id, x, len(x) AS n, unnest(range(1, len(x) + 1)) AS i FROM rows)
), book0 AS MATERIALIZED (
  SELECT part, entry, pos, v FROM cells
  JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM rows ORDER BY vec_id LIMIT 16) USING (vec_id)
)"""
    for k in range(vector_codes.ROUNDS + 1):
        parts += f""", taken{k} AS MATERIALIZED (
  SELECT vec_id, part, min(d) AS d, arg_min(entry, (d, entry)) AS entry
  FROM (
    SELECT c.vec_id, c.part, b.entry, CAST(sum((c.v - b.v) * (c.v - b.v)) AS BIGINT) AS d
    FROM cells c JOIN book{k} b ON b.part = c.part AND b.pos = c.pos GROUP BY c.vec_id, c.part, b.entry
  ) GROUP BY vec_id, part
)"""
        if k < vector_codes.ROUNDS:
            parts += f""", mean{k} AS (
  SELECT c.part, t.entry, c.pos, sum(c.v) AS s, count(*) AS n
  FROM cells c JOIN taken{k} t ON t.vec_id = c.vec_id AND t.part = c.part GROUP BY c.part, t.entry, c.pos
), book{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos, CAST(coalesce((m.s - ((m.s % m.n + m.n) % m.n)) // m.n, b.v) AS BIGINT) AS v
  FROM book{k} b LEFT JOIN mean{k} m ON m.part = b.part AND m.entry = b.entry AND m.pos = b.pos
)"""
    last = vector_codes.ROUNDS
    return f"""WITH {parts}, coded AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM taken{last} GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM book{last}) AS codebooks_sha256
FROM coded JOIN rows USING (vec_id)
"""


OP12_SQL = _op12_sql()


def llm_queries() -> dict[str, Query]:
    return {
        "op1_link_rank": op1_link_rank,
        "op2_warc": op2_warc,
        "op3_cotraining": op3_cotraining,
        "op4_simhash": op4_simhash,
        "op5_secret_scan": op5_secret_scan,
        "op6_bpe": op6_bpe,
        "op7_prefix_free_parsing": op7_prefix_free_parsing,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_decontamination": op9_decontamination,
        "op10_line_templates": op10_line_templates,
        "op11_token_counts": op11_token_counts,
        "op12_vector_codes": op12_vector_codes,
        "op13_periodic_runs": op13_periodic_runs,
        "pipeline": corpus_pipeline.run,
    }


def llm_sql() -> dict[str, str]:
    return {"op2_warc": OP2_SQL, "op8_exact_dedup": OP8_SQL, "op10_line_templates": OP10_SQL, "op12_vector_codes": OP12_SQL}
