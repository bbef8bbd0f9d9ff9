"""Registered queries of the training-data operators: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanline.llm import common as c

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


@query("op1_minhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fanline.llm.minhash_dedup import Similarity, near_duplicates

    return near_duplicates(c.read_table(spark, sf_dir, "documents"), Similarity(width=3, percent=85))


@query("op9_cost_balanced_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fanline.llm.packing import pack

    return pack(c.read_table(spark, sf_dir, "documents"), with_tokens=False)


@query("op7_wavelet_token_shards")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fanline.llm.wavelet import read_documents, write_shards

    path = c.shared_path(spark, "shards")
    write_shards(c.read_table(spark, sf_dir, "documents"), path)
    return read_documents(spark, path, with_tokens=False)


@query("op2_compression_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fanline.llm.labelled import fold_is
    from fanline.llm.toxicity import score_documents, train

    docs, held = c.read_table(spark, sf_dir, "documents"), fold_is("doc_id", 5, 0)
    model = train(docs, c.read_table(spark, sf_dir, "labels"), ~held)
    return score_documents(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


@query("op8_ftrl_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fanline.llm.labelled import fold_is
    from fanline.llm.quality import score_documents, train

    docs, held = c.read_table(spark, sf_dir, "documents"), fold_is("doc_id", 3, 1)
    model = train(docs, c.read_table(spark, sf_dir, "labels"), ~held)
    return score_documents(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


@query("op3_balanced_posting_lists")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fanline.llm.posting_lists import nearest_neighbours

    return nearest_neighbours(c.read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


@query("op6_threshold_top_k")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fanline.llm.threshold_topk import exact_top_k

    return exact_top_k(c.read_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


#: the list that op5 joins with, made from the hosts and segments of the pages:
#: a log of dated entries, with patterns that come, go and come again
_ENTRIES_SQL = """
  SELECT host AS pattern, (m * 37) % 600 AS d, 'add' AS action FROM hosts WHERE m % 3 <> 0
  UNION ALL SELECT host, (m * 37) % 600 + 60 + m % 50, 'remove' FROM hosts WHERE m % 3 <> 0 AND m % 2 = 0
  UNION ALL SELECT host, (m * 37) % 600 + 200, 'add' FROM hosts WHERE m % 3 <> 0 AND m % 4 = 0
  UNION ALL SELECT parent, (m * 53) % 700, 'add' FROM parents WHERE m % 5 = 0
  UNION ALL SELECT parent, (m * 53) % 700 + 30, 'remove' FROM parents WHERE m % 5 = 0
  UNION ALL SELECT pattern, (m * 11) % 700, 'add' FROM segments WHERE m % 7 = 0
"""

_OP5_SQL = r"""
WITH captures AS (
  SELECT page_id, DATE '2023-01-01' + CAST(page_id % 730 AS INTEGER) AS day,
    coalesce(lower(regexp_replace(regexp_replace(regexp_replace(
      regexp_extract(trim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', ''), '[.]+$', '')), '') AS host,
    coalesce(regexp_extract(trim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*/([^/?#]+)', 1), '') AS segment
  FROM pages
), hosts AS (SELECT host, min(page_id) AS m FROM captures WHERE host <> '' GROUP BY host),
parents AS (
  SELECT substr(host, strpos(host, '.') + 1) AS parent, min(m) AS m FROM hosts WHERE strpos(host, '.') > 0 GROUP BY 1
), segments AS (
  SELECT host || '/' || segment AS pattern, min(page_id) AS m FROM captures WHERE host <> '' AND segment <> '' GROUP BY 1
), entries AS (SELECT pattern, DATE '2023-01-01' + CAST(d AS INTEGER) AS day, action FROM (ENTRIES)),
daily AS (SELECT pattern, day, max(CASE WHEN action = 'add' THEN 1 ELSE 0 END) AS listed FROM entries GROUP BY 1, 2),
spans AS (SELECT pattern, day AS start, lead(day) OVER (PARTITION BY pattern ORDER BY day) AS stop, listed FROM daily),
reach AS (
  SELECT page_id, host, day, segment, unnest(list_transform(generate_series(1, len(string_split(host, '.'))),
    lambda i: array_to_string(string_split(host, '.')[i:], '.'))) AS domain
  FROM captures WHERE host <> '' AND len(string_split(host, '.')) <= 127
), cover AS (
  SELECT page_id, day, domain AS pattern FROM reach
  UNION SELECT page_id, day, domain || '/' || segment FROM reach WHERE segment <> ''
), met AS (
  SELECT page_id, s.pattern, start, row_number() OVER (PARTITION BY page_id ORDER BY length(s.pattern) DESC, s.pattern) AS rn
  FROM cover JOIN spans s ON s.pattern = cover.pattern AND s.listed = 1 AND start <= day AND (stop IS NULL OR day < stop)
)
SELECT c.page_id, host, day, m.pattern IS NOT NULL AS listed, m.pattern, m.start AS since
FROM captures c LEFT JOIN met m ON m.page_id = c.page_id AND m.rn = 1
""".replace("ENTRIES", _ENTRIES_SQL)


@query("op5_temporal_url_lists", _OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures are the pages, fetched on a day derived from page_id (the table
    holds none); the list is derived from their hosts and segments."""
    from fanline.llm.url_lists import filter_captures, url_host, url_segment

    pages = c.read_table(spark, sf_dir, "pages")
    start = F.lit("2023-01-01").cast("date")
    captures = pages.select("page_id", "url", F.date_add(start, (F.col("page_id") % 730).cast("int")).alias("day"))
    parts = captures.select("page_id", url_host(F.col("url")).alias("host"), url_segment(F.col("url")).alias("segment"))
    named = parts.where("host <> ''").groupBy("host", "segment").agg(F.min("page_id").alias("m"))
    named = c.materialise(named, "hosts")
    least = F.min("m").alias("m")
    hosts = named.groupBy("host").agg(least)
    parents = hosts.where("instr(host, '.') > 0").groupBy(F.expr("substring(host, instr(host, '.') + 1)").alias("parent")).agg(least)
    segments = named.where("segment <> ''").groupBy(F.concat("host", F.lit("/"), "segment").alias("pattern")).agg(least)
    log = spark.sql(_ENTRIES_SQL.replace("FROM hosts", "FROM {hosts}").replace("FROM parents", "FROM {parents}").replace("FROM segments", "FROM {segments}"), hosts=hosts, parents=parents, segments=segments)
    entries = log.select("pattern", F.date_add(start, F.col("d").cast("int")).alias("day"), "action")
    return filter_captures(captures, entries)


@query("op10_lattice_sampling")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fanline.llm.piece_sampling import sample_pieces

    return sample_pieces(c.read_table(spark, sf_dir, "documents"), with_tokens=False)


@query("op4_paragraph_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fanline.llm.paragraph_dedup import remove_repeats

    cut = remove_repeats(c.read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id",
        "n_removed",
        F.size(F.split("text", "\n")).alias("n_lines"),
        F.length("text").alias("n_chars"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )



def _op11_sql() -> str:
    from fanline.llm.license_scan import PHRASES, TEMPLATES, Templates

    t = Templates.of(TEMPLATES, 80)
    rows = ", ".join(
        f"({k}, '{label}', [{', '.join(repr(t.words[w].decode()) for w in s)}])" for k, (label, s) in enumerate(zip(t.labels, t.sets))
    )
    phrases = ", ".join(f"('{label}', [{', '.join(repr(w) for w in p.split())}])" for p, label in PHRASES)
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), phrases(label, p) AS (VALUES {phrases}),
places AS (
  SELECT r, label, k FROM (
    SELECT r, label, p, w, unnest(range(len(w))) AS k FROM d, phrases WHERE list_has_all(w, p)
  ) WHERE w[k + 1:k + len(p)] = p
), base AS (
  SELECT r, count(*) AS n, min(k) AS a, max(k) AS z, list_sort(list(DISTINCT label)) AS labels FROM places GROUP BY r
), templates(t, label, s) AS (VALUES {rows}),
blocks AS (
  SELECT r, list_distinct(w[k * {t.half} + 1:(k + 2) * {t.half}]) AS b
  FROM (SELECT r, w, unnest(range(greatest(1, CAST(ceil(len(w) / {t.half}.0) AS BIGINT) - 1))) AS k FROM d)
), met AS (
  SELECT r, label, len(list_intersect(b, s)) / len(s) AS share FROM blocks, templates WHERE 100 * len(list_intersect(b, s)) >= 80 * len(s)
), more AS (SELECT r, list(DISTINCT label) AS labels, max(share) AS share FROM met GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, a AS first_word, z AS last_word,
  coalesce(array_to_string(base.labels, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(base.labels, more.labels))), ','), '') AS labels,
  CASE WHEN n > 0 THEN 1.0 ELSE coalesce(share, 0.0) END :: DOUBLE AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN more USING (r)
"""


@query("op11_license_set_join", _op11_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fanline.llm.license_scan import license_scan

    return license_scan(c.read_table(spark, sf_dir, "documents"))


_OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS repeated
  FROM documents
), known AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), failing AS (
  SELECT part, concat(
      CASE WHEN len(w) < 200 THEN 'A' ELSE '' END,
      CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END,
      CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text) THEN 'C' ELSE '' END,
      CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END,
      CASE WHEN repeated THEN 'E' ELSE '' END) AS f,
    coalesce(good, 0) AS good, coalesce(bad, 0) AS bad
  FROM d LEFT JOIN known USING (doc_id)
), m AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM failing GROUP BY part, f),
x(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.l || b.l || g.l || h.l || i.l AS o FROM x a, x b, x g, x h, x i
  WHERE len(list_distinct([a.l, b.l, g.l, h.l, i.l])) = 5
), steps AS (
  SELECT o, k AS step, substr(o, k, 1) AS l, string_split(substr(o, 1, k - 1), '') AS earlier FROM orders, range(1, 6) t(k)
), met AS (
  SELECT part, o, step, l, n, good, bad, contains(f, l) AS fails, k > 1 AND list_has_any(string_split(f, ''), earlier) AS gone, f = l AS alone
  FROM m, (SELECT *, step AS k FROM steps)
), rows AS (
  SELECT part, o AS filter_order, step, l,
    sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN alone THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN fails AND NOT gone THEN bad ELSE 0 END) AS toxic_lost
  FROM met GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, l) AS BIGINT) AS shapley
FROM rows
"""


@query("op12_filter_audit", _OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fanline.llm.filter_audit import filter_audit

    return filter_audit(c.read_table(spark, sf_dir, "documents"), c.read_table(spark, sf_dir, "labels"))


_OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
), held AS (SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(t) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS lang_n FROM held GROUP BY ALL HAVING count(*) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
cells AS (SELECT lang, source, term, sum(n) AS n FROM held GROUP BY ALL),
wide AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, lang_n,
    sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
  FROM groups g JOIN kept k USING (lang) LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS (
  SELECT wide.lang, source, term, n,
    1 + (1000000000::HUGEINT * (n::HUGEINT + 5)) // (total::HUGEINT + 5 * v) AS p,
    1 + (1000000000::HUGEINT * (lang_n::HUGEINT + 5)) // (lang_total::HUGEINT + 5 * v) AS q
  FROM wide JOIN langs USING (lang)
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), over AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM over)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


@query("op13_source_divergence", _OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fanline.llm.source_divergence import divergence_audit

    return divergence_audit(c.read_table(spark, sf_dir, "documents"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
