"""One query per operator of this package over its whole table, with SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, chat, decontaminate, language, lattice, mixing, secrets, sharding, simhash, urls, variants, whitening, wordpiece
from .batches import ready

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        QUERIES[name] = lambda spark, folder: query(ready(spark), folder)
        if sql is not None:
            ORACLES[name] = sql
        return query

    return keep


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- 8: chat formatting

CHAT_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, CASE WHEN coalesce(role, '') = '' THEN 'unknown' ELSE role END AS speaker,
         coalesce(text, '') AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS position
  FROM conversations),
v AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
m AS (
  SELECT t.conv_id, v.perspective, (position - 1) // 256 AS part, position, speaker = perspective AS own,
         CASE WHEN speaker = perspective THEN '<|im_start|>assistant'
              WHEN speaker = 'system' THEN '<|im_start|>system'
              ELSE '<|im_start|>user name=' || speaker END || chr(10) AS head,
         said || '<|im_end|>' AS body
  FROM t JOIN v ON t.conv_id IS NOT DISTINCT FROM v.conv_id),
s AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
              PARTITION BY conv_id, perspective, part ORDER BY position
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS start
  FROM m)
SELECT conv_id, perspective, CAST(part AS BIGINT) AS part, count(*) AS n_turns,
       string_agg(head || body || chr(10), '' ORDER BY position) AS rendered,
       coalesce(string_agg(CAST(CAST(start AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(start + length(body) AS BIGINT) AS VARCHAR), ','
                  ORDER BY position) FILTER (WHERE own), '') AS spans,
       CAST(coalesce(sum(length(body)) FILTER (WHERE own), 0) AS BIGINT) AS trained_chars
FROM s GROUP BY conv_id, perspective, part"""


@register("op8_chat", CHAT_SQL)
def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation from the point of view of each of its participants."""
    return chat.rotate(load(spark, folder, "conversations"))


# --- 9: URL filters.  The tables have no lists and no fetch times; both are derived from ``pages``:
# a host or address takes part in a list by digits of its MD5, which also give the days.

LISTS_SQL = """
SELECT * FROM (
  SELECT 'spam' AS list, 'block' AS effect, 'host' AS kind, pattern, 'add' AS action, {day1} AS dated FROM ({hosts}) h WHERE n % 4 = 0
  UNION ALL SELECT 'spam', 'block', 'host', pattern, 'remove', {day2} FROM ({hosts}) h WHERE n % 8 = 0
  UNION ALL SELECT 'spam', 'block', 'host', pattern, 'add', {day3} FROM ({hosts}) h WHERE n % 16 = 0
  UNION ALL SELECT 'adult', 'block', 'host', pattern, 'add', {day1} FROM ({domains}) d WHERE n % 7 = 0
  UNION ALL SELECT 'trusted', 'allow', 'host', pattern, 'add', {day2} FROM ({hosts}) h WHERE n % 12 = 0
  UNION ALL SELECT 'notices', 'block', 'url', pattern, 'add', {day1} FROM ({addresses}) a WHERE n % 10 = 0
  UNION ALL SELECT 'notices', 'block', 'url', pattern, 'remove', {day2} FROM ({addresses}) a WHERE n % 30 = 0) e"""

HOST = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))"
PATH = r"regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '')"


def _lists_sql(number: str, day: str) -> str:
    """The list entries in either dialect: ``number`` turns four hex digits into an integer."""
    distinct = "SELECT pattern, " + number.format("md5(pattern)") + " AS n FROM (SELECT DISTINCT {} AS pattern FROM pages) p WHERE pattern <> ''"
    return LISTS_SQL.format(
        hosts=distinct.format(HOST),
        domains=distinct.format(f"regexp_replace({HOST}, '^[^.]*[.]([^.]*[.][^.]*[.][^.]*)$', '\\1')".replace("'\\1'", "'{group}'")),
        addresses=distinct.format(f"{HOST} || {PATH}"),
        day1=day.format("n % 150"),
        day2=day.format("150 + n % 100"),
        day3=day.format("260 + n % 90"),
    )


URLS_SQL = (
    "WITH lists AS ("
    + _lists_sql("CAST(('0x' || substr({}, 1, 4)) AS BIGINT)", "DATE '2024-01-01' + CAST({} AS INTEGER)").replace("{group}", r"\1")
    + f"""),
daily AS (SELECT list, effect, kind, pattern, CAST(dated AS DATE) AS dated, max(action) AS action FROM lists GROUP BY ALL),
intervals AS (
  SELECT * FROM (SELECT *, lead(dated) OVER (PARTITION BY list, effect, kind, pattern ORDER BY dated) AS valid_to FROM daily)
  WHERE action = 'add'),
captures AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST((page_id * 37) % 366 AS INTEGER) AS fetched_on,
         {HOST} AS host, {HOST} || {PATH} AS address FROM pages),
hits AS (
  SELECT c.page_id, c.url, i.list, i.effect FROM captures c JOIN intervals i
    ON ((i.kind = 'host' AND (c.host = i.pattern OR ends_with(c.host, '.' || i.pattern)))
        OR (i.kind = 'url' AND c.address = i.pattern))
       AND i.dated <= c.fetched_on AND (i.valid_to IS NULL OR c.fetched_on < i.valid_to)),
summed AS (
  SELECT page_id, url, count(*) FILTER (WHERE effect = 'block') AS blocks, count(*) FILTER (WHERE effect = 'allow') AS allows,
         string_agg(DISTINCT list, ',' ORDER BY list) FILTER (WHERE effect = 'block') AS lists
  FROM hits GROUP BY page_id, url)
SELECT c.page_id, c.url, c.fetched_on, nullif(c.host, '') AS host, coalesce(blocks, 0) AS blocks, coalesce(allows, 0) AS allows,
       coalesce(lists, '') AS lists, coalesce(blocks, 0) > 0 AND coalesce(allows, 0) = 0 AS blocked
FROM captures c LEFT JOIN summed s ON c.page_id = s.page_id AND c.url = s.url"""
)


@register("op9_url_filter", URLS_SQL)
def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Every page of the crawl against the lists as they stood on its day of fetching."""
    pages = load(spark, folder, "pages")
    day = "date_add(DATE '2024-01-01', CAST({} AS INT))"
    sql = _lists_sql("CAST(conv(substr({}, 1, 4), 16, 10) AS BIGINT)", day).replace("{group}", "$1")
    entries = spark.sql(sql.replace("FROM pages", "FROM {pages}"), pages=pages)
    captures = pages.select(
        "page_id", "url", F.expr(day.format("pmod(page_id * 37, 366)")).alias("fetched_on")
    )
    return urls.filter_urls(captures, entries)


# --- 10: sharding


@register("op10_shards")
def op10_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in random order over 24 shards of equal row counts."""
    return sharding.shard_documents(load(spark, folder, "documents"))


# --- 1, 2, 3: operators that read each text by itself


@register("op1_bpe")
def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    outputs = ("n_tokens", "ids_sha256", "decoded_sha256")
    return bpe.encode(load(spark, folder, "documents"), TOKENIZER, outputs, keep=("doc_id",))


@register("op2_secrets")
def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document."""
    docs = load(spark, folder, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs).drop("text")
    kinds = [rule.kind for rule in secrets.BASE]
    return found.select(
        "doc_id",
        *[F.expr(f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS BIGINT) AS n_{k}") for k in kinds],
        F.sha2(secrets.span_text("spans", kinds).cast("binary"), 256).alias("base_sha256"),
        secrets.span_text("spans").alias("spans"),
    )


@register("op3_language")
def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learnt from the rows that are not held out."""
    docs = load(spark, folder, "documents").select("doc_id", "text", "lang")
    return language.identify(docs).select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


# --- 4, 7: near duplicates and benchmark passages


@register("op4_simhash")
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(load(spark, folder, "documents"))


@register("op7_decontaminate")
def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every document and benchmark item that has a passage in it."""
    return decontaminate.leaks(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


# --- 5, 6: embeddings and token counts


@register("op5_embeddings")
def op5_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Links and component of every vector."""
    return lattice.near_vectors(load(spark, folder, "embeddings"))


@register("op6_token_counts")
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Word-piece lengths of every document."""
    docs = load(spark, folder, "documents").select("doc_id", "text")
    return wordpiece.count_tokens(docs, *wordpiece.vocabulary(TOKENIZER)).drop("text")


# --- 11: spelling variants


@register("op11_variants")
def op11_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of the documents with its form and root."""
    return variants.spelling_variants(load(spark, folder, "documents"))


# --- 12: mixing sources

MIX_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_, doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key
  FROM documents),
s AS (
  SELECT *, 3 * source_size AS most, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source)),
o AS (
  SELECT *, row_number() OVER w AS k, sum(source_size) OVER () - (sum(most) OVER w - most) AS rest,
         sum(weight) OVER () - (sum(weight) OVER w - weight) AS weights
  FROM s WINDOW w AS (ORDER BY most / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
v AS (SELECT arg_min(rest, k) AS rest, arg_min(weights, k) AS weights FROM o WHERE rest * weight <= most * weights),
t AS (SELECT source, source_size, least(CAST(v.rest * weight AS DOUBLE) / v.weights, CAST(most AS DOUBLE)) AS target FROM s, v),
q AS (
  SELECT d.*, t.source_size, t.target, sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS end_
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT row_, size, source, pass, key, CAST((pass - 1) * source_size + end_ AS DOUBLE) / target AS finish
  FROM (SELECT *, unnest(range(1, CAST(least(3, floor(target / greatest(source_size, 1)) + 1) AS BIGINT) + 1)) AS pass FROM q WHERE size > 0)),
l AS (SELECT row_, size, sum(size) OVER (ORDER BY finish, source NULLS LAST, pass, key, row_ ROWS UNBOUNDED PRECEDING) AS line FROM c),
a AS (SELECT row_, CAST(sum(size) AS BIGINT) AS taken FROM l WHERE line <= (SELECT sum(size) FROM d) GROUP BY row_)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM q LEFT JOIN a USING (row_)"""


@register("op12_mix", MIX_SQL)
def op12_mix(spark: SparkSession, folder: str) -> DataFrame:
    """How much of every document the mix takes."""
    return mixing.mix(load(spark, folder, "documents"))


# --- 13: whitening


@register("op13_whiten")
def op13_whiten(spark: SparkSession, folder: str) -> DataFrame:
    """Every usable vector on the leading components, scaled to variance one."""
    return whitening.whiten(load(spark, folder, "embeddings"))
