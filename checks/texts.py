"""Text cleaning: TXT steps, stemming, lemmas, previews."""

from __future__ import annotations

import dataclasses
import re

from pyspark.sql import functions as F

from threadloom.functions import stemming, text as X
from threadloom.functions.scalars import preview
from threadloom.functions.sentences import TREEBANK, fit_sentences, sentences
from threadloom.functions.stopwords import ENGLISH
from threadloom.functions.text import CONTRACTIONS, TextOptions, clean, tokens
from threadloom.operators.morphology import ENDINGS, lemma_table
from threadloom.operators.sizing import spread
from threadloom.operators.transforms import clean_fields
from threadloom.operators.vocab import lemmatize

from .registry import RAW_POSTS_SQL, check, load, raw_posts

# The same character classes in the oracle's regex syntax.
SPACE = r"\s\x0b\x{1c}-\x{1f}\x{85}\p{Z}"
WORD = r"\p{L}\p{N}_"


def sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def strip_urls_sql(column: str) -> str:
    return f"regexp_replace(coalesce({column}, ''), '(http|www)[^{SPACE}]+', '', 'g')"


def tokens_sql(column: str, stops=ENGLISH, numbers: bool = False, lower: bool = True) -> str:
    chars = strip_urls_sql(column)
    if lower:
        chars = f"lower({chars})"
    chars = f"regexp_replace({chars}, '[^{WORD}{SPACE}]+', '', 'g')"
    if numbers:
        chars = rf"regexp_replace({chars}, '\p{{Nd}}+', '', 'g')"
    parts = f"string_split_regex({chars}, '[{SPACE}]+')"
    cases = " ".join(f"WHEN '{w}' THEN ['{a}', '{b}']" for w, (a, b) in CONTRACTIONS.items())
    whole = f"flatten(list_transform({parts}, lambda w: CASE w {cases} ELSE [w] END))"
    return f"list_filter({whole}, lambda w: w NOT IN ({sql_list(['', *stops])}))"


def clean_sql(column: str, **options) -> str:
    return f"array_to_string({tokens_sql(column, **options)}, ' ')"


@check("text_clean", f"SELECT doc_id, {clean_sql('text')} AS cleaned FROM documents")
def text_clean(spark, folder):
    docs = spread(load(spark, folder, "documents").select("doc_id", "text"))
    return docs.select("doc_id", clean(F.col("text")).alias("cleaned"))


@check(
    "text_clean_html",
    f"SELECT page_id, {clean_sql('html', numbers=True)} AS cleaned FROM pages",
)
def text_clean_html(spark, folder):
    pages = spread(load(spark, folder, "pages").select("page_id", "html"))
    return pages.select("page_id", clean(F.col("html"), TextOptions(remove_numbers=True)).alias("cleaned"))


@check(
    "text_clean_case_kept",
    f"SELECT doc_id, {clean_sql('text', lower=False)} AS cleaned FROM documents",
)
def text_clean_case_kept(spark, folder):
    docs = spread(load(spark, folder, "documents").select("doc_id", "text"))
    return docs.select("doc_id", clean(F.col("text"), TextOptions(lowercase=False)).alias("cleaned"))


@check(
    "text_collapse_spaces",
    f"""SELECT doc_id, array_to_string(list_filter(string_split_regex(text, '[{SPACE}]+'),
        lambda w: w <> ''), ' ') AS cleaned FROM documents""",
)
def text_collapse_spaces(spark, folder):
    docs = load(spark, folder, "documents")
    return docs.select("doc_id", clean(F.col("text"), TextOptions.switched(False)).alias("cleaned"))


@check(
    "text_tokens",
    f"""SELECT doc_id, CAST(len({tokens_sql('text')}) AS BIGINT) AS n_tokens,
        CAST(len(list_distinct({tokens_sql('text')})) AS BIGINT) AS n_distinct,
        list_min({tokens_sql('text')}) AS least_token FROM documents""",
)
def text_tokens(spark, folder):
    docs = spread(load(spark, folder, "documents").select("doc_id", "text"))
    words = docs.select("doc_id", tokens(F.col("text")).alias("w"))
    return words.select(
        "doc_id",
        F.size("w").cast("long").alias("n_tokens"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        F.array_min("w").alias("least_token"),
    )


@check(
    "text_strip_urls",
    f"SELECT page_id, {strip_urls_sql('url')} AS url_left, {strip_urls_sql('html')} AS html_left FROM pages",
)
def text_strip_urls(spark, folder):
    return load(spark, folder, "pages").select(
        "page_id",
        X.strip_urls(F.col("url")).alias("url_left"),
        X.strip_urls(F.col("html")).alias("html_left"),
    )


@check(
    "clean_fields",
    f"WITH {RAW_POSTS_SQL} SELECT id, {clean_sql('title')} AS title, {clean_sql('selftext')} AS selftext, "
    f"CASE WHEN author IS NULL THEN NULL ELSE {clean_sql('author')} END AS author FROM raw_posts",
)
def clean_several_fields(spark, folder):
    posts = raw_posts(spark, folder).select("id", "title", "selftext", "author")
    return clean_fields(posts, ["title", "selftext", "author"])


@check("text_preview", "SELECT doc_id, substr(text, 1, 100) AS preview FROM documents")
def text_preview(spark, folder):
    return load(spark, folder, "documents").select("doc_id", preview(F.col("text")).alias("preview"))


# Porter's algorithm as a chain of steps over the distinct words.  A word is marked first: the
# letter y after a consonant becomes I, a vowel, so that classes of letters need no context.
VOWEL = "[aeiouI]"
CONSONANT = "[^aeiouI]"


def cut(word: str, count: int) -> str:
    return f"left({word}, length({word}) - {count})"


def marked(word: str) -> str:
    return rf"regexp_replace({word}, '([^aeiou])y', '\1I', 'g')"


def measure(word: str) -> str:
    return f"len(regexp_extract_all({marked(word)}, '{VOWEL}{CONSONANT}'))"


def short_end(word: str) -> str:
    return (
        f"(regexp_matches({marked(word)}, '^{VOWEL}{CONSONANT}$') OR (regexp_matches({marked(word)}, "
        f"'{CONSONANT}{VOWEL}{CONSONANT}$') AND right({word}, 1) NOT IN ('w', 'x', 'y')))"
    )


def first_suffix(word: str, cases) -> str:
    """The first suffix that matches decides; ``cases`` yields (suffix, new end, condition on the stem)."""
    whens = " ".join(
        f"WHEN ends_with({word}, '{suffix}') THEN CASE WHEN {condition} THEN {cut(word, len(suffix))} || '{new}' ELSE {word} END"
        for suffix, new, condition in cases
    )
    return f"CASE {whens} ELSE {word} END"


def positive(word: str, table):
    return [(suffix, new, f"{measure(cut(word, len(suffix)))} > 0") for suffix, new in table]


def dropped(word: str):
    for suffix in stemming._STEP_4:
        condition = f"{measure(cut(word, len(suffix)))} > 1"
        if suffix == "ion":
            condition += f" AND right({cut(word, 3)}, 1) IN ('s', 't')"
        yield suffix, "", condition


def has_vowel(word: str) -> str:
    return f"regexp_matches({marked(word)}, '{VOWEL}')"


def stems_sql(words: str) -> str:
    """CTEs ending in ``stems(word, stem)`` for the relation ``words(word)``."""
    irregular = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in stemming._IRREGULAR.items())
    return f"""
    plural AS (SELECT word, CASE lower(word) {irregular} ELSE CASE WHEN length(word) <= 2 THEN lower(word) END END AS fixed, lower(word) AS l FROM {words}),
    s1 AS (SELECT word, fixed, CASE WHEN ends_with(l, 'ies') THEN CASE WHEN length(l) = 4 THEN {cut('l', 1)} ELSE {cut('l', 2)} END
             WHEN ends_with(l, 'sses') THEN {cut('l', 2)}
             WHEN ends_with(l, 's') AND NOT ends_with(l, 'ss') THEN {cut('l', 1)} ELSE l END AS w FROM plural),
    s2 AS (SELECT *, CASE WHEN ends_with(w, 'ied') OR ends_with(w, 'eed') THEN NULL
             WHEN ends_with(w, 'ed') AND {has_vowel(cut('w', 2))} THEN {cut('w', 2)}
             WHEN ends_with(w, 'ing') AND {has_vowel(cut('w', 3))} THEN {cut('w', 3)} END AS x FROM s1),
    s3 AS (SELECT word, fixed, CASE WHEN ends_with(w, 'ied') THEN CASE WHEN length(w) = 4 THEN {cut('w', 1)} ELSE {cut('w', 2)} END
             WHEN ends_with(w, 'eed') THEN CASE WHEN {measure(cut('w', 3))} > 0 THEN {cut('w', 1)} ELSE w END
             WHEN x IS NULL THEN w
             WHEN right(x, 2) IN ('at', 'bl', 'iz') THEN x || 'e'
             WHEN length(x) > 1 AND right(x, 1) = substr(x, length(x) - 1, 1) AND regexp_matches({marked('x')}, '{CONSONANT}$')
               THEN CASE WHEN right(x, 1) IN ('l', 's', 'z') THEN x ELSE {cut('x', 1)} END
             WHEN {measure('x')} = 1 AND {short_end('x')} THEN x || 'e' ELSE x END AS w FROM s2),
    s4 AS (SELECT word, fixed, CASE WHEN ends_with(w, 'y') AND length(w) > 2 AND regexp_matches({marked(cut('w', 1))}, '{CONSONANT}$')
             THEN {cut('w', 1)} || 'i' ELSE w END AS w FROM s3),
    s5 AS (SELECT word, fixed, CASE WHEN ends_with(w, 'alli') AND {measure(cut('w', 4))} > 0 THEN {cut('w', 2)} ELSE w END AS w FROM s4),
    s6 AS (SELECT word, fixed, CASE WHEN ends_with(w, 'logi') AND {measure(cut('w', 3))} > 0 THEN {cut('w', 1)}
             ELSE {first_suffix('w', positive('w', stemming._STEP_2))} END AS w FROM s5),
    s7 AS (SELECT word, fixed, {first_suffix('w', positive('w', stemming._STEP_3))} AS w FROM s6),
    s8 AS (SELECT word, fixed, {first_suffix('w', dropped('w'))} AS w FROM s7),
    s9 AS (SELECT word, fixed, CASE WHEN ends_with(w, 'e') AND ({measure(cut('w', 1))} > 1 OR ({measure(cut('w', 1))} = 1
             AND NOT {short_end(cut('w', 1))})) THEN {cut('w', 1)} ELSE w END AS w FROM s8),
    stems AS (SELECT word, coalesce(fixed, CASE WHEN ends_with(w, 'll') AND {measure(cut('w', 1))} > 1 THEN {cut('w', 1)} ELSE w END) AS stem FROM s9)"""


@check(
    "stem_tokens",
    f"""WITH cleaned AS (SELECT doc_id, {tokens_sql('text')} AS ws FROM documents),
    placed AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM cleaned),
    words AS (SELECT DISTINCT word FROM placed), {stems_sql('words')},
    joined AS (SELECT doc_id, string_agg(stem, ' ' ORDER BY pos) AS t FROM placed p JOIN stems s ON p.word = s.word GROUP BY doc_id)
    SELECT c.doc_id, coalesce(t, '') AS stemmed FROM cleaned c LEFT JOIN joined j ON c.doc_id = j.doc_id""",
)
def stem_tokens(spark, folder):
    docs = spread(load(spark, folder, "documents").select("doc_id", "text"))
    return docs.select("doc_id", clean(F.col("text"), TextOptions(stemming=True)).alias("stemmed"))


# The lemma table is read from the data: every word seen in the English benchmark
# passages that ends in s is mapped to the word without it.
LEMMA_SQL = f"""WITH words AS (SELECT DISTINCT unnest({tokens_sql('text')}) AS word FROM benchmark),
    lemmas AS (SELECT word, substr(word, 1, length(word) - 1) AS lemma FROM words
               WHERE word LIKE '%s' AND length(word) > 3),
    cleaned AS (SELECT doc_id, {tokens_sql('text')} AS ws FROM documents),
    placed AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM cleaned),
    changed AS (SELECT doc_id, string_agg(coalesce(lemma, p.word), ' ' ORDER BY pos) AS t
                FROM placed p LEFT JOIN lemmas l ON p.word = l.word GROUP BY doc_id)
    SELECT c.doc_id, coalesce(t, '') AS cleaned FROM cleaned c LEFT JOIN changed g ON c.doc_id = g.doc_id"""


def lemmatized(spark, folder, strategy):
    words = load(spark, folder, "benchmark").select(F.explode(tokens(F.col("text"))).alias("word")).distinct()
    lemmas = words.where("word LIKE '%s' AND length(word) > 3").selectExpr(
        "word", "substr(word, 1, length(word) - 1) AS lemma"
    )
    docs = spread(load(spark, folder, "documents").select("doc_id", "text"))
    cleaned = docs.select("doc_id", clean(F.col("text")).alias("cleaned"))
    return lemmatize(cleaned, "cleaned", lemmas, strategy)


@check("lemma_tokens", LEMMA_SQL)
def lemma_tokens(spark, folder):
    return lemmatized(spark, folder, "map")


@check("lemma_tokens_join", LEMMA_SQL)
def lemma_tokens_join(spark, folder):
    return lemmatized(spark, folder, "join")


# Rows without a key and repeated rows, under either plan that the size may choose.
REPEATED_LEMMA_SQL = LEMMA_SQL.replace("SELECT c.doc_id, coalesce(t, '')", "SELECT CASE WHEN c.doc_id % 5 > 0 THEN c.doc_id // 2 END AS doc_id, coalesce(t, '')")


def lemmatized_repeats(spark, folder, lemma_strategy="auto"):
    words = load(spark, folder, "benchmark").select(F.explode(tokens(F.col("text"))).alias("word")).distinct()
    lemmas = words.where("word LIKE '%s' AND length(word) > 3").selectExpr(
        "word", "substr(word, 1, length(word) - 1) AS lemma"
    )
    docs = spread(load(spark, folder, "documents").select("doc_id", "text"))
    keyed = docs.select(F.expr("CASE WHEN doc_id % 5 > 0 THEN doc_id DIV 2 END AS doc_id"), clean(F.col("text")).alias("cleaned"))
    return lemmatize(keyed, "cleaned", lemmas, lemma_strategy)


@check("lemma_repeated_keys", REPEATED_LEMMA_SQL)
def lemma_repeated_keys(spark, folder):
    return lemmatized_repeats(spark, folder)


@check("lemma_repeated_keys_join", REPEATED_LEMMA_SQL)
def lemma_repeated_keys_join(spark, folder):
    return lemmatized_repeats(spark, folder, "join")


@check(
    "text_clean_missing",
    f"""SELECT doc_id, {clean_sql('t')} AS cleaned, t IS NULL AS missing
        FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE text END AS t FROM documents) d""",
)
def text_clean_missing(spark, folder):
    """A null or empty text cleans to the empty text."""
    docs = load(spark, folder, "documents").selectExpr("doc_id", "CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE text END AS t")
    return docs.select("doc_id", clean(F.col("t")).alias("cleaned"), F.col("t").isNull().alias("missing"))


# Sentences and punctuation ---------------------------------------------------------


def separated_sql(column: str) -> str:
    """The Treebank rules of ``sentences`` in DuckDB's dialect."""
    out = f"' ' || array_to_string(list_filter(string_split_regex({column}, '[{SPACE}]+'), lambda w: w <> ''), ' ') || ' '"
    for pattern, change in TREEBANK:
        pattern, change = pattern.replace("'", "''"), re.sub(r"\$(\d)", r"\\\1", change).replace("'", "''")
        out = f"regexp_replace({out}, '{pattern}', '{change}', 'g')"
    return out


PUNCTUATION = TextOptions.switched(False)


@check(
    "text_punctuation_tokens",
    f"""WITH t AS (SELECT doc_id, list_filter(string_split({separated_sql('text')}, ' '), lambda w: w <> '') AS w FROM documents)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_tokens, CAST(len(list_filter(w, lambda x: NOT regexp_matches(x, '[\\p{{L}}\\p{{N}}]'))) AS BIGINT) AS n_marks,
           md5(array_to_string(w, ' ')) AS digest FROM t""",
)
def text_punctuation_tokens(spark, folder):
    """Punctuation marks as tokens, the text taken as one sentence."""
    docs = spread(load(spark, folder, "documents").select("doc_id", "text"))
    options = dataclasses.replace(PUNCTUATION, punctuation_tokens=True, split_contractions=False)
    listed = docs.select("doc_id", tokens(F.col("text"), options).alias("w"))
    return listed.select(
        "doc_id",
        F.size("w").cast("long").alias("n_tokens"),
        F.size(F.filter("w", lambda x: ~x.rlike(r"[\p{L}\p{N}]"))).cast("long").alias("n_marks"),
        F.md5(F.array_join("w", " ")).alias("digest"),
    )



def bare(word):
    return f"regexp_replace({word}, " + r"""'["''”’»)\]}]+$', '')"""


def opened(word):
    return f"regexp_replace({word}, " + r"""'^["''“‘«(\[{]+', '')"""


def core(word):
    return opened(rf"regexp_replace({bare(word)}, '\.$', '')")


def first(word):
    return f"substr({opened(word)}, 1, 1)"


def stopped(word):
    return rf"regexp_matches({bare(word)}, '(^|[^.])\.$')"


def upper(word):
    return f"{first(word)} <> lower({first(word)})"


SENTENCES_SQL = rf"""
WITH l AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[{SPACE}]+'), lambda w: w <> '') AS w FROM documents),
e AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM l),
t AS (SELECT doc_id, i, word, lag(word) OVER o AS before, lead(word) OVER o AS after FROM e WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
c AS (
  SELECT lower({core('word')}) AS type, CAST(count(*) FILTER (WHERE {stopped('word')}) AS DOUBLE) AS stopped,
         CAST(count(*) FILTER (WHERE NOT {stopped('word')}) AS DOUBLE) AS plain,
         count(*) FILTER (WHERE {first('word')} <> upper({first('word')})) AS low,
         count(*) FILTER (WHERE {upper('word')} AND before IS NOT NULL
                          AND NOT regexp_matches({bare('before')}, '[.?!]$')) AS up
  FROM t GROUP BY 1),
p AS (SELECT sum(stopped) / sum(stopped + plain) AS p FROM c),
s AS (SELECT *, length(replace(type, '.', '')) AS n, length(type) - length(replace(type, '.', '')) AS inner_ FROM c),
a AS (SELECT type FROM s, p WHERE stopped > 0 AND regexp_matches(type, '\p{{L}}')
      AND 2 * (stopped * ln(0.99) + plain * ln(1 - 0.99) - stopped * ln(p) - plain * ln(1 - p)) * exp(-n) * (inner_ + 1) * pow(n, -plain) >= 0.3),
d AS (SELECT type FROM c WHERE low > 0 AND up = 0),
b AS (
  SELECT doc_id, i, word, CASE WHEN after IS NULL THEN FALSE
    WHEN regexp_matches({bare('word')}, '[?!]$') THEN TRUE
    WHEN regexp_matches({bare('word')}, '\.\.$') THEN {upper('after')}
    WHEN NOT regexp_matches({bare('word')}, '\.$') THEN FALSE
    WHEN {stopped('word')} AND (lower({core('word')}) IN (SELECT type FROM a) OR regexp_matches({core('word')}, '^\p{{L}}$'))
      THEN {upper('after')} AND lower({core('after')}) IN (SELECT type FROM d)
    WHEN NOT regexp_matches({bare('word')}, '\p{{L}}') THEN {first('after')} = upper({first('after')})
    ELSE TRUE END AS border
  FROM t),
j AS (SELECT doc_id, string_agg(word || CASE WHEN border THEN chr(10) ELSE ' ' END, '' ORDER BY i) AS joined, count(*) FILTER (WHERE border) + 1 AS n FROM b GROUP BY doc_id)
SELECT l.doc_id, coalesce(n, 0) AS n_sentences, md5(coalesce(rtrim(replace(joined, chr(10), ' ' || chr(10)), ' '), '')) AS digest FROM l LEFT JOIN j USING (doc_id)"""


@check("text_sentences", SENTENCES_SQL)
def text_sentences(spark, folder):
    """Sentences by the statistics of all documents."""
    docs = spread(load(spark, folder, "documents").select("doc_id", "text"))
    model = fit_sentences(docs, "text")
    split = docs.select("doc_id", sentences(F.col("text"), model).alias("s"))
    return split.select("doc_id", F.size("s").cast("long").alias("n_sentences"), F.md5(F.array_join("s", " \n")).alias("digest"))


# Lemmas by morphology: known are the words that occur at least ten times.
def lemmas_sql(part: str) -> str:
    tried = "".join(
        f" UNION ALL SELECT word, {n}, left(word, length(word) - {len(end)}) || '{instead}' FROM v WHERE ends_with(word, '{end}') AND length(word) > {len(end)}"
        for n, (end, instead) in enumerate(ENDINGS[part], 1)
    )
    return f"""WITH w AS (SELECT unnest({tokens_sql('text')}) AS word FROM documents),
    v AS (SELECT word, count(*) AS n FROM w GROUP BY word),
    known AS (SELECT word FROM v WHERE n >= 10),
    tried AS (SELECT word, 0 AS rule, word AS candidate FROM v{tried}),
    best AS (SELECT word, arg_min(candidate, [length(candidate), rule]) AS lemma FROM tried WHERE candidate IN (SELECT word FROM known) GROUP BY word)
    SELECT v.word, CASE WHEN v.word = 'und' THEN 'and' ELSE coalesce(lemma, v.word) END AS lemma FROM v LEFT JOIN best b ON v.word = b.word"""


for _part in ENDINGS:

    @check(f"lemma_morphology_{_part}", lemmas_sql(_part))
    def morphology(spark, folder, part=_part):
        """The lemma of every word of the documents; one irregular form goes before the rules."""
        docs = spread(load(spark, folder, "documents").select("text"))
        words = docs.select(F.explode(tokens(F.col("text"))).alias("word"))
        known = words.groupBy("word").count().where("count >= 10")
        odd = spark.createDataFrame([("und", "and")], "word string, lemma string")
        return lemma_table(words, known, part, odd)
