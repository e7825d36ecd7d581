"""The operators applied to their whole tables, as queries: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.llm import (
    byte_bpe, chat_format, collocations, fingerprints, language_id, licenses, mixing, near_dedup, quality, ranked_search,
    repeats, topk_search, url_filter,
)
from tidemill.llm.common import read

# The rules that the URL query is to apply.
RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]
#: Hosts with one of these words are what the tables have of spam; their canonical URLs are the list.
SPAM = r"casino|pills"


def op1_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scan(read(spark, d, "documents"))


def op2_topk_search(spark: SparkSession, d: str) -> DataFrame:
    return topk_search.top_k(read(spark, d, "embeddings"), F.col("id") % 50 == 0, 5)


def op3_source_mixing(spark: SparkSession, d: str) -> DataFrame:
    drawn = mixing.copies(read(spark, d, "documents"))
    return drawn.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op4_chat_format(spark: SparkSession, d: str) -> DataFrame:
    return chat_format.format_chats(read(spark, d, "conversations"))


def op5_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    return repeats.removed_bytes(read(spark, d, "documents"))


def op6_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = byte_bpe.round_trip(read(spark, d, "documents"), ranks, public_tokenizers.PATTERN, ["doc_id"])
    return coded.select("doc_id", byte_bpe.n_tokens().alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_url_filter(spark: SparkSession, d: str) -> DataFrame:
    pages = read(spark, d, "pages")
    listed = pages.where(url_filter.host(F.col("url")).rlike(SPAM)).select(
        url_filter.canonical(F.col("url")).alias("canonical"))
    return url_filter.judge(pages, listed, RULES)


def op8_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return fingerprints.fingerprints(read(spark, d, "documents"))


def op9_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, d, "documents"), words=4)


def op10_language_id(spark: SparkSession, d: str) -> DataFrame:
    return language_id.identify(read(spark, d, "documents"))


def op11_collocations(spark: SparkSession, d: str) -> DataFrame:
    return collocations.collocations(read(spark, d, "documents"))


def op12_ranked_search(spark: SparkSession, d: str) -> DataFrame:
    return ranked_search.best_documents(read(spark, d, "documents"), read(spark, d, "benchmark"))


def op13_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.score(read(spark, d, "documents"), read(spark, d, "labels"))


QUERIES = {f.__name__: f for f in [
    op1_license_scan, op2_topk_search, op3_source_mixing, op4_chat_format, op5_suffix_dedup,
    op6_byte_bpe, op7_url_filter, op8_fingerprints, op9_near_dedup, op10_language_id,
    op11_collocations, op12_ranked_search, op13_quality,
]}

_HOST = "translate(coalesce(regexp_extract({rest}, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_REST = "CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END"

ORACLE = {
    "op4_chat_format": """
        WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
        whole AS (SELECT conv_id, list({'turn': turn, 'role': role, 'text': text} ORDER BY turn, role, text) AS l
                  FROM turns GROUP BY conv_id),
        proper AS (SELECT DISTINCT l[1:i] AS l FROM (SELECT l, unnest(range(1, len(l))) AS i FROM whole)),
        kept AS (SELECT conv_id FROM whole WHERE l NOT IN (SELECT l FROM proper))
        SELECT conv_id, CAST(floor(turn / 1024) AS BIGINT) AS part, count(*) AS n_turns,
               string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>'
                          || chr(10), '' ORDER BY turn, role, text) AS text
        FROM turns WHERE conv_id IN (SELECT conv_id FROM kept) GROUP BY 1, 2""",
    "op7_url_filter": f"""
        WITH parts AS (SELECT page_id, {_REST} AS rest FROM pages),
        parsed AS (
            SELECT page_id, rest, {_HOST.format(rest='rest')} AS host,
                   coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
                   list_filter(string_split(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT
                       regexp_matches(p, '^(utm_[a-z]+|ref|gclid|fbclid)(=|$)')) AS params
            FROM parts),
        named AS (
            SELECT *, regexp_replace(regexp_replace(host, '^www\\.', ''), ':(80|443)$', '') AS bare FROM parsed),
        keyed AS (
            SELECT page_id, host, path, CASE WHEN bare <> '' THEN bare || regexp_replace(path, '/+$', '') ||
                   CASE WHEN len(params) > 0 THEN '?' || array_to_string(list_sort(params), '&') ELSE '' END END AS canonical,
                   CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
                        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
                        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
                        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
            FROM named),
        listed AS (SELECT DISTINCT canonical FROM keyed WHERE regexp_matches(host, 'casino|pills') AND canonical IS NOT NULL)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('com/fr/', 'org/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                    WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict
        FROM keyed""",
    "op11_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
            FROM documents WHERE text IS NOT NULL),
        worded AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
        placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
        grown AS (SELECT lang, w, i, unnest(range(1, least(4, len(w) - i + 1) + 1)) AS k FROM placed),
        f AS (SELECT lang, w[i:i + k - 1] AS p, count(*) AS n FROM grown GROUP BY 1, 2),
        totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE len(p) = 1 GROUP BY 1),
        often AS (SELECT lang, p, n AS a FROM f WHERE n >= 30),
        cuts AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM often WHERE len(p) > 1),
        scored AS (
            SELECT c.lang, c.p, c.a, c.k, x.a AS l, y.a AS r,
                   CAST((2000000::HUGEINT * c.a) // (x.a + y.a) AS BIGINT) AS score
            FROM cuts c JOIN often x ON x.lang = c.lang AND x.p = c.p[1:c.k]
            JOIN often y ON y.lang = c.lang AND y.p = c.p[c.k + 1:]),
        weakest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
        parts AS (SELECT lang, p, a, unnest(range(1, len(p))) AS i FROM often WHERE len(p) > 2),
        held AS (SELECT lang, p, a, i, unnest(range(2, len(p))) AS k FROM parts),
        inside AS (SELECT lang, p[i:i + k - 1] AS p, max(a) AS most FROM held WHERE i + k - 1 <= len(p) GROUP BY 1, 2),
        kept AS (
            SELECT w.lang, array_to_string(w.p, ' ') AS phrase, a, l, r, score FROM weakest w
            LEFT JOIN inside i ON i.lang = w.lang AND i.p = w.p WHERE i.most IS NULL OR 100 * i.most < 80 * a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
               score
        FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000""",
    "op12_ranked_search": r"""
        WITH terms AS (
            SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
            FROM documents),
        docs AS (SELECT row, doc_id, t, len(t) AS n FROM terms WHERE len(t) > 0),
        corpus AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs),
        tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(t) AS term FROM docs) GROUP BY 1, 2),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
        asked AS (
            SELECT item, item_id, term, count(*) AS qtf FROM (
                SELECT item, item_id, unnest(regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark)) GROUP BY 1, 2, 3),
        scored AS (
            SELECT item, item_id, row, doc_id, CAST(sum(
                qtf * CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT)
                * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
            FROM asked JOIN df USING (term) JOIN tf USING (term) JOIN docs USING (row), corpus GROUP BY 1, 2, 3, 4)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
               doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 10""",
}
