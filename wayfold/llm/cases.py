"""The operators as queries over the given tables, with SQL where it can express them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayfold.llm import (
    chat_format, chat_repair, classifier, common, extraction, mixing, ngram_jaccard, quality_rules, sentencepiece_codec, suffix_dedup, token_align, topk,
    url_filters, warc,
)

#: Columns of the given tables; declared, so that a read opens no file to find them out.
TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
MODEL = os.environ.get("WAYFOLD_PIECES", "/opt/tokenizers/piece_bpe_32k.model")
BYTES = os.environ.get("WAYFOLD_BYTES", "/opt/tokenizers/byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_documents(table(spark, sf_dir, "documents"), MODEL)


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def fetches(pages: DataFrame) -> DataFrame:
    """Captures: each page fetched on a day of 2024 that its id gives."""
    day = F.pmod(F.col("page_id") * 37, F.lit(366)).cast("int")
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), day).alias("fetched"))


def url_log(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts and sections of the pages. Of each pattern a digest gives whether and when it
    is listed, taken off and listed again."""
    url = F.col("url")
    name = url_filters.host(url)
    section = F.concat(name, F.regexp_extract(url, r"^https?://[^/?#]*(/[^/?#]*/)", 1))
    patterns = pages.select(name.alias("pattern")).union(pages.select(section.alias("pattern"))).where("pattern IS NOT NULL AND pattern <> ''").distinct()
    digit = lambda at: F.conv(F.substring(F.md5("pattern"), at, 2), 16, 10).cast("int")
    start = F.lit("2024-01-01").cast("date")
    events = F.array(
        F.struct(F.lit("add").alias("action"), F.date_add(start, digit(1)).alias("at")),
        F.struct(F.lit("remove").alias("action"), F.date_add(start, digit(1) + digit(3)).alias("at")),
        F.struct(F.lit("add").alias("action"), F.date_add(start, digit(1) + digit(3) + digit(5)).alias("at")),
    )
    listed = patterns.where(digit(7) % 3 == 0)
    return listed.select("pattern", F.explode(events).alias("e")).select("pattern", "e.action", "e.at")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filters.judge(fetches(pages), url_log(pages))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.fresh(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    read = warc.read_archives(spark, path)
    return read.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repaired_digests(table(spark, sf_dir, "conversations"))


#: Holds the template's own control strings, one of them escaped already.
HARD_TEXT = r"\### Assistant: </turn> ok"


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = spark.range(2).select(F.lit(-7).cast("bigint"), "id", F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(HARD_TEXT))
    formatted = chat_format.format_chats(table(spark, sf_dir, "conversations").unionAll(hard))
    return chat_format.digests(formatted)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align_documents(table(spark, sf_dir, "documents"), BYTES, MODEL)


QUERIES = {
    f.__name__: f
    for f in (
        op1_sentencepiece, op2_topk, op3_mixing, op4_url_filters, op5_ngram_jaccard, op6_warc, op7_html_extraction, op8_quality_rules,
        op9_suffix_dedup, op10_quality_classifier, op11_structure_repair, op12_chat_formatting, op13_token_alignment,
    )
}

_WORDS = r"'[^\x20\x09-\x0D]+'"
_HOST = "lower(regexp_replace(regexp_replace(regexp_replace(regexp_extract(coalesce(url, ''), '^(?i:https?)://([^/?#]*)', 1), '^.*@', ''), ':\\d*$', ''), '\\.$', ''))"


def _digit(at: int) -> str:
    return f"('0x' || substr(md5(pattern), {at}, 2))::INT"


def _repair_sql() -> str:
    """The dynamic program as a recursive query; a state is {cost, audit, repaired lines}, and structs compare in that order."""
    lost = "{'cost': 1000000, 'audit': '', 'lines': []::VARCHAR[]}"
    least = lambda *x: f"list_sort([{', '.join(x)}])[1]"
    step = lambda q, cost, letter, line: f"{{'cost': {q}.cost + {cost}, 'audit': {q}.audit || '{letter}', 'lines': {f'list_append({q}.lines, {line})' if line else f'{q}.lines'}}}"

    def stay(q: str, role: str) -> str:
        kept = step(q, "more", "K", "o.role || ':' || o.text")
        return f"CASE WHEN must THEN {lost} WHEN initial = '{role[0]}' THEN {kept} ELSE {step(q, 'more + 1', 'R', f"'{role}:' || o.text")} END"

    return rf"""
        WITH RECURSIVE k AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(list_prepend(4294967295::BIGINT,
                list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)),
                lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))),
                4294967295) % 20 AS kind FROM conversations),
        d AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, row_number() OVER () AS i
            FROM k, generate_series(1, CASE WHEN kind = 3 THEN 2 ELSE 1 END) WHERE kind <> 0),
        f AS (
            SELECT *, row_number() OVER w AS n, left(role, 1) AS initial, left(lag(role) OVER w, 1) AS before,
                   CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, i) > 1 THEN 'duplicate'
                        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
            FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, i)),
        o AS (SELECT *, fault IN ('blank', 'duplicate') AS must, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS more FROM f),
        r AS (
            SELECT DISTINCT conv_id, 0::BIGINT AS n, {{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}} AS z, {lost} AS s,
                   {{'cost': 5, 'audit': 'I', 'lines': ['user:']}} AS u, {{'cost': 10, 'audit': 'II', 'lines': ['user:', 'assistant:']}} AS a FROM conversations
            UNION ALL
            SELECT conv_id, n, z, s, u, {least("a", step("u", 5, "I", "'assistant:'"))} FROM (
                SELECT conv_id, n, z, s, {least("u", *(step(q, 5, "I", "'user:'") for q in "zsa"))} AS u, a FROM (
                    SELECT r.conv_id, o.n, {step("z", 2, "D", "")} AS z,
                           {least(step("s", 2, "D", ""), f"CASE WHEN NOT must AND initial = 's' THEN {step('z', 'more', 'K', "o.role || ':' || o.text")} ELSE {lost} END")} AS s,
                           {least(step("u", 2, "D", ""), *(stay(q, "user") for q in "zsa"))} AS u,
                           {least(step("a", 2, "D", ""), stay("u", "assistant"))} AS a
                    FROM r JOIN o ON o.conv_id IS NOT DISTINCT FROM r.conv_id AND o.n = r.n + 1))),
        e AS (SELECT conv_id, {least("z", "a")} AS best FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) AS back FROM r) WHERE back = 1),
        c AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                   count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
            FROM f GROUP BY conv_id)
        SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, CASE WHEN c.gaps IS NULL THEN 0 ELSE best.cost END::BIGINT AS cost,
               CASE WHEN c.gaps IS NULL THEN '' ELSE best.audit END AS audit,
               sha256(CASE WHEN c.gaps IS NULL THEN '' ELSE array_to_string(best.lines, chr(10)) END) AS repaired_sha256
        FROM e LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM e.conv_id"""


SQL = {
    "op2_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
              FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.vec_id % 50 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op3_mixing": mixing.mix_sql(),
    "op4_url_filters": f"""
        WITH shots AS (SELECT page_id, url, CAST(DATE '2024-01-01' + CAST((page_id * 37) % 366 AS INT) AS DATE) AS fetched, {_HOST} AS host FROM pages),
        patterns AS (
            SELECT DISTINCT pattern FROM (
                SELECT host AS pattern FROM shots UNION ALL
                SELECT host || regexp_extract(url, '^https?://[^/?#]*(/[^/?#]*/)', 1) FROM shots)
            WHERE pattern <> ''),
        listed AS (SELECT pattern, {_digit(1)} AS a, {_digit(3)} AS b, {_digit(5)} AS c FROM patterns WHERE {_digit(7)} % 3 = 0),
        active AS (SELECT s.page_id, s.url, s.fetched, l.pattern FROM shots s JOIN listed l ON
            (s.host = l.pattern OR s.host LIKE '%.' || l.pattern
             OR (contains(l.pattern, '/') AND starts_with(s.host || regexp_extract(s.url, '^(?i:https?)://[^/?#]*(/[^?#]*)', 1), l.pattern)))
            AND ((date_diff('day', DATE '2024-01-01', s.fetched) >= a AND date_diff('day', DATE '2024-01-01', s.fetched) < a + b)
                 OR date_diff('day', DATE '2024-01-01', s.fetched) >= a + b + c))
        SELECT s.page_id, s.url, s.fetched, count(DISTINCT a.pattern) AS n_entries,
               first(a.pattern ORDER BY length(a.pattern) DESC, a.pattern) AS pattern, count(a.pattern) > 0 AS blocked
        FROM shots s LEFT JOIN active a USING (page_id) GROUP BY ALL""",
    "op5_ngram_jaccard": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORDS}) AS w
            FROM documents),
        g AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                   ELSE list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g
            FROM w),
        n AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles FROM g),
        u AS (SELECT doc_id, unnest(g) AS s FROM g),
        o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM u a JOIN u b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
        l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
              WHERE 100 * c >= 80 * (x.n_shingles + y.n_shingles - c)),
        r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
        SELECT doc_id, n_shingles, component_id FROM n JOIN m USING (doc_id)""",
    "op6_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS last FROM p)
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(generate_series(0, 31), lambda i:
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                          CAST((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31 AS INT) + 1, 1)), '') AS payload_digest,
               CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to, true AS intact
        FROM d""",
    "op11_structure_repair": _repair_sql(),
    "op12_chat_formatting": rf"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '{HARD_TEXT}' UNION ALL SELECT -7, 1, 'assistant', '{HARD_TEXT}')
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(15 + length(role) + length(text) + len(regexp_extract_all(text, '### |</turn>'))) AS BIGINT) AS formatted_chars
        FROM c GROUP BY conv_id""",
}
