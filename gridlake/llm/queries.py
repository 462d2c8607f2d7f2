"""The operators over the test tables, with production parameters, beside their SQL where SQL can say it."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm import (
    arrow_tokens, ball_tree, conversations, decontaminate, language, near_dedup, one_bit, packing, quality, topk, toxicity, urls,
    warc,
)
from gridlake.llm.shared import ship_package, split_of

END_ID = 2          # ends every document's ids

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its oracle SQL."""
    def add(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def word_tokenizer() -> str:
    """The file of the public word tokenizer, as its package names it."""
    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


RULES = (      # host, path, verdict
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

URL_SQL = """
WITH parts AS (
  SELECT page_id, CASE WHEN url IS NULL OR instr(url, '://') = 0 THEN '' ELSE substr(url, instr(url, '://') + 3) END AS tail
  FROM pages
), hosts AS (
  SELECT page_id, translate(regexp_extract(tail, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(rhost, rpath, verdict) AS (VALUES """ + ", ".join(str(r) for r in RULES) + """),
fits AS (
  SELECT page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(verdict, length(rhost || rpath)) AS verdict
  FROM hosts, rules
  WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id
)
SELECT page_id, host, path, fits.rule AS rule, coalesce(fits.verdict, 'allow') AS verdict
FROM hosts LEFT JOIN fits USING (page_id)
"""


@query("op1_url_filter", URL_SQL)
def op1_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return urls.judge(table(spark, sf_dir, "pages"), rules)


@query("op2_quality")
def op2_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = split_of("doc_id", 3) == 1
    model = quality.fit(docs, labels, learn=~held_out)
    return quality.score(docs, model, keep={"doc_id": F.col("doc_id"), "held_out": held_out})


WARC_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages
), g AS (SELECT digest, max(page_id) AS original FROM p WHERE n >= 1000 GROUP BY digest)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN original <> page_id THEN original END AS refers_to
FROM p LEFT JOIN g USING (digest)
"""


@query("op3_warc", WARC_SQL)
def op3_warc(spark, sf_dir):
    return warc.archive_pages(table(spark, sf_dir, "pages"))


TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""


@query("op4_top_k", TOP_SQL)
def op4_top_k(spark, sf_dir):
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op5_toxicity")
def op5_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = split_of("doc_id", 5) == 0
    model = toxicity.fit(docs, labels, learn=~held_out)
    return toxicity.score(docs, model, keep={"doc_id": F.col("doc_id"), "held_out": held_out})


@query("op6_language_id")
def op6_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = split_of("doc_id", 3) == 1
    profiles = language.fit(docs, learn=~held_out)
    return language.identify(docs, profiles, keep={"doc_id": F.col("doc_id"), "held_out": held_out})


@query("op8_near_dedup")
def op8_near_dedup(spark, sf_dir):
    return near_dedup.find_groups(table(spark, sf_dir, "documents"), percent=85)


@query("op7_arrow_tokens")
def op7_arrow_tokens(spark, sf_dir):
    return arrow_tokens.encode_documents(table(spark, sf_dir, "documents"), word_tokenizer(), END_ID)


@query("op9_packing")
def op9_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), word_tokenizer(), END_ID, with_ids=False)


@query("op10_decontamination")
def op10_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    indexes = decontaminate.build_indexes(docs, table(spark, sf_dir, "benchmark"))
    return decontaminate.find_leaks(docs, indexes)


def _repair_sql() -> str:
    """The repair as a walk from each conversation's last row to its first, with the best way on from each state.

    A way is {c: cost, e: edits, t: rows}; states are 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
    """
    role = {2: "user:", 3: "assistant:"}
    forced, leads = (2, 2, 3, 2), {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
    way = lambda cost, edit, rows, to: f"{{c: g{to}.c + {cost}, e: '{edit}' || g{to}.e, t: {rows} || g{to}.t}}"
    insert = lambda s, behind: (f"{{c: {behind}.c + 2, e: 'I' || {behind}.e, t: ['{role[forced[s]]}'] || {behind}.t}}")
    use = []
    for s in range(4):
        keep = " ".join(f"WHEN initial = '{i}' THEN {way('cut', 'K', '[said]', to[s])}" for i, to in leads.items() if s in to)
        new = role[forced[s]]
        use.append(f"least({way(3, 'D', 'CAST([] AS VARCHAR[])', s)}, CASE WHEN gone THEN NULL {keep} END, "
                   f"CASE WHEN NOT gone THEN {way('2 + cut', 'R', f"['{new}' || text]", forced[s])} END) AS h{s}")
    end = ", ".join(f"{{c: CAST({len(rows) * 2} AS BIGINT), e: '{'I' * len(rows)}', t: CAST({rows} AS VARCHAR[])}} AS g{s}"
                    for s, rows in enumerate([[], ["user:", "assistant:"], ["assistant:"], []]))
    crc_entry = "list_reduce([k] || range(8), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    return f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda k: {crc_entry}) AS entry),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), faults AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce([4294967295] || list_transform(string_split(k, ''), lambda x: CAST(ord(x) AS BIGINT)),
                         lambda c, b: xor(c >> 8, entry[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS fault FROM keyed, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM faults WHERE fault <> 0
), placed AS (
  SELECT *, regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS bare,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS time FROM damaged
), found AS (
  SELECT conv_id, i, turn, role, text, role || ':' || text AS said, left(role, 1) AS initial, bare = '' AS blank, time > 1 AS again,
         bare = '' OR time > 1 AS gone, CASE WHEN right(bare, 1) IN ('.', '!', '?') THEN 0 ELSE 1 END AS cut,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM placed
), facts AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
         count(*) FILTER (cut = 1 AND NOT gone) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM found GROUP BY conv_id
), walk AS (
  SELECT conv_id, n AS i, {end} FROM facts
  UNION ALL
  SELECT conv_id, i - 1, least(h0, {{c: g2.c + 2, e: 'I' || g2.e, t: ['user:'] || g2.t}}),
         least(h1, {{c: g2.c + 2, e: 'I' || g2.e, t: ['user:'] || g2.t}}), g2, g3
  FROM (SELECT *, least(h2, {insert(2, 'h3')}) AS g2, least(h3, {insert(3, 'h2')}) AS g3
        FROM (SELECT w.conv_id, w.i, {', '.join(use)}
              FROM walk w JOIN found f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.i = f.i))
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(g0.c, 0) AS cost,
       coalesce(g0.e, '') AS audit, sha256(coalesce(array_to_string(g0.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN facts f ON c.conv_id IS NOT DISTINCT FROM f.conv_id
LEFT JOIN walk w ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = 0
"""


@query("op11_repair", _repair_sql())
def op11_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return conversations.repair_report(conversations.damage(rows), rows)


LEXICAL_SQL = r"""
WITH words AS (
  SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)
), asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
  ) GROUP BY item_id, term
), sizes AS (SELECT r, count(*) AS n FROM words GROUP BY r
), whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes
), tf AS (SELECT r, doc_id, term, count(*) AS tf FROM words GROUP BY r, doc_id, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY term
), scores AS (
  SELECT item_id, r, doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN sizes USING (r), whole
  GROUP BY item_id, r, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
) WHERE rank <= 10
"""


@query("op12_lexical_search", LEXICAL_SQL)
def op12_lexical_search(spark, sf_dir):
    return ball_tree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_nearest")
def op13_nearest(spark, sf_dir):
    return one_bit.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
