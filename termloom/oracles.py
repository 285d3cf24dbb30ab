"""The named queries as SQL for DuckDB."""

from __future__ import annotations

from termloom.catalog import CUSTOM_STOPWORDS
from termloom.functions.text import DEFAULT_STOPWORDS

WORD = r"'[\p{L}\p{N}]+'"


def prepared(text: str) -> str:
    return f"replace(nfc_normalize({text}), 'ʼ', '''')"


def tokens(text: str) -> str:
    return f"regexp_extract_all(lower({prepared(text)}), {WORD})"


def counted(tokens_sql: str, source: str = "documents", doc_id: str = "doc_id") -> str:
    return (
        f"SELECT term, doc_id, CAST(count(*) AS INTEGER) AS tf FROM "
        f"(SELECT {doc_id} AS doc_id, unnest({tokens_sql}) AS term FROM {source}) "
        f"GROUP BY term, doc_id"
    )


POSTINGS = counted(tokens("text"))
WITH = f"WITH postings AS ({POSTINGS})"


def quoted(words) -> str:
    return ", ".join(f"'{word}'" for word in words)


def having_all(words, n: int) -> str:
    return (
        f"SELECT doc_id FROM postings WHERE term IN ({quoted(words)}) "
        f"GROUP BY doc_id HAVING count(*) = {n}"
    )


def snippet(text: str, terms: list[str]) -> str:
    found = ", ".join(
        f"{{'position': instr(lower({text}), '{t}'), 'query_order': {i}, 'length': {len(t)}}}"
        for i, t in enumerate(terms)
    )
    hit = f"list_min(list_filter([{found}], lambda h: h.position > 0))"
    return (
        f"CASE WHEN {hit} IS NOT NULL AND length({text}) > 0 THEN substring({text}, "
        f"greatest({hit}.position - 1 - 40, 0) + 1, "
        f"{hit}.position - 1 + {hit}.length + 80 - greatest({hit}.position - 1 - 40, 0)) END"
    )


QUERIES_SQL = rf"""
items AS (SELECT item_id, text FROM benchmark),
item_terms AS ({counted(tokens("text"), "items", "item_id")}),
pairs AS (
  SELECT doc_id AS item_id, string_agg(term, ' ' ORDER BY term) AS q FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tf DESC, term) AS rank
    FROM item_terms) WHERE rank <= 2 GROUP BY doc_id),
queries AS (
  SELECT item_id * 3 AS query_id, text AS q, 'or' AS mode,
    CASE item_id % 3 WHEN 1 THEN 5 WHEN 2 THEN 25 END AS lim FROM items
  UNION ALL
  SELECT item_id * 3 + 1, q, 'and', CASE item_id % 2 WHEN 1 THEN 10 END FROM pairs
  UNION ALL
  SELECT item_id * 3 + 2, regexp_replace(text, '[\p{{L}}\p{{N}}]', '', 'g'), 'and', NULL
  FROM items),
cut AS (SELECT *, {tokens("q")} AS terms FROM queries),
words AS (
  SELECT query_id, mode, lim, len(list_distinct(terms)) AS k,
    unnest(list_distinct(terms)) AS term FROM cut),
matched AS (
  SELECT query_id, lim, doc_id FROM words JOIN postings USING (term)
  GROUP BY query_id, mode, lim, k, doc_id HAVING mode = 'or' OR count(*) = k),
hits AS (
  SELECT query_id, doc_id, lim FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY doc_id) AS rank FROM matched)
  WHERE lim IS NULL OR rank <= lim)
"""

REJECT = r"""
CASE WHEN title IS NULL OR NOT regexp_matches(title, '[^\s\x{a0}]') THEN 'title is required'
  WHEN body IS NULL OR NOT regexp_matches(body, '[^\s\x{a0}]') THEN 'body is required' END
"""

BATCH = """
batch AS (
  SELECT doc_id,
    CASE source WHEN 'src3' THEN ' ' || chr(9) || chr(160) WHEN 'src5' THEN NULL
      ELSE source END AS title,
    CASE WHEN lang = 'es' THEN chr(10) ELSE text END AS body
  FROM documents)
"""


def generated() -> str:
    """The generator's draws in SQL."""
    word = (
        "'w' || ((((a + {i} * b) % 2147483647) * ((a + {i} * b) % 2147483647)) "
        "% 2147483647 % 2000)"
    )

    def words(first: int, length: str, places: list[str]) -> str:
        hit = " OR ".join(f"i = {place}" for place in places)
        draw = word.format(i=f"(i + {first})")
        return (
            f"array_to_string(list_transform(range({length}), "
            f"lambda i: CASE WHEN {hit} THEN topic ELSE {draw} END), ' ')"
        )

    parts = ", ".join(
        f"CAST('0x' || substring(digest, {1 + 7 * i}, 7) AS BIGINT) AS {name}"
        for i, name in enumerate("abcd")
    )
    body_places = [f"((c + {k} * d) % 2147483647) % body_length" for k in (1, 2, 3)]
    return f"""
WITH digests AS (
  SELECT doc_id AS number, md5('smoke|' || doc_id) AS digest FROM documents),
drawn AS (SELECT number, {parts} FROM digests),
sized AS (
  SELECT *, ['alpha', 'beta', 'gamma', 'delta', 'epsilon'][c % 5 + 1] AS topic,
    4 + (c // 5) % 7 AS title_length, 60 + d % 121 AS body_length FROM drawn)
SELECT number, 'doc_' || CASE WHEN length(CAST(number AS VARCHAR)) < 8
    THEN lpad(CAST(number AS VARCHAR), 8, '0') ELSE CAST(number AS VARCHAR) END AS external_id,
  {words(0, "title_length", ["(d // 1000) % title_length"])} AS title,
  {words(10, "body_length", body_places)} AS body
FROM sized
"""


ORACLES: dict[str, str] = {
    "postings_unicode": POSTINGS,
    "postings_simple": counted(f"regexp_extract_all(lower(text), {WORD})"),
    "postings_ascii": f"""
SELECT term, doc_id, CAST(count(*) AS INTEGER) AS tf FROM (
  SELECT doc_id, lower(unnest(regexp_split_to_array(source || ' ' || text, '[^A-Za-z0-9]+')))
    AS term FROM documents)
WHERE term <> '' GROUP BY term, doc_id""",
    "token_positions": f"""
SELECT doc_id, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS position, unnest(t) AS token
FROM (SELECT doc_id, {tokens("text")} AS t FROM documents)""",
    "normalized_text": rf"""
SELECT doc_id, trim(regexp_replace(lower({prepared("text")}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))
  AS normalized FROM documents""",
    "normalized_apostrophes": rf"""
SELECT page_id AS doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  translate(lower(nfc_normalize(html)), '’‘ʼ', ''''''''),
  '[^\p{{L}}\p{{N}}'']+', ' ', 'g'),
  '(^|[^\p{{L}}\p{{N}}])''+|''+([^\p{{L}}\p{{N}}]|$)', '\1\2', 'g'),
  '''+', '''', 'g'), ' +', ' ', 'g')) AS normalized FROM pages""",
    "tokens_nostop": f"SELECT * FROM ({POSTINGS}) WHERE term NOT IN ({quoted(DEFAULT_STOPWORDS)})",
    "tokens_custom_stopwords": (
        f"SELECT * FROM ({POSTINGS}) WHERE term NOT IN ({quoted(CUSTOM_STOPWORDS)})"
    ),
    "tokens_minlen": f"SELECT * FROM ({POSTINGS}) WHERE length(term) >= 4",
    "tokens_fold": counted(f"regexp_extract_all(lower(strip_accents(text)), {WORD})"),
    "tokens_cased": counted(f"regexp_extract_all({prepared('text')}, {WORD})"),
    "conversation_postings": counted(tokens("text"), "conversations", "conv_id"),
    "corpus_scan": "SELECT page_id AS doc_id, html AS text FROM pages WHERE page_id > -1",
    "sanitized_postings": f"""
SELECT term, doc_id, CASE WHEN doc_id % 3 = 2 THEN tf + 1 ELSE 0 END AS tf FROM ({POSTINGS})""",
    "posting_blocks": f"""{WITH}
SELECT term, doc_id // 100 AS block, string_agg(doc_id || ':' || tf, ',' ORDER BY doc_id)
  AS postings FROM postings GROUP BY term, doc_id // 100""",
    "corpus_stats": f"""{WITH}
SELECT (SELECT count(*) FROM documents) AS doc_count,
  (SELECT count(DISTINCT term) FROM postings) AS term_count""",
    "row_count": "SELECT CAST(count(*) AS INTEGER) AS n FROM documents",
    "term_sample": f"""{WITH}
SELECT term, doc_id, tf FROM (
  SELECT *, row_number() OVER (PARTITION BY term ORDER BY doc_id) AS rank
  FROM postings WHERE term IN (SELECT DISTINCT term FROM postings ORDER BY term LIMIT 10))
WHERE rank <= 5""",
    "term_lookup": f"{WITH} SELECT * FROM postings WHERE term IN ('the', 'der', 'nosuchterm')",
    "terms_lookup": f"""{WITH}
SELECT * FROM postings WHERE term IN (SELECT unnest({tokens("text")}) FROM benchmark)""",
    "hit_documents": f"""{WITH}
SELECT p.doc_id, quality, toxic FROM postings p LEFT JOIN labels l ON l.doc_id = p.doc_id
WHERE p.term = 'the'""",
    "existing_documents": f"""{WITH}
SELECT DISTINCT doc_id FROM postings
WHERE term IN ('the', 'der') AND doc_id IN (SELECT doc_id FROM labels)""",
    "document_lookup": """
SELECT l.doc_id, quality, text FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id""",
    "recent_events": """
SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 20""",
    "recent_events_cut": """
SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 5000""",
    "first_documents": "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 5",
    "search_and": f"{WITH} {having_all(['the', 'of'], 2)}",
    "search_or": f"{WITH} SELECT DISTINCT doc_id FROM postings WHERE term IN ('the', 'of')",
    "search_limit": f"{WITH} {having_all(['the', 'of'], 2)} ORDER BY doc_id LIMIT 25",
    "hits_intersection": f"""{WITH}
SELECT doc_id FROM postings WHERE term = 'the'
INTERSECT SELECT doc_id FROM postings WHERE term = 'of'""",
    "hits_union": f"""{WITH}
SELECT doc_id FROM postings WHERE term = 'the'
UNION SELECT doc_id FROM postings WHERE term = 'der'""",
    "search_response": f"""{WITH}, hits AS ({having_all(["the", "of"], 2)})
SELECT 'of the of' AS q, 'and' AS mode, 'of the of' AS terms,
  (SELECT count(*) FROM hits) AS count, doc_id // 100 AS page,
  string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS doc_ids
FROM hits GROUP BY doc_id // 100""",
    "search_snippets": f"""{WITH},
hits AS (SELECT DISTINCT doc_id FROM postings WHERE term IN ('the', 'of'))
SELECT (SELECT count(*) FROM hits) AS count, doc_id, {snippet("text", ["the", "of"])} AS snippet
FROM hits JOIN documents USING (doc_id)""",
    "term_topk": f"""{WITH}
SELECT d.doc_id, d.source, tf FROM postings p JOIN documents d ON d.doc_id = p.doc_id
WHERE term = 'the' ORDER BY tf DESC, d.doc_id LIMIT 10""",
    "snippets": f"SELECT doc_id, {snippet('text', ['the', 'und'])} AS snippet FROM documents",
    "batch_search": f"{WITH}, {QUERIES_SQL} SELECT query_id, doc_id FROM hits",
    "batch_responses": f"""{WITH}, {QUERIES_SQL},
totals AS (SELECT query_id, count(*) AS n FROM hits GROUP BY query_id),
pages AS (
  SELECT query_id, doc_id // 100 AS page,
    string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS doc_ids
  FROM hits GROUP BY 1, 2)
SELECT c.query_id, mode, CAST(len(terms) AS BIGINT) AS term_count, coalesce(n, 0) AS count,
  coalesce(page, 0) AS page, coalesce(doc_ids, '') AS doc_ids
FROM cut c LEFT JOIN totals t ON t.query_id = c.query_id
  LEFT JOIN pages p ON p.query_id = c.query_id""",
    "request_checks": """
WITH requests AS (
  SELECT event_id AS query_id, event_type AS q,
    CASE user_id % 4 WHEN 0 THEN 'and' WHEN 1 THEN 'or' WHEN 2 THEN 'and' END AS mode,
    CASE WHEN value < 5 THEN 'none' WHEN value < 15 THEN 'bad' ELSE 'good' END AS kind, value
  FROM events)
SELECT query_id, q, mode, CASE kind WHEN 'good' THEN CAST(floor(value) AS BIGINT) END AS limit,
  CASE WHEN mode IS NULL THEN 'invalid_mode' WHEN kind = 'bad' THEN 'invalid_limit' END AS reason
FROM requests""",
    "ingest_valid": f"WITH {BATCH} SELECT * FROM batch WHERE ({REJECT}) IS NULL",
    "ingest_rejects": f"""
WITH {BATCH} SELECT doc_id, reason FROM (SELECT doc_id, {REJECT} AS reason FROM batch)
WHERE reason IS NOT NULL""",
    "inserted_documents": """
SELECT 1000 + row_number() OVER (ORDER BY doc_id) AS id,
  'doc_' || lpad(CAST(doc_id AS VARCHAR), 8, '0') AS external_id, source AS title, text AS body,
  TIMESTAMP '2024-01-01 00:00:00' AS created_at
FROM documents""",
    "upserted_documents": """
WITH existing AS (
  SELECT doc_id + 1 AS id, CASE WHEN lang <> 'de'
    THEN 'doc_' || lpad(CAST(doc_id * 2 AS VARCHAR), 8, '0') END AS external_id,
    source AS title, text AS body FROM documents),
changes AS (
  SELECT 'doc_' || lpad(CAST(page_id AS VARCHAR), 8, '0') AS external_id, url, html FROM pages)
SELECT id, e.external_id, coalesce(url, title) AS title, coalesce(html, body) AS body
FROM existing e LEFT JOIN changes c ON c.external_id = e.external_id
UNION ALL
SELECT (SELECT max(id) FROM existing) + row_number() OVER (ORDER BY c.external_id),
  c.external_id, url, html
FROM changes c LEFT JOIN existing e ON c.external_id = e.external_id
WHERE e.external_id IS NULL""",
    "json_batches": """
SELECT true AS is_object, CASE WHEN lang <> 'es' THEN source END AS title, text AS body
FROM documents""",
    "generated_corpus": generated(),
    "incremental_index": POSTINGS,
    "index_statistics": f"""{WITH}
SELECT count(*) AS doc_count, (SELECT count(*) FROM postings) AS posting_count,
  max(doc_id) AS max_doc_id FROM documents""",
    "json_index": POSTINGS,
    "streamed_index": POSTINGS,
    "index_checks": f"""{WITH}
SELECT 'term' AS rule, count(*) FILTER (WHERE term IS NULL OR term = '') AS violations
FROM postings WHERE doc_id < 500
UNION ALL SELECT 'doc_id', count(*) FILTER (WHERE doc_id < 1) FROM postings WHERE doc_id < 500
UNION ALL SELECT 'tf', count(*) FILTER (WHERE tf < 1) FROM postings WHERE doc_id < 500
UNION ALL SELECT 'expected_term:' || t, CASE WHEN t IN (SELECT term FROM postings WHERE doc_id < 500)
  THEN 0 ELSE 1 END FROM (VALUES ('the'), ('of'), ('nosuchterm')) v(t)
UNION ALL SELECT 'duplicate_posting', count(*) - count(DISTINCT (term, doc_id)) FROM postings WHERE doc_id < 500
UNION ALL SELECT 'doc_count', CASE WHEN count(*) = count(*) FILTER (WHERE doc_id < 500)
  THEN 0 ELSE 1 END FROM documents""",
    "block_checks": f"""{WITH},
blocks AS (
  SELECT CASE doc_id // 100 % 3 WHEN 0 THEN list(doc_id ORDER BY doc_id) WHEN 1 THEN []
    ELSE list(doc_id ORDER BY doc_id DESC) END AS ids
  FROM postings GROUP BY term, doc_id // 100)
SELECT 'empty_block' AS rule, count(*) FILTER (WHERE len(ids) < 1) AS violations FROM blocks
UNION ALL SELECT 'ascending', count(*) FILTER (WHERE ids <> list_sort(ids)) FROM blocks""",
    "required_fields": """
WITH wanted AS (SELECT d.doc_id, text, quality FROM documents d
  LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT 'doc_id' AS rule, count(*) - count(doc_id) AS violations FROM wanted
UNION ALL SELECT 'text', count(*) - count(text) FROM wanted
UNION ALL SELECT 'quality', count(*) - count(quality) FROM wanted""",
    "id_differences": """
SELECT doc_id, 'unexpected' AS side FROM (
  SELECT doc_id FROM documents EXCEPT ALL SELECT doc_id FROM labels)
UNION ALL
SELECT doc_id, 'missing' FROM (
  SELECT doc_id FROM labels EXCEPT ALL SELECT doc_id FROM documents)""",
    "index_freshness": f"""{WITH}
SELECT count(*) AS stored_postings, count(*) AS rebuilt_postings,
  count(*) = count(DISTINCT (term, doc_id, tf)) AS fresh FROM postings""",
    "index_staleness": f"""{WITH}
SELECT count(*) AS stored_postings, count(*) + (
    SELECT count(*) FROM documents d WHERE doc_id % 10 = 0 AND NOT EXISTS (
      SELECT 1 FROM postings p WHERE p.doc_id = d.doc_id AND p.term = 'of')) AS rebuilt_postings,
  false AS fresh FROM postings""",
    "index_fingerprint": f"""{WITH}
SELECT count(*) AS postings, CAST(coalesce(sum(CAST(concat('0x',
  substr(sha256(concat_ws('|', term, doc_id, tf)), 1, 15)) AS BIGINT)), 0) AS VARCHAR) AS hash_sum
FROM postings""",
    "upsert_rejects": """
SELECT 'doc_' || lpad(CAST(page_id AS VARCHAR), 8, '0') AS external_id,
  CASE WHEN page_id % 5 = 0 THEN 'title is null' ELSE 'body is null' END AS reason
FROM pages WHERE page_id % 5 = 0 OR page_id % 7 = 0""",
    "term_topk_texts": f"""{WITH}
SELECT d.*, tf FROM postings p JOIN documents d ON d.doc_id = p.doc_id
WHERE term = 'of' ORDER BY tf DESC, d.doc_id LIMIT 5""",
    "search_folded_index": """
SELECT doc_id FROM documents WHERE list_contains(
  string_split_regex(strip_accents(lower(text)), '[^\\p{L}\\p{N}]+'), 'ere')""",
    "search_ascii_index": """
SELECT doc_id FROM documents WHERE list_has_all(
  string_split_regex(lower(text), '[^a-z0-9]+'), ['the', 'of'])""",
    "document_lookup_by_id": "SELECT * FROM documents WHERE doc_id = 77",
    "latency_summary": """
SELECT event_type AS term, count(*) AS n, quantile_disc(value, 0.5) AS p50,
  quantile_disc(value, 0.95) AS p95, min(value) AS min, max(value) AS max
FROM events WHERE value IS NOT NULL GROUP BY event_type""",
}
