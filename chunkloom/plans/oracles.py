"""The same results as plain SQL over the shared tables, for checking the Spark queries."""

from __future__ import annotations

CHUNKS = """
base AS (
  SELECT coalesce(d.doc_id, e.vec_id) AS id, d.text, d.n_chars, e.embedding, e.label
  FROM documents d FULL OUTER JOIN embeddings e ON d.doc_id = e.vec_id
),
chunks AS (
  SELECT CAST(b.id AS VARCHAR) AS chunk_id,
         concat('doc_', CAST(b.id // 10 AS VARCHAR), '.txt') AS filename,
         b.text AS content,
         CAST(0 AS BIGINT) AS original_span_start, b.n_chars AS original_span_end,
         CASE WHEN b.id % 10 = 0 THEN 0 WHEN b.id % 10 <= 3 THEN 1 ELSE 2 END AS hierarchy_level,
         CASE WHEN b.id % 10 = 0 THEN NULL
              WHEN b.id % 10 <= 3 THEN CAST(b.id - b.id % 10 AS VARCHAR)
              ELSE CAST(b.id - b.id % 10 + 1 + (b.id % 10) % 3 AS VARCHAR) END AS parent_id,
         r.lang AS language, r.source AS source, string_split(r.source, 'c') AS tags,
         b.label AS label, l.quality AS quality,
         CAST(b.embedding AS DOUBLE[]) AS v,
         concat('tenant_', CAST((b.id // 10) % 3 AS VARCHAR)) AS tenant
  FROM base b
  LEFT JOIN documents r ON r.doc_id = b.id - b.id % 10
  LEFT JOIN labels l ON l.doc_id = b.id
),
requests AS (
  SELECT CAST(vec_id AS VARCHAR) AS request_id, CAST(embedding AS DOUBLE[]) AS q, label AS asked
  FROM embeddings
)
"""

PLAIN = (
    "chunk_id, filename, hierarchy_level, parent_id, original_span_end, language, label, tenant"
)
STORED = (
    "chunk_id, tenant, filename, hierarchy_level, md5(content) AS content_md5, "
    "v IS NOT NULL AS has_vectors"
)
COSINE = "greatest(list_cosine_distance(q, v), 0.0)"


def _total(a: str, b: str, term: str) -> str:
    pairs = f"[{term} FOR p IN list_zip({a}, {b})]"
    return f"list_sum({pairs})"


DOT = "-list_inner_product(q, v)"
L2 = _total("q", "v", "(p[1] - p[2]) * (p[1] - p[2])")
MANHATTAN = _total("q", "v", "abs(p[1] - p[2])")
HAMMING = _total("q", "v", "CASE WHEN (p[1] > 0) = (p[2] > 0) THEN 0.0 ELSE 1.0 END::DOUBLE")


def _with(body: str, *tables: str) -> str:
    return "WITH " + ",\n".join([CHUNKS, *tables]) + "\n" + body


def _pairs(distance: str = COSINE, condition: str = "TRUE") -> str:
    return f"""
scored AS (
  SELECT request_id, asked, chunk_id, tenant, filename, parent_id, hierarchy_level, language, source,
         label, original_span_end, v,
         {distance} AS distance
  FROM requests JOIN chunks ON v IS NOT NULL AND ({condition})
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY distance, chunk_id, tenant) AS rank
  FROM scored WHERE distance IS NOT NULL
)"""


def _hits(distance: str = COSINE, top: str = "rank <= 10") -> str:
    return _with(
        f"SELECT request_id, chunk_id, round(distance, 6) AS distance, rank FROM ranked WHERE {top}",
        _pairs(distance),
    )


def _filter(condition: str) -> str:
    return _with(f"SELECT chunk_id, filename, hierarchy_level FROM chunks WHERE {condition}")


FILTERS = {
    "filter_eq": "language = 'en'",
    "filter_ne": "language <> 'en'",
    "filter_lt": "label < 4",
    "filter_le": "label <= 4",
    "filter_gt": "label > 4",
    "filter_ge": "label >= 4",
    "filter_contains": "list_has_any(tags, ['10', '12'])",
    "filter_in": "label IN (1, 3, 5)",
    "filter_not_in": "label NOT IN (1, 3, 5)",
    "filter_like": "source LIKE 's%c1%'",
    "filter_all": "language = 'en' AND label >= 5",
    "filter_any": "language = 'fr' OR quality = 1",
    "filter_all_any": (
        "hierarchy_level >= 1 AND language <> 'de' AND (quality = 0 OR label IN (2, 7))"
    ),
}

REQUEST_FILTER = """
CASE WHEN asked < 3 THEN language = 'en'
     WHEN asked < 6 THEN label >= 2 AND source LIKE 'src1%'
     WHEN asked < 8 THEN tenant = 'tenant_2'
     ELSE (language = 'fr' OR quality = 1)
          AND hierarchy_level = (SELECT max(hierarchy_level) FROM chunks) END
"""


def _documents(condition: str, top: int) -> str:
    return _with(
        f"""
SELECT request_id, filename, min(rank * 2) AS first_place, first(language) AS language,
       string_agg(chunk_id, ',' ORDER BY rank) AS chunk_ids
FROM ranked WHERE rank <= {top} GROUP BY request_id, filename""",
        _pairs(COSINE, condition),
    )


ENTRIES = """
entries AS (
  SELECT chunk_id, 'document_metadata.language' AS path, language AS value FROM chunks
  UNION ALL SELECT chunk_id, 'document_metadata.source', source FROM chunks
  UNION ALL SELECT chunk_id, 'custom_properties.label', CAST(label AS VARCHAR) FROM chunks
  UNION ALL SELECT chunk_id, 'custom_properties.quality', CAST(quality AS VARCHAR) FROM chunks
  UNION ALL SELECT chunk_id, 'custom_properties.tags',
                   '["' || array_to_string(tags, '","') || '"]' FROM chunks
)"""

AUTO_CUT = """
bulges AS (
  SELECT *, (distance - min(distance) OVER w) / nullif(max(distance) OVER w - min(distance) OVER w, 0)
            - CAST(rank - 1 AS DOUBLE) / nullif(max(rank) OVER w - 1, 0) AS bulge
  FROM ranked WHERE {top} WINDOW w AS (PARTITION BY request_id)
),
starts AS (
  SELECT *, CASE WHEN bulge > lag(bulge) OVER w
                  AND bulge > coalesce(lead(bulge) OVER w, lag(bulge, 2) OVER w)
                 THEN 1 ELSE 0 END AS starting
  FROM bulges WINDOW w AS (PARTITION BY request_id ORDER BY rank)
),
groups AS (
  SELECT *, sum(starting) OVER (PARTITION BY request_id ORDER BY rank) AS cut_group FROM starts
)"""


def _auto_cut(top: str) -> str:
    return _with(
        "SELECT request_id, chunk_id, round(distance, 6) AS distance, rank FROM groups "
        "WHERE cut_group < asked % 3 + 1",
        _pairs(),
        AUTO_CUT.format(top=top),
    )


PARENTS = """
hits AS (SELECT * FROM ranked WHERE rank <= 10),
parents AS (
  SELECT h.request_id, h.tenant, h.parent_id AS chunk_id, min(h.rank) AS rank
  FROM hits h WHERE h.parent_id IS NOT NULL GROUP BY h.request_id, h.tenant, h.parent_id
),
parent_rows AS (
  SELECT p.request_id, p.chunk_id, p.rank * 2 + 1 AS place, TRUE AS is_parent, c.hierarchy_level
  FROM parents p JOIN chunks c ON c.chunk_id = p.chunk_id AND c.tenant = p.tenant
)"""

# Words over the whole text, as lower-cased runs of letters and digits.
TEXTS = r"""
texts AS (
  SELECT chunk_id, tenant,
         list_filter(regexp_split_to_array(lower(content), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS words
  FROM chunks WHERE content IS NOT NULL
),
queries AS (
  SELECT CAST(item_id AS VARCHAR) AS request_id,
         list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS words
  FROM benchmark
)"""

BM25 = """
sizes AS (SELECT chunk_id, len(words) AS dl FROM texts),
corpus_size AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM sizes),
postings AS (
  SELECT chunk_id, word, count(*) AS tf
  FROM (SELECT chunk_id, unnest(words) AS word FROM texts) GROUP BY chunk_id, word
),
frequency AS (SELECT word, count(*) AS df FROM postings GROUP BY word),
asked_words AS (SELECT request_id, unnest(list_distinct(words)) AS word FROM queries),
text_scores AS (
  SELECT a.request_id, p.chunk_id,
         round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
               / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 9) AS score
  FROM asked_words a JOIN postings p USING (word) JOIN frequency USING (word)
  JOIN sizes s ON s.chunk_id = p.chunk_id, corpus_size
  GROUP BY a.request_id, p.chunk_id
)"""

HYBRID = """
both_requests AS (
  SELECT q.request_id, r.q,
         CASE WHEN CAST(q.request_id AS INT) % 2 = 0 THEN 0.3 ELSE 0.5 END AS alpha
  FROM queries q JOIN requests r USING (request_id)
),
eligible AS (
  SELECT b.request_id, b.alpha, c.chunk_id, c.tenant,
         CASE WHEN c.v IS NOT NULL THEN 1 - list_cosine_distance(b.q, c.v) END AS near,
         coalesce(t.score, 0) AS text
  FROM both_requests b JOIN chunks c ON TRUE
  LEFT JOIN text_scores t ON t.request_id = b.request_id AND t.chunk_id = c.chunk_id
  WHERE c.v IS NOT NULL OR t.score > 0
),
scaled AS (
  SELECT request_id, chunk_id, tenant, alpha,
         coalesce((near - min(near) OVER w) / nullif(max(near) OVER w - min(near) OVER w, 0), 0) AS a,
         coalesce((text - min(text) OVER w) / nullif(max(text) OVER w - min(text) OVER w, 0), 0) AS b
  FROM eligible WINDOW w AS (PARTITION BY request_id)
),
blended AS (
  SELECT *, round(alpha * a + (1 - alpha) * b, 9) AS score FROM scaled
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, chunk_id, tenant) AS rank
  FROM blended
)"""

HASHED = """
word_counts AS (
  SELECT owner, id, CAST(('0x' || substr(md5(word), 1, 7)) AS BIGINT) % 64 AS bucket
  FROM (SELECT 'chunk' AS owner, chunk_id AS id, unnest(words) AS word FROM texts
        UNION ALL SELECT 'query', request_id, unnest(words) FROM queries)
),
counted AS (SELECT owner, id, bucket, CAST(count(*) AS DOUBLE) AS n FROM word_counts GROUP BY ALL),
lengths AS (SELECT owner, id, sqrt(sum(n * n)) AS size FROM counted GROUP BY ALL),
products AS (
  SELECT q.id AS request_id, c.id AS chunk_id, sum(q.n * c.n) AS product
  FROM counted q JOIN counted c ON q.bucket = c.bucket AND q.owner = 'query' AND c.owner = 'chunk'
  GROUP BY ALL
),
near AS (
  SELECT lq.id AS request_id, lc.id AS chunk_id,
         greatest(1 - coalesce(product, 0) / (lq.size * lc.size), 0.0) AS distance
  FROM lengths lq JOIN lengths lc ON lq.owner = 'query' AND lc.owner = 'chunk'
  LEFT JOIN products p ON p.request_id = lq.id AND p.chunk_id = lc.id
),
near_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY distance, chunk_id) AS rank FROM near
)"""

UPSERT = """
incoming AS (
  SELECT chunk_id, tenant, filename, hierarchy_level, concat('revised ', content) AS content,
         CAST(0 AS BIGINT) AS position
  FROM chunks WHERE quality IS NOT NULL AND content IS NOT NULL
  UNION ALL
  SELECT chunk_id, tenant, filename, hierarchy_level, NULL, CAST(0 AS BIGINT)
  FROM chunks WHERE quality IS NOT NULL AND content IS NULL
  UNION ALL
  SELECT concat('talk_', CAST(conv_id AS VARCHAR)), concat('tenant_', CAST(conv_id % 3 AS VARCHAR)),
         concat('talk_', CAST(conv_id AS VARCHAR), '.txt'), 0, text, turn
  FROM conversations
),
latest AS (
  SELECT * FROM incoming
  QUALIFY row_number() OVER (
    PARTITION BY tenant, chunk_id ORDER BY hierarchy_level DESC, position DESC, content DESC) = 1
)"""
LATEST = (
    "SELECT chunk_id, tenant, filename, hierarchy_level, md5(content) AS content_md5, "
    "FALSE AS has_vectors FROM latest"
)
NOT_LATEST = "NOT EXISTS (SELECT 1 FROM latest l WHERE l.chunk_id = c.chunk_id AND l.tenant = c.tenant)"

PRESENT = f"""
present AS (
  SELECT chunk_id, tenant, content FROM chunks c WHERE {NOT_LATEST}
  UNION ALL SELECT chunk_id, tenant, content FROM latest
)"""
PRESENT_TEXTS = TEXTS.replace("FROM chunks WHERE", "FROM present WHERE")

STORED_BM25 = r"""
current AS (
  SELECT chunk_id, tenant, content FROM chunks c WHERE """ + NOT_LATEST + r""" AND language IS DISTINCT FROM 'fr'
  UNION ALL
  SELECT l.chunk_id, l.tenant, l.content FROM latest l LEFT JOIN chunks c USING (chunk_id, tenant)
  WHERE c.language IS DISTINCT FROM 'fr'
),
stored_words AS (
  SELECT chunk_id, tenant,
         list_filter(regexp_split_to_array(lower(content), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS words
  FROM current WHERE content IS NOT NULL
),
scopes AS (
  SELECT request_id, words,
         CASE WHEN CAST(request_id AS INT) % 2 = 1
              THEN concat('tenant_', CAST(CAST(request_id AS INT) % 3 AS VARCHAR)) ELSE '*' END AS scope
  FROM queries
),
scoped_words AS (
  SELECT *, tenant AS scope FROM stored_words UNION ALL SELECT *, '*' FROM stored_words
),
scope_sizes AS (SELECT scope, count(*) AS n, avg(len(words)) AS avgdl FROM scoped_words GROUP BY scope),
scope_postings AS (
  SELECT scope, chunk_id, tenant, word, dl, count(*) AS tf
  FROM (SELECT scope, chunk_id, tenant, len(words) AS dl, unnest(words) AS word FROM scoped_words)
  GROUP BY ALL
),
scope_frequency AS (SELECT scope, word, count(*) AS df FROM scope_postings GROUP BY scope, word),
asked_scopes AS (SELECT request_id, scope, unnest(list_distinct(words)) AS word FROM scopes),
stored_scores AS (
  SELECT request_id, tenant, chunk_id,
         round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
               / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 9) AS score
  FROM asked_scopes JOIN scope_postings USING (scope, word) JOIN scope_frequency USING (scope, word)
  JOIN scope_sizes USING (scope)
  GROUP BY request_id, tenant, chunk_id
)"""

READ_BACK = "SELECT chunk_id, language, source, label, {quality} AS quality, array_to_string(tags, '|') AS tags FROM chunks"


def _kept(condition: str) -> str:
    return _with(f"SELECT {STORED} FROM chunks WHERE NOT coalesce({condition}, FALSE)")


ORACLES: dict[str, str] = {
    "vector_search": _documents(REQUEST_FILTER, 10),
    "scan_collection": _with(f"SELECT {PLAIN} FROM chunks"),
    "scan_tenant": _with(f"SELECT {PLAIN} FROM chunks WHERE tenant = 'tenant_1'"),
    "ingest_explode": _with(f"SELECT {PLAIN} FROM chunks"),
    "request_defaults": """
SELECT CAST(vec_id AS VARCHAR) AS request_id,
       CASE WHEN label < 3 THEN 'dot' ELSE 'manhattan' END AS method,
       CASE WHEN label % 2 = 0 THEN label ELSE 12 END AS top,
       CAST(0.75 AS DOUBLE) AS horizon, 'default' AS vector_name,
       CASE WHEN label = 9 THEN 'replace' END AS parent_strategy,
       FALSE AS include_vector, CAST(len(embedding) AS INT) AS dimensions
FROM embeddings""",
    "result_json": _with("""
SELECT request_id, min(rank * 2) AS first_place, filename, first(source) AS source,
       string_agg(chunk_id, ',' ORDER BY rank) AS chunk_ids,
       CASE WHEN count(original_span_end) = count(*) THEN CAST(sum(original_span_end) AS BIGINT) END AS span_ends,
       round(sum(list_sum(v)), 5) AS vector_total
FROM ranked WHERE rank <= 5 GROUP BY request_id, filename""", _pairs()),
    "chunk_properties": _with("""
SELECT chunk_id, filename, md5(content) AS content_md5, original_span_start, original_span_end,
       hierarchy_level, source, quality, CAST(len(v) AS INT) AS vector_size FROM chunks"""),
    "flatten_properties": _with("""
SELECT chunk_id, path, concat('property_', md5(path)) AS flat_name, value
FROM entries WHERE value IS NOT NULL""", ENTRIES),
    "flatten_variant": """
SELECT event_id, 'kind' AS path, event_type AS value FROM events
UNION ALL
SELECT event_id, concat('more.props.', k), json_extract_string(props, concat('$.', k))
FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""",
    "flatten_deep": """
SELECT event_id, concat('a0.a1.a2.a3.a4.a5.a6.a7.a8.a9.a10.a11.', k) AS path,
       json_extract_string(props, concat('$.', k)) AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""",
    "unflatten_deep": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "unflatten_types": """
SELECT event_id, CAST(ts AS DATE) AS day, value, user_id AS who, 'DATE' AS day_kind, 'DOUBLE' AS value_kind
FROM events""",
    "filter_variant_bigint": "SELECT event_id FROM events WHERE event_id % 5 = 1",
    "filter_none": _filter("TRUE"),
    "uuid_normalise": """
SELECT doc_id, CAST(CAST(md5(text) AS UUID) AS VARCHAR) AS uuid FROM documents""",
    "native_distance": _with(
        "SELECT chunk_id, round(distance, 6) AS distance FROM ranked WHERE request_id = '0' AND rank <= 50", _pairs(L2)
    ),
    "knn_tiles": _hits(),
    "search_stored": _with("""
SELECT request_id, filename, min(rank * 2) AS first_place, string_agg(chunk_id, ',' ORDER BY rank) AS chunk_ids
FROM ranked WHERE rank <= 5 GROUP BY request_id, filename""",
        _pairs(COSINE, "tenant = concat('tenant_', CAST(asked % 3 AS VARCHAR))")),
    "delete_emptied": _kept("NOT (tenant = 'tenant_2' OR filename = 'doc_1.txt')"),
    "describe_collection": _with("""
SELECT TRUE AS multi_tenancy, property, type, nr_chunks
FROM (VALUES ('chunk_id', 'string'), ('content', 'string'), ('hierarchy_level', 'int')) AS p(property, type),
     (SELECT count(*) AS nr_chunks FROM chunks)"""),
    "drop_collection": _kept("tenant <> 'tenant_2'"),
    "flat_name": """
SELECT doc_id, concat('property_', md5(concat('document_metadata.', source))) AS flat_name,
       concat('property_', md5(concat(lang, '.', source))) AS parts_name
FROM documents""",
    "unflatten_properties": _with(READ_BACK.format(quality="quality")),
    "unmap_properties": _with(READ_BACK.format(quality="CAST(NULL AS INT)")),
    "filter_variant": """
SELECT event_id FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events)
WHERE k >= 40 AND k NOT IN (50, 60) AND (k < 70 OR k = 90)""",
    "named_vector": _with("""
SELECT chunk_id, CAST(len(vector) AS INT) AS dimensions, round(list_sum(vector), 6) AS total
FROM (SELECT chunk_id, CASE WHEN hierarchy_level = 0 THEN v[1:8] ELSE v END AS vector FROM chunks)
WHERE vector IS NOT NULL"""),
    "include_vector": _with("""
SELECT request_id, chunk_id, rank,
       CASE WHEN asked % 2 = 0 THEN round(list_sum(v), 6) END AS vector_total
FROM ranked WHERE rank <= 3""", _pairs()),
    **{name: _filter(condition) for name, condition in FILTERS.items()},
    "level_abs": _with("SELECT chunk_id, hierarchy_level FROM chunks WHERE hierarchy_level = 1"),
    "level_from_bottom": _with("""
SELECT chunk_id, hierarchy_level FROM chunks
WHERE hierarchy_level = (SELECT max(hierarchy_level) - 1 FROM chunks)"""),
    "max_level": _with("SELECT max(hierarchy_level) AS max_level FROM chunks"),
    "chunks_per_level": _with("""
SELECT hierarchy_level, count(*) AS nr_chunks, count(DISTINCT filename) AS nr_files
FROM chunks GROUP BY hierarchy_level"""),
    "knn_cosine": _hits(),
    "knn_dot": _hits(DOT),
    "knn_l2": _hits(L2),
    "knn_manhattan": _hits(MANHATTAN),
    "knn_hamming": _hits(HAMMING),
    "knn_topk": _hits(top="rank <= asked + 1"),
    "knn_horizon": _hits(top="distance <= 0.5 + asked / 20.0"),
    "knn_autocut": _auto_cut("rank <= 50"),
    "knn_autocut_unlimited": _auto_cut("TRUE"),
    "group_by_file": _documents("TRUE", 40),
    "parent_replace": _with("SELECT * FROM parent_rows", _pairs(), PARENTS),
    "parent_include": _with("""
SELECT * FROM parent_rows
UNION ALL
SELECT request_id, chunk_id, rank * 2, FALSE, hierarchy_level FROM hits""", _pairs(), PARENTS),
    "text_search": _with("""
SELECT request_id, chunk_id, round(distance, 6) AS distance, rank FROM near_ranked
WHERE rank <= 10""", TEXTS, HASHED),
    "text_search_stored": _with("""
SELECT request_id, chunk_id, round(distance, 6) AS distance, rank FROM near_ranked
WHERE rank <= 10""", UPSERT, PRESENT, PRESENT_TEXTS, HASHED),
    "bm25": _with("""
SELECT request_id, chunk_id, round(score, 6) AS score, rank
FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, chunk_id) AS rank
      FROM text_scores) WHERE rank <= 10""", TEXTS, BM25),
    "bm25_stored": _with("""
SELECT request_id, tenant, chunk_id, round(score, 6) AS score, rank
FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, chunk_id, tenant) AS rank
      FROM stored_scores) WHERE rank <= 10""", TEXTS, UPSERT, STORED_BM25),
    "hybrid_search": _with("""
SELECT request_id, chunk_id, round(score, 6) AS score, rank FROM placed WHERE rank <= 10""",
        TEXTS, BM25, HYBRID),
    "upsert_rows": _with(
        f"SELECT {STORED} FROM chunks c WHERE {NOT_LATEST} UNION ALL {LATEST}", UPSERT
    ),
    "upsert_counts": _with("""
SELECT count(*) FILTER (WHERE c.chunk_id IS NULL) AS nr_inserts,
       count(*) FILTER (WHERE c.chunk_id IS NOT NULL) AS nr_replaces
FROM latest l LEFT JOIN chunks c ON c.chunk_id = l.chunk_id AND c.tenant = l.tenant""", UPSERT),
    "upsert_dedup": _with(LATEST, UPSERT),
    "delete_by_id": _kept("label = 1"),
    "delete_counts": _with("""
SELECT count(*) AS matches, CAST(0 AS BIGINT) AS failed, count(*) AS successful
FROM chunks WHERE label = 1"""),
    "delete_by_filename": _kept("filename = 'doc_3.txt'"),
    "delete_document": _kept("language = 'fr'"),
    "delete_by_filter": _kept("language = 'fr' OR quality = 0"),
    "persist_committed": _with(
        f"SELECT {STORED} FROM chunks c WHERE {NOT_LATEST} UNION ALL {LATEST}", UPSERT
    ),
    "commit_replayed": _with(
        f"SELECT {STORED} FROM chunks c WHERE {NOT_LATEST} UNION ALL {LATEST}", UPSERT
    ),
    "delete_committed": _kept(
        "language = 'fr' OR quality = 0 OR filename = 'doc_3.txt' OR tenant = 'tenant_2'"
    ),
    "stream_ingest": _with(f"SELECT * REPLACE ('__default__' AS tenant) FROM (SELECT {STORED} FROM chunks)"),
}
