"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from chunkloom.llm import raking, url_templates

_WARC = """
    WITH page AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
        FROM pages),
    shared AS (
        SELECT payload_digest, max(page_id) AS largest FROM page WHERE payload_bytes >= 1000 GROUP BY 1),
    judged AS (
        SELECT p.*, CASE WHEN largest > page_id AND payload_bytes >= 1000 THEN largest END AS refers_to
        FROM page p LEFT JOIN shared USING (payload_digest))
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
    FROM judged"""


def _raked_mix() -> str:
    """Every round of fitting is a select over windows; the level comes from the cells in order of ratio."""
    share = "SELECT *, tokens / (SELECT sum(tokens) FROM cells) AS share FROM cells"
    targets = []
    for name, power in raking.TEMPER.items():
        targets.append(f"""
            goal_{name} AS (
                SELECT {name}, raw / sum(raw) OVER () AS target FROM (
                    SELECT {name}, pow(sum(tokens), {power}) AS raw FROM cells WHERE tokens > 0 GROUP BY 1))""")
    for _ in range(raking.ROUNDS):
        for name in raking.TEMPER:
            share = f"""
                SELECT * EXCLUDE (target)
                    REPLACE (share * coalesce(target / nullif(sum(share) OVER (PARTITION BY {name}), 0), 0) AS share)
                FROM ({share}) LEFT JOIN goal_{name} USING ({name})"""
    none = f"'{raking.NONE}'"
    return f"""
        WITH counted AS (
            SELECT doc_id, coalesce(text, '') AS text, source, lang,
                   len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens
            FROM documents),
        placed AS (
            SELECT doc_id, n_tokens, coalesce(source, {none}) AS source, coalesce(lang, {none}) AS lang,
                   CASE WHEN contains(text, 'icense') OR contains(text, 'ights reserved') THEN 'legal'
                        WHEN contains(text, '@') THEN 'contact'
                        WHEN contains(text, ' | ') THEN 'listing'
                        WHEN n_tokens < 100 THEN 'note' ELSE 'prose' END AS topic
            FROM counted),
        cells AS (
            SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM placed GROUP BY ALL),
        {",".join(targets)},
        fitted AS MATERIALIZED ({share}),
        rated AS (
            SELECT *, CASE WHEN tokens > 0 THEN share * (SELECT sum(tokens) FROM cells) / tokens ELSE 1 END AS ratio FROM fitted),
        steps AS (
            SELECT ratio, {raking.BUDGET} * (SELECT sum(tokens) FROM cells)
                   - coalesce(sum(tokens) OVER before, 0) AS room, sum(tokens * ratio) OVER behind AS rest
            FROM rated WHERE tokens > 0
            WINDOW before AS (ORDER BY ratio DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                   behind AS (ORDER BY ratio DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        chosen AS (SELECT max(room / rest) AS level FROM steps WHERE ratio * room / rest < 1)
        SELECT doc_id, n_tokens, topic, round(least(1.0, ratio * level), 8) AS probability,
               CAST(('0x' || substr(md5('{raking.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT)
                   / pow(16, 13) < least(1.0, ratio * level) AS kept
        FROM placed JOIN rated USING (source, lang, topic) CROSS JOIN chosen"""


def _url_templates() -> str:
    """The tree level by level, each a few common tables; nodes below ``DEPTH`` segments are not followed."""
    t = url_templates
    parts = """
        WITH found AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        parts AS (
            SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM found),
        segments AS (
            SELECT *, list_transform(list_filter(string_split(path, '/'), lambda p: p <> ''), lambda p:
                CASE WHEN regexp_full_match(p, '[0-9a-fA-F-]{8,}') AND regexp_matches(p, '[0-9]') AND regexp_matches(p, '[a-fA-F-]')
                     THEN '<x>' ELSE regexp_replace(p, '[0-9]+', '<n>', 'g') END) AS own
            FROM parts),""" + f"""
        placed AS (
            SELECT page_id, host, path,
                   CASE WHEN len(own) > {t.DEPTH} THEN list_append(own[1:{t.DEPTH}], '**') ELSE own END AS shape
            FROM segments),
        known AS (
            SELECT doc_id AS page_id, avg(quality) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1),
        tree0 AS (
            SELECT host, shape, count(*) AS pages, count(good) AS labelled, coalesce(sum(good), 0) AS good, '' AS template
            FROM placed LEFT JOIN known USING (page_id) GROUP BY host, shape)"""
    for level in range(t.DEPTH + 1):
        parts += f""",
        branches{level} AS (
            SELECT host, template, shape[{level + 1}] AS branch, sum(pages) AS pages, sum(labelled) AS labelled, sum(good) AS good
            FROM tree{level} WHERE len(shape) > {level} GROUP BY ALL),
        nodes{level} AS (
            SELECT *, count(*) OVER node AS ways,
                   (sum(good) OVER node + 1) / (sum(labelled) OVER node + 2) AS mean
            FROM branches{level} WINDOW node AS (PARTITION BY host, template)),
        named{level} AS (
            SELECT host, template, branch, CASE WHEN ways > 1 AND (
                (ways >= {t.MANY} AND pages < {t.FEW})
                OR abs(good - labelled * mean) <= {t.Z} * sqrt(mean * (1 - mean) * greatest(labelled, 1)))
                THEN '*' ELSE branch END AS name
            FROM nodes{level}),
        tree{level + 1} AS MATERIALIZED (
            SELECT t.host, t.shape, t.pages, t.labelled, t.good, t.template || coalesce('/' || n.name, '') AS template
            FROM tree{level} t LEFT JOIN named{level} n
                ON t.host = n.host AND t.template = n.template AND t.shape[{level + 1}] = n.branch)"""
    last = f"tree{t.DEPTH + 1}"
    rules = sorted(t.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, a) for a, h, p in rules]
    rule = " ".join(f"WHEN {test} THEN '{name}'" for test, name, _ in fits)
    action = " ".join(f"WHEN {test} THEN '{verdict}'" for test, _, verdict in fits)
    return parts + f""",
        prior AS (SELECT CASE WHEN sum(labelled) > 0 THEN sum(good) / sum(labelled) ELSE 1 END AS mean FROM tree0),
        pure AS (
            SELECT host, template, (sum(good) + {t.WEIGHT} * (SELECT mean FROM prior)) / (sum(labelled) + {t.WEIGHT}) AS purity
            FROM {last} GROUP BY host, template)
        SELECT page_id, host, path, CASE {rule} END AS rule,
               CASE {action} WHEN purity >= {t.PURITY} THEN 'allow' ELSE 'block' END AS verdict,
               template, round(purity, 8) AS purity
        FROM placed JOIN {last} USING (host, shape) JOIN pure USING (host, template)"""


_SUFFIX = """
    WITH folded AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
    doc AS (SELECT doc_id, regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM folded),
    item AS (
        SELECT item_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
        FROM benchmark),
    item_place AS (
        SELECT item_id, words, least(len(words), 13) AS size, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS s
        FROM item WHERE len(words) > 0),
    item_window AS (
        SELECT DISTINCT item_id, size, array_to_string(words[s:s + size - 1], ' ') AS key FROM item_place),
    sizes AS (SELECT DISTINCT size FROM item_window),
    doc_place AS (
        SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS s FROM doc JOIN sizes ON len(words) >= size),
    hit AS (
        SELECT doc_id, s, w.size, item_id
        FROM (SELECT doc_id, s, size, array_to_string(words[s:s + size - 1], ' ') AS key FROM doc_place) p
        JOIN item_window w ON p.key = w.key AND p.size = w.size),
    covered AS (
        SELECT doc_id, count(DISTINCT place) AS n_hit FROM (
            SELECT doc_id, unnest(range(s, s + size)) AS place FROM hit) GROUP BY doc_id),
    named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
    SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
    FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""

_COVER = """
    WITH doc AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
    place AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS s FROM doc WHERE len(words) >= 20),
    ranked AS (
        SELECT doc_id, s, row_number() OVER (PARTITION BY array_to_string(words[s:s + 19], ' ') ORDER BY doc_id, s) AS n
        FROM place),
    gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM ranked WHERE n > 1),
    word AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM doc),
    left_over AS (
        SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
        FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
    SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(l.text, '')) AS kept_sha256
    FROM doc LEFT JOIN left_over l USING (doc_id)"""

_SHINGLES = """
    WITH RECURSIVE folded AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x20\\x09-\\x0D]+') AS words
        FROM documents),
    place AS (
        SELECT doc_id, words, least(len(words), 4) AS size, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS s
        FROM folded WHERE len(words) > 0),
    shingle AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(words[s:s + size - 1], ' ') AS key FROM place),
    sized AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
    shared AS MATERIALIZED (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
        FROM shingle a JOIN shingle b ON a.key = b.key AND a.doc_id < b.doc_id GROUP BY ALL),
    link AS MATERIALIZED (
        SELECT x, y FROM shared JOIN sized a ON a.doc_id = x JOIN sized b ON b.doc_id = y
        WHERE 100 * common >= 80 * (a.n + b.n - common)),
    edge AS MATERIALIZED (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
    reach(doc_id, least) AS (
        SELECT doc_id, doc_id FROM documents
        UNION
        SELECT e.y, r.least FROM reach r JOIN edge e ON e.x = r.doc_id WHERE r.least < e.y)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(least) AS component_id, min(least) = d.doc_id AS kept
    FROM documents d LEFT JOIN sized USING (doc_id) JOIN reach r ON r.doc_id = d.doc_id GROUP BY d.doc_id, n"""

# The crc32 of a decimal id: its characters one after the other, eight steps of a bit (-1) behind each.
_CRC = """xor(4294967295, list_reduce(
    [CAST(4294967295 AS BIGINT)] || flatten([[CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]
        FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"""

_TRIE = f"""
    WITH turn_of AS (
        SELECT conv_id, turn, octet_length(encode(coalesce(text, ''))) AS size,
               md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
        FROM conversations WHERE conv_id IS NOT NULL),
    own AS (
        SELECT conv_id, list({{'digest': digest, 'size': size}} ORDER BY turn NULLS FIRST, digest) AS turns,
               {_CRC} % 9 AS h
        FROM turn_of GROUP BY conv_id),
    conv AS (
        SELECT o.conv_id, coalesce(b.turns[1:o.h], []) || o.turns[o.h + 1:] AS turns
        FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
    member AS (
        SELECT conv_id, d AS depth, len(turns) AS length, [t.digest FOR t IN turns[1:d]] AS prefix,
               CASE WHEN d = 0 THEN 0 ELSE turns[d].size END AS size
        FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM conv)),
    node AS (
        SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size,
               sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends_sha256
        FROM member GROUP BY prefix, depth),
    linked AS (
        SELECT n.*, p.conv_id AS parent_conv_id, coalesce(c.n, 0) AS n_children
        FROM node n LEFT JOIN node p ON n.depth > 0 AND p.prefix = n.prefix[1:n.depth - 1]
             LEFT JOIN (SELECT prefix[1:depth - 1] AS above, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1) c
                  ON c.above = n.prefix),
    reach AS (
        SELECT prefix[1:d] AS top, n_children, (n_convs - 1) * size AS saved
        FROM (SELECT *, unnest(range(depth + 1)) AS d FROM linked))
    SELECT l.conv_id, l.depth, l.parent_conv_id, l.n_convs, l.n_children,
           CAST(count(*) FILTER (r.n_children = 0) AS BIGINT) AS n_leaves,
           CAST(sum(r.saved) AS BIGINT) AS saved_tokens, l.ends_sha256
    FROM linked l JOIN reach r ON r.top = l.prefix
    GROUP BY l.prefix, l.conv_id, l.depth, l.parent_conv_id, l.n_convs, l.n_children, l.ends_sha256"""

_NEGATIVES = """
    WITH vec AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
               [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label,
               CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
        FROM vec a JOIN vec b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
    positive AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE own = label
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank
    FROM positive JOIN scored USING (anchor_id)
    WHERE own <> label AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    QUALIFY rank <= 3"""

ORACLES: dict[str, str] = {
    "op1_raked_mix": _raked_mix(),
    "op4_warc_chains": _WARC,
    "op5_odd_sketch": _SHINGLES,
    "op6_suffix_arrays": _SUFFIX,
    "op8_url_templates": _url_templates(),
    "op10_difference_cover": _COVER,
    "op12_conversation_tries": _TRIE,
    "op13_multi_index": _NEGATIVES,
}
