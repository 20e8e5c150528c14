"""DuckDB SQL that gives the rows of the queries, where SQL can express them."""

from __future__ import annotations

from . import decontaminate, jaccard, licenses, lines, sharding, topk
from .text import LOWER, UPPER

_ALNUM = r"[0-9a-z\x{80}-\x{10FFFF}]+"


def _lower(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{UPPER}', '{LOWER}')"


def _words(column: str) -> str:
    return f"regexp_extract_all({_lower(column)}, '{_ALNUM}')"


def _license_scan() -> str:
    templates = ", ".join(f"({i}, '{t.label}', string_split('{t.words}', ' '), {t.gap}, {t.cover}::DOUBLE)" for i, t in enumerate(licenses.TEMPLATES))
    base = ", ".join(f"'{t.label}'" for t in licenses.BASE)
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_words("text")} AS w FROM documents),
    templates(t, label, words, gap, cover) AS (VALUES {templates}),
    wanted AS (
        SELECT t, label, gap, cover, len(words) - 1 AS grams, i AS t_pos, words[i + 1] AS w1, words[i + 2] AS w2
        FROM (SELECT *, unnest(range(len(words) - 1)) AS i FROM templates)),
    pairs AS (SELECT r, pos, w[pos + 1] AS w1, w[pos + 2] AS w2 FROM (SELECT r, w, unnest(range(len(w) - 1)) AS pos FROM docs)),
    diagonals AS (
        SELECT r, t, label, gap, cover, grams, pos - t_pos AS d, count(*) AS votes, min(pos) AS first, max(pos) + 1 AS last
        FROM pairs JOIN wanted USING (w1, w2) GROUP BY ALL),
    marked AS (SELECT *, CASE WHEN d - lag(d) OVER (PARTITION BY r, t ORDER BY d) <= gap THEN 0 ELSE 1 END AS fresh FROM diagonals),
    grouped AS (SELECT *, sum(fresh) OVER (PARTITION BY r, t ORDER BY d) AS g FROM marked),
    spans AS (
        SELECT r, label, cover, grams, least(1.0::DOUBLE, sum(votes)::DOUBLE / grams) AS coverage, min(first) AS first, max(last) AS last
        FROM grouped GROUP BY r, t, label, cover, grams, g),
    good AS (SELECT *, label IN ({base}) AS is_base FROM spans WHERE coverage >= cover AND last - first <= grams * 1.5),
    found AS (
        SELECT r, count(*) FILTER (is_base) AS n_base, min(first) FILTER (is_base) AS first_word, max(first) FILTER (is_base) AS last_word,
            array_to_string(list_sort(list_distinct(coalesce(list(label) FILTER (is_base), []))), ',') AS base_labels,
            array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(coverage) AS score
        FROM good GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
        last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
        coalesce(score, 0.0)::DOUBLE AS score
    FROM docs LEFT JOIN found USING (r)"""


def _line_dedup() -> str:
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
    each AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM docs),
    keyed AS (SELECT *, {_lower(f"trim(line, {white})")} AS k FROM each),
    common AS (
        SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= {lines.MIN_CHARS}
        GROUP BY k HAVING count(DISTINCT doc_id) >= {lines.MIN_DOCS}),
    decided AS (SELECT r, doc_id, pos, line, last IS NULL OR doc_id = last AS kept FROM keyed LEFT JOIN common USING (k))
    SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (NOT kept)::BIGINT AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (kept), '')) AS kept_sha256
    FROM decided GROUP BY r, doc_id"""


def _jaccard_join() -> str:
    n, percent = jaccard.WORDS, jaccard.PERCENT
    return rf"""
    WITH RECURSIVE docs AS (
        SELECT doc_id, regexp_extract_all({_lower("text")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {n} THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' ')) END) AS s FROM docs),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
    shared AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (
        SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * m >= {percent} * (x.n + y.n - m)),
    reach(a, b) AS (SELECT doc_id, doc_id FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    smallest AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM docs LEFT JOIN sizes USING (doc_id) JOIN smallest USING (doc_id)"""


def _decontaminate() -> str:
    size = decontaminate.WINDOW
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_words("text")} AS w FROM documents),
    items AS (SELECT item_id, {_words("text")} AS w, least({size}, len(w)) AS n FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, n, w[i:i + n - 1] AS x FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM items WHERE n > 0)),
    lengths AS (SELECT DISTINCT n FROM windows),
    places AS (
        SELECT r, n, i, w[i:i + n - 1] AS x
        FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)),
    hits AS (SELECT r, n, i, item_id FROM places JOIN windows USING (n, x)),
    words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
    found AS (
        SELECT r, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list_distinct(list(item_id::VARCHAR))), ',') AS ids
        FROM hits GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)"""


def _top_k() -> str:
    return f"""
    WITH vectors AS (
        SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({topk.SCALE} * x::DOUBLE)) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
        FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND q.r <> c.r),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored)
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= {topk.K}"""


def _sharding() -> str:
    bits, limit = sharding.HASH_BITS, sharding.SHARD_BYTES
    return f"""
    WITH docs AS (
        SELECT row_number() OVER () AS r, doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes,
            ('0x' || substr(md5(concat_ws('|', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))), 1, 15))::BIGINT AS h
        FROM documents),
    levels AS (SELECT *, unnest(range(0, {bits + 1})) AS depth FROM docs),
    buckets AS (
        SELECT depth, h >> ({bits} - depth) AS prefix, sum(n_bytes)::BIGINT AS bytes, min(h) = max(h) AS one FROM levels GROUP BY ALL),
    chosen AS (
        SELECT r, min(l.depth) AS depth FROM levels l JOIN buckets b ON b.depth = l.depth AND b.prefix = l.h >> ({bits} - l.depth)
        WHERE bytes <= {limit} OR one GROUP BY r)
    SELECT doc_id, n_bytes, lpad(bin(h), {bits}, '0')[1:depth] AS shard, depth::BIGINT AS shard_depth,
        bytes AS shard_bytes, bytes <= {limit} AS fits
    FROM docs JOIN chosen USING (r) JOIN buckets b USING (depth) WHERE b.prefix = h >> ({bits} - depth)"""


def _prefix_trie() -> str:
    bytewise = "list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))"
    points = "list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT)"
    crc = f"xor(list_reduce(list_prepend(4294967295, {points}), lambda a, b: {bytewise}), 4294967295)"
    return f"""
    WITH turns AS (
        SELECT conv_id, turn, md5(strlen(role) || ':' || role || text) AS key, length(text) AS points
        FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
    own AS (
        SELECT conv_id, {crc} % 6 AS h, conv_id - conv_id % 100 AS base, list(key ORDER BY turn NULLS FIRST, key) AS keys,
            list(points ORDER BY turn NULLS FIRST, key) AS points
        FROM turns GROUP BY conv_id),
    rebuilt AS (
        SELECT o.conv_id, coalesce(b.keys[1:o.h], []) || o.keys[o.h + 1:] AS path, coalesce(b.points[1:o.h], []) || o.points[o.h + 1:] AS points
        FROM own o LEFT JOIN own b ON b.conv_id = o.base),
    begun AS (SELECT conv_id, path, points, unnest(range(0, len(path) + 1)) AS depth FROM rebuilt),
    nodes AS (
        SELECT path[1:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(coalesce(points[depth], 0)) AS last,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(path) = depth), '')) AS ends_sha256
        FROM begun GROUP BY ALL),
    families AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
    counted AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN families f ON f.prefix = n.prefix),
    lines AS (SELECT *, unnest(range(0, depth + 1)) AS above FROM counted),
    subtrees AS (
        SELECT prefix[1:above] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * last) AS saved_tokens
        FROM lines GROUP BY ALL)
    SELECT c.conv_id, c.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n_convs::BIGINT AS n_convs, c.n_children::BIGINT AS n_children,
        s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, c.ends_sha256
    FROM counted c JOIN subtrees s ON s.prefix = c.prefix LEFT JOIN nodes p ON c.depth > 0 AND p.prefix = c.prefix[1:c.depth - 1]"""


def _vector_codes() -> str:
    """Two rounds written out; every entry is compared, the lowest distance and then number wins."""

    def assigned(books: str) -> str:
        distance = "list_aggregate(list_transform(list_zip(v, e), lambda z: (z[1] - z[2]) * (z[1] - z[2])), 'sum')::HUGEINT"
        return f"""
        SELECT r, p, v, (low % 1000)::INTEGER AS n, low // 1000 AS distance FROM (
            SELECT r, p, any_value(v) AS v, min({distance} * 1000 + n) AS low FROM parts JOIN {books} USING (p) GROUP BY r, p)"""

    def refined(given: str, books: str) -> str:
        return f"""
        SELECT p, n, coalesce(means.e, {books}.e) AS e FROM {books} LEFT JOIN (
            SELECT p, n, list((total - ((total % size) + size) % size) // size ORDER BY i) AS e FROM (
                SELECT p, n, i, sum(v[i])::HUGEINT AS total, count(*)::HUGEINT AS size
                FROM (SELECT p, n, v, unnest(range(1, len(v) + 1)) AS i FROM {given}) GROUP BY ALL) GROUP BY p, n) means USING (p, n)"""

    return f"""
    WITH kept AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r, vec_id, label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS whole, len(embedding) // 16 AS w
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (SELECT r, p, whole[p * w + 1 : (p + 1) * w] AS v FROM (SELECT *, unnest(range(16)) AS p FROM kept)),
    books0 AS MATERIALIZED (SELECT p, r AS n, v AS e FROM parts WHERE r < 64),
    given0 AS MATERIALIZED ({assigned("books0")}),
    books1 AS MATERIALIZED ({refined("given0", "books0")}),
    given1 AS MATERIALIZED ({assigned("books1")}),
    books2 AS MATERIALIZED ({refined("given1", "books1")}),
    given2 AS MATERIALIZED ({assigned("books2")}),
    coded AS (
        SELECT r, string_agg(lpad(lower(hex(n)), 2, '0'), '' ORDER BY p) AS code, sum(distance)::BIGINT AS error FROM given2 GROUP BY r),
    digest AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY p, n)) AS codebooks_sha256 FROM books2)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
    FROM kept JOIN coded USING (r), digest"""


SQL: dict[str, str] = {
    "op1_license_scan": _license_scan(),
    "op3_line_dedup": _line_dedup(),
    "op4_jaccard_join": _jaccard_join(),
    "op5_decontaminate": _decontaminate(),
    "op9_exact_top_k": _top_k(),
    "op10_sharding": _sharding(),
    "op11_prefix_trie": _prefix_trie(),
    "op13_vector_codes": _vector_codes(),
}
