"""SQL for the registered queries that SQL can express."""

from __future__ import annotations

from opinara.llm import line_dedup, merkle, mixing, sharding, topk, variants

ORACLES: dict[str, str] = {}


def crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of a text's UTF-8 bytes; SQL has bitwise operators but no such function."""
    # What each bit of a byte adds, by the reflected polynomial 0xEDB88320.
    bits = [0x77073096, 0xEE0E612C, 0x076DC419, 0x0EDB8832, 0x1DB71064, 0x3B6E20C8, 0x76DC4190, 0xEDB88320]
    added = "(c >> 8)"
    for place, value in enumerate(bits):
        added = f"xor({added}, ((xor(c, b) >> {place}) & 1) * {value})"
    bytes_ = f"list_transform(range(0, strlen({text})), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bytes_}), lambda c, b: {added}), 4294967295)"


ORACLES["op2_mix_sources"] = f"""
WITH RECURSIVE counts AS (
    SELECT source, count(*) AS n_rows, sqrt(count(*)) AS weight FROM documents GROUP BY source
), parts AS (
    SELECT source, n_rows, CAST(greatest(round(weight / sum(weight) OVER () * {mixing.PARTS}), 1) AS BIGINT) AS part,
        row_number() OVER (ORDER BY source NULLS FIRST) AS i
    FROM counts
), plan AS (
    SELECT CAST(sum(part) AS BIGINT) AS p, list(part ORDER BY i) AS a FROM parts
), run AS (
    SELECT CAST(0 AS BIGINT) AS t, list_transform(a, lambda x: CAST(0 AS BIGINT)) AS done, CAST(0 AS BIGINT) AS i FROM plan
    UNION ALL
    SELECT t + 1, list_transform(done, lambda n, j: CASE WHEN j = pick THEN n + 1 ELSE n END), pick
    FROM (
        SELECT t, done, list_min(list_transform(range(1, len(a) + 1), lambda j: CASE
            WHEN done[j] * p < (t + 1) * a[j] THEN ((done[j] + 1) * p + a[j] - 1) // a[j] * 100000 + j END)) % 100000 AS pick
        FROM run, plan WHERE t < p
    )
), slots AS (
    SELECT i, t - 1 AS within, row_number() OVER (PARTITION BY i ORDER BY t) - 1 AS k FROM run WHERE t > 0
), ranked AS (
    SELECT doc_id, source, row_number() OVER (
        PARTITION BY source ORDER BY CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, {mixing.ORDER_HEX}) AS BIGINT), doc_id) - 1 AS rank
    FROM documents
), blocks AS (
    SELECT doc_id, ranked.source, rank, rank // {mixing.BLOCK_ROWS} AS block, part, i
    FROM ranked JOIN parts ON ranked.source IS NOT DISTINCT FROM parts.source
), placed AS (
    SELECT doc_id, source, rank, block, block // part * p + within AS slot
    FROM blocks JOIN slots ON blocks.i = slots.i AND block % part = k, plan
)
SELECT doc_id, source, block, slot, row_number() OVER (ORDER BY slot, rank) - 1 AS position FROM placed
"""

ORACLES["op4_extendible_shards"] = f"""
WITH hashed AS (
    SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS bytes,
        CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS bits
    FROM documents
), prefixes AS (
    SELECT d AS depth, bits >> ({sharding.BITS} - d) AS prefix, sum(bytes) AS bytes
    FROM hashed, range(0, {sharding.BITS + 1}) AS r(d) GROUP BY ALL
), chosen AS (
    SELECT doc_id, hashed.bytes, bits, min(depth) AS depth
    FROM hashed JOIN prefixes ON prefix = bits >> ({sharding.BITS} - depth)
    WHERE prefixes.bytes <= {sharding.BYTE_LIMIT} OR depth = {sharding.BITS} GROUP BY ALL
)
SELECT doc_id, bytes, CAST(depth AS INTEGER) AS depth,
    CASE WHEN depth = 0 THEN '' ELSE lpad(bin(bits >> CAST({sharding.BITS} - depth AS BIGINT)), CAST(depth AS INTEGER), '0') END AS shard,
    CAST(0 AS BIGINT) AS page
FROM chosen
"""

# No lookaround in this SQL: a mark, which no text holds, is put where a unit ends.
_MARKED = r"""replace(regexp_replace(coalesce(text, ''), '([.!?])([ \t])', '\1' || chr(31) || '\2', 'g'), chr(10), chr(10) || chr(31))"""

ORACLES["op9_cut_repeated_lines"] = rf"""
WITH parts AS (
    SELECT doc_id, string_split({_MARKED}, chr(31)) AS parts FROM documents
), units AS (
    SELECT doc_id, unnest(parts) AS unit, unnest(range(0, len(parts))) AS no FROM parts
), marked AS (
    SELECT *, rtrim(unit, chr(10)) AS body, trim(regexp_replace(lower(unit), '[ \t\r\x0B\x0C\n]+', ' ', 'g'), ' ') AS norm,
        sum(length(unit)) OVER (PARTITION BY doc_id ORDER BY no) - length(unit) AS start
    FROM units
), ranked AS (
    SELECT *, norm <> '' AND row_number() OVER (PARTITION BY norm ORDER BY doc_id, no) > 1 AS gone,
        CASE WHEN norm = '' THEN 0 ELSE len(string_split(norm, ' ')) END AS words
    FROM marked
), runs AS (
    SELECT *, sum(CASE WHEN NOT gone AND norm <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY no) AS run FROM ranked
), sums AS (
    SELECT *, sum(CASE WHEN gone THEN words ELSE 0 END) OVER (PARTITION BY doc_id, run) AS run_words FROM runs
)
SELECT doc_id, count(*) AS n_units, count(*) FILTER (gone) AS n_removed,
    coalesce(sum(words) FILTER (gone), 0)::BIGINT AS removed_words,
    coalesce(sum(words) FILTER (gone AND run_words >= {line_dedup.PASSAGE_WORDS}), 0)::BIGINT AS passage_words,
    coalesce(string_agg(CAST(CAST(start AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(start AS BIGINT) + length(body) AS VARCHAR), ',' ORDER BY no) FILTER (gone), '') AS spans,
    sha256(string_agg(CASE WHEN gone THEN substring(unit, length(body) + 1) ELSE unit END, '' ORDER BY no)) AS kept_sha256
FROM sums GROUP BY doc_id
"""

ORACLES["op3_top_k_search"] = f"""
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({topk.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % {topk.EVERY} = 0
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored
)
SELECT * FROM ranked WHERE rank <= {topk.K}
"""

FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"
LEAF = "sha256(concat({}))"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

ORACLES["op11_merkle_manifest"] = f"""
WITH RECURSIVE rows_ AS (
    SELECT doc_id, lang, {LEAF.format(", ".join(FIELD.format(f) for f in FIELDS))} AS leaf,
        CASE WHEN n_chars IS NOT NULL AND {crc32("CAST(doc_id AS VARCHAR)")} % {merkle.TAMPERED} = 0
            THEN {LEAF.format(", ".join(FIELD.format("(n_chars + 1)" if f == "n_chars" else f) for f in FIELDS))} END AS tampered
    FROM documents
), langs AS (
    SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS t FROM (SELECT DISTINCT lang FROM documents)
), leaves AS (
    SELECT doc_id, t, leaf, tampered, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
    FROM rows_ JOIN langs ON rows_.lang IS NOT DISTINCT FROM langs.lang
), tree AS (
    SELECT t, 0 AS level, i, leaf AS node, count(*) OVER (PARTITION BY t) AS n FROM leaves
    UNION ALL
    SELECT t, level + 1, i // 2, sha256(string_agg(node, '' ORDER BY i)), (n + 1) // 2 FROM tree WHERE n > 1 GROUP BY t, level, i // 2, n
), over_ AS (
    SELECT 0 AS level, t AS i, node, (SELECT count(*) FROM langs) AS n FROM tree WHERE n = 1
    UNION ALL
    SELECT level + 1, i // 2, sha256(string_agg(node, '' ORDER BY i)), (n + 1) // 2 FROM over_ WHERE n > 1 GROUP BY level, i // 2, n
), climb AS (
    SELECT t, i AS leaf_no, 0 AS level, i, coalesce(tampered, leaf) AS node, '' AS proof FROM leaves
    UNION ALL
    SELECT c.t, leaf_no, c.level + 1, c.i // 2, sha256(CASE WHEN s.i < c.i THEN s.node || c.node ELSE c.node || coalesce(s.node, '') END),
        proof || coalesce(s.node, '')
    FROM climb c JOIN tree own ON own.t = c.t AND own.level = c.level AND own.i = c.i AND own.n > 1
    LEFT JOIN tree s ON s.t = c.t AND s.level = c.level AND s.i = xor(c.i, 1)
), arrived AS (
    SELECT c.t, leaf_no, c.node, proof, own.node AS subroot
    FROM climb c JOIN tree own ON own.t = c.t AND own.level = c.level AND own.n = 1
), climb_over AS (
    SELECT t, leaf_no, 0 AS level, t AS i, node, proof FROM arrived
    UNION ALL
    SELECT c.t, leaf_no, c.level + 1, c.i // 2, sha256(CASE WHEN s.i < c.i THEN s.node || c.node ELSE c.node || coalesce(s.node, '') END),
        proof || coalesce(s.node, '')
    FROM climb_over c JOIN over_ own ON own.level = c.level AND own.i = c.i AND own.n > 1
    LEFT JOIN over_ s ON s.level = c.level AND s.i = xor(c.i, 1)
)
SELECT l.doc_id, l.leaf, a.subroot, top.node AS root, sha256(c.proof) AS proof_sha256, c.node AS folded_root, c.node = top.node AS verified
FROM leaves l JOIN arrived a ON a.t = l.t AND a.leaf_no = l.i
JOIN climb_over c ON c.t = l.t AND c.leaf_no = l.i
JOIN over_ top ON top.n = 1 AND top.level = c.level
"""

ORACLES["op12_spelling_variants"] = f"""
WITH RECURSIVE runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL
), hashed AS (
    SELECT run, n, {crc32("(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || run)")} AS h FROM runs
    WHERE length(run) >= {variants.LEAST_LETTERS}
), words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT CASE WHEN h % {variants.DELETED} = 0
            THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n
        FROM hashed
    ) WHERE length(word) >= {variants.LEAST_LETTERS} GROUP BY word HAVING sum(n) >= {variants.LEAST_COUNT}
), shorter AS (
    SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), links AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, max(near_n) AS near_n FROM links GROUP BY word
), forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {variants.TIMES} * n THEN near_n END AS form_n,
        CASE WHEN near_n >= {variants.TIMES} * n
            THEN (SELECT min(near) FROM links l WHERE l.word = w.word AND l.near_n = best.near_n) END AS form
    FROM words w LEFT JOIN best ON best.word = w.word
), chain AS (
    SELECT word, word AS reached, form FROM forms
    UNION ALL
    SELECT chain.word, chain.form, forms.form FROM chain JOIN forms ON forms.word = chain.form WHERE chain.form IS NOT NULL
)
SELECT forms.word, form, reached AS root, n, n_near, form_n FROM forms JOIN (SELECT word, reached FROM chain WHERE form IS NULL) USING (word)
"""
