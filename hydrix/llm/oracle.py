"""DuckDB SQL of the training-data queries whose results SQL can express over whole tables.

Each text is written from the contract alone, by a plain method (self joins, recursive reachability,
row-by-row claims) that shares nothing with the operator it checks.  Four results have no SQL: link
propagation and trained models (``op1``, ``op5``, ``op6``) end in floating sums or trained weights, and
span positions of a pattern (``op2``) have no function there.
"""

from __future__ import annotations

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK_WORDS = r"'[^\x20\x09-\x0D]+'"
_ALNUM_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

#: Slots 4099 and 32 shards: every turn's shard takes the first free slot of its own order.
_OP3 = """
WITH RECURSIVE shards AS (
    SELECT i, format('shard-{:05d}', i) AS name,
           ('0x' || substr(md5('offset:' || format('shard-{:05d}', i)), 1, 15))::BIGINT % 4099 AS first_slot,
           ('0x' || substr(md5('step:' || format('shard-{:05d}', i)), 1, 15))::BIGINT % 4098 + 1 AS step
    FROM range(32) t(i)
), claims AS (
    SELECT 0::BIGINT AS turn, -1::BIGINT AS slot, list_transform(range(4099), lambda x: true) AS free
    UNION ALL
    SELECT turn + 1, claimed, list_transform(free, lambda f, k: f AND k <> claimed + 1)
    FROM (
        SELECT turn, free, list_filter(
            list_transform(range(4099), lambda j: (first_slot + j * step) % 4099), lambda s: free[s + 1])[1] AS claimed
        FROM claims JOIN shards ON i = turn % 32 WHERE turn < 4099
    )
), owners AS (SELECT slot, name AS shard FROM claims JOIN shards ON i = (turn - 1) % 32 WHERE turn > 0),
placed AS (
    SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '')), 1, 15))::BIGINT % 4099 AS slot
    FROM documents
)
SELECT doc_id, slot, shard FROM placed LEFT JOIN owners USING (slot)
"""

_COMPONENT = """
reach AS (
    SELECT id, id AS other FROM nodes
    UNION
    SELECT reach.id, l.b FROM reach JOIN links l ON l.a = reach.other
), component AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
"""

_OP4 = f"""
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
), usable AS (
    SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS norm FROM vectors
    WHERE label IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND list_dot_product(v, v) > 0
), pairs AS (
    SELECT p.vec_id AS a, q.vec_id AS b FROM usable p JOIN usable q ON p.label = q.label AND p.vec_id <> q.vec_id
    WHERE len(p.v) = len(q.v) AND list_dot_product(p.v, q.v) / (p.norm * q.norm) >= 0.98
), links AS (SELECT * FROM pairs), nodes AS (SELECT vec_id AS id FROM vectors), {_COMPONENT}
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM vectors JOIN component ON id = vec_id LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) ON a = vec_id
"""

_OP7 = f"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all({_LOWER.format('text')}, {_BLANK_WORDS}) AS words FROM documents
), placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM texts),
grams AS (
    SELECT doc_id, concat_ws(' ', word, lead(word, 1) OVER w, lead(word, 2) OVER w, lead(word, 3) OVER w,
                             lead(word, 4) OVER w) AS gram, i, count(*) OVER (PARTITION BY doc_id) AS n
    FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), sets AS MATERIALIZED (SELECT DISTINCT doc_id, md5(gram) AS gram FROM grams WHERE i <= greatest(n - 4, 1)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
    SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM sets p JOIN sets q USING (gram)
    WHERE p.doc_id <> q.doc_id GROUP BY ALL
), links AS MATERIALIZED (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * c >= 75 * (x.n + y.n - c)
), nodes AS (SELECT doc_id AS id FROM documents), {_COMPONENT}
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN component ON id = d.doc_id LEFT JOIN sizes USING (doc_id)
"""

_OP8 = f"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all({_LOWER.format('text')}, {_ALNUM_WORDS}) AS words FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all({_LOWER.format('text')}, {_ALNUM_WORDS}) AS words FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i : i + 9], ' ') AS body
    FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 8, 2))) AS i FROM item_words WHERE len(words) > 0)
), placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM doc_words),
tails AS MATERIALIZED (
    SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS tail
    FROM placed
), spots AS (
    SELECT doc_id, i, n, item_id
    FROM (SELECT doc_id, i, n, array_to_string(tail[1:n], ' ') AS body
          FROM tails JOIN (SELECT DISTINCT n FROM windows) ON len(tail) >= n) t
    JOIN windows USING (n, body)
), hits AS (
    SELECT doc_id, count(DISTINCT spot) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS spot FROM spots) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM spots) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP9 = """
WITH texts AS (SELECT doc_id, encode(coalesce(text, '')) AS t FROM documents),
starts AS (
    SELECT doc_id, i, md5(t[i : i + 199]) AS body
    FROM (SELECT doc_id, t, unnest(range(1, octet_length(t) - 198)) AS i FROM texts WHERE octet_length(t) >= 200)
), repeated AS (SELECT doc_id, i FROM starts WHERE body IN (SELECT body FROM starts GROUP BY body HAVING count(*) > 1)),
marked AS (SELECT doc_id, i, i > lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) + 200 AS new FROM repeated),
runs AS (
    SELECT doc_id, min(i) AS a, max(i) + 199 AS b
    FROM (SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked) GROUP BY doc_id, run
), edges AS (
    SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1 AS since FROM runs
), gaps AS (
    SELECT doc_id, since AS lo, a - 1 AS hi FROM edges
    UNION ALL
    SELECT doc_id, max(b) + 1, max(octet_length(t)) FROM runs JOIN texts USING (doc_id) GROUP BY doc_id
), kept AS (
    SELECT doc_id, string_agg(CASE WHEN hi >= lo THEN hex(t[lo:hi]) ELSE '' END, '' ORDER BY lo) AS body
    FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id
), removed AS (SELECT doc_id, sum(b - a + 1) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT doc_id, octet_length(t)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(CASE WHEN body IS NULL THEN t ELSE unhex(body) END) AS kept_sha256
FROM texts LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

#: Seed 17, blocks of 128 words, 16 shards, weights 3, 1, 2, a budget of 1.5 and at most 2 copies.
_OP10 = f"""
WITH docs AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_BLANK_WORDS}))::BIGINT AS size,
           ('0x' || substr(md5(concat_ws(':', '17', doc_id::VARCHAR, text)), 1, 15))::BIGINT AS place
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, sum(size) * 2.0::DOUBLE AS cap,
           [3.0::DOUBLE, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
    FROM docs GROUP BY source
), levels AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
               - coalesce(sum(cap) OVER (fill ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (fill ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM sources WINDOW fill AS (ORDER BY cap / weight, source NULLS LAST)
), final AS (SELECT min_by(level, cap / weight) AS level FROM levels WHERE cap > level * weight),
targets AS (
    SELECT s.source, source_size, cap, least(cap, coalesce(f.level * weight, cap)) AS target FROM sources s, final f
), quotients AS (
    SELECT source, row_number() OVER (ORDER BY target / (2 * s + 1) DESC, source NULLS LAST, s) AS seat
    FROM (SELECT source, target, unnest(range(0, (cap / 128)::BIGINT + 2)) AS s FROM targets)
), seats AS (
    SELECT k, (SELECT round(sum(target) / 128 * k / 16) FROM targets) AS seats FROM range(1, 17) t(k)
), ends AS (
    SELECT source, list(upto ORDER BY k) AS ends
    FROM (SELECT s.source, k, count(seat) AS upto FROM targets s CROSS JOIN seats
          LEFT JOIN quotients q ON q.source IS NOT DISTINCT FROM s.source AND seat <= seats GROUP BY s.source, k)
    GROUP BY source
), won AS (
    SELECT source, count(*) AS blocks FROM quotients
    WHERE seat <= (SELECT round(sum(target) / 128) FROM targets) GROUP BY source
), plans AS (
    SELECT t.*, least(coalesce(blocks, 0) * 128, 2 * source_size) AS words
    FROM targets t LEFT JOIN won ON won.source IS NOT DISTINCT FROM t.source
), streams AS (
    SELECT d.*, source_size, target, words // greatest(source_size, 1) AS copies, words % greatest(source_size, 1) AS rest,
           coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM docs d JOIN plans p ON p.source IS NOT DISTINCT FROM d.source
)
SELECT doc_id, size, source_size, target, taken, source, CASE WHEN taken > 0 THEN (before // 128)::BIGINT END AS block,
       CASE WHEN taken > 0 THEN (1 + len(list_filter(ends, lambda e: e <= before // 128)))::BIGINT END AS shard
FROM (SELECT *, (copies * size + least(size, greatest(rest - before, 0)))::BIGINT AS taken FROM streams) s
JOIN (SELECT source AS end_source, ends FROM ends) ON end_source IS NOT DISTINCT FROM source
"""

#: Seed 7; all texts may be cut, half of them with the suffix first.
_OP11 = """
WITH lines AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256(concat('7:', doc_id)) AS h,
           regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS unit
    FROM documents
), drawn AS (
    SELECT *, len(unit) AS n, ('0x' || h[1:8])::BIGINT % (len(unit) + 1) AS r1, ('0x' || h[9:16])::BIGINT % (len(unit) + 1) AS r2,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR ('0x' || h[17:24])::BIGINT % 100 >= 100 THEN 'plain'
                WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM lines
), parts AS (
    SELECT *, array_to_string(unit[1 : least(r1, r2)], '') AS p, array_to_string(unit[least(r1, r2) + 1 : greatest(r1, r2)], '') AS m,
           array_to_string(unit[greatest(r1, r2) + 1 :], '') AS s
    FROM drawn
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', p, '<S>', s, '<M>', m)
              ELSE concat('<S>', s, '<P>', p, '<M>', m) END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts
"""

_OP12 = """
WITH texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
placed AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM texts),
keyed AS (
    SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM placed
), shared AS (
    SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (last IS NOT NULL AND doc_id <> last) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (last IS NULL OR doc_id = last), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (key) GROUP BY doc_id
"""


def _op13(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Every assignment compares all entries; a round is a pair of named tables."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""nearest{r} AS MATERIALIZED (
    SELECT row, p, min({{'d': list_sum(list_transform(list_zip(part, entry), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': e}}) AS best
    FROM parts JOIN book{r} USING (p) GROUP BY row, p
)""")
        if r < rounds:
            steps.append(f"""book{r + 1} AS MATERIALIZED (
    SELECT b.p, b.e, coalesce(m.entry, b.entry) AS entry FROM book{r} b LEFT JOIN (
        SELECT p, e, list(((s - (s % n + n) % n) // n)::BIGINT ORDER BY j) AS entry FROM (
            SELECT p, best.e AS e, j, sum(part[j]) AS s, count(*) AS n
            FROM nearest{r} JOIN parts USING (row, p), (SELECT unnest(range(1, max(len(part)) + 1)) AS j FROM parts)
            GROUP BY ALL) GROUP BY p, e
    ) m ON m.p = b.p AND m.e = b.e
)""")
    return f"""
WITH kept AS (
    SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS row,
           list_transform(embedding, lambda x: floor(x::DOUBLE * 4096)::BIGINT) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT row, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS part FROM kept, range({parts}) t(p)
), book0 AS MATERIALIZED (SELECT p, row - 1 AS e, part AS entry FROM parts WHERE row <= {entries}),
{", ".join(steps)},
codes AS (
    SELECT row, string_agg(format('{{:02x}}', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM nearest{rounds} GROUP BY row
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN codes USING (row)
"""


ORACLE_SQL: dict[str, str] = {
    "op3_sharding": _OP3,
    "op4_projection_collisions": _OP4,
    "op7_minhash_join": _OP7,
    "op8_fm_decontam": _OP8,
    "op9_bucket_pointer": _OP9,
    "op10_source_mix": _OP10,
    "op11_fill_middle": _OP11,
    "op12_line_dedup": _OP12,
    "op13_vector_codes": _op13(),
}
