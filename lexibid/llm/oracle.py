"""DuckDB SQL for the queries that SQL can express, written independently of the operators."""

WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

# Lower case of A-Z only.
NORMAL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
    WITH normal AS (SELECT doc_id, {NORMAL} AS text FROM documents)
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
        doc_id = max(doc_id) OVER same AS kept, sha256(text) AS text_sha256
    FROM normal WINDOW same AS (PARTITION BY text)
"""

# Sets that are the same are compared once; components are all that can be reached by links.
JACCARD = f"""
    WITH RECURSIVE worded AS (
        SELECT doc_id, regexp_extract_all({NORMAL}, '[^\x20\x09-\x0D]+') AS w FROM documents
    ), sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))))
            END AS shingles
        FROM worded
    ), classes AS MATERIALIZED (
        SELECT min(doc_id) AS class_id, count(*) AS size, shingles, len(shingles) AS n
        FROM sets WHERE len(shingles) > 0 GROUP BY shingles
    ), tokens AS (
        SELECT class_id, size, n, unnest(shingles) AS token FROM classes
    ), pairs AS MATERIALIZED (
        SELECT a.class_id AS x, b.class_id AS y, b.size
        FROM tokens a JOIN tokens b ON a.token = b.token AND a.class_id <> b.class_id
        GROUP BY a.class_id, b.class_id, a.n, b.n, b.size
        HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
    ), reach AS (
        SELECT x, y FROM pairs
        UNION
        SELECT reach.x, pairs.y FROM reach JOIN pairs ON reach.y = pairs.x
    ), of_class AS (
        SELECT class_id, shingles, size - 1 + coalesce((SELECT sum(p.size) FROM pairs p WHERE p.x = class_id), 0) AS n_links,
            least(class_id, (SELECT min(y) FROM reach WHERE x = class_id)) AS component_id
        FROM classes
    )
    SELECT doc_id, len(sets.shingles)::bigint AS n_shingles, coalesce(component_id, doc_id) AS component_id,
        coalesce(class_id, doc_id) AS class_id, coalesce(n_links, 0)::bigint AS n_links
    FROM sets LEFT JOIN of_class ON sets.shingles = of_class.shingles AND len(sets.shingles) > 0
"""

# Four characters of base32 from every five hexadecimal digits.
BASE32 = """list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(sha1(html), 5 * (i // 4)::int + 1, 5))::int >> (15 - 5 * (i % 4))::int) & 31) + 1, 1)),
    'string_agg', '')"""

WARC = f"""
    WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    latest AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last_id FROM payloads)
    SELECT page_id, strlen(html)::bigint AS payload_bytes, {BASE32} AS payload_digest,
        CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id <> last_id THEN last_id END AS refers_to
    FROM latest
"""

MIXING = f"""
    WITH sized AS (
        SELECT doc_id, source, {WORDS}::bigint AS size,
            ('0x' || substr(md5('mix-1:' || coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')), 1, 13))::bigint
                / 4503599627370496.0::double AS draw
        FROM documents
    ), sources AS (
        SELECT source, sum(size)::bigint AS source_size,
            [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::int]::double AS weight
        FROM sized GROUP BY source
    ), -- the common level: cap sources one by one, those that fill first
    filling AS (
        SELECT *, source_size * 2.0::double / weight AS full_at,
            row_number() OVER (ORDER BY source_size * 2.0::double / weight, source NULLS LAST) AS k
        FROM sources
    ), levels AS (
        SELECT a.k, any_value(a.full_at) AS full_at,
            ((SELECT sum(source_size) FROM sources)::double * 1.5::double
                - coalesce(sum(b.source_size) FILTER (b.k < a.k), 0)::double * 2.0::double)
                / sum(b.weight) FILTER (b.k >= a.k) AS level
        FROM filling a, filling b GROUP BY a.k
    ), common AS (
        SELECT arg_min(level, k) AS level FROM levels WHERE level <= full_at
    ), targets AS (
        SELECT source, source_size, least(source_size * 2.0::double, (SELECT level FROM common) * weight) AS target
        FROM sources
    )
    SELECT doc_id, size, source_size, target,
        size * (CASE WHEN source_size = 0 THEN 0 ELSE
            floor(target / source_size)::bigint
            + CASE WHEN draw < target / source_size - floor(target / source_size) THEN 1 ELSE 0 END END) AS taken
    FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
"""

# Bytes of a field, its length in front; null apart from empty.
FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::varchar) || ':' || {0}::varchar END"
FIELDS = " || ".join(FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
EDITED = FIELDS.replace("text", "replace(text, chr(10), '')")

# crc32 of a short string, bit by bit: eight steps per byte.
CRC32 = """list_reduce(list_prepend(4294967295::bigint, list_transform(range(8 * length({0})),
        lambda i: CASE WHEN i % 8 = 0 THEN unicode({0}[(i // 8 + 1)::int])::bigint ELSE 0::bigint END)),
        lambda crc, own: CASE WHEN xor(crc, own) & 1 = 1
            THEN xor(xor(crc, own) >> 1, 3988292384) ELSE xor(crc, own) >> 1 END)"""

# A node's run is three of its level; level by level the siblings to the left and right of a leaf's way.
MERKLE = f"""
    WITH RECURSIVE records AS (
        SELECT doc_id, source, sha256({FIELDS}) AS leaf,
            CASE WHEN xor({CRC32.format('(doc_id::varchar)')}, 4294967295) % 2 = 0
                THEN sha256({EDITED}) ELSE sha256({FIELDS}) END AS own
        FROM documents
    ), leaves AS (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS pos,
            count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree
        FROM records
    ), nodes(tree, lvl, pos, n, hash) AS (
        SELECT tree, 0, pos, n, leaf FROM leaves
        UNION ALL
        SELECT tree, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY pos))
        FROM nodes WHERE n > 1 GROUP BY tree, lvl, pos // 3, n
    ), subroots AS (
        SELECT tree, lvl AS height, hash AS subroot, tree - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
    ), over_sources(lvl, pos, n, hash) AS (
        SELECT 0, pos, n, subroot FROM subroots
        UNION ALL
        SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY pos))
        FROM over_sources WHERE n > 1 GROUP BY lvl, pos // 3, n
    ), ways(doc_id, leaf, tree, height, lvl, pos, top_pos, proof, folded) AS (
        SELECT doc_id, leaf, tree, height, 0, leaves.pos, subroots.pos, '', own FROM leaves JOIN subroots USING (tree)
        UNION ALL
        SELECT doc_id, leaf, w.tree, height, w.lvl + 1,
            CASE WHEN w.lvl < height THEN w.pos // 3 ELSE w.pos END,
            CASE WHEN w.lvl < height THEN w.top_pos ELSE w.top_pos // 3 END,
            proof || coalesce(string_agg(s.hash, '' ORDER BY s.pos) FILTER (s.pos <> here), ''),
            sha256(string_agg(CASE WHEN s.pos = here THEN folded ELSE s.hash END, '' ORDER BY s.pos))
        FROM (SELECT *, CASE WHEN lvl < height THEN pos ELSE top_pos END AS here FROM ways) w
        JOIN (
            SELECT tree, lvl, pos, hash FROM nodes
            UNION ALL
            SELECT 0, lvl, pos, hash FROM over_sources
        ) s ON s.tree = CASE WHEN w.lvl < height THEN w.tree ELSE 0 END
            AND s.lvl = CASE WHEN w.lvl < height THEN w.lvl ELSE w.lvl - height END AND s.pos // 3 = here // 3
        WHERE w.lvl < height + (SELECT max(lvl) FROM over_sources)
        GROUP BY doc_id, leaf, w.tree, height, w.lvl, w.pos, w.top_pos, proof, folded, here
    )
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
    FROM ways JOIN subroots USING (tree, height), (SELECT hash AS root, lvl AS top FROM over_sources WHERE n = 1)
    WHERE ways.lvl = height + top
"""


def _codebook(entries: str) -> str:
    """The nearest entry of every part, of equals the first: ``vec_id, label, part, own, entry, error``."""
    return f"""
        SELECT vec_id, label, p.part, own,
            arg_min(entry, (list_sum(list_transform(range(1, len(own) + 1), lambda i: (own[i] - c[i]) * (own[i] - c[i])))
                * 64 + entry)::bigint) AS entry,
            min(list_sum(list_transform(range(1, len(own) + 1), lambda i: (own[i] - c[i]) * (own[i] - c[i]))))::bigint AS error
        FROM parts p JOIN {entries} e ON p.part = e.part GROUP BY vec_id, label, p.part, own"""


def _averaged(found: str, entries: str) -> str:
    return f"""
        SELECT e.part, e.entry, CASE WHEN mean IS NULL THEN c ELSE mean END AS c FROM {entries} e
        LEFT JOIN (
            SELECT part, entry, list(mean ORDER BY i) AS mean FROM (
                SELECT part, entry, i, floor(sum(own[i])::double / count(*))::bigint AS mean
                FROM {found}, range(1, (SELECT max(len(own)) + 1 FROM parts)) t(i) GROUP BY part, entry, i
            ) GROUP BY part, entry
        ) m ON m.part = e.part AND m.entry = e.entry"""


VECTOR_CODES = f"""
    WITH kept AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::double * 256)::bigint) AS grid
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), parts AS MATERIALIZED (
        SELECT vec_id, label, part, grid[(part * len(grid) // 16 + 1)::int : ((part + 1) * len(grid) // 16)::int] AS own
        FROM kept, range(16) t(part)
    ), books0 AS MATERIALIZED (
        SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, own AS c
        FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)
    ), found0 AS MATERIALIZED ({_codebook('books0')}
    ), books1 AS MATERIALIZED ({_averaged('found0', 'books0')}
    ), found1 AS MATERIALIZED ({_codebook('books1')}
    ), books2 AS MATERIALIZED ({_averaged('found1', 'books1')}
    ), found2 AS MATERIALIZED ({_codebook('books2')}
    ), codes AS (
        SELECT vec_id, label, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, sum(error)::bigint AS error
        FROM found2 GROUP BY vec_id, label
    )
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::bigint AS label_error,
        (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM books2) AS codebooks_sha256
    FROM codes
"""


def all_oracles() -> dict[str, str]:
    return {
        "op1_exact_dedup": EXACT_DEDUP,
        "op4_jaccard_join": JACCARD,
        "op5_warc": WARC,
        "op9_mixing": MIXING,
        "op11_vector_codes": VECTOR_CODES,
        "op13_merkle_manifest": MERKLE,
    }
