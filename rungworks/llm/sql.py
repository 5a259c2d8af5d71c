"""DuckDB SQL of the corpus queries, each written from the query's contract."""

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

OP8 = r"""
WITH flat AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), grouped AS (
    SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM flat GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM flat JOIN grouped USING (norm)
"""

OP10 = rf"""
WITH numbered AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), cut AS (
    SELECT r, doc_id, text, {_WORDS} AS w,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
    FROM numbered
), windows AS (
    SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM cut WHERE len(w) >= 3
), keyed AS (
    SELECT r, i, [w[i], w[i + 1], w[i + 2]] AS k FROM windows
), repeated AS (
    SELECT r, i FROM keyed QUALIFY count(*) OVER (PARTITION BY r, k) > 1
), covered AS (
    SELECT r, count(DISTINCT i + d) AS n FROM repeated CROSS JOIN (VALUES (0), (1), (2)) AS t(d) GROUP BY r
), base AS (
    SELECT doc_id, text, l, len(w) AS n_words,
        coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(l) - len(list_distinct(l)) AS n_dup_lines,
        coalesce(n, 0) AS n_repeat_words,
        length(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper_chars,
        length(regexp_replace(text, '[^!]', '', 'g')) AS bangs
    FROM cut LEFT JOIN covered USING (r)
), failed AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
    NOT base_failed AND n_symbols <= 0.10 * word_chars AND word_chars <= 20.0 * n_words
        AND NOT (len(l) >= 4 AND n_dup_lines > 0.70 * len(l))
        AND NOT (upper_chars > 0.4 * word_chars AND bangs > 0.1 * word_chars) AS kept
FROM failed
"""

OP1 = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, source, len({_WORDS})::BIGINT AS size,
        md5('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), sized AS (
    SELECT source, sum(size)::DOUBLE AS size, count(*) AS docs,
        row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS nr FROM docs GROUP BY source
), weighed AS (
    SELECT *, list_value(5.0::DOUBLE, 2.0, 1.0)[nr % 3 + 1] AS w FROM sized
), levels AS (
    SELECT (1.5 * (SELECT sum(size) FROM sized) - coalesce((SELECT sum(2 * o.size) FROM weighed o WHERE (o.size / o.w, o.nr) < (x.size / x.w, x.nr)), 0))
        / (SELECT sum(o.w) FROM weighed o WHERE (o.size / o.w, o.nr) >= (x.size / x.w, x.nr)) AS level FROM weighed x
), sources AS (
    SELECT *, least(2 * size, w * (SELECT max(level) FROM levels)) AS target, ceil(sqrt(docs))::BIGINT AS shards FROM weighed
), asked AS (
    SELECT floor(sum(target) / 64 + 0.5)::BIGINT AS blocks FROM sources
), source_quotients AS (
    SELECT nr, target / (2 * unnest(range(0, (SELECT blocks FROM asked))) + 1) AS q FROM sources WHERE target > 0
), source_seats AS (
    SELECT nr, count(*) AS seats FROM (SELECT * FROM source_quotients QUALIFY row_number() OVER (ORDER BY q DESC, nr) <= (SELECT blocks FROM asked)) GROUP BY nr
), quotas AS (
    SELECT s.*, least(coalesce(seats, 0), 2 * ceil(size / 64))::BIGINT AS quota FROM sources s LEFT JOIN source_seats USING (nr)
), placed AS (
    SELECT d.*, q.nr, q.quota, q.target, q.size AS source_size, ('0x' || h[1:8])::BIGINT % q.shards AS shard
    FROM docs d JOIN quotas q ON d.source IS NOT DISTINCT FROM q.source
), streamed AS (
    SELECT *, (sum(size) OVER (PARTITION BY nr ORDER BY shard, h, doc_id NULLS FIRST, size, r) - size)::BIGINT AS a FROM placed
), blocks AS (
    SELECT nr, quota, unnest(range(0, ceil(sum(size) / 64)::BIGINT)) AS j FROM placed GROUP BY nr, quota
), begun AS (
    SELECT b.nr, b.quota, b.j, d.shard FROM blocks b JOIN streamed d ON d.nr = b.nr AND d.a <= b.j * 64 AND b.j * 64 < d.a + d.size
), shard_blocks AS (
    SELECT nr, quota, shard, count(*) AS m, min(j) AS j0 FROM begun GROUP BY ALL
), shard_quotients AS (
    SELECT nr, quota, shard, m / (2.0::DOUBLE * unnest(range(0, 2 * m)) + 1) AS q FROM shard_blocks
), shard_seats AS (
    SELECT nr, shard, count(*) AS seats FROM (SELECT * FROM shard_quotients QUALIFY row_number() OVER (PARTITION BY nr ORDER BY q DESC, shard) <= quota) GROUP BY ALL
), given AS (
    SELECT b.nr, b.j, coalesce(seats, 0) // m + CASE WHEN ((b.j - j0) * 2654435761 + ('0x' || md5('1:' || b.nr || ':' || b.shard)[1:8])::BIGINT % m) % m < coalesce(seats, 0) % m THEN 1 ELSE 0 END AS times
    FROM begun b JOIN shard_blocks USING (nr, shard) LEFT JOIN shard_seats USING (nr, shard)
)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
    coalesce((SELECT sum((least(a + size, (j + 1) * 64) - greatest(a, j * 64)) * times) FROM given g WHERE g.nr = d.nr AND g.j BETWEEN d.a // 64 AND (d.a + d.size - 1) // 64 AND d.size > 0), 0)::BIGINT AS taken
FROM streamed d
"""

OP5 = r"""
WITH numbered AS (
    SELECT row_number() OVER () AS r, doc_id, text, source FROM documents
), lines AS (
    SELECT r, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM numbered WHERE text IS NOT NULL
), keyed AS (
    SELECT *, trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS k FROM lines
), shared AS (
    SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT source) >= 10
), marked AS (
    SELECT *, k IN (SELECT k FROM shared) AS removed FROM keyed
), told AS (
    SELECT r, count(*) FILTER (k <> '') AS n_lines, count(*) FILTER (removed) AS n_removed,
        coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT removed), '') AS kept FROM marked GROUP BY r
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(CASE WHEN text IS NOT NULL THEN kept END) AS kept_sha256
FROM numbered LEFT JOIN told USING (r)
"""

OP6 = r"""
WITH cut AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages
), rules(verdict, rhost, rpath) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), bare AS (
    SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name FROM (SELECT DISTINCT host FROM cut)
), parts AS (
    SELECT *, string_split(name, '.') AS l, regexp_matches(name, '^[0-9]+([.][0-9]+){3}$|^\[') AS address FROM bare
), named AS (
    SELECT *, CASE WHEN array_to_string(l[-2:], '.') IN ('co.uk', 'org.uk', 'com.au', 'co.jp', 'com.br', 'co.in') THEN 2 ELSE 1 END AS s FROM parts
), tree AS (
    SELECT host, CASE WHEN address THEN '' ELSE array_to_string(l[-s:], '.') END AS suffix,
        CASE WHEN address THEN name ELSE array_to_string(l[-(s + 1):], '.') END AS domain FROM named
), hosts AS (
    SELECT host, domain, suffix, count(quality) AS n, coalesce(sum(1 - quality), 0) AS k
    FROM cut JOIN tree USING (host) LEFT JOIN labels ON labels.doc_id = cut.page_id GROUP BY ALL
), domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY ALL
), suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY ALL
), groups AS (
    SELECT 1 AS level, n, k FROM hosts UNION ALL SELECT 2, n, k FROM domains UNION ALL SELECT 3, n, k FROM suffixes
), moments AS (
    SELECT level, sum(n)::DOUBLE AS n, sum(k)::DOUBLE AS k, sum(n * n)::DOUBLE AS nn, sum(k * k / n) AS pk, count(*) AS g FROM groups WHERE n > 0 GROUP BY level
), fitted AS (
    SELECT level, CASE WHEN g < 2 OR k = 0 OR k = n OR n - nn / n - (g - 1) <= 0 THEN -1
        ELSE (pk - n * (k / n) * (k / n) - (k / n) * (1 - k / n) * (g - 1)) / ((k / n) * (1 - k / n) * (n - nn / n - (g - 1))) END AS rho FROM moments
), strength AS (
    SELECT v.level, CASE WHEN coalesce(rho, -1) <= 0 THEN 1000.0 ELSE least(1000.0, greatest(1.0, 1 / rho - 1)) END::DOUBLE AS w FROM (VALUES (1), (2), (3)) v(level) LEFT JOIN fitted USING (level)
), w AS (
    SELECT max(w) FILTER (level = 1) AS h, max(w) FILTER (level = 2) AS d, max(w) FILTER (level = 3) AS s,
        (SELECT (coalesce(sum(k), 0) + 0.5)::DOUBLE / (coalesce(sum(n), 0) + 1) FROM suffixes) AS m FROM strength
), rates AS (
    SELECT d.domain, (w.d * ((w.s * w.m + s.k) / (w.s + s.n)) + d.k) / (w.d + d.n) AS rate FROM domains d JOIN suffixes s USING (suffix), w
), posterior AS (
    SELECT host, w.h * rate + k AS a, w.h * (1 - rate) + n - k AS b FROM hosts JOIN rates USING (domain), w
), fits AS (
    SELECT c.page_id, c.host, c.path, r.rhost || r.rpath AS rule, r.verdict, row_number() OVER (PARTITION BY c.id ORDER BY length(r.rhost || r.rpath) DESC NULLS LAST) AS i
    FROM (SELECT row_number() OVER () AS id, * FROM cut) c LEFT JOIN rules r
        ON (c.host = r.rhost OR ends_with(c.host, '.' || r.rhost)) AND starts_with(c.path, r.rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM fits JOIN posterior USING (host) WHERE i = 1
"""

OP9 = r"""
WITH flat AS (
    SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS payload FROM pages
), kinds AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload) AS first FROM flat
), digits AS (
    SELECT r, sha1(payload) AS h FROM flat
), letters AS (
    SELECT r, string_agg('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((('0x' || h[5 * g + 1:5 * g + 5])::INTEGER >> s) & 31) + 1], '' ORDER BY g, s DESC) AS digest
    FROM digits, range(0, 8) AS a(g), (VALUES (15), (10), (5), (0)) AS b(s) GROUP BY r
)
SELECT page_id, strlen(payload) AS payload_bytes, digest AS payload_digest,
    CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM kinds JOIN letters USING (r)
"""

_CRC_TABLE = """crc(t) AS (
    SELECT list_transform(range(0, 256), lambda b: list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))
)"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a string's UTF-8 bytes, with the table ``crc``."""
    each = f"list_transform(regexp_extract_all(hex({text}), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {each}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


OP11 = """
WITH sound AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, q.r AS q, x.vec_id, x.r, list_inner_product(q.v, x.v)::BIGINT AS score FROM sound q JOIN sound x ON q.r <> x.r WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id ASC NULLS LAST, r) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP12 = rf"""
WITH RECURSIVE {_CRC_TABLE}, told AS (
    SELECT row_number() OVER () AS r, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
), hit AS (
    SELECT told.*, {_crc32("k")} % 20 AS h FROM told, crc
), damaged AS (
    SELECT r, conv, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
        CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE h WHEN 3 THEN 2 ELSE 1 END)) AS again FROM hit WHERE h <> 0
), placed AS (
    SELECT *, role[1:1] AS initial, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, md5(text), r, again) AS i FROM damaged
), looked AS (
    SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS again_said,
        NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut, lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial AS pair FROM placed
), rows AS (
    SELECT *, NOT blank AND again_said AS duplicate, NOT blank AND NOT again_said AND cut AS truncated FROM looked
), closure(p, q, cost, audit, put) AS (
    VALUES (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []), (0, 2, 3, 'I', ['user:']), (1, 2, 3, 'I', ['user:']), (2, 3, 3, 'I', ['assistant:']), (3, 2, 3, 'I', ['user:']),
        (0, 3, 6, 'II', ['user:', 'assistant:']), (1, 3, 6, 'II', ['user:', 'assistant:'])
), edits(p, q, initial, letter, price, role) AS (
    VALUES (0, 0, NULL, 'D', 4, NULL), (1, 1, NULL, 'D', 4, NULL), (2, 2, NULL, 'D', 4, NULL), (3, 3, NULL, 'D', 4, NULL),
        (0, 1, 's', 'K', 0, NULL), (0, 2, 'u', 'K', 0, NULL), (1, 2, 'u', 'K', 0, NULL), (2, 3, 'a', 'K', 0, NULL), (3, 2, 'u', 'K', 0, NULL),
        (0, 2, NULL, 'R', 3, 'user'), (1, 2, NULL, 'R', 3, 'user'), (2, 3, NULL, 'R', 3, 'assistant'), (3, 2, NULL, 'R', 3, 'user')
), convs AS (
    SELECT DISTINCT conv, conv_id FROM told
), walk AS (
    SELECT conv, 0::BIGINT AS i, q AS p, cost::BIGINT AS cost, audit, put FROM convs, closure WHERE closure.p = 0
    UNION ALL
    SELECT conv, i, q, best.cost, best.audit, best.put FROM (
        SELECT w.conv, n.i, c.q, min({{'cost': w.cost + price + c.cost + CASE WHEN truncated AND letter <> 'D' THEN 3 ELSE 0 END, 'audit': w.audit || letter || c.audit,
            'put': list_concat(list_concat(w.put, CASE WHEN letter = 'D' THEN [] ELSE [coalesce(e.role, n.role) || ':' || n.text] END), c.put)}}) AS best
        FROM walk w JOIN rows n ON n.conv = w.conv AND n.i = w.i + 1
            JOIN edits e ON e.p = w.p AND (e.initial IS NULL OR e.initial = n.initial) AND (letter = 'D' OR NOT (blank OR duplicate)) JOIN closure c ON c.p = e.q GROUP BY ALL
    )
), counted AS (
    SELECT conv, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
        count(*) FILTER (truncated) AS truncated, count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY conv
), best AS (
    SELECT conv, min({{'cost': cost, 'audit': audit, 'put': put}}) AS b FROM walk LEFT JOIN counted USING (conv) WHERE i = coalesce(n, 0) AND p IN (0, 3) GROUP BY conv
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
    coalesce(illegal, 0)::BIGINT AS illegal, b.cost AS cost, b.audit AS audit, sha256(array_to_string(b.put, chr(10))) AS repaired_sha256
FROM convs JOIN best USING (conv) LEFT JOIN counted USING (conv)
"""

OP13 = rf"""
WITH RECURSIVE {_CRC_TABLE}, runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), counted AS (
    SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL
), hashed AS (
    SELECT run, n, {_crc32("(id || ':' || run)")} AS h FROM counted, crc
), words AS (
    SELECT CASE WHEN h % 199 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, sum(n)::BIGINT AS n FROM hashed GROUP BY word HAVING length(word) >= 6 AND sum(n) >= 5
), shorter AS (
    SELECT word, i, word[1:i] || word[i + 2:] AS rest FROM (SELECT word, unnest(range(0, length(word))) AS i FROM words)
), near AS (
    SELECT word, rest AS other FROM shorter SEMI JOIN words w ON w.word = rest
    UNION SELECT rest, word FROM shorter SEMI JOIN words w ON w.word = rest
    UNION SELECT a.word, b.word FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
), told AS (
    SELECT a.word, a.n, count(o.word) AS n_near, min({{'less': -o.n, 'form': o.word}}) FILTER (o.word IS NOT NULL) AS best FROM words a LEFT JOIN near ON near.word = a.word LEFT JOIN words o ON o.word = near.other GROUP BY a.word, a.n
), formed AS (
    SELECT word, n, n_near, CASE WHEN -best.less >= 5 * n THEN best.form END AS form, CASE WHEN -best.less >= 5 * n THEN -best.less END AS form_n FROM told
), chain AS (
    SELECT word, word AS here FROM formed UNION ALL SELECT chain.word, form FROM chain JOIN formed f ON f.word = chain.here WHERE form IS NOT NULL
), ends AS (
    SELECT chain.word, here AS root FROM chain JOIN formed f ON f.word = chain.here WHERE form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""

ORACLE = {
    "op9_warc": OP9,
    "op5_line_dedup": OP5,
    "op6_url_filters": OP6,
    "op1_source_mixing": OP1,
    "op8_exact_dedup": OP8,
    "op10_quality_rules": OP10,
    "op11_exact_topk": OP11,
    "op12_conversation_repair": OP12,
    "op13_spelling_variants": OP13,
}
