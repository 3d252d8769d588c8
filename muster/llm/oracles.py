"""Expected rows of the operators as DuckDB SQL."""

from __future__ import annotations

#: Words of a text, A-Z lower-cased.
_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x20\x09-\x0D]+')"
)


def _shingles(table: str, key: str) -> str:
    """One row per document and distinct five-word shingle; shorter texts are one shingle."""
    return f"""
    split AS (SELECT {key} AS id, {_WORDS} AS w FROM {table}),
    shingle AS (
        SELECT DISTINCT id, unnest(CASE
            WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
            ELSE [] END) AS s
        FROM split
    ),
    size AS (SELECT id, count(*) AS n FROM shingle GROUP BY id)"""


#: Components of links ``link(a, b)``: the smallest id that each id reaches.
_COMPONENTS = """
    step AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
    reach AS (SELECT a AS id, b AS other FROM step UNION SELECT reach.id, step.b FROM reach JOIN step ON step.a = reach.other),
    component AS (SELECT id, least(id, min(other)) AS component_id FROM reach GROUP BY id)"""

#: Unit vectors in double precision; vectors without a direction have none.
_OP1 = f"""
WITH RECURSIVE unit AS (
        SELECT vec_id AS id, label, [x / norm FOR x IN v] AS u
        FROM (SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS norm
              FROM (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
                    WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0))
        WHERE norm > 0
    ),
    link AS (
        SELECT x.id AS a, y.id AS b FROM unit x JOIN unit y ON x.label = y.label AND x.id < y.id AND len(x.u) = len(y.u)
        WHERE list_dot_product(x.u, y.u) >= 0.98
    ),
    {_COMPONENTS},
    degree AS (SELECT a AS id, count(*) AS n FROM step GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
       vec_id = coalesce(component_id, vec_id) AS kept, 1.0::DOUBLE AS audit_recall
FROM embeddings LEFT JOIN component ON component.id = vec_id LEFT JOIN degree ON degree.id = vec_id
"""

#: Patterns of op2 by kind, the group that counts and its least length. Keywords as classes: no letters of other
#: alphabets fold into them.
_SECRETS = [
    (
        "assign",
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
        r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]+", 0, 16),
    ("pem", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
    ("url", r"://[A-Za-z0-9._-]{1,64}:[^\x00-\x20@/:]{6,128}@", 0, 1),
]


def _op2() -> str:
    """Matches with the texts between them; the lengths of what lies before a match add up to its start."""
    kinds = []
    for rank, (kind, pattern, group, least) in enumerate(_SECRETS):
        quoted = pattern.replace("'", "''")
        kinds.append(
            f"""
    SELECT doc_id, {rank} AS rank, '{kind}' AS kind,
           unnest(regexp_extract_all(text, '{quoted}')) AS whole, unnest(regexp_extract_all(text, '{quoted}', {group})) AS part,
           unnest(string_split_regex(text, '{quoted}')) AS gap, generate_subscripts(string_split_regex(text, '{quoted}'), 1) AS place,
           {least} AS least
    FROM texts"""
        )
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
raw AS ({" UNION ALL ".join(kinds)}),
placed AS (
    SELECT *, sum(length(gap) + coalesce(length(whole), 0)) OVER (PARTITION BY doc_id, rank ORDER BY place) - coalesce(length(whole), 0) AS low
    FROM raw
),
spans AS (
    SELECT doc_id, rank, kind, low, kind || ':' || low || ':' || (low + length(whole)) AS span
    FROM placed WHERE whole IS NOT NULL AND length(part) >= least
),
joined AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(span, ',' ORDER BY low, rank) FILTER (rank < 3) AS base, string_agg(span, ',' ORDER BY low, rank) AS spans
    FROM spans GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN joined USING (doc_id)
"""


_OP3 = f"""
WITH RECURSIVE {_shingles("documents", "doc_id")},
    link AS (
        SELECT x.id AS a, y.id AS b
        FROM shingle x JOIN shingle y ON x.s = y.s AND x.id < y.id
        JOIN size p ON p.id = x.id JOIN size q ON q.id = y.id
        GROUP BY x.id, y.id, p.n, q.n
        HAVING 100 * count(*) >= 75 * (p.n + q.n - count(*))
    ),
    {_COMPONENTS}
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       doc_id = coalesce(component_id, doc_id) AS kept
FROM documents LEFT JOIN size ON size.id = doc_id LEFT JOIN component ON component.id = doc_id
"""

_OP5 = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
),
marks AS (SELECT doc_id AS id, avg(quality) AS mark FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
keyed AS (
    SELECT doc_id, source, size,
           -ln((('0x' || substr(md5('mix-1:' || doc_id), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)
           / CASE WHEN mark IS NULL THEN 1.0 ELSE 0.5 + 1.5 * mark END AS key
    FROM sized LEFT JOIN marks ON id = doc_id
),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
    SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, 3 * source_size AS cap FROM sizes
),
levels AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
    FROM ranked
    WINDOW b AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
final AS (SELECT arg_min(level, cap / weight) AS level FROM levels WHERE weight * level < cap),
shares AS (
    SELECT source, source_size, least(coalesce(weight * final.level, cap), cap)::DOUBLE AS target
    FROM levels LEFT JOIN final ON TRUE
),
placed AS (
    SELECT doc_id, size, source_size, target,
           coalesce(sum(size) OVER (PARTITION BY keyed.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM keyed JOIN shares ON shares.source IS NOT DISTINCT FROM keyed.source
),
goals AS (
    SELECT *, round(target)::BIGINT AS goal,
           CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS epochs
    FROM placed
)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, goal - epochs * source_size - before)))::BIGINT AS taken
FROM goals
"""

_OP7 = f"""
WITH {_shingles("documents", "doc_id").replace("split", "dsplit").replace("shingle", "dshingle").replace("size", "dsize")},
    {_shingles("(SELECT * FROM benchmark WHERE text IS NOT NULL)", "item_id")}
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS common, n AS item_shingles
FROM dshingle d JOIN shingle i ON i.s = d.s JOIN size ON size.id = i.id
GROUP BY d.id, i.id, n HAVING 100 * count(*) >= 75 * n
"""


_OP11 = """
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
           sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d
    FROM documents
),
drawn AS (
    SELECT *, len(u)::BIGINT AS n, ('0x' || substr(d, 1, 8))::BIGINT AS h1, ('0x' || substr(d, 9, 8))::BIGINT AS h2,
           ('0x' || substr(d, 17, 8))::BIGINT AS h3, ('0x' || substr(d, 25, 8))::BIGINT AS h4
    FROM units
),
cut AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
),
parts AS (
    SELECT *, array_to_string(u[1:low], '') AS p, array_to_string(u[low + 1:high], '') AS m, array_to_string(u[high + 1:n], '') AS s
    FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

#: Limits as in ``divergence.Limits``.
_OP12 = r"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, lang, coalesce(text, '') AS text FROM documents),
split AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
windows AS (
    SELECT row, unnest([w[i:i + 2] FOR i IN range(1, len(w) - 1)]) AS three, unnest(range(1, len(w) - 1)) AS i FROM split
),
repeated AS (
    SELECT row, unnest([i, i + 1, i + 2]) AS place
    FROM (SELECT row, i, count(*) OVER (PARTITION BY row, three) AS n FROM windows) WHERE n >= 2
),
repeats AS (SELECT row, count(DISTINCT place) AS n_repeat_words FROM repeated GROUP BY row),
counted AS (
    SELECT row, doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
           list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words,
           len(regexp_extract_all(text, '\p{Lu}')) AS upper, len(regexp_extract_all(text, '\p{Nd}')) AS digit,
           len(regexp_extract_all(text, '\p{P}')) - len(regexp_extract_all(text, '[#*%&]')) AS punct,
           list_filter([lower(trim(x, '.,;:!?"''()[]{}#*$%&|<>-_')) FOR x IN w], lambda x: length(x) BETWEEN 1 AND 6) AS short
    FROM split LEFT JOIN repeats USING (row)
),
classed AS (SELECT *, [upper, digit, n_symbols, punct, word_chars - upper - digit - n_symbols - punct] AS classes FROM counted),
totals AS (
    SELECT lang AS ref_lang, sum(n_words) AS all_words,
           [sum(classes[1]) / sum(word_chars), sum(classes[2]) / sum(word_chars), sum(classes[3]) / sum(word_chars),
            sum(classes[4]) / sum(word_chars), sum(classes[5]) / sum(word_chars)] AS class_shares
    FROM classed WHERE lang IS NOT NULL GROUP BY lang
),
tops AS (
    SELECT lang AS ref_lang, list(word ORDER BY count DESC, word) AS common, list(count ORDER BY count DESC, word) AS counts
    FROM (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY count DESC, word) AS rank
        FROM (SELECT lang, word, count(*) AS count FROM (SELECT lang, unnest(short) AS word FROM classed) WHERE lang IS NOT NULL GROUP BY ALL)
    ) WHERE rank <= 50 GROUP BY lang
),
reference AS (
    SELECT ref_lang, class_shares, common, list_append(shares, 1 - list_sum(shares)) AS word_shares
    FROM (SELECT *, [c / all_words FOR c IN counts] AS shares FROM totals JOIN tops USING (ref_lang) WHERE all_words >= 20000)
),
shared AS (
    SELECT *, [c / word_chars FOR c IN classes] AS cp, list_append(wp, greatest(1 - list_sum(wp), 0)) AS p
    FROM (
        SELECT *, [len(list_filter(short, lambda x: x = k)) / n_words FOR k IN common] AS wp
        FROM classed LEFT JOIN reference ON ref_lang = lang
    )
),
far AS (
    SELECT *,
        sqrt(greatest(list_sum([
            CASE WHEN cp[i] > 0 THEN cp[i] * log2(cp[i] / ((cp[i] + class_shares[i]) / 2)) ELSE 0 END
            + CASE WHEN class_shares[i] > 0 THEN class_shares[i] * log2(class_shares[i] / ((cp[i] + class_shares[i]) / 2)) ELSE 0 END
            FOR i IN range(1, 6)]) / 2, 0)) AS class_distance,
        sqrt(greatest(list_sum([
            CASE WHEN p[i] > 0 THEN p[i] * log2(p[i] / ((p[i] + word_shares[i]) / 2)) ELSE 0 END
            + CASE WHEN word_shares[i] > 0 THEN word_shares[i] * log2(word_shares[i] / ((p[i] + word_shares[i]) / 2)) ELSE 0 END
            FOR i IN range(1, len(word_shares) + 1)]) / 2, 0)) AS word_distance,
        n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
    FROM shared
)
SELECT doc_id, n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, n_repeat_words,
       base_failed,
       NOT base_failed AND NOT coalesce(word_chars >= 200 AND class_distance > 0.25, FALSE)
       AND NOT coalesce(n_words >= 80 AND word_distance ** 2 > 0.28 ** 2 + (len(word_shares) - 1) / (8 * n_words * ln(2)), FALSE) AS kept
FROM far
"""

#: The digest of a text is the exclusive or of what each byte adds by its distance from the end, and of a term by length.
_OP13 = r"""
WITH RECURSIVE crc_table AS (
    SELECT b, list_reduce([b::UBIGINT] || range(8)::UBIGINT[],
        lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END) AS digest
    FROM range(256) t(b)
),
words AS (
    SELECT kind, row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM (
        SELECT 'd' AS kind, row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
        UNION ALL SELECT 'b', row_number() OVER (), NULL, coalesce(text, '') FROM benchmark
    )
),
features AS (
    SELECT kind, row, unnest(w || [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS f FROM words
),
texts AS (SELECT f, hex(encode(f)) AS x, octet_length(encode(f)) AS n FROM (SELECT DISTINCT f FROM features)),
adds(distance, b, digest) AS (
    SELECT 0, b, digest FROM crc_table
    UNION ALL
    SELECT distance + 1, adds.b, xor(adds.digest // 256, crc_table.digest)
    FROM adds JOIN crc_table ON crc_table.b = adds.digest % 256 WHERE distance < (SELECT max(n) FROM texts) + 4
),
bytes AS (SELECT f, n, unnest(range(n)) AS i, x FROM texts),
added AS (
    SELECT f, bit_xor(digest) AS digest
    FROM (SELECT f, n - 1 - i AS distance, ('0x' || substr(x, (2 * i + 1)::INT, 2))::INT AS b FROM bytes) JOIN adds USING (distance, b)
    GROUP BY f
),
step(n, digest) AS (
    SELECT 0, 4294967295::UBIGINT
    UNION ALL
    SELECT n + 1, xor(step.digest // 256, crc_table.digest) FROM step JOIN crc_table ON b = step.digest % 256
    WHERE n < (SELECT max(n) FROM texts)
),
buckets AS (
    SELECT f, xor(xor(added.digest, step.digest), 4294967295::UBIGINT) % 10000 AS bucket
    FROM added JOIN texts USING (f) JOIN step ON step.n = texts.n
),
counts AS (
    SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t FROM features JOIN buckets USING (f) GROUP BY bucket
),
gains AS (
    SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (all_s + 10000) / ((s + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS gain
    FROM counts, (SELECT sum(s) AS all_s, sum(t) AS all_t FROM counts)
),
sums AS (
    SELECT row, count(*) AS n_features, sum(gain)::BIGINT AS total
    FROM features JOIN buckets USING (f) JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY row
),
scored AS (
    SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
           coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
           ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
    FROM words LEFT JOIN sums USING (row) WHERE kind = 'd'
),
keyed AS (SELECT *, (weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0))))::BIGINT AS score FROM scored),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
           count(*) FILTER (n_words >= 20) OVER () AS eligible
    FROM keyed
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * eligible // 100 THEN place END AS rank FROM ranked
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_nn_descent": _OP1,
        "op2_blob_ledger": _op2(),
        "op3_minhash_forest": _OP3,
        "op5_weighted_mix": _OP5,
        "op7_benchmark_containment": _OP7,
        "op11_secondary_sort": _OP11,
        "op12_divergence": _OP12,
        "op13_arrow_resampling": _OP13,
    }
