"""DuckDB SQL with the rows of the queries that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

REPETITION = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
places AS (
    SELECT r, i,
        CASE WHEN i + 2 <= len(w) THEN array_to_string(w[i:i + 2], ' ') END AS w3,
        CASE WHEN i + 7 <= len(w) THEN array_to_string(w[i:i + 7], ' ') END AS w8,
        CASE WHEN i + 100 <= len(w) THEN md5(array_to_string(w[i:i + 100], ' ')) END AS w101
    FROM docs, unnest(range(1, len(w) + 1)) AS t(i)
),
again AS (
    SELECT r, i,
        (w3 IS NOT NULL AND count(*) OVER (PARTITION BY r, w3) > 1)::INT AS a3,
        (w8 IS NOT NULL AND count(*) OVER (PARTITION BY r, w8) > 1)::INT AS a8,
        (w101 IS NOT NULL AND count(*) OVER (PARTITION BY r, w101) > 1)::INT AS a101
    FROM places
),
inside AS (
    SELECT r, a101,
        max(a3) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c3,
        max(a8) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS c8
    FROM again
),
totals AS (SELECT r, sum(c3) AS n3, sum(c8) AS n8, max(a101) AS too_long FROM inside GROUP BY r),
lines AS (
    SELECT r, count(*) - count(DISTINCT line) AS n
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
),
measured AS (
    SELECT doc_id, len(w)::BIGINT AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(n3, 0)::BIGINT AS n_repeat_words,
        coalesce(n8, 0)::BIGINT AS n_covered_words, coalesce(too_long, 0) AS too_long
    FROM docs LEFT JOIN totals USING (r) LEFT JOIN lines USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered_words,
    (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
        AND 100 * n_covered_words <= 45 * n_words AND too_long = 0 AS kept
FROM measured
"""

MIXING = rf"""
WITH docs AS (
    SELECT doc_id, source, len({WORDS})::BIGINT AS size,
        md5('mix:' || coalesce(doc_id::VARCHAR, 'null')) AS draw FROM documents
),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
    SELECT source, source_size, source_size * 2.0::DOUBLE AS most, sum(source_size) OVER () * 1.5::DOUBLE AS total,
        [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight FROM sources
),
levels AS (
    SELECT *, row_number() OVER line AS place,
        (total - coalesce(sum(most) OVER (line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (line ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed WINDOW line AS (ORDER BY most / weight, source NULLS LAST)
),
targets AS (
    SELECT source, source_size, CASE WHEN shared IS NULL THEN most ELSE least(most, weight * shared) END AS target
    FROM levels, (SELECT min_by(level, place) AS shared FROM levels WHERE most > weight * level)
),
ordered AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY draw, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM docs
),
met AS (
    SELECT o.doc_id, o.size, t.source_size, t.target, o.before,
        CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole
    FROM ordered o JOIN targets t ON o.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    (size * (whole + CASE WHEN size > 0 AND before + size / 2 <= target - whole * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM met
"""

WORD_WINDOWS = rf"""
WITH docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
places AS (
    SELECT doc_id, i, w[i] AS word,
        CASE WHEN i + 19 <= len(w) THEN md5(array_to_string(w[i:i + 19], ' ')) END AS win
    FROM docs, unnest(range(1, len(w) + 1)) AS t(i)
),
later AS (
    SELECT doc_id, i, word, (win IS NOT NULL AND row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1)::INT AS again
    FROM places
),
covered AS (
    SELECT doc_id, i, word,
        max(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
    FROM later
),
kept AS (
    SELECT doc_id, count(*) AS n_words, sum(gone) AS n_removed,
        coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0), '') AS text
    FROM covered GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""

NEAR = rf"""
WITH RECURSIVE lowered AS (
    SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
),
docs AS (SELECT doc_id, {WORDS} AS w FROM lowered),
shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
    FROM docs, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS t(i) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id
),
links AS (
    SELECT u, v FROM shared JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v
    WHERE 100 * shared.n >= 80 * (a.n + b.n - shared.n)
),
arcs AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reached(doc_id, seen) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, arcs.v FROM reached r JOIN arcs ON r.seen = arcs.u
)
SELECT r.doc_id, coalesce(max(sizes.n), 0)::BIGINT AS n_shingles, min(r.seen) AS component_id, r.doc_id = min(r.seen) AS kept
FROM reached r LEFT JOIN sizes USING (doc_id) GROUP BY r.doc_id
"""

LINE_CHUNKS = """
WITH docs AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE length(text) > 0),
lines AS (
    SELECT doc_id, i, l[i] AS line, i = len(l) AS last, ('0x' || substr(md5(l[i]), 1, 7))::BIGINT AS h
    FROM docs, unnest(range(1, len(l) + 1)) AS t(i)
),
rolled AS (
    SELECT lines.*, base, NOT last
        AND (base * coalesce(lag(h) OVER (PARTITION BY doc_id, base ORDER BY i), 0) + h) % 2147483647 % 3 <> 0 AS may
    FROM lines, (SELECT unnest([1000003, 15485863, 179424673])::BIGINT AS base)
),
grouped AS (
    SELECT *, sum((NOT may)::INT) OVER (PARTITION BY doc_id, base ORDER BY i) AS run FROM rolled
),
marked AS (
    SELECT *, last OR may AND row_number() OVER (PARTITION BY doc_id, base, run, may ORDER BY i) % 2 = 1 AS ends FROM grouped
),
numbered AS (
    SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id, base ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS no
    FROM marked
),
pieces AS (
    SELECT *, (row_number() OVER (PARTITION BY doc_id, base, no ORDER BY i) - 1) // 8 AS piece FROM numbered
),
chunks AS (
    SELECT DISTINCT doc_id, first, n, content FROM (
        SELECT doc_id, min(i) AS first, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS content
        FROM pieces GROUP BY doc_id, base, no, piece
    )
),
judged AS (
    SELECT *, n >= 2 AND row_number() OVER (PARTITION BY n >= 2, content ORDER BY doc_id, first) > 1 AS gone FROM chunks
),
totals AS (SELECT doc_id, count(*) AS n_chunks FROM chunks GROUP BY doc_id),
removed AS (SELECT DISTINCT doc_id, unnest(range(first, first + n)) AS i FROM judged WHERE gone),
kept AS (
    SELECT doc_id, count(*) AS n_lines, count(removed.i) AS n_removed,
        string_agg(line, chr(10) ORDER BY i) FILTER (WHERE removed.i IS NULL) AS text
    FROM lines LEFT JOIN removed USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_chunks, 0)::BIGINT AS n_chunks,
    coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id) LEFT JOIN totals USING (doc_id)
"""

COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM words, unnest(range(1, len(w) + 1)) AS t(i), unnest([1, 2, 3, 4]) AS u(k) WHERE i + k - 1 <= len(w)
),
counts AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 30),
cut AS MATERIALIZED (
    SELECT lang, phrase, f AS a, i, array_to_string(w[:i], ' ') AS one, array_to_string(w[i + 1:], ' ') AS rest
    FROM candidates, unnest(range(1, k)) AS t(i)
),
cuts AS (
    SELECT cut.lang, cut.phrase, a, i, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f + y.f) AS score
    FROM cut JOIN counts x ON x.lang = cut.lang AND x.phrase = cut.one JOIN counts y ON y.lang = cut.lang AND y.phrase = cut.rest
),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
inside AS (
    SELECT c.lang, array_to_string(c.w[i:i + s - 1], ' ') AS phrase, max(c.f) AS f
    FROM candidates c, unnest([2, 3]) AS t(s), unnest([1, 2, 3]) AS u(i) WHERE s < c.k AND i + s - 1 <= c.k GROUP BY ALL
),
ranked AS (
    SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank
    FROM scored s LEFT JOIN inside USING (lang, phrase) WHERE inside.f IS NULL OR 100::HUGEINT * inside.f < 80::HUGEINT * s.a
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def _vector_codes(rounds: int = 4) -> str:
    """Rounds of exact k-means, one block of CTEs each."""
    blocks = []
    for step in range(rounds + 1):
        blocks.append(f"""
near{step} AS (
    SELECT p.vec_id, p.part, p.x, min_by({{'entry': e.entry, 'd': d}}, (d, e.entry)) AS hit
    FROM parts p JOIN book{step} e ON e.part = p.part,
        LATERAL (SELECT list_sum(list_transform(list_zip(p.x, e.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d)
    GROUP BY ALL
)""")
        if step < rounds:
            blocks.append(f"""
mean{step} AS (
    SELECT part, entry, list(mean ORDER BY place) AS x FROM (
        SELECT part, hit.entry AS entry, place, floor(sum(x[place])::DECIMAL(38, 6) / count(*))::BIGINT AS rough,
            rough - (rough * count(*) > sum(x[place]))::BIGINT + ((rough + 1) * count(*) <= sum(x[place]))::BIGINT AS mean
        FROM near{step}, unnest(range(1, len(x) + 1)) AS t(place) GROUP BY part, hit.entry, place
    ) GROUP BY part, entry
),
book{step + 1} AS (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM book{step} b LEFT JOIN mean{step} m USING (part, entry))""")
    return f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda v: floor(v::DOUBLE * 1024)::BIGINT) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
),
parts AS (
    SELECT vec_id, part, x[part * (len(x) // 4) + 1:(part + 1) * (len(x) // 4)] AS x FROM kept, unnest([0, 1, 2, 3]) AS t(part)
),
book0 AS (
    SELECT part, entry, p.x FROM parts p JOIN
        (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 256) USING (vec_id)
),{",".join(blocks)},
coded AS (
    SELECT vec_id, string_agg(format('{{:02x}}', hit.entry), '' ORDER BY part) AS code, sum(hit.d)::BIGINT AS error
    FROM near{rounds} GROUP BY vec_id
),
digest AS (
    SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), digest
"""


VECTOR_CODES = _vector_codes()
