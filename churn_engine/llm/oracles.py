"""DuckDB SQL with the same rows as the corpus queries that SQL can express over whole tables."""

from __future__ import annotations

OP10 = """
WITH rows AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents
), groups AS (
    SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM rows GROUP BY body
)
SELECT r.doc_id, g.keep_id, g.group_size, r.doc_id = g.keep_id AS kept, sha256(r.body) AS text_sha256
FROM rows r JOIN groups g ON r.body = g.body
"""

OP4 = r"""
WITH words AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
    FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)
), numbered AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i AS pos, array_to_string(w[i:i + 49], ' ') AS body
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM numbered WHERE len(w) >= 50)
), least AS (
    SELECT body, min(doc_id) AS first_doc FROM windows GROUP BY body HAVING min(doc_id) < max(doc_id)
), repeated AS (
    SELECT doc_id, pos FROM windows JOIN least USING (body) WHERE doc_id > first_doc
), marked AS (
    SELECT w.doc_id, w.pos, w.word, max(r.pos) OVER (PARTITION BY w.doc_id ORDER BY w.pos) AS last_start
    FROM words w LEFT JOIN repeated r ON w.doc_id = r.doc_id AND w.pos = r.pos
), counted AS (
    SELECT doc_id, count(*) AS n_words, count(*) FILTER (last_start > pos - 50) AS n_removed,
           string_agg(word, ' ' ORDER BY pos) FILTER (last_start IS NULL OR last_start <= pos - 50) AS kept
    FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(c.n_words, 0) AS n_words, coalesce(c.n_removed, 0) AS n_removed, sha256(coalesce(c.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN counted c ON d.doc_id = c.doc_id
"""


OP6 = """
WITH rows AS (
    SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), groups AS (
    SELECT body, max(page_id) AS last_page FROM rows WHERE payload_bytes >= 1000 GROUP BY body
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, sha1(r.body) AS payload_digest,
       CASE WHEN page_id < last_page THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < last_page THEN last_page END AS refers_to
FROM rows r LEFT JOIN groups g ON r.body = g.body
"""

OP8 = """
WITH rules(host, path, verdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), rests AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), urls AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rests
), judged AS (
    SELECT u.page_id, max_by(struct_pack(rule := r.host || r.path, verdict := r.verdict), strlen(r.host || r.path)) AS best
    FROM urls u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
    GROUP BY u.page_id
)
SELECT u.page_id, u.host, u.path, j.best.rule AS rule, coalesce(j.best.verdict, 'allow') AS verdict
FROM urls u LEFT JOIN judged j ON u.page_id = j.page_id
"""


OP12 = r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), asked AS (
    SELECT item_id, term, count(*) AS repeats
    FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
    GROUP BY item_id, term
), totals AS (
    SELECT count(DISTINCT doc_id) AS documents, count(*) AS terms FROM words
), lengths AS (
    SELECT doc_id, 100 - 25 + ((25 * count(*) * any_value(documents)) // any_value(terms)) AS m FROM words, totals GROUP BY doc_id
), postings AS (
    SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM postings, totals GROUP BY term
), scores AS (
    SELECT a.item_id, p.doc_id, CAST(sum(a.repeats * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * l.m))) AS BIGINT) AS score
    FROM asked a JOIN postings p ON a.term = p.term JOIN weights w ON a.term = w.term JOIN lengths l ON p.doc_id = l.doc_id
    GROUP BY a.item_id, p.doc_id
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def _vector_codes(rounds: int = 6) -> str:
    """Six rounds of assigning and averaging, one step of CTEs for each."""
    steps = [
        """
WITH kept AS (
    SELECT vec_id, label, embedding AS v, len(embedding) // 8 AS size FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), places AS (
    SELECT vec_id, label, size, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS spot FROM kept
), parts AS (
    SELECT vec_id, label, CAST(spot // size AS INTEGER) AS part, CAST(spot % size AS INTEGER) AS place,
           CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) AS x
    FROM places
), first AS (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 16
), book0 AS (
    SELECT part, entry, place, x FROM parts JOIN first USING (vec_id)
)"""
    ]
    near = """, apart{r} AS (
    SELECT p.vec_id, p.part, b.entry, CAST(sum((p.x - b.x) * (p.x - b.x)) AS BIGINT) AS d
    FROM parts p JOIN book{r} b ON p.part = b.part AND p.place = b.place GROUP BY p.vec_id, p.part, b.entry
), near{r} AS (
    SELECT vec_id, part, entry, d FROM (
        SELECT vec_id, part, entry, d, row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) AS n FROM apart{r}
    ) WHERE n = 1
)"""
    move = """, mean{n} AS (
    SELECT n.part, n.entry, p.place, CAST(floor(CAST(sum(p.x) AS DOUBLE) / count(*)) AS BIGINT) AS x
    FROM near{r} n JOIN parts p ON n.vec_id = p.vec_id AND n.part = p.part GROUP BY n.part, n.entry, p.place
), book{n} AS (
    SELECT b.part, b.entry, b.place, coalesce(m.x, b.x) AS x
    FROM book{r} b LEFT JOIN mean{n} m ON b.part = m.part AND b.entry = m.entry AND b.place = m.place
)"""
    for r in range(rounds):
        steps += [near.format(r=r), move.format(r=r, n=r + 1)]
    steps += [
        near.format(r=rounds),
        """, coded AS (
    SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{r} GROUP BY vec_id
), labelled AS (
    SELECT c.vec_id, c.code, c.error, k.label FROM coded c JOIN kept k ON c.vec_id = k.vec_id
), told AS (
    SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, place)) AS digest FROM book{r}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM labelled, told
""".format(r=rounds),
    ]
    return "".join(steps)


def oracle_sql() -> dict[str, str]:
    return {"op4_substring_dedup": OP4, "op6_warc": OP6, "op8_url_filter": OP8, "op10_exact_dedup": OP10, "op12_ranked_search": OP12, "op13_vector_codes": _vector_codes()}
