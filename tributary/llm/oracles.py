"""The SQL that checks the queries SQL can express, over the same tables."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SUBSTRINGS = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS rid,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x09-\x0D ]+'), lambda x: x <> '') AS words
  FROM documents
), windows AS MATERIALIZED (
  SELECT rid, doc_id, i, array_to_string(words[i:i + 12], ' ') AS w
  FROM (SELECT rid, doc_id, words, unnest(generate_series(1, len(words) - 12)) AS i FROM d)
), firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
covered AS (
  SELECT DISTINCT rid, i + unnest(generate_series(0, 12)) AS pos
  FROM windows JOIN firsts USING (w) WHERE first < doc_id
), placed AS (SELECT rid, unnest(words) AS word, unnest(generate_series(1, len(words))) AS pos FROM d),
marked AS (
  SELECT rid, count(*) AS n_words, count(c.pos) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (c.pos IS NULL) AS kept
  FROM placed LEFT JOIN covered AS c USING (rid, pos) GROUP BY rid
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN marked USING (rid)
"""


def _lloyd(rounds: int, entries: int, parts: int, scale: int) -> str:
    steps = [f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, embedding) - 1 AS rid, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c AS MATERIALIZED (
  SELECT rid, place // (dims // {parts}) AS p, place % (dims // {parts}) AS j, CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) AS c
  FROM (SELECT rid, len(embedding) AS dims, unnest(embedding) AS x, unnest(generate_series(0, len(embedding) - 1)) AS place FROM v)
), b0 AS MATERIALIZED (SELECT p, rid AS e, j, c AS b FROM c WHERE rid < {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT rid, p, min({{'d': d, 'e': e}}) AS best
  FROM (SELECT rid, p, e, CAST(sum((c - b) * (c - b)) AS BIGINT) AS d FROM c JOIN b{r} USING (p, j) GROUP BY rid, p, e)
  GROUP BY rid, p
)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (
  SELECT p, best.e AS e, j, CAST(sum(c) AS BIGINT) AS s, count(*) AS n FROM c JOIN a{r} USING (rid, p) GROUP BY ALL
), b{r + 1} AS MATERIALIZED (
  SELECT p, e, j, CASE WHEN n IS NULL THEN b ELSE (s - ((s % n) + n) % n) // n END AS b FROM b{r} LEFT JOIN m{r} USING (p, e, j)
)""")
    return ",".join(steps) + f""",
coded AS (
  SELECT rid, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds} GROUP BY rid
), books AS (SELECT sha256(string_agg(CAST(b AS VARCHAR), ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN coded USING (rid), books
"""


PHRASES = rf"""
WITH pieces AS MATERIALIZED (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x09 ]+'), lambda x: x <> '') AS words FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
  )
), totals AS (SELECT lang, sum(len(words)) AS n FROM pieces GROUP BY lang),
f AS MATERIALIZED (
  SELECT lang, phrase, m, count(*) AS a FROM (
    SELECT lang, m, array_to_string(words[i:i + m - 1], ' ') AS phrase FROM (
      SELECT lang, words, m, unnest(generate_series(1, len(words) - m + 1)) AS i FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS m)
    )
  ) GROUP BY ALL HAVING count(*) >= 30
), inside AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, max(a) AS longer FROM (
    SELECT *, unnest(generate_series(1, m - k + 1)) AS i FROM (
      SELECT lang, m, a, string_split(phrase, ' ') AS w, unnest(generate_series(2, m - 1)) AS k FROM f WHERE m > 2
    )
  ) GROUP BY ALL
), alone AS (
  SELECT lang, phrase, m, a, string_split(phrase, ' ') AS w FROM f LEFT JOIN inside USING (lang, phrase)
  WHERE m > 1 AND (longer IS NULL OR 100 * longer < 80 * a)
), cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[:k], ' ') AS first_part, array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM alone)
), scored AS (
  SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, CAST(CAST(2000000 AS HUGEINT) * c.a // (x.a + y.a) AS BIGINT) AS score
  FROM cuts AS c JOIN f AS x ON x.lang = c.lang AND x.phrase = first_part JOIN f AS y ON y.lang = c.lang AND y.phrase = rest
), weakest AS (SELECT lang, phrase, a, unnest(min({{'score': score, 'k': k, 'l': l, 'r': r}})) FROM scored GROUP BY lang, phrase, a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op11_substring_dedup": SUBSTRINGS,
    "op12_vector_codes": _lloyd(rounds=6, entries=16, parts=8, scale=4096),
    "op13_phrase_stripes": PHRASES,
}
