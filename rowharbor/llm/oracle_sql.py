"""SQL that yields the rows of some of the queries, for tables of moderate size."""

from __future__ import annotations

PASSAGES = r"""WITH worded AS (SELECT doc_id, REGEXP_EXTRACT_ALL(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, UNNEST(RANGE(1, LEN(w) - 48)) AS i FROM worded),
windows AS (SELECT doc_id, i, ARRAY_TO_STRING(w[i:i + 49], ' ') AS x FROM starts),
firsts AS (SELECT x, MIN(doc_id) AS first FROM windows GROUP BY x),
gone AS (SELECT DISTINCT doc_id, UNNEST(RANGE(i, i + 50)) AS j FROM windows JOIN firsts USING (x) WHERE first < doc_id),
words AS (SELECT doc_id, UNNEST(w) AS word, UNNEST(RANGE(1, LEN(w) + 1)) AS j FROM worded),
kept AS (SELECT doc_id, COUNT(g.j) AS n_removed, STRING_AGG(word, ' ' ORDER BY j) FILTER (WHERE g.j IS NULL) AS kept
  FROM words LEFT JOIN gone g USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, LEN(w) AS n_words, COALESCE(n_removed, 0) AS n_removed, SHA256(COALESCE(kept, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (doc_id)"""


def _field(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE STRLEN(CAST({column} AS VARCHAR)) || ':' || {column} END"


def _leaf(text: str) -> str:
    return f"SHA256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


def _steps(nodes: str, depth: str, tree: str) -> str:
    """What stands left and right of every node within its run of three."""
    run = f"PARTITION BY {tree}, level, p // 3 ORDER BY p ROWS BETWEEN"
    return f"""SELECT {tree}, level AS depth, p, COALESCE(STRING_AGG(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  COALESCE(STRING_AGG(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {nodes} WHERE level < {depth}"""


#: CRC-32 by its bits: a character is added, then eight shifts.
_CRC = """XOR(4294967295, LIST_REDUCE(LIST_PREPEND(CAST(4294967295 AS BIGINT), FLATTEN(LIST_TRANSFORM(STRING_SPLIT(CAST(doc_id AS VARCHAR), ''),
  lambda c: [CAST(ASCII(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda crc, c: CASE WHEN c >= 0 THEN XOR(crc, c) ELSE XOR(crc >> 1, (crc & 1) * 3988292384) END))"""

MANIFEST = f"""WITH RECURSIVE audited AS (SELECT *, CASE WHEN {_CRC} % 2 = 0 THEN REPLACE(text, CHR(10), '') ELSE text END AS seen FROM documents),
leaves AS (SELECT doc_id, {_leaf('text')} AS leaf, {_leaf('seen')} AS observed, DENSE_RANK() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
  ROW_NUMBER() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS p FROM audited),
powers AS (SELECT k, CAST(POW(3, k) AS BIGINT) AS reach FROM RANGE(39) t(k)),
counts AS (SELECT tree, COUNT(*) AS n FROM leaves GROUP BY tree),
sizes AS (SELECT tree, MIN(k) AS height FROM counts JOIN powers ON reach >= n GROUP BY tree),
crown AS (SELECT MIN(k) AS crown_height FROM (SELECT COUNT(*) AS n FROM counts) JOIN powers ON reach >= n),
nodes AS (SELECT tree, 0 AS level, p, leaf AS digest, height FROM leaves JOIN sizes USING (tree) UNION ALL
  SELECT tree, level + 1, p // 3, SHA256(STRING_AGG(digest, '' ORDER BY p)), height FROM nodes WHERE level < height GROUP BY tree, level, p // 3, height),
subroots AS (SELECT tree, digest AS subroot FROM nodes WHERE level = height),
tops AS (SELECT 0 AS level, tree AS p, subroot AS digest, crown_height FROM subroots, crown UNION ALL
  SELECT level + 1, p // 3, SHA256(STRING_AGG(digest, '' ORDER BY p)), crown_height FROM tops WHERE level < crown_height GROUP BY level, p // 3, crown_height),
steps AS ({_steps('nodes', 'height', 'tree')}),
top_steps AS ({_steps('tops', 'crown_height', 'crown_height')}),
path AS (SELECT x.doc_id, x.tree, x.p, s.depth, s.l, s.r FROM leaves x JOIN steps s ON s.tree = x.tree AND s.p = x.p // CAST(POW(3, s.depth) AS BIGINT) UNION ALL
  SELECT x.doc_id, x.tree, x.p, 100 + s.depth, s.l, s.r FROM leaves x JOIN top_steps s ON s.p = x.tree // CAST(POW(3, s.depth) AS BIGINT)),
proofs AS (SELECT tree, p, STRING_AGG(l || r, '' ORDER BY depth) AS proof, LIST(l || '|' || r ORDER BY depth) AS steps FROM path GROUP BY tree, p),
folded AS (SELECT doc_id, leaf, subroot, (SELECT digest FROM tops WHERE level = crown_height) AS root, SHA256(COALESCE(proof, '')) AS proof_sha256,
  LIST_REDUCE(LIST_PREPEND(observed, COALESCE(steps, [])), lambda h, s: SHA256(SPLIT_PART(s, '|', 1) || h || SPLIT_PART(s, '|', 2))) AS folded_root
  FROM leaves JOIN subroots USING (tree) LEFT JOIN proofs USING (tree, p))
SELECT *, folded_root = root AS verified FROM folded"""


def _codes(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    steps = [
        """WITH kept AS (SELECT vec_id, label, LIST_TRANSFORM(embedding, lambda x: CAST(FLOOR(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND LEN(LIST_FILTER(embedding, lambda x: x IS NULL OR NOT ISFINITE(x))) = 0)""",
        f"parts AS (SELECT vec_id, p, v[p * (LEN(v) // {parts}) + 1:(p + 1) * (LEN(v) // {parts})] AS x FROM kept, RANGE({parts}) t(p))",
        f"""book0 AS (SELECT p, ROW_NUMBER() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries}))""",
    ]
    for k in range(rounds + 1):
        steps.append(f"""met{k} AS (SELECT vec_id, p, x, MIN(CAST(LIST_SUM(LIST_TRANSFORM(RANGE(1, LEN(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS BIGINT) * {entries} + e) AS best
  FROM parts JOIN book{k} USING (p) GROUP BY vec_id, p, x),
near{k} AS (SELECT vec_id, p, x, best % {entries} AS e, best // {entries} AS d FROM met{k})""")
        if k < rounds:
            steps.append(f"""sums{k} AS (SELECT p, e, i, CAST(SUM(y) AS BIGINT) AS s, COUNT(*) AS n FROM (SELECT p, e, UNNEST(x) AS y, UNNEST(RANGE(1, LEN(x) + 1)) AS i FROM near{k}) GROUP BY p, e, i),
means{k} AS (SELECT p, e, LIST((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM sums{k} GROUP BY p, e),
book{k + 1} AS (SELECT p, e, COALESCE(m.c, b.c) AS c FROM book{k} b LEFT JOIN means{k} m USING (p, e))""")
    steps.append(f"""coded AS (SELECT vec_id, STRING_AGG(PRINTF('%02x', e), '' ORDER BY p) AS code, CAST(SUM(d) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id),
digest AS (SELECT SHA256(STRING_AGG(ARRAY_TO_STRING(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded JOIN kept USING (vec_id), digest""")
    return ",\n".join(steps)


CODES = _codes()
