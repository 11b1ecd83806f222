"""DuckDB SQL for the corpus queries that SQL can express, on the same tables."""

_OP1 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64.0 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, x.vec_id AS vec_id, CAST(list_dot_product(q.v, x.v) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

_OP3 = r"""
WITH p AS (
  SELECT doc_id, coalesce(source, '') AS site, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), l AS (
  SELECT doc_id, site, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM p
), k AS (
  SELECT *, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS key,
    regexp_matches(line, '([^\x20\x09-\x0D]+[\x20\x09-\x0D]+){2}[^\x20\x09-\x0D]+') AS judged FROM l
), b AS (
  SELECT key, min(struct_pack(doc_id := doc_id, pos := pos)) AS first
  FROM k WHERE judged GROUP BY key HAVING count(DISTINCT site) >= 10
), m AS (
  SELECT k.doc_id, k.pos, k.line, b.key IS NOT NULL AND NOT (b.first.doc_id = k.doc_id AND b.first.pos = k.pos) AS gone
  FROM k LEFT JOIN b ON k.judged AND k.key = b.key
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
  count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed
FROM m GROUP BY doc_id
"""


def _op4() -> str:
    base = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}\b",
    }
    digits = "regexp_replace(body, '[^0-9]', '', 'g')"
    luhn = f"""list_sum(list_transform(range(length({digits})), lambda i: CASE WHEN i % 2 = 0 THEN CAST(substr(reverse({digits}), i + 1, 1) AS INTEGER)
      ELSE (CAST(substr(reverse({digits}), i + 1, 1) AS INTEGER) * 2) % 10 + (CAST(substr(reverse({digits}), i + 1, 1) AS INTEGER) * 2) // 10 END)) % 10 = 0"""
    turned = "(substr(body, 5) || substr(body, 1, 4))"
    mod97 = f"""list_reduce(list_prepend(0, list_transform(range(length({turned})), lambda i: ascii(substr({turned}, i + 1, 1)))),
      lambda a, c: CASE WHEN c <= 57 THEN (a * 10 + c - 48) % 97 ELSE (a * 100 + c - 55) % 97 END) = 1"""
    confirmed = {
        "email": "true",
        "ip": "len(list_filter(string_split(body, '.'), lambda x: length(ltrim(x, '0')) > 3 OR CAST('0' || substr(ltrim(x, '0'), 1, 4) AS INTEGER) > 255)) = 0",
        "card": f"length({digits}) BETWEEN 16 AND 19 AND {luhn}",
        "phone": f"length({digits}) BETWEEN 8 AND 15",
        "iban": mod97,
    }
    context = {
        "email": "mail|contact|write",
        "ip": "ip|host|server|address",
        "card": "card|visa|credit|pay",
        "phone": "phone|call|tel|mobile",
        "iban": "iban|account|bank",
    }
    parts = [
        f"""SELECT doc_id, '{kind}' AS kind, {n} AS kind_no, start, start + length(body) AS stop, body,
  CASE WHEN regexp_matches(lower(substr(t, greatest(start - 40, 0) + 1, start - greatest(start - 40, 0))), '(^|[^a-z])({context[kind]})([^a-z]|$)')
    THEN '1.0' ELSE '0.7' END AS score
FROM (
  SELECT doc_id, t, bodies[i] AS body,
    CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(bodies[1:i-1], lambda g: length(g))), 0) AS BIGINT) AS start
  FROM (SELECT doc_id, t, bodies, gaps, unnest(range(1, len(bodies) + 1)) AS i FROM (
    SELECT doc_id, t, regexp_extract_all(t, '{p}') AS bodies, string_split_regex(t, '{p}') AS gaps FROM d))
) WHERE {confirmed[kind]}"""
        for n, (kind, p) in enumerate(base.items())
    ]
    mark = "kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT)"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), s AS ({" UNION ALL ".join(parts)}),
g AS (SELECT doc_id,
  {", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in list(base)[:4])},
  coalesce(string_agg({mark}, ',' ORDER BY kind_no, start) FILTER (WHERE kind_no < 4), '') AS base,
  string_agg({mark}, ',' ORDER BY kind_no, start) AS spans, string_agg(score, ',' ORDER BY kind_no, start) AS scores
FROM s GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in list(base)[:4])}, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""


_OP5 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn FROM d GROUP BY source
), w AS (
  SELECT *, CAST(CASE turn WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight, source_size * 3 AS cap FROM s
), f AS (
  SELECT *, coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left, sum(source_size) OVER () AS total
  FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)
), g AS (
  SELECT *, CAST(total - before AS DOUBLE) / weight_left AS level FROM f
), h AS (
  SELECT *, (SELECT arg_min(level, before) FROM g WHERE cap > weight * level) AS open FROM g
), t AS (
  SELECT source, source_size, turn, CASE WHEN open IS NULL OR cap <= weight * open THEN CAST(cap AS DOUBLE) ELSE weight * open END AS target FROM h
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.turn, CAST(floor(t.target) AS BIGINT) AS words,
    CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(CAST(d.doc_id AS VARCHAR)), d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), q AS (
  SELECT *, coalesce(words // nullif(source_size, 0), 0) AS full_passes FROM p
), r AS (
  SELECT *, full_passes * size + least(greatest(words - full_passes * source_size - place, 0), size) AS taken,
    coalesce(place / nullif(target, 0), 0) AS share FROM q
)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken,
  CASE WHEN taken > 0 THEN round(CASE turn
    WHEN 0 THEN 2.0 * (share * 5.0) / (7.5 + sqrt(greatest(56.25 - 10.0 * (share * 5.0), 0.0)))
    WHEN 1 THEN 2.0 * (share * 2.0) / (2.0 + sqrt(4.0))
    ELSE 2.0 * (share * 1.0) / (0.5 + sqrt(0.25 + 2.0 * (share * 1.0))) END, 6) END AS position
FROM r
"""

_OP8 = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

SQL: dict[str, str] = {"op1_topk": _OP1, "op3_line_spread": _OP3, "op4_pii": _op4(), "op5_curriculum": _OP5, "op8_exact": _OP8}
