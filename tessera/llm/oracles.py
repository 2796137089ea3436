"""DuckDB SQL of the training-data queries that SQL can express.

op1 (media files), op2 (trained model), op3 (XXH64), op4 (trained model) and op7 (tokenizer)
have no SQL form; tests hold them against brute force.
"""

from __future__ import annotations

SPACE = r"[\x20\x09-\x0D]+"


def _matches(pattern: str, rank: int, kind: str, keep: str) -> str:
    """List of {start, rank, end, kind, m} of a pattern's matches; ``keep`` is a condition on m."""
    p = pattern.replace("'", "''")
    gaps, ms = f"string_split_regex(text, '{p}')", f"regexp_extract_all(text, '{p}', 0)"
    before = f"coalesce(list_sum(list_transform(({gaps})[1:i], lambda g: length(g))), 0) + coalesce(list_sum(list_transform(({ms})[1:i-1], lambda g: length(g))), 0)"
    made = f"list_transform(range(1, len({ms}) + 1), lambda i: {{'start': ({before})::BIGINT, 'rank': {rank}, 'end': ({before} + length(({ms})[i]))::BIGINT, 'kind': '{kind}', 'm': ({ms})[i]}})"
    return f"list_filter({made}, lambda s: {keep.replace('$m', 's.m')})"


def _listed(spans: str) -> str:
    return f"coalesce(array_to_string(list_transform({spans}, lambda s: s.kind || ':' || s.start || ':' || s.end), ','), '')"


DIGITS = "regexp_replace($m, '[^0-9]', '', 'g')"
LUHN = (
    f"length({DIGITS}) BETWEEN 14 AND 19 AND (list_sum(list_transform(range(1, length({DIGITS}) + 1), lambda j: CASE WHEN j % 2 = 0 THEN "
    f"(CASE WHEN substr(reverse({DIGITS}), j, 1)::INT > 4 THEN substr(reverse({DIGITS}), j, 1)::INT * 2 - 9 ELSE substr(reverse({DIGITS}), j, 1)::INT * 2 END) "
    f"ELSE substr(reverse({DIGITS}), j, 1)::INT END)) % 10 = 0)"
)
IP_OK = r"len(list_filter(string_split($m, '.'), lambda p: NOT regexp_full_match(p, '0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])'))) = 0"
MOD97 = (
    "list_reduce(list_concat([0], list_transform(string_split(substr($m, 5) || substr($m, 1, 4), ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c::INT ELSE ascii(c) - 55 END)), "
    "lambda a, v: CASE WHEN v < 10 THEN (a * 10 + v) % 97 ELSE (a * 100 + v) % 97 END) = 1"
)


def _pii() -> str:
    kinds = [
        _matches(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", 0, "email", "true"),
        _matches(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", 1, "ip", IP_OK),
        _matches(r"[0-9](?:[\x20-]?[0-9])+", 2, "card", LUHN),
        _matches(r"\+[0-9][\x20().0-9-]+[0-9]", 3, "phone", f"length({DIGITS}) BETWEEN 10 AND 15"),
        _matches(r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}\b", 4, "iban", MOD97),
    ]
    every = " || ".join(f"({k})" for k in kinds)
    near = "lower(substr(text, greatest(1, s.start - 39), least(40, s.start)))"
    prior = "CASE s.kind WHEN 'ip' THEN 0.5 WHEN 'card' THEN 0.7 WHEN 'phone' THEN 0.5 ELSE 0.8 END"
    context = f"""CASE s.kind WHEN 'email' THEN regexp_matches({near}, 'mail|contact|write to|@') WHEN 'ip' THEN regexp_matches({near}, 'ip|address|host|server|login')
        WHEN 'card' THEN regexp_matches({near}, 'card|visa|master|amex|payment|credit|debit') WHEN 'phone' THEN regexp_matches({near}, 'phone|tel|call|mobile|fax|whatsapp')
        ELSE regexp_matches({near}, 'iban|account|bank|transfer|konto') END"""
    count = lambda k: f"len(list_filter(all_spans, lambda s: s.kind = '{k}'))::BIGINT AS n_{k}"
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    f AS (SELECT doc_id, text, list_sort({every}) AS all_spans FROM d)
    SELECT doc_id, {", ".join(count(k) for k in ("email", "ip", "card", "phone"))},
      sha256({_listed("list_filter(all_spans, lambda s: s.rank < 4)")}) AS base_sha256, {_listed("all_spans")} AS spans,
      coalesce(array_to_string(list_transform(all_spans, lambda s: printf('%.2f', {prior} + CASE WHEN {context} THEN 0.2 ELSE 0.0 END)), ','), '') AS scores
    FROM f"""


def _secrets() -> str:
    assign = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    kinds = [
        _matches(assign, 0, "assign", f"length(regexp_extract($m, '{assign.replace(chr(39), chr(39) * 2)}', 1)) >= 6"),
        _matches("AKIA[A-Z0-9]+", 1, "access", "length($m) >= 20"),
        _matches("[0-9a-f]{24,}", 2, "hex", "true"),
        _matches("-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----", 3, "pem", "true"),
        _matches("gh[pousr]_[A-Za-z0-9]{36,}", 4, "github", "true"),
    ]
    every = " || ".join(f"({k})" for k in kinds)
    count = lambda k: f"len(list_filter(all_spans, lambda s: s.kind = '{k}'))::BIGINT AS n_{k}"
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    f AS (SELECT doc_id, list_sort({every}) AS all_spans FROM d)
    SELECT doc_id, {", ".join(count(k) for k in ("assign", "access", "hex"))},
      sha256({_listed("list_filter(all_spans, lambda s: s.rank < 3)")}) AS base_sha256, {_listed("all_spans")} AS spans FROM f"""


def _winnow() -> str:
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, {words} AS w FROM documents),
    b AS (SELECT item_id, {words} AS w FROM benchmark),
    i AS (SELECT item_id, w, least(len(w), 13) AS n FROM b WHERE len(w) > 0),
    x AS (SELECT DISTINCT item_id, n, array_to_string(w[k:k+n-1], ' ') AS span FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM i)),
    sizes AS (SELECT DISTINCT n FROM i),
    y AS (SELECT r, n, k, array_to_string(w[k:k+n-1], ' ') AS span FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
    m AS (SELECT y.r, y.k, y.n, x.item_id FROM y JOIN x USING (n, span)),
    h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM m) GROUP BY r),
    t AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM m GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
      coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)"""


def _mixing() -> str:
    return rf"""
    WITH d AS (SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '{SPACE}'), lambda x: x <> ''))::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '') || ':0') AS key FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM d GROUP BY source),
    w AS (SELECT source, source_size, ([5.0, 2.0, 1.0][k % 3 + 1])::DOUBLE AS w, source_size * 3.0::DOUBLE AS lim, (sum(source_size) OVER ())::DOUBLE AS total FROM s),
    l AS (SELECT *, (total - coalesce(sum(lim) OVER (ORDER BY lim / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY lim / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM w),
    v AS (SELECT arg_min(lev, lim / w) AS level FROM l WHERE w * lev <= lim),
    t AS (SELECT source, source_size, coalesce(least(lim, w * level), lim)::DOUBLE AS target FROM l, v),
    p AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM d),
    g AS (SELECT doc_id, size, source_size, target, ahead, round(target)::BIGINT AS goal, round(target)::BIGINT // greatest(source_size, 1) AS epochs FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target, (epochs * size + least(size, greatest(0, goal - epochs * source_size - ahead)))::BIGINT AS taken FROM g"""


def _warc() -> str:
    letter = lambda shift: f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, i * 5 + 1, 5))::INT >> {shift}) & 31) + 1, 1)"
    return f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    q AS (SELECT page_id, html, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS first FROM p)
    SELECT page_id, strlen(html)::BIGINT AS payload_bytes, array_to_string(list_transform(range(0, 8), lambda i: {" || ".join(letter(s) for s in (15, 10, 5, 0))}), '') AS payload_digest,
      CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM q"""


def oracle_sql() -> dict[str, str]:
    return {"op5_winnow": _winnow(), "op6_pii": _pii(), "op8_secrets": _secrets(), "op9_mixing": _mixing(), "op10_warc": _warc()}
