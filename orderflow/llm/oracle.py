"""SQL twins of the queries over the same tables."""

from __future__ import annotations

from orderflow.llm.quality_rules import STOP_WORDS

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"

MIXING = rf"""
WITH docs AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '{WORD}+'))::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 14))::BIGINT AS h
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight
  FROM docs GROUP BY source),
levels AS (
  SELECT *, 2 * source_size AS cap,
         (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(2 * source_size) OVER (
            ORDER BY 2 * source_size / weight, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
  FROM sources),
targets AS (
  SELECT *, least(cap::DOUBLE, max(lvl) OVER () * weight) AS target FROM levels),
budgets AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size)::INT END AS passes
  FROM targets),
hashes AS (
  SELECT source, h, sum(size) AS size,
         sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto
  FROM docs GROUP BY source, h),
edges AS (
  SELECT b.source, min_by(h.h + CASE WHEN h.upto - (b.target - b.passes * b.source_size)
           < (b.target - b.passes * b.source_size) - (h.upto - h.size) THEN 1 ELSE 0 END, h.h) AS edge
  FROM hashes h JOIN budgets b ON h.source IS NOT DISTINCT FROM b.source
  WHERE h.upto > b.target - b.passes * b.source_size
    AND b.target - b.passes * b.source_size > 0
  GROUP BY b.source)
SELECT d.doc_id, d.size, b.source_size, b.target,
       (d.size * (b.passes + CASE WHEN d.h < coalesce(e.edge, 0) THEN 1 ELSE 0 END))::BIGINT AS taken,
       d.source, (b.passes + CASE WHEN d.h < coalesce(e.edge, 0) THEN 1 ELSE 0 END)::INT AS copies
FROM docs d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
LEFT JOIN edges e ON d.source IS NOT DISTINCT FROM e.source
"""


#: Trim and lower-case as the operators do, on ASCII only.
_KEY = r"""translate(trim({0}, e' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""

LINE_DEDUP = rf"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM docs),
keyed AS (SELECT *, {_KEY.format("line")} AS k FROM lines),
found AS (
  SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT keyed.*, found.k IS NOT NULL AND doc_id <> top AS gone
  FROM keyed LEFT JOIN found USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

EXACT_DEDUP = rf"""
WITH docs AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '{SPACE}+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM docs WINDOW same AS (PARTITION BY t)
"""


QUALITY_RULES = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '{WORD}')) AS ls
  FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 3)) AS i,
         unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS x
  FROM docs WHERE len(w) >= 5),
repeated AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM windows),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS p FROM repeated WHERE n > 1) GROUP BY doc_id),
stats AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '{SPACE}', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_capitals,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: list_contains({{stop}}, lower(rtrim(x, '.,;:'))))) AS n_stop,
         len(list_filter(w, lambda x, i: i > 1 AND w[i - 1] = x)) AS n_echo,
         len(ls) AS n_lines,
         len(list_filter(ls, lambda x: x LIKE '%...' OR x LIKE '%…')) AS n_ellipsis,
         len(list_filter(ls, lambda x: regexp_matches(x, '^{SPACE}*[-*•]'))) AS n_bullet
  FROM docs LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       n_words >= 10 AND 100 * n_repeat_words <= 20 * n_words
       AND word_chars / n_words BETWEEN 2 AND 15 AND n_symbols / n_words <= 0.1::DOUBLE
       AND (n_stop / n_words >= 0.02::DOUBLE OR n_words < 50)
       AND n_capitals / word_chars <= 0.3::DOUBLE AND n_echo / n_words <= 0.2::DOUBLE
       AND (n_dup_lines / n_lines <= 0.5::DOUBLE OR n_words < 50)
       AND n_ellipsis / n_lines <= 0.3::DOUBLE AND n_bullet / n_lines <= 0.9::DOUBLE AS kept
FROM stats
"""


_BYTE = r"0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = (
    f"list_sum(list_transform(range(1, len({_DIGITS}) + 1), lambda i: "
    f"[[0,1,2,3,4,5,6,7,8,9],[0,2,4,6,8,1,3,5,7,9]][1 + (i + 1) % 2]"
    f"[1 + substr({_DIGITS}, (len({_DIGITS}) - i + 1)::INT, 1)::INT])) % 10 = 0"
)
_PATTERNS["secret"] = (
    r"""(?i:token|secret|password|passwd|key)["'']?[\x20]?[:=][\x20]?["'']?[A-Za-z0-9+/_-]{16,}"""
)
_MATCHES = " UNION ALL ".join(
    f"SELECT doc_id, {k} AS kind_no, '{kind}' AS kind, t, regexp_extract_all(t, '{pattern}') AS found, "
    f"string_split_regex(t, '{pattern}') AS between FROM docs WHERE regexp_matches(t, '{pattern}')"
    for k, (kind, pattern) in enumerate(_PATTERNS.items())
)
_SIGN = r"[\p{L}\p{M}\p{N}]"
_TOKEN = rf"{_SIGN}+(?:[-''\x{{2019}}\x{{2010}}\x{{2011}}]{_SIGN}+)*"

PII = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
matches AS ({_MATCHES}),
each AS (
  SELECT doc_id, kind_no, kind, unnest(found) AS v,
         unnest(list_transform(range(1, len(found) + 1), lambda k:
           list_sum(list_transform(between[:k], lambda x: length(x)))
           + coalesce(list_sum(list_transform(found[:k - 1], lambda x: length(x))), 0)))::BIGINT AS s
  FROM matches),
placed AS (
  SELECT doc_id, kind_no, kind, s + length(v) AS e,
         CASE kind WHEN 'secret' THEN regexp_extract(v, '[A-Za-z0-9+/_-]+$') ELSE v END AS v FROM each),
mentions AS (
  SELECT doc_id, kind_no, kind, e - length(v) AS s, e, kind || ':' || CASE
           WHEN kind IN ('email', 'ip') THEN lower(v) WHEN kind = 'secret' THEN v ELSE {_DIGITS} END AS entity
  FROM placed
  WHERE CASE kind WHEN 'email' THEN true WHEN 'secret' THEN true
    WHEN 'ip' THEN regexp_full_match(v, '{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}')
    WHEN 'card' THEN length({_DIGITS}) BETWEEN 14 AND 19 AND {_LUHN}
    ELSE length({_DIGITS}) BETWEEN 10 AND 15 END),
total AS (SELECT count(*)::DOUBLE AS n FROM docs),
named AS (SELECT DISTINCT doc_id, entity FROM mentions),
known AS (SELECT entity, count(*) AS n_e FROM named GROUP BY entity),
held AS (SELECT * FROM docs WHERE doc_id IN (SELECT doc_id FROM mentions)),
spoken AS (
  SELECT term, count(*) AS n_t FROM (
    SELECT unnest(list_distinct(list_transform(regexp_extract_all(t, '{_TOKEN}'), lambda x: lower(x)))) AS term
    FROM docs) GROUP BY term),
tokens AS (
  SELECT doc_id, unnest(regexp_extract_all(t, '{_TOKEN}')) AS w,
         unnest(string_split_regex(t, '{_TOKEN}')[:len(regexp_extract_all(t, '{_TOKEN}'))]) AS gap,
         unnest(range(1, len(regexp_extract_all(t, '{_TOKEN}')) + 1)) AS i
  FROM held),
spots AS (
  SELECT doc_id, lower(w) AS term, length(w) AS n,
         sum(length(w) + length(gap)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM tokens),
said AS (SELECT DISTINCT doc_id, term FROM spots),
pairs AS (
  SELECT entity, term, count(*) AS n_et FROM named JOIN said USING (doc_id) GROUP BY entity, term),
rated AS (
  SELECT entity, term, log2(n * n_et / (n_e * n_t)) / log2(n / n_e) AS told
  FROM pairs JOIN known USING (entity) JOIN spoken USING (term), total WHERE n_e < n),
told AS (
  SELECT doc_id, term, max(told) >= 0.9::DOUBLE AS removed
  FROM named JOIN rated USING (entity) JOIN said USING (doc_id, term)
  WHERE told >= 0.7::DOUBLE GROUP BY doc_id, term),
free AS (
  SELECT doc_id, 5 AS kind_no, 'term' AS kind, (e - n)::BIGINT AS s, e::BIGINT AS e, removed
  FROM spots JOIN told USING (doc_id, term)
  WHERE NOT EXISTS (SELECT 1 FROM mentions m
                    WHERE m.doc_id = spots.doc_id AND m.s < spots.e AND spots.e - spots.n < m.e)),
spans AS (
  SELECT doc_id, kind_no, kind, s, e, false AS removed FROM mentions UNION ALL SELECT * FROM free),
reached AS (
  SELECT *, coalesce(max(e) OVER (PARTITION BY doc_id ORDER BY s, kind_no
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM spans),
parts AS (
  SELECT r.*, substr(t, done + 1, greatest(s - done, 0))
              || CASE WHEN s < done OR removed THEN '' ELSE '[' || upper(kind) || ']' END AS part
  FROM reached r JOIN docs USING (doc_id)),
lists AS (
  SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, kind_no) FILTER (kind_no < 4) AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, kind_no) AS spans,
         string_agg(part, '' ORDER BY s, kind_no) AS head, max(e) AS upto
  FROM parts GROUP BY doc_id)
SELECT doc_id, coalesce(n_email, 0)::BIGINT AS n_email, coalesce(n_ip, 0)::BIGINT AS n_ip,
       coalesce(n_card, 0)::BIGINT AS n_card, coalesce(n_phone, 0)::BIGINT AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       sha256(coalesce(head, '') || substr(t, coalesce(upto, 0) + 1)) AS sanitised_sha256
FROM docs LEFT JOIN lists USING (doc_id)
"""

#: Classes of linked documents; {percent} is the least similarity.
SIMILAR = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '{WORD}+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 2),
                lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM docs),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
edges AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b
    ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {{percent}} * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS r FROM docs
  UNION SELECT reach.doc_id, e.b FROM reach JOIN edges e ON reach.r = e.a),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id{{more}}
FROM sets JOIN least USING (doc_id)
"""

#: The polynomial of CRC-32, reversed.
_CRC = 3988292384
_CRC32 = (
    "xor(4294967295, list_reduce(flatten(list_prepend([4294967295::BIGINT], list_transform("
    "string_split({0}, ''), lambda c: [ord(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), "
    f"lambda acc, b: xor(xor(acc, b) >> 1, {_CRC} * (xor(acc, b) & 1))))"
)

PERIODIC_RUNS = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}+') AS w,
         {_CRC32.format("doc_id::VARCHAR")} AS h FROM documents),
planned AS (
  SELECT *, len(w)::BIGINT AS n, (h // 10) % greatest(len(w), 1) AS a,
         1 + (len(w) - (h // 10) % greatest(len(w), 1)) // (3 + (h // 10) % 8) AS p FROM docs),
texts AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 THEN list_transform(range(n), lambda i:
           w[(CASE WHEN i >= a THEN a + (i - a) % p ELSE i END) + 1]) ELSE w END AS w FROM planned),
periods AS (SELECT doc_id, n, w, unnest(range(1, n // 4 + 1)) AS q FROM texts),
blocks AS (SELECT *, unnest(range(n // q - 2)) * q AS b FROM periods),
likely AS (
  SELECT DISTINCT doc_id, q FROM blocks
  WHERE w[b + 1] = w[b + q + 1] AND w[b + q // 2 + 1] = w[b + q // 2 + q + 1]
    AND w[b + q] = w[b + 2 * q] AND w[b + q + 1] = w[b + 2 * q + 1] AND w[b + 2 * q] = w[b + 3 * q]),
breaks AS (
  SELECT doc_id, q, list_prepend(-1::BIGINT, list_append(
           list_filter(range(n - q), lambda x: w[x + 1] <> w[x + q + 1]), n - q)) AS x
  FROM likely JOIN texts USING (doc_id)),
stretches AS (
  SELECT doc_id, q, unnest(x[:-2]) + 1 AS s, unnest(x[2:]) - unnest(x[:-2]) - 1 + q AS len FROM breaks),
runs AS (
  SELECT doc_id, s, len, min(q) AS q FROM stretches
  WHERE len >= 6 AND len >= 4 * q GROUP BY doc_id, s, len),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY len::DOUBLE / q DESC, s, q) AS k FROM runs),
lists AS (
  SELECT doc_id, count(*) AS n_runs, max(s) FILTER (k = 1) AS s, max(len) FILTER (k = 1) AS len,
         max(q) FILTER (k = 1) AS q, list({{'lo': s + q, 'hi': s + len}}) AS gone,
         string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS said
  FROM ranked GROUP BY doc_id),
spoken AS (
  SELECT doc_id, n_runs, s, len, q, said, CASE WHEN gone IS NULL THEN w ELSE list_transform(
           list_filter(range(n), lambda i: NOT list_bool_or(list_transform(gone,
             lambda r: i >= r.lo AND i < r.hi))), lambda i: w[i + 1]) END AS kept
  FROM texts LEFT JOIN lists USING (doc_id))
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, len::BIGINT AS length,
       q::BIGINT AS period, (1000 * len // q)::BIGINT AS exponent_milli,
       sha256(coalesce(said, '')) AS runs_sha256,
       sha256(array_to_string(kept, ' ')) AS collapsed_sha256
FROM spoken
"""

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"((('0x' || substr(h, {5 * group + 1}, 5))::BIGINT >> {shift}) & 31)::INT + 1, 1)"
    for group in range(8)
    for shift in (15, 10, 5, 0)
)

WARC = f"""
WITH digests AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h
  FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM digests)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""


def _stop_words() -> str:
    known = sorted(set().union(*STOP_WORDS.values()))
    return "[" + ", ".join(f"'{word}'" for word in known) + "]"


def oracle_sql() -> dict[str, str]:
    return {
        "op3_line_dedup": LINE_DEDUP,
        "op4_exact_dedup": EXACT_DEDUP,
        "op5_quality_rules": QUALITY_RULES.replace("{stop}", _stop_words()),
        "op6_pii": PII,
        "op7_mixing": MIXING,
        "op8_near_dedup": SIMILAR.format(percent=80, more=", doc_id = component_id AS kept"),
        "op10_warc": WARC,
        "op11_periodic_runs": PERIODIC_RUNS,
        "op12_ngram_join": SIMILAR.format(percent=85, more=""),
    }
