"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

WORD = r"[^\x20\x09-\x0D]+"

# The limits of operator 6, stated apart from the operator.
GRAM_LIMITS = {5: 25, 6: 24, 7: 23, 8: 22, 9: 21, 10: 20}
LINE_LIMIT, MIN_WORDS, MAX_REPEAT_WORDS, SYMBOLS = 30, 10, 20, "#*$%&|<>"


def repetition_sql() -> str:
    """Operator 6: windows over the words of every text."""
    grams = sorted({5, *GRAM_LIMITS})

    def gram(n: int) -> str:
        parts = ", ".join(f"lead(word, {k}) OVER t" if k else "word" for k in range(n))
        return f"CASE WHEN lead(word, {n - 1}) OVER t IS NOT NULL THEN concat_ws(' ', {parts}) END AS g{n}"

    return f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
      FROM (SELECT r, regexp_extract_all(text, '{WORD}') AS ws FROM texts)),
g AS (SELECT r, i, word, {', '.join(gram(n) for n in grams)} FROM w
      WINDOW t AS (PARTITION BY r ORDER BY i)),
d AS (SELECT r, i, length(word) AS chars,
      {', '.join(f"(g{n} IS NOT NULL AND count(*) OVER (PARTITION BY r, g{n}) > 1)::INT AS d{n}" for n in grams)}
      FROM g),
c AS (SELECT r, chars,
      {', '.join(f"max(d{n}) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c{n}" for n in grams)}
      FROM d),
a AS (SELECT r, count(*) AS n_words, sum(chars) AS word_chars, sum(c5) AS n_repeat_words,
      {', '.join(f"sum(c{n} * chars) AS dup_chars_{n}" for n in grams)} FROM c GROUP BY r),
lines AS (SELECT r, unnest(ls) AS line, generate_subscripts(ls, 1) AS i
      FROM (SELECT r, string_split(text, chr(10)) AS ls FROM texts)),
nth AS (SELECT r, line, row_number() OVER (PARTITION BY r, line ORDER BY i) AS k FROM lines
      WHERE regexp_matches(line, '{WORD}')),
dups AS (SELECT r, count(*) AS n_dup_lines,
      sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g'))) AS dup_line_chars
      FROM nth WHERE k > 1 GROUP BY r),
x AS (SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words,
      coalesce(word_chars, 0)::BIGINT AS word_chars,
      length(regexp_replace(text, '[^{SYMBOLS}]', '', 'g'))::BIGINT AS n_symbols,
      coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
      coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
      coalesce(dup_line_chars, 0)::BIGINT AS dup_line_chars,
      {', '.join(f"coalesce(dup_chars_{n}, 0)::BIGINT AS dup_chars_{n}" for n in GRAM_LIMITS)}
      FROM texts LEFT JOIN a USING (r) LEFT JOIN dups USING (r))
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_WORDS} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_WORDS} * n_words
            OR 100 * dup_line_chars > {LINE_LIMIT} * word_chars
            OR {' OR '.join(f"100 * dup_chars_{n} > {limit} * word_chars" for n, limit in GRAM_LIMITS.items())}) AS kept
FROM x"""


def near_sql(words: int, percent: int) -> str:
    """Operator 2: links from an inverted index over distinct sets, groups by recursion."""
    parts = ", ".join(f"lead(word, {k}) OVER t" if k else "word" for k in range(words))
    return f"""
WITH RECURSIVE texts AS (SELECT row_number() OVER () AS r, doc_id,
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
      FROM documents),
split AS (SELECT r, regexp_extract_all(text, '{WORD}') AS ws FROM texts),
w AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM split),
g AS (SELECT r, CASE WHEN lead(word, {words - 1}) OVER t IS NOT NULL
      THEN concat_ws(' ', {parts}) END AS s FROM w WINDOW t AS (PARTITION BY r ORDER BY i)),
s AS (SELECT DISTINCT r, s FROM g WHERE s IS NOT NULL
      UNION ALL SELECT r, array_to_string(ws, ' ') FROM split WHERE len(ws) BETWEEN 1 AND {words - 1}),
n AS (SELECT r, count(*) AS n, list_sort(list(s)) AS all_s FROM s GROUP BY r),
rep AS (SELECT r, n, min(r) OVER (PARTITION BY all_s) AS node FROM n),
ns AS (SELECT s.r, s.s, rep.n FROM s JOIN rep ON s.r = rep.r AND rep.r = rep.node),
links AS (SELECT a.r AS x, b.r AS y FROM ns a JOIN ns b ON a.s = b.s AND a.r < b.r
      AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
      GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links
      UNION ALL SELECT r, node FROM rep WHERE r <> node UNION ALL SELECT node, r FROM rep WHERE r <> node),
reach(a, b) AS (SELECT DISTINCT x, x FROM both_ways UNION SELECT reach.a, y FROM reach JOIN both_ways ON reach.b = x),
smallest AS (SELECT a AS r, min(t.doc_id) AS component_id FROM reach JOIN texts t ON t.r = b GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       doc_id IS NOT DISTINCT FROM coalesce(component_id, doc_id) AS kept
FROM texts LEFT JOIN n USING (r) LEFT JOIN smallest USING (r)"""


#: Operator 1: what the archives must say; SHA-1 from hexadecimal to base 32, five bits at a time.
WARC = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, url, html, sha1(html) AS hex, min(page_id) OVER (PARTITION BY html) AS first FROM p),
b AS (SELECT *, array_to_string([printf('%04b', instr('0123456789abcdef', hex[i]) - 1)
      FOR i IN range(1, 41)], '') AS bits FROM h)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       array_to_string([('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')[
           1 + list_sum([CASE bits[5 * i + j + 1] WHEN '1' THEN (16 >> j) ELSE 0 END FOR j IN range(0, 5)])::INT]
           FOR i IN range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to,
       url AS target_uri
FROM b"""

#: Operator 4: every query against every row.
TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
      FROM embeddings WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.x, v.x)::BIGINT AS score
      FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5"""



def crc32(value: str) -> str:
    """The unsigned CRC-32 of a value's decimal text."""
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({value}::VARCHAR, ''), "
            "lambda ch: ascii(ch)::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), "
            "lambda y, k: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)), 4294967295::BIGINT)")


#: Operator 11: every prefix of every rebuilt conversation, by the hashes of its turns.
TRIE = f"""
WITH t AS (SELECT conv_id::BIGINT AS conv_id, role, text, hash, length(text) AS chars,
      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, hash) - 1 AS pos
      FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
            md5(concat(strlen(coalesce(role, '')), ':', role, text)) AS hash FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base, {crc32('conv_id')} % 6 AS h FROM t GROUP BY conv_id),
r AS (SELECT c.conv_id, t.pos, t.hash, t.chars FROM c JOIN t ON t.conv_id = c.base AND t.pos < h
      UNION ALL SELECT c.conv_id, t.pos, t.hash, t.chars FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= h),
s AS (SELECT c.conv_id, coalesce(list(hash ORDER BY pos) FILTER (hash IS NOT NULL), []) AS hashes,
      coalesce(list(chars ORDER BY pos) FILTER (hash IS NOT NULL), []) AS sizes FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
m AS (SELECT conv_id, d AS depth, sizes[d] AS chars, array_to_string(hashes[1:d], '') AS path,
      CASE WHEN d > 0 THEN array_to_string(hashes[1:d - 1], '') END AS up, len(hashes) AS len FROM s, unnest(range(0, len(hashes) + 1)) u(d)),
n AS (SELECT path, min(up) AS up, min(conv_id) AS conv_id, min(depth) AS depth, count(*) AS n_convs, coalesce(min(chars), 0) AS chars,
      sha256(coalesce(string_agg(CASE WHEN len = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
      FROM m GROUP BY path),
k AS (SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM n x WHERE x.up = n.path) AS n_children
      FROM n LEFT JOIN n p ON p.path = n.up),
above AS (SELECT k.*, left(path, 32 * d) AS top FROM k, unnest(range(0, depth + 1)) u(d)),
sums AS (SELECT top, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens FROM above GROUP BY top)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM k JOIN sums ON top = path"""


def _leaf(text: str) -> str:
    fields = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
              for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256(concat({', '.join(fields)}))"


_UP = ("list_transform(range(0, (len(l) + 2) // 3), "
       "lambda i: sha256(array_to_string(list_slice(l, 3 * i + 1, 3 * i + 3), '')))")

#: Operator 12: trees as lists of digests, a level at a time; proofs and folds step by step.
MERKLE = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, source, {_leaf('text')} AS leaf,
      CASE WHEN doc_id IS NOT NULL AND {crc32('doc_id')} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS claim
      FROM documents),
placed AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS place,
      row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos FROM d),
own(place, level, l) AS (SELECT place, 0, list(leaf ORDER BY pos) FROM placed GROUP BY place
      UNION ALL SELECT place, level + 1, {_UP} FROM own WHERE len(l) > 1),
sub AS (SELECT place, l[1] AS subroot FROM own WHERE len(l) = 1),
top(level, l) AS (SELECT 0, list(subroot ORDER BY place) FROM sub
      UNION ALL SELECT level + 1, {_UP} FROM top WHERE len(l) > 1),
way AS (SELECT r, own.level AS lv, pos // (3 ** own.level)::BIGINT AS i, l
      FROM placed JOIN own ON own.place = placed.place WHERE len(l) > 1
      UNION ALL SELECT r, 1000 + top.level, place // (3 ** top.level)::BIGINT, l FROM placed CROSS JOIN top WHERE len(l) > 1),
steps AS (SELECT r, lv, array_to_string(list_slice(l, i - i % 3 + 1, i), '') AS before,
      array_to_string(list_slice(l, i + 2, i - i % 3 + 3), '') AS after FROM way),
walk AS (SELECT r, list(before ORDER BY lv) AS b, list(after ORDER BY lv) AS a FROM steps GROUP BY r),
fold(r, k, cur) AS (SELECT r, 1, claim FROM placed
      UNION ALL SELECT fold.r, k + 1, sha256(concat(b[k], cur, a[k])) FROM fold JOIN walk ON walk.r = fold.r WHERE k <= len(b)),
ends AS (SELECT r, arg_max(cur, k) AS folded_root FROM fold GROUP BY r)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(range(1, len(b) + 1),
       lambda k: concat(b[k], a[k])), ''), '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN sub USING (place) JOIN ends USING (r) LEFT JOIN walk USING (r)
CROSS JOIN (SELECT l[1] AS root FROM top WHERE len(l) = 1)"""


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ENCODINGS = [
    ("base10", "0-9", _DIGITS), ("base16", "0-9a-f", _DIGITS + "abcdef"),
    ("base16_upper", "0-9A-F", _DIGITS + "ABCDEF"), ("base32", "A-Z2-7", _UPPER + "234567"),
    ("base36", "0-9a-z", _DIGITS + _LOWER), ("base36_upper", "0-9A-Z", _DIGITS + _UPPER),
    ("base62", "0-9A-Za-z", _DIGITS + _UPPER + _LOWER),
    ("base64", "0-9A-Za-z+/", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", "0-9A-Za-z_-", _UPPER + _LOWER + _DIGITS + "-_")]


def _either(word: str) -> str:
    """A word in either case, of ASCII letters alone."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_ASSIGN = (f"({'|'.join(map(_either, ('password', 'passwd', 'secret', 'token', 'api_?key')))})"
           "[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)")


def _hits(kind: int, pattern: str, kept: str, part: str) -> str:
    return f"""SELECT r, {kind} AS kind, unnest(range(0, len(found))) AS i, unnest(gaps[1:len(found)]) AS gap, unnest(found) AS s, unnest({kept}) AS kept
      FROM (SELECT r, string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}', 0) AS found, {part} AS part FROM texts)"""


def _by_encoding(value: Callable[[str, str], object], other: object) -> str:
    whens = " ".join(f"WHEN regexp_full_match(token, '[{chars}]+') THEN {value(name, alphabet)}"
                     for name, chars, alphabet in _ENCODINGS)
    return f"CASE {whens} ELSE {other} END"


def _pairs(value: str) -> str:
    return f"list_transform(range(1, n), lambda i: {value})"


#: Operator 13: the base's spans, and the strings that battery and false-discovery control leave.
SECRETS = f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
hits AS ({_hits(0, _ASSIGN, 'list_transform(part, lambda x: length(x) >= 8)', f"regexp_extract_all(text, '{_ASSIGN}', 2)")}
      UNION ALL {_hits(1, 'AKIA[A-Z0-9]+', 'list_transform(found, lambda x: length(x) >= 16)', '[]')}
      UNION ALL {_hits(2, '[0-9a-f]+', 'list_transform(found, lambda x: length(x) >= 32)', '[]')}
      UNION ALL {_hits(3, '[A-Za-z0-9+/_-]+', 'list_transform(found, lambda x: length(x) >= 20)', '[]')}),
placed AS (SELECT *, sum(length(gap) + length(s)) OVER (PARTITION BY r, kind ORDER BY i) AS stop FROM hits),
spans AS (SELECT r, kind, (stop - length(s))::BIGINT AS start, stop::BIGINT AS stop, s FROM placed WHERE kept),
tokens AS (SELECT DISTINCT s AS token FROM spans WHERE kind = 3),
coded AS (SELECT token, {_by_encoding(lambda n, a: f"'{n}'", "'mixed'")} AS encoding, {_by_encoding(lambda n, a: len(a), 64)} AS m,
      length(token) AS n, list_transform(string_split(token, ''), lambda c: instr({_by_encoding(lambda n, a: f"'{a}'", "''")}, c) - 1) AS v,
      list_transform(string_split(token, ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN 0 WHEN c BETWEEN 'a' AND 'z' THEN 1
          WHEN c BETWEEN 'A' AND 'Z' THEN 2 ELSE 3 END) AS classes FROM tokens),
stats AS (SELECT *, greatest(2, least(16, m, n // 5)) AS k, list_sum(v)::DOUBLE AS s, list_sum(list_transform(v, lambda x: x * x))::DOUBLE AS q,
      list_sum({_pairs('v[i] * v[i + 1]')})::DOUBLE AS x, (v[1] + v[-1])::DOUBLE AS ends,
      len(list_filter(v, lambda x: 2 * x >= m))::DOUBLE AS high,
      (1 + list_sum({_pairs('((2 * v[i] >= m) <> (2 * v[i + 1] >= m))::INT')}))::DOUBLE AS runs,
      list_sum({_pairs('(classes[i] <> classes[i + 1])::INT')}) / (n - 1.0::DOUBLE) AS rate FROM coded),
tests AS (SELECT *, greatest(0, list_sum(list_transform(range(0, k), lambda b: len(list_filter(v, lambda y: y * k // m = b)) ** 2 * m::DOUBLE
          / (n * (((b + 1) * m + k - 1) // k - (b * m + k - 1) // k)))) - n) AS chi, 2 * high * (n - high) AS pairs,
      n::DOUBLE * n * q - n * s * s AS spread, n::DOUBLE * n * x - n * s * (2 * s - ends) + (n - 1) * s * s AS drift FROM stats),
scored AS (SELECT token, encoding, length(bin(n)) AS octave, CASE WHEN encoding = 'mixed' OR pairs <= n OR spread <= 0 OR rate <= 0.2 THEN 0
      WHEN sqrt(2 * chi) - sqrt(2.0::DOUBLE * k - 3) > 3 OR abs((runs - pairs / n - 1) / sqrt(pairs * (pairs - n) / (n::DOUBLE * n * (n - 1)))) > 3
          OR abs((drift / spread + 1.0::DOUBLE / n) * sqrt(n)) > 3 THEN 0
      ELSE least(60, floor((n - 1) * (rate * ln(rate / 0.2) + CASE WHEN rate < 1 THEN (1 - rate) * ln((1 - rate) / 0.8) ELSE 0 END) / ln(2))) END AS bits FROM tests),
strata AS (SELECT encoding, octave, bits, count(*) OVER (PARTITION BY encoding, octave) AS every,
      count(*) OVER (PARTITION BY encoding, octave ORDER BY bits DESC) AS upto FROM scored),
least AS (SELECT encoding, octave, min(bits) AS least FROM strata WHERE bits > 0 AND every <= 0.01 * upto * 2 ** bits GROUP BY ALL),
random AS (SELECT token FROM scored JOIN least USING (encoding, octave) WHERE bits >= least),
base AS (SELECT r, kind, start, stop FROM spans WHERE kind < 3),
everything AS (SELECT * FROM base UNION ALL SELECT r, 3, start, stop FROM spans s JOIN random ON s.s = token
      WHERE kind = 3 AND NOT EXISTS (SELECT 1 FROM base b WHERE b.r = s.r AND b.start <= s.start AND b.stop >= s.stop)),
named AS (SELECT *, concat_ws(':', ['assign', 'access', 'hex', 'random'][kind + 1], start, stop) AS span FROM everything),
done AS (SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
      string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY start, kind) AS spans FROM named GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM texts LEFT JOIN done USING (r)"""
