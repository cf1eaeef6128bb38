"""SQL equivalents of the queries, for DuckDB, written against the same adapters."""

from __future__ import annotations

import re

from checks.adapters import duck
from checks.queries import HEADROOM, MANY, NOW_S, PAGE_SIZE, PAGE_START
from docketflow.functions.case_types import CASE_TYPES
from docketflow.functions.courts import COURT_NAMES, COURT_STATES
from docketflow.functions.text import BLANKS

ORACLE: dict[str, str] = {}

CAP = 1_073_741_824


def sql(name: str, needs: str, body: str) -> None:
    ORACLE[name] = duck(tuple(f"fx_{n}" for n in needs.split()), body)


# -- expression helpers ------------------------------------------------------------------

_BLANK = " || ".join(f"chr({ord(c)})" for c in BLANKS)


def strip(x: str) -> str:
    return f"trim({x}, {_BLANK})"


def clip(x: str, n: int) -> str:
    return f"left(nullif({strip(x)}, ''), {n})"


_WORD = r"\p{L}\p{N}_"
_LEFT, _RIGHT = f"(?:^|[^{_WORD}])", f"(?:$|[^{_WORD}])"


def unicode_words(pattern: str) -> str:
    """The pattern with word boundaries spelled out, as this engine's are ASCII-only."""
    pattern = pattern.replace(r"\br\.?p\.?\b", rf"\br\.?p\b|\br\.?p\.[{_WORD}]")
    pattern = re.sub(r"(^|\|)\\b", lambda m: m[1] + _LEFT, pattern)
    pattern = re.sub(r"\\b($|\|)", lambda m: _RIGHT + m[1], pattern)
    assert r"\b" not in pattern, pattern
    return pattern


def case_type(x: str) -> str:
    arms = " ".join(
        f"WHEN regexp_matches({x}, '(?i){unicode_words(p)}') THEN '{label}'"
        for label, p in CASE_TYPES)
    return f"CASE {arms} END"


# Quotes are doubled for the SQL literal.
_TITLES = (r"(?i)^(?:(?:hon''?ble\s+)?(?:the\s+)?"
           r"(?:mr\.?|mrs\.?|ms\.?|dr\.?|justice|chief\s+justice)\s*)+")


def judge_name(x: str) -> str:
    bare = f"regexp_replace({strip(x)}, '{_TITLES}', '')"
    return f"regexp_replace(lower({bare}), '[^a-z0-9]+', '', 'g')"


def bench_type(x: str) -> str:
    parts = rf"regexp_split_to_array({x}, '(?i)\s*(?:\||;|,|\band\b)\s*')"
    names = f"list_transform({parts}, lambda p: {judge_name('p')})"
    n = f"len(list_distinct(list_filter({names}, lambda p: p <> '')))"
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {n} = 0 THEN NULL WHEN {n} = 1 THEN "
            f"'single_judge' WHEN {n} = 2 THEN 'division_bench' WHEN {n} <= 4 THEN 'full_bench' "
            "ELSE 'constitution_bench' END")


def decision_year(x: str) -> str:
    return rf"try_cast(regexp_extract({x}, '(?:19|20)\d{{2}}', 0) AS INTEGER)"


def decision_date(x: str) -> str:
    t = strip(x)
    dmy = r"^(\d{1,2})[-/](\d{1,2})[-/]((?:19|20)\d{2})"

    def part(n):
        return f"lpad(regexp_extract({t}, '{dmy}', {n}), 2, '0')"

    year = f"regexp_extract({t}, '{dmy}', 3)"
    return (
        rf"CAST(CASE WHEN regexp_matches({t}, '^(?:19|20)\d{{2}}-\d{{2}}-\d{{2}}') "
        f"THEN try_cast(left({t}, 10) AS DATE) WHEN regexp_matches({t}, '{dmy}') "
        f"THEN try_cast({year} || '-' || {part(2)} || '-' || {part(1)} AS DATE) END AS VARCHAR)")


def parties(x: str) -> str:
    at = f"instr({x}, ' of ')"
    return f"nullif({strip(f'CASE WHEN {at} > 0 THEN substr({x}, {at} + 4) ELSE {x} END')}, '')"


def stem(x: str) -> str:
    return rf"regexp_replace({x}, '\.(pdf|html)$', '')"


def base(x: str) -> str:
    return f"regexp_extract({x}, '[^/]*$', 0)"


def blob(*xs: str) -> str:
    return "concat_ws(' ', " + ", ".join(f"nullif({x}, '')" for x in xs) + ")"


def prefix(t: str = "") -> str:
    return (f"CASE WHEN {t}source = 'hc' THEN 'hc/year=' || {t}year || '/court=' || {t}court "
            f"|| '/bench=' || {t}bench ELSE 'sc/year=' || {t}year || '/' "
            f"|| coalesce(nullif({t}court, ''), 'english') END")


PREFIX = prefix()

USABLE = ("filename LIKE '%.pdf' AND filename NOT LIKE '%/%' "
          "AND bytes BETWEEN 2048 AND 52428800")

COURTS = "courts(code, name, state) AS (VALUES " + ", ".join(
    f"('{c}', '{n}', '{COURT_STATES[c]}')" for c, n in COURT_NAMES.items()) + ")"

# -- discovery ---------------------------------------------------------------------------

_HC = f"""+ {COURTS},
idx AS (
  SELECT * FROM (
    SELECT *, {base('pdf_link')} AS file, row_number() OVER (
      PARTITION BY year, court_code, bench, {base('pdf_link')} ORDER BY ord DESC) AS rn
    FROM fx_hc_meta WHERE pdf_link IS NOT NULL AND pdf_link <> '') WHERE rn = 1),
raw AS (
  SELECT o.*, {prefix('o.')} AS prefix,
    {stem('o.filename')} AS stem, coalesce({clip('m.title', 500)}, {stem('o.filename')}) AS ttl,
    m.description AS descr, {clip('m.cnr', 64)} AS mcnr, {clip('m.judge', 1000)} AS mjudges,
    m.decision_date AS mdate, {clip('m.court', 255)} AS mcourt,
    {clip('m.disposal_nature', 5000)} AS mout
  FROM fx_objects o LEFT JOIN idx m ON o.year = m.year AND o.court = m.court_code
    AND o.bench = m.bench AND o.filename = m.file
  WHERE o.source = 'hc' AND {USABLE.replace('filename', 'o.filename')}),
hc AS (
  SELECT 'hc' AS source, bucket, s3_key, bytes,
    left('HC/' || court || '/' || bench || '/' || stem, 255) AS citation,
    left(coalesce(mcnr, 'HC/' || court || '/' || bench || '/' || stem), 255) AS source_citation,
    ttl AS title, coalesce({decision_year('mdate')}, year) AS year,
    {decision_date('mdate')} AS decision_date, coalesce(mcourt, c.name, court) AS court,
    'high_court' AS court_type, c.state AS state_name, bench,
    {bench_type('mjudges')} AS bench_type, {case_type(blob('ttl', 'descr'))} AS case_type,
    mjudges AS judges, {clip(parties('ttl'), 2000)} AS parties, mout AS outcome,
    'en' AS language, 'https://judgments.ecourts.gov.in/ (CNR ' || mcnr || ')' AS source_url,
    mcnr AS cnr, prefix
  FROM raw LEFT JOIN courts c ON c.code = raw.court)"""

_SC = f"""
sidx AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY year, path ORDER BY ord DESC) AS rn
    FROM fx_sc_meta WHERE path IS NOT NULL AND path <> '') WHERE rn = 1),
files AS (
  SELECT *, {stem('filename')} AS stem, {PREFIX} AS prefix,
    CASE WHEN instr({stem('filename')}, '_') = 0 THEN ''
      ELSE regexp_replace({stem('filename')}, '_[^_]*$', '') END AS base,
    regexp_extract({stem('filename')}, '[^_]*$', 0) AS suffix
  FROM fx_objects WHERE source = 'sc' AND {USABLE}),
picked AS (
  SELECT f.*, coalesce(a.ord, b.ord) AS ord FROM files f
  LEFT JOIN sidx a ON a.year = f.year AND a.path = f.base
  LEFT JOIN sidx b ON b.year = f.year AND b.path = f.stem),
sraw AS (
  SELECT p.bucket, p.s3_key, p.bytes, p.year, p.court AS kind, p.stem, p.suffix, p.prefix,
    coalesce({clip('m.title', 500)}, p.stem) AS ttl, m.description AS descr,
    coalesce({clip('m.citation', 200)}, {clip('m.nc_display', 200)}, {clip('m.case_id', 200)},
      'SC/' || p.year || '/' || p.stem) AS said,
    nullif(concat_ws(' | ', {clip('m.judge', 500)}, {clip('m.author_judge', 400)}), '') AS mjudges,
    nullif(concat_ws(' vs ', {clip('m.petitioner', 900)}, {clip('m.respondent', 900)}), '')
      AS mparties,
    m.decision_date AS mdate, {clip('m.court', 255)} AS mcourt,
    {clip('m.disposal_nature', 5000)} AS mout, {clip('m.cnr', 64)} AS mcnr
  FROM picked p LEFT JOIN sidx m ON m.year = p.year AND m.ord = p.ord),
sc AS (
  SELECT 'sc' AS source, bucket, s3_key, bytes,
    left('SC/' || year || '/' || stem || CASE WHEN kind <> 'english' AND suffix <> ''
      THEN '_' || suffix ELSE '' END, 255) AS citation,
    left(said, 255) AS source_citation, ttl AS title,
    coalesce({decision_year('mdate')}, year) AS year, {decision_date('mdate')} AS decision_date,
    coalesce(mcourt, 'Supreme Court of India') AS court, 'supreme_court' AS court_type,
    'India' AS state_name, CAST(NULL AS VARCHAR) AS bench,
    {bench_type('mjudges')} AS bench_type, {case_type(blob('ttl', 'descr'))} AS case_type,
    mjudges AS judges, {clip('mparties', 2000)} AS parties, mout AS outcome,
    CASE WHEN kind = 'english' THEN 'en'
      ELSE left(lower(CASE WHEN suffix = '' THEN 'regional' ELSE suffix END), 10) END AS language,
    'https://scr.sci.gov.in/' AS source_url, mcnr AS cnr, prefix
  FROM sraw)"""

sql("discover_hc", "objects hc_meta", _HC + " SELECT * FROM hc")
sql("discover_sc", "objects sc_meta", "+" + _SC + " SELECT * FROM sc")
sql("discovered_profile", "objects hc_meta sc_meta", _HC + "," + _SC + """
SELECT source, court, bench_type, case_type, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes
FROM (SELECT * FROM hc UNION ALL SELECT * FROM sc) GROUP BY ALL""")

_LEDGER = """ledger AS (
  SELECT CASE WHEN doc_id % 3 <> 0 THEN s3_key ELSE 'old/' || s3_key END AS s3_key,
    CASE WHEN doc_id % 5 <> 0 THEN 'O/' ELSE 'K/' END || CAST(doc_id AS VARCHAR) AS citation,
    doc_id AS id FROM fx_objects)"""
_BATCH = f"""+ {_LEDGER},
batch AS (
  SELECT s3_key, CASE WHEN doc_id % 19 = 0 THEN 'dup/' || (doc_id % 7)
    WHEN doc_id % 23 = 0 THEN NULL ELSE 'K/' || doc_id END AS citation,
    doc_id * 2 + twice.n AS ord
  FROM fx_objects, (VALUES (0), (1)) AS twice(n)),
unseen AS (
  SELECT *, row_number() OVER (PARTITION BY citation ORDER BY ord) AS nth FROM (
    SELECT *, row_number() OVER (PARTITION BY s3_key ORDER BY ord) AS copy FROM batch)
  WHERE copy = 1 AND s3_key NOT IN (SELECT s3_key FROM ledger)),
inserted AS (
  SELECT s3_key, citation, ord FROM unseen
  WHERE citation IS NULL OR (nth = 1 AND citation NOT IN (SELECT citation FROM ledger)))"""
sql("insert_or_ignore", "objects", _BATCH + " SELECT * FROM inserted")
sql("rejected_items", "objects", _BATCH + """
SELECT b.s3_key, b.citation, b.ord,
  CASE WHEN b.s3_key IN (SELECT s3_key FROM ledger) THEN 's3_key in ledger'
    WHEN b.ord > (SELECT min(x.ord) FROM batch x WHERE x.s3_key = b.s3_key) THEN 's3_key repeated'
    WHEN b.citation IN (SELECT citation FROM ledger) THEN 'citation in ledger'
    ELSE 'citation repeated' END AS reason
FROM batch b WHERE b.ord NOT IN (SELECT ord FROM inserted)""")
sql("arrival_ids", "objects", _BATCH + f"""
SELECT (SELECT max(id) FROM ledger) + row_number() OVER (ORDER BY s3_key) AS id, s3_key,
  'discovered' AS status, 0 AS attempts, 'en' AS language, CAST({NOW_S} AS BIGINT) AS discovered_at
FROM inserted""")

_SUMMARY = f"""+ {_LEDGER},
placed AS (SELECT *, {PREFIX} AS prefix FROM fx_objects),
summary AS (
  SELECT prefix, source, count(*) AS seen, count(*) FILTER (WHERE {USABLE}) AS usable,
    count(*) FILTER (WHERE {USABLE} AND s3_key NOT IN (SELECT s3_key FROM ledger)) AS queued,
    CASE WHEN year IN (2014, 2021) THEN 'truncated' END AS metadata_error
  FROM placed GROUP BY prefix, source, year)"""
_ISO = "regexp_matches(decision_date, '^20[0-9]{2}-')"
sql("metadata_triage", "hc_meta", f"""
SELECT CAST(year AS VARCHAR) AS year, court_code, CASE WHEN year = 2014 THEN 0 ELSE count(*) END AS n_rows,
  CASE WHEN year = 2014 THEN 0 ELSE count(title) END AS n_titles,
  CASE WHEN year = 2014 THEN NULL WHEN year % 2 = 1 THEN min(decision_date)
    ELSE min(left(decision_date, 10)) FILTER (WHERE {_ISO}) END AS first_date, year = 2014 AS damaged
FROM fx_hc_meta GROUP BY year, court_code""")
sql("scan_summary", "objects", _SUMMARY + " SELECT * FROM summary")
sql("scan_events", "objects log", _SUMMARY + f""",
lines AS (
  SELECT prefix, 0 AS line, 'warn' AS level, prefix || ': metadata unreadable ('
    || metadata_error || '), documents taken without it' AS message
  FROM summary WHERE metadata_error IS NOT NULL
  UNION ALL
  SELECT prefix, 1, 'info', prefix || ' scanned: ' || seen || ' objects, ' || usable
    || ' usable, ' || queued || ' new' FROM summary)
SELECT (SELECT max(id) FROM fx_log) + row_number() OVER (ORDER BY prefix, line) AS id,
  level, message, CAST({NOW_S} AS BIGINT) AS "at", CAST(NULL AS BIGINT) AS item_id FROM lines""")

# -- functions ---------------------------------------------------------------------------


def both(*columns: str) -> str:
    names = ", ".join(columns)
    return " UNION ALL ".join(
        f"SELECT '{c}' AS collection, ord, {names} FROM fx_{c}_meta" for c in ("hc", "sc"))


sql("case_types", "hc_meta sc_meta",
    f"SELECT collection, ord, {case_type(blob('title', 'description'))} AS case_type "
    f"FROM ({both('title', 'description')}) m")
sql("bench_types", "hc_meta sc_meta",
    f"SELECT collection, ord, {bench_type('judge')} AS bench_type, "
    f"{judge_name('judge')} AS judge_name FROM ({both('judge')}) m")
sql("decision_dates", "hc_meta sc_meta",
    f"SELECT collection, ord, {decision_date('decision_date')} AS decision_date, "
    f"{decision_year('decision_date')} AS decision_year FROM ({both('decision_date')}) m")
sql("clip_and_parties", "hc_meta",
    f"SELECT ord, {clip('title', 500)} AS title, {clip(parties('title'), 2000)} AS parties, "
    f"{base('pdf_link')} AS file, {stem(base('pdf_link'))} AS stem, "
    f"coalesce({clip('cnr', 64)}, {clip('court', 255)}) AS label FROM fx_hc_meta")


def _unit(n: str, arms) -> str:
    out = arms(f"({n} / 1099511627776.0::DOUBLE)", "TiB")
    for power, unit in ((3, "GiB"), (2, "MiB"), (1, "KiB"), (0, "B")):
        out = (f"CASE WHEN {n} < {1024 ** (power + 1)} THEN "
               f"{arms(f'({n} / {1024 ** power}.0::DOUBLE)', unit)} ELSE {out} END")
    return out


def human(n: str) -> str:
    return _unit(n, lambda v, u: f"CAST({n} AS BIGINT) || ' B'" if u == "B"
                 else f"printf('%.1f', {v}) || ' {u}'")


def short(n: str) -> str:
    def arm(v, u):
        whole = f"CAST(floor({v} + 0.5) AS BIGINT) || ' {u}'"
        if u == "B":
            return whole
        return (f"CASE WHEN {v} < 10 THEN printf('%.1f', floor({v} * 10 + 0.5) / 10) || ' {u}' "
                f"ELSE {whole} END")
    return f"CASE WHEN {n} IS NULL THEN '–' ELSE {_unit(n, arm)} END"


sql("human_sizes", "items",
    f"SELECT id, {human('n')} AS long_form, {short('n')} AS short_form "
    "FROM (SELECT id, bytes * (id % 997) AS n FROM fx_items)")
sql("event_clock", "log",
    "SELECT id, strftime(stamp, '%H:%M:%S') AS clock, left(message, 500) AS message FROM fx_log")

# -- catalogue ---------------------------------------------------------------------------

sql("catalogue_years", "objects", "SELECT DISTINCT year, source FROM fx_objects")
sql("catalogue_courts", "objects", f"""+ {COURTS}
SELECT DISTINCT o.year, o.court AS code, coalesce(c.name, o.court) AS name
FROM fx_objects o LEFT JOIN courts c ON c.code = o.court WHERE o.source = 'hc'""")
sql("catalogue_benches", "objects",
    "SELECT DISTINCT year, court, bench FROM fx_objects WHERE source = 'hc'")
sql("place_objects", "objects",
    "SELECT bucket, s3_key, filename, bytes, source, year, court, bench FROM fx_objects")
sql("expand_targets", "objects", """
SELECT DISTINCT source, year, court, bench FROM fx_objects
WHERE source = 'hc' AND year BETWEEN 2012 AND 2020 AND court IN ('9_13', '7_26', '99_9', '27_1')
UNION ALL
SELECT 'sc', CAST(y.year AS INTEGER), k.kind, NULL
FROM (SELECT unnest(range(min(year), max(year) + 1)) AS year FROM fx_objects) y,
  (VALUES ('english'), ('regional')) AS k(kind)""")
sql("prefix_roundtrip", "partitions", r"""
SELECT prefix, CASE WHEN ok THEN source END AS source,
  CASE WHEN ok THEN CAST(regexp_extract(prefix, 'year=(\d+)', 1) AS INTEGER) END AS year,
  CASE WHEN NOT ok THEN NULL WHEN source = 'hc' THEN regexp_extract(prefix, 'court=([^/]*)', 1)
    ELSE regexp_extract(prefix, '^sc/[^/]*/(.*)$', 1) END AS court,
  CASE WHEN ok AND source = 'hc' THEN regexp_extract(prefix, 'bench=(.*)$', 1) END AS bench,
  CASE WHEN ok THEN prefix END AS again
FROM (SELECT *, prefix NOT LIKE 'hc/broken%' AS ok FROM fx_partitions)
""".replace("CASE WHEN ok THEN source END", "CASE WHEN ok THEN left(prefix, 2) END"))

_OPEN = f"""+ targets AS (
  SELECT DISTINCT source, year, court, bench, {PREFIX} AS prefix FROM fx_objects),
fresh AS (SELECT * FROM targets
  WHERE prefix NOT IN (SELECT prefix FROM fx_partitions WHERE status = 'done'))"""
sql("plan_replace", "objects partitions", _OPEN + """
SELECT row_number() OVER (ORDER BY source, year, court, bench) - 1 AS pos, prefix, source, year,
  court, bench FROM fresh""")
sql("arrival_ids_in_plan", "objects partitions", _BATCH + "," + _OPEN.removeprefix("+") + f""",
plan AS (SELECT prefix, row_number() OVER (ORDER BY source, year, court, bench) AS pos FROM fresh),
keyed AS (SELECT i.s3_key, i.ord, {PREFIX} AS prefix FROM inserted i JOIN fx_objects o ON o.s3_key = i.s3_key)
SELECT (SELECT max(id) FROM ledger) + row_number() OVER (ORDER BY pos NULLS LAST, prefix, ord) AS id,
  s3_key, prefix FROM keyed LEFT JOIN plan USING (prefix)""")
sql("plan_append", "objects partitions", _OPEN + """
SELECT row_number() OVER (ORDER BY source, year, court, bench) - 1 AS pos, prefix, source, year,
  court, bench FROM fresh""")
_CANNOT = "'cannot list ' || w.prefix"
sql("plan_walk", "objects partitions", _OPEN + f""",
placed AS (SELECT *, row_number() OVER (ORDER BY source, year, court, bench) - 1 AS pos FROM fresh),
walked AS (SELECT prefix, source, year IN (2014, 2021) AS bad FROM placed
  WHERE pos >= {PAGE_START} AND pos < {PAGE_START + PAGE_SIZE}),
tallied AS (SELECT {PREFIX} AS prefix, count(*) AS found, count(*) FILTER (WHERE filename LIKE '%.pdf'
    AND filename NOT LIKE '%/%' AND bytes BETWEEN 2048 AND 52428800 AND doc_id % 3 = 0) AS queued
  FROM fx_objects GROUP BY 1),
tried AS (SELECT coalesce(p.prefix, w.prefix) AS prefix, coalesce(p.source, w.source) AS source, w.bad,
    CASE WHEN w.bad IS FALSE THEN t.found ELSE coalesce(p.found, 0) END AS found,
    CASE WHEN w.bad IS FALSE THEN t.queued ELSE coalesce(p.queued, 0) END AS queued,
    CASE WHEN w.bad IS NULL THEN p.scanned_s ELSE {NOW_S} END AS scanned_at,
    CASE WHEN w.bad IS NULL THEN p.status WHEN NOT w.bad THEN 'done'
      WHEN coalesce(p.attempts, 0) + 1 >= 4 THEN 'failed' ELSE 'pending' END AS status,
    CASE WHEN w.bad IS NULL THEN p.attempts WHEN w.bad THEN coalesce(p.attempts, 0) + 1 ELSE 0 END AS attempts,
    CASE WHEN w.bad IS NULL THEN p.error WHEN w.bad THEN {_CANNOT} END AS error,
    CASE WHEN w.bad IS NULL THEN p.next_s WHEN NOT w.bad THEN {NOW_S}
      ELSE CAST({NOW_S} + least(60 * power(2, coalesce(p.attempts, 0)), 900) AS BIGINT) END AS next_attempt_at
  FROM fx_partitions p FULL JOIN walked w ON p.prefix = w.prefix LEFT JOIN tallied t ON t.prefix = w.prefix)
SELECT prefix, t.source, found, queued, scanned_at, status, attempts, error, next_attempt_at, pos,
  pos < {PAGE_START + PAGE_SIZE} AS behind,
  CASE WHEN bad THEN CASE status WHEN 'failed' THEN 'error' ELSE 'warn' END END AS level,
  CASE WHEN bad THEN 'Scan failed for ' || prefix || ': ' || error
    || CASE status WHEN 'failed' THEN '' ELSE ' — will retry' END END AS message
FROM tried t LEFT JOIN placed USING (prefix)""")
sql("plan_progress", "objects partitions", _OPEN + """
SELECT count(*) AS total, least(5, count(*)) AS position, greatest(0, count(*) - 5) AS remaining
FROM fresh""")

# -- ledger ------------------------------------------------------------------------------

_STEP = ("CASE WHEN acc.spent + x.bytes <= {budget} AND len(acc.ids) < {limit} THEN "
         "{{'spent': acc.spent + x.bytes, 'ids': list_append(acc.ids, x.id), "
         "'bytes': CAST(0 AS BIGINT), 'id': CAST(0 AS BIGINT)}} ELSE acc END")
_ROW = "{'spent': CAST(0 AS BIGINT), 'ids': CAST([] AS BIGINT[]), 'bytes': bytes, 'id': id}"
_ZERO = ("{'spent': CAST(0 AS BIGINT), 'ids': CAST([] AS BIGINT[]), 'bytes': CAST(0 AS BIGINT), "
         "'id': CAST(0 AS BIGINT)}")


def _admit(budget: int, limit: int) -> str:
    step = _STEP.format(budget=budget, limit=limit)
    return f"""+ queue AS (
  SELECT id, bytes FROM fx_items WHERE status = 'discovered' AND bytes <= {budget}
  ORDER BY id LIMIT {limit * 4})
SELECT unnest(list_reduce(list_prepend({_ZERO}, rows), lambda acc, x: {step}).ids) AS id
FROM (SELECT list({_ROW} ORDER BY id) AS rows FROM queue)"""


sql("admit_under_budget", "items", _admit(HEADROOM, 8))
sql("admit_many", "items", _admit(HEADROOM * 200, MANY))
sql("claim_for_upload", "items", """
SELECT id, CASE WHEN id IN (SELECT id FROM fx_items WHERE status = 'downloaded'
    ORDER BY id LIMIT 4) THEN 'uploading' ELSE status END AS status FROM fx_items""")
sql("staging_paths", "items", f"""
SELECT id, 'batch' || batch_id || '/' || source || '/' || id || '_' || {base('s3_key')} AS path
FROM fx_items""")
sql("mark_downloaded", "items", f"""
SELECT id, CASE WHEN hit THEN 'downloaded' ELSE status END AS status,
  CASE WHEN hit THEN 'batch77/' || source || '/' || id || '_' || {base('s3_key')}
    ELSE local_path END AS local_path,
  CASE WHEN hit THEN bytes + id % 3 ELSE bytes END AS bytes,
  CASE WHEN hit THEN 77 ELSE batch_id END AS batch_id, attempts,
  CASE WHEN NOT hit THEN error END AS error,
  CASE WHEN hit THEN CAST({NOW_S} AS BIGINT) END AS downloaded_at
FROM (SELECT *, status = 'downloading' AND id % 5 <> 0 AS hit FROM fx_items)""")

_CLASSIFIED = r"""classified AS (
  SELECT item_id, http_status, outcome,
    CASE WHEN http_status IN (200, 201) THEN doc END AS document_id,
    CASE WHEN outcome = 'pushed' THEN NULL
      WHEN http_status IN (200, 201) THEN 'Upload accepted but no document id: ' || body
      ELSE CASE http_status WHEN 409 THEN 'Already in corpus: ' WHEN 401 THEN 'Unauthorised: '
        WHEN 403 THEN 'Forbidden — user lacks a corpus role: ' WHEN 400 THEN 'Rejected (400): '
        ELSE 'HTTP ' || http_status || ': ' END || said END AS message,
    'downloaded' AS retry_state
  FROM (
    SELECT *, CASE WHEN http_status IN (200, 201) AND doc IS NOT NULL THEN 'pushed'
        WHEN http_status IN (400, 409) THEN 'skipped' WHEN http_status IN (401, 403) THEN 'auth'
        ELSE 'retry' END AS outcome
    FROM (
      SELECT *, CASE WHEN json_valid(body)
          THEN try_cast(json_extract_string(body, '$.data.id') AS BIGINT) END AS doc,
        coalesce(CASE WHEN json_valid(body) THEN json_extract_string(body, '$.message') END,
          left(body, 300)) AS said
      FROM fx_responses)))"""
sql("classify_responses", "responses", "+ " + _CLASSIFIED + " SELECT * FROM classified")
sql("auth_halt", "responses", "+ " + _CLASSIFIED + """
SELECT bool_or(outcome = 'auth') AS halt, count(*) FILTER (WHERE outcome = 'auth') AS refused,
  min(message) FILTER (WHERE outcome = 'auth') AS reason FROM classified""")
sql("delivery_outcomes", "items responses", "+ " + _CLASSIFIED + f"""
SELECT i.id,
  CASE WHEN o.outcome IN ('pushed', 'skipped') THEN o.outcome WHEN o.outcome IS NULL THEN i.status
    WHEN i.attempts + 1 >= 3 THEN 'failed' ELSE 'downloaded' END AS status,
  CASE WHEN o.outcome IN ('auth', 'retry') THEN i.attempts + 1 ELSE i.attempts END AS attempts,
  CASE WHEN o.outcome IS NULL THEN i.error WHEN o.outcome = 'pushed' THEN NULL
    ELSE left(o.message, 500) END AS error,
  CASE WHEN o.outcome = 'pushed' THEN o.document_id ELSE i.document_id END AS document_id,
  CASE WHEN o.outcome IN ('pushed', 'skipped') THEN NULL ELSE i.local_path END AS local_path,
  CASE WHEN o.outcome = 'pushed' THEN CAST({NOW_S} AS BIGINT) END AS pushed_at
FROM fx_items i LEFT JOIN classified o ON o.item_id = i.id""")
ORACLE["replayed_responses"] = ORACLE["delivery_outcomes"].replace(
    "ON o.item_id = i.id", "ON o.item_id + 1 = i.id AND i.status = 'uploading'")
sql("download_failures", "items", """
SELECT id, CASE WHEN status <> 'downloading' THEN status WHEN attempts + 1 >= 3 THEN 'failed'
    ELSE 'discovered' END AS status,
  CASE WHEN status = 'downloading' THEN attempts + 1 ELSE attempts END AS attempts,
  CASE WHEN status = 'downloading' THEN 'timed out' ELSE error END AS error,
  document_id, local_path, CAST(NULL AS BIGINT) AS pushed_at FROM fx_items""")
sql("retry_failed", "items", """
SELECT id, CASE WHEN status <> 'failed' THEN status WHEN local_path IS NULL THEN 'discovered'
    ELSE 'downloaded' END AS status,
  CASE WHEN status = 'failed' THEN 0 ELSE attempts END AS attempts,
  CASE WHEN status <> 'failed' THEN error END AS error, local_path FROM fx_items""")
_KEPT = "local_path IN (SELECT path FROM fx_staged)"
sql("recover_inflight", "items staged", f"""
SELECT id, CASE WHEN status NOT IN ('downloading', 'uploading') THEN status
    WHEN {_KEPT} THEN 'downloaded' ELSE 'discovered' END AS status,
  CASE WHEN status NOT IN ('downloading', 'uploading') OR {_KEPT} THEN local_path END
    AS local_path, attempts FROM fx_items""")
sql("requeue_vanished", "items staged", f"""
SELECT id, CASE WHEN status = 'uploading' AND NOT {_KEPT} THEN 'discovered' ELSE status END
    AS status,
  CASE WHEN status = 'uploading' AND NOT {_KEPT} THEN NULL ELSE local_path END AS local_path,
  attempts FROM fx_items""")
sql("orphans", "items staged", """
SELECT path, bytes FROM fx_staged s
WHERE NOT EXISTS (SELECT 1 FROM fx_items i WHERE i.local_path = s.path)""")

_DONE = """SELECT batch_id, count(*) AS total,
  count(*) FILTER (WHERE status IN ('pushed', 'skipped', 'failed')) AS terminal,
  count(*) = count(*) FILTER (WHERE status IN ('pushed', 'skipped', 'failed')) AS done
FROM fx_items GROUP BY batch_id"""
sql("batch_completion", "items", _DONE)
sql("delivery_events", "items responses", "+ " + _CLASSIFIED + f"""
SELECT CASE o.outcome WHEN 'auth' THEN 'error' WHEN 'retry' THEN CASE WHEN i.attempts + 1 >= 3 THEN 'error'
    ELSE 'warn' END ELSE 'info' END AS level,
  CASE o.outcome WHEN 'pushed' THEN 'Pushed ' || i.citation || ' as document ' || o.document_id
    WHEN 'skipped' THEN 'Skipped ' || i.citation || ': ' || o.message
    WHEN 'auth' THEN 'Push halted: ' || o.message
    ELSE 'Push failed: ' || i.citation || ': ' || o.message END AS message, i.id AS item_id
FROM fx_items i JOIN classified o ON o.item_id = i.id
UNION ALL SELECT 'info', 'Batch ' || batch_id || ' complete', NULL FROM ({_DONE}) WHERE done""")
sql("open_batch", "items", f"""
SELECT coalesce(max(batch_id) FILTER (WHERE NOT done), max(batch_id) + 1) AS id,
  max(batch_id) FILTER (WHERE NOT done) IS NULL AS created FROM ({_DONE})""")
sql("batch_status", "items", f"""
SELECT batch_id AS id, 1700000000 + batch_id AS opened_at,
  CASE WHEN NOT done THEN CAST({NOW_S} AS BIGINT) END AS closed_at,
  CASE WHEN done THEN CAST({NOW_S} AS BIGINT) END AS pushed_at,
  CASE WHEN done THEN 'done' ELSE 'full' END AS status FROM ({_DONE})""")

_S = "{{'kind': '', 'ex': {ex}, 'st': {st}, 'att': {att}, 'fl': {fl}}}"


def _next(st="s.st", att="s.att", fl="s.fl", ex="true") -> str:
    return _S.format(ex=ex, st=st, att=att, fl=fl)


_STAGE = "CASE WHEN s.fl THEN 'downloaded' ELSE 'discovered' END"
_PARK = f"CASE WHEN s.att + 1 >= 3 THEN 'failed' ELSE {_STAGE} END"
sql("lifecycle_fold", "item_events", f"""+ histories AS (
  SELECT item_id, count(*) AS n_events, max(ts) AS last_ts, arg_max(event_id, ts) AS last_event_id,
    list({{'kind': kind, 'ex': false, 'st': '', 'att': CAST(0 AS BIGINT), 'fl': false}}
      ORDER BY ts, event_id) AS h
  FROM fx_item_events GROUP BY item_id),
folded AS (
  SELECT item_id, n_events, last_ts, last_event_id, list_reduce(list_prepend(
    {{'kind': '', 'ex': false, 'st': '', 'att': CAST(0 AS BIGINT), 'fl': false}}, h),
    lambda s, e: CASE
      WHEN NOT s.ex AND e.kind = 'discovered' THEN {_next("'discovered'", 'CAST(0 AS BIGINT)', 'false')}
      WHEN NOT s.ex THEN s
      WHEN e.kind = 'downloaded' THEN {_next("'downloaded'", fl='true')}
      WHEN e.kind = 'pushed' THEN {_next("'pushed'", fl='false')}
      WHEN e.kind = 'failed' THEN {_next(_PARK, 's.att + 1')}
      WHEN e.kind = 'retry' AND s.st = 'failed' THEN {_next(_STAGE, 'CAST(0 AS BIGINT)')}
      ELSE s END) AS s
  FROM histories)
SELECT item_id, s.st AS status, s.att AS attempts, s.fl AS has_file, n_events,
  last_event_id, strftime(last_ts, '%Y-%m-%d %H:%M:%S') AS last_ts
FROM folded WHERE s.ex""")
sql("event_rates", "item_events", """
SELECT window_s, kind, count(*) AS n_events, count(*) AS per_window
FROM (SELECT kind, CAST(floor(epoch(ts) / 21600) * 21600 AS BIGINT) AS window_s FROM fx_item_events)
GROUP BY ALL""")
sql("schema_migrate", "items", """
SELECT id, CAST(NULL AS VARCHAR) AS source_citation, CAST(NULL AS VARCHAR) AS decision_date,
  CAST(NULL AS VARCHAR) AS court_type, CAST(NULL AS VARCHAR) AS bench_type, 'en' AS language,
  0 AS attempts, status, bytes, seen_s AS discovered_at FROM fx_items""")

# -- reports -----------------------------------------------------------------------------

_HELD = "status IN ('downloaded', 'uploading', 'failed')"
_RESERVED = "status IN ('downloaded', 'uploading', 'failed', 'downloading')"


def total(where: str = "true", column: str = "bytes") -> str:
    return f"CAST(coalesce(sum({column}) FILTER (WHERE {where}), 0) AS BIGINT)"


sql("disk_usage", "items staged", f"""
SELECT *, filesystem_bytes - bytes_on_disk AS drift_bytes FROM (
  SELECT {total(_HELD)} AS bytes_on_disk, {total(_RESERVED)} AS reserved_bytes,
    (SELECT {total()} FROM fx_staged) AS filesystem_bytes FROM fx_items)""")
sql("held_with_file", "items", f"""
SELECT {total(_RESERVED + " AND (status <> 'failed' OR local_path IS NOT NULL)")} AS held_bytes
FROM fx_items""")
sql("ledger_stats", "items", """
SELECT source, status, CAST(grouping(source, status) AS BIGINT) AS level, count(*) AS n,
  CAST(sum(bytes) AS BIGINT) AS bytes
FROM fx_items GROUP BY GROUPING SETS ((source, status), (source), (status), ())""")


def count(where: str) -> str:
    return f"count(*) FILTER (WHERE {where})"


_CHANGED = """+ changed AS (SELECT source,
  CASE WHEN claimed AND id % 3 = 0 THEN 'downloaded' WHEN claimed THEN 'downloading'
    WHEN status = 'failed' AND local_path IS NULL THEN 'discovered'
    WHEN status = 'failed' THEN 'downloaded' ELSE status END AS status,
  CASE WHEN claimed AND id % 3 = 0 THEN bytes + 7 ELSE bytes END AS bytes
  FROM (SELECT *, status = 'discovered' AND id % 2 = 0 AS claimed FROM fx_items))"""
sql("stats_deltas", "items", _CHANGED + """
SELECT source, status, CAST(grouping(source, status) AS BIGINT) AS level, count(*) AS n,
  CAST(sum(bytes) AS BIGINT) AS bytes
FROM changed GROUP BY GROUPING SETS ((source, status), (source), (status), ())""")
sql("status_deltas", "items", _CHANGED + f"""
SELECT count(*) AS total_items, {', '.join(f"{count(f"status = '{x}'")} AS {x}" for x in (
    'discovered', 'downloading', 'downloaded', 'uploading', 'pushed', 'failed', 'skipped'))},
  {total("status = 'pushed'")} AS pushed_bytes, {total()} AS known_bytes,
  {total(_HELD)} AS bytes_on_disk, {total(_RESERVED)} AS reserved_bytes,
  min(bytes) FILTER (WHERE status = 'discovered') AS smallest_queued FROM changed""")
sql("source_stats", "items", f"""
SELECT source, count(*) AS total, {count("status = 'pushed'")} AS pushed,
  {count("status = 'discovered'")} AS queued, {count(_HELD)} AS on_disk,
  {count("status = 'failed'")} AS failed, {count("status = 'skipped'")} AS skipped,
  {total("status = 'pushed'")} AS pushed_bytes FROM fx_items GROUP BY source""")
sql("ledger_totals", "items", f"""
SELECT count(*) AS total_items, {total("status = 'pushed'")} AS pushed_bytes,
  {total()} AS known_bytes, {total(_HELD)} AS bytes_on_disk FROM fx_items""")
sql("queue_head", "items", f"""
SELECT min(bytes) FILTER (WHERE status = 'discovered') AS smallest_queued,
  {count("status = 'downloaded'")} > 0 AS pending_uploads FROM fx_items""")
sql("item_page", "items", """
SELECT id, source, s3_key, bytes, citation, title, year, court, bench, status, attempts, error,
  document_id, batch_id FROM fx_items WHERE status = 'failed' ORDER BY id DESC LIMIT 50 OFFSET 20""")
sql("item_table", "items", f"""
SELECT id, source, citation, title, coalesce(CAST(year AS VARCHAR), '–') AS year, court,
  {short('bytes')} AS size, status, coalesce(CAST(document_id AS VARCHAR), '–') AS document_id,
  coalesce(error, '') AS error FROM fx_items ORDER BY id DESC LIMIT 100""")
sql("item_lines", "items", f"""
SELECT id, lpad(CAST(id AS VARCHAR), 7, ' ') || ' ' || rpad(source, 3, ' ') || ' '
  || rpad(status, 11, ' ') || ' ' || lpad({human('bytes')}, 9, ' ') || '  '
  || rpad(left(citation, 48), 48, ' ') || ' ' || coalesce(left(error, 60), '') AS line
FROM fx_items WHERE status = 'skipped' ORDER BY id DESC LIMIT 40""")
sql("recent_events", "log", """
SELECT id, strftime(stamp, '%H:%M:%S') AS "at", level, message, item_id FROM fx_log
ORDER BY id DESC LIMIT 80""")
sql("event_retention", "log", """
SELECT id, level, message, item_id FROM fx_log
WHERE id >= (SELECT max(id) - 2000 FROM fx_log)""")
ORACLE["lifecycle_hot_items"] = ORACLE["lifecycle_late_events"] = ORACLE["lifecycle_fold"]
ORACLE["kv_latest"] = """
WITH writes AS (
  SELECT CAST(user_id AS VARCHAR) AS key, event_id AS seq,
    CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN '"' || event_type || '"'
      WHEN 2 THEN json_extract_string(props, '$.k') ELSE 'null' END AS value
  FROM events
  UNION ALL
  SELECT DISTINCT 'old' || CAST(user_id AS VARCHAR), -1, 'true' FROM events),
latest AS (SELECT key, arg_max(value, seq) AS value FROM writes GROUP BY key)
SELECT key, value, CASE WHEN value = 'null' THEN NULL
  WHEN json_valid(value) THEN json_extract_string(value, '$') ELSE value END AS decoded
FROM latest"""

# -- partitions --------------------------------------------------------------------------

_PARTS = "prefix, source, found, queued, scanned_s AS scanned_at, status, attempts, error, " \
         "next_s AS next_attempt_at"
_RESULTS = f"""+ parts AS (SELECT {_PARTS} FROM fx_partitions),
seen AS (SELECT {PREFIX} AS prefix, source, count(*) AS found,
  count(*) FILTER (WHERE filename LIKE '%.pdf') AS queued FROM fx_objects GROUP BY 1, 2)"""
sql("partition_scanned", "objects partitions", _RESULTS + f"""
SELECT coalesce(p.prefix, s.prefix) AS prefix, coalesce(p.source, s.source) AS source,
  coalesce(s.found, p.found) AS found, coalesce(s.queued, p.queued) AS queued,
  CASE WHEN s.prefix IS NULL THEN p.scanned_at ELSE {NOW_S} END AS scanned_at,
  CASE WHEN s.prefix IS NULL THEN p.status ELSE 'done' END AS status,
  CASE WHEN s.prefix IS NULL THEN p.attempts ELSE 0 END AS attempts,
  CASE WHEN s.prefix IS NULL THEN p.error END AS error,
  coalesce(p.next_attempt_at, 0) AS next_attempt_at
FROM parts p FULL JOIN seen s ON p.prefix = s.prefix""")
sql("partition_counts_merged", "objects", f"""
SELECT {PREFIX} AS prefix, source, count(*) AS found,
  count(*) FILTER (WHERE doc_id % 3 <> 0) AS queued, CAST(max(doc_id % 4) AS BIGINT) AS batch
FROM fx_objects GROUP BY 1, 2""")
sql("partition_failures", "objects partitions", _RESULTS + f"""
SELECT coalesce(p.prefix, s.prefix) AS prefix, coalesce(s.source, p.source) AS source,
  coalesce(p.found, 0) AS found, coalesce(p.queued, 0) AS queued,
  CASE WHEN s.prefix IS NULL THEN p.scanned_at ELSE {NOW_S} END AS scanned_at,
  CASE WHEN s.prefix IS NULL THEN p.status WHEN coalesce(p.attempts, 0) + 1 >= 4 THEN 'failed'
    ELSE 'pending' END AS status,
  CASE WHEN s.prefix IS NULL THEN p.attempts ELSE coalesce(p.attempts, 0) + 1 END AS attempts,
  CASE WHEN s.prefix IS NULL THEN p.error ELSE 'listing timed out' END AS error,
  CASE WHEN s.prefix IS NULL THEN p.next_attempt_at ELSE CAST({NOW_S}
    + least(60 * power(2, coalesce(p.attempts, 0)), 900) AS BIGINT) END AS next_attempt_at
FROM parts p FULL JOIN seen s ON p.prefix = s.prefix""")
sql("partition_retry", "partitions", """
SELECT prefix, source, found, queued, scanned_s AS scanned_at,
  CASE WHEN status = 'failed' THEN 'pending' ELSE status END AS status,
  CASE WHEN status = 'failed' THEN 0 ELSE attempts END AS attempts,
  CASE WHEN status <> 'failed' THEN error END AS error,
  CASE WHEN status = 'failed' THEN 0 ELSE next_s END AS next_attempt_at FROM fx_partitions""")
sql("partition_retry_queue", "partitions", rf"""
SELECT prefix, source, attempts,
  CASE WHEN NOT bad THEN CAST(regexp_extract(prefix, 'year=(\d+)', 1) AS INTEGER) END AS year,
  CASE WHEN bad THEN NULL WHEN source = 'hc' THEN regexp_extract(prefix, 'court=([^/]*)', 1)
    ELSE regexp_extract(prefix, '^sc/[^/]*/(.*)$', 1) END AS court,
  CASE WHEN NOT bad AND source = 'hc' THEN regexp_extract(prefix, 'bench=(.*)$', 1) END AS bench,
  bad AS malformed
FROM (SELECT *, prefix LIKE 'hc/broken%' AS bad FROM fx_partitions)
WHERE status = 'pending' AND next_s <= {NOW_S}""")
sql("partition_due_page", "partitions", f"""
SELECT prefix, attempts FROM fx_partitions WHERE status = 'pending' AND next_s <= {NOW_S}
ORDER BY next_s, prefix LIMIT 25""")
sql("partition_backlog", "partitions",
    "SELECT count(*) FILTER (WHERE status = 'pending') AS pending, "
    "count(*) FILTER (WHERE status = 'failed') AS failed FROM fx_partitions")
sql("newest_partitions", "partitions", """
SELECT prefix, source, found, queued, scanned_s AS scanned_at, status, attempts, error
FROM fx_partitions ORDER BY scanned_s DESC, prefix LIMIT 200""")
sql("backoff_delays", "partitions", """
SELECT prefix, CAST(least(60 * power(2, attempts), 900) AS BIGINT) AS delay_s
FROM fx_partitions""")

# -- delivery and status -----------------------------------------------------------------

_TEXTS = ("citation title parties court court_type bench bench_type decision_date case_type "
          "judges outcome").split()
sql("ledger_merge", "items", """
SELECT id, source, s3_key, bytes,
  CASE WHEN id % 6 = 0 THEN 'pushed' WHEN id % 3 = 0 THEN 'uploading' ELSE status END AS status,
  CASE WHEN id % 3 = 0 AND id % 6 <> 0 THEN attempts + 1 ELSE attempts END AS attempts,
  CASE WHEN id % 6 <> 0 THEN local_path END AS local_path
FROM fx_items""")
sql("payloads", "items",
    "SELECT id, batch_id, " + ", ".join(f"nullif({c}, '') AS {c}" for c in _TEXTS)
    + ", nullif(state_name, '') AS state, CAST(year AS VARCHAR) AS year, "
    "coalesce(nullif(language, ''), 'en') AS language, CASE WHEN source_url LIKE 'http%' "
    "AND source_url NOT LIKE '% %' THEN source_url END AS source_url FROM fx_items")

_JSON = ("citation title parties court court_type state bench bench_type year decision_date "
         "case_type judges outcome language source_url").split()
ORACLE["payload_json"] = "SELECT id, batch_id, '{' || concat_ws(',', " + ", ".join(
    f"'\"{c}\":' || CAST(to_json({c}) AS VARCHAR)" for c in _JSON
) + f") || '}}' AS payload FROM ({ORACLE['payloads']}) p"

_SNAP = _OPEN + f""",
i AS (SELECT {total(_RESERVED)} AS used, count(*) AS total_items,
    {total("status = 'pushed'")} AS pushed_bytes, {total()} AS known_bytes,
    {total(_HELD)} AS bytes_on_disk, min(bytes) FILTER (WHERE status = 'discovered') AS smallest,
    {count("status = 'discovered'")} AS discovered, {count("status = 'pushed'")} AS pushed,
    {count("status = 'downloaded'")} AS downloaded, {count("status = 'uploading'")} AS uploading,
    {count("status = 'failed'")} AS failed, {count("status = 'skipped'")} AS skipped
  FROM fx_items),
b AS (SELECT {count("status = 'pending'")} AS pending, {count("status = 'failed'")} AS pfailed,
    {count(f"status = 'pending' AND next_s <= {NOW_S}")} AS due FROM fx_partitions),
p AS (SELECT count(*) AS total, least(5, count(*)) AS position,
    greatest(0, count(*) - 5) AS remaining FROM fresh),
fs AS (SELECT {total()} AS fs_bytes FROM fx_staged)"""


def phase(paused: str, auto: str, cap: int) -> str:
    return f"""CASE WHEN {paused} THEN 'paused' WHEN {auto} AND downloaded > 0 THEN 'pushing'
  WHEN smallest > {cap} - used AND downloaded > 0 THEN 'cap-reached'
  WHEN smallest > {cap} - used THEN 'cap-blocked'
  WHEN discovered > 0 AND {cap} - used > 0 THEN 'downloading'
  WHEN remaining > 0 OR due > 0 THEN 'scanning'
  WHEN pending + pfailed > 0 THEN 'scan-incomplete' ELSE 'idle' END"""


sql("status_report", "items staged objects partitions", _SNAP + f"""
SELECT {phase('false', 'true', CAP)} AS phase,
  discovered + downloaded + uploading + remaining + pending + pfailed > 0 AS work_left,
  used AS used_bytes, fs_bytes AS filesystem_bytes, CAST({CAP} AS BIGINT) AS cap_bytes,
  greatest(0, {CAP} - used) AS free_bytes, CAST(round(round(used / {CAP}.0::DOUBLE * 100, 2) * 100) AS BIGINT) AS pct_hundredths,
  total AS plan_total, position AS plan_position, remaining AS plan_remaining,
  pending AS parts_pending, pfailed AS parts_failed, due, total_items, pushed_bytes, known_bytes,
  bytes_on_disk, smallest AS smallest_queued, discovered, pushed
FROM i, b, p, fs""")
sql("status_phases", "items staged objects partitions", _SNAP + f"""
SELECT 'paused' AS setting, {phase('true', 'true', CAP)} AS phase FROM i, b, p
UNION ALL SELECT 'auto push', {phase('false', 'true', CAP)} FROM i, b, p
UNION ALL SELECT 'manual, full', {phase('false', 'false', CAP)} FROM i, b, p
UNION ALL SELECT 'manual, room', {phase('false', 'false', 10**15)} FROM i, b, p""")
_MIB = "printf('%.0f', {} / 1048576.0::DOUBLE)"
sql("cap_cycle", "items staged objects partitions", _SNAP + f""",
opened AS (SELECT max(batch_id) AS batch FROM ({_DONE})),
capped AS (SELECT used, downloaded, greatest(0, {CAP} - used) AS free, batch, 'full' AS status,
  CAST({NOW_S} AS BIGINT) AS closed_at FROM i, opened WHERE smallest > {CAP} - used)
SELECT 1 AS turn, 'cap-reached' AS phase, batch, 'cap_notified' AS key, 'warn' AS level, 'Disk cap reached ('
  || {_MIB.format('used')} || ' MiB staged, ' || {_MIB.format('free')}
  || ' MiB free): the batch waits for a manual push' AS message, status, closed_at FROM capped WHERE downloaded > 0
UNION ALL SELECT 3, 'cap-blocked', batch, 'cap_blocked_notified', 'error', 'Cap held by '
  || {_MIB.format('used')} || ' MiB of failed rows with nothing to push: retry them or clean up',
  status, closed_at FROM capped""")
sql("status_headline", "items staged objects partitions", _SNAP + f"""
SELECT {short('used')} || ' / ' || {short(str(CAP))} AS disk,
  {short(f"greatest(0, {CAP} - used)")} || ' free · '
    || CAST(round(used / {CAP}.0::DOUBLE * 100, 2) AS VARCHAR) || '% of cap' AS free,
  {short('pushed_bytes')} || ' ingested' AS ingested, downloaded + uploading AS staged,
  discovered AS queued, failed || ' failed · ' || skipped || ' skipped (duplicates)' AS problems,
  position || ' / ' || total || ' partitions · ' || remaining || ' left' AS plan
FROM i, b, p""")
sql("status_lines", "items", f"""
SELECT status AS key, '  ' || rpad(status, 11, ' ') || ': ' || count(*) AS line FROM fx_items
WHERE status <> 'downloading' GROUP BY status
UNION ALL
SELECT source, '  ' || source || ': pushed=' || {count("status = 'pushed'")} || ' queued='
  || {count("status = 'discovered'")} || ' failed=' || {count("status = 'failed'")}
  || ' skipped=' || {count("status = 'skipped'")} FROM fx_items GROUP BY source
UNION ALL
SELECT 'ingested', 'ingested    : ' || {human('b')}
FROM (SELECT {total("status = 'pushed'")} AS b FROM fx_items)""")
