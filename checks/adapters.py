"""Inputs derived from the driver tables, as SQL both engines run.

Each adapter covers its whole base table; modulo arithmetic only spreads values over rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from docketflow.functions.courts import COURT_NAMES

_CODES = list(COURT_NAMES) + ["99_9"]
CODES = ", ".join(f"({i}, '{c}')" for i, c in enumerate(_CODES))

# One phrase per case type, then some without any.
_PHRASES = [
    "Habeas Corpus Petition", "Public Interest Litigation", "Letters Patent Appeal", "SLP No",
    "Anticipatory Bail", "Cancellation of the Bail", "Regular Bail", "Quashing", "T.P.(C)",
    "Crl. Rev", "WP(C)", "Crl.A", "RSA", "First Appeal", "C.A. No", "R.P. No",
    "Contempt", "Arb. P", "Income Tax", "PC Act", "Chargesheet", "Disciplinary", "OA",
    "C.P.(IB)", "Insolvency", "Execution Case", "Commercial Court", "Consumer",
    "Election Petition", "MACT", "LAR", "Divorce", "Hindu Marriage Act", "Rent Control",
    "Partition", "Specific Performance", "Injunction", "Suit for Declaration",
    "Money Suit", "S.C. No", "Misc", "Matter", "File", "X Private Ltd",
]
PHRASES = ", ".join(f"({i}, '{p}')" for i, p in enumerate(_PHRASES))

ADAPTERS = {
    "fx_docs": f"""
        SELECT doc_id, text, source, bucket, year, court, bench, filename, bytes,
          'data/pdf/year=' || CAST(year AS STRING)
            || CASE WHEN source = 'hc' THEN '/court=' || court || '/bench=' || bench
                    ELSE '/' || court END
            || '/' || filename AS s3_key
        FROM (
          SELECT d.doc_id, d.text,
            CASE WHEN d.doc_id % 4 = 3 THEN 'sc' ELSE 'hc' END AS source,
            CASE WHEN d.doc_id % 4 = 3 THEN 'indian-supreme-court-judgments'
                 ELSE 'indian-high-court-judgments' END AS bucket,
            CAST(2010 + d.doc_id % 15 AS INT) AS year,
            CASE WHEN d.doc_id % 8 = 7 THEN 'regional' WHEN d.doc_id % 4 = 3 THEN 'english'
                 ELSE c.code END AS court,
            CASE WHEN d.doc_id % 4 = 3 THEN CAST(NULL AS STRING) ELSE d.source END AS bench,
            CASE WHEN d.doc_id % 41 = 0 THEN 'sub/' ELSE '' END
              || CASE WHEN d.doc_id % 4 <> 3
                   THEN 'CN' || lpad(CAST(d.doc_id AS STRING), 12, '0') || '_1_2024-01-05'
                   ELSE CAST(2010 + d.doc_id % 15 AS STRING) || '_' || CAST(d.doc_id AS STRING)
                     || CASE WHEN d.doc_id % 97 = 3 THEN ''
                             WHEN d.doc_id % 8 <> 7 THEN '_EN'
                             WHEN d.doc_id % 16 = 7 THEN '_HIN' ELSE '_TAM' END END
              || CASE WHEN d.doc_id % 37 = 0 THEN '.html' ELSE '.pdf' END AS filename,
            CASE WHEN d.doc_id % 53 = 0 THEN CAST(1000 AS BIGINT)
                 ELSE CAST(d.n_chars * 2000 AS BIGINT) END AS bytes
          FROM {{documents}} d
          JOIN (VALUES {CODES}) AS c(i, code) ON d.doc_id % 26 = c.i
        ) placed""",
    "fx_objects": """
        SELECT doc_id, source, bucket, year, court, bench, filename, bytes, s3_key
        FROM fx_docs""",
    "fx_hc_meta": f"""
        SELECT year, court_code, bench, doc_id * 2 + copy AS ord,
          CASE WHEN doc_id % 13 = 0 THEN NULL WHEN doc_id % 17 = 0 THEN '   '
               WHEN copy = 1 THEN 'Corrected ' || phrase || ' of ' || text
               ELSE phrase || '/' || CAST(doc_id AS STRING) || '/2023 of ' || text || ' Vs STATE'
          END AS title,
          CASE WHEN doc_id % 6 = 0 THEN NULL WHEN doc_id % 6 = 1 THEN ''
               ELSE text || ' ' || phrase END AS description,
          CASE doc_id % 10
            WHEN 0 THEN NULL WHEN 1 THEN 'HON''BLE MR. JUSTICE A B'
            WHEN 2 THEN 'Justice A | HON''BLE MR. JUSTICE A' WHEN 3 THEN 'A, B'
            WHEN 4 THEN 'A; B and C' WHEN 5 THEN 'Mrs. X and Ms. X and Dr. X, Justice Y'
            WHEN 6 THEN 'A,B;C|D and E' WHEN 7 THEN 'Anand' WHEN 8 THEN 'Chief Justice'
            ELSE '  The Chief Justice R. Mohan AND Justice Dr. S.K. Anderson ' END AS judge,
          CASE WHEN doc_id % 7 = 0 THEN NULL
               ELSE 'court/cnrorders/' || court_code || '/' || filename END AS pdf_link,
          CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN ' '
               ELSE ' CNR' || lpad(CAST(doc_id AS STRING), 13, '0') || ' ' END AS cnr,
          CASE doc_id % 11
            WHEN 0 THEN NULL WHEN 1 THEN '2024-03-05 00:00:00' WHEN 2 THEN '05-03-2024'
            WHEN 3 THEN '5/3/2024' WHEN 4 THEN '05-03/2024' WHEN 5 THEN '31-02-2024'
            WHEN 6 THEN 'NaT' WHEN 7 THEN '3rd March 2019' WHEN 8 THEN '1899-01-01'
            WHEN 9 THEN ' 2012-12-31T10:00' ELSE '120190' END AS decision_date,
          CASE WHEN doc_id % 3 = 0 THEN NULL ELSE ' DISPOSED ' || text END AS disposal_nature,
          CASE WHEN doc_id % 4 = 0 THEN NULL ELSE 'Court of ' || court_code END AS court
        FROM (
          SELECT o.doc_id, o.year, o.court AS court_code, o.bench, o.filename, o.text, p.phrase,
                 v.copy
          FROM fx_docs o
          JOIN (VALUES {PHRASES}) AS p(i, phrase) ON o.doc_id % 44 = p.i
          JOIN (VALUES (0, 0), (11, 0), (11, 1)) AS v(every, copy)
            ON v.every = CASE WHEN o.doc_id % 11 = 0 THEN 11 ELSE 0 END
          WHERE o.source = 'hc'
        ) listed""",
    "fx_sc_meta": f"""
        SELECT year, doc_id * 2 + copy AS ord,
          CASE WHEN doc_id % 5 = 0 THEN stem ELSE base END AS path,
          CASE WHEN doc_id % 13 = 0 THEN NULL
               ELSE phrase || CASE WHEN copy = 1 THEN ' (revised)' ELSE '' END || ' ' || text
          END AS title,
          CASE WHEN doc_id % 7 = 0 THEN NULL ELSE ' P' || CAST(doc_id AS STRING) END AS petitioner,
          CASE WHEN doc_id % 11 = 0 THEN '' ELSE 'R ' || text END AS respondent,
          CASE WHEN doc_id % 6 = 0 THEN NULL ELSE text END AS description,
          CASE WHEN doc_id % 10 = 1 THEN NULL ELSE 'HON''BLE MR. JUSTICE A B, C D' END AS judge,
          CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'A B' WHEN 2 THEN 'E and F'
            ELSE 'Justice C D' END AS author_judge,
          CASE WHEN doc_id % 3 = 0 THEN NULL ELSE '[2024] ' || CAST(doc_id AS STRING) || ' SCR'
          END AS citation,
          CASE WHEN doc_id % 9 = 0 THEN ' ' ELSE '2024 INSC ' || CAST(doc_id AS STRING)
          END AS nc_display,
          CASE WHEN doc_id % 27 = 0 THEN NULL ELSE 'case ' || CAST(doc_id AS STRING)
          END AS case_id,
          CASE WHEN doc_id % 2 = 0 THEN NULL ELSE 'SCN' || CAST(doc_id AS STRING) END AS cnr,
          CASE doc_id % 5 WHEN 0 THEN '1-2-2020' WHEN 1 THEN '2021-11-30' WHEN 2 THEN ''
            WHEN 3 THEN 'heard in 1987' ELSE '31/12/2019 ' END AS decision_date,
          CASE WHEN doc_id % 3 = 1 THEN NULL ELSE 'Dismissed' END AS disposal_nature,
          CASE WHEN doc_id % 8 = 3 THEN NULL ELSE 'Supreme Court' END AS court
        FROM (
          SELECT o.doc_id, o.year, o.text, p.phrase, v.copy,
            CAST(o.year AS STRING) || '_' || CAST(o.doc_id AS STRING) AS base,
            replace(replace(replace(o.filename, 'sub/', ''), '.pdf', ''), '.html', '') AS stem
          FROM fx_docs o
          JOIN (VALUES {PHRASES}) AS p(i, phrase) ON o.doc_id % 44 = p.i
          JOIN (VALUES (0, 0), (11, 0), (11, 1)) AS v(every, copy)
            ON v.every = CASE WHEN o.doc_id % 11 = 0 THEN 11 ELSE 0 END
          WHERE o.source = 'sc'
        ) listed""",
    "fx_items": """
        SELECT id, source,
          'data/pdf/' || source || '/' || CAST(id % 1000 AS STRING) || '.pdf' AS s3_key,
          CASE WHEN source = 'sc' THEN 'indian-supreme-court-judgments'
               ELSE 'indian-high-court-judgments' END AS bucket,
          bytes, 'C/' || CAST(id AS STRING) AS citation,
          CASE WHEN id % 4 = 0 THEN NULL ELSE 'S/' || CAST(id AS STRING) END AS source_citation,
          CASE WHEN id % 12 = 0 THEN '' ELSE 'Title ' || note END AS title,
          CAST(2000 + id % 25 AS INT) AS year,
          CASE WHEN id % 3 = 0 THEN NULL ELSE '2024-01-05' END AS decision_date,
          CASE WHEN id % 10 = 0 THEN NULL ELSE note END AS court,
          CASE WHEN source = 'sc' THEN 'supreme_court' ELSE 'high_court' END AS court_type,
          CASE WHEN source = 'sc' THEN 'India' ELSE 'Delhi' END AS state_name,
          CASE WHEN source = 'sc' THEN NULL ELSE 'main' END AS bench,
          CASE WHEN id % 2 = 0 THEN 'single_judge' END AS bench_type,
          CASE WHEN id % 5 = 0 THEN 'writ_petition' END AS case_type,
          CASE WHEN id % 7 = 0 THEN '' ELSE 'A | B' END AS judges,
          'P vs R' AS parties,
          CASE WHEN id % 9 = 0 THEN 'Allowed' END AS outcome,
          CASE WHEN id % 8 = 0 THEN '' WHEN id % 8 = 1 THEN NULL WHEN id % 8 = 2 THEN 'hin'
               ELSE 'en' END AS language,
          CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'https://scr.sci.gov.in/'
            WHEN 2 THEN 'https://judgments.ecourts.gov.in/ (CNR 1)' ELSE 'ftp://x' END
            AS source_url,
          CASE WHEN id % 6 = 0 THEN NULL ELSE 'CNR' || CAST(id AS STRING) END AS cnr,
          status,
          CASE WHEN status IN ('downloaded', 'uploading')
                 OR (status = 'failed' AND id % 2 = 0)
                 OR (status = 'downloading' AND id % 4 = 1)
               THEN 'staging/batch' || CAST(batch_id AS STRING) || '/' || source || '/'
                    || CAST(id AS STRING) || '_' || CAST(id % 1000 AS STRING) || '.pdf'
          END AS local_path,
          CAST(id % 3 AS INT) AS attempts,
          CASE WHEN status IN ('failed', 'skipped') THEN 'error ' || note END AS error,
          CASE WHEN status = 'pushed' THEN id + 1000000 END AS document_id,
          batch_id, seen_s
        FROM (
          SELECT o_orderkey AS id,
            CASE WHEN o_custkey % 3 = 0 THEN 'sc' ELSE 'hc' END AS source,
            o_custkey % 50 AS batch_id, o_orderpriority AS note,
            CAST(floor(o_totalprice * 100) AS BIGINT) AS bytes,
            CASE WHEN o_custkey % 50 < 10
                 THEN CASE o_orderkey % 3 WHEN 0 THEN 'pushed' WHEN 1 THEN 'skipped'
                        ELSE 'failed' END
                 ELSE CASE o_orderkey % 7 WHEN 0 THEN 'discovered' WHEN 1 THEN 'downloading'
                        WHEN 2 THEN 'downloaded' WHEN 3 THEN 'uploading' WHEN 4 THEN 'pushed'
                        WHEN 5 THEN 'failed' ELSE 'skipped' END END AS status,
            1700000000 + o_orderkey AS seen_s
          FROM {orders}
        ) numbered""",
    "fx_staged": """
        SELECT CASE WHEN id % 19 = 0 THEN 'staging/stray/' || CAST(id AS STRING) || '.pdf'
                    ELSE local_path END AS path,
          bytes + id % 3 AS bytes
        FROM fx_items WHERE local_path IS NOT NULL""",
    "fx_partitions": """
        SELECT
          CASE WHEN seed % 29 = 7 THEN 'hc/broken/' || CAST(seed AS STRING) ELSE prefix END
            AS prefix,
          source, found, found - found % 3 AS queued, CAST(seed % 5 AS INT) AS attempts,
          CASE seed % 3 WHEN 0 THEN 'done' WHEN 1 THEN 'pending' ELSE 'failed' END AS status,
          CASE WHEN seed % 3 <> 0 THEN 'scan error ' || CAST(seed AS STRING) END AS error,
          1700000000 + seed AS scanned_s,
          CASE WHEN seed % 3 = 1 THEN 1700000000 + seed * 60 ELSE 0 END AS next_s
        FROM (
          SELECT source,
            CASE WHEN source = 'hc'
                 THEN 'hc/year=' || CAST(year AS STRING) || '/court=' || court
                      || '/bench=' || bench
                 ELSE 'sc/year=' || CAST(year AS STRING) || '/' || court END AS prefix,
            min(doc_id) AS seed, count(*) AS found
          FROM fx_objects GROUP BY source, year, court, bench
        ) grouped""",
    "fx_item_events": """
        SELECT user_id AS item_id, event_id, ts,
          CASE event_type WHEN 'signup' THEN 'discovered' WHEN 'view' THEN 'downloaded'
            WHEN 'click' THEN 'pushed' WHEN 'error' THEN 'failed' ELSE 'retry' END AS kind
        FROM {events}""",
    "fx_responses": """
        SELECT event_id AS item_id,
          CASE event_id % 9 WHEN 0 THEN 200 WHEN 1 THEN 201 WHEN 2 THEN 400 WHEN 3 THEN 401
            WHEN 4 THEN 403 WHEN 5 THEN 404 WHEN 6 THEN 409 WHEN 7 THEN 500 ELSE 503
          END AS http_status,
          CASE event_id % 5
            WHEN 0 THEN '{{"data": {{"id": ' || CAST(event_id + 7000 AS STRING) || '}}}}'
            WHEN 1 THEN '{{"data": {{}}, "message": "' || event_type || ' refused"}}'
            WHEN 2 THEN 'plain ' || event_type || ' ' || props
            WHEN 3 THEN '{{"data": null}}'
            ELSE '{{"message": "again", "data": {{"id": "' || CAST(event_id AS STRING) || '"}}}}'
          END AS body
        FROM {events}""",
    "fx_log": """
        SELECT event_id AS id, ts AS stamp,
          CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'warn' ELSE 'info' END
            AS level,
          props AS message,
          CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END AS item_id
        FROM {events}""",
}

BASE = ("documents", "orders", "events")


def _needs(name: str) -> list[str]:
    """Adapters ``name`` builds on, in dependency order, itself last."""
    order: list[str] = []
    for other in re.findall(r"\bfx_\w+", ADAPTERS[name]):
        order += [n for n in _needs(other) if n not in order]
    return order + [name]


def with_clause(*names: str) -> str:
    """``WITH`` list defining the adapters, base tables still in braces."""
    order: list[str] = []
    for name in names:
        order += [n for n in _needs(name) if n not in order]
    return "WITH " + ",\n".join(f"{n} AS ({ADAPTERS[n]})" for n in order)


def duck(names: tuple[str, ...], body: str) -> str:
    """DuckDB text: adapters as CTEs followed by the query."""
    head = with_clause(*names).format(**{t: t for t in BASE})
    joiner = ",\n" if body.lstrip().startswith("+") else "\n"
    return head + joiner + body.lstrip().removeprefix("+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.

    The small scales store all documents in one row group, which only one task can read.  When
    a table has fewer splits than the session has cores, its rows are spread before the text
    work; a table of cluster size has more splits than cores and is read as it lies.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if name == "documents" and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def adapter(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One adapter as a DataFrame over the parquet tables."""
    text = with_clause(name) + f"\nSELECT * FROM {name}"
    used = {t: table(spark, sf_dir, t) for t in BASE if f"{{{t}}}" in text}
    return spark.sql(text, **used)
