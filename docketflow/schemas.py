"""Declared schemas: ledger tables, listings and the two metadata collections."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.TimestampType()


def _struct(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in pairs])


ITEMS = _struct(
    ("id", _L), ("source", _S), ("s3_key", _S), ("bucket", _S), ("bytes", _L),
    ("citation", _S), ("source_citation", _S), ("title", _S), ("year", _I),
    ("decision_date", _S), ("court", _S), ("court_type", _S), ("state_name", _S),
    ("bench", _S), ("bench_type", _S), ("case_type", _S), ("judges", _S),
    ("parties", _S), ("outcome", _S), ("language", _S), ("source_url", _S),
    ("cnr", _S), ("status", _S), ("local_path", _S), ("attempts", _I), ("error", _S),
    ("document_id", _L), ("batch_id", _L), ("discovered_at", _TS),
    ("downloaded_at", _TS), ("pushed_at", _TS), ("claims", _L),
)
BATCHES = _struct(
    ("id", _L), ("opened_at", _TS), ("closed_at", _TS), ("pushed_at", _TS), ("status", _S),
)
PARTITIONS = _struct(
    ("prefix", _S), ("source", _S), ("found", _L), ("queued", _L), ("scanned_at", _TS),
    ("status", _S), ("attempts", _I), ("error", _S), ("next_attempt_at", _TS),
)
EVENTS = _struct(("id", _L), ("at", _TS), ("level", _S), ("message", _S), ("item_id", _L))
META = _struct(("key", _S), ("value", _S))
COUNTS = _struct(("source", _S), ("status", _S), ("size", _L), ("n", _L), ("bytes", _L))
TOTALS = _struct(
    ("prefix", _S), ("source", _S), ("found", _L), ("queued", _L), ("batch", _L),
)
PLAN = _struct(
    ("pos", _L), ("prefix", _S), ("source", _S), ("year", _I), ("court", _S), ("bench", _S),
)

TABLES = {
    "items": ITEMS, "batches": BATCHES, "scanned_partitions": PARTITIONS,
    "events": EVENTS, "meta": META, "plan": PLAN,
    "item_counts": COUNTS, "partition_totals": TOTALS,
}

# Defaults given to a column that an older table lacks (see sources.store.conform).
DEFAULTS = {
    "items": {"bytes": 0, "language": "en", "status": "discovered", "attempts": 0,
              "claims": 0},
    "batches": {"status": "open"},
    "scanned_partitions": {"found": 0, "queued": 0, "status": "done", "attempts": 0,
                           "next_attempt_at": "1970-01-01T00:00:00Z"},
    "events": {},
    "meta": {},
    "plan": {},
    "item_counts": {},
    "partition_totals": {},
}

# Columns a discovery job emits, in ledger order.
DISCOVERED = [
    "source", "bucket", "s3_key", "bytes", "citation", "source_citation", "title", "year",
    "decision_date", "court", "court_type", "state_name", "bench", "bench_type", "case_type",
    "judges", "parties", "outcome", "language", "source_url", "cnr",
]

OBJECTS = _struct(
    ("bucket", _S), ("s3_key", _S), ("filename", _S), ("bytes", _L),
    ("source", _S), ("year", _I), ("court", _S), ("bench", _S),
)
INVENTORY = _struct(("bucket", _S), ("s3_key", _S), ("bytes", _L))

# Only the columns discovery uses; the wide raw page column is never declared, so never read.
HC_METADATA = _struct(
    ("title", _S), ("description", _S), ("judge", _S), ("pdf_link", _S), ("cnr", _S),
    ("decision_date", _S), ("disposal_nature", _S), ("court", _S),
)
SC_METADATA = _struct(
    ("title", _S), ("petitioner", _S), ("respondent", _S), ("description", _S),
    ("judge", _S), ("author_judge", _S), ("citation", _S), ("case_id", _S), ("cnr", _S),
    ("decision_date", _S), ("disposal_nature", _S), ("court", _S), ("path", _S),
    ("nc_display", _S),
)
TARGETS = _struct(("source", _S), ("year", _I), ("court", _S), ("bench", _S))
