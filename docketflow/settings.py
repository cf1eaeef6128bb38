"""Limits shared by the operators.  Every one is a parameter, never read from the environment."""

from __future__ import annotations

from dataclasses import dataclass

# The public open-data buckets holding the two collections.
HC_BUCKET = "indian-high-court-judgments"
SC_BUCKET = "indian-supreme-court-judgments"

# The life-cycle vocabulary of a ledger row.
ITEM_STATUSES = (
    "discovered", "downloading", "downloaded", "uploading",
    "pushed", "failed", "skipped",
)
ON_DISK = ("downloaded", "uploading", "failed")
RESERVED = ON_DISK + ("downloading",)
TERMINAL = ("pushed", "skipped", "failed")
EVENT_LEVELS = ("info", "warn", "error")


@dataclass(frozen=True)
class Limits:
    """Capacity and retry limits."""

    disk_cap_bytes: int = 1_073_741_824
    min_pdf_bytes: int = 2_048
    max_pdf_bytes: int = 52_428_800
    max_attempts: int = 3
    max_scan_attempts: int = 4
    backoff_base_s: int = 60
    backoff_cap_s: int = 900
    download_claim: int = 8
    upload_claim: int = 4
    event_span: int = 2_000


DEFAULTS = Limits()
