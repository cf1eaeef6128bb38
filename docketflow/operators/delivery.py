"""Upload payloads, and what the responses mean for the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.functions.text import bare_url, nonblank
from docketflow.operators.keyed import last_per_key

# Payload field -> ledger column.
FIELDS = {
    "citation": "citation", "title": "title", "parties": "parties", "court": "court",
    "court_type": "court_type", "state": "state_name", "bench": "bench",
    "bench_type": "bench_type", "year": "year", "decision_date": "decision_date",
    "case_type": "case_type", "judges": "judges", "outcome": "outcome",
    "language": "language", "source_url": "source_url",
}

# Text put before the service's own message.
PREFIXES = {
    409: "Already in corpus: ",
    401: "Unauthorised: ",
    403: "Forbidden — user lacks a corpus role: ",
    400: "Rejected (400): ",
}
NO_ID = "Upload accepted but no document id: "


def payload_columns(items: DataFrame, *beside: str) -> DataFrame:
    """One text column per field, NULL where the field is left out, and the columns ``beside``."""
    def value(field: str, column: str) -> Column:
        text = nonblank(F.col(column).cast("string"))
        if field == "language":
            return F.coalesce(text, F.lit("en"))
        return bare_url(text) if field == "source_url" else text

    return items.select("id", "batch_id", *beside, *[value(f, c).alias(f) for f, c in FIELDS.items()])


def payloads(items: DataFrame, *beside: str) -> DataFrame:
    """(id, batch_id, payload JSON) and the columns ``beside``, such as the number of the claim that
    a response must name; the JSON writer leaves NULL fields out."""
    return payload_columns(items, *beside).select(
        "id", "batch_id", *beside, F.to_json(F.struct(*FIELDS)).alias("payload"))


def answered(uploading: DataFrame, responses: DataFrame) -> DataFrame:
    """The response that counts for each row of ``uploading``: (item_id, http_status, body).

    It is the last by ``seq`` of those to the row's present claim.  Responses to earlier claims, or
    to rows no longer uploading, however late or often they come, are left out.
    """
    present = uploading.select(F.col("id").alias("item_id"), F.col("claims").alias("claim"))
    mine = responses.join(present, ["item_id", "claim"], "left_semi")
    return last_per_key(mine, ["item_id"], "seq").select("item_id", "last.http_status", "last.body")


def classify(responses: DataFrame) -> DataFrame:
    """(item_id, http_status, body) -> outcome, document id, message and retry state."""
    status, body = F.col("http_status"), F.col("body")
    accepted = status.isin(200, 201)
    doc_id = F.get_json_object(body, "$.data.id").try_cast("long")
    said = F.coalesce(F.get_json_object(body, "$.message"), F.substring(body, 1, 300))
    outcome = (
        F.when(accepted & doc_id.isNotNull(), "pushed")
        .when(status.isin(400, 409), "skipped")
        .when(status.isin(401, 403), "auth")
        .otherwise("retry")
    )
    message = F.when(accepted, F.concat(F.lit(NO_ID), body))
    for code, prefix in PREFIXES.items():
        message = message.when(status == code, F.concat(F.lit(prefix), said))
    message = message.otherwise(F.format_string("HTTP %d: %s", status, said))
    judged = responses.select(
        "item_id", "http_status", outcome.alias("outcome"),
        F.when(accepted, doc_id).alias("document_id"), message.alias("message"))
    return judged.select(
        "item_id", "http_status", "outcome", "document_id",
        F.when(F.col("outcome") != "pushed", F.col("message")).alias("message"),
        F.lit("downloaded").alias("retry_state"))


def outcome_events(after: DataFrame, outcomes: DataFrame, what: str = "Push") -> DataFrame:
    """Log lines (level, message, item_id), one per outcome, from the rows as they are ``after`` it.

    A failed try is a warning while others are left, then an error; refused credentials are one.
    """
    told = outcomes.select(F.col("item_id").alias("id"), "outcome", "message")
    rows = after.select("id", "citation", "status", "document_id").join(told, "id")
    outcome, message = F.col("outcome"), F.coalesce("message", F.lit(""))
    name = F.coalesce("citation", F.concat(F.lit("item "), F.col("id").cast("string")))
    parked = F.when(F.col("status") == "failed", "error").otherwise("warn")
    return rows.select(
        F.when(outcome == "auth", "error").when(outcome == "retry", parked).otherwise("info").alias("level"),
        F.when(outcome == "pushed", F.concat(
            F.lit("Pushed "), name, F.lit(" as document "), F.col("document_id").cast("string")))
        .when(outcome == "skipped", F.concat(F.lit("Skipped "), name, F.lit(": "), message))
        .when(outcome == "auth", F.concat(F.lit("Push halted: "), message))
        .otherwise(F.concat(F.lit(f"{what} failed: "), name, F.lit(": "), message)).alias("message"),
        F.col("id").cast("long").alias("item_id"))


def auth_halt(outcomes: DataFrame) -> DataFrame:
    """One row: whether any upload was refused for its credentials, how many, and why."""
    refused = F.col("outcome") == "auth"
    return outcomes.agg(
        F.coalesce(F.bool_or(refused), F.lit(False)).alias("halt"),
        F.count_if(refused).alias("refused"),
        F.min(F.when(refused, F.col("message"))).alias("reason"),
    )
