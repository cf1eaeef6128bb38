"""Ledger transitions, each one pass over the rows with conditional columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.functions.text import basename, col, error_text
from docketflow.operators.keyed import patch
from docketflow.settings import DEFAULTS, Limits


def _null(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def _set(items: DataFrame, when: Column, **values: Column) -> DataFrame:
    """Replace columns on the rows where ``when`` holds."""
    return items.withColumns({
        name: F.when(when, value).otherwise(F.col(name)) for name, value in values.items()
    })


def staging_path(
    batch_id: Column | str = "batch_id", source: Column | str = "source",
    item_id: Column | str = "id", s3_key: Column | str = "s3_key",
) -> Column:
    """Where a document is staged.  The id keeps equal file names apart."""
    folder = F.concat(F.lit("batch"), col(batch_id).cast("string"))
    name = F.concat(col(item_id).cast("string"), F.lit("_"), basename(s3_key))
    return F.concat_ws("/", folder, col(source), name)


def staged_manifest(admitted: DataFrame, staged: DataFrame, batch_id: Column) -> DataFrame:
    """Admitted rows whose file arrived: id, path, size as found, batch."""
    expected = admitted.select("id", staging_path(batch_id).alias("local_path"),
                               batch_id.cast("long").alias("batch_id"))
    found = staged.select(F.col("path").alias("local_path"), "bytes")
    return expected.join(found, "local_path").select("id", "local_path", "bytes", "batch_id")


def mark_downloaded(items: DataFrame, manifest: DataFrame, now: Column) -> DataFrame:
    """Record path, true size, batch and time; attempts stay, as both stages share them."""
    changes = manifest.select(
        "id", F.lit("downloaded").alias("status"), "local_path", "bytes", "batch_id",
        now.alias("downloaded_at"), _null().alias("error"))
    return patch(items, changes, "id")


def apply_outcomes(
    items: DataFrame, outcomes: DataFrame, now: Column, limits: Limits = DEFAULTS
) -> DataFrame:
    """Apply (item_id, outcome, document_id, message, retry_state), one per item, in one pass.

    ``pushed`` and ``skipped`` give up the local file.  ``retry`` and ``auth`` count an attempt
    and keep it: the row goes to ``retry_state`` or, at the attempt limit, to ``failed``.
    """
    packed = outcomes.select(F.col("item_id").alias("id"), F.struct(
        "outcome", "document_id", "message", "retry_state").alias("_o"))
    joined = items.join(packed, "id", "left")
    outcome = F.col("_o.outcome")
    pushed, skipped = outcome == "pushed", outcome == "skipped"
    failed = outcome.isin("retry", "auth")
    tries = F.col("attempts") + 1
    spent = tries >= limits.max_attempts
    message = error_text("_o.message")
    return joined.withColumns({
        "status": F.when(pushed, "pushed").when(skipped, "skipped")
        .when(failed & spent, "failed").when(failed, F.col("_o.retry_state"))
        .otherwise(F.col("status")),
        "document_id": F.when(pushed, F.col("_o.document_id")).otherwise(F.col("document_id")),
        "pushed_at": F.when(pushed, now).otherwise(F.col("pushed_at")),
        "local_path": F.when(pushed | skipped, _null()).otherwise(F.col("local_path")),
        "error": F.when(pushed, _null()).when(skipped | failed, message)
        .otherwise(F.col("error")),
        "attempts": F.when(failed, tries).otherwise(F.col("attempts")).cast("int"),
    }).select(*items.columns)


def retry_failed(items: DataFrame) -> DataFrame:
    """Requeue failed rows: to the upload stage when their file is kept, else to download."""
    parked = F.col("status") == "failed"
    resumed = F.when(F.col("local_path").isNotNull(), "downloaded").otherwise("discovered")
    return _set(items, parked, attempts=F.lit(0), error=_null(), status=resumed)


def _file_check(
    items: DataFrame, staged: DataFrame, states: tuple[str, ...]
) -> tuple[DataFrame, DataFrame]:
    """Rows outside ``states``, and rows in them flagged with whether their file exists.

    Only the rows in question are joined, by path and without NULL keys; the rest of the ledger
    passes through unshuffled.
    """
    asked = F.coalesce(F.col("status").isin(*states), F.lit(False))
    files = staged.select(F.col("path").alias("local_path"), F.lit(True).alias("kept")).distinct()
    checked = items.where(asked)
    pathed = checked.where(F.col("local_path").isNotNull()).join(files, "local_path", "left")
    bare = checked.where(F.col("local_path").isNull()).withColumn("kept", F.lit(False))
    flagged = pathed.withColumn("kept", F.coalesce("kept", F.lit(False))).unionByName(bare)
    return items.where(~asked), flagged


def reset_inflight(items: DataFrame, staged: DataFrame) -> DataFrame:
    """After a crash: in-flight rows resume at upload if their file exists, else at download."""
    rest, flagged = _file_check(items, staged, ("downloading", "uploading"))
    resumed = flagged.withColumns({
        "local_path": F.when(F.col("kept"), F.col("local_path")),
        "status": F.when(F.col("kept"), "downloaded").otherwise("discovered"),
    })
    return rest.unionByName(resumed.select(*items.columns))


def requeue_vanished(items: DataFrame, staged: DataFrame) -> DataFrame:
    """Rows about to upload whose file is gone go back to download; attempts stay."""
    rest, flagged = _file_check(items, staged, ("uploading",))
    checked = _set(flagged, ~F.col("kept"), status=F.lit("discovered"), local_path=_null())
    return rest.unionByName(checked.select(*items.columns))


def orphans(items: DataFrame, staged: DataFrame) -> DataFrame:
    """Staged files no row claims, whatever the row's status."""
    claimed = items.where(F.col("local_path").isNotNull()).select(
        F.col("local_path").alias("path"))
    return staged.join(claimed, "path", "left_anti")
