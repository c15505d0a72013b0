"""Hand-entered records: derivation, repair, detection of shifted columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reachmart.functions.cleaning import looks_shifted, unit_score
from reachmart.functions.decisions import TARGET_SEGMENTS
from reachmart.functions.temporal import Instant, as_datetime, days_before, parsed_day
from reachmart.functions.text import filled, repair_json
from reachmart.sources import outbox
from reachmart.sources.files import exists
from reachmart.sources.schemas import MANUAL_COLUMNS

# Fixed value: the action of a new entry.
PROMOTION = '{"channel": "email", "template": "promotional", "discount_pct": 0.0}'


def new_entries(forms: DataFrame, submitted_at: Instant, entry_id: Column | None = None) -> DataFrame:
    """Entries from submitted forms: id, company, dates and first action are derived.

    The id is ``manual-`` and the time of submission; a batch of forms of one time passes
    its own ``entry_id`` to keep the ids apart.
    """
    moment = as_datetime(submitted_at)
    suffix = F.lit(moment.strftime("%Y%m%d%H%M%S")) if entry_id is None else entry_id.cast("string")
    return forms.withColumns(
        {
            "customer_id": F.concat(F.lit("manual-"), suffix),
            "company": filled("{name} Company", name=F.col("first_name")),
            "created_at": F.lit(days_before(moment, 30).strftime("%Y-%m-%d")),
            "last_event_ts": F.lit(moment.strftime("%Y-%m-%d")),
            "nba_action": F.lit(PROMOTION),
        }
    ).select(*MANUAL_COLUMNS)


def shifted_columns(entries: DataFrame) -> DataFrame:
    """One row: whether any record has its columns shifted."""
    shifted = looks_shifted(F.col("first_name"), F.col("segment"))
    return entries.agg(F.coalesce(F.max(shifted), F.lit(False)).alias("misaligned"))


def repaired(entries: DataFrame) -> DataFrame:
    """All repairs, row by row.

    A segment name in the name column is what makes a file count as shifted, so whether a
    record is swapped depends on that record alone, and no pass over the file comes first.
    Columns that a file lacks are not repaired.
    """
    text = {name: F.col(name).cast("string") for name in entries.columns}
    fixes = {}
    if {"first_name", "segment"} <= set(entries.columns):
        swap = F.coalesce(F.col("first_name").isin(TARGET_SEGMENTS), F.lit(False))
        fixes["first_name"] = F.when(swap, F.col("segment")).otherwise(F.col("first_name"))
        fixes["segment"] = F.when(swap, F.col("first_name")).otherwise(F.col("segment"))
    if "customer_id" in text:
        fixes["customer_id"] = text["customer_id"]
    if "score" in text:
        fixes["score"] = unit_score(text["score"])
    for name in ("created_at", "last_event_ts"):
        if name in text:
            fixes[name] = parsed_day(text[name])
    leading = ["customer_id", "email", "first_name", "segment", "score"]
    names = [*leading, *[name for name in entries.columns if name not in leading]]
    fixed = entries.withColumns(fixes)
    if "nba_action" in entries.columns:
        fixed = repair_json(fixed, "nba_action")
    return fixed.select(*[name for name in names if name in entries.columns])


def repair_file(spark: SparkSession, path: str, target: str) -> DataFrame:
    """Repairs a hand-entered or payload file into a new folder and keeps a backup of what
    it read.

    Spark cannot overwrite the files it is reading, so the repaired copy has its own path.
    """
    entries = outbox.read_by_name(spark, path).drop("_file")
    outbox.back_up_once(spark, path, f"{target.rstrip('/')}.bak")
    fixed = repaired(entries)
    outbox.write_csv(fixed, target)
    return outbox.read_payload(spark, target, fixed.schema)


# The files of the outbox that are repaired together.
REPAIRED_FILES = ["manual_entries.csv", "all_payload.csv", "high_value_lapse_risk_payload.csv"]


def repair_all(spark: SparkSession, outbox_dir: str, target_dir: str) -> list[str]:
    """Repairs the outbox files that exist; returns their names."""
    found = [name for name in REPAIRED_FILES if exists(spark, f"{outbox_dir.rstrip('/')}/{name}")]
    for name in found:
        repair_file(spark, f"{outbox_dir.rstrip('/')}/{name}", f"{target_dir.rstrip('/')}/{name}")
    return found
