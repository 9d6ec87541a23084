"""Landed documents and result pages → the batch that is merged into RAW, and what could not be read."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.layout import written
from ..sources import landing as L
from .ingest import between_optional, filter_in_ci, since


def land_advisories(docs: DataFrame, as_of: _dt.datetime, severities: Sequence[str],
                    from_: _dt.date | None = None) -> tuple[DataFrame, DataFrame]:
    """(typed batch, rejects) of JSON documents; each document is parsed once and the typed rows are written once.

    Documents that are no JSON object are rejects (raw_json, reject_reason) and are told apart before any
    filter. Of several documents with an id the one updated last stays, by
    its parsed time (time zones count, an unreadable time is the oldest), of
    equal times the last one in the input; which one that is follows from ids,
    times and positions alone. Documents without an id all stay. The severities and ``from_`` then apply to
    what stayed, so an older version never stands in for a newer one.
    """
    typed = L.typed_advisories(L.parse_documents(docs), as_of)
    landed = written(typed.withColumn("position", F.monotonically_increasing_id()), "landed")
    rejects = landed.where("reject_reason is not null").select(F.col("json").alias("raw_json"), "reject_reason")
    good = landed.where("reject_reason is null")
    named = good.where("ghsa_id is not null").select("ghsa_id", "updated_at", "position")
    newest = named.groupBy("ghsa_id").agg(F.max(F.struct("updated_at", "position")).alias("last"))
    stays = newest.select(F.col("last.position").alias("position"))
    batch = good.where("ghsa_id is not null").join(stays, "position", "left_semi").unionByName(good.where("ghsa_id is null"))
    batch = filter_in_ci(batch, "severity", severities).select(*L.RAW_ADVISORY.names)
    return (batch if from_ is None else since(batch, "updated_at", from_)), rejects


def land_records(pages: DataFrame, unwrap: Callable[[DataFrame], DataFrame],
                 bounds: dict[str, tuple] | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, rejected pages) of result pages (json, fetched_at); ``unwrap`` turns pages into records.

    Pages that do not parse are rejects. ``bounds`` gives closed ranges (either end may be None) on time fields of
    the record; under a bound a record without a readable time is left out.
    """
    parses = F.try_parse_json("json").isNotNull()
    records = unwrap(pages.where(parses))
    for field, (low, high) in (bounds or {}).items():
        if low is not None or high is not None:
            at = F.try_to_timestamp(F.get_json_object("record", f"$.{field}")).cast("timestamp_ntz")
            records = between_optional(records.withColumn("_at", at), "_at", low, high).drop("_at")
    return records, pages.where(~parses).withColumn("reject_reason", F.lit("invalid JSON"))
