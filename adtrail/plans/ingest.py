"""From a topic to valid and invalid rows, batch or stream."""

from __future__ import annotations

from datetime import timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame

from adtrail.operators import dedup, quality
from adtrail.registry import BIDS, CLICKS, IMPRESSIONS, SourceSpec
from adtrail.streaming import dedup as stream_dedup

DELAY = timedelta(hours=1)


class Ingested(NamedTuple):
    valid: DataFrame
    invalid: DataFrame


def ingest(
    log: DataFrame,
    spec: SourceSpec,
    delay: timedelta = DELAY,
    observe: bool = False,
    collapse_copies: bool = False,
) -> Ingested:
    """Decode a topic, split it by the rules of the source and drop copies of valid rows.

    In batch the copy that comes first in the log is kept. A stream keeps the
    first one it sees and drops those that arrive within ``delay`` after it; a
    row is never dropped for being late. It also rejects rows without a readable
    timestamp, which have no place in the windows that follow.
    ``collapse_copies`` guards a stream's dedup against keys with very many
    copies.
    """
    if log.isStreaming:
        spec = spec.with_event_time()
    decoded = quality.decode_log(log, spec)
    if observe:
        decoded = quality.observed(decoded, spec)
    return split(decoded, spec, delay, collapse_copies)


def split(
    decoded: DataFrame,
    spec: SourceSpec,
    delay: timedelta = DELAY,
    collapse_copies: bool = False,
) -> Ingested:
    """The second half of ``ingest``: a decoded topic by the rules of its source, without copies."""
    invalid = quality.dead_letters(decoded, spec)
    valid = quality.valid_part(decoded, spec)
    keys = list(spec.dedup_keys)
    if decoded.isStreaming:
        curated = quality.curated_columns(valid, spec)
        unique = stream_dedup.drop_copies(curated, keys, delay, collapse_copies)
    else:
        first = dedup.keep_first(
            valid.select(*spec.fields, "event_time", "partition", "offset"),
            keys,
            ["partition", "offset"],
            drop_order=True,
        )
        unique = quality.curated_columns(first, spec)
    return Ingested(unique, invalid)


def ingest_impressions(log: DataFrame, spec: SourceSpec = IMPRESSIONS) -> Ingested:
    return ingest(log, spec)


def ingest_clicks(log: DataFrame, spec: SourceSpec = CLICKS) -> Ingested:
    return ingest(log, spec)


def ingest_bids(log: DataFrame, spec: SourceSpec = BIDS) -> Ingested:
    """``spec`` decides the codec: ``BIDS`` reads Avro, ``BIDS.with_codec("json")`` JSON."""
    return ingest(log, spec)
