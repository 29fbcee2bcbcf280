"""The ordered audit trail of jobs that check requests step by step.

A job's checks are a ladder of rungs, written as data: what a request that passes a rung leaves behind, what
one that fails there leaves, and which status means that it failed there. The status of a request is worked out
once, by the job. Its trail is then one array of events, cut at the rung where it failed, followed by the error, or
by the report of success, and is unfolded with the number of the step. Nothing is looked up again.

Events of customers that do not exist are not kept, as an audit row refers to its customer.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from perkwell.functions.columns import joined_text, moment, number_text

# Texts of database errors.
NO_DATA, NO_PARENT, CHECK_VIOLATED = (
    "ORA-01403: no data found", "ORA-02291: integrity constraint violated - parent key not found", "ORA-02290: check constraint violated",
)
_NAME = re.compile(r"\{(\w+)\}")


def text(template: str) -> Column:
    """A text in which ``{name}`` stands for a column; NULL is empty, numbers are printed in their shortest form."""
    parts: list[Column | str] = []
    for k, piece in enumerate(_NAME.split(template)):
        if k % 2:
            parts.append(number_text(F.col(piece)))
        elif piece:
            parts.append(piece)
    return joined_text(*parts)


def event(kind: str, template: str, when: Column | None = None) -> Column:
    """One audit event; NULL where ``when`` does not hold."""
    made = F.struct(F.lit(kind).alias("activity_type"), text(template).alias("details"))
    return made if when is None else F.when(when, made)


@dataclass(frozen=True)
class Rung:
    """``stops`` are the statuses of requests that fail here."""

    stops: Sequence[str]
    passed: Sequence[Column] = field(default=())
    failed: Sequence[Column] = field(default=())


def ladder_events(rungs: Sequence[Rung], status: Column, done: Sequence[Column], error: Column) -> Column:
    """The events of a request in order, NULL where there is none; ``error`` follows every failure."""
    at = F.lit(len(rungs))
    for k, rung in enumerate(rungs):
        at = F.when(status.isin(*rung.stops), k).otherwise(at)
    events = []
    for k, rung in enumerate(rungs):
        events += [F.when(at > k, e) for e in rung.passed] + [F.when(at == k, e) for e in rung.failed]
    events += [F.when(at == len(rungs), e) for e in done] + [F.when(at < len(rungs), error)]
    return F.array(*events)


def trail(rows: DataFrame, events: Column, as_of: datetime) -> DataFrame:
    """Audit rows with ``request_id`` and ``step``, counted from 1, of rows with a known customer or none at all."""
    return rows.select("request_id", "customer_id", F.posexplode(F.array_compact(events)).alias("_step", "_event")).select(
        "request_id", (F.col("_step") + 1).alias("step"), "customer_id", F.col("_event.activity_type").alias("activity_type"),
        moment(as_of).alias("activity_date"), F.lit(None).cast("string").alias("ip_address"), F.col("_event.details").alias("details"),
    )
