"""Run stamps (A28): one timestamp per run, three text forms.

The handler reads the clock three times; we take one instant per run on the
driver (or one per row for a timestamp column) so the texts always agree.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticksmith.constants import EXTRACT_DATE_PATTERN, RUN_ID_PATTERN


@dataclass(frozen=True)
class RunStamp:
    at: datetime

    def __post_init__(self):
        at = self.at
        if at.tzinfo is None:
            at = at.replace(tzinfo=timezone.utc)
        object.__setattr__(self, "at", at.astimezone(timezone.utc))

    @classmethod
    def now(cls) -> "RunStamp":
        return cls(datetime.now(timezone.utc))

    @property
    def run_id(self) -> str:
        return self.at.strftime("%Y%m%dT%H%M%SZ")

    @property
    def extract_date(self) -> str:
        return self.at.strftime("%Y-%m-%d")

    @property
    def extracted_at_utc(self) -> str:
        return self.at.isoformat()


# stamp used by tests and registered queries so results are reproducible
FIXED_STAMP = RunStamp(datetime(2026, 3, 31, 22, 15, 30, tzinfo=timezone.utc))


def run_id_text(ts: Column) -> Column:
    return F.date_format(ts, RUN_ID_PATTERN)


def extract_date_text(ts: Column) -> Column:
    return F.date_format(ts, EXTRACT_DATE_PATTERN)


def isoformat_text(ts: Column) -> Column:
    """``datetime.isoformat()`` of a UTC instant: the fraction is left out
    when the microseconds are zero, and the offset is ``+00:00``."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.concat(
        whole,
        F.when(micros == F.lit("000000"), F.lit("")).otherwise(F.concat(F.lit("."), micros)),
        F.lit("+00:00"),
    )
