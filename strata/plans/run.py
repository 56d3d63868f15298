"""What a run is told and what a layer reports."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from typing import Any


@dataclass(frozen=True)
class Run:
    """One run of a subject. One batch id links all its layers; the clock is read here only."""

    batch_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    run_ts: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    load_job_nr: str = "1"
    application_id: str | None = None
    day: date | None = None  # the day of a batch that another run began

    @property
    def as_of(self) -> date:
        return self.day or self.run_ts.date()


@dataclass(frozen=True)
class LayerResult:
    layer: str
    status: str
    source_rows: int = 0
    inserted: int = 0
    updated: int = 0
    errors: int = 0


@dataclass(frozen=True)
class Job:
    """A subject's configuration row, the database of its tables, the run, and the Bronze table it loads."""

    database: str
    subject: dict[str, Any]
    run: Run
    bronze: str = "bronze"

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    @property
    def frequency(self) -> str:
        return self.subject["frequency"]

    @property
    def name(self) -> str:
        return self.subject["data_subject"]
