"""Where the tables of a run lie and how strictly they are checked."""

from __future__ import annotations

from dataclasses import dataclass

from tidemark.schemas import SOURCE_SYSTEM


@dataclass(frozen=True)
class Paths:
    """One folder per table under ``base``; ``landing`` holds the payloads."""

    base: str
    landing: str

    @property
    def bronze(self) -> str:
        return f"{self.base}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.base}/silver"

    @property
    def gold(self) -> str:
        return f"{self.base}/gold"

    @property
    def quality(self) -> str:
        return f"{self.base}/quality"

    @property
    def quarantine(self) -> str:
        return f"{self.base}/quarantine"

    @property
    def dropped(self) -> str:
        return f"{self.base}/dropped"

    @property
    def accounting(self) -> str:
        return f"{self.base}/accounting"

    @property
    def published(self) -> str:
        return f"{self.base}/published"

    @property
    def state(self) -> str:
        return f"{self.base}/state"

    @property
    def unpublished(self) -> str:
        return f"{self.base}/unpublished"

    @property
    def metrics(self) -> str:
        return f"{self.base}/metrics"

    @property
    def recoverable(self) -> list[str]:
        """Tables whose publications a lost driver may leave unfinished."""
        return [self.bronze, self.quality, self.quarantine, self.dropped, self.accounting, self.silver]


@dataclass(frozen=True)
class Settings:
    """``threshold`` is the number of failed checks a series may have; ``null_tolerance``
    the number of missing rows a null check lets through. ``window_days=None`` takes the
    landed batch whole. ``gold`` is "full" or "touched" (see ``load_gold``)."""

    layout: str = "lines"
    on_error: str = "fail"
    window_days: int | None = 7
    source_system: str = SOURCE_SYSTEM
    policy: str = "auto"
    threshold: int = 0
    null_tolerance: int = 0
    gold: str = "full"
