"""Errors of the stages, and logging."""

from __future__ import annotations

import logging
from enum import Enum


class Severity(Enum):
    FATAL = "fatal"
    ERROR = "error"
    WARN = "warn"
    INFO = "info"


class PipelineError(Exception):
    """What went wrong where: severity, stage, message, and what is known of place, input and remedy."""

    def __init__(self, severity: Severity, stage: str, message: str, location: str | None = None, raw_input: str | None = None, suggestion: str | None = None):
        self.severity, self.stage, self.message, self.location, self.raw_input, self.suggestion = severity, stage, message, location, raw_input, suggestion
        parts = [f"[{severity.name}] {stage}: {message}"] + [f"{n}: {v}" for n, v in (("at", location), ("input", raw_input), ("hint", suggestion)) if v]
        super().__init__("; ".join(parts))


def configure_logging(level: str = "INFO") -> None:
    """Lines with time, level and name on standard error."""
    logging.basicConfig(level=level, format="%(asctime)s %(levelname)s %(name)s %(message)s", force=True)
