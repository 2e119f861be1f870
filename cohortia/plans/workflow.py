"""A workflow: one audience model and its settings."""

from __future__ import annotations

import datetime
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from cohortia.operators.recipes import Dataset


class Postprocessor:
    """A step run on a workflow's written scores; subclass to add one."""

    pid: str
    stage = "postprocessing"
    failed = "failed"

    def process(self, scores: DataFrame, workflow: Workflow, date: datetime.date) -> None:
        raise NotImplementedError


@dataclass
class Thresholds(Postprocessor):
    """Score ranges of named buckets.

    All workflows' thresholds are computed together, see ``postprocessing``.
    """

    pid: str
    strategy: str
    thresholds: list[float]
    buckets: list[str]

    stage = "thresholding"
    failed = "failed_on_threshold"

    def to_dict(self) -> dict:
        return {
            "postprocessor_id": self.pid,
            "type": "Thresholder",
            "strategy": self.strategy,
            "thresholds": self.thresholds,
            "buckets": self.buckets,
        }


@dataclass
class Workflow:
    id: str
    name: str
    trait_id: int
    description: str = ""
    vendor: str = ""
    dataset: Dataset | None = None
    enabled: bool = True
    passthrough_group: str | None = None  # targets of this group are the scores
    postprocessors: list[Postprocessor] = field(default_factory=list)

    def label(self) -> dict:
        """Name and description as reports carry them: word characters only."""
        return {k: re.sub(r"\W", "", getattr(self, k)) for k in ("name", "description")}
