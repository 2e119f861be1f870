"""Segment membership to targets, with automatic back-fill."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.errors import EmptyInput
from cohortia.functions.aspects import aspect
from cohortia.operators import segments as seg
from cohortia.operators.identity import bridge_segments
from cohortia.plans.targets import PRESENT, VendorTargets
from cohortia.sources import sinks
from cohortia.sources.identity import id_maps, require_some_day
from cohortia.sources.tables import require_rows


@dataclass
class SegmentTargets(VendorTargets):
    """Users of each active segment on every day since it was last processed."""

    vendor = "adobe"
    source: str = "mcid"
    active: DataFrame = None
    identity: DataFrame = None
    identity_days: int = 120
    backfill_days: int = 35

    def transform(self, data):
        full = seg.latest_full_date(data)
        if full is None or (self.date - full).days > self.backfill_days:
            raise EmptyInput("no recent full membership file: wait for it to be loaded")
        active = require_rows(
            seg.active_on(self.active, self.date, full), "no active segments on the date"
        )
        self.days = seg.days_and_segments(active, full, self.date, self.backfill_days)
        require_some_day(self.identity, self.date, self.identity_days)
        mcid, xid = id_maps(self.identity, self.date, self.identity_days)
        selected = seg.selected_segments(data, self.days, full)
        users = bridge_segments(selected, mcid, xid, seg.known_segments(active))
        return seg.named_targets(users, active)

    def columns(self):
        return {
            "date": F.col("processing_start_date"),
            "aspect": aspect({"name": F.col("segment_name")}),
            "value": F.lit(PRESENT),
        }

    def write(self, targets, uri):
        return sinks.replace_targets(targets, uri, seg.replaced_partitions(self.days))

