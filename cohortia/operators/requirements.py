"""Class-size requirements of a training set: checking and down-sampling."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.errors import InsufficientData, InvalidDefinition
from cohortia.functions.ids import unit_hash

BINARY, MULTICLASS = "binary", "multiclass"

# The requirements a data set gets when it states none.
DEFAULTS = {
    BINARY: {
        "logic": "min_max_provided",
        "min_positive": 100,
        "min_negative": 100,
        "max_positive": 250000,
        "max_negative": 250000,
    },
    MULTICLASS: {"logic": "no_requirements"},
}
BINARY_NAMES = {1: "positive", 0: "negative"}


def class_counts(df: DataFrame, target="target") -> DataFrame:
    """``target, n``: at most one row per class."""
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))


@dataclass
class Requirements:
    """``min_<class>`` and ``max_<class>`` sizes; no limits for ``no_requirements``."""

    family: str
    logic: str = "no_requirements"
    minimum: dict[str, int] = field(default_factory=dict)
    maximum: dict[str, int] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, wanted: dict, family: str) -> Requirements:
        if wanted.get("logic") not in ("min_max_provided", "no_requirements"):
            raise InvalidDefinition("data requirements need a known logic")
        if wanted["logic"] == "no_requirements":
            return cls(family)
        limits = {
            side: {k[4:]: v for k, v in wanted.items() if k.startswith(f"{side}_")}
            for side in ("min", "max")
        }
        return cls(family, wanted["logic"], limits["min"], limits["max"])

    def to_dict(self) -> dict:
        sizes = {f"min_{k}": v for k, v in self.minimum.items()}
        sizes |= {f"max_{k}": v for k, v in self.maximum.items()}
        return {"logic": self.logic, **sizes}

    def name(self, label) -> str:
        return BINARY_NAMES.get(label, str(label)) if self.family == BINARY else str(label)

    def check(self, counts: dict) -> dict[str, int]:
        """Class sizes by name; raises when a class is missing or too small."""
        if None in counts:
            raise InsufficientData("labels must not be NULL")
        sizes = {self.name(label): n for label, n in counts.items()}
        if self.family == BINARY:
            for name in BINARY_NAMES.values():
                if not sizes.get(name):
                    raise InsufficientData(f"there are no {name}s among the labels")
        for name, least in self.minimum.items():
            if sizes.get(name, 0) < least:
                raise InsufficientData(
                    f"class {name} has {sizes.get(name, 0)} users and needs at least {least}"
                )
        return sizes

    def ratios(self, counts: dict) -> dict:
        """Share of each class to keep so that its expected size is its maximum."""
        return {
            label: min(1.0, self.maximum.get(self.name(label), n) / n)
            for label, n in counts.items()
            if n
        }

    def sample(self, df: DataFrame, counts: dict, target="target", key="xid") -> DataFrame:
        """Down-sample each class independently, by a hash of the user id."""
        over = {label: share for label, share in self.ratios(counts).items() if share < 1}
        if not over:
            return df
        keep = F.lit(1.0)
        for label, share in over.items():
            keep = F.when(F.col(target) == label, share).otherwise(keep)
        return df.filter(unit_hash(key) < keep)

    def meet(self, df: DataFrame, target="target", key="xid") -> tuple[DataFrame, dict[str, int]]:
        """Checked and down-sampled rows, with the class sizes before sampling."""
        counts = {row[target]: row["n"] for row in class_counts(df, target).collect()}
        return self.sample(df, counts, target, key), self.check(counts)
