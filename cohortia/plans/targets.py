"""Vendor data to the one targets table.

Each vendor is a small class: ``transform`` reshapes its rows, ``columns`` maps
them to the seven target columns.  Subclass ``VendorTargets`` to add one.
"""

from __future__ import annotations

import datetime
from abc import ABC, abstractmethod
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortia import schemas
from cohortia.functions.aspects import any_of, aspect, aspect_columns, constant_aspect
from cohortia.functions.ids import keep_full_length_ids, keep_valid_xids
from cohortia.operators.identity import universal_ids, with_universal_id
from cohortia.operators.reshape import to_long
from cohortia.sources import sinks
from cohortia.sources.tables import load, of_orders, on_date

PRESENT = 1  # value of a target that only records membership


@dataclass
class VendorTargets(ABC):
    date: datetime.date
    vendor = ""
    source: str | None = None
    fmt = "parquet"

    @abstractmethod
    def transform(self, data: DataFrame) -> DataFrame: ...

    @abstractmethod
    def columns(self) -> dict[str, Column]:
        """Target columns that differ from ``defaults``."""

    def defaults(self) -> dict[str, Column]:
        return {
            "xid": F.col("xid"),
            "date": F.col("date"),
            "vendor": F.lit(self.vendor),
            "source": F.lit(self.source),
            "group": F.col("group"),
            "aspect": aspect(),
            "value": F.col("value"),
        }

    def map_schema(self, data: DataFrame) -> DataFrame:
        """The seven typed target columns of rows whose id is a UUID."""
        mapped = {**self.defaults(), **self.columns()}
        return keep_valid_xids(
            data.select(*[mapped[f.name].cast(f.dataType).alias(f.name) for f in schemas.TARGETS])
        )

    def targets(self, data: DataFrame) -> DataFrame:
        return self.map_schema(self.transform(data))

    def write(self, targets: DataFrame, uri: str) -> bool:
        return sinks.replace_day(targets, uri, self.vendor, self.source, self.date)

    def run(self, spark: SparkSession, uri: str, targets_uri: str) -> bool:
        """Load, transform, map and write; False when there was nothing to write."""
        return self.write(self.targets(load(spark, uri, self.fmt)), targets_uri)


@dataclass
class ResolvedVendor(VendorTargets):
    """Vendor keyed by ``universal_id``: needs identities and offline tables.

    ``offline`` maps an id kind to its table of ``id, universal_id``.
    """

    ids: DataFrame = None
    offline: dict[str, DataFrame] = field(default_factory=dict)

    def with_users(self, data: DataFrame) -> DataFrame:
        """Vendor rows of the users seen on the run date.

        The date is fixed before any join, so other days never get shuffled.
        """
        users = universal_ids(on_date(self.ids, self.date, "date"), self.offline)
        return with_universal_id(users, data)


@dataclass
class Demographics(ResolvedVendor):
    """One JSON aspect per attribute group, as long rows."""

    vendor = "cds"
    fmt = "orc"
    attributes: dict[str, dict[str, str]] = field(default_factory=dict)

    def transform(self, data):
        wide = aspect_columns(self.with_users(data), self.attributes)
        return to_long(wide, "group", "aspect").distinct()

    def columns(self):
        return {"aspect": F.col("aspect"), "value": F.lit(PRESENT)}


@dataclass
class IndividualGender(Demographics):
    source: str = "alt_individual"
    attributes: dict = field(default_factory=lambda: {"gender": {"gender": "gender_cd"}})


@dataclass
class IndividualDemographics(Demographics):
    source: str = "alt_individual_demo"
    attributes: dict = field(
        default_factory=lambda: {
            "age": {"age": "i1_exact_age"},
            "gender": {"gender": "i1_gndr_code"},
            "income": {"income_class": "experian_income_cd_v6"},
        }
    )


@dataclass
class PurchaseCategories(ResolvedVendor):
    """Wide 0/1 purchase categories: a user has the largest value of its ids.

    The largest value per user is taken while still wide, so the long form is
    only as big as the result and each category needs no shuffle of its own.
    """

    vendor = "ncs"
    source: str = "syndicated"

    def transform(self, data):
        users = self.with_users(data).drop("universal_id")
        names = [c for c in users.columns if c not in ("xid", "date")]
        widest = users.groupBy("xid", "date").agg(*[F.max(c).alias(c) for c in names])
        return to_long(widest, "group", "value")

    def columns(self):
        return {"aspect": constant_aspect(action="purchase")}


@dataclass
class CampaignScales(ResolvedVendor):
    """Average scale per user and campaign; NULL only when every scale is."""

    vendor = "ncs"
    source: str = "custom"

    def transform(self, data):
        users = self.with_users(data)
        return users.groupBy("xid", "date", "campaign").agg(F.avg("scale").alias("scale"))

    def columns(self):
        return {"group": F.col("campaign"), "value": F.col("scale")}


@dataclass
class AdEvents(VendorTargets):
    """Ad server clicks or impressions of the active orders on one date."""

    vendor = "dfp"
    fmt = "orc"
    orders: DataFrame | list = None
    user_key: str = "user_id"  # key of the user id in the ad server's custom fields
    details: dict[str, str] = field(default_factory=dict)

    def transform(self, data):
        return of_orders(on_date(data, self.date), self.orders)

    def columns(self):
        return {
            "xid": F.col("custom_targeting")[self.user_key],
            "date": F.lit(self.date),
            "group": F.col("order_id"),
            "aspect": aspect(self.details, as_text=True),
            "value": F.lit(PRESENT),
        }


@dataclass
class AdClicks(AdEvents):
    source: str = "network_clicks"
    details: dict = field(
        default_factory=lambda: {
            "creative_size": "creative_size",
            "creative_id": "creative_id",
            "line_item_id": "line_item_id",
            "ad_unit_id": "adunit_id",
        }
    )


@dataclass
class AdImpressions(AdEvents):
    source: str = "network_impressions"
    details: dict = field(
        default_factory=lambda: {
            "creative_size": "creative_size",
            "creative_id": "creative_id",
            "line_item_id": "line_item_id",
            "referrer_url": "referer_url",
            "active_view_eligible_impression": "activevieweligibleimpression",
        }
    )


@dataclass
class AudienceRatings(VendorTargets):
    """Ready-made targets, only mapped."""

    vendor = "nielsen"
    source: str = "dar"

    def transform(self, data):
        return data

    def columns(self):
        return {}


@dataclass
class CustomTargets(VendorTargets):
    """Ready-made targets of one date, of every source or of one."""

    vendor = "custom"

    def transform(self, data):
        rows = on_date(data, self.date, "date")
        return rows.filter(F.col("source") == self.source) if self.source else rows

    def columns(self):
        return {"source": F.col("source")}


@dataclass
class ArticleGroup:
    """Counts the articles of a user on which a condition held."""

    group: str
    counter: str
    condition: Column


# What marks a keyword article and an affiliate click.
KEYWORDS = "coronavirus|covid"
AFFILIATE_ACTIONS = [
    "affiliate link clicks",
    "amp link type: affiliate link",
    "amp link type: buy button",
]
ALL_ARTICLES = "total_articles"


def keyword_readers() -> ArticleGroup:
    def mentions(column):
        return F.lower(column).rlike(KEYWORDS)

    return ArticleGroup(
        "covid_readers",
        "corona_articles",
        any_of([mentions("hits_page_pagepath"), mentions("onsite_keywords")]),
    )


def affiliate_clickers() -> ArticleGroup:
    return ArticleGroup(
        "affiliate_commerce_clicks",
        "affiliate_articles",
        F.lower("hits_eventinfo_eventaction").isin(AFFILIATE_ACTIONS),
    )


def article_counts(clicks: DataFrame, groups: list[ArticleGroup], day="dt") -> DataFrame:
    """Per user and day: articles seen, and articles on which each group's flag held.

    Clicks are first reduced to one row per user and article, which spreads a
    very active user over many tasks; both groups share the pass.
    """
    flags = [F.max(F.when(g.condition, 1).otherwise(0)).alias(g.counter) for g in groups]
    per_article = clicks.groupBy("infinity_id", "content_id", day).agg(*flags)
    return per_article.groupBy("infinity_id", day).agg(
        *[F.sum(g.counter).alias(g.counter) for g in groups],
        F.count(F.lit(1)).alias(ALL_ARTICLES),
    )


@dataclass
class ClickLogGroups(VendorTargets):
    """Readers and clickers from the publisher's own click log on one date.

    ``label`` is the vendor name under which these targets are stored.
    """

    label: str = "first_party"
    source: str = "ga"

    def __post_init__(self):
        self.vendor = self.label

    def groups(self) -> list[ArticleGroup]:
        return [keyword_readers(), affiliate_clickers()]

    def transform(self, data):
        groups = self.groups()
        clicks = keep_full_length_ids(on_date(data, self.date), "infinity_id", "content_id")
        counts = article_counts(clicks, groups)
        entries = [
            F.struct(
                F.lit(g.group).alias("group"),
                aspect({g.counter: F.col(g.counter), ALL_ARTICLES: F.col(ALL_ARTICLES)}).alias("aspect"),
                F.when(F.col(g.counter) >= 1, 1).otherwise(0).alias("value"),
            )
            for g in groups
        ]
        return counts.select(
            F.col("infinity_id").alias("xid"), F.col("dt").alias("date"), F.inline(F.array(*entries))
        )

    def columns(self):
        return {"aspect": F.col("aspect")}


LAG_DAYS = {"adobe": 0}  # other vendors run one day behind


def run_date(vendor: str, execution_date: str | datetime.date) -> datetime.date:
    """Day whose data a run covers."""
    if isinstance(execution_date, str):
        execution_date = datetime.date.fromisoformat(execution_date)
    return execution_date - datetime.timedelta(days=LAG_DAYS.get(vendor, 1))


REGISTRY: dict[tuple[str, str | None], type[VendorTargets]] = {
    ("dfp", "network_clicks"): AdClicks,
    ("dfp", "network_impressions"): AdImpressions,
    ("ncs", "custom"): CampaignScales,
    ("ncs", "syndicated"): PurchaseCategories,
    ("cds", "alt_individual"): IndividualGender,
    ("cds", "alt_individual_demo"): IndividualDemographics,
    ("nielsen", "dar"): AudienceRatings,
    ("custom", None): CustomTargets,
}


def vendor_for(
    vendor: str, source: str | None, execution_date, first_party: str | None = None, **inputs
) -> VendorTargets:
    """Configured vendor for an execution date; ``inputs`` are its extra frames.

    Source ``ga`` is the click log of ``first_party``; where that is not given, of
    any vendor that is not registered for other sources.
    """
    from cohortia.plans.adobe import SegmentTargets  # extends VendorTargets, so it comes after this module

    known = REGISTRY | {("adobe", "mcid"): SegmentTargets}
    if (vendor, source) in known:
        return known[vendor, source](run_date(vendor, execution_date), **inputs)
    own = vendor == first_party if first_party else vendor not in {name for name, _ in known}
    if source != "ga" or not own:
        raise KeyError(f"unknown vendor and source {vendor}/{source}")
    return ClickLogGroups(run_date(vendor, execution_date), label=vendor, **inputs)
