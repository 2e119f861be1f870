"""Ready-made recipes per vendor and source.

The publisher's own click-log vendor goes by whatever label its targets carry
(``first_party`` below); pass that label to ``dataset_for`` to select its recipe.
"""

from __future__ import annotations

from cohortia.errors import InvalidDefinition
from cohortia.operators.recipes import Behavior, Dataset, MatchesAny, MatchesPercentage
from cohortia.operators.requirements import BINARY


def binary(positive: MatchesAny, negative: MatchesAny) -> Dataset:
    return Dataset(BINARY, {"positive": positive, "negative": negative})


def by_value(groups, positive=1, negative=0, **attributes) -> Dataset:
    """Groups with the positive value against the same groups with the negative."""

    def side(value):
        return MatchesAny([Behavior({**attributes, "group": g, "value": value}) for g in groups])

    return binary(side(positive), side(negative))


def against_universe(groups, vendor="adobe") -> Dataset:
    """Members of the groups against everyone the vendor has seen."""
    members = [Behavior({"vendor": vendor, "group": str(g)}) for g in groups]
    return binary(MatchesAny(members), MatchesAny([Behavior({"vendor": vendor})]))


def clicks_against_impressions(groups, vendor="dfp") -> Dataset:
    def side(source):
        return MatchesAny([Behavior({"vendor": vendor, "source": source, "group": g}) for g in groups])

    return binary(side("network_clicks"), side("network_impressions"))


def by_listed_values(groups, values_by_group=None, neg_values_by_group=None) -> Dataset:
    """Listed values per group; by default 1 against a missing value."""
    attributes = {"vendor": "ncs", "source": "custom"}

    def side(listed, default):
        return MatchesAny(
            [
                Behavior({**attributes, "group": g, "value": value})
                for g in groups
                for value in (listed[g] if listed else [default])
            ]
        )

    return binary(side(values_by_group, 1), side(neg_values_by_group, None))


def by_percentile(groups, behaviors_by_group=None, pos_threshold=0.95, neg_threshold=0.1) -> Dataset:
    """Top share of each group's values against its bottom share."""
    attributes = {"vendor": "ncs", "source": "custom"}

    def side(share, direction):
        classes = [
            MatchesPercentage(
                Behavior({**attributes, "group": g}, {"behavior": b} if b else {}),
                share,
                direction=direction,
            )
            for g in groups
            for b in (behaviors_by_group[g] if behaviors_by_group else [None])
        ]
        return MatchesAny([], classes)

    return binary(side(pos_threshold, "greater_than"), side(neg_threshold, "less_than"))


def dataset_for(vendor, source=None, first_party=None, old=False, **options) -> Dataset:
    """Default recipe of a vendor and source."""
    if vendor == "ncs" and source == "custom":
        return by_percentile(**options) if old else by_listed_values(**options)
    if vendor == "ncs" and source == "syndicated":
        return by_value(vendor="ncs", **options)
    if vendor == "adobe":
        return against_universe(**options)
    if vendor == "dfp":
        return clicks_against_impressions(**options)
    if vendor == "nielsen" and source == "dar":
        return by_value(vendor="nielsen", source="dar", **options)
    if vendor == "custom":
        return by_value(vendor="custom", source=source, **options)
    if first_party is not None and vendor == first_party:
        return by_value(vendor=first_party, **options)
    raise InvalidDefinition(f"no default recipe for {vendor}/{source}")
