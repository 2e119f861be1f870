"""Vendor targets on small inputs."""

import pytest
from pyspark.sql import functions as F
from tests.conftest import day, rows

from cohortia import schemas
from cohortia.errors import EmptyInput, InvalidDefinition
from cohortia.functions import ids as fid
from cohortia.functions.aspects import aspect, aspect_columns
from cohortia.operators import identity, reshape
from cohortia.plans import targets as vendors
from cohortia.sources import identity as id_scans
from cohortia.sources import tables

D = day("2021-01-31")


def x(n):
    return f"00000000-0000-0000-0000-{n:012d}"


def ids(spark):
    data = [
        (D, "v1", "infinity_id", x(1)), (D, "v1", "infinity_id", x(1)), (D, "v1", "mdw_id", "m1"), (D, "v1", "amg_user_id", "a1"),
        (D, "v2", "infinity_id", x(2)), (D, "v2", "cds_account_number", "c2"), (D, "v3", "infinity_id", "not-an-id"),
        (D, "v3", "mdw_id", "m1"), (day("2021-01-30"), "v1", "mdw_id", "m9"), (D, None, "infinity_id", x(7)),
    ]
    return spark.createDataFrame(data, "date date, fullvisitor_id string, type string, mapped_id string")


def offline(spark):
    def table(*pairs):
        return spark.createDataFrame(list(pairs), "id string, universal_id long")

    return {"mdw_id": table(("m1", 100), ("m1", 100), ("m1", 101)), "amg_user_id": table(("a1", 100), ("c2", 999)),
            "cds_account_number": table(("c2", 200))}


def test_identity_resolution(spark):
    users = identity.users_with_offline_ids(ids(spark))
    assert rows(users) == {(x(1), "mdw_id", "m1", D): 1, (x(1), "amg_user_id", "a1", D): 1, (x(2), "cds_account_number", "c2", D): 1}
    assert rows(identity.resolve(users, offline(spark))) == {(x(1), 100, D): 1, (x(1), 101, D): 1, (x(2), 200, D): 1}
    assert rows(identity.join_offline_table(users, "mdw_id", offline(spark)["mdw_id"])) == {(x(1), 100, D): 1, (x(1), 101, D): 1}


def resolved(kind, spark, data):
    return kind(D, ids=ids(spark), offline=offline(spark)).targets(data)


def test_demographics(spark):
    data = spark.createDataFrame([(100, "F"), (200, None), (300, "M")], "universal_id long, gender_cd string")
    assert rows(resolved(vendors.IndividualGender, spark, data)) == {
        (x(1), D, "cds", "alt_individual", "gender", '{"gender":"F"}', 1.0): 1,
        (x(2), D, "cds", "alt_individual", "gender", '{"gender":null}', 1.0): 1}
    demo = spark.createDataFrame([(100, 49, "M", "C")], "universal_id long, i1_exact_age int, i1_gndr_code string, experian_income_cd_v6 string")
    found = resolved(vendors.IndividualDemographics, spark, demo)
    assert rows(found.select("group", "aspect")) == {
        ("age", '{"age":49}'): 1, ("gender", '{"gender":"M"}'): 1, ("income", '{"income_class":"C"}'): 1}


def test_purchase_categories_take_the_largest_value(spark):
    data = spark.createDataFrame([(100, 0, 1), (101, 1, 0), (200, 0, 0)], "universal_id long, cat_a int, cat_b int")
    found = resolved(vendors.PurchaseCategories, spark, data)
    assert rows(found.select("xid", "group", "aspect", "value")) == {
        (x(1), "cat_a", '{"action":"purchase"}', 1.0): 1, (x(1), "cat_b", '{"action":"purchase"}', 1.0): 1,
        (x(2), "cat_a", '{"action":"purchase"}', 0.0): 1, (x(2), "cat_b", '{"action":"purchase"}', 0.0): 1}


def test_campaign_scales_average_and_keep_null(spark):
    data = spark.createDataFrame([(100, "c", 1.0), (101, "c", 0.0), (200, "c", None)], "universal_id long, campaign string, scale double")
    assert rows(resolved(vendors.CampaignScales, spark, data).select("xid", "group", "aspect", "value")) == {
        (x(1), "c", "{}", 0.5): 1, (x(2), "c", "{}", None): 1}


def test_ad_events(spark):
    data = [(D, 5, {"user_id": x(1)}, "300x250", 11, 21, "u1"), (D, 6, {"user_id": x(1)}, "300x250", 11, 21, "u1"),
            (D, 5, {"other": "k"}, "300x250", 11, 21, "u1"), (day("2021-01-30"), 5, {"user_id": x(2)}, "1x1", 1, 2, None)]
    events = spark.createDataFrame(data, "dt date, order_id long, custom_targeting map<string,string>, creative_size string, creative_id long, line_item_id long, adunit_id string")
    expected = {(x(1), D, "dfp", "network_clicks", "5",
                 '{"creative_size":"300x250","creative_id":"11","line_item_id":"21","ad_unit_id":"u1"}', 1.0): 1}
    orders = spark.createDataFrame([(5,), (5,)], "order_id long")
    assert rows(vendors.AdClicks(D, orders=[5]).targets(events)) == expected
    assert rows(vendors.AdClicks(D, orders=orders).targets(events)) == expected


def test_ready_made_targets(spark):
    data = spark.createDataFrame([(x(1), D, "s1", "g", 1), ("bad", D, "s1", "g", 1), (x(2), day("2021-01-30"), "s2", "h", 0)],
                                 "xid string, date date, source string, group string, value int")
    assert rows(vendors.AudienceRatings(D).targets(data)) == {
        (x(1), D, "nielsen", "dar", "g", "{}", 1.0): 1, (x(2), day("2021-01-30"), "nielsen", "dar", "h", "{}", 0.0): 1}
    assert rows(vendors.CustomTargets(D).targets(data)) == {(x(1), D, "custom", "s1", "g", "{}", 1.0): 1}
    assert vendors.CustomTargets(D, source="s2").targets(data).isEmpty()


def test_click_log_groups(spark):
    # one article twice, one without keyword, an empty content id, a short id, another day
    data = [(D, x(1), "c1", "/Coronavirus/a", None, "view"), (D, x(1), "c1", "/a", None, "Affiliate Link Clicks"),
            (D, x(1), "c2", "/b", "nothing", None), (D, x(1), "", "/covid", None, None), (D, "short", "c1", "/covid", None, None),
            (day("2021-01-30"), x(1), "c9", "/covid", None, None), (D, x(2), "c3", "/b", "COVID-19", "view")]
    clicks = spark.createDataFrame(data, "dt date, infinity_id string, content_id string, hits_page_pagepath string, onsite_keywords string, hits_eventinfo_eventaction string")
    found = vendors.ClickLogGroups(D, label="own").targets(clicks)
    assert found.columns == schemas.TARGETS.names
    assert rows(found.select("xid", "vendor", "group", "aspect", "value")) == {
        (x(1), "own", "covid_readers", '{"corona_articles":1,"total_articles":2}', 1.0): 1,
        (x(1), "own", "affiliate_commerce_clicks", '{"affiliate_articles":1,"total_articles":2}', 1.0): 1,
        (x(2), "own", "covid_readers", '{"corona_articles":1,"total_articles":1}', 1.0): 1,
        (x(2), "own", "affiliate_commerce_clicks", '{"affiliate_articles":0,"total_articles":1}', 0.0): 1}


def test_vendor_lookup_and_run_dates():
    assert str(vendors.run_date("dfp", "2021-02-01")) == "2021-01-31"
    assert str(vendors.run_date("adobe", "2021-02-01")) == "2021-02-01"
    assert isinstance(vendors.vendor_for("custom", None, "2021-02-01"), vendors.CustomTargets)
    own = vendors.vendor_for("own", "ga", "2021-02-01")
    assert (own.vendor, str(own.date)) == ("own", "2021-01-31")
    with pytest.raises(KeyError):
        vendors.vendor_for("dfp", "nothing", "2021-02-01")
    assert vendors.vendor_for("own", "ga", "2021-02-01", first_party="own").vendor == "own"
    for vendor, first_party in [("dfp", None), ("adobe", None), ("other", "own")]:
        with pytest.raises(KeyError):
            vendors.vendor_for(vendor, "ga", "2021-02-01", first_party=first_party)


def test_aspects(spark):
    df = spark.createDataFrame([("A", "v1", 2)], "xid string, c1 string, c2 int")
    assert df.select(aspect({"a": "c1"}), aspect({"a": "c1", "b": "c2"}, as_text=True), aspect()).first()[:] == (
        '{"a":"v1"}', '{"a":"v1","b":"2"}', "{}")
    wide = aspect_columns(df, {"g1": {"aspect": "c1"}, "g2": {"n": "c2"}}, ["xid"])
    assert rows(reshape.to_long(wide, "key", "val", ["xid"])) == {("A", "g1", '{"aspect":"v1"}'): 1, ("A", "g2", '{"n":2}'): 1}
    with pytest.raises(InvalidDefinition):
        reshape.to_long(df, "k", "v", ["xid"])


def test_identity_days(spark):
    table = spark.createDataFrame([(D, "v", "adobe_mcid", "1" * 38), (D, "v", "adobe_mcid", "1" * 37), (D, "v", "infinity_id", x(1))],
                                  "dt date, fullvisitor_id string, type string, mapped_id string")
    mcid, xid = id_scans.id_maps(table, D, 2)
    assert rows(mcid) == {("1" * 38, "v"): 1} and rows(xid) == {(x(1), "v"): 1}
    assert id_scans.require_some_day(table, D, 2) == [day("2021-01-30")]
    with pytest.raises(EmptyInput):
        id_scans.require_some_day(table, day("2021-03-01"), 2)
    assert id_scans.ids_since(table, day("2021-02-01"), 1).columns[0] == "date"
    with pytest.raises(EmptyInput):
        id_scans.ids_since(table, day("2021-02-01"))


def test_ids_and_names(spark):
    df = spark.createDataFrame([("wf_dfp_12",), ("wf_iqvia_34_x",), ("plain",)], "name string")
    found = [tuple(r) for r in df.select(fid.vendor_of(F.col("name")), fid.trailing_number(F.col("name"), "iqvia")).collect()]
    assert found == [("dfp", None), ("iqvia", 34), ("", None)]
    assert fid.column_slug("feature_X::My Topic.a") == "feature_x__my_topica"
    topics = spark.createDataFrame([("Topics::News & Été.1",)], "t string")
    assert topics.select(fid.topic_slug("p", F.col("t"))).first()[0] == "p_topics_news__été1"
    assert df.select(fid.word_characters(F.lit("a b-c_1"))).first()[0] == "abc_1"


def test_templated_filters(spark):
    df = spark.createDataFrame([(D, "us", 1), (D, "jp's", 2), (day("2020-01-01"), "jp's", 3)], "date date, origin string, n int")

    def found(template, **arguments):
        return sorted(r.n for r in tables.matching(df, template, **arguments).collect())

    assert found("date >= DATE('{date}') AND origin = '{origin}'", date=D, origin="jp's") == [2]
    assert found("n > {n}", n=1) == [2, 3]
    assert found(None) == found("") == [1, 2, 3]
    assert tables.matching(df, "n > {n}", n=1).columns == df.columns
