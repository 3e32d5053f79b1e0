"""Composed jobs against the direct, row-by-row form, and the shape of their plans."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civica import fixtures as fx
from civica.functions.statistics import safe_corr
from civica.operators import ranking
from civica.plans import kpis, price_model, reconcile, sheets

SF = "/root/testdata/sf0.001"
KEYS = ["neighborhood", "district"]

names = st.sampled_from(["a", "b", "c", None])
prices = st.one_of(st.none(), st.integers(0, 5).map(float))
listings = st.lists(st.tuples(names, names, prices), max_size=30)
incomes = st.lists(st.tuples(names, names, prices, st.integers(1, 3)), max_size=12)
parties = st.sampled_from(["PP", "PSC", "ERC", "Electors", None])
votes = st.lists(st.tuples(names, names, parties, prices), max_size=12)

few = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def close(a, b):
    if a is None or b is None:
        return a is b
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


def frames(spark, homes, pay):
    listing = spark.createDataFrame(homes, "neighborhood string, district string, price double")
    income = spark.createDataFrame(
        pay, "neighborhood string, district string, RFD double, pop int")
    return listing, income


@few
@given(homes=listings, pay=incomes, by=st.sampled_from(["district", "neighborhood"]))
def test_price_figures_equal_row_by_row(spark, homes, pay, by):
    listing, income = frames(spark, homes, pay)
    direct = listing.join(income, KEYS).groupBy(by).agg(
        F.avg("price").alias("avg_price"), safe_corr("price", "RFD").alias("correlation"))
    want = {r[by]: r for r in direct.collect()}
    price = {r[by]: r["avg_price"] for r in kpis.average_price(listing, income, by).collect()}
    corr = {
        r[by]: r["correlation"]
        for r in kpis.price_income_correlation(listing, income, by).collect()}
    assert set(price) == set(corr) == set(want)
    for key, row in want.items():
        assert close(price[key], row["avg_price"])
        assert close(corr[key], row["correlation"])


@few
@given(homes=listings, polled=votes)
def test_weighted_winners_equal_fan_out(spark, rows, homes, polled):
    listing, _ = frames(spark, homes, [])
    elections = spark.createDataFrame(
        polled, "neighborhood string, district string, Party string, Votes double")
    fan_out = listing.join(elections, KEYS).where(~F.col("Party").isin("Electors"))
    summed = fan_out.groupBy("district", "Party").agg(F.sum("Votes").alias("total_votes"))
    want = ranking.top_within(summed, ["district"], "total_votes")
    assert rows(kpis.top_party_weighted(listing, elections)) == rows(want)


def test_constant_income_has_no_correlation(spark):
    rng = random.Random(3)
    homes = [("a", "d", rng.random() * 1e5) for _ in range(50)] + [("b", "d", 7.0)] * 9
    listing, income = frames(spark, homes, [("a", "d", 0.1, 1), ("b", "d", 0.1, 1)])
    assert kpis.price_income_correlation(listing, income).first()["correlation"] is None


def test_text_numbers_and_text_votes(spark, rows):
    listing = spark.createDataFrame(
        [("a", "d", "10.5"), ("a", "d", "bad")],
        "neighborhood string, district string, price string")
    income = spark.createDataFrame(
        [("a", "d", "1", "4")], "neighborhood string, district string, RFD string, pop string")
    elections = spark.createDataFrame(
        [("a", "d", "Electors", "3"), ("a", "d", "PP", "2")],
        "neighborhood string, district string, Party string, Votes string")
    assert rows(kpis.average_price(listing, income)) == [("d", 10.5)]
    assert rows(kpis.participation(elections, income)) == [("d", 3.0, 4.0, 0.75)]
    assert rows(kpis.top_party_plain(elections)) == [("d", "PP", 2.0, 1)]


def test_reconcile_income_in_the_raw_layout(spark, rows):
    raw = spark.createDataFrame(
        [(1, "ciutat vella", 1, "el raval", [(65.0, 48485, 2011), (70.0, 1, 2012)]),
         (2, "ciutat vella", 1, "unknown", [])],
        "_id int, district_name string, district_id int, `neigh_name ` string, "
        "info array<struct<RFD: double, pop: int, year: int>>")
    districts = spark.createDataFrame([("ciutat vella", "Ciutat Vella")], "r string, n string")
    places = spark.createDataFrame([("el raval", "El Raval")], "r string, n string")
    got = reconcile.reconcile_income(
        [raw], reconcile.Lookup(districts, "r", "n"), reconcile.Lookup(places, "r", "n"))
    assert sorted(got.columns) == ["RFD", "district", "neighborhood", "pop", "year"]
    assert rows(got, "district", "neighborhood", "RFD", "pop", "year") == [
        ("Ciutat Vella", "El Raval", 65.0, 48485, 2011), ("Ciutat Vella", None, None, None, None)]


def test_tied_parties_repeat_shapes(spark, rows):
    metrics = spark.createDataFrame(
        [("d", "10,5", "0,25")], "district string, avg_price string, participation string")
    geometry = spark.createDataFrame(
        [(1, "d", "P2"), (1, "d", "P1"), (2, None, "P3")],
        "codi_districte int, nom_districte string, geometria_wgs84 string")
    tied = spark.createDataFrame(
        [("d", "PP", "9"), ("d", "ERC", "9")], "district string, Party string, total_votes string")
    board = sheets.dashboard_join(metrics, geometry, tied)
    assert rows(sheets.sheet_price(board)) == [("d", 10.5, ["P1", "P1", "P2", "P2"])]
    assert rows(sheets.sheet_participation(board)) == [("d", 100.0, ["P1", "P1", "P2", "P2"])]
    assert rows(sheets.sheet_party(board), "Party", "colour") == [
        ("ERC", None), ("PP", "#4e79a7")]


def test_split_is_complete_and_stable(spark, rows):
    df = spark.range(2000)
    train, test = price_model.split(df, "id")
    again, _ = price_model.split(df.repartition(7), "id")
    assert train.intersect(test).isEmpty()
    assert train.count() + test.count() == 2000
    assert rows(train) == rows(again)
    assert 0.65 < train.count() / 2000 < 0.75


def test_model_skips_unseen_places_and_missing_prices(spark):
    train = spark.createDataFrame(
        [("a", 10.0), ("a", 12.0), ("b", 30.0), ("b", 34.0), ("b", None), ("c", 50.0)],
        "neighborhood string, price double")
    model = price_model.fit_price_model(train)
    test = spark.createDataFrame(
        [("a", 11.0), ("unseen", 1.0), (None, 1.0)], "neighborhood string, price double")
    scored = price_model.score(model, test, "neighborhood").collect()
    assert [r["neighborhood"] for r in scored] == ["a"]
    assert abs(scored[0]["prediction"] - 11.0) < 0.5


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("make", [
    lambda s: kpis.average_price(fx.listing(s, SF), fx.income(s, SF)),
    lambda s: kpis.price_income_correlation(fx.listing(s, SF), fx.income(s, SF)),
    lambda s: kpis.top_party_weighted(fx.listing(s, SF), fx.elections(s, SF)),
    lambda s: reconcile.reconcile_listings(fx.raw_listings(s, SF), *fx.lookups(s, SF)),
])
def test_plans_stay_in_the_jvm(spark, make):
    text = executed(make(spark))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "collect_list"):
        assert node not in text


def test_listings_are_reduced_before_the_join(spark):
    """Only needed columns are read, and partial sums come before the first shuffle."""
    text = executed(kpis.average_price(fx.listing(spark, SF), fx.income(spark, SF)))
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text
    assert "partial_sum(price" in text


def test_equality_filter_reaches_the_scan(spark):
    orders = fx.table(spark, SF, "orders")
    from civica.operators.filters import keep_equal
    assert "EqualTo(o_orderstatus,F)" in executed(keep_equal(orders, "o_orderstatus", "F"))


def test_top_rows_are_limited_before_the_shuffle(spark):
    orders = fx.table(spark, SF, "orders")
    text = executed(ranking.top_within(orders, ["o_orderpriority"], "o_totalprice", k=2))
    assert text.count("WindowGroupLimit") == 2
