"""The key figures per district and neighbourhood.

Listings are the large side. Every figure that needs them joined with income or
elections first reduces them to a few sums per place, in one pass with map-side
partial sums, and joins those. The fan-out of the join is kept as a weight, so the
results equal those of joining row by row, while neither a hot place nor the number of
listings ever reaches the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civica import fixed_values as fv
from civica.functions.numbers import ratio, to_double
from civica.operators.aggregates import corr_whole, sum_by
from civica.operators.filters import keep_equal, keep_not_in
from civica.operators.joins import join_on_keys
from civica.operators.moments import combine_correlation, value_moments
from civica.operators.ranking import order_descending, top_within
from civica.operators.shaping import recast_numbers


def listings_with_income(
    listing: DataFrame, income: DataFrame, spread_by: Sequence[str] = ()
) -> DataFrame:
    """Listing rows with the income of their place, numbers recast to double."""
    joined = join_on_keys(listing, income, fv.PLACE_KEYS, spread_by=spread_by)
    return recast_numbers(joined, fv.MATRIX_COLUMNS)


def _income_weight(income: DataFrame) -> DataFrame:
    return income.groupBy(*fv.PLACE_KEYS).agg(F.count(F.lit(1)).alias("copies"))


def average_price(listing: DataFrame, income: DataFrame, by: str = "district") -> DataFrame:
    """Mean listing price by ``by``, highest first, over listings joined with income.

    A listing whose place has no income row is left out; one whose place has several
    counts once for each.
    """
    price = to_double(F.col("price"))
    places = listing.groupBy(*fv.PLACE_KEYS).agg(
        F.sum(price).alias("total"), F.count(price).alias("priced"))
    joined = places.join(_income_weight(income), fv.PLACE_KEYS)
    total = F.sum(F.col("total") * F.col("copies"))
    rows = F.sum(F.col("priced") * F.col("copies"))
    result = joined.groupBy(by).agg(ratio(total, rows).alias("avg_price"))
    return order_descending(result, "avg_price", [by])


def price_income_correlation(
    listing: DataFrame, income: DataFrame, by: str = "district"
) -> DataFrame:
    """Correlation of price and income per ``by`` over the joined rows.

    Within one place every price meets every income, so the two are uncorrelated
    there, and the moments of the joined rows follow from those of either side.
    """
    price, pay = to_double(F.col("price")), to_double(F.col("RFD"))
    prices = listing.groupBy(*fv.PLACE_KEYS).agg(*value_moments(price, "x"))
    incomes = income.groupBy(*fv.PLACE_KEYS).agg(*value_moments(pay, "y"))
    parts = prices.join(incomes, fv.PLACE_KEYS).withColumns({
        "n": F.col("x_n") * F.col("y_n"), "cov": F.lit(0.0)})
    return combine_correlation(parts, [by], "correlation")


def _party_votes(elections: DataFrame, excluded: Sequence[str]) -> DataFrame:
    parties = keep_not_in(elections, "Party", excluded)
    return parties.withColumn("Votes", to_double(F.col("Votes")))


def _winners(votes: DataFrame) -> DataFrame:
    return top_within(votes, ["district"], "total_votes")


def top_party_weighted(
    listing: DataFrame, elections: DataFrame, excluded: Sequence[str] = fv.PSEUDO_PARTIES
) -> DataFrame:
    """Most voted party per district, votes of a place counted once per listing there."""
    votes = sum_by(_party_votes(elections, excluded), [*fv.PLACE_KEYS, "Party"], "Votes", "votes")
    places = listing.groupBy(*fv.PLACE_KEYS).agg(F.count(F.lit(1)).alias("listings"))
    joined = votes.join(places, fv.PLACE_KEYS)
    total = F.sum(F.col("votes") * F.col("listings")).alias("total_votes")
    return _winners(joined.groupBy("district", "Party").agg(total))


def top_party_plain(
    elections: DataFrame, excluded: Sequence[str] = fv.PSEUDO_PARTIES
) -> DataFrame:
    """Most voted party per district, each vote counted once."""
    votes = _party_votes(elections, excluded)
    return _winners(sum_by(votes, ["district", "Party"], "Votes", "total_votes"))


def participation(
    elections: DataFrame, income: DataFrame, electors: str = fv.ELECTORS
) -> DataFrame:
    """Enrolled electors by population per district. This is not turnout."""
    enrolled = keep_equal(elections, "Party", electors)
    enrolled = recast_numbers(enrolled, ["Votes"])
    votes = sum_by(enrolled, ["district"], "Votes", "TotalVotes")
    people = sum_by(recast_numbers(income, ["pop"]), ["district"], "pop", "total_population")
    share = ratio(F.col("TotalVotes"), F.col("total_population"))
    return votes.join(people, "district").withColumn("participation", share)


def price_participation(
    listing: DataFrame, income: DataFrame, elections: DataFrame
) -> DataFrame:
    """Average price next to participation, per district."""
    prices = average_price(listing, income)
    joined = prices.join(participation(elections, income), "district")
    return joined.select("district", "avg_price", "participation")


def price_participation_correlation(
    listing: DataFrame, income: DataFrame, elections: DataFrame
) -> DataFrame:
    """Correlation of average price and participation over all districts."""
    pairs = price_participation(listing, income, elections)
    return corr_whole(pairs, "avg_price", "participation", "correlation")
