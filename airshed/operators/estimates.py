"""Per-day visitor lookup from estimate API responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.functions import estimate_int, name_matches, valid_date
from airshed.schemas import ESTIMATE_RESPONSE


def first_match(entries, names: Sequence[str], case_sensitive: bool = True) -> Column:
    """First array element whose ``name`` matches (NULL when none does).

    Array order is response order, so this is the loop-with-break of a
    hand-written lookup, evaluated per row by a higher-order function.
    """
    entries = F.col(entries) if isinstance(entries, str) else entries
    hit = F.filter(entries, lambda e: name_matches(e["name"], names, case_sensitive))
    return F.try_element_at(hit, F.lit(1))


def _entries(responses: DataFrame, names: Sequence[str], case_sensitive: bool, response_col: str, date_col: str,
             order_col: str | None) -> DataFrame:
    """Per response: date_text, date_str (NULL if no date), whether the city was listed, its estimate (NULL if
    not a number)."""
    hit = first_match(F.from_json(response_col, ESTIMATE_RESPONSE)["info"], names, case_sensitive)
    rows = responses.select(F.col(date_col).alias("date_text"), valid_date(date_col, strict=False).alias("date_str"),
                            hit.alias("hit"), (F.col(order_col) if order_col else F.lit(0)).alias("rank"))
    return rows.select("date_text", "date_str", F.col("hit").isNotNull().alias("listed"),
                       estimate_int(F.col("hit.estimated_no_people")).alias("tourist_estimate"), "rank")


def lookup_problems(responses: DataFrame, names: Sequence[str], case_sensitive: bool = True,
                    response_col: str = "response", date_col: str = "date_str") -> DataFrame:
    """One row of counts: responses, bad_dates, city_missing, bad_estimates (of a listed city),
    repeated_dates (responses beyond the first of their date)."""
    e = _entries(responses, names, case_sensitive, response_col, date_col, None)
    dated = F.col("date_str").isNotNull()
    per_date = e.groupBy("date_str").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(dated & ~F.col("listed")).alias("unlisted"),
        F.count_if(dated & F.col("listed") & F.col("tourist_estimate").isNull()).alias("junk"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return per_date.agg(total("n").alias("responses"), total(F.when(~dated, F.col("n"))).alias("bad_dates"),
                        total("unlisted").alias("city_missing"), total("junk").alias("bad_estimates"),
                        total(F.when(dated, F.col("n") - 1)).alias("repeated_dates"))


def build_lookup(responses: DataFrame, names: Sequence[str], case_sensitive: bool = True,
                 on_missing: str = "null", response_col: str = "response",
                 date_col: str = "date_str", order_col: str | None = None) -> DataFrame:
    """(date_str, tourist_estimate), one row per date, from JSON responses.

    Dates are validated and normalised to ``yyyy-MM-dd``.  Of several
    responses for a date (after that) the last by ``order_col`` holds; among
    equals, or without that column, the largest estimate.
    ``on_missing="null"``: a response without the city, or whose estimate is
    no number, gives a NULL estimate; one without a valid date has no place in
    the lookup (``lookup_problems`` counts all three).
    ``on_missing="error"``: any of these is an error, checked eagerly.
    """
    if on_missing not in ("error", "null"):
        raise ValueError(f"unknown on_missing {on_missing!r}")
    entries = _entries(responses, names, case_sensitive, response_col, date_col, order_col)
    if on_missing == "error":
        # Materialise once (lineage cut, shared folder) and check the stored
        # rows, so the responses are not parsed twice.
        from airshed.operators.joins import materialise
        entries, _ = materialise(entries, "lookup")
        first = lambda bad: F.min(F.when(bad, F.coalesce("date_text", F.lit("NULL"))))
        bad = entries.agg(first(F.col("date_str").isNull()).alias("date"), first(~F.col("listed")).alias("city"),
                          first(F.col("listed") & F.col("tourist_estimate").isNull()).alias("value")).first()
        for at, what in ((bad.date, "response without a calendar date"), (bad.city, f"{names[0]!r} is not listed"),
                         (bad.value, f"the estimate of {names[0]!r} is no number")):
            if at is not None:
                raise RuntimeError(f"{what}: date {at}")
    best = F.max(F.struct("rank", "tourist_estimate"))
    return entries.filter(F.col("date_str").isNotNull()).groupBy("date_str").agg(best.alias("b")) \
        .select("date_str", F.col("b.tourist_estimate").alias("tourist_estimate"))
