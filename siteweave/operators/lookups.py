"""Chained lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import first_or, fixed, has_items, has_number


def company_website(
    requested: DataFrame, id_col: str, games: DataFrame, involved: DataFrame, companies: DataFrame
) -> DataFrame:
    """Game -> first involved company -> company -> websites, or what was missing.

    games(id, involved_companies array<long>), involved(id, company),
    companies(id, websites array<struct<url>>). Returns (id_col, answer); several
    websites are separated by blanks.
    """
    first = first_or(F.col("involved_companies"), None)
    game = games.select(F.col("id").alias("_g"), has_items(F.col("involved_companies")).alias("_any"), first.alias("_inv"))
    link = involved.select(F.col("id").alias("_i"), F.col("company").alias("_company"))
    firm = companies.select(F.col("id").alias("_c"), F.col("websites.url").alias("_urls"))
    joined = (
        requested.select(id_col)
        .join(game, F.col(id_col) == F.col("_g"), "left")
        .join(link, F.col("_inv") == F.col("_i"), "left")
        .join(firm, F.col("_company") == F.col("_c"), "left")
    )
    answer = (
        F.when(F.col("_g").isNull(), fixed.NO_GAME)
        .when(~F.col("_any"), fixed.NO_COMPANIES)
        .when(F.col("_i").isNull(), fixed.NO_INVOLVEMENT)
        .when(~has_number(F.col("_company")), fixed.NO_COMPANY_ID)
        .when(F.col("_urls").isNull(), fixed.NO_WEBSITE)
        .otherwise(F.array_join("_urls", " "))
    )
    return joined.select(id_col, answer.alias("answer"))
