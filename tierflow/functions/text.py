"""Text and value cleaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that stand for one country code.
COUNTRY_SPELLINGS = {
    "TH": ("TH", "THAILAND"),
    "US": ("US", "USA", "UNITED STATES"),
    "GB": ("GB", "UK", "UNITED KINGDOM"),
}


def clean_name(name: Column) -> Column:
    return F.trim(name)


def clean_email(email: Column) -> Column:
    return F.lower(F.trim(email))


def canonical_country(country: Column) -> Column:
    """Known spellings to their code, anything else upper-cased as it is."""
    shouted = F.upper(country)
    first, *rest = COUNTRY_SPELLINGS.items()
    chain = reduce(
        lambda case, item: case.when(shouted.isin(*item[1]), F.lit(item[0])),
        rest,
        F.when(shouted.isin(*first[1]), F.lit(first[0])),
    )
    return chain.otherwise(shouted)
