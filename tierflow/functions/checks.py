"""Row checks of the two quality policies.

``scored`` counts three checks and accepts a record that passes two of them;
``strict`` asks for four conditions at once. They differ on purpose: age limits
are exclusive in the first and inclusive in the second, and only the second
looks at the name.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, limits and labels of the two policies.
EMAIL_REGEX = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
EMAIL_LIKE = "%@%.%"
AGE_LOW, AGE_HIGH = 0, 120
MIN_SCORE = 2
VALID, INVALID = "VALID", "INVALID"
ERROR_TYPE = "INVALID_RECORD"


def not_blank(text: Column) -> Column:
    return F.length(F.trim(text)) > 0


def age_in_range(age: Column) -> Column:
    return age.between(AGE_LOW, AGE_HIGH)


def age_or_null(age: Column) -> Column:
    return F.when(age_in_range(age), age)


def email_flag() -> Column:
    """Null for a null email, as a regex match is."""
    return F.col("email").rlike(EMAIL_REGEX)


def age_flag() -> Column:
    age = F.col("age")
    return age.isNotNull() & (age > AGE_LOW) & (age < AGE_HIGH)


def country_flag() -> Column:
    country = F.col("country")
    return country.isNotNull() & not_blank(country)


def score(*flags: Column) -> Column:
    """Number of true flags; a null flag adds nothing."""
    points = [F.when(flag, 1).otherwise(0) for flag in flags]
    return sum(points[1:], points[0])


def strict_status() -> Column:
    """VALID when all four conditions hold; false or unknown gives INVALID."""
    passed = (
        F.col("email").like(EMAIL_LIKE)
        & age_in_range(F.col("age"))
        & F.col("country").isNotNull()
        & not_blank(F.col("name"))
    )
    return F.when(passed, VALID).otherwise(INVALID)
