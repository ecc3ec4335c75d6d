"""Column expressions for the profile fields and prediction post-processing.

All are built-in Spark expressions (code-generated, no Python per row). "Absent" means SQL NULL or
the literal string ``"None"``, as in the source JSON.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reference date for account age and the fallback prediction.
REFERENCE_DATE = "2021-03-10"
GUARD_VALUE = 3.0
STAR_MIN, STAR_MAX = 1.0, 5.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_absent(c) -> Column:
    c = _c(c)
    return c.isNull() | (c == F.lit("None"))


def token_count(c, sep: str = ",") -> Column:
    """Number of ``sep``-separated pieces; absent -> 0; the empty string counts as one piece."""
    return F.when(is_absent(c), F.lit(0)).otherwise(F.size(F.split(_c(c), sep)))


def map_size(c) -> Column:
    """Number of entries of a map; NULL map -> 0."""
    return F.when(_c(c).isNull(), F.lit(0)).otherwise(F.size(_c(c)))


def max_token(c, sep: str = ",") -> Column:
    """Largest piece in string order, as an int; absent -> 0.

    String order on untrimmed pieces: in ``"2012, 2015"`` the piece ``" 2015"`` sorts first, so
    the result is 2012. A piece that is not an integer gives NULL.
    """
    top = F.array_max(F.split(_c(c), sep))
    return F.when(is_absent(c), F.lit(0)).otherwise(F.trim(top).try_cast("int"))


def days_since(c, reference: str = REFERENCE_DATE) -> Column:
    """Days from a ``yyyy-MM-dd`` string to the reference date (NULL when unparsable)."""
    return F.datediff(F.lit(reference).cast("date"), F.try_to_date(_c(c), "yyyy-MM-dd"))


def is_digits(c) -> Column:
    """True when a string is non-empty and all ASCII digits."""
    return _c(c).rlike("^[0-9]+$")


def whole_number(c) -> Column:
    """A string of digits as its integer is written, without leading zeros; all else unchanged."""
    c = _c(c)
    return F.when(is_digits(c), F.regexp_replace(c, "^0+(?=[0-9])", "")).otherwise(c)


def flatten_nested_map(c) -> Column:
    """Flatten a MAP<STRING,STRING> whose values may be dict strings.

    A value containing ``{`` is stripped of quotes and braces, split on ``,`` then ``": "``; the first
    two parts of each piece become a top-level entry (keys keep their leading space and are not
    prefixed by the parent key; a piece of one part has a NULL value). Values of digits only count as
    integers. Later keys overwrite earlier ones (needs ``spark.sql.mapKeyDedupPolicy=LAST_WIN``).
    NULL map -> empty map.
    """
    entries = F.map_entries(F.coalesce(_c(c), F.create_map().cast("map<string,string>")))

    def piece(p):
        parts = F.split(p, ": ")
        return F.struct(F.get(parts, F.lit(0)).alias("key"), whole_number(F.get(parts, F.lit(1))).alias("value"))

    def expand(e):
        nested = F.transform(F.split(F.regexp_replace(e["value"], "['{}]", ""), ","), piece)
        plain = F.struct(e["key"].alias("key"), whole_number(e["value"]).alias("value"))
        return F.when(e["value"].contains("{"), nested).otherwise(F.array(plain))

    return F.map_from_entries(F.flatten(F.transform(entries, expand)))


def map_value_sum(c) -> Column:
    """Sum of the values of a MAP<STRING,INT> (0 for an empty map, NULL for a NULL map)."""
    return F.aggregate(F.map_values(_c(c)), F.lit(0).cast("long"), lambda acc, x: acc + x)


def map_value_mean(c) -> Column:
    """Mean of the map values; NULL for an empty or NULL map."""
    return F.try_divide(map_value_sum(c).cast("double"), F.size(_c(c)))


def guard_prediction(c, value: float = GUARD_VALUE) -> Column:
    """NaN, +inf, -inf, 0 (and NULL) -> ``value``; anything else unchanged."""
    c = _c(c)
    bad = (c.isNull() | F.isnan(c) | (c == float("inf")) | (c == float("-inf")) | (c == 0))
    return F.when(bad, F.lit(float(value))).otherwise(c)


def clip_prediction(c, lo: float = STAR_MIN, hi: float = STAR_MAX) -> Column:
    """Clip to [lo, hi]; NaN passes through (Spark orders NaN above every number, so test first)."""
    c = _c(c)
    return (F.when(F.isnan(c), c).when(c < lo, F.lit(float(lo)))
            .when(c > hi, F.lit(float(hi))).otherwise(c))


def blend(knn, model, knn_weight: float = 0.1) -> Column:
    """knn_weight * knn + (1 - knn_weight) * model."""
    return F.lit(knn_weight) * _c(knn) + F.lit(1.0 - knn_weight) * _c(model)
