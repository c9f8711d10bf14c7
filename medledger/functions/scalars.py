"""Column helpers. Everything here stays JVM-side: no Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

MONEY = "decimal(18,2)"
SHARE = "decimal(9,4)"
OPEN_END = "9999-12-31"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def name(c: str) -> str:
    return f"`{c}`"


# The row-level helpers take column names and are single SQL expressions: one call to the JVM each,
# where the same thing as a tree of Column calls takes dozens, for every column of every table.


def text_or_null(c: str) -> Column:
    """Raw text marks a missing value with an empty string."""
    return F.expr(f"nullif({name(c)}, '')")


def parse_number(c: str, to: str = MONEY) -> Column:
    """Text to number; empty or unparseable text gives NULL, never an error."""
    return F.expr(f"try_cast(nullif({name(c)}, '') AS {to})")


def parse_int(c: str) -> Column:
    return parse_number(c, "int")


def parse_flag(c: str) -> Column:
    return F.expr(f"lower({name(c)}) = 'true'")


def date_sql(s: str) -> str:
    """Three layouts: an ISO prefix (timestamps pass), dd/mm/yyyy and dd-mm-yyyy; else NULL.

    The layout is told apart by its separators, each is rebuilt as ISO text and cast, so neither a
    regular expression nor a pattern formatter runs per row. The cast itself rejects non-digits and
    impossible dates such as 31/02; only a one-digit day, which it would accept, is checked here.
    """
    return f"""try_cast(CASE
        WHEN substr({s}, 5, 1) = '-' AND substr({s}, 8, 1) = '-' AND substr({s}, 10, 1) BETWEEN '0' AND '9'
        THEN substr({s}, 1, 10)
        WHEN length({s}) = 10 AND substr({s}, 3, 1) IN ('/', '-') AND substr({s}, 3, 1) = substr({s}, 6, 1)
             AND substr({s}, 2, 1) BETWEEN '0' AND '9'
        THEN concat(substr({s}, 7, 4), '-', substr({s}, 4, 2), '-', substr({s}, 1, 2))
    END AS date)"""


def parse_date(c: str) -> Column:
    return F.expr(date_sql(name(c)))


def register_sql_functions(spark: SparkSession) -> None:
    """The same parser for SQL text: a SQL UDF, which Catalyst inlines."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION parse_claim_date(s STRING) RETURNS DATE
        RETURN {date_sql('s')}
    """)


def canonical_city(c: str) -> Column:
    """Trimmed text with a capital after every character that is neither letter nor digit.

    Spark's own ``initcap`` starts a word only after white space, so `al-shifa` would stay
    `Al-shifa`; the split below keeps each separator at the end of the piece before it.
    """
    low = f"lower(trim({name(c)}))"
    return F.expr(rf"""CASE WHEN {low} RLIKE r'[^\p{{L}}\p{{N}}]' THEN
        array_join(transform(split({low}, r'(?<=[^\p{{L}}\p{{N}}])', -1), p -> concat(upper(left(p, 1)), substr(p, 2))), '')
        ELSE concat(upper(left({low}, 1)), substr({low}, 2)) END""")


def surrogate_key(*cols: str) -> Column:
    parts = ", ".join(f"coalesce(cast({name(c)} AS string), '_null_')" for c in cols)
    return F.expr(f"md5(concat_ws('|', {parts}))")


def date_key(c: str) -> Column:
    """Date to a yyyymmdd integer, by arithmetic rather than by a formatter."""
    d = name(c)
    return F.expr(f"year({d}) * 10000 + month({d}) * 100 + day({d})")


def date_of_key(c: str) -> Column:
    k = name(c)
    return F.expr(f"make_date({k} div 10000, {k} div 100 % 100, {k} % 100)")


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(_col(later), _col(earlier))


def age_in_years(birth: str, as_of: str) -> Column:
    """Whole multiples of 365 days, truncated; not calendar years."""
    return F.expr(f"int(datediff(date '{as_of}', {name(birth)}) div 365)")


def age_band(age: Column | str) -> Column:
    a = _col(age)
    return (
        F.when(a < 18, "0-17").when(a < 30, "18-29").when(a < 45, "30-44").when(a < 60, "45-59").otherwise("60+")
    )


def ageing_bucket(days: Column | str) -> Column:
    d = _col(days)
    return F.when(d <= 30, "0-30").when(d <= 60, "31-60").when(d <= 90, "61-90").otherwise("90+")


def ratio(num: Column | str, den: Column | str, positive: bool = True) -> Column:
    """num / den as double; NULL when den is 0 (or, by default, not above 0)."""
    n, d = _col(num).cast("double"), _col(den).cast("double")
    guard = d > 0 if positive else d != 0
    return F.when(guard, F.try_divide(n, d))


def mean_of(c: Column | str, over: WindowSpec | None = None) -> Column:
    """Mean from an exact sum: the result does not depend on the order rows arrive in."""
    total, n = F.sum(_col(c)), F.count(_col(c))
    if over is not None:
        total, n = total.over(over), n.over(over)
    return ratio(total, n)
