from medledger.functions.scalars import (  # noqa: F401
    age_in_years,
    ageing_bucket,
    age_band,
    canonical_city,
    date_key,
    date_of_key,
    days_between,
    mean_of,
    parse_date,
    parse_flag,
    parse_int,
    parse_number,
    ratio,
    register_sql_functions,
    surrogate_key,
    text_or_null,
)
