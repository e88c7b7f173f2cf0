from stratalake.functions.columns import (  # noqa: F401
    band,
    clamp,
    epoch_to_ts,
    exact_avg,
    exact_sum,
    initcap_words,
    money,
    na_to_null,
    non_negative,
    round2,
    safe_ratio,
    seconds_between,
    strip,
    sum_units,
    to_boolean,
    to_date_ts,
    to_int,
    to_number,
    to_ts,
    truthy,
    units,
)
from stratalake.functions.median import exact_median  # noqa: F401
