"""Column-level building blocks (standardise, derive, render)."""

from routeflow.functions.columns import (  # noqa: F401
    all_not_null,
    any_null,
    as_flag,
    bucket,
    code,
    differs,
    flag_contradicts,
    null_if,
    number_text,
    outside,
    route_key,
    template,
    text,
    try_convert,
    verdict,
)
