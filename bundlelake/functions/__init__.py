from bundlelake.functions.json import (  # noqa: F401
    CASTS, age_in_years, date_prefix, json_scalar, strip_ref,
)
