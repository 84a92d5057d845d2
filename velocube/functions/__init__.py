"""Scalar Column expressions (all JVM-side built-ins, no Python UDFs)."""
from velocube.functions.time import (  # noqa: F401
    as_naive, as_utc, day_name, day_of_week, duration_min, hour_bucket, hour_of_day,
    is_weekend, month_of_year, parse_ts, resolve_epoch, time_label, to_eastern, trunc_ntz,
)
from velocube.functions.text import (  # noqa: F401
    bin_label, duration_bin, month_from_path, route, route_strict, short_label,
)
from velocube.functions.numeric import clamp0, round_js, round_py  # noqa: F401
