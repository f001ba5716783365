"""Column expressions (scalar functions), all JVM-side built-ins."""

from airshed.functions.time import (  # noqa: F401
    date_text, day_of, day_text, epoch_ntz, event_time_or, iso_text, nano_date, ntz_micros,
    time_text, ts_of, utc_text, valid_date,
)
from airshed.functions.text import (  # noqa: F401
    country_of, date_from_path, decode_key, encode_city, file_name, first_non_empty,
    graft, name_matches, remap_prefix, starts_with_any, strip_slash, strip_ws,
)
from airshed.functions.values import (  # noqa: F401
    estimate_int, json_in, json_out, ms_to_kmh, zero_if_null,
)
