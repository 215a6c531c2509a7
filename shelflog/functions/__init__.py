"""Column expressions shared by the models. All of them stay inside the JVM."""

from shelflog.functions.codes import code_or_default, one_of, std_code
from shelflog.functions.keys import event_id, payload_hash, surrogate_key
from shelflog.functions.times import (
    day_of,
    hours_between,
    iso_utc,
    read_utc,
    seconds_between,
    utc_text,
)
from shelflog.functions.variants import field

__all__ = [
    "code_or_default",
    "day_of",
    "event_id",
    "field",
    "hours_between",
    "iso_utc",
    "one_of",
    "payload_hash",
    "read_utc",
    "seconds_between",
    "std_code",
    "surrogate_key",
    "utc_text",
]
