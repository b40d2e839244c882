from tidelane.functions.chemistry import add_corrected_ph, isfet_ph
from tidelane.functions.search import count_at_or_below
from tidelane.functions.time import (
    duration_us,
    from_micros,
    micros,
    normalize_time,
    time_shift,
    total_seconds,
)

__all__ = [
    "add_corrected_ph",
    "count_at_or_below",
    "duration_us",
    "from_micros",
    "isfet_ph",
    "micros",
    "normalize_time",
    "time_shift",
    "total_seconds",
]
