"""Column-level helpers: built-in expressions only, so they stay inside
whole-stage codegen."""

from tributary.functions.nulls import (  # noqa: F401
    concat_arrays, null_safe_on, round_half_away, safe_divide, desc_last, ratio4,
)
from tributary.functions.text import (  # noqa: F401
    flag_contains, clock_to_minutes, parse_event_time, json_long,
)
from tributary.functions.hashing import user_hash, bucket_of  # noqa: F401
from tributary.functions import bits  # noqa: F401
from tributary.functions.bits import (  # noqa: F401
    datelist_mask, mask_bits, activity_bitmaps, merge_bitmaps, days_active, bitmap_days_hex,
)
