"""Column expressions: keys, hashes, guarded arithmetic, formats, casts."""

from snapmart.functions.casts import (
    lenient_cast,
    parse_date,
    strict_cast,
    strict_date,
    strict_iso_date_text,
)
from snapmart.functions.formatting import fixed_decimals, grouped_integer, humanize_volume
from snapmart.functions.keys import (
    entity_key,
    lake_key,
    normalize_identifier,
    normalized_entity_name,
    record_hash,
    sha256_hex,
)
from snapmart.functions.numeric import (
    guarded_ratio,
    log_activity,
    min_max_scaled,
    momentum_class,
    percent_change,
    prior_estimate,
    relative_width,
    round_half_even,
    row_mean,
)

__all__ = [
    "entity_key",
    "fixed_decimals",
    "grouped_integer",
    "guarded_ratio",
    "humanize_volume",
    "lake_key",
    "lenient_cast",
    "log_activity",
    "min_max_scaled",
    "momentum_class",
    "normalize_identifier",
    "normalized_entity_name",
    "parse_date",
    "percent_change",
    "prior_estimate",
    "record_hash",
    "relative_width",
    "round_half_even",
    "row_mean",
    "sha256_hex",
    "strict_cast",
    "strict_date",
    "strict_iso_date_text",
]
