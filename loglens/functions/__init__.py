"""Column functions (projections) of the log model."""

from loglens.functions.status import (  # noqa: F401
    status_last_segment,
    status_regex,
    status_strict,
)
from loglens.functions.outcome import (  # noqa: F401
    error_4xx_5xx,
    failure_not_ok_message,
    success_2xx,
    success_below_400,
)
from loglens.functions.timefn import (  # noqa: F401
    epoch_micros,
    epoch_seconds,
    epoch_to_timestamp,
    epoch_to_timestamp_seconds,
)
from loglens.functions.common import safe_ratio  # noqa: F401
from loglens.functions.bloomhash import bloom_index, bloom_indices  # noqa: F401
from loglens.functions.formatting import format_value, format_timestamp  # noqa: F401
