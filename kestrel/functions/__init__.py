"""Column expressions built only from ``pyspark.sql.functions`` (JVM side, whole-stage codegen)."""

from kestrel.functions.text import (  # noqa: F401
    after_first_colon,
    safe_double,
    split_fields,
    strip_quotes,
    ustrip,
)
from kestrel.functions.numeric import (  # noqa: F401
    celsius_to_fahrenheit,
    exact_sum,
    nan_as_zero,
    round_half_up,
    row_total,
)
from kestrel.functions.temporal import auto_timestamp, local_date  # noqa: F401
