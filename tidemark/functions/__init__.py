"""Column expressions shared by the models. All are built-in Spark functions, so
they stay inside whole-stage code generation; none depends on the session zone
when given ``TIMESTAMP_NTZ`` input."""

from tidemark.functions.scalar import (  # noqa: F401
    boundary_seconds,
    clean_email,
    epoch_micros,
    epoch_ms,
    far_future,
    nullif_blank,
    trunc_ntz,
    to_ntz,
)
