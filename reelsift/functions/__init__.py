"""Column-level helpers: every function returns a native Spark ``Column``."""

from reelsift.functions.columns import (  # noqa: F401
    POSITIVE_THRESHOLD,
    clean_title,
    cosine100,
    dot,
    fmt2,
    genre_array,
    genre_pieces,
    genre_slot,
    label,
    norm,
    release_year,
    round6,
    to_double_array,
    uniform,
    unit_vector,
)
