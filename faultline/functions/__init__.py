from faultline.functions.scalar import (
    CRITICAL,
    SEVERITY_WEIGHTS,
    contains_ignore_case,
    elapsed_minutes,
    excerpt,
    hashed_uniform,
    pick,
    severity_weight,
    time_to_clear,
    zero_pad,
)

__all__ = [
    "CRITICAL",
    "SEVERITY_WEIGHTS",
    "contains_ignore_case",
    "elapsed_minutes",
    "excerpt",
    "hashed_uniform",
    "pick",
    "severity_weight",
    "time_to_clear",
    "zero_pad",
]
