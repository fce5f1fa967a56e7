from .reports import (
    check_tokenized,
    class_coverage,
    class_profile,
    extraction_report,
    shape_profile,
    unknown_tokens,
)

__all__ = [
    "check_tokenized",
    "class_coverage",
    "class_profile",
    "extraction_report",
    "shape_profile",
    "unknown_tokens",
]
