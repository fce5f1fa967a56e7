"""Tokenize text columns and extract fields from them, as plain DataFrame operations."""

from .functions import capture_field_names
from .operators import (
    dictionary_decode,
    dictionary_encode,
    dictionary_ordered,
    extract,
    extract_first,
    extract_schema,
    tokenize,
    tokenize_schema,
    tokens_long,
)
from .plans import (
    check_tokenized,
    class_coverage,
    class_profile,
    extraction_report,
    shape_profile,
    unknown_tokens,
)
from .sources import Model, read_classes, read_definitions, validate_model, vocabulary
from .streaming import write_batches, write_stream

__all__ = [
    "Model",
    "capture_field_names",
    "check_tokenized",
    "class_coverage",
    "class_profile",
    "dictionary_decode",
    "dictionary_encode",
    "dictionary_ordered",
    "extract",
    "extract_first",
    "extract_schema",
    "extraction_report",
    "read_classes",
    "read_definitions",
    "shape_profile",
    "tokenize",
    "tokenize_schema",
    "tokens_long",
    "unknown_tokens",
    "validate_model",
    "vocabulary",
    "write_batches",
    "write_stream",
]
