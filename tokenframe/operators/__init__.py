from .extract import extract, extract_first, extract_schema
from .dictionary import dictionary_decode, dictionary_encode, dictionary_ordered
from .tokenize import tokenize, tokenize_schema, tokens_long

__all__ = [
    "dictionary_decode",
    "dictionary_encode",
    "dictionary_ordered",
    "extract",
    "extract_first",
    "extract_schema",
    "tokenize",
    "tokenize_schema",
    "tokens_long",
]
