from .patterns import capture_field_names
from .tokens import class_expr, decode_col, encode_col, tokens_col, type_expr

__all__ = [
    "capture_field_names",
    "class_expr",
    "decode_col",
    "encode_col",
    "tokens_col",
    "type_expr",
]
