from .model import Model, validate_model, vocabulary
from .model_files import read_classes, read_definitions

__all__ = ["Model", "read_classes", "read_definitions", "validate_model", "vocabulary"]
