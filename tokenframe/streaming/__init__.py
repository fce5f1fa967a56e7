from .jobs import write_batches, write_stream

__all__ = ["write_batches", "write_stream"]
