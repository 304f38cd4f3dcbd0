"""Errors with the numeric codes that callers of the reference's interface test for."""

from __future__ import annotations


class QueryError(ValueError):
    """A filter, path, order or option that is not valid. code tells which rule it breaks."""

    def __init__(self, code: int, message: str):
        super().__init__(f"[{code}] {message}")
        self.code = code


class BatchError(RuntimeError):
    """A bulk write that was given up as a whole; processed counts the documents seen before the one that failed."""

    def __init__(self, message: str, processed: int):
        super().__init__(message)
        self.processed = processed
