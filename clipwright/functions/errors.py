"""Which failures are worth another try."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


class RetryableError(Exception):
    """Base of failures that may pass, and of whatever subclasses users give it."""


class TransientIOError(RetryableError):
    pass


class OOMError(RetryableError):
    pass


class DecodeError(Exception):
    pass


class InvalidDataError(Exception):
    pass


class ModelMissingError(Exception):
    pass


#: The names of the classes by verdict, and the reasons read from messages.
PASSING = ("RetryableError", "TransientIOError", "OOMError")
LASTING = ("DecodeError", "InvalidDataError", "ModelMissingError")
OOM, CUDA, UNKNOWN = "oom", "cuda_error", "unknown"


def ancestry(error: BaseException) -> list[str]:
    """The names of an error's class and of its bases, nearest first: what workers report, as a class by itself says
    nothing of what it derives from."""
    return [c.__name__ for c in type(error).__mro__ if c not in (Exception, BaseException, object)]


def _among(kinds: Column, names: tuple[str, ...]) -> Column:
    return F.coalesce(F.arrays_overlap(kinds, F.array(*map(F.lit, names))), F.lit(False))


def reason(kinds: Column, message: Column) -> Column:
    """kinds: an error's ancestry. A class of known descent decides, by its own name; otherwise the message does."""
    said = F.lower(F.coalesce(message, F.lit("")))
    known = F.when(_among(kinds, PASSING) | _among(kinds, LASTING), F.get(kinds, F.lit(0)))
    return known.when(said.contains("out of memory"), F.lit(OOM)).when(said.contains("cuda") & said.contains("error"), F.lit(CUDA)).otherwise(F.lit(UNKNOWN))


def retryable(kinds: Column, message: Column) -> Column:
    return _among(kinds, PASSING) | reason(kinds, message).isin(OOM, CUDA)


def next_delay(attempt: Column, base_s: float = 5.0, backoff: float = 3.0) -> Column:
    return F.lit(base_s) * F.pow(F.lit(backoff), F.greatest(F.lit(0), attempt - 1))
