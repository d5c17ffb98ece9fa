"""One clear error for input that an earlier step has not produced."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.errors import AnalysisException

Read = TypeVar("Read")


def require(path: str, produced_by: str, read: Callable[[], Read]) -> Read:
    """Run ``read``; if ``path`` does not exist, say which step has to run first."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"{path} does not exist: run {produced_by} first") from error
