"""The scratch tables of the core library, for the operators here."""

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame

from ..sources import scratch as core
from ..sources.scratch import collected, delete, folder, path, table
from . import batches


def tidied(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The core's, which also drops the executors' copies of what tasks shared."""

    @wraps(f)
    def run(*args, **kwargs) -> DataFrame:
        result = core.tidied(f)(*args, **kwargs)
        batches.release()
        return result

    return run


__all__ = ["collected", "delete", "folder", "path", "table", "tidied"]
