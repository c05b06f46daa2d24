"""A folder every executor can reach, for tables written on the way."""
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import SparkSession

from clickrev.sources.files import delete, delete_at_exit, join_path

_SETTING = "spark.checkpoint.dir"
_open_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("open_scopes", default=())


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a folder below the warehouse, but only for a local master: on a
    cluster nothing says that all executors share one, so that is refused.
    """
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder
    master = spark.conf.get("spark.master", "")
    if master.split("[")[0] != "local":
        raise ValueError(
            f"set {_SETTING} to a folder that the driver and all executors share: "
            f"intermediate tables go there, and with master {master!r} none can be assumed"
        )
    return join_path(spark.conf.get("spark.sql.warehouse.dir"), "_clickrev")


def workspace(spark: SparkSession, label: str) -> str:
    """A new folder for intermediate tables.

    A result that is read lazily may need it until the driver ends, when it is deleted,
    also if the session was stopped before. :func:`discard` and :func:`scratch` delete it
    earlier.
    """
    folder = join_path(shared_folder(spark), f"clickrev-{label}-{uuid4().hex}")
    delete_at_exit(spark, folder)
    for scope in _open_scopes.get()[-1:]:
        scope.append(folder)
    return folder


def discard(spark: SparkSession, folder: str) -> None:
    """Delete an intermediate folder that nothing will read any more."""
    delete(spark, folder)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, every workspace that was opened inside it.

    For a step whose result has been written elsewhere by then.
    """
    folders: list[str] = []
    token = _open_scopes.set((*_open_scopes.get(), folders))
    try:
        yield
    finally:
        _open_scopes.reset(token)
        for folder in folders:
            discard(spark, folder)
