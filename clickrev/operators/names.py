"""Names for columns that live inside an operator only."""
from collections.abc import Callable

from pyspark.sql import DataFrame


def own_names(*frames: DataFrame) -> Callable[[str], str]:
    """A function that turns a word into a column name none of ``frames`` has.

    Names differ from all columns whatever their case, and are the same for the same columns.
    """
    taken = [name.lower() for frame in frames for name in frame.columns]
    prefix = "_"
    while any(name.startswith(prefix) for name in taken):
        prefix += "_"
    return lambda word: prefix + word
