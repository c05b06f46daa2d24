"""Predicates on the packed event list of a hit."""
from pyspark.sql import Column, functions as F

_BLANKS = " \t\n\x0b\x0c\r"


def has_event(event_list: Column, code: str) -> Column:
    """True where ``event_list`` holds ``code`` as a whole token.

    ``2, 1 ,12`` holds 1; ``10,12`` does not. NULL stays NULL, which a filter drops.
    """
    tokens = F.split(event_list, ",", -1)
    return F.exists(tokens, lambda token: F.trim(token, F.lit(_BLANKS)) == code)
