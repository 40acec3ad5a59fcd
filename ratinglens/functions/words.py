"""Word extraction from review texts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V


def words(text: Column) -> Column:
    """Lower-case words of a text: its runs of letters. An empty word marks a text that starts otherwise.

    Cutting at everything that is no letter gives the words of the text whose other characters were replaced by
    single spaces, in one pass.
    """
    return F.split(F.lower(text), V.NON_LETTER_RUN)


def stop_words(base=None) -> list[str]:
    """Words left out of word counts: a base list plus the words of the review domain."""
    return sorted(set(V.ENGLISH_STOP_WORDS if base is None else base) | set(V.DOMAIN_STOP_WORDS))
