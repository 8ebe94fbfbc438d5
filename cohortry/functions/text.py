"""Evidence in free text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def mentions(text: str, patterns: Sequence[str], unless: Sequence[str] = ()) -> Column:
    """The lower-cased text matches a pattern and none of ``unless``.

    Patterns are regular expressions, searched anywhere in the text. The result is
    null for a null text, which a filter treats as no evidence.
    """
    lowered = F.lower(text)
    found = lowered.rlike("|".join(patterns))
    return found & ~lowered.rlike("|".join(unless)) if unless else found
