"""Text functions with the meaning that Unicode-aware pattern libraries give them.

The JVM's ``\\s``, ``\\w`` and case folding are ASCII unless flagged; patterns here carry the flags.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Without leading and trailing Unicode white space; a text that has none at its ends isn't searched."""
    ends = F.concat(F.substring(c, 1, 1), F.substring(c, -1, 1))
    return F.when(ends.rlike(r"(?U)\s"), F.regexp_replace(c, r"(?U)^\s+|\s+$", "")).otherwise(c)


def collapse(c: Column) -> Column:
    """Each run of white space as one space."""
    return F.regexp_replace(c, r"(?U)\s+", " ")


def normalized_id(name: Column, prefix: str = "T_") -> Column:
    """A key for a topic or keyword: lower case, word signs only, blanks and hyphens as one underscore.

    A name without any word sign gets a key from its hash.
    """
    bare = F.regexp_replace(F.lower(name), r"(?U)[^\w\s-]", "")
    joined = F.regexp_replace(bare, r"(?U)[\s-]+", "_")
    return F.concat(F.lit(prefix), F.when(joined == "", F.hex(F.xxhash64(name))).otherwise(joined))


def normalized_name(name: Column) -> Column:
    """Lower case without surrounding white space."""
    return F.lower(strip(name))


def non_empty(c: Column) -> Column:
    """Neither null nor empty."""
    return F.coalesce(c != "", F.lit(False))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once for each row, whatever the optimizer does with projections."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
