"""Dictionary decode as a literal map lookup (runs inside codegen)."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_map(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def decode(code: Column | str, mapping: Mapping[str, str], default: str | None) -> Column:
    """``mapping[code]``, ``default`` for an unknown code, null for a null code.

    The null guard matters: a bare ``coalesce(map[code], default)`` would give
    the default to null codes, while the original per-value lookup leaves them
    null.
    """
    c = F.col(code) if isinstance(code, str) else code
    hit = F.try_element_at(literal_map(mapping), c)
    value = hit if default is None else F.coalesce(hit, F.lit(default))
    return F.when(c.isNotNull(), value)
