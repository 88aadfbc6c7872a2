"""Column functions for typed statuses and model answers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StructType

from cohortsieve import vocabulary as v

_FENCE = r"^\s*```[A-Za-z]*\s*|\s*```\s*$"


def normalise_status(col: Column, allowed: list[str] = v.STATUSES, other: str = v.UNKNOWN) -> Column:
    """``col`` where it is an allowed value, else ``other`` (NULL too)."""
    return F.when(col.isin(allowed), col).otherwise(F.lit(other))


def parse_response(col: Column, schema: str | StructType) -> Column:
    """Typed struct out of a model's JSON answer.

    Code fences around the JSON are taken off; the fields may stand at the top level or under
    ``result``. Text that is not JSON gives NULL.
    """
    shape = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    bare = F.regexp_replace(col, _FENCE, "")
    flat = F.from_json(bare, shape)
    wrapped = F.from_json(bare, StructType().add("result", shape)).getField("result")
    fields = [
        F.coalesce(flat.getField(f.name), wrapped.getField(f.name)).alias(f.name)
        for f in shape.fields
    ]
    found = F.coalesce(*(F.coalesce(flat.getField(f.name), wrapped.getField(f.name)).cast("string")
                         for f in shape.fields))
    return F.when(found.isNotNull(), F.struct(*fields))
