"""Partition-key column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.schemas import KEY_SEPARATOR


def dims_map(**dims: Column | str) -> Column:
    """``map(dim_name -> value)`` from keyword arguments."""
    parts: list[Column] = []
    for name, value in dims.items():
        col = F.col(value) if isinstance(value, str) else value
        parts += [F.lit(name), col.cast("string")]
    return F.create_map(*parts)


def encode_key(dim_map: Column, sep: str = KEY_SEPARATOR) -> Column:
    """Multi-dimension key: values ordered by dimension *name*, joined by ``sep``.

    ``array_sort`` on the map entries orders structs by their first field, the
    key, so ``daily`` precedes ``stations``.
    """
    entries = F.array_sort(F.map_entries(dim_map))
    return F.array_join(F.transform(entries, lambda e: e["value"]), sep)


def encode_columns(*cols: str, sep: str = KEY_SEPARATOR) -> Column:
    """Key from columns that are already in dimension-name order."""
    return F.concat_ws(sep, *[F.col(c).cast("string") for c in cols])


def decode_key(key: Column | str, names: list[str], sep: str = KEY_SEPARATOR) -> list[Column]:
    """Split a key back into named columns (dimension-name order)."""
    key_col = F.col(key) if isinstance(key, str) else key
    parts = F.split(key_col, "\\" + sep if sep in "|.^$*+?()[]{}\\" else sep)
    return [parts.getItem(i).alias(n) for i, n in enumerate(names)]
