"""Constant lookup tables inside an expression."""

import json
import zlib
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Beyond this many entries a table belongs in a DataFrame and a join.
MAX_LITERAL_ENTRIES = 20_000


def lookup(key: Column, table: Mapping[str, float]) -> Column:
    """Value of a string key in a small constant table, null if absent.

    A Spark map is searched from front to back. Entries are therefore spread over many small maps by
    a checksum that Python and Spark share, which leaves about one comparison per lookup.
    """
    if len(table) > MAX_LITERAL_ENTRIES:
        raise ValueError(f"{len(table)} entries; use a join for more than {MAX_LITERAL_ENTRIES}")
    width = max(1, len(table))
    slots: list[dict[str, float]] = [{} for _ in range(width)]
    for term, value in table.items():
        slots[zlib.crc32(term.encode("utf-8")) % width][term] = float(value)
    constant = F.from_json(F.lit(json.dumps(slots)), "array<map<string,double>>")
    slot = (F.crc32(key) % F.lit(width)).cast("int")
    return F.try_element_at(F.get(constant, slot), key)
