"""Where in a record's text a field begins."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def csv_field_position(text: Column, index: Column, sep: str = ",", quote: str = '"', escape: str = '"') -> Column:
    """1-based place of the field ``index`` (from 0) of a csv record; null if the record has fewer.

    Separators and line breaks inside quotes belong to the field.
    """
    s, q, e = re.escape(sep), re.escape(quote), re.escape(escape)
    # Possessive loops: a long field takes no stack.
    inside = f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+" if quote == escape else f"[^{q}{e}]*+(?:{e}.[^{q}{e}]*+)*+"
    fields = F.concat(F.lit(f"(?s)^(?:(?:{q}{inside}{q})?[^{s}]*+{s}){{"), index.cast("string"), F.lit("}"))
    before = F.length(F.call_function("regexp_extract", text, fields, F.lit(0))) + 1
    return F.when((index == 0) | (before > 1), F.when(index == 0, 1).otherwise(before)).cast("long")


def json_value_position(text: Column, key: Column) -> Column:
    """1-based place of the value of ``key`` (in any case) in the text of a JSON object.

    One pass over the characters, which knows strings, escapes and nesting.  Without such a key: the place after the end of a text that
    is cut off, else null.
    """
    def state(pos, depth, inside, escaped, start, end, wanted, found) -> Column:
        named = {"pos": pos, "depth": depth, "inside": inside, "escaped": escaped, "start": start, "end": end, "wanted": wanted, "found": found}
        return F.struct(*[v.cast("boolean" if k in ("inside", "escaped", "wanted") else "int").alias(k) for k, v in named.items()])

    zero, no = F.lit(0), F.lit(False)

    def step(s: Column, c: Column) -> Column:
        pos = s["pos"] + 1
        quoted = c == '"'
        opens = quoted & ~s["inside"]
        closes = quoted & s["inside"] & ~s["escaped"]
        outside = ~s["inside"]
        depth = s["depth"] + F.when(outside & c.isin("{", "["), 1).when(outside & c.isin("}", "]"), -1).otherwise(0)
        named = F.lower(F.substring(text, s["start"] + 1, s["end"] - s["start"] - 1)) == F.lower(key)
        begins = s["wanted"] & outside & ~c.rlike(r"\s")
        wanted = (outside & (c == ":") & (s["depth"] == 1) & F.coalesce(named, no)) | (s["wanted"] & ~begins)
        return state(
            pos, depth, opens | (s["inside"] & ~closes), s["inside"] & (c == "\\") & ~s["escaped"], F.when(opens, pos).otherwise(s["start"]), F.when(closes, pos).otherwise(s["end"]),
            wanted, F.when(begins & (s["found"] == 0), pos).otherwise(s["found"]),
        )

    def result(s: Column) -> Column:
        return F.when(s["found"] > 0, s["found"]).when(s["inside"] | (s["depth"] > 0), s["pos"] + 1).cast("long")

    characters = F.filter(F.split(text, ""), lambda c: c != "")
    return F.aggregate(characters, state(zero, zero, no, no, zero, zero, no, zero), step, result)
