"""Schema enforcement by tolerant casts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import parse

INTEGERS = ("tinyint", "smallint", "int", "bigint")


def typed(df: DataFrame, name: str, to: str, strip: str = "") -> Column:
    """Column ``name`` of ``df`` as type ``to``; what cannot be read is NULL.

    ``strip`` names characters removed from text before it is parsed.
    """
    c = df[name]
    if not isinstance(df.schema[name].dataType, T.StringType):
        return c.try_cast(to)
    return _read(c, to, strip)


def _read(text: Column, to: str, strip: str) -> Column:
    if strip:
        text = parse.strip_chars(text, strip)
    if to in INTEGERS:
        return parse.parse_int(text, to)
    return parse.parse_double(text) if to == "double" else text.try_cast(to)


def typed_together(df: DataFrame, types: Mapping[str, str], strip: str = "") -> DataFrame:
    """``df`` with each column that ``types`` names as :func:`typed` has it.

    Texts that become numbers of one type are read by one function over an array of
    them, so that the code of a row does not grow with their number: spelt out for
    each of twenty columns, it is more than Java compiles.
    """
    texts: dict[str, list[str]] = {}
    for name, to in types.items():
        if isinstance(df.schema[name].dataType, T.StringType) and (to in INTEGERS or to == "double"):
            texts.setdefault(to, []).append(name)
    read, arrays = {}, []
    for to, names in texts.items():
        array = f"__texts_as_{to}"
        together = F.array(*[df[name] for name in names])
        arrays.append(F.transform(together, lambda text: _read(text, to, strip)).alias(array))
        read |= {name: F.get(F.col(array), F.lit(i)) for i, name in enumerate(names)}
    kept = [typed(df, c, types[c], strip).alias(c) if c in types else df[c] for c in df.columns if c not in read]
    return df.select(*kept, *arrays).select(*[read[c].alias(c) if c in read else F.col(c) for c in df.columns])


def enforce_schema(
    df: DataFrame, types: Mapping[str, str], *, strict: bool = False
) -> DataFrame:
    """Cast the columns named in ``types``; other columns pass through.

    Lenient by default: names that ``df`` lacks are ignored.  With ``strict``
    a missing column is an error.
    """
    missing = [name for name in types if name not in df.columns]
    if strict and missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return typed_together(df, {name: types[name] for name in df.columns if name in types})
