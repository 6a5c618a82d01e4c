"""Column expressions with the null rules that the play features need."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def clip(c: Column | str, low: float, high: float) -> Column:
    """Between ``low`` and ``high``; null stays null (``greatest`` and ``least`` alone would skip it)."""
    c = _col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def flag(condition: Column, kind: str = "double") -> Column:
    """A condition as 0 or 1; null stays null."""
    return condition.cast(kind)


def truth(condition: Column, kind: str = "long") -> Column:
    """A condition as 0 or 1; null counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast(kind)


def one_hot(c: Column | str, values: Sequence, prefix: str, kind: str = "double") -> dict[str, Column]:
    return {f"{prefix}{v}": flag(_col(c) == F.lit(v), kind) for v in values}


def ranges(c: Column | str, edges: Sequence[float], prefix: str) -> dict[str, Column]:
    """Flags of half-open ranges: below the first edge, between edges, from the last edge on."""
    c = _col(c)
    lows, highs = [None, *edges], [*edges, None]
    out = {}
    for k, (low, high) in enumerate(zip(lows, highs, strict=True)):
        parts = [x for x in ((c >= low) if low is not None else None, (c < high) if high is not None else None) if x is not None]
        out[f"{prefix}{k}"] = flag(parts[0] if len(parts) == 1 else parts[0] & parts[1])
    return out


def bucket(c: Column | str, steps: Sequence[tuple[float, str]], rest: str) -> Column:
    """The name of the first step whose upper bound (inclusive) holds; null stays null."""
    c = _col(c)
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for bound, name in steps:
        out = out.when(c <= bound, name)
    return out.otherwise(rest)


def sign_flip(c: Column | str, keep: Column) -> Column:
    """``c`` where ``keep`` holds, its negative elsewhere (also where ``keep`` is null)."""
    c = _col(c)
    return F.when(keep, c).otherwise(-c)


def renamed(c: Column | str, names: Mapping[str, str]) -> Column:
    """Mapped values; what the mapping doesn't know stays."""
    c = _col(c)
    if not names:
        return c
    pairs = [F.lit(x) for kv in names.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[c], c)


def matched(c: Column | str, pattern: str, group: int = 1) -> Column:
    """A group of the first match; null (not '') if nothing matches."""
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit(""))


def clock_seconds(c: Column | str) -> Column:
    """``MM:SS`` as seconds; null if it isn't such a text."""
    parts = F.split(_col(c), ":", 2)
    return F.try_add(F.get(parts, F.lit(0)).try_cast("int") * 60, F.get(parts, F.lit(1)).try_cast("int"))


def half_of(quarter: Column | str) -> Column:
    q = _col(quarter)
    return F.when(q.isNull(), F.lit(None).cast("string")).when(q.isin(1, 2), "Half1").when(q.isin(3, 4), "Half2").otherwise("Overtime")


def decay(value: Column | str, left: Column | str, whole: float = 3600.0, rate: float = 4.0, grow: bool = False) -> Column:
    """``value`` times (or, to ``grow``, divided by) exp(-rate * elapsed share), where ``left`` of ``whole`` is left."""
    factor = F.exp(-F.lit(rate) * (F.lit(whole) - _col(left)) / F.lit(whole))
    return _col(value) / factor if grow else _col(value) * factor


def expected(probabilities: Column, values: Column) -> Column:
    """Sum of products of two arrays."""
    return F.aggregate(F.zip_with(probabilities, values, lambda p, v: p * v), F.lit(0.0), lambda a, x: a + x)
