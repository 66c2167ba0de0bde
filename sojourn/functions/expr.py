"""Column expressions shared by the operators. All stay inside codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def truth(condition: Column) -> Column:
    """Two-valued view of a predicate: null counts as false."""
    return F.coalesce(condition, F.lit(False))


def days_between(end: Column | str, start: Column | str) -> Column:
    """Whole calendar days from ``start`` to ``end`` as bigint; null if either is."""
    end = F.col(end) if isinstance(end, str) else end
    start = F.col(start) if isinstance(start, str) else start
    return F.datediff(end.cast("date"), start.cast("date")).cast("bigint")


def floored_age(index_date: Column, birth: Column) -> Column:
    """Age used to select the cohort: whole 365-day years."""
    return F.floor(F.datediff(index_date, birth) / 365).cast("int")


def rounded_age(index_date: Column, birth: Column) -> Column:
    """Age recorded on the patient: rounded 365.25-day years."""
    return F.bround(F.datediff(index_date, birth) / F.lit(365.25)).cast("int")


def clamp(value: Column, low: int | None = None, high: int | None = None) -> Column:
    """Bound a value and keep null as null (bare greatest/least would drop it)."""
    bounded = value
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(value.isNotNull(), bounded)


def keep_until(date: Column, limit: Column) -> Column:
    """Null out an event dated after the end of observation."""
    return F.when(date <= limit, date)


def band(value: Column, edges: Sequence[tuple[int, str]], top: str) -> Column:
    """CASE banding: first edge the value lies under, else ``top`` (null included)."""
    expr: Column | None = None
    for edge, label in edges:
        expr = F.when(value < edge, label) if expr is None else expr.when(value < edge, label)
    return expr.otherwise(top) if expr is not None else F.lit(top)


def age_band(age: Column) -> Column:
    return band(age, ((65, "<65"), (75, "65-74")), "75+")


def burden_band(score: Column) -> Column:
    return band(score, ((2, "low"), (4, "medium")), "high")


def surrogate_key(prefix: str, natural: Column, suffix: Column | None = None, width: int = 8) -> Column:
    """``PREFIX-00000042[-k]`` over a natural key; keys longer than ``width`` stay whole."""
    text = natural.cast("string")
    padded = F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)
    parts = [F.lit(f"{prefix}-"), padded]
    if suffix is not None:
        parts += [F.lit("-"), suffix.cast("string")]
    return F.concat(*parts)


def sql_columns(columns: Mapping[str, str]) -> dict[str, Column]:
    """Named SQL expressions as columns, for long lists where SQL reads better."""
    return {name: F.expr(text) for name, text in columns.items()}


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_map(mapping: Mapping[str, str], key: str) -> Column:
    """Look a column up in a small fixed dictionary; unknown keys give null."""
    arms = " ".join(f"WHEN {sql_text(k)} THEN {sql_text(v)}" for k, v in mapping.items())
    return F.expr(f"CASE {key} {arms} END")


def literal_item(values: Sequence[str], number: str) -> Column:
    """Value at a position of a small fixed list; null past its end."""
    items = ", ".join(sql_text(v) for v in values)
    return F.expr(f"get(array({items}), cast({number} AS INT))")


def keyed_hash(seed: int, key: str) -> Column:
    """Hex digest that orders keys at random but identically on every run."""
    return F.expr(f"md5(concat('{seed}:', cast({key} AS STRING)))")


def hex_to_long(digest: Column, digits: int) -> Column:
    """Leading hex digits (at most 15) as a non-negative bigint."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def weighted_bucket(key: str, seed: int, weights: Mapping[str, float]) -> Column:
    """Allocate a key to a label in proportion to the weights, by hash."""
    draw = f"cast(conv(substring(md5(concat('{seed}:', cast({key} AS STRING))), 1, 8), 16, 10) AS BIGINT)"
    labels = list(weights)
    arms, cumulative = "", 0.0
    for label in labels[:-1]:
        cumulative += weights[label]
        arms += f" WHEN {draw} < {bucket_limit(cumulative)} THEN {sql_text(label)}"
    last = sql_text(labels[-1])
    return F.expr(f"CASE{arms} ELSE {last} END" if arms else last)


def bucket_limit(cumulative: float) -> int:
    """Upper 32-bit hash bound of a cumulative weight."""
    return int(round(cumulative * 2**32))


def resolve(df: DataFrame, names: Iterable[str], default: Column | None = None) -> Column:
    """First column of ``df`` matching any name without regard to case, else the default."""
    present = {column.lower(): column for column in df.columns}
    for name in names:
        if name.lower() in present:
            return F.col(f"`{present[name.lower()]}`")
    return F.lit(None).cast("string") if default is None else default


def lenient_date(df: DataFrame, column: Column) -> Column:
    """Date, or null where the text is not one. Typed columns are only cast."""
    kind = df.select(column.alias("c")).schema["c"].dataType.typeName()
    return F.try_to_date(column) if kind in ("string", "void") else column.cast("date")
