"""Model-ready features: category codes, median fill, feature matrix."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from creascope.functions.cleaning import category_text
from creascope.functions.columns import (
    CATEGORICAL_FEATURES, filled_number, select_tabular_features, select_vision_features,
)
from creascope.operators.linking import attach_vision
from creascope.session import stash


def fit_encoders(df: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """Dictionary (column, value, code): codes count up from 0 in sorted order of the values.

    One scan covers all columns, and values are made distinct per task before they move. The
    distinct values are dealt to ranges of about equal size and stored; a code is the position in
    the range plus the values of the ranges before, so no task orders a whole column.
    """
    present = [name for name in columns if name in df.columns]
    texts = df.select([category_text(F.col(name)).alias(name) for name in present])
    values = texts.unpivot([], present, "column", "value").distinct()
    # stored, as the ranges are drawn from a sample and a second run may deal them otherwise
    dealt = stash(values.repartitionByRange("column", "value").withColumn("part", F.spark_partition_id()), "values")
    place = F.row_number().over(Window.partitionBy("column", "part").orderBy("value"))
    sizes = dealt.groupBy("column", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("column", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # one row per column and range
    return dealt.withColumn("place", place).join(F.broadcast(before), ["column", "part"]).select(
        "column", "value", (F.col("before") + F.col("place") - 1).cast("int").alias("code"))


def apply_encoders(
    df: DataFrame,
    encoders: DataFrame,
    columns: Sequence[str] = CATEGORICAL_FEATURES,
    unseen: str | None = "unknown",
) -> DataFrame:
    """Add ``<column>_enc`` codes.

    A value without a code is read as ``unknown``: its code if there is one, otherwise the
    next free code. ``unseen="zero"`` uses 0 instead of the next free code, ``unseen=None``
    states that every value is in the dictionary. A column the frame lacks is added as the
    text ``unknown`` without a code; a column without a dictionary gets code 0.

    Pass a stored dictionary: its size is then known before the join is planned, so a small
    one is broadcast and the rows are not shuffled by a possibly very frequent category.
    """
    for name in columns:
        if name not in df.columns:
            df = df.withColumn(name, F.lit("unknown"))
            continue
        dictionary = encoders.filter(F.col("column") == name)
        codes = dictionary.select(F.col("value").alias(name), F.col("code").alias(f"{name}_enc"))
        df = df.withColumn(name, category_text(F.col(name))).join(codes, name, "left")
        if unseen is None:
            continue
        summary = dictionary.agg(F.struct(
            F.count("*").cast("int").alias("size"),
            F.max(F.when(F.col("value") == "unknown", F.col("code"))).alias("unknown"),
        )).scalar()
        spare = summary.getField("size") if unseen == "unknown" else F.lit(0)
        code, known = F.col(f"{name}_enc"), summary.getField("size") > 0
        df = df.withColumns({
            name: F.when(code.isNull() & known, "unknown").otherwise(F.col(name)),
            f"{name}_enc": F.coalesce(code, summary.getField("unknown"), spare),
        })
    return df


class _Search:
    """The open interval (low, high) of one column that holds its middle ranks; None is unbounded."""

    def __init__(self):
        self.low = self.high = None
        self.ranks: tuple[int, ...] = ()
        self.found: dict[int, float] = {}
        self.bound = None  # most rows the interval can hold, where that is known

    def sql(self, name: str) -> tuple[str, str, str, str]:
        """Value inside the interval (else NULL), counts below it, at its low and at its high end."""
        x = f"nullif(try_cast(`{name}` as double), double('NaN'))"
        low, high = (None if end is None else f"double('{end!r}')" for end in (self.low, self.high))
        inside = " and ".join([f"{x} > {low}"] * (low is not None) + [f"{x} < {high}"] * (high is not None))
        return (f"case when {inside} then {x} end" if inside else x, f"count_if({x} < {low})" if low else "0",
                f"count_if({x} = {low})" if low else "0", f"count_if({x} = {high})" if high else "0")

    def narrow(self, cuts: Sequence[float], rows: int, before: int, error: float) -> None:
        """Shrink to the splitters around the ranks; ``rows`` lie inside, ``before`` below."""
        parts = len(cuts) - 1
        first = math.floor(((min(self.ranks) - before - 1) / rows - error) * parts)
        last = math.ceil(((max(self.ranks) - before) / rows + error) * parts)
        self.low = cuts[first] if first > 0 else self.low
        self.high = cuts[last] if last < parts else self.high
        self.bound = rows * ((min(last, parts) - max(first, 0)) / parts + 2 * error) + 2

    def settle(self, before: int, at_low: int, rows: int, at_high: int, held: Sequence[float] | None) -> bool:
        """Read off the ranks that are known now; False if the interval missed one."""
        left = []
        for rank in self.ranks:
            place = rank - before
            if place < 1 or place > at_low + rows + at_high:
                return False
            if place <= at_low:
                self.found[rank] = self.low
            elif place > at_low + rows:
                self.found[rank] = self.high
            elif held is not None:
                self.found[rank] = held[place - at_low - 1]
            else:
                left.append(rank)
        self.ranks = tuple(left)
        return True


def column_medians(
    df: DataFrame, columns: Sequence[str], approx: bool = False,
    accuracy: int = 10_000, buckets: int = 50, hold: int = 10_000,
) -> DataFrame:
    """Median per numeric column as (feature, median); columns without a value are absent.

    Exact selection, all columns in the same scans and no row multiplied: a scan takes ``buckets``
    equal-count splitters inside each column's interval and counts what lies below it, at its two
    ends and inside. The interval shrinks to the splitters around the middle ranks until at most
    ``hold`` values can lie in it, which are then ordered. A value that fills an interval's end is
    only counted, however often it occurs. Two scans do up to about ``hold`` * ``buckets`` / 4 rows;
    each further one handles as many times more. Splitters are quantiles with a guaranteed error;
    the counts check them, and a scan that gained nothing is repeated with finer ones.
    """
    if approx:
        row = df.selectExpr(*[f"percentile_approx({_Search().sql(n)[0]}, 0.5, {accuracy}) as m{i}"
                              for i, n in enumerate(columns)]).first()
        return _median_rows(df, {n: row[f"m{i}"] for i, n in enumerate(columns)})
    hold = max(hold, 2)  # the two middle ranks
    searches = {name: _Search() for name in columns}
    open_columns, first = list(columns), True
    while open_columns:
        shares = ", ".join(f"{j / buckets}D" for j in range(buckets + 1))
        aggregates = []
        for i, name in enumerate(open_columns):
            search = searches[name]
            inner, below, at_low, at_high = search.sql(name)
            gather = search.bound is not None and search.bound <= hold
            aggregates += [
                f"count({inner}) as n{i}", f"{below} as b{i}", f"{at_low} as l{i}", f"{at_high} as h{i}",
                f"sort_array(collect_list({inner})) as v{i}" if gather
                else f"percentile_approx({inner}, array({shares}), {accuracy}) as q{i}"]
        row = df.selectExpr(*aggregates).first().asDict()
        for i, name in enumerate(list(open_columns)):
            search, rows = searches[name], row[f"n{i}"]
            if first:
                if not rows:
                    open_columns.remove(name)
                    continue
                search.ranks = ((rows + 1) // 2, rows // 2 + 1) if rows % 2 == 0 else ((rows + 1) // 2,)
            counts = row[f"b{i}"], row[f"l{i}"], rows, row[f"h{i}"]
            if not first and not search.settle(*counts, row.get(f"v{i}")):
                search.low = search.high = search.bound = None
            elif search.ranks:
                if rows <= hold:
                    search.bound = rows
                else:
                    search.narrow(row[f"q{i}"], rows, row[f"b{i}"] + row[f"l{i}"], 2.0 / accuracy)
            else:
                open_columns.remove(name)
        first = False
        accuracy, buckets = min(2 * accuracy, 1 << 20), min(2 * buckets, 2000)
    return _median_rows(df, {
        name: sum(search.found.values()) / len(search.found) if search.found else None for name, search in searches.items()})


def _median_rows(df: DataFrame, medians: Mapping[str, float | None]) -> DataFrame:
    rows = [(name, value) for name, value in medians.items() if value is not None]
    return df.sparkSession.createDataFrame(rows, "feature string, median double")


def median_fills(df: DataFrame, columns: Sequence[str], approx: bool = False) -> dict[str, float]:
    """Fill value per column, 0.0 where a column has no value. At most one row per column is read."""
    rows = column_medians(df, columns, approx).collect()
    return {name: 0.0 for name in columns} | {row["feature"]: float(row["median"]) for row in rows}


def fill_numbers(df: DataFrame, columns: Sequence[str], fills: Mapping[str, float]) -> DataFrame:
    return df.withColumns({name: filled_number(name, fills.get(name, 0.0)) for name in columns})


def feature_matrix(
    linked: DataFrame,
    vision: DataFrame | None = None,
    encoders: DataFrame | None = None,
    fills: Mapping[str, float] | None = None,
    approx: bool = False,
    vision_order: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame, dict[str, float]]:
    """Linked rows with image features, category codes and filled numbers.

    Without ``encoders`` the codes and the median fill values are fitted on these rows.
    With them, missing numbers are filled from ``fills`` or with 0.0.
    """
    base = linked if vision is None else attach_vision(linked, vision, vision_order)
    fitting = encoders is None
    if fitting:
        base = stash(base, "linked")  # fitting scans it several times
        encoders = stash(fit_encoders(base), "encoders")
    encoded = apply_encoders(base, encoders, unseen=None if fitting else "unknown")
    numeric = select_tabular_features(encoded) + select_vision_features(encoded)
    raw = [name for name in numeric if name in base.columns]
    if fitting:
        fills = median_fills(base, raw, approx)
    fills = dict(fills or {})
    return fill_numbers(encoded, raw, fills), encoders, fills
