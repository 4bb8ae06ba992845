"""Seasonal decomposition into trend, seasonal and residual parts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barograph.functions.columns import capped_period
from barograph.params import SeasonalParams, SeriesSpec
from barograph.plans.layout import (
    BLOCK,
    OWN,
    POS,
    attach,
    block_window,
    fill_gaps,
    join_series,
    merge_blocks,
    split_blocks,
)
from barograph.session import materialize

TREND, SEASONAL, RESIDUAL = "_trend", "_seasonal", "_residual"


def _plan_columns(columns: list[str], params: SeasonalParams) -> dict[str, Column]:
    """``period``, ``half`` and the ``_ok_`` flags, from row and value counts."""
    period = capped_period(params.period, "n")
    out = {"period": period, "half": F.floor(period / 2)}
    for c in columns:
        enough = F.col(f"_k_{c}") >= 2 * period
        positive = params.model == "multiplicative" and params.positive_only
        out[f"_ok_{c}"] = enough & (F.col(f"_m_{c}") > 0) if positive else enough
    return out


def season_plan(df: DataFrame, spec: SeriesSpec, columns: Iterable[str], params: SeasonalParams) -> DataFrame:
    """Per series: rows ``n``, capped ``period``, ``half``, and which columns qualify.

    A column qualifies with two full periods of readings and, for the
    multiplicative model, only positive ones (unless ``positive_only`` is off).
    """
    columns = list(columns)
    counts = df.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("n"), *_value_counts(columns))
    plan = _plan_columns(columns, params)
    return counts.withColumns(plan).select(*spec.keys, "n", *plan)


def _value_counts(columns: list[str]) -> list[Column]:
    return [e for c in columns for e in (F.count(c).alias(f"_k_{c}"), F.min(c).alias(f"_m_{c}"))]


def _planned(df: DataFrame, spec: SeriesSpec, columns: list[str], params: SeasonalParams) -> DataFrame:
    """Filled rows with the plan columns; a window where the series is known to be short."""
    filled = fill_gaps(df, spec, columns)
    if not spec.one_block:
        return attach(filled, season_plan(df, spec, columns, params), spec)
    whole = Window.partitionBy(*spec.keys)
    raw = {f"_r_{c}": F.col(c) for c in columns}
    counted = fill_gaps(df.withColumns(raw), spec, columns).withColumns(
        {"n": F.count(F.lit(1)).over(whole)}
        | {f"_k_{c}": F.count(f"_r_{c}").over(whole) for c in columns}
        | {f"_m_{c}": F.min(f"_r_{c}").over(whole) for c in columns}
    )
    helpers = [*raw, *[f"_{part}_{c}" for part in "km" for c in columns]]
    return counted.withColumns(_plan_columns(columns, params)).drop(*helpers)


def _long_trend(df: DataFrame, spec: SeriesSpec, columns: list[str], period: int) -> DataFrame:
    """Centred mean of one known period: constant work per row.

    Rows are cut into chunks as long as the inner window, which so spans two chunks at most: the sums from its
    first row to the end of that chunk and from the start of the next chunk to its last row. Nothing is
    subtracted, so a value that is infinite or very large is felt by its own windows only.
    """
    half, even = period // 2, period % 2 == 0
    reach = half - 1 if even else half
    size = 2 * reach + 1
    blocks = split_blocks(df, spec, before=half, after=half).withColumn("_chunk", F.expr(f"{POS} div {size}"))
    w, chunk = block_window(spec), Window.partitionBy(*spec.keys, BLOCK, "_chunk")
    so_far, to_come = (chunk.orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in (POS, F.desc(POS)))
    blocks = blocks.withColumns({f"_s_{c}": F.sum(c).over(so_far) for c in columns})
    blocks = blocks.withColumns({f"_e_{c}": F.sum(c).over(to_come) for c in columns})
    trends = {}
    for c in columns:
        upper, lower = F.lead(f"_s_{c}", reach).over(w), F.lag(f"_e_{c}", reach).over(w)
        inside = F.when((F.col(POS) - reach) % size == 0, upper).otherwise(lower + upper)
        if even:
            inside = inside + (F.lag(c, half).over(w) + F.lead(c, half).over(w)) / 2
        edge = (F.col(POS) < half) | (F.col(POS) >= F.col("n") - half)
        trends[f"{c}{TREND}"] = F.when(~edge & F.col(f"_ok_{c}"), inside / period)
    helpers = [f"_{part}_{c}" for part in "se" for c in columns]
    return merge_blocks(blocks.withColumns(trends), spec).drop("_chunk", *helpers)


def _short_trend(df: DataFrame, spec: SeriesSpec, columns: list[str]) -> DataFrame:
    """Centred mean where each short series has its own period.

    Ordering by ``pos / (half + 1/2)`` makes the range -1..1 reach exactly ``half``
    rows to each side, whatever the half of the series is. Such series have fewer
    than three requested periods of rows, so a whole-series window is bounded.
    """
    near = Window.partitionBy(*spec.keys).orderBy(F.col(POS) / (F.col("half") + 0.5)).rangeBetween(-1, 1)
    inner = Window.partitionBy(*spec.keys).orderBy(F.col(POS) / (F.col("half") - 0.5)).rangeBetween(-1, 1)
    even = F.col("period") % 2 == 0
    trends = {}
    for c in columns:
        wide, narrow = F.sum(c).over(near), F.sum(c).over(inner)
        mean = F.when(even, (wide + narrow) / 2).otherwise(wide) / F.col("period")
        edge = (F.col(POS) < F.col("half")) | (F.col(POS) >= F.col("n") - F.col("half"))
        trends[f"{c}{TREND}"] = F.when(~edge & F.col(f"_ok_{c}"), mean)
    return df.withColumns(trends)


def centered_trend(
    df: DataFrame, spec: SeriesSpec, columns: Iterable[str], params: SeasonalParams = SeasonalParams()
) -> DataFrame:
    """Centred moving mean over one period; null on the first and last half period.

    Adds the plan columns of :func:`season_plan` as well.
    """
    columns = list(columns)
    filled = _planned(df, spec, columns, params)
    wanted = max(2, int(params.period))
    if spec.shortest is not None and spec.shortest >= max(8, 3 * wanted):
        return _long_trend(filled, spec, columns, wanted)
    if spec.longest is not None and spec.longest < 3 * wanted:
        return _short_trend(filled, spec, columns)
    is_long = F.col("n") >= max(8, 3 * wanted)
    long_part = _long_trend(filled.filter(is_long), spec, columns, wanted)
    return long_part.unionByName(_short_trend(filled.filter(~is_long), spec, columns))


class _Line:
    """Least-squares line over the chosen rows; one single row gives the shortest solution."""

    def __init__(self, part: str, y: Column, x: Column, inside: Column):
        chosen = inside & y.isNotNull()
        self.part, self.y, self.x = part, F.when(chosen, y), F.when(chosen, x.cast("double"))

    def _value(self, over) -> Column:
        one_y, one_x = over(F.max(self.y)), over(F.max(self.x))
        many = over((F.regr_slope if self.part == "slope" else F.regr_intercept)(self.y, self.x))
        alone = one_y * (one_x if self.part == "slope" else F.lit(1.0)) / (one_x * one_x + 1)
        return F.when(over(F.count(self.y)) == 1, alone).otherwise(many)

    def aggregate(self) -> Column:
        return self._value(lambda e: e)

    def over(self, w: WindowSpec) -> Column:
        return self._value(lambda e: e.over(w))


def extend_trend(trended: DataFrame, spec: SeriesSpec, columns: Iterable[str]) -> DataFrame:
    """Fill the trend edges with straight lines through the nearest trend rows.

    The lines are aggregates over at most one period of rows per end.
    """
    columns = list(columns)
    pos, half, period, n = (F.col(c) for c in (POS, "half", "period", "n"))
    back = n - 1 - half
    front_rows = (pos >= half) & (pos < F.least(half + period, back))
    back_rows = (pos >= F.greatest(half, back - period)) & (pos < back)
    lines = {}
    for c in columns:
        for end, rows in (("front", front_rows), ("back", back_rows)):
            for part in ("slope", "start"):
                lines[f"_{end}_{c}_{part}"] = _Line(part, F.col(f"{c}{TREND}"), pos, rows)
    if spec.one_block:
        joined = trended.withColumns({name: line.over(Window.partitionBy(*spec.keys)) for name, line in lines.items()})
    else:
        named = [line.aggregate().alias(name) for name, line in lines.items()]
        fitted = trended.filter(front_rows | back_rows).groupBy(*spec.keys).agg(F.max("n").alias("_n"), *named)
        joined = join_series(split_blocks(trended, spec), fitted, spec, rows="_n", how="left")
    extended = {}
    for c in columns:
        at = lambda end, c=c: F.col(f"_{end}_{c}_slope") * pos + F.col(f"_{end}_{c}_start")
        extended[f"{c}{TREND}"] = (
            F.when(~F.col(f"_ok_{c}"), None)
            .when(pos < half, at("front"))
            .when(pos > back, at("back"))
            .otherwise(F.col(f"{c}{TREND}"))
        )
    return joined.withColumns(extended).drop(BLOCK, OWN, "_n", *lines)


def _share(a: Column, b: Column) -> Column:
    """``a / b``; infinite or NaN where b is zero, as for floating-point numbers."""
    return F.when(b == 0, a * F.lit(float("inf"))).otherwise(a / b)


def _centred(mean: Column, overall: Column, ratio: bool) -> Column:
    return _share(mean, overall) if ratio else mean - overall


def _phase_windows(df: DataFrame, spec: SeriesSpec, detrended: dict[str, Column], ratio: bool) -> DataFrame:
    """Seasonal columns of short series; all windows share the partitioning by series."""
    phases, whole = Window.partitionBy(*spec.keys, "_phase"), Window.partitionBy(*spec.keys)
    means = df.withColumns({f"_p_{y}": F.avg(d).over(phases) for y, d in detrended.items()})
    once = F.col(POS) < F.col("period")
    overall = {y: F.avg(F.when(once, F.col(f"_p_{y}"))).over(whole) for y in detrended}
    return means.withColumns({f"{y}{SEASONAL}": _centred(F.col(f"_p_{y}"), overall[y], ratio) for y in detrended})


def _phase_joins(df: DataFrame, spec: SeriesSpec, detrended: dict[str, Column], ratio: bool) -> DataFrame:
    """Seasonal columns of long series: phase means are aggregated and joined back per block."""
    whole = Window.partitionBy(*spec.keys)
    means = df.groupBy(*spec.keys, "_phase").agg(
        F.max("n").alias("_n"), *[F.avg(d).alias(f"_p_{y}") for y, d in detrended.items()]
    )
    # At most ``period`` rows per series.
    overall = {y: F.avg(f"_p_{y}").over(whole) for y in detrended}
    centred = [_centred(F.col(f"_p_{y}"), overall[y], ratio).alias(f"{y}{SEASONAL}") for y in detrended]
    count = F.expr(f"(_n - 1) div {spec.block_rows}")
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), count)).alias(BLOCK)
    means = means.select(*spec.keys, "_phase", "_n", *centred).select("*", blocks).drop("_n")
    return split_blocks(df, spec).join(means, [*spec.keys, BLOCK, "_phase"])


def seasonal_parts(
    df: DataFrame,
    spec: SeriesSpec,
    columns: Iterable[str],
    params: SeasonalParams = SeasonalParams(),
    names: Iterable[str] | None = None,
) -> DataFrame:
    """Add trend, seasonal and residual of each column, computed on the filled values.

    ``names`` gives the output prefixes. Columns that do not qualify get nulls. Phase means are a partial aggregate on
    (series, phase) and are joined back per block.
    """
    columns = list(columns)
    names = dict(zip(columns, names or columns))
    work = {c: f"_y_{c}" for c in columns}
    ys = list(work.values())
    inputs = df.withColumns({y: F.col(c).cast("double") for c, y in work.items()})
    trended = centered_trend(inputs, spec, ys, params)
    if not spec.one_block:
        trended = materialize(trended, "trend")
    extended = extend_trend(trended, spec, ys)
    ratio = params.model == "multiplicative"
    phase = F.col(POS) % F.col("period")
    detrended = {y: _share(F.col(y), F.col(f"{y}{TREND}")) if ratio else (F.col(y) - F.col(f"{y}{TREND}")) for y in ys}
    joined = (_phase_windows if spec.one_block else _phase_joins)(
        extended.withColumn("_phase", phase), spec, detrended, ratio
    )
    out = {}
    for c, y in work.items():
        value, trend, season = F.col(y), F.col(f"{y}{TREND}"), F.col(f"{y}{SEASONAL}")
        name = names[c]
        out[f"{name}{TREND}"], out[f"{name}{SEASONAL}"] = trend, season
        out[f"{name}{RESIDUAL}"] = _share(_share(value, season), trend) if ratio else value - trend - season
    return joined.select(*df.columns, *[e.alias(name) for name, e in out.items()])
