"""Median and adaptive Kalman smoothing.

The recurrence runs over a whole series, but each of its parts can be scanned: the noise level and the estimate are
affine recurrences, the error is a product of 2x2 matrices. A task takes the rows of many series or blocks at once,
lays them out in chunks, reduces every chunk to its effect, applies the effects in order (one step per
chunk) and replays all chunks side by side, so that no Python step sees a single row.

A series that fits into one block is smoothed in one such pass. A longer one is smoothed block by block in the same
way: each block is first reduced to its effect on the carried value, the effects are applied in order (one row
per block), and the blocks are then replayed from their start values.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.params import KalmanParams, SeriesSpec
from barograph.plans.layout import BLOCK, OWN, POS, fill_gaps, split_blocks, spread
from barograph.session import materialize

#: Rows that are scanned together, or one segment if it is longer. A scan needs some dozens of numbers per row in Python,
#: in every task of an executor and twice where one scan feeds another.
ROWS = 1 << 15


@dataclass(frozen=True)
class Chunks:
    """Segments of rows, one behind the other, cut into chunks of ``width`` (the last of a segment is padded)."""

    sizes: np.ndarray
    width: int
    #: Chunks per segment, and the place of each row in the padded layout.
    counts: np.ndarray
    spots: np.ndarray

    @staticmethod
    def of(sizes: np.ndarray) -> Chunks:
        total = int(sizes.sum())
        width = max(1, min(int(sizes.max(initial=1)), int(np.ceil(np.sqrt(total)))))
        counts = -(-sizes // width)
        first = (np.cumsum(counts) - counts) * width
        rows = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return Chunks(sizes, width, counts, np.repeat(first, sizes) + rows)

    def lay(self, values: np.ndarray, pad: float) -> np.ndarray:
        """Values by (place in the chunk, chunk)."""
        out = np.full(int(self.counts.sum()) * self.width, pad)
        out[self.spots] = values
        return np.ascontiguousarray(out.reshape(-1, self.width).T)

    def back(self, laid: np.ndarray) -> np.ndarray:
        return laid.T.reshape(-1)[self.spots]

    def carry(self, step, starts) -> list:
        """The value that each chunk starts from: ``step(chunk, value)`` leads to the next chunk of a segment."""
        out, at = [], 0
        for count, value in zip(self.counts.tolist(), starts, strict=True):
            for i in range(at, at + count):
                out.append(value)
                value = step(i, value)
            at += count
        return out

    def totals(self, step, start) -> list:
        """What ``step`` makes of ``start`` over all chunks of each segment."""
        out, at = [], 0
        for count in self.counts.tolist():
            value = start
            for i in range(at, at + count):
                value = step(i, value)
            out.append(value)
            at += count
        return out


def _effect(a: np.ndarray, b: np.ndarray) -> tuple[list[float], list[float]]:
    """Each chunk's effect on a carried value: x becomes a x + b."""
    scale, shift = np.ones(a.shape[1]), np.zeros(a.shape[1])
    for x, y in zip(a, b, strict=True):
        scale, shift = x * scale, x * shift + y
    return scale.tolist(), shift.tolist()


def affine_scan(chunks: Chunks, a: np.ndarray, b: np.ndarray, starts) -> np.ndarray:
    """y = a y + b over each segment, from its start value."""
    a, b = chunks.lay(a, 1.0), chunks.lay(b, 0.0)
    scale, shift = _effect(a, b)
    y = np.array(chunks.carry(lambda i, x: scale[i] * x + shift[i], starts), float)
    out = np.empty_like(a)
    for i in range(chunks.width):
        y = a[i] * y + b[i]
        out[i] = y
    return chunks.back(out)


def running_medians(x: np.ndarray, place: np.ndarray, rows: int) -> np.ndarray:
    """Median of the last ``rows`` values; ``place`` counts from the start of a segment, where the window grows."""
    last = np.stack([np.where(place >= k, np.roll(x, k), np.nan) for k in range(rows)], axis=1)
    last.sort(axis=1)  # what is missing comes last
    many = np.minimum(place + 1, rows)
    each = np.arange(len(x))
    return (last[each, (many - 1) // 2] + last[each, many // 2]) / 2 if len(x) else x


def trailing_variance(x: np.ndarray, place: np.ndarray, rows: int) -> np.ndarray:
    """Population variance of the last ``rows`` values; the window grows at the start of a segment."""
    many = np.minimum(place + 1, rows).astype(float)
    mean, out = np.zeros(len(x)), np.zeros(len(x))
    for k in range(rows):
        mean += np.where(place >= k, np.roll(x, k), 0.0)
    mean /= np.maximum(many, 1)
    for k in range(rows):
        out += np.where(place >= k, np.roll(x, k) - mean, 0.0) ** 2
    return out / np.maximum(many, 1)


def medians_and_noise(x: np.ndarray, sizes: np.ndarray, firsts: np.ndarray, params: KalmanParams):
    """Running median, and the variance of the last medians once there are enough.

    ``firsts`` are the positions of the first rows of the segments in their series.
    """
    place = np.arange(len(x)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    medians = running_medians(x, place, params.median_window)
    variance = trailing_variance(medians, place, params.history)
    variance[place + np.repeat(firsts, sizes) < params.min_history - 1] = np.nan
    variance[np.isnan(medians)] = np.nan
    return medians, variance


def noise_levels(chunks: Chunks, variance: np.ndarray, starts, params: KalmanParams) -> np.ndarray:
    """Measurement noise after each row; rows without a variance keep the level."""
    known = ~np.isnan(variance)
    learn = params.adaptation_rate
    a = np.where(known, 1.0 - learn, 1.0)
    b = np.where(known, learn * np.maximum(np.where(known, variance, 0.0), params.min_variance), 0.0)
    return affine_scan(chunks, a, b, starts)


def _matrices(chunks: Chunks, levels: np.ndarray, params: KalmanParams) -> list[np.ndarray]:
    """Each chunk's 2x2 matrix (four arrays) of the error update, scaled to stay finite."""
    q, laid = params.process_variance, chunks.lay(levels, np.nan)
    n = laid.shape[1]
    a, b, c, d = np.ones(n), np.zeros(n), np.zeros(n), np.ones(n)
    for level in laid:
        new = level * (a + q * c), level * (b + q * d), a + (q + level) * c, b + (q + level) * d
        top = np.maximum.reduce([np.abs(x) for x in new])
        live = ~np.isnan(level)
        a, b, c, d = (np.where(live, x / top, old) for x, old in zip(new, (a, b, c, d), strict=True))
    return [a, b, c, d]


def gains(chunks: Chunks, levels: np.ndarray, starts, params: KalmanParams) -> np.ndarray:
    """Kalman gain of each row, from the error before each segment; rows without a level change nothing."""
    a, b, c, d = (x.tolist() for x in _matrices(chunks, levels, params))
    error = np.array(chunks.carry(lambda i, e: (a[i] * e + b[i]) / (c[i] * e + d[i]), starts), float)
    laid = chunks.lay(levels, np.nan)
    live, out = ~np.isnan(laid), np.empty_like(laid)
    for i, level in enumerate(laid):
        predicted = error + params.process_variance
        out[i] = np.where(live[i], predicted / (predicted + level), 0.0)
        error = np.where(live[i], (1.0 - out[i]) * predicted, error)
    return chunks.back(out)


def error_matrices(chunks: Chunks, levels: np.ndarray, params: KalmanParams) -> list[tuple[float, float, float, float]]:
    """Each segment's 2x2 matrix of the error update over all its rows."""
    each = list(zip(*(x.tolist() for x in _matrices(chunks, levels, params)), strict=True))

    def step(i: int, m):
        (a, b, c, d), (e, f, g, h) = each[i], m
        out = a * e + b * g, a * f + b * h, c * e + d * g, c * f + d * h
        top = max(map(abs, out))
        return tuple(x / top for x in out)

    return chunks.totals(step, (1.0, 0.0, 0.0, 1.0))


def estimates(chunks: Chunks, medians: np.ndarray, gain: np.ndarray, starts) -> np.ndarray:
    """Smoothed value of each row."""
    return affine_scan(chunks, 1.0 - gain, gain * medians, starts)


def segments(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = ROWS) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(whole segments of sorted rows, their sizes): at least ``rows`` rows at a time, until the last."""

    def cuts(table: pa.Table) -> np.ndarray:
        new = np.zeros(max(len(table) - 1, 0), bool)
        for k in keys:
            column = table.column(k)
            new |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
        return np.flatnonzero(new) + 1

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        # Sorted rows: with the same keys at both ends all of it is one segment, which goes on.
        one = all(held[0].column(k)[0] == batch.column(k)[-1] for k in keys)
        if not one and sum(b.num_rows for b in held) >= rows:
            table = pa.Table.from_batches(held).combine_chunks()
            ends = cuts(table)
            if len(ends):
                yield table.slice(0, ends[-1]), np.diff(ends, prepend=0)
                held = table.slice(ends[-1]).to_batches()
    table = pa.Table.from_batches(held).combine_chunks() if held else None
    if table is not None and len(table):
        yield table, np.diff(np.append(cuts(table), len(table)), prepend=0)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(float)


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _fields(df: DataFrame, names: Iterable[str]) -> str:
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ", ".join(f"`{n}` {types[n]}" for n in names)


def _with_results(table: pa.Table, kept: list[str], results: dict[str, np.ndarray]) -> pa.Table:
    out = table.select(kept)
    for name, values in results.items():
        out = out.append_column(name, pa.array(values, pa.float64(), from_pandas=True))
    return out


#: Column of a frame that goes on from an earlier one: false on rows that were smoothed then.
LIVE = "_live"
#: Per smoothed column, the noise, error and value to go on from; null in a new series.
CARRIED = ("noise0", "error0", "value0")


def _carried(c: str) -> list[str]:
    return [f"_{part}_{c}" for part in CARRIED]


def kalman_smooth(
    df: DataFrame,
    spec: SeriesSpec,
    columns: Iterable[str],
    params: KalmanParams = KalmanParams(),
    suffix: str = "_filt",
    carried: bool = False,
) -> DataFrame:
    """Add the smoothed value of each column; an all-null series stays null.

    With ``carried`` a series goes on from an earlier frame: its rows begin with the last ones of that
    frame, marked by a false ``_live``, which only fill the windows, and the columns ``_noise0_<c>``, ``_error0_<c>`` and
    ``_value0_<c>`` hold what they ended with. The columns ``<c>_filled``, ``<c>_noise`` and ``<c>_error`` are
    added then, for the next frame.
    """
    columns = list(columns)
    work = {c: f"_x_{c}" for c in columns}
    filled = fill_gaps(df.withColumns({x: F.col(c).cast("double") for c, x in work.items()}), spec, work.values())
    halo = params.median_window + params.history - 2
    keys = list(spec.keys) if spec.one_block else [*spec.keys, BLOCK]
    blocks = spread(split_blocks(filled, spec, before=halo), keys)
    kept = [*df.columns]
    if carried:
        blocks = blocks.withColumns({f"{c}_filled": F.col(f"_x_{c}") for c in columns})
        kept += [f"{c}_filled" for c in columns]
    if spec.one_block:
        return _smooth_whole(blocks, spec, columns, params, suffix, kept, carried)
    medians = materialize(_median_rows(blocks, keys, columns, params, kept, carried), "medians")
    return _smooth_blocks(medians, spec, columns, params, suffix, kept, carried)


def _live(table: pa.Table, carried: bool) -> np.ndarray:
    return table.column(LIVE).to_numpy().astype(bool) if carried else np.ones(len(table), bool)


def _first_of(table: pa.Table, name: str, sizes: np.ndarray, otherwise=None) -> list:
    """Values of a column on the first row of each segment, ``otherwise`` where they are null."""
    found = table.column(name).take(pa.array(_starts(sizes))).to_pylist()
    if otherwise is None:
        return found
    other = otherwise if isinstance(otherwise, list) else [otherwise] * len(found)
    return [o if v is None else v for v, o in zip(found, other, strict=True)]


def _sorted_blocks(blocks: DataFrame, keys: list[str]) -> DataFrame:
    return spread(blocks, keys).sortWithinPartitions(*keys, POS)


def _smooth_whole(blocks, spec, columns, params, suffix, kept, carried) -> DataFrame:
    keys = list(spec.keys)

    def smooth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, sizes in segments(batches, keys):
            chunks, results, live = Chunks.of(sizes), {}, _live(table, carried)
            for c in columns:
                medians, variance = medians_and_noise(_column(table, f"_x_{c}"), sizes, np.zeros(len(sizes), int), params)
                starts = [params.measurement_variance, params.estimated_error, medians[_starts(sizes)].tolist()]
                if carried:
                    starts = [_first_of(table, n, sizes, o) for n, o in zip(_carried(c), starts, strict=True)]
                else:
                    starts[:2] = ([x] * len(sizes) for x in starts[:2])
                variance[~live] = np.nan
                levels = noise_levels(chunks, variance, starts[0], params)
                gain = gains(chunks, np.where(live, levels, np.nan), starts[1], params)
                results[f"{c}{suffix}"] = estimates(chunks, medians, gain, starts[2])
                if carried:
                    results[f"{c}_noise"], results[f"{c}_error"] = levels, gain * levels
            yield from _with_results(table, kept, results).to_batches()

    made = [f"{c}{part}" for c in columns for part in ([suffix, "_noise", "_error"] if carried else [suffix])]
    schema = ", ".join([_fields(blocks, kept), *[f"`{name}` double" for name in made]])
    return _sorted_blocks(blocks, keys).mapInArrow(smooth, schema)


def _median_rows(
    blocks: DataFrame, keys: list[str], columns: list[str], params: KalmanParams, kept: list[str], carried: bool
) -> DataFrame:
    """The owned rows of each block with their medians and noise variances."""

    def medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, sizes in segments(batches, keys):
            firsts, results = table.column(POS).to_numpy()[_starts(sizes)], {}
            live = _live(table, carried)
            for c in columns:
                medians, variance = medians_and_noise(_column(table, f"_x_{c}"), sizes, firsts, params)
                results[f"_x_{c}_med"], results[f"_x_{c}_var"] = medians, np.where(live, variance, np.nan)
            rows = _with_results(table, [*kept, BLOCK, OWN], results).filter(table.column(OWN)).drop_columns([OWN])
            yield from rows.to_batches()

    added = [f"`_x_{c}_{part}` double" for c in columns for part in ("med", "var")]
    return _sorted_blocks(blocks, keys).mapInArrow(medians, ", ".join([_fields(blocks, [*kept, BLOCK]), *added]))


def _scan(summaries: DataFrame, spec: SeriesSpec, step, start, values: list[str]) -> DataFrame:
    """Run ``step`` over the block summaries of a series; give each block its start value.

    One row per block, so even the longest series is a small group here.
    """
    schema = f"{_fields(summaries, spec.keys)}, {BLOCK} long, " + ", ".join(f"`{v}` double" for v in values)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(BLOCK)
        state, starts = None, {v: [] for v in values}
        for row in table.to_pylist():
            state = state or {v: start(v, row) for v in values}
            for v in values:
                starts[v].append(state[v])
            state = {v: step(v, row, state[v]) for v in values}
        return _with_results(table, [*spec.keys, BLOCK], {v: np.array(x, float) for v, x in starts.items()})

    return summaries.groupBy(*spec.keys).applyInArrow(run, schema)


def _smooth_blocks(blocks, spec, columns, params, suffix, kept, carried) -> DataFrame:
    keys = [*spec.keys, BLOCK]

    def begin(part: int, otherwise):
        """The start of a series: what its first block carries, or the value of a new series."""

        def of(v: str, row: dict):
            c = v[2:]
            found = row.get(_carried(c)[part]) if carried else None
            return found if found is not None else otherwise(c, row)

        return of

    starts = [F.max(name).alias(name) for c in columns for name in _carried(c)] if carried else []
    keep, learn = 1.0 - params.adaptation_rate, params.adaptation_rate

    # Noise: level_out = keep^k * level_in + sum(learn * keep^(rows left) * variance).
    last = (F.col(BLOCK) + 1) * spec.block_rows - 1
    parts = []
    for c in columns:
        v = F.col(f"_x_{c}_var")
        weight = learn * F.pow(F.lit(keep), last - F.col(POS))
        parts += [
            F.pow(F.lit(keep), F.count(v)).alias(f"a_{c}"),
            # greatest() skips nulls: rows without a variance must not count as the least one.
            F.coalesce(F.sum(F.when(v.isNotNull(), F.greatest(v, F.lit(params.min_variance))) * weight), F.lit(0.0)).alias(
                f"b_{c}"
            ),
        ]
    affine = lambda v, row, x: row[f"a_{v[2:]}"] * x + row[f"b_{v[2:]}"]
    levels = _scan(
        blocks.groupBy(*keys).agg(*parts, *starts),
        spec,
        affine,
        begin(0, lambda c, row: params.measurement_variance),
        [f"r_{c}" for c in columns],
    )

    # Error: a product of 2x2 matrices.
    def error_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, sizes in segments(batches, keys):
            chunks, out, live = Chunks.of(sizes), {}, _live(table, carried)
            for c in columns:
                level = noise_levels(chunks, _column(table, f"_x_{c}_var"), _first_of(table, f"r_{c}", sizes), params)
                found = zip(*error_matrices(chunks, np.where(live, level, np.nan), params), strict=True)
                out.update({f"m{i}_{c}": np.array(x) for i, x in enumerate(found)})
            first = table.take(pa.array(_starts(sizes)))
            yield from _with_results(first, [*keys, *passed], out).to_batches()

    def next_error(v: str, row: dict, p: float) -> float:
        m = [row[f"m{i}_{v[2:]}"] for i in range(4)]
        return (m[0] * p + m[1]) / (m[2] * p + m[3])

    matrix_schema = ", ".join(f"`m{i}_{c}` double" for c in columns for i in range(4))
    passed = [name for c in columns for name in _carried(c)] if carried else []
    noise = blocks.select(*keys, POS, *([LIVE] if carried else []), *passed, *[f"_x_{c}_var" for c in columns])
    parts = _sorted_blocks(noise.join(levels, keys), keys)
    parts = parts.mapInArrow(error_parts, f"{_fields(blocks, [*keys, *passed])}, {matrix_schema}")
    errors = _scan(parts, spec, next_error, begin(1, lambda c, row: params.estimated_error), [f"p_{c}" for c in columns])
    known = levels.join(errors, keys)

    # Estimate: a row's value is affine in the value before its block, with a scale and a shift of its own.
    def value_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, sizes in segments(batches, keys):
            chunks, out, none, live = Chunks.of(sizes), {}, np.zeros(len(table)), _live(table, carried)
            for c in columns:
                level = noise_levels(chunks, _column(table, f"_x_{c}_var"), _first_of(table, f"r_{c}", sizes), params)
                gain = gains(chunks, np.where(live, level, np.nan), _first_of(table, f"p_{c}", sizes), params)
                if carried:
                    out[f"{c}_noise"], out[f"{c}_error"] = level, gain * level
                out[f"_x_{c}_shift"] = estimates(chunks, _column(table, f"_x_{c}_med"), gain, [0.0] * len(sizes))
                out[f"_x_{c}_scale"] = affine_scan(chunks, 1.0 - gain, none, [1.0] * len(sizes))
            medians = [f"_x_{c}_med" for c in columns]
            rows = _with_results(table, [*kept, BLOCK, *medians], {name: out[name] for name in order[1]})
            yield from rows.to_batches()

    traced = [f"{c}_{part}" for c in columns for part in ("noise", "error")] if carried else []
    order = [f"_x_{c}_med" for c in columns], [*traced, *[f"_x_{c}_{part}" for c in columns for part in ("shift", "scale")]]
    made = ", ".join(f"`{name}` double" for part in order for name in part)
    rows = _sorted_blocks(blocks.join(known, keys), keys).mapInArrow(value_parts, f"{_fields(blocks, [*kept, BLOCK])}, {made}")
    rows = materialize(rows, "estimates")
    ends = rows.groupBy(*keys).agg(
        *[F.max_by(f"_x_{c}_scale", POS).alias(f"a_{c}") for c in columns],
        *[F.max_by(f"_x_{c}_shift", POS).alias(f"b_{c}") for c in columns],
        *[F.min_by(f"_x_{c}_med", POS).alias(f"s_{c}") for c in columns],
        *starts,
    )
    values = _scan(
        ends,
        spec,
        lambda v, row, x: affine(v, row, x) if x is not None else None,
        begin(2, lambda c, row: row[f"s_{c}"]),
        [f"x_{c}" for c in columns],
    )
    smoothed = [(F.col(f"_x_{c}_scale") * F.col(f"x_{c}") + F.col(f"_x_{c}_shift")).alias(f"{c}{suffix}") for c in columns]
    return rows.join(values, keys).select(*kept, *smoothed, *traced)
