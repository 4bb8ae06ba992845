"""Parameters of the operators, as frozen dataclasses with the default settings."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Sensor order, and the inclusive bounds a valid reading lies in.
SENSORS = ("ws", "wd", "pressure", "rh", "temp", "dew", "rain")
BOUNDS = {
    "ws": (0.0, 120.0),
    "wd": (0.0, 360.0),
    "pressure": (800.0, 1100.0),
    "rh": (0.0, 100.0),
    "temp": (-40.0, 55.0),
    "dew": (-50.0, 50.0),
    "rain": (0.0, 500.0),
}


@dataclass(frozen=True)
class SeriesSpec:
    """How rows form ordered series, and how long series are cut into blocks.

    ``keys`` name one series, ``order`` sorts it (the last order column breaks
    ties and must be unique within a series). No task ever holds more than
    ``block_rows`` rows of a series plus the halo an operator asks for.
    ``longest`` and ``shortest`` are the row counts seen when the series were
    indexed; ``None`` means unknown. ``blocked`` says that the frame holds blocks with
    a halo already, so operators neither cut nor merge it.
    """

    keys: tuple[str, ...] = ("station", "sensor")
    order: tuple[str, ...] = ("ts", "seq")
    block_rows: int = 262_144
    longest: int | None = None
    shortest: int | None = None
    blocked: bool = False

    @property
    def one_block(self) -> bool:
        """True when every series is known to fit into a single block."""
        return self.longest is not None and self.longest <= self.block_rows

    def sized(self, longest: int, shortest: int) -> SeriesSpec:
        return replace(self, longest=longest, shortest=shortest)


@dataclass(frozen=True)
class KalmanParams:
    median_window: int = 5
    process_variance: float = 0.01
    measurement_variance: float = 0.5
    estimated_error: float = 1.0
    adaptation_rate: float = 0.1
    history: int = 20
    min_history: int = 5
    min_variance: float = 1e-6


@dataclass(frozen=True)
class SeasonalParams:
    period: int = 1440
    model: str = "additive"
    #: The multiplicative model leaves out columns with a reading of zero or less.
    positive_only: bool = True


@dataclass(frozen=True)
class SarimaParams:
    order: tuple[int, int, int] = (0, 1, 1)
    seasonal_order: tuple[int, int, int] = (0, 1, 1)
    season: int = 60
    min_seasons: int = 24
    min_rows: int = 30


@dataclass(frozen=True)
class ForecastParams:
    sarima: SarimaParams = field(default_factory=SarimaParams)
    use_sarima: bool = True
    use_lag_model: bool = True
    primary: str = "temp"
    horizon: int = 6
    lookback: int = 48
    weight_primary: tuple[float, float] = (0.45, 0.55)
    weight_other: tuple[float, float] = (0.15, 0.85)
    error_window: int = 30
    warmup_rows: int = 48
    history_rows: int = 360
    refit_rows: int = 30
    tail_rows: int = 600
    fast_tail_rows: int = 120
    baseline_rows: int = 3
    min_rows: int = 30
    fast: bool = False
    fill: bool = False


@dataclass(frozen=True)
class ForestParams:
    trees: int = 100
    sample_rows: int = 256
    contamination: float = 0.04
    seed: int = 42


@dataclass(frozen=True)
class AnomalyParams:
    forest: ForestParams = field(default_factory=ForestParams)
    z_threshold: float = 3.0
    error_mode: str = "adaptive"
    error_threshold: float = 2.5
    error_k: float = 3.0


@dataclass(frozen=True)
class DriftParams:
    p_threshold: float = 0.05
    baseline_rows: int = 120
    comparison_rows: int = 60
    min_rows: int = 50
    min_sample: int = 10
    #: "exact" or "asymptotic": how the p-value is computed, for samples of any size.
    method: str = "exact"


@dataclass(frozen=True)
class RunParams:
    """Settings of a whole station run."""

    sensors: tuple[str, ...] = SENSORS
    bounds: dict[str, tuple[float, float]] = field(default_factory=lambda: dict(BOUNDS))
    rolling_window: int = 6
    drop: str = "any"
    kalman: KalmanParams = field(default_factory=KalmanParams)
    seasonal: SeasonalParams = field(default_factory=SeasonalParams)
    forecast: ForecastParams = field(default_factory=ForecastParams)
    anomaly: AnomalyParams = field(default_factory=AnomalyParams)
    drift: DriftParams = field(default_factory=DriftParams)
    min_anomalies: int = 1
    block_rows: int = 262_144

    @property
    def primary(self) -> str:
        """The sensor whose forecast error is scored: the configured one, else the first."""
        wanted = self.forecast.primary.strip().lower()
        return wanted if wanted in self.sensors else self.sensors[0]
