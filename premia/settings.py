"""Settings are plain frozen dataclasses that callers pass explicitly."""

from __future__ import annotations

from dataclasses import dataclass, field

# They define what the queries mean, so they are stated as plain data.
DRIVER_AGE_BINS = (18.0, 25.0, 30.0, 40.0, 50.0, 60.0, 70.0, 100.0)
VEHICLE_AGE_BINS = (0.0, 1.0, 3.0, 5.0, 10.0, 20.0, 100.0)
VEHICLE_POWER_BINS = (0.0, 4.0, 6.0, 8.0, 10.0, 15.0)
AREA_LEVELS = ("A", "B", "C", "D", "E", "F")
FUEL_LEVELS = ("Regular", "Diesel")
ALPHA_GRID = (0.0001, 0.001, 0.01, 0.1, 1.0)
POWER_GRID = (1.1, 1.2, 1.3, 1.4, 1.5, 1.6, 1.7, 1.8, 1.9)
LATENCY_BUCKETS_MS = (5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0, 1000.0)

NUMERIC_FEATURES = ("driv_age", "veh_age", "veh_power", "bonus_malus", "log_density")
CATEGORICAL_FEATURES = (
    "area",
    "veh_brand",
    "veh_gas",
    "region",
    "veh_power_band",
    "driv_age_band",
    "veh_age_band",
)
USE_CASES = ("frequency", "severity", "pure_premium")


@dataclass(frozen=True)
class Cleaning:
    exposure_cap: float = 1.0
    claim_cap: int = 4
    large_loss_threshold: float = 50_000.0
    large_loss_quantile: float = 0.995
    large_loss_method: str = "fixed"
    min_claim_amount: float = 1.0


@dataclass(frozen=True)
class Splitting:
    seed: int = 42
    test_share: float = 0.2
    val_share: float = 0.2
    n_seeds: int = 5

    def seeds(self) -> list[int]:
        return [self.seed + i for i in range(self.n_seeds)]


@dataclass(frozen=True)
class Features:
    driver_age_bins: tuple[float, ...] = DRIVER_AGE_BINS
    vehicle_age_bins: tuple[float, ...] = VEHICLE_AGE_BINS
    vehicle_power_bins: tuple[float, ...] = VEHICLE_POWER_BINS
    area_levels: tuple[str, ...] = AREA_LEVELS
    fuel_levels: tuple[str, ...] = FUEL_LEVELS
    spline_knots: int = 5
    interactions: bool = False


@dataclass(frozen=True)
class Modelling:
    poisson_alphas: tuple[float, ...] = ALPHA_GRID
    gamma_alphas: tuple[float, ...] = ALPHA_GRID
    tweedie_powers: tuple[float, ...] = POWER_GRID
    tweedie_alpha: float = 1.0
    folds: int = 5
    max_iter: int = 1000
    parallel_fits: int = 8
    offset_summary: bool = False


@dataclass(frozen=True)
class Boosting:
    trials: int = 50
    timeout_s: float | None = None
    tweedie_power: float = 1.5
    leaves: tuple[int, int] = (7, 255)
    min_child_rows: tuple[int, int] = (5, 200)
    learning_rate: tuple[float, float] = (0.01, 0.3)
    trees: tuple[int, int] = (50, 600)
    ridge: tuple[float, float] = (1e-4, 10.0)
    feature_share: tuple[float, float] = (0.5, 1.0)
    row_share: tuple[float, float] = (0.5, 1.0)
    depth: int | None = None
    bins: int = 255
    parallel_trials: int = 4


@dataclass(frozen=True)
class Monitoring:
    bins: int = 10
    watch: float = 0.1
    alert: float = 0.25
    epsilon: float = 1e-4


@dataclass(frozen=True)
class Pricing:
    expense_load: float = 0.15
    profit_load: float = 0.05
    currency: str = "EUR"
    max_quote_exposure: float = 1.5
    reason_codes: int = 3
    latency_buckets_ms: tuple[float, ...] = LATENCY_BUCKETS_MS
    frequency_model: str = "motor_frequency"
    severity_model: str = "motor_severity"


@dataclass(frozen=True)
class Settings:
    cleaning: Cleaning = field(default_factory=Cleaning)
    splitting: Splitting = field(default_factory=Splitting)
    features: Features = field(default_factory=Features)
    modelling: Modelling = field(default_factory=Modelling)
    boosting: Boosting = field(default_factory=Boosting)
    monitoring: Monitoring = field(default_factory=Monitoring)
    pricing: Pricing = field(default_factory=Pricing)
