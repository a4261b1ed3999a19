"""Every tunable of the library, as plain dataclasses."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace

from panelkit.errors import PanelError

# Logical names of the tracker metrics, in panel column order.
TRACKER_METRICS = (
    "median_sale_price",
    "homes_sold",
    "inventory",
    "new_listings",
    "median_dom",
    "avg_sale_to_list",
    "sold_above_list",
    "price_drops",
)

# Columns of the feature table that are never model inputs.
NON_FEATURES = ("zip", "month", "target", "target_outlier", "low_volume", "split")

# Lower and upper quantile column of each selectable band.
BANDS = {80: ("p10", "p90"), 90: ("p05", "p95")}


@dataclass(frozen=True)
class PanelParams:
    """Parameters of the panel, the features, the label and the splits."""

    property_type: str = "All Residential"
    metros: tuple[str, ...] = ()
    low_volume_threshold: int = 10
    target_outlier_threshold: float = 0.50
    join_coverage_min: float = 0.50
    label_horizon_months: int = 3
    holdout_months: int = 6
    holdout_gap: int = 0
    cv_gap_months: int = 3
    train_window_months: int = 36
    momentum_lags: tuple[int, ...] = (1, 3, 6, 12)
    macro_series: tuple[str, ...] = ("MORTGAGE30US", "UNRATE", "CPIAUCSL", "HOUST")
    macro_deltas: dict[str, str] = field(
        default_factory=lambda: {
            "MORTGAGE30US": "mortgage_delta_3m",
            "UNRATE": "unrate_delta_3m",
        }
    )


@dataclass(frozen=True)
class ModelParams:
    """Parameters of training, bands, decisions and monitoring."""

    seed: int = 42
    quantiles: tuple[float, ...] = (0.05, 0.10, 0.50, 0.90, 0.95)
    folds: int = 5
    grid: dict[str, tuple] = field(
        default_factory=lambda: {
            "maxDepth": (3, 5, 7),
            "maxIter": (200, 400),
            "stepSize": (0.03, 0.1),
        }
    )
    forest: dict[str, float] = field(
        default_factory=lambda: {
            "numTrees": 120,
            "maxDepth": 12,
            "minInstancesPerNode": 100,
            "subsamplingRate": 0.4,
        }
    )
    boosted: dict[str, float] = field(
        default_factory=lambda: {"maxIter": 400, "maxDepth": 6, "stepSize": 0.05}
    )
    leafwise: dict[str, float] = field(
        default_factory=lambda: {"maxIter": 400, "maxLeaves": 63, "maxDepth": 12, "stepSize": 0.05, "minInstancesPerNode": 20, "l2": 0.0}
    )
    band_trees: int = 200
    band_least: int = 20
    ridge_alpha: float = 1.0
    selection_metric: str = "rank_corr"
    exclude_flags: tuple[str, ...] = ("low_volume", "target_outlier")
    top_k: int = 10
    importance_sample: int = 8000
    scenario_features: tuple[str, ...] = ("MORTGAGE30US", "mortgage_delta_3m")
    risk_lambda: float = 1.0
    min_roi: float = 0.0
    max_downside: float = 0.05
    degradation_multiplier: float = 2.0
    risk_tolerance: dict[str, float] = field(
        default_factory=lambda: {"Low": 0.50, "Moderate": 0.25, "High": 0.10}
    )
    rate_feature: str = "MORTGAGE30US"
    rate_scenarios_bps: tuple[int, ...] = (-50, -25, 0, 25, 50, 100)
    color_domain: tuple[float, float] = (-0.05, 0.05)


@dataclass(frozen=True)
class Controls:
    """One set of user choices, in the units a user thinks in."""

    metros: tuple[str, ...] = ()
    min_roi: float = 0.0
    max_downside: float = 0.05
    ci_level: int = 80
    risk_tolerance: str = "Moderate"
    rate_bps: int = 0
    budget: float = 1_000_000.0
    exclude_zips: tuple[str, ...] = ()

    def with_exclusions(self, keys) -> "Controls":
        return replace(self, exclude_zips=tuple(keys))


def from_mapping(cls, values: dict):
    """Build a parameter dataclass from a mapping, rejecting unknown names."""
    known = {f.name for f in fields(cls)}
    unknown = sorted(set(values) - known)
    if unknown:
        raise PanelError(f"unknown {cls.__name__} setting(s): {unknown}; known: {sorted(known)}")
    return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})


def band_columns(ci_level: int) -> tuple[str, str]:
    """(lower, upper) quantile column of a band; other levels raise."""
    if ci_level not in BANDS:
        raise PanelError(f"ci_level must be one of {sorted(BANDS)}, got {ci_level}")
    return BANDS[ci_level]
