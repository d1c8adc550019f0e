"""What a label's model sees: lags, transforms and estimators. Plain configuration."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, dataclass, field


@dataclass(frozen=True)
class RollingMean:
    """Mean of ``size`` lagged values; null below ``min_samples`` known ones (default: all)."""

    size: int
    min_samples: int | None = None

    @property
    def needed(self) -> int:
        return self.size if self.min_samples is None else self.min_samples


@dataclass(frozen=True)
class ExpandingStd:
    """Sample standard deviation of everything up to the lag."""


@dataclass(frozen=True)
class ExponentialMean:
    """Exponentially weighted mean, ``alpha`` the weight of the newest value."""

    alpha: float


Transform = RollingMean | ExpandingStd | ExponentialMean

# Names of the target transforms.
DIFFERENCE, SCALE = "difference", "local_scale"


@dataclass(frozen=True)
class TreeModel:
    """Boosted trees: ``kind`` names the builder, the rest are its parameters."""

    kind: str
    trees: int = 100
    depth: int = 5
    rate: float = 0.1
    subsample: float = 1.0
    seed: int = 0


@dataclass(frozen=True)
class LinearModel:
    """Least squares with an intercept; ``penalty`` is the weight of the squared coefficients."""

    kind: str = "linear"
    penalty: float = 0.0


@dataclass(frozen=True)
class ModelSpec:
    name: str
    lags: tuple[int, ...]
    lag_transforms: Mapping[int, tuple[Transform, ...]] = field(default_factory=dict)
    target_transforms: tuple[str, ...] = ()
    models: Mapping[str, TreeModel | LinearModel] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.target_transforms not in ((), (DIFFERENCE,), (SCALE,), (DIFFERENCE, SCALE)):
            raise ValueError(
                f"Target transforms {self.target_transforms} are not supported: at most one "
                f"{DIFFERENCE!r}, then at most one {SCALE!r}"
            )

    def lag_features(self) -> dict[str, tuple[int, Transform | None]]:
        """Feature name -> (lag, transform), plain lags first."""
        out: dict[str, tuple[int, Transform | None]] = {f"lag{k}": (k, None) for k in self.lags}
        for lag, transforms in self.lag_transforms.items():
            for t in transforms:
                if isinstance(t, RollingMean):
                    out[f"rolling_mean_lag{lag}_w{t.size}"] = (lag, t)
                elif isinstance(t, ExpandingStd):
                    out[f"expanding_std_lag{lag}"] = (lag, t)
                else:
                    alpha = f"{t.alpha:g}".replace(".", "_")
                    out[f"ewm_lag{lag}_a{alpha}"] = (lag, t)
        return out

    def to_dict(self) -> dict:
        transforms = {
            str(lag): [{"type": type(t).__name__, **asdict(t)} for t in ts]
            for lag, ts in self.lag_transforms.items()
        }
        return {
            "name": self.name,
            "lags": list(self.lags),
            "lag_transforms": transforms,
            "target_transforms": list(self.target_transforms),
            "models": {name: asdict(m) for name, m in self.models.items()},
        }

    @staticmethod
    def from_dict(data: Mapping) -> ModelSpec:
        kinds = {c.__name__: c for c in (RollingMean, ExpandingStd, ExponentialMean)}
        transforms = {
            int(lag): tuple(
                kinds[t["type"]](**{k: v for k, v in t.items() if k != "type"}) for t in ts
            )
            for lag, ts in data["lag_transforms"].items()
        }
        return ModelSpec(
            data["name"],
            tuple(data["lags"]),
            transforms,
            tuple(data["target_transforms"]),
            {
                name: (LinearModel if m["kind"] == "linear" else TreeModel)(**m)
                for name, m in data["models"].items()
            },
        )
