"""Model specification per demand label."""

from __future__ import annotations

from demandpanel.functions.spec import (
    DIFFERENCE, SCALE, ExpandingStd, ExponentialMean, ModelSpec, RollingMean, TreeModel,
)

# Lags, transforms, trees, depth, rate and subsample per label.
POLICIES: dict[str, ModelSpec] = {
    "Smooth": ModelSpec(
        name="smooth_lgbm_xgb",
        lags=(1, 4),
        lag_transforms={1: (RollingMean(3),), 4: (RollingMean(6),)},
        target_transforms=(DIFFERENCE,),
        models={
            "lgbm": TreeModel("lgbm", trees=1000, seed=0),
            "xgb": TreeModel("xgb", trees=500, depth=6, rate=0.3),
        },
    ),
    "Intermittent": ModelSpec(
        name="intermittent_xgb",
        lags=(1, 3, 6, 12),
        lag_transforms={1: (ExpandingStd(),), 12: (RollingMean(12, min_samples=1),)},
        target_transforms=(DIFFERENCE,),
        models={"xgb": TreeModel("xgb", trees=300, depth=6, rate=0.3, subsample=0.8)},
    ),
    "Erratic": ModelSpec(
        name="erratic_xgb",
        lags=(1, 2, 3),
        lag_transforms={
            1: (ExpandingStd(),),
            2: (RollingMean(3, min_samples=1),),
            3: (ExponentialMean(0.5),),
        },
        target_transforms=(SCALE,),
        models={"xgb": TreeModel("xgb", trees=500, depth=6, rate=0.3)},
    ),
    "Lumpy": ModelSpec(
        name="lumpy_lgbm",
        lags=(1, 2, 3),
        lag_transforms={
            1: (ExpandingStd(),),
            2: (RollingMean(6, min_samples=1), RollingMean(12, min_samples=1)),
            3: (ExponentialMean(0.3),),
        },
        target_transforms=(DIFFERENCE, SCALE),
        models={"lgbm": TreeModel("lgbm", trees=1000, rate=0.01)},
    ),
}


def spec_for(label: str) -> ModelSpec:
    if label not in POLICIES:
        raise ValueError(f"No model specification for label {label!r}; known: {sorted(POLICIES)}")
    return POLICIES[label]
