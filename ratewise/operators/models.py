"""The booster settings of the two models, and fitting and prediction with them.

Missing values need no treatment: the trees route them (:mod:`ratewise.operators.boosting`).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from ratewise.operators import boosting

# Booster settings of the feature model and of the hybrid model (its other settings are
# the booster library's defaults).
FEATURE_MODEL = boosting.Settings(trees=300, depth=8, rate=0.07, min_rows=4, columns=0.7, l1=0.5, l2=0.5,
                                  stop_rounds=6, seed=0)
HYBRID = boosting.Settings(trees=100, depth=10, rate=0.2, min_rows=1, columns=1.0, l1=2.0, l2=1.0, seed=0)


def fit_trees(train_rows: DataFrame, feature_cols: list[str], label_col: str = "label",
              settings: boosting.Settings = FEATURE_MODEL, groups: list[list[str]] | None = None,
              **changes) -> boosting.BoostedTrees:
    """Boosted trees with ``settings``, some of them changed by name; ``groups`` as in :func:`boosting.fit`."""
    return boosting.fit(train_rows, feature_cols, label_col, replace(settings, **changes), groups=groups)


def predict(model: boosting.BoostedTrees, rows: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns plus ``prediction``."""
    return model.transform(rows).select(*keep, "prediction")
