"""Model of the live detector for one training window of at most 200 ticks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

from tidewatch.functions.trees import flat, grow_all, score

# The live detector's settings.
WINDOW, RETRAIN, WARMUP = 200, 50, 30
TREES, SAMPLE, CONTAMINATION, SEED, EXPLAIN_ABOVE = 100, 256, 0.05, 42, 1.5


@dataclass(frozen=True)
class Settings:
    window: int = WINDOW
    retrain: int = RETRAIN
    warmup: int = WARMUP
    trees: int = TREES
    contamination: float = CONTAMINATION
    seed: int = SEED


class WindowModel:
    """Trees, cut and normal values of one training window; the same window and epoch give the same model."""

    def __init__(self, rows: np.ndarray, epoch: int, settings: Settings = Settings()):
        self.mean, self.std = rows.mean(axis=0), rows.std(axis=0)
        self.size = min(SAMPLE, len(rows))
        drawn = [rows[np.random.default_rng([settings.seed, epoch, t]).permutation(len(rows))[: self.size]] for t in range(settings.trees)]
        self.trees = flat(grow_all(drawn, settings.seed * 1_000_003 + epoch))
        self.cut = float(np.percentile(score(self.trees, rows, self.size), 100 * settings.contamination))

    def decide(self, rows: np.ndarray) -> np.ndarray:
        """Score above the cut; anomalous below 0."""
        return score(self.trees, rows, self.size) - self.cut

    def reason(self, row: np.ndarray, names: Sequence[str]) -> str:
        """Metrics far from their normal values, in the given order."""
        out = []
        for name, value, mean, std in zip(names, row, self.mean, self.std):
            z = (value - mean) / std if std > 0 else 0.0
            if abs(z) > EXPLAIN_ABOVE:
                out.append(f"{name}={value:.1f} ({'HIGH' if z > 0 else 'LOW'}, z={z:+.1f})")
        return " | ".join(out)
