"""Distance names and their fixed constants."""

from __future__ import annotations

METRICS = ("euclidean", "manhattan", "cosine")
ALIASES = {"minkowski": "euclidean", "l2": "euclidean", "l1": "manhattan", "cityblock": "manhattan"}


def canonical(metric: str) -> str:
    m = ALIASES.get(metric, metric)
    if m not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; choose one of {', '.join(METRICS)}")
    return m
