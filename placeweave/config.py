"""Settings of the trade-area jobs, checked when they are made."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from .errors import ConfigError


def _need(ok: bool, what: str) -> None:
    if not ok:
        raise ConfigError(what)


@dataclass(frozen=True)
class VisitConfig:
    merge_window_minutes: int = 30
    max_daily_merchants: int = 100

    def __post_init__(self) -> None:
        _need(self.merge_window_minutes > 0, "merge_window_minutes must be positive")
        _need(self.max_daily_merchants > 0, "max_daily_merchants must be positive")


@dataclass(frozen=True)
class PairConfig:
    window_minutes: int = 120
    decay_minutes: float = 60.0
    min_support: int = 2

    def __post_init__(self) -> None:
        _need(self.window_minutes > 0, "window_minutes must be positive")
        _need(self.decay_minutes > 0 and math.isfinite(self.decay_minutes), "decay_minutes must be positive")
        _need(self.min_support >= 1, "min_support must be at least 1")


@dataclass(frozen=True)
class GraphConfig:
    method: str = "sppmi"
    smoothing: float = 0.75
    shift: float = 3.0
    top_k: int = 15
    min_z: float = 0.5

    def __post_init__(self) -> None:
        _need(self.method in ("sppmi", "transaction_count"), f"unknown edge method {self.method!r}")
        _need(0 < self.smoothing <= 1, "smoothing must be in (0, 1]")
        _need(self.shift > 0, "shift must be positive")
        _need(self.top_k > 0, "top_k must be positive")
        _need(self.min_z >= 0, "min_z must not be negative")


@dataclass(frozen=True)
class CommunityConfig:
    resolution: float = 1.0
    seed: int = 42
    min_online_neighbours: int = 30
    online_distance_m: float = 3000.0

    def __post_init__(self) -> None:
        _need(self.resolution > 0, "resolution must be positive")
        _need(self.min_online_neighbours >= 2, "min_online_neighbours must be at least 2")
        _need(self.online_distance_m > 0, "online_distance_m must be positive")


@dataclass(frozen=True)
class AnchorConfig:
    min_count: int = 3
    max_count: int = 10
    merchants_per_anchor: int = 20
    min_community: int = 3
    max_participation: float = 0.6
    chain_quantile: float = 0.99
    chain_min_visits: int = 100

    def __post_init__(self) -> None:
        _need(1 <= self.min_count <= self.max_count, "anchor counts must satisfy 1 <= min <= max")
        _need(self.merchants_per_anchor > 0, "merchants_per_anchor must be positive")
        _need(self.min_community > 0, "min_community must be positive")
        _need(0 <= self.max_participation <= 1, "max_participation must be in [0, 1]")
        _need(0 < self.chain_quantile <= 1, "chain_quantile must be in (0, 1]")
        _need(self.chain_min_visits > 0, "chain_min_visits must be positive")


@dataclass(frozen=True)
class GeoConfig:
    radius_m: float = 3000.0
    max_merchants_per_coordinate: int = 20

    def __post_init__(self) -> None:
        _need(self.radius_m > 0, "radius_m must be positive")
        _need(self.max_merchants_per_coordinate > 0, "max_merchants_per_coordinate must be positive")


@dataclass(frozen=True)
class JobConfig:
    city_code: str = "city"
    visits: VisitConfig = field(default_factory=VisitConfig)
    pairs: PairConfig = field(default_factory=PairConfig)
    graph: GraphConfig = field(default_factory=GraphConfig)
    community: CommunityConfig = field(default_factory=CommunityConfig)
    anchors: AnchorConfig = field(default_factory=AnchorConfig)
    geo: GeoConfig = field(default_factory=GeoConfig)
    min_community_size: int = 3

    def __post_init__(self) -> None:
        _need(bool(self.city_code.strip()), "city_code must not be blank")
        _need(self.min_community_size > 0, "min_community_size must be positive")
