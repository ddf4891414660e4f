"""Settings as frozen dataclasses, read from TOML over the defaults; unknown keys are errors."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field, fields, replace
from functools import lru_cache
from pathlib import Path


@dataclass(frozen=True)
class Acquisition:
    season: str = "E2026"
    request_delay: float = 0.3
    max_gap: int = 5
    fantasy_rounds: str = "all"


@dataclass(frozen=True)
class Transformation:
    names_mode: str = "continue"
    include_history: bool = False
    base_season: str | None = None


@dataclass(frozen=True)
class Optimization:
    target: str = "exp_pir"
    robustness_lambda: float = 0.0
    upside_beta: float = 0.0
    downside_gamma: float = 0.0
    cash: float = 100.0
    max_trades: int = 4
    unlimited_trades: bool = False
    credit_value: float = 0.0
    min_players_per_turn: tuple[int, ...] = ()
    must_have: tuple[str, ...] = ()
    avoid: tuple[str, ...] = ()

    @property
    def trades(self) -> int | None:
        return None if self.unlimited_trades else self.max_trades


@dataclass(frozen=True)
class Config:
    acquisition: Acquisition = field(default_factory=Acquisition)
    transformation: Transformation = field(default_factory=Transformation)
    optimization: Optimization = field(default_factory=Optimization)


def override(node, values: dict, where: str = ""):
    """A copy of a settings node with other values; lists become tuples, tables go down, unknown keys raise."""
    known = {f.name for f in fields(node)}
    changes = {}
    for key, value in values.items():
        if key not in known:
            raise ValueError(f"unknown setting {where}{key}; known: {sorted(known)}")
        old = getattr(node, key)
        if isinstance(value, dict):
            changes[key] = override(old, value, f"{where}{key}.")
        else:
            changes[key] = tuple(value) if isinstance(value, list) else value
    return replace(node, **changes)


@lru_cache(maxsize=8)
def load_config(path: str | None = None) -> Config:
    if path is None or not Path(path).exists():
        return Config()
    return override(Config(), tomllib.loads(Path(path).read_text(encoding="utf-8")))
