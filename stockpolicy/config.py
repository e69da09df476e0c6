"""Settings and source mapping, both immutable.

Settings become literals in the plans, so Catalyst can fold and push them down;
there is no settings table to join.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Mapping as MappingABC
from dataclasses import dataclass, field


def _as_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))


@dataclass(frozen=True)
class PolicyConfig:
    demand_window_weeks: int = 26
    min_weeks_history: int = 8
    min_units_history: float = 20
    intermittency_threshold: float = 0.40
    activity_window_weeks: int = 13
    service_levels: dict = field(default_factory=lambda: {"A": 0.98, "B": 0.95, "C": 0.90})
    abc_thresholds: dict = field(default_factory=lambda: {"A": 0.80, "B": 0.95})
    xyz_thresholds: dict = field(default_factory=lambda: {"X": 0.50, "Y": 1.00})
    baseline_weeks_of_cover: float = 2.0
    completed_status: str = "delivered"

    start_date: dt.date = dt.date(2017, 1, 1)
    period_starts: tuple = (dt.date(2017, 1, 1), dt.date(2018, 1, 1))
    min_deliveries: int = 10
    spine_end: dt.date | None = None  # weeks run on to this date's, not to a series' last sale

    max_duration_days: float = 365
    max_null_pct: float = 5
    max_row_drop_pct: float = 10

    min_usable_orders: int = 500
    min_span_weeks: int = 26
    min_lines_per_product: int = 8
    min_viable_series: int = 30

    def __post_init__(self):
        object.__setattr__(self, "start_date", _as_date(self.start_date))
        if self.spine_end is not None:
            object.__setattr__(self, "spine_end", _as_date(self.spine_end))
        starts = tuple(sorted(_as_date(d) for d in self.period_starts))
        if not starts:
            raise ValueError("period_starts needs at least one date")
        object.__setattr__(self, "period_starts", starts)

    def with_(self, **changes) -> PolicyConfig:
        return dataclasses.replace(self, **changes)

    @classmethod
    def from_dict(cls, settings: MappingABC) -> PolicyConfig:
        """Known keys only; an unknown key is an error, not a knob that does nothing."""
        known = {f.name for f in dataclasses.fields(cls)}
        unknown = sorted(set(settings) - known)
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        return cls(**dict(settings))

    @classmethod
    def from_yaml(cls, path: str) -> PolicyConfig:
        return cls.from_dict(_load_yaml(path))


@dataclass(frozen=True)
class SourceSpec:
    """One mapped extract. ``columns`` maps canonical names to source names."""

    file: str
    columns: dict
    expected_rows: int | None = None


@dataclass(frozen=True)
class Mapping:
    sections: dict
    completed_status: str = "delivered"

    def get(self, section: str) -> SourceSpec | None:
        return self.sections.get(section)

    @classmethod
    def from_dict(cls, raw: MappingABC) -> Mapping:
        sections = {}
        for name, spec in raw.items():
            if not spec:
                continue
            rows = spec.get("expected_rows")
            sections[name] = SourceSpec(
                file=spec["file"],
                columns=dict(spec["columns"]),
                expected_rows=int(rows) if rows else None,
            )
        status = (raw.get("orders") or {}).get("completed_status", "delivered")
        return cls(sections=sections, completed_status=status)

    @classmethod
    def from_yaml(cls, path: str) -> Mapping:
        return cls.from_dict(_load_yaml(path))


def _load_yaml(path: str) -> dict:
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading YAML settings needs PyYAML; use from_dict instead") from e
    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}
