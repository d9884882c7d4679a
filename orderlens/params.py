"""Typed arguments of the batch job and of the reports."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date
from typing import Optional, Sequence

# Default entities and analysed window of the batch job.
DEFAULT_ENTITIES = ("FP_TW", "FP_HK", "FP_SG", "FP_MY", "FP_TH", "FP_PH", "FP_BD", "FP_PK")
DEFAULT_START = date(2022, 6, 1)
DEFAULT_END = date(2022, 8, 31)

# Allowed range and step of the two report parameters.
BIN_SIZE_DEFAULT, BIN_SIZE_MIN, BIN_SIZE_MAX, BIN_SIZE_STEP = 5000.0, 1000.0, 10000.0, 1000.0
ORDER_DROP_DEFAULT, ORDER_DROP_MIN, ORDER_DROP_MAX, ORDER_DROP_STEP = 0.02, 0.0, 0.16, 0.02


def _as_date(value) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


@dataclass(frozen=True)
class BatchParams:
    """Entities and inclusive date window of one batch run."""

    entity_ids: Sequence[str] = DEFAULT_ENTITIES
    start_date: date = DEFAULT_START
    end_date: date = DEFAULT_END

    def __post_init__(self):
        object.__setattr__(self, "entity_ids", tuple(self.entity_ids))
        object.__setattr__(self, "start_date", _as_date(self.start_date))
        object.__setattr__(self, "end_date", _as_date(self.end_date))
        if not self.entity_ids:
            raise ValueError("entity_ids must not be empty")
        if self.start_date > self.end_date:
            raise ValueError("start_date is after end_date")


def _range_parameter(name: str, value: float, low: float, high: float, step: float) -> float:
    steps = (value - low) / step
    if not low <= value <= high or abs(steps - round(steps)) > 1e-9:
        raise ValueError(f"{name}={value} is not in {low}..{high} step {step}")
    return float(value)


@dataclass(frozen=True)
class ReportParams:
    """What-if order drop and width of the GMV bins."""

    order_drop: float = ORDER_DROP_DEFAULT
    gmv_bin_size: float = BIN_SIZE_DEFAULT

    def __post_init__(self):
        object.__setattr__(self, "order_drop", _range_parameter(
            "order_drop", self.order_drop, ORDER_DROP_MIN, ORDER_DROP_MAX, ORDER_DROP_STEP))
        object.__setattr__(self, "gmv_bin_size", _range_parameter(
            "gmv_bin_size", self.gmv_bin_size, BIN_SIZE_MIN, BIN_SIZE_MAX, BIN_SIZE_STEP))


@dataclass(frozen=True)
class ViewFilters:
    """Context filters shared by every report; ``None`` keeps all members, NULL included.

    A member list may hold ``None`` to keep rows whose value is NULL.
    """

    created_date_utc: Optional[tuple] = None  # (first day, last day), both kept
    entity_id: Optional[Sequence[Optional[str]]] = None
    region: Optional[Sequence[Optional[str]]] = None
    is_fd_subscription: Optional[Sequence[Optional[str]]] = None
    city_name: Optional[Sequence[Optional[str]]] = None
    zone_name: Optional[Sequence[Optional[str]]] = None
    vertical_type: Optional[Sequence[Optional[str]]] = None

    def without(self, column: str) -> "ViewFilters":
        return replace(self, **{column: None})


# The state in which the reports are first opened.
DEFAULT_VIEW_FILTERS = ViewFilters(
    created_date_utc=(DEFAULT_START, DEFAULT_END),
    entity_id=("FP_TW",),
    region=(None, "Asia"),
    is_fd_subscription=("Y",),
)
DEFAULT_RUNNING_SHARE_RANGE = (0.00064293826459584406, 1.0)
