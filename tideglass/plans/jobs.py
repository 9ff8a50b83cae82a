"""Which job reads which kind of source, by name, and the contract that all of them keep."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tideglass.operators.gates import GateError, check_schema
from tideglass.plans import fixed_width, members, pages, tables
from tideglass.plans.result import ParseResult
from tideglass.spec import DatasetSpec, DeclarationError

#: Kind of source to the job that parses it.
JOBS: dict[str, Callable] = {
    "fixed_width_hourly": fixed_width.parse_hourly,
    "fixed_width_daily": fixed_width.parse_daily,
    "wide_table": tables.parse_wide,
    "month_matrix": tables.parse_month_matrix,
    "inventory": tables.parse_inventory,
    "grid": tables.parse_grid,
    "unit_values": members.corrected_values,
    "api_pages": pages.collect_pages,
}


def job(kind: str) -> Callable:
    """The job of a kind of source; an unknown one is refused with the known names."""
    if kind not in JOBS:
        raise DeclarationError(f"no job reads {kind!r}; known: {', '.join(sorted(JOBS))}")
    return JOBS[kind]


def run_job(parser: str | Callable[..., ParseResult | DataFrame], spec: DatasetSpec, *args, **options) -> ParseResult:
    """Runs a job, or a caller's own parser, and holds its result against the dataset's declaration before any row is read.

    A parser takes the source and returns accepted and rejected rows; rows alone mean that it rejects none.
    """
    made = (job(parser) if isinstance(parser, str) else parser)(*args, **options)
    result = made if isinstance(made, ParseResult) else getattr(made, "result", None) or ParseResult(getattr(made, "accepted", made), tables.no_rejections(getattr(made, "accepted", made)))
    check_schema(result.accepted, spec)
    if missing := {"source", "rejection_key", "reason"} - {*result.rejected.columns}:
        raise GateError(f"{spec.dataset_id}: rejections lack {sorted(missing)}")
    return result
