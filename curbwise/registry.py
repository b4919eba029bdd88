"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables of ``sf_dir`` through the fixture
mapping (``PermitTables.from_fixture``) and runs the library plan over the
whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from curbwise.plans import reports, scoring, tagging, weekly
from curbwise.sources.fixtures import AS_OF
from curbwise.sources.tables import PermitTables

QueryFn = Callable[[SparkSession, str], DataFrame]


def _on_fixture(plan) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plan(PermitTables.from_fixture(spark, sf_dir))
    run.__doc__ = plan.__doc__
    run.__name__ = plan.__name__
    return run


# name -> (plan function, whether it takes the clock ``as_of`` as 2nd argument)
PLAN_FUNCTIONS = {
    **{name: (fn, False) for name, fn in reports.REPORTS.items()},
    # metric pipelines
    "daily_request_counts": (weekly.daily_request_counts, False),
    "active_permits_snapshot": (weekly.active_permits_snapshot, True),
    "weekly_type_totals": (weekly.weekly_type_totals_report, False),
    "weekly_summary": (weekly.weekly_summary_report, False),
    "segment_count_score": (scoring.segment_count_score, True),
    "duration_score": (scoring.duration_score, True),
    "duration_score_literal": (scoring.duration_score_literal, True),
    "road_segment_attach": (scoring.road_segment_attach, True),
    "road_class_score": (scoring.road_class_score, True),
    "dapcz_score": (scoring.dapcz_score, True),
    "permit_inspector_zone": (scoring.permit_inspector_zone, True),
    "deficiency_score": (scoring.deficiency_score, True),
    "recent_inspection_score": (scoring.recent_inspection_score, True),
    "permit_type_label": (scoring.permit_type_label, True),
    "inspector_priority": (scoring.inspector_priority, True),
    "timestamp_text_normalize": (scoring.timestamp_text_normalize, True),
    # spatial tagging
    "segments_recent": (tagging.segments_recent, True),
    "segment_inspector_zone": (tagging.segment_inspector_zone, False),
    "segment_dapcz_zone": (tagging.segment_dapcz_zone, False),
    "segment_zone_tags": (tagging.segment_zone_tags, True),
    # publishing
    "keyed_upsert": (tagging.keyed_upsert, True),
}


def bind(name: str, as_of: str) -> Callable[[PermitTables], DataFrame]:
    """The plan of ``name`` as a function of the tables, with the clock fixed."""
    fn, takes_clock = PLAN_FUNCTIONS[name]

    def plan(t: PermitTables) -> DataFrame:
        return fn(t, as_of) if takes_clock else fn(t)
    plan.__doc__ = fn.__doc__
    plan.__name__ = name
    return plan


PLANS = {name: bind(name, AS_OF) for name in PLAN_FUNCTIONS}  # fixture clock


def queries() -> dict[str, QueryFn]:
    return {name: _on_fixture(fn) for name, fn in PLANS.items()}
