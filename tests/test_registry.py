"""The registered query set is the SURVEY section 2 key list."""

import __spark_entry__ as E
from curbwise import oracle_sql, registry

SURVEY_KEYS = {
    "applications_received", "active_permits", "issued_permits", "review_time", "ex_permits_issued",
    "license_agreements_timeline", "lde_site_plan_revisions", "row_inspector_permit_list",
    "row_inspector_segment_list", "tds_cases", "tds_asmd_map", "sif_payment_details",
    "daily_request_counts", "active_permits_snapshot", "weekly_type_totals", "weekly_summary",
    "segment_count_score", "duration_score", "duration_score_literal", "road_segment_attach",
    "road_class_score", "dapcz_score", "permit_inspector_zone", "deficiency_score",
    "recent_inspection_score", "permit_type_label", "inspector_priority", "timestamp_text_normalize",
    "segments_recent", "segment_inspector_zone", "segment_dapcz_zone", "segment_zone_tags",
    "keyed_upsert",
}


def test_registered_keys_are_the_survey_keys():
    assert SURVEY_KEYS <= set(E.queries())
    assert set(registry.queries()) == SURVEY_KEYS == set(registry.PLAN_FUNCTIONS)
    assert set(oracle_sql.oracle_sql()) == SURVEY_KEYS


def test_building_a_query_starts_no_job(spark):
    """Plans are lazy: jobs of an action alone, whatever was built before it."""
    tracker = spark.sparkContext.statusTracker()
    for name, build in registry.queries().items():
        group = f"build-{name}"
        spark.sparkContext.setJobGroup(group, name)
        build(spark, "/root/testdata/sf0.001")
        jobs = [j for j in tracker.getJobIdsForGroup(group)]
        spark.sparkContext.setJobGroup("", "")
        # reading a parquet folder's schema is one small job per table, none reads rows
        assert all(len(tracker.getJobInfo(j).stageIds) == 1 for j in jobs), name
        assert all(tracker.getStageInfo(s) is None or tracker.getStageInfo(s).numTasks == 1
                   for j in jobs for s in tracker.getJobInfo(j).stageIds), name


def test_rules_without_road_data_tag_nothing(spark):
    for name in ("segment_count_score", "duration_score", "duration_score_literal", "deficiency_score",
                 "recent_inspection_score", "permit_type_label", "timestamp_text_normalize"):
        plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "signum" not in plan.lower(), name
