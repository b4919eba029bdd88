"""End-to-end production flow: extract -> tag + publish -> read back -> score -> publish."""

from curbwise.plans import scoring, tagging
from curbwise.schemas import PERMIT_SCHEMAS
from curbwise.sources import sinks
from curbwise.sources.jdbc import extract_to_parquet
from curbwise.sources.tables import PermitTables

SF = "/root/testdata/sf0.001"
AS_OF = "2022-06-01 00:00:00"


def test_publish_flow_matches_fixture_flagship(spark, tmp_path):
    fixture = PermitTables.from_fixture(spark, SF)
    model_root, pub_root = str(tmp_path / "model"), str(tmp_path / "published")
    extract_to_parquet(fixture, model_root, [n for n in PERMIT_SCHEMAS if n != "road_segment"])
    t = PermitTables.from_parquet(spark, model_root)

    # full tagging run publishes the road dataset, an incremental run upserts into it
    sinks.publish(spark, "segment_zone_tags", tagging.segment_zone_tags(t, AS_OF, full=True), pub_root)
    sinks.publish(spark, "segment_zone_tags", tagging.segment_zone_tags(t, AS_OF), pub_root)
    road = sinks.read_latest(spark, f"{pub_root}/segment_zone_tags", PERMIT_SCHEMAS["road_segment"])
    assert road.count() == fixture.segment.count()

    prio = scoring.inspector_priority(t, AS_OF, road=road)
    sinks.publish(spark, "inspector_priority", prio, pub_root)
    published = sinks.read_latest(spark, f"{pub_root}/inspector_priority")

    expected = scoring.inspector_priority(fixture, AS_OF)
    cols = sorted(expected.columns)
    assert sorted(published.columns) == cols
    def rows(df):
        return sorted(map(repr, map(tuple, df.select(*cols).collect())))
    got, want = rows(published), rows(expected)
    assert got == want and len(got) > 0
