"""Plan-shape checks: no Python in the hot path, no cross products, shared scans."""

import pytest

from curbwise import registry

SF = "/root/testdata/sf0.001"
QUERIES = registry.queries()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_and_no_cross_product(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
                "BroadcastNestedLoopJoin", "Scan ExistingRDD"):  # the last would hide a plan that ran before
        assert bad not in plan, f"{name}: {bad} in plan"


@pytest.fixture(scope="module")
def extracted(spark, tmp_path_factory):
    """The fixture model written in the production layout (attribute tables partitioned)."""
    from curbwise.sources.jdbc import extract_to_parquet
    from curbwise.sources.tables import PermitTables
    root = str(tmp_path_factory.mktemp("extract"))
    src = PermitTables.from_fixture(spark, SF)
    extract_to_parquet(src, root, ["folder", "folderinfo", "folderproperty", "property", "propertyinfo",
                                   "validstatus", "accountbill", "folderfreeform", "accountbillfee", "accountpayment",
                                   "accountpaymentdetail", "folderprocess", "folderprocessattempt", "folderprocessdeficiency",
                                   "validsub", "validwork", "folderpeople", "people"])
    return PermitTables.from_parquet(spark, root)


def _scans(plan: str, table: str) -> list[str]:
    return [ln for ln in plan.splitlines() if "FileScan parquet" in ln and f"/{table}]" in ln]


@pytest.mark.parametrize("report,codes", [("tds_asmd_map", "SIF_INFO"), ("sif_payment_details", "SIF_PAYMENT_INFO")])
def test_attribute_joins_read_the_wanted_partitions_in_one_scan(spark, extracted, report, codes):
    from curbwise.plans import reports
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        (scan,) = _scans(_plan(getattr(reports, report)(extracted)), "folderinfo")
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pruned = scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    for code in getattr(reports, codes).values():
        assert str(code) in pruned, code


@pytest.mark.parametrize("report,tables", [("license_agreements_timeline", ["folderprocessattempt"]),
                                           ("row_inspector_permit_list", ["folderprocessattempt", "folderprocessdeficiency"])])
def test_history_is_cut_before_it_is_aggregated(spark, extracted, report, tables):
    """Above the scan of a history table comes the semi-join with the wanted processes, then the partial aggregation."""
    from curbwise.plans import reports
    lines = _plan(getattr(reports, report)(extracted)).splitlines()
    for table in tables:
        (at,) = [i for i, ln in enumerate(lines) if "FileScan parquet" in ln and f"/{table}]" in ln]
        depth = len(lines[at]) - len(lines[at].lstrip(" :+-*()0123456789"))
        above = []
        for ln in reversed(lines[:at]):
            d = len(ln) - len(ln.lstrip(" :+-*()0123456789"))
            if d < depth:
                above.append(ln)
                depth = d
        semi = next(i for i, ln in enumerate(above) if "LeftSemi" in ln)
        aggregate = next(i for i, ln in enumerate(above) if "Aggregate" in ln and "partial_" in ln)
        assert semi < aggregate, table


def _cell_joins(plan: str) -> int:
    return sum("Join [" in ln and "cx#" in ln for ln in plan.splitlines())


def test_road_class_needs_no_zones_and_the_upsert_tags_once(spark):
    from curbwise.plans import scoring
    from curbwise.sources.fixtures import AS_OF
    from curbwise.sources.tables import PermitTables
    t = PermitTables.from_fixture(spark, SF)
    plan = _plan(scoring.road_class_score(t, AS_OF))
    assert not _cell_joins(plan)  # no geometry at all
    upsert, tags = _plan(QUERIES["keyed_upsert"](spark, SF)), _plan(QUERIES["segment_zone_tags"](spark, SF))
    joins = [_cell_joins(p) for p in (upsert, tags)]
    assert joins[0] == joins[1] > 0  # one spatial join in either plan


def test_filters_and_columns_reach_the_scan(spark, extracted):
    from curbwise.plans import reports
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = _plan(reports.applications_received(extracted))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    assert "GreaterThanOrEqual(indate,2018-10-01T00:00)" in scan, scan
    assert "In(foldertype, [DS,EX,RW])" in scan or "foldertype" in scan.split("PushedFilters")[1], scan
    assert "ReadSchema: struct<foldertype:string,subcode:int,statuscode:int,indate:timestamp_ntz>" in scan


def test_extracted_layout_gives_same_rows(spark, extracted):
    from curbwise.plans import reports
    from curbwise.sources.tables import PermitTables
    a = sorted(map(tuple, reports.tds_asmd_map(extracted).collect()))
    b = sorted(map(tuple, reports.tds_asmd_map(PermitTables.from_fixture(spark, SF)).collect()))
    assert a == b and a


def test_a_hot_group_is_numbered_in_ranges(spark):
    """The window is partitioned by the key's range too, so no task holds a whole group."""
    plan = _plan(QUERIES["lde_site_plan_revisions"](spark, SF))
    numbered = next(ln for ln in plan.splitlines() if "Window [row_number()" in ln)
    assert "_k#" in numbered
