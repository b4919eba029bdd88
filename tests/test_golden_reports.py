"""Golden cases of the report rules (FIXTURES.md section 4)."""

import datetime as dt

import pytest

from curbwise.functions import dates as D
from curbwise.functions import text as X
from curbwise.plans import reports
from helpers import VALID, tables, ts


def folder(rsn, **kw):
    base = {"folderrsn": rsn, "foldertype": "RW", "subcode": 50500, "statuscode": 50010,
            "foldername": f"P-{rsn}", "priority": 2, "indate": ts("2020-01-01 08:00:00"),
            "issuedate": ts("2020-01-05 08:00:00"), "expirydate": ts("2020-02-01 09:00:00"),
            "propertyrsn": 100 + rsn, "workcode": 1, "folderyear": 22, "foldersequence": 100000 + rsn}
    base.update(kw)
    return base


def test_day_rounding_and_null_date(spark):
    t = tables(spark, folder=[
        folder(1, indate=ts("2020-03-01 11:59:59")),
        folder(2, indate=ts("2020-03-01 12:00:00")),
        folder(3, indate=None)])
    rows = {r.received_date: r.issuedrowpermits for r in reports.applications_received(t).collect()}
    assert rows == {"2020-03-01": 1, "2020-03-02": 1}


def test_not_in_with_null_subcode(spark):
    t = tables(spark, folder=[
        folder(1, foldertype="RW", subcode=None), folder(2, foldertype="EX", subcode=None),
        folder(3, foldertype="DS", subcode=None)])
    got = [(r.foldertype, r.subcode) for r in reports.applications_received(t).collect()]
    assert got == [("DS", None)]


def test_la_names(spark):
    t = tables(spark, folder=[
        folder(1, foldertype="RW", foldername="LA-1"), folder(2, foldertype="EX", foldername="LA-1"),
        folder(3, foldertype="RW", foldername=None), folder(4, foldertype="RW")])
    got = {r.foldertype: r.activepermits for r in reports.active_permits(t).collect()}
    assert got == {"EX": 1, "RW": 1}


def test_first_process_and_fractional_days(spark):
    f = [folder(1, indate=ts("2023-01-01 00:00:00"), issuedate=ts("2023-01-02 06:00:00")),
         folder(2, indate=ts("2023-01-01 00:00:00"), issuedate=ts("2023-01-03 00:00:00"))]
    procs = [{"processrsn": 10, "folderrsn": 1, "processcode": 70000, "startdate": None},
             {"processrsn": 11, "folderrsn": 1, "processcode": 70000, "startdate": ts("2023-01-02")},
             {"processrsn": 12, "folderrsn": 1, "processcode": 70000, "startdate": ts("2023-01-01 12:00:00")}]
    t = tables(spark, folder=f, folderprocess=procs)
    rows = {r.folderrsn: r for r in reports.review_time(t).collect()}
    assert rows[1].webappstart == "2023-01-01T12:00:00"
    assert rows[1].time_to_issuance == pytest.approx(1.25)
    assert rows[1].time_to_review == pytest.approx(0.5)
    assert rows[2].webappstart is None and rows[2].time_to_review is None


def test_permit_id(spark):
    t = tables(spark, folder=[folder(1, foldertype="EX", folderyear=22, foldersequence=100001, priority=3,
                                     issuedate=ts("2020-01-01 00:00:00"))], validsub=VALID["validsub"])
    (row,) = reports.ex_permits_issued(t).collect()
    assert row.permit_id == "22-100001"
    assert row.subdesc == "TURP"
    assert row.issuedate == "01-01-2020 00:00:00"


def test_min_accepted_attempt(spark):
    t = tables(spark, folder=[folder(1, foldertype="LM")],
               folderprocess=[{"processrsn": 5, "folderrsn": 1, "processcode": 70000}],
               folderprocessattempt=[
                   {"processrsn": 5, "attemptdate": ts("2021-01-01"), "resultcode": 52131},
                   {"processrsn": 5, "attemptdate": ts("2021-01-03"), "resultcode": 52130},
                   {"processrsn": 5, "attemptdate": ts("2021-01-02"), "resultcode": 52130}])
    (row,) = reports.license_agreements_timeline(t).collect()
    assert row.web_app_accept_date == "2021-01-02T00:00:00"
    assert row.payment_completed_date is None


def test_cycle_numbers(spark):
    procs = [{"processrsn": 9, "folderrsn": 1, "processcode": 51212, "statuscode": 1},
             {"processrsn": 7, "folderrsn": 1, "processcode": 51212, "statuscode": 1},
             {"processrsn": 8, "folderrsn": 1, "processcode": 51258, "statuscode": 1}]
    t = tables(spark, folder=[folder(1, foldertype="SP")], folderprocess=procs,
               propertyinfo=[{"propertyrsn": 101, "propertyinfocode": 52026, "propinfovalue": "3"}], **VALID)
    got = {r.processrsn: r.cyclenumber for r in reports.lde_site_plan_revisions(t).collect()}
    assert got == {7: 1, 9: 2, 8: 1}


def _inspector_model(spark, **extra):
    data = dict(
        folder=[folder(1, foldertype="EX"), folder(2, foldertype="EX")],
        folderpeople=[{"folderrsn": 1, "peoplersn": 1, "peoplecode": 50065},
                      {"folderrsn": 1, "peoplersn": 2, "peoplecode": 50065},
                      {"folderrsn": 2, "peoplersn": 1, "peoplecode": 50065}],
        people=[{"peoplersn": 1, "organizationname": "A"}, {"peoplersn": 2, "organizationname": "B"}],
        folderprocess=[{"processrsn": 20, "folderrsn": 1, "processcode": 50685},
                       {"processrsn": 21, "folderrsn": 1, "processcode": 50685}],
        folderprocessdeficiency=[{"processrsn": 20, "statuscode": 55360},
                                 {"processrsn": 20, "statuscode": 55361}],
        **VALID)
    data.update(extra)
    return tables(spark, **data)


def test_fan_out_and_deficiency_counts(spark):
    rows = reports.row_inspector_permit_list(_inspector_model(spark)).collect()
    f1 = [r for r in rows if r.folderrsn == 1]
    assert len(f1) == 4  # 2 processes x 2 contacts
    counts = sorted({(r.contractor, r.count_deficiencies) for r in f1})
    assert counts == [("A", 0), ("A", 1), ("B", 0), ("B", 1)]
    (f2,) = [r for r in rows if r.folderrsn == 2]
    assert f2.count_deficiencies == 0 and f2.most_recent_inspection is None


def test_scalar_lookup_repeated_code_raises(spark):
    info = [{"folderrsn": 1, "infocode": 75390, "infovalue": "5"},
            {"folderrsn": 1, "infocode": 75390, "infovalue": "6"}]
    with pytest.raises(Exception, match="more than one"):
        reports.row_inspector_permit_list(_inspector_model(spark, folderinfo=info)).collect()


def test_relation_flag(spark):
    fp = [{"folderrsn": 1, "propertyrsn": 1, "propertyrelationcode": 5},
          {"folderrsn": 1, "propertyrsn": 2, "propertyrelationcode": 1},
          {"folderrsn": 1, "propertyrsn": 3, "propertyrelationcode": None}]
    props = [{"propertyrsn": i, "propcode": 52010} for i in (1, 2, 3)]
    t = tables(spark, folder=[folder(1, foldertype="DS")], folderproperty=fp, property=props)
    got = {r.propertyrsn: r.is_primary for r in reports.row_inspector_segment_list(t).collect()}
    assert got == {1: "TRUE", 2: "FALSE", 3: "FALSE"}


def _sif_model(spark, info):
    return tables(
        spark, folder=[folder(1, foldertype="SIF", statuscode=50010, propertyrsn=7)],
        folderproperty=[{"folderrsn": 1, "propertyrsn": 7}],
        property=[{"propertyrsn": 7, "prophouse": "12", "propstreet": "MAIN", "propprovince": "TX",
                   "proppostal": "78701"}],
        propertyinfo=[{"propertyrsn": 7, "propertyinfocode": 55005, "propinfovalue": "S7"}],
        folderinfo=info, **VALID)


def test_eav_inner_join_missing_and_repeated(spark):
    codes = list(reports.SIF_INFO.values())
    six = [{"folderrsn": 1, "infocode": c, "infovalue": "x"} for c in codes[:-1]]
    assert reports.tds_asmd_map(_sif_model(spark, six)).count() == 0
    seven_plus = six + [{"folderrsn": 1, "infocode": codes[-1], "infovalue": "a"},
                        {"folderrsn": 1, "infocode": codes[-1], "infovalue": "b"}]
    rows = reports.tds_asmd_map(_sif_model(spark, seven_plus)).collect()
    assert len(rows) == 2
    assert rows[0].primary_folder_property_address == "12 MAIN     TX 78701"
    assert rows[0].total_fees_paid is None


def test_address_month_fiscal(spark):
    df = spark.createDataFrame([("12", "MAIN", None, None, None, None, "TX", "78701",
                                 dt.datetime(2022, 10, 1), dt.datetime(2022, 9, 30))],
                               "a string, b string, c string, d string, e string, f string, g string, h string,"
                               " d1 timestamp_ntz, d2 timestamp_ntz")
    r = df.select(X.joined_with_blanks(*"abcdefgh").alias("addr"),
                  D.month_name_padded("d1").alias("m1"), D.fiscal_quarter("d1").alias("q1"),
                  D.fiscal_year("d1").alias("y1"), D.month_name_padded("d2").alias("m2"),
                  D.fiscal_quarter("d2").alias("q2"), D.fiscal_year("d2").alias("y2")).first()
    assert r.addr == "12 MAIN     TX 78701"
    assert (r.m1, r.q1, r.y1) == ("October  ", "Q1", 2023)
    assert (r.m2, r.q2, r.y2) == ("September", "Q4", 2022)


def test_void_flag(spark):
    base = dict(
        folder=[folder(1, foldertype="SIF", propertyrsn=7)],
        folderfreeform=[{"folderrsn": 1, "f03": 1.0}],
        accountbill=[{"folderrsn": 1, "billnumber": 1}],
        accountbillfee=[{"folderrsn": 1, "billnumber": 1}, {"folderrsn": 1, "billnumber": 1}],
        accountpaymentdetail=[{"folderrsn": 1, "billnumber": 1, "paymentnumber": p,
                               "dategenerated": ts("2022-10-01")} for p in (1, 2, 3)],
        accountpayment=[{"folderrsn": 1, "paymentnumber": 1, "voidflag": "Y"},
                        {"folderrsn": 1, "paymentnumber": 2, "voidflag": None},
                        {"folderrsn": 1, "paymentnumber": 3, "voidflag": "N"}],
        folderproperty=[{"folderrsn": 1, "propertyrsn": 7}],
        property=[{"propertyrsn": 7}],
        propertyinfo=[{"propertyrsn": 7, "propertyinfocode": 55005, "propinfovalue": "S"}],
        folderinfo=[{"folderrsn": 1, "infocode": 84011, "infovalue": "D1"},
                    {"folderrsn": 1, "infocode": 84012, "infovalue": "A"}],
        **VALID)
    rows = reports.sif_payment_details(tables(spark, **base)).collect()
    assert [(r.paymentnumber, r.payment_quarter, r.payment_fy) for r in rows] == [(3, "Q1", 2023)]


def test_column_name_normalisation(spark):
    df = spark.createDataFrame([(1,)], "`DS Applications Received` int")
    assert X.normalize_columns(df).columns == ["ds_applications_received"]


def test_reports_are_sorted_with_nulls_last(spark):
    from curbwise.sources.tables import PermitTables
    t = PermitTables.from_fixture(spark, "/root/testdata/sf0.001")
    orders = {
        "applications_received": ("foldertype", "subcode", "received_date"), "active_permits": ("foldertype",),
        "issued_permits": ("foldertype", "subcode", "issued_date"),
        "lde_site_plan_revisions": ("reviewer", "foldertype", "process_name", "processrsn"),
        "row_inspector_segment_list": ("folderrsn",), "tds_cases": ("reviewer", "foldertype", "processname", "processrsn"),
        "tds_asmd_map": ("folderrsn",), "sif_payment_details": ("folderrsn",)}
    for name, by in orders.items():
        keys = [tuple((r[c] is None, r[c]) if r[c] is not None else (True, "") for c in by) for r in reports.REPORTS[name](t).collect()]
        assert keys and keys == sorted(keys), name


def test_issued_subcode_exclusion_only_for_rw(spark):
    t = tables(spark, folder=[
        folder(1, foldertype="RW", subcode=50505), folder(2, foldertype="EX", subcode=50505),
        folder(3, foldertype="DS", subcode=None), folder(4, foldertype="RW", subcode=None),
        folder(5, foldertype="EX", issuedate=ts("2018-09-30 23:00:00"))])
    got = sorted((r.foldertype, r.subcode) for r in reports.issued_permits(t).collect())
    assert got == [("DS", None), ("EX", 50505)]


def test_segment_list_keeps_duplicate_links(spark):
    fp = [{"folderrsn": 1, "propertyrsn": 1, "propertyrelationcode": 5}] * 2
    t = tables(spark, folder=[folder(1, foldertype="EX")], folderproperty=fp,
               property=[{"propertyrsn": 1, "propcode": 52010}])
    assert reports.row_inspector_segment_list(t).count() == 2
