"""The twelve permit reports, each a function ``tables -> DataFrame``.

Output columns are lower case and keep the report's column order. Joins are
ordered so that consecutive joins share a key (folder, then process, then
property) and Spark can keep one hash partitioning across them; code-table
lookups (``valid*``) are tiny and become broadcast joins through Spark's
size threshold, never through a hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbwise.functions import dates as D
from curbwise.functions import text as X
from curbwise.operators import eav
from curbwise.operators.grouping import cycle_number, first_of_group
from curbwise.sources.tables import PermitTables

# Fixed values of the reports: cut-off dates, status / process / info codes.
SINCE_FY2019 = "2018-10-01 00:00:00"
SINCE_FY2023 = "2022-10-01 00:00:00"
ACTIVE = 50010
WITHDRAWN, REJECTED, VOID_APP, VOID_LM = 50003, 50005, 70045, 56050
TURP = 50500
EXCLUDED_SUBCODES = (50510, 50505)
WEB_ACCEPTANCE, INITIAL_DISTRIBUTION, ROW_INSPECTION = 70000, 51070, 50685
ACCEPTED, COMPLETED = 52130, 55000
REVIEW_DISCIPLINE = 50030
OPEN_DEFICIENCY = 55360
LDE_PROCESSES = (51212, 51258, 51259)
TDS_PROCESSES = (51132, 51834, 84102)
TDS_FOLDER_TYPES = ("C8", "SP", "ZC", "PR", "CC")
COUNCIL_DISTRICT_INFO, SEGMENT_GIS_INFO = 52026, 55005
SEGMENT_PROPCODE = 52010
PRIMARY_RELATION = 5
RW_CONTACT, ROW_CONTRACTOR = 1, 50065
PERMIT_INFO = {  # scalar folderinfo lookups of the inspector permit list
    "total_days": 75390,
    "event_start_date": 75980,
    "start_date": 76110,
    "extension_start_date": 75993,
    "extension_end_date": 75994,
    "end_date": 76115,
}
SIF_INFO = {  # inner folderinfo joins of the SIF map (in report column order)
    "offset_amount": 84021,
    "row_dedication_value": 84040,
    "easement_dedication_value": 84043,
    "council_district": 84011,
    "sif_district_area": 84012,
    "total_affordability_reduction": 84044,
    "transportation_land_use": 84016,
}
SIF_PAYMENT_INFO = {"council_district": 84011, "sif_district_area": 84012}

col = F.col


def _sorted(df: DataFrame, *names: str) -> DataFrame:
    """Ascending, NULLs last, as the source database sorts."""
    return df.orderBy(*[col(n).asc_nulls_last() for n in names])


def _ftype(*types: str):
    return col("foldertype").isin(*types)


def _address(p: str = "p"):
    return X.joined_with_blanks(*[col(f"{p}.{c}") for c in (
        "prophouse", "propstreet", "propstreettype", "propstreetdirection",
        "propunittype", "propunit", "propprovince", "proppostal")])


# R1 ------------------------------------------------------------------------
def applications_received(t: PermitTables) -> DataFrame:
    """Applications received per folder type, sub code and (rounded) day."""
    recent = col("indate") >= D.ts_literal(SINCE_FY2019)
    ds = _ftype("DS") & ~col("statuscode").isin(REJECTED, WITHDRAWN, VOID_APP)
    rw_ex = (_ftype("RW", "EX") & ~col("statuscode").isin(VOID_APP, WITHDRAWN)
             & ~col("subcode").isin(*EXCLUDED_SUBCODES))
    counts = (t.folder.filter((ds | rw_ex) & recent)
              .groupBy("foldertype", "subcode", D.day_text(D.round_day("indate")).alias("received_date"))
              .agg(F.count(F.lit(1)).alias("issuedrowpermits")))
    return _sorted(counts, "foldertype", "subcode", "received_date")


# R2 ------------------------------------------------------------------------
def active_permits(t: PermitTables) -> DataFrame:
    """Active permits per folder type (RW licence agreements excluded)."""
    keep = (col("statuscode") == ACTIVE) & (
        _ftype("EX", "DS") | (_ftype("RW") & X.not_like_prefix("foldername", "LA-")))
    counts = t.folder.filter(keep).groupBy("foldertype").agg(F.count(F.lit(1)).alias("activepermits"))
    return _sorted(counts, "foldertype")


# R3 ------------------------------------------------------------------------
def issued_permits(t: PermitTables) -> DataFrame:
    """Permits issued per folder type, sub code and (rounded) day."""
    recent = col("issuedate") >= D.ts_literal(SINCE_FY2019)
    keep = recent & (_ftype("EX", "DS") | (_ftype("RW") & ~col("subcode").isin(*EXCLUDED_SUBCODES)))
    counts = (t.folder.filter(keep)
              .groupBy("foldertype", "subcode", D.day_text(D.round_day("issuedate")).alias("issued_date"))
              .agg(F.count(F.lit(1)).alias("issuedrowpermits")))
    return _sorted(counts, "foldertype", "subcode", "issued_date")


# R4 ------------------------------------------------------------------------
def review_time(t: PermitTables) -> DataFrame:
    """Days to issuance and to first web-acceptance review of recent permits.

    Only processes of the selected (recent) folders are aggregated: a
    semi-join on the folder key first, after which the rows are partitioned
    by folder and the first-of-group aggregate adds no shuffle.
    """
    f = t.folder.filter(((_ftype("RW") & (col("subcode") == TURP)) | _ftype("EX"))
                        & (col("indate") >= D.ts_literal(SINCE_FY2023))
                        & col("issuedate").isNotNull())
    procs = t.folderprocess.filter(col("processcode") == WEB_ACCEPTANCE).join(f.select("folderrsn"), "folderrsn", "left_semi")
    first_review = first_of_group(procs, keys=["folderrsn"], order_by=["startdate", "processrsn"],
                                  values=["startdate", "enddate"])
    j = f.join(first_review, "folderrsn", "left")
    return j.select(
        "customfoldernumber", "folderrsn", "foldertype",
        D.iso_seconds("indate").alias("indate"),
        D.iso_seconds("issuedate").alias("issuedate"),
        D.iso_seconds("startdate").alias("webappstart"),
        D.iso_seconds("enddate").alias("webappend"),
        D.fractional_days("indate", "issuedate").alias("time_to_issuance"),
        D.fractional_days("indate", "startdate").alias("time_to_review"))


# R5 ------------------------------------------------------------------------
def ex_permits_issued(t: PermitTables) -> DataFrame:
    """Issued EX permits of priority 3 with their sub-type description."""
    f = t.folder.filter(_ftype("EX") & (col("issuedate") >= D.ts_literal(SINCE_FY2019))
                        & (col("priority") == 3))
    return f.join(t.validsub, "subcode", "left").select(
        X.oracle_concat("folderyear", F.lit("-"), "foldersequence").alias("permit_id"),
        "subcode", "subdesc", "foldername",
        D.us_seconds("indate").alias("indate"),
        D.us_seconds("issuedate").alias("issuedate"))


# R6 ------------------------------------------------------------------------
def license_agreements_timeline(t: PermitTables) -> DataFrame:
    """Licence agreements with acceptance, distribution and review dates.

    The three per-folder sub-queries (two attempt minima, one end-date
    maximum) are one conditional aggregation over a single process scan.
    """
    f = t.folder.filter(_ftype("LM") & (col("statuscode") != VOID_LM))
    fp = (t.folderprocess.filter(col("processcode").isin(WEB_ACCEPTANCE, INITIAL_DISTRIBUTION)
                                 | (col("disciplinecode") == REVIEW_DISCIPLINE))
          .select("processrsn", "folderrsn", "processcode", "disciplinecode", "enddate")
          .join(f.select("folderrsn"), "folderrsn", "left_semi"))
    res = col("resultcode")
    # earliest accepted / completed attempt per process, of the licence folders'
    # processes only: the history is cut before it is aggregated
    att = (t.folderprocessattempt.filter(res.isin(ACCEPTED, COMPLETED))
           .join(fp.filter(col("processcode").isin(WEB_ACCEPTANCE, INITIAL_DISTRIBUTION)).select("processrsn"), "processrsn", "left_semi")
           .groupBy("processrsn")
           .agg(F.min(F.when(res == ACCEPTED, col("attemptdate"))).alias("_accepted"),
                F.min(F.when(res == COMPLETED, col("attemptdate"))).alias("_completed")))
    code = col("processcode")
    per_folder = fp.join(att, "processrsn", "left").groupBy("folderrsn").agg(
        F.min(F.when(code == WEB_ACCEPTANCE, col("_accepted"))).alias("web_acc"),
        F.min(F.when(code == INITIAL_DISTRIBUTION, col("_completed"))).alias("pay"),
        F.max(F.when(col("disciplinecode") == REVIEW_DISCIPLINE, col("enddate"))).alias("rev_end"))
    j = (f.join(per_folder, "folderrsn", "left")
         .join(t.validsub, "subcode", "left")
         .join(t.validstatus, "statuscode", "left"))
    return j.select(
        "folderrsn", "referencefile", "subdesc", "statusdesc", "foldercondition",
        D.iso_seconds("indate").alias("indate"),
        D.iso_seconds("web_acc").alias("web_app_accept_date"),
        D.iso_seconds("pay").alias("payment_completed_date"),
        D.iso_seconds("rev_end").alias("review_end_date"),
        D.iso_seconds("issuedate").alias("issuedate"))


# R7 / R10 shared -------------------------------------------------------------
def _process_rows(t: PermitTables, folders: DataFrame, process_codes) -> DataFrame:
    """Folder x process x descriptions x council district (inner), reviewer (left).

    The selective process filter joins first (on folder), then the council
    district (on property); the DISTINCT that follows shuffles on all of its
    columns, so a folder with very many processes is spread.
    """
    fp = t.folderprocess.filter(col("processcode").isin(*process_codes)).select(
        "folderrsn", "processrsn", "processcode", "assigneduser",
        col("statuscode").alias("process_statuscode"),
        "startdate", "enddate", "scheduledate", "scheduleenddate")
    vps = t.validprocessstatus.select(col("statuscode").alias("process_statuscode"),
                                      col("statusdesc").alias("process_status"))
    vu = t.validuser.select(col("userid").alias("assigneduser"), col("username").alias("reviewer"))
    pi = t.propertyinfo.filter(col("propertyinfocode") == COUNCIL_DISTRICT_INFO) \
        .select("propertyrsn", col("propinfovalue").alias("councildistrict"))
    return (folders.join(fp, "folderrsn", "inner")
            .join(t.validprocess, "processcode", "inner")
            .join(vu, "assigneduser", "left")
            .join(vps, "process_statuscode", "inner")
            .join(pi, "propertyrsn", "inner"))


def _numbered(t: PermitTables, rows: DataFrame, process_codes, dates: list[str]) -> DataFrame:
    """Distinct rows with their cycle number per folder and process code."""
    processes = t.folderprocess.filter(col("processcode").isin(*process_codes))
    return cycle_number(rows, ["folderrsn", "processcode"],
                        ["processrsn", "councildistrict", "reviewer", *dates, "process_status"], processes)


# R7 ------------------------------------------------------------------------
def lde_site_plan_revisions(t: PermitTables) -> DataFrame:
    """Land-development engineering reviews with their cycle number."""
    rows = (_process_rows(t, t.folder, LDE_PROCESSES)
            .join(t.validsub, "subcode", "left")
            .join(t.validstatus, "statuscode", "left"))
    distinct = rows.select(
        "foldertype", "folderrevision", "folderrsn", "subcode", "subdesc", "statusdesc",
        "foldercondition", "referencefile", "foldername", "reviewer", "processrsn",
        "processcode", col("processdesc").alias("process_name"),
        D.iso_seconds("startdate").alias("start_date"),
        D.iso_seconds("enddate").alias("end_date"),
        D.iso_seconds("scheduledate").alias("to_start"),
        D.iso_seconds("scheduleenddate").alias("to_end"),
        "process_status", "councildistrict").distinct()
    numbered = _numbered(t, distinct, LDE_PROCESSES, ["start_date", "end_date", "to_start", "to_end"])
    out = numbered.select(
        "foldertype", "folderrevision", "folderrsn", "subcode", "subdesc", "statusdesc",
        "foldercondition", "referencefile", "foldername", "reviewer", "processrsn",
        "process_name", "start_date", "end_date", "to_start", "to_end", "process_status",
        "cyclenumber", "councildistrict")
    return _sorted(out, "reviewer", "foldertype", "process_name", "processrsn")


# R10 -----------------------------------------------------------------------
def tds_cases(t: PermitTables) -> DataFrame:
    """Transportation development review processes with their cycle number."""
    rows = _process_rows(t, t.folder.filter(_ftype(*TDS_FOLDER_TYPES)), TDS_PROCESSES)
    distinct = rows.select(
        "foldertype", "folderrsn", "referencefile", "foldername", "reviewer", "processrsn",
        "processcode", col("processdesc").alias("processname"),
        D.iso_seconds("scheduledate").alias("tostart_date"),
        D.iso_seconds("scheduleenddate").alias("duedate"),
        D.iso_seconds("startdate").alias("started_date"),
        D.iso_seconds("enddate").alias("ended_date"),
        "process_status", "councildistrict").distinct()
    numbered = _numbered(t, distinct, TDS_PROCESSES, ["started_date", "ended_date", "tostart_date", "duedate"])
    out = numbered.select(
        "foldertype", "folderrsn", "referencefile", "foldername", "reviewer", "processrsn",
        "processname", "tostart_date", "duedate", "started_date", "ended_date",
        "process_status", "cyclenumber", "councildistrict")
    return _sorted(out, "reviewer", "foldertype", "processname", "processrsn")


# R8 ------------------------------------------------------------------------
def _inspector_folder_filter():
    rw = _ftype("RW") & (col("subcode") == TURP) & X.not_like_prefix("foldername", "LA-")
    return (col("statuscode") == ACTIVE) & (rw | _ftype("EX", "DS"))


def inspection_process_stats(t: PermitTables, folders: DataFrame) -> DataFrame:
    """Per ROW-inspection process of ``folders``: open deficiency count and last attempt.

    Deficiencies and attempts are cut to those processes, by a semi-join on the
    key they are grouped by next, then aggregated per process, so the joins below
    see at most one row per process on the right.
    """
    procs = (t.folderprocess.filter(col("processcode") == ROW_INSPECTION).select("folderrsn", "processrsn")
             .join(folders, "folderrsn", "left_semi"))
    wanted = procs.select("processrsn")
    defs = (t.folderprocessdeficiency.filter(col("statuscode") == OPEN_DEFICIENCY).join(wanted, "processrsn", "left_semi")
            .groupBy("processrsn").agg(F.count("processrsn").alias("n_def")))
    last = t.folderprocessattempt.join(wanted, "processrsn", "left_semi").groupBy("processrsn").agg(F.max("attemptdate").alias("most_recent_inspection"))
    return (procs.join(defs, "processrsn", "left").join(last, "processrsn", "left")
            .select("folderrsn", "processrsn", F.coalesce(col("n_def"), F.lit(0)).alias("n_def"),
                    "most_recent_inspection"))


def row_inspector_permit_list(t: PermitTables) -> DataFrame:
    """Active ROW permits with contractor, durations and inspection facts.

    One row per (permit, matching contact, ROW-inspection process): the
    contact and process joins fan out exactly as the report does. Tables with
    the history of all folders are cut to the active ones by semi-joins on the
    folder key, which they are shuffled by for the next join anyway; where the
    active folders turn out small, Spark broadcasts their keys at run time.
    """
    f = (t.folder.filter(_inspector_folder_filter() & (col("priority") != 1))
         .select("folderrsn", "foldertype", "subcode", "workcode", "propertyrsn",
                 "referencefile", "foldername", "expirydate", "issuedate"))
    keys = f.select("folderrsn")
    prop = t.property.select("propertyrsn", "propertyname")
    links = t.folderpeople.filter(col("peoplecode").isin(RW_CONTACT, ROW_CONTRACTOR)).join(keys, "folderrsn", "left_semi")
    contacts = (links.join(t.people.select("peoplersn", "organizationname", "phone1"), "peoplersn", "left")
                .select(col("folderrsn").alias("c_folderrsn"), "peoplecode", "organizationname", "phone1"))
    # The contact code depends on the folder type; written as a CASE so the
    # join keeps the folder as its only key (and its partitioning).
    wants_contact = F.when(col("foldertype") == "RW", col("peoplecode") == RW_CONTACT) \
        .otherwise(col("peoplecode") == ROW_CONTRACTOR)
    info = eav.scalar_attributes(t.folderinfo.join(keys, "folderrsn", "left_semi"), "folderrsn", "infocode",
                                 "infovalue", PERMIT_INFO)
    j = (f.join(prop, "propertyrsn", "left")
         .join(contacts, (col("folderrsn") == col("c_folderrsn")) & wants_contact, "inner")
         .join(inspection_process_stats(t, keys), "folderrsn", "left")
         .join(info, "folderrsn", "left")
         .join(t.validsub, "subcode", "left")
         .join(t.validwork, "workcode", "left"))
    return j.select(
        col("subdesc").alias("permit_type"), "foldertype",
        col("referencefile").alias("permit"), "folderrsn",
        col("foldername").alias("folder_name"), col("propertyname").alias("property_name"),
        col("expirydate").alias("expiry_date"), col("issuedate").alias("issue_date"),
        col("organizationname").alias("contractor"), col("phone1").alias("phone"),
        col("workdesc").alias("rw_work_description"),
        D.whole_day_diff("issuedate", "expirydate").alias("wz_duration"),
        *[eav.checked_scalar(n, "folderinfo") for n in PERMIT_INFO],
        F.coalesce(col("n_def"), F.lit(0)).alias("count_deficiencies"),
        "most_recent_inspection")


# R9 ------------------------------------------------------------------------
def row_inspector_segment_list(t: PermitTables) -> DataFrame:
    """Street segments (properties of segment type) of active ROW permits."""
    f = t.folder.filter(_inspector_folder_filter()).select("folderrsn")
    fp = t.folderproperty.select("folderrsn", "propertyrsn", "propertyrelationcode")
    segs = t.property.filter(col("propcode") == SEGMENT_PROPCODE).select("propertyrsn")
    out = (fp.join(f, "folderrsn", "inner").join(segs, "propertyrsn", "inner")
           .select("folderrsn", "propertyrsn",
                   F.when(col("propertyrelationcode") == PRIMARY_RELATION, "TRUE")
                   .otherwise("FALSE").alias("is_primary")))
    return _sorted(out, "folderrsn")


# R11 -----------------------------------------------------------------------
def _primary_property(t: PermitTables, folders: DataFrame, existence_only: bool = False) -> DataFrame:
    """Folder x its primary folder-property row x property x segment GIS id.

    The folder-property join matches on (folder, folder's own property). When
    the caller de-duplicates anyway it is only an existence test (semi-join).
    """
    fp = t.folderproperty.select("folderrsn", "propertyrsn")
    f = folders.join(fp, ["folderrsn", "propertyrsn"], "left_semi" if existence_only else "inner")
    pi = t.propertyinfo.filter(col("propertyinfocode") == SEGMENT_GIS_INFO) \
        .select("propertyrsn", col("propinfovalue").alias("segm"))
    prop = t.property.alias("p").join(pi, "propertyrsn", "inner").select(
        "propertyrsn", _address("p").alias("address"), col("propertyroll").alias("roll"), "segm")
    return f.join(prop, "propertyrsn", "inner")


def tds_asmd_map(t: PermitTables) -> DataFrame:
    """SIF cases: primary property, fee totals and seven SIF attributes.

    Bills and free-form rows are cut to the SIF folders by semi-joins on the
    folder key, by which they are summed next.
    """
    f = (t.folder.filter(_ftype("SIF") & (col("statuscode") != VOID_APP))
         .join(t.validstatus, "statuscode", "inner")
         .select("folderrsn", "parentrsn", "propertyrsn", "statusdesc", "foldername"))
    keys = f.select("folderrsn")
    base = _primary_property(t, f)
    fees = (t.accountbill.join(keys, "folderrsn", "left_semi")
            .groupBy("folderrsn").agg(F.sum("totalpaid").alias("total_fees_paid")))
    units = (t.folderfreeform.join(keys, "folderrsn", "left_semi")
             .groupBy("folderrsn").agg(F.sum("f03").alias("total_affordability_units")))
    info = t.folderinfo.join(keys, "folderrsn", "left_semi")
    j = eav.attribute_join(base, info, "folderrsn", "infocode", "infovalue", SIF_INFO)
    j = j.join(fees, "folderrsn", "left").join(units, "folderrsn", "left")
    out = j.select(
        "folderrsn", "parentrsn",
        col("address").alias("primary_folder_property_address"),
        col("propertyrsn").alias("primary_folder_property_propid"),
        col("roll").alias("primary_folder_property_roll"),
        col("segm").alias("primary_folder_property_segm"),
        "statusdesc", "foldername", "total_fees_paid",
        "offset_amount", "row_dedication_value", "easement_dedication_value",
        "total_affordability_units", "council_district", "sif_district_area",
        "total_affordability_reduction", "transportation_land_use")
    return _sorted(out, "folderrsn")


# R12 -----------------------------------------------------------------------
def sif_payment_details(t: PermitTables) -> DataFrame:
    """Distinct non-void payment lines of SIF cases with fiscal period.

    Joins whose tables contribute no output column (free-form rows, bill
    fees, payments, status) only test existence under the DISTINCT and are
    written as semi-joins, so they never multiply rows.
    """
    f = (t.folder.filter(_ftype("SIF"))
         .join(t.validstatus.select("statuscode"), "statuscode", "left_semi")
         .join(t.folderfreeform.select("folderrsn"), "folderrsn", "left_semi")
         .select("folderrsn", "parentrsn", "propertyrsn"))
    base = _primary_property(t, f, existence_only=True)
    bills = (t.accountbill.select("folderrsn", "billnumber")
             .join(t.accountbillfee.select("folderrsn", "billnumber"), ["folderrsn", "billnumber"], "left_semi"))
    paid = t.accountpayment.filter(col("voidflag") != "Y").select("folderrsn", "paymentnumber")
    lines = (t.accountpaymentdetail.select("folderrsn", "billnumber", "paymentnumber",
                                           "paymentamount", "dategenerated")
             .join(bills, ["folderrsn", "billnumber"], "inner")
             .join(paid, ["folderrsn", "paymentnumber"], "left_semi"))
    info = t.folderinfo.join(f.select("folderrsn"), "folderrsn", "left_semi")
    j = eav.attribute_join(base.join(lines, "folderrsn", "inner"), info, "folderrsn",
                           "infocode", "infovalue", SIF_PAYMENT_INFO)
    out = j.select(
        "folderrsn", "parentrsn",
        col("address").alias("primary_folder_property"),
        col("propertyrsn").alias("primary_folder_property_propid"),
        col("roll").alias("primary_folder_property_roll"),
        col("segm").alias("primary_folder_property_segm"),
        "council_district", "sif_district_area", "paymentnumber", "paymentamount", "billnumber",
        D.iso_seconds("dategenerated").alias("paymentdate"),
        D.month_name_padded("dategenerated").alias("payment_month"),
        D.fiscal_quarter("dategenerated").alias("payment_quarter"),
        D.fiscal_year("dategenerated").alias("payment_fy")).distinct()
    return _sorted(out, "folderrsn")


REPORTS = {
    "applications_received": applications_received,
    "active_permits": active_permits,
    "issued_permits": issued_permits,
    "review_time": review_time,
    "ex_permits_issued": ex_permits_issued,
    "license_agreements_timeline": license_agreements_timeline,
    "lde_site_plan_revisions": lde_site_plan_revisions,
    "row_inspector_permit_list": row_inspector_permit_list,
    "row_inspector_segment_list": row_inspector_segment_list,
    "tds_cases": tds_cases,
    "tds_asmd_map": tds_asmd_map,
    "sif_payment_details": sif_payment_details,
}
