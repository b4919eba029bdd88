"""Explicit schemas of the permit model (FIXTURES.md section 1).

Used when the model is read from CSV or JDBC, where nothing should be
inferred. Parquet sources carry their own schema and are checked against
these names.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, I, D, S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
TS = T.TimestampNTZType()
MONEY = T.DecimalType(18, 2)
POINT = T.StructType([T.StructField("x", D), T.StructField("y", D)])
GEOMETRY = T.ArrayType(T.ArrayType(POINT))


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable=(i != 0 or not key))
                         for i, (n, t, key) in enumerate(
                             (c if len(c) == 3 else (*c, False)) for c in cols)])


PERMIT_SCHEMAS: dict[str, T.StructType] = {
    "folder": _schema(("folderrsn", L, True), ("foldertype", S), ("subcode", I), ("statuscode", I),
                      ("foldername", S), ("priority", L), ("indate", TS), ("issuedate", TS),
                      ("expirydate", TS), ("customfoldernumber", S), ("folderyear", L),
                      ("foldersequence", L), ("referencefile", S), ("foldercondition", S),
                      ("folderrevision", S), ("propertyrsn", L), ("workcode", L), ("parentrsn", L)),
    "folderprocess": _schema(("processrsn", L, True), ("folderrsn", L), ("processcode", I),
                             ("statuscode", L), ("disciplinecode", I), ("assigneduser", L),
                             ("startdate", TS), ("enddate", TS), ("scheduledate", TS),
                             ("scheduleenddate", TS)),
    "folderprocessattempt": _schema(("processrsn", L), ("attemptdate", TS), ("resultcode", I)),
    "folderprocessdeficiency": _schema(("processrsn", L), ("statuscode", I)),
    "folderinfo": _schema(("folderrsn", L), ("infocode", I), ("infovalue", S)),
    "folderpeople": _schema(("folderrsn", L), ("peoplersn", L), ("peoplecode", I)),
    "people": _schema(("peoplersn", L, True), ("organizationname", S), ("phone1", S)),
    "folderproperty": _schema(("folderrsn", L), ("propertyrsn", L), ("propertyrelationcode", I)),
    "property": _schema(("propertyrsn", L, True), ("propertyname", S), ("propcode", I),
                        ("propertyroll", S), ("prophouse", S), ("propstreet", S),
                        ("propstreettype", S), ("propstreetdirection", S), ("propunittype", S),
                        ("propunit", S), ("propprovince", S), ("proppostal", S)),
    "propertyinfo": _schema(("propertyrsn", L), ("propertyinfocode", I), ("propinfovalue", S)),
    "folderfreeform": _schema(("folderrsn", L), ("f03", D)),
    "accountbill": _schema(("folderrsn", L), ("billnumber", I), ("totalpaid", MONEY)),
    "accountbillfee": _schema(("folderrsn", L), ("billnumber", I)),
    "accountpaymentdetail": _schema(("folderrsn", L), ("billnumber", I), ("paymentnumber", L),
                                    ("paymentamount", MONEY), ("dategenerated", TS)),
    "accountpayment": _schema(("folderrsn", L), ("paymentnumber", L), ("voidflag", S)),
    "validsub": _schema(("subcode", I), ("subdesc", S)),
    "validstatus": _schema(("statuscode", I), ("statusdesc", S)),
    "validprocess": _schema(("processcode", I), ("processdesc", S)),
    "validprocessstatus": _schema(("statuscode", I), ("statusdesc", S)),
    "validuser": _schema(("userid", L), ("username", S)),
    "validwork": _schema(("workcode", I), ("workdesc", S)),
    "request_ds_commercial": _schema(("request_id", L), ("created", TS)),
    "request_ds_residential": _schema(("request_id", L), ("created", TS)),
    "request_extension": _schema(("request_id", L), ("created", TS)),
    "segment": _schema(("segment_id", L, True), ("full_street_name", S), ("road_class", I),
                       ("modified_date", TS), ("path", GEOMETRY)),
    "inspector_zone": _schema(("objectid", L), ("zone_id", D), ("rings", GEOMETRY)),
    "dapcz_zone": _schema(("objectid", L), ("zone_id", S), ("rings", GEOMETRY)),
    "road_segment": _schema(("segment_id", L, True), ("full_street_name", S), ("road_class", I),
                            ("inspector_zone", D), ("dapcz_zone", S)),
}
