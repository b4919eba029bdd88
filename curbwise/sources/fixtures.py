"""Deterministic mapping of the driver's parquet tables onto the permit model.

Each permit table is one SQL statement (FIXTURES.md section 2) written once as a
template and rendered for two engines:

* Spark: table references become DataFrames passed to ``spark.sql`` and the
  small fan-out lists become ``LATERAL VIEW`` generators (explode / stack),
  so the derived tables are plain projections/generators over one scan.
* DuckDB (the oracle): table references are the pre-registered views and the
  fan-out lists become ``VALUES`` lists.

Template markers: ``{orders}`` is a table reference; ``<<k: 0,1,2>>`` and
``<<c,d: (1,2),(3,4)>>`` are fan-out lists.
"""

from __future__ import annotations

import re

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")

_PROCESSRSN = ("((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey")
_SHIFT = "INTERVAL '8036' DAY"

_DATE = f"CAST(o_orderdate + {_SHIFT} + d * INTERVAL '1' DAY AS DATE)"


def _two(part: str) -> str:
    return f"LPAD(CAST({part}({_DATE}) AS VARCHAR(20)), 2, '0')"


# The attribute dates as text, in four layouts by folder.
_TEXT_DATE = f"""CASE o_orderkey % 4
    WHEN 0 THEN CAST({_DATE} AS VARCHAR(20))
    WHEN 1 THEN CONCAT({_two('MONTH')}, '/', {_two('DAY')}, '/', CAST(YEAR({_DATE}) AS VARCHAR(20)), ' 03:04 PM')
    WHEN 2 THEN CONCAT({_two('MONTH')}, '/', {_two('DAY')}, '/', LPAD(CAST(YEAR({_DATE}) % 100 AS VARCHAR(20)), 2, '0'))
    ELSE CONCAT(CAST({_DATE} AS VARCHAR(20)), 'T10:00:00Z') END"""

# Fixed values of the mapping (FIXTURES.md section 2): codes, descriptions and
# moduli chosen so that every branch of every report is exercised.
TEMPLATES: dict[str, str] = {
    "folder": f"""
SELECT o_orderkey AS folderrsn,
  CASE o_orderkey % 8 WHEN 0 THEN 'RW' WHEN 1 THEN 'EX' WHEN 2 THEN 'DS' WHEN 3 THEN 'LM'
    WHEN 4 THEN 'SIF' WHEN 5 THEN 'SP' WHEN 6 THEN 'C8' ELSE 'RW' END AS foldertype,
  CASE o_orderkey % 5 WHEN 0 THEN 50500 WHEN 1 THEN 50500 WHEN 2 THEN 50505 WHEN 3 THEN 50510 END AS subcode,
  CASE o_orderkey % 13 WHEN 0 THEN 70045 WHEN 1 THEN 50003 WHEN 2 THEN 50005 WHEN 3 THEN 56050 ELSE 50010 END AS statuscode,
  CONCAT(CASE WHEN o_orderkey % 11 = 0 THEN 'LA-' ELSE 'P-' END, CAST(o_orderkey AS VARCHAR(20))) AS foldername,
  CASE WHEN o_orderkey % 17 <> 0 THEN o_orderkey % 3 + 1 END AS priority,
  o_orderdate + {_SHIFT} + (o_orderkey * 7919 % 86400) * INTERVAL '1' SECOND AS indate,
  CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate + {_SHIFT} + (o_orderkey * 104729 % 4000000) * INTERVAL '1' SECOND END AS issuedate,
  o_orderdate + {_SHIFT} + (o_orderkey * 31 % 90) * INTERVAL '1' DAY + INTERVAL '9' HOUR AS expirydate,
  CONCAT('CF-', CAST(o_orderkey AS VARCHAR(20))) AS customfoldernumber,
  20 + o_orderkey % 4 AS folderyear, 100000 + o_orderkey AS foldersequence,
  CONCAT('2022-', CAST(o_orderkey AS VARCHAR(20))) AS referencefile,
  o_orderpriority AS foldercondition, CAST(o_orderkey % 3 AS VARCHAR(5)) AS folderrevision,
  o_custkey AS propertyrsn, o_custkey % 7 AS workcode, o_orderkey % 100 AS parentrsn
FROM {{orders}}""",
    "folderprocess": f"""
SELECT {_PROCESSRSN} AS processrsn, l_orderkey AS folderrsn,
  CASE l_partkey % 9 WHEN 0 THEN 70000 WHEN 1 THEN 51070 WHEN 2 THEN 50685 WHEN 3 THEN 51132
    WHEN 4 THEN 51834 WHEN 5 THEN 84102 WHEN 6 THEN 51212 WHEN 7 THEN 51258 ELSE 51259 END AS processcode,
  l_suppkey % 4 + 1 AS statuscode, CASE WHEN l_suppkey % 3 = 0 THEN 50030 ELSE 50031 END AS disciplinecode,
  CASE WHEN l_suppkey % 10 <> 0 THEN l_suppkey % 25 END AS assigneduser,
  CASE WHEN l_partkey % 23 <> 0 THEN l_shipdate + {_SHIFT} END AS startdate,
  CASE WHEN l_linestatus = 'F' THEN l_shipdate + {_SHIFT} + l_linenumber * INTERVAL '1' DAY END AS enddate,
  l_shipdate + {_SHIFT} - INTERVAL '2' DAY AS scheduledate,
  l_shipdate + {_SHIFT} + INTERVAL '10' DAY AS scheduleenddate
FROM {{lineitem}}""",
    "folderprocessattempt": f"""
SELECT {_PROCESSRSN} AS processrsn, l_shipdate + {_SHIFT} + k * INTERVAL '30' HOUR AS attemptdate,
  CASE (l_suppkey + k) % 3 WHEN 0 THEN 52130 WHEN 1 THEN 55000 ELSE 52131 END AS resultcode
FROM {{lineitem}} <<k: 0,1,2>> WHERE (l_suppkey + l_partkey + k) % 3 <> 0""",
    "folderprocessdeficiency": f"""
SELECT {_PROCESSRSN} AS processrsn, CASE (l_suppkey + k) % 2 WHEN 0 THEN 55360 ELSE 55361 END AS statuscode
FROM {{lineitem}} <<k: 0,1,2>> WHERE l_returnflag = 'R'""",
    "folderinfo": f"""
SELECT o_orderkey AS folderrsn, c AS infocode,
  CASE WHEN c IN (75980,76110,75993,75994,76115) THEN {_TEXT_DATE}
       WHEN c = 75390 AND o_orderkey % 41 = 0 THEN 'n/a' ELSE CAST((o_orderkey * 31 + c) % 60 AS VARCHAR(20)) END AS infovalue
FROM {{orders}} <<c,d: (75390,0),(75980,1),(76110,2),(76115,12),(75993,20),(75994,45),(84011,0),(84012,0),(84016,0),(84021,0),(84040,0),(84043,0),(84044,0)>>
WHERE (o_orderkey * 7 + c) % 19 <> 0 AND (c NOT IN (75993,75994) OR o_orderkey % 3 = 0)
UNION ALL SELECT o_orderkey, 84040, 'second' FROM {{orders}} WHERE o_orderkey % 29 = 0""",
    "folderpeople": """
SELECT o_orderkey AS folderrsn, (o_orderkey + k) % 10 AS peoplersn,
  CASE k WHEN 0 THEN 1 WHEN 1 THEN 50065 WHEN 2 THEN 2 ELSE 50065 END AS peoplecode
FROM {orders} <<k: 0,1,2,3>> WHERE (o_orderkey + k) % 7 <> 0 AND (k < 3 OR o_orderkey % 12 = 1)""",
    "people": """
SELECT s_suppkey AS peoplersn, s_name AS organizationname,
  CONCAT('512-', CAST(1000 + s_nationkey AS VARCHAR(10))) AS phone1 FROM {supplier}""",
    "property": """
SELECT c_custkey AS propertyrsn, c_name AS propertyname, CASE WHEN c_custkey % 3 = 0 THEN 52011 ELSE 52010 END AS propcode,
  CONCAT('R', CAST(c_custkey AS VARCHAR(20))) AS propertyroll, CAST(c_custkey AS VARCHAR(20)) AS prophouse, c_mktsegment AS propstreet,
  CASE WHEN c_custkey % 2 = 0 THEN 'ST' END AS propstreettype, CASE WHEN c_custkey % 4 = 0 THEN 'N' END AS propstreetdirection,
  CASE WHEN c_custkey % 6 = 0 THEN 'APT' END AS propunittype, CASE WHEN c_custkey % 6 = 0 THEN CAST(c_nationkey AS VARCHAR(10)) END AS propunit,
  'TX' AS propprovince, CAST(78700 + c_nationkey AS VARCHAR(10)) AS proppostal FROM {customer}""",
    "propertyinfo": """
SELECT c_custkey AS propertyrsn, c AS propertyinfocode, CAST((c_custkey + c) % 10 + 1 AS VARCHAR(10)) AS propinfovalue
FROM {customer} <<c: 52026,55005>> WHERE (c_custkey + c) % 8 <> 0""",
    "folderproperty": """
SELECT o_orderkey AS folderrsn, o_custkey + k AS propertyrsn, CASE k WHEN 0 THEN 5 WHEN 1 THEN 1 END AS propertyrelationcode
FROM {orders} <<k: 0,1,2>> WHERE k <= o_orderkey % 4""",
    "folderfreeform": """
SELECT o_orderkey AS folderrsn, CAST(o_orderkey % 20 + k AS DOUBLE) AS f03 FROM {orders} <<k: 0,1>> WHERE o_orderkey % 3 <> 0""",
    "accountbill": """
SELECT o_orderkey AS folderrsn, k AS billnumber, CAST(o_orderkey % 1000 AS DOUBLE) * k + 0.25 AS totalpaid
FROM {orders} <<k: 1,2>> WHERE o_orderkey % 7 <> 0""",
    "accountbillfee": """
SELECT o_orderkey AS folderrsn, k AS billnumber FROM {orders} <<k: 1,1,2>> WHERE o_orderkey % 7 <> 0""",
    "accountpaymentdetail": f"""
SELECT o_orderkey AS folderrsn, k AS billnumber, o_orderkey * 10 + k AS paymentnumber,
  CAST(o_orderkey % 500 AS DOUBLE) + 0.5 AS paymentamount,
  o_orderdate + {_SHIFT} + (o_orderkey * k * 611 % 9000000) * INTERVAL '1' SECOND AS dategenerated
FROM {{orders}} <<k: 1,2>> WHERE o_orderkey % 7 <> 0""",
    "accountpayment": """
SELECT o_orderkey AS folderrsn, o_orderkey * 10 + k AS paymentnumber,
  CASE o_orderkey % 5 WHEN 0 THEN 'Y' WHEN 1 THEN NULL ELSE 'N' END AS voidflag FROM {orders} <<k: 1,2>>""",
    "validsub": """
SELECT * FROM (VALUES (50500,'TURP'),(50505,'Sub 505'),(50510,'Sub 510')) t(subcode, subdesc)""",
    "validstatus": """
SELECT * FROM (VALUES (50010,'Active'),(50003,'Withdrawn'),(50005,'Rejected'),(56050,'Void')) t(statuscode, statusdesc)""",
    "validprocess": """
SELECT * FROM (VALUES (51132,'TDS A'),(51834,'TDS B'),(84102,'TDS C'),(51212,'LDE A'),(51258,'LDE B'),(51259,'LDE C')) t(processcode, processdesc)""",
    "validprocessstatus": """
SELECT * FROM (VALUES (1,'Open'),(2,'In Review'),(3,'Closed')) t(statuscode, statusdesc)""",
    "validuser": """
SELECT n_nationkey AS userid, n_name AS username FROM {nation} WHERE n_nationkey <> 7""",
    "validwork": """
SELECT * FROM (VALUES (0,'Boring'),(1,'Crane'),(2,'Event'),(3,'Paving'),(4,'Utility')) t(workcode, workdesc)""",
    "request_ds_commercial": """
SELECT event_id AS request_id, ts - (event_id % 1000) * INTERVAL '1' DAY AS created FROM {events} WHERE event_type IN ('signup', 'click')""",
    "request_ds_residential": """
SELECT event_id AS request_id, ts - (event_id % 1000) * INTERVAL '1' DAY AS created FROM {events} WHERE event_type IN ('purchase', 'view')""",
    "request_extension": """
SELECT event_id AS request_id, ts - (event_id % 1000) * INTERVAL '1' DAY AS created FROM {events} WHERE event_type NOT IN ('signup', 'click', 'purchase', 'view')""",
    "segment_attrs": """
SELECT c_custkey AS segment_id, CONCAT(c_mktsegment, ' ', CAST(c_nationkey AS VARCHAR(10))) AS full_street_name,
  CAST(c_custkey % 12 AS INT) AS road_class,
  TIMESTAMP '2022-06-01 00:00:00' - (c_custkey % 60) * INTERVAL '1' DAY AS modified_date FROM {customer}""",
    "segment_edge": """
SELECT c_custkey AS segment_id, k AS edge_no, CAST(c_custkey * 37 % 1000 + k * 15 AS DOUBLE) AS x1,
  CAST(c_custkey * 91 % 1000 + k * 10 AS DOUBLE) AS y1, CAST(c_custkey * 37 % 1000 + (k + 1) * 15 AS DOUBLE) AS x2,
  CAST(c_custkey * 91 % 1000 + (k + 1) * 10 AS DOUBLE) AS y2 FROM {customer} <<k: 0,1,2>>""",
    "inspector_zone_box": """
SELECT n_nationkey AS objectid, CAST(n_nationkey % 9 + 1 AS DOUBLE) AS zone_id,
  CAST(n_nationkey % 5 * 200 AS DOUBLE) AS xmin, CAST(n_nationkey % 5 * 200 + 190 AS DOUBLE) AS xmax,
  CAST((n_nationkey - n_nationkey % 5) * 40 AS DOUBLE) AS ymin, CAST((n_nationkey - n_nationkey % 5) * 40 + 210 AS DOUBLE) AS ymax
FROM {nation}""",
    "dapcz_box": """
SELECT r_regionkey AS objectid, CONCAT('D', CAST(r_regionkey AS VARCHAR(3))) AS zone_id,
  CAST(r_regionkey * 130 AS DOUBLE) AS xmin, CAST(r_regionkey * 130 + 150 AS DOUBLE) AS xmax,
  CAST(400 AS DOUBLE) AS ymin, CAST(550 AS DOUBLE) AS ymax FROM {region}""",
}

# Fixed clock of the fixtures: the "now" of every time-relative rule.
AS_OF = "2022-06-01 00:00:00"

_FANOUT = re.compile(r"<<\s*([a-z_, ]+):\s*(.*?)>>", re.S)
_TABLE = re.compile(r"\{([a-z_]+)\}")


def _split_tuples(body: str) -> list[list[str]]:
    body = body.strip()
    if body.startswith("("):
        return [[v.strip() for v in t.split(",")] for t in re.findall(r"\(([^()]*)\)", body)]
    return [[v.strip()] for v in body.split(",")]


def _spark_fanout(m: re.Match) -> str:
    cols = [c.strip() for c in m.group(1).split(",")]
    rows = _split_tuples(m.group(2))
    if len(cols) == 1:
        return f"LATERAL VIEW explode(array({', '.join(r[0] for r in rows)})) fan AS {cols[0]}"
    flat = ", ".join(v for r in rows for v in r)
    return f"LATERAL VIEW stack({len(rows)}, {flat}) fan AS {', '.join(cols)}"


def _duck_fanout(m: re.Match) -> str:
    cols = [c.strip() for c in m.group(1).split(",")]
    rows = _split_tuples(m.group(2))
    values = ", ".join("(" + ", ".join(r) + ")" for r in rows)
    return f"CROSS JOIN (VALUES {values}) fan({', '.join(cols)})"


def tables_used(name: str) -> list[str]:
    return sorted(set(_TABLE.findall(TEMPLATES[name])))


def spark_sql_text(name: str) -> str:
    """Template rendered for ``spark.sql(text, **dataframes)``."""
    return _FANOUT.sub(_spark_fanout, TEMPLATES[name])


def duckdb_sql_text(name: str) -> str:
    """Template rendered for DuckDB with the driver's pre-registered views."""
    text = _FANOUT.sub(_duck_fanout, TEMPLATES[name])
    return _TABLE.sub(lambda m: m.group(1), text)
