"""Skewed data: one folder holds a third of all processes and attempts.

The same synthetic rows are loaded into Spark and DuckDB; the report plans
must equal the oracle SQL bodies.
"""

import random

import duckdb
import pandas as pd

from curbwise import oracle_sql as O
from curbwise.plans import reports
from curbwise.schemas import PERMIT_SCHEMAS
from curbwise.sources.tables import PermitTables
from helpers import VALID, ts
from oracle_check import canonical

HOT = 7
HOT_ACTIVE = 11  # an active EX permit with many inspection processes and two contractors


def _model():
    rnd = random.Random(5)
    folders = []
    for rsn in range(1, 301):
        folders.append({
            "folderrsn": rsn, "foldertype": "LM" if rsn == HOT else rnd.choice(["RW", "EX", "DS", "LM", "SP"]),
            "subcode": rnd.choice([50500, 50505, None]),
            "statuscode": 50010 if rsn == HOT else rnd.choice([50010, 50010, 56050, 50003]),
            "foldername": f"P-{rsn}", "priority": rnd.choice([1, 2, 3, None]),
            "indate": ts("2023-01-01 08:00:00"), "issuedate": ts("2023-02-01 09:00:00"),
            "expirydate": ts("2023-03-01 09:00:00"), "propertyrsn": rsn % 50, "workcode": rsn % 5,
            "referencefile": f"R-{rsn}", "folderrevision": "0", "foldercondition": "c",
            "customfoldernumber": f"CF-{rsn}"})
    procs, attempts = [], []
    for i in range(1, 3001):
        f = HOT if i % 3 == 0 else rnd.randint(1, 300)  # a third of all processes on one folder
        code = rnd.choice([70000, 51070, 51212, 51258, 50685])
        start = None if rnd.random() < 0.1 else ts(f"2023-01-{rnd.randint(1, 28):02d} 10:00:00")
        procs.append({"processrsn": i, "folderrsn": f, "processcode": code, "statuscode": rnd.randint(1, 3),
                      "disciplinecode": rnd.choice([50030, 50031]), "assigneduser": rnd.choice([1, None]),
                      "startdate": start, "enddate": ts(f"2023-02-{rnd.randint(1, 28):02d} 10:00:00"),
                      "scheduledate": ts("2023-01-01 00:00:00"), "scheduleenddate": ts("2023-01-11 00:00:00")})
        for _ in range(rnd.randint(0, 3)):
            attempts.append({"processrsn": i, "resultcode": rnd.choice([52130, 55000, 52131]),
                             "attemptdate": ts(f"2023-03-{rnd.randint(1, 28):02d} 0{rnd.randint(0, 9)}:00:00")})
    folders[HOT_ACTIVE - 1].update(foldertype="EX", statuscode=50010, priority=2)
    defs = []
    for i in range(5001, 5601):
        procs.append({"processrsn": i, "folderrsn": HOT_ACTIVE, "processcode": 50685, "statuscode": 1,
                      "startdate": ts("2023-01-02 10:00:00")})
        attempts.append({"processrsn": i, "resultcode": 52131,
                         "attemptdate": ts(f"2023-04-{rnd.randint(1, 28):02d} 10:00:00")})
        defs += [{"processrsn": i, "statuscode": rnd.choice([55360, 55361])} for _ in range(rnd.randint(0, 2))]
    people = [{"folderrsn": f["folderrsn"], "peoplersn": p, "peoplecode": rnd.choice([1, 50065, 2])}
              for f in folders for p in (1, 2)]
    people = [r for r in people if r["folderrsn"] != HOT_ACTIVE]
    people += [{"folderrsn": HOT_ACTIVE, "peoplersn": p, "peoplecode": 50065} for p in (1, 2)]
    info = [{"folderrsn": f["folderrsn"], "infocode": c, "infovalue": v}
            for f in folders for c, v in ((75390, "12"), (76110, "2023-01-05"), (76115, "2023-01-20"))]
    pinfo = [{"propertyrsn": p, "propertyinfocode": 52026, "propinfovalue": str(p % 10)} for p in range(50)]
    return {"folder": folders, "folderprocess": procs, "folderprocessattempt": attempts,
            "folderprocessdeficiency": defs, "folderpeople": people, "folderinfo": info,
            "people": [{"peoplersn": 1, "organizationname": "A", "phone1": "1"},
                       {"peoplersn": 2, "organizationname": "B", "phone1": "2"}],
            "property": [{"propertyrsn": p, "propertyname": f"S{p}", "propcode": 52010} for p in range(50)],
            "propertyinfo": pinfo, **VALID}


def _load(spark, data):
    frames, con = {}, duckdb.connect()
    for name, schema in PERMIT_SCHEMAS.items():
        cols = [f.name for f in schema.fields]
        rows = data.get(name, [])
        frames[name] = spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], schema)
        pdf = pd.DataFrame([{c: r.get(c) for c in cols} for r in rows], columns=cols)
        con.register(f"_{name}", pdf)
        casts = ", ".join(f"CAST({c} AS {_duck(f.dataType.simpleString())}) AS {c}" for c, f in zip(cols, schema.fields))
        con.execute(f"CREATE VIEW {name} AS SELECT {casts} FROM _{name}")
    return PermitTables(spark, {n: (lambda df=df: df) for n, df in frames.items()}), con


def _duck(t: str) -> str:
    return {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
            "timestamp_ntz": "TIMESTAMP", "decimal(18,2)": "DECIMAL(18,2)"}.get(t, "VARCHAR")


def _same(df, con, sql):
    rel = con.execute(sql)
    d_cols = [c[0] for c in rel.description]
    return canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(d_cols, rel.fetchall())


def test_reports_on_a_hot_folder_match_sql(spark):
    t, con = _load(spark, _model())
    r7 = reports.lde_site_plan_revisions(t)
    assert r7.filter(f"folderrsn = {HOT}").groupBy("process_name").count().agg({"count": "max"}).first()[0] > 50
    assert _same(r7, con, O.R7)
    r4, r6 = reports.review_time(t), reports.license_agreements_timeline(t)
    assert r4.count() > 0 and r6.filter(f"folderrsn = {HOT}").count() == 1
    assert _same(r4, con, O.R4)
    assert _same(r6, con, O.R6)


def test_permit_list_with_a_hot_active_folder_matches_sql(spark):
    t, con = _load(spark, _model())
    r8 = reports.row_inspector_permit_list(t)
    assert r8.filter(f"folderrsn = {HOT_ACTIVE}").count() == 1200  # 600 processes x 2 contractors
    assert _same(r8, con, O.R8)
