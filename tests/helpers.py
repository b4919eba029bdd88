"""Build small in-memory permit models for golden-case tests."""

from __future__ import annotations

import datetime as dt

from curbwise.schemas import PERMIT_SCHEMAS
from curbwise.sources.tables import PermitTables


def ts(text: str) -> dt.datetime:
    fmt = "%Y-%m-%d %H:%M:%S" if len(text) > 10 else "%Y-%m-%d"
    return dt.datetime.strptime(text, fmt)


def frame(spark, table: str, rows: list[dict]):
    schema = PERMIT_SCHEMAS[table]
    names = [f.name for f in schema.fields]
    for r in rows:
        unknown = set(r) - set(names)
        assert not unknown, f"{table}: unknown columns {unknown}"
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def tables(spark, **data: list[dict]) -> PermitTables:
    """PermitTables where every table is empty unless rows are given."""
    loaders = {}
    for name in PERMIT_SCHEMAS:
        rows = data.get(name, [])
        loaders[name] = (lambda n=name, r=rows: frame(spark, n, r))
    return PermitTables(spark, loaders)


VALID = {
    "validsub": [{"subcode": 50500, "subdesc": "TURP"}, {"subcode": 50505, "subdesc": "Sub 505"}],
    "validstatus": [{"statuscode": 50010, "statusdesc": "Active"}, {"statuscode": 56050, "statusdesc": "Void"}],
    "validprocess": [{"processcode": 51212, "processdesc": "LDE A"}, {"processcode": 51258, "processdesc": "LDE B"}],
    "validprocessstatus": [{"statuscode": 1, "statusdesc": "Open"}],
    "validuser": [{"userid": 1, "username": "ana"}],
    "validwork": [{"workcode": 1, "workdesc": "Crane"}],
}
