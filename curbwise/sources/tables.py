"""Access to the permit model as DataFrames.

``PermitTables`` is a lazy name -> DataFrame mapping. The plans only read
attributes (``t.folder``, ``t.folderprocess`` ...), so the same plan runs on

* ``PermitTables.from_parquet(spark, root)`` — one parquet dataset per table
  (the production layout, e.g. a nightly JDBC extract, see ``jdbc.py``);
* ``PermitTables.from_fixture(spark, sf_dir)`` — the deterministic mapping of
  the driver tables (``fixtures.py``), derived on the fly so Catalyst prunes
  and pushes filters straight into the driver parquet scans.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbwise.schemas import PERMIT_SCHEMAS
from curbwise.sources import fixtures


class PermitTables:
    def __init__(self, spark: SparkSession, loaders: dict[str, Callable[[], DataFrame]]):
        self.spark = spark
        self._loaders = loaders
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        frames = self.__dict__.get("_frames")
        if frames is None:
            raise AttributeError(name)
        if name not in frames:
            loaders = self.__dict__["_loaders"]
            if name not in loaders:
                raise AttributeError(f"no permit table {name!r}")
            frames[name] = loaders[name]()
        return frames[name]

    def names(self) -> list[str]:
        return sorted(self._loaders)

    def has(self, name: str) -> bool:
        return name in self._loaders

    def with_table(self, name: str, df: DataFrame) -> "PermitTables":
        """Copy with one table replaced (e.g. a published road dataset)."""
        loaders = dict(self._loaders)
        loaders[name] = lambda: df
        return PermitTables(self.spark, loaders)

    # -- constructors -------------------------------------------------------
    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> "PermitTables":
        """Every source table at ``root/<table>``; a table is read when first used.

        ``road_segment`` is a published result, not a source table: add it with ``with_table``.
        """
        def reader(name):
            # select in model order: partition columns come back last otherwise
            cols = [f.name for f in PERMIT_SCHEMAS[name].fields]
            return lambda: spark.read.parquet(f"{root.rstrip('/')}/{name}").select(*cols)
        return cls(spark, {n: reader(n) for n in PERMIT_SCHEMAS if n != "road_segment"})

    @classmethod
    def from_tables(cls, spark: SparkSession, database: str) -> "PermitTables":
        """Every source table of a database that ``jdbc.extract_to_tables`` wrote; read when first used."""
        def reader(name):
            cols = [f.name for f in PERMIT_SCHEMAS[name].fields]
            return lambda: spark.table(f"{database}.{name}").select(*cols)
        return cls(spark, {n: reader(n) for n in PERMIT_SCHEMAS if n != "road_segment"})

    @classmethod
    def from_fixture(cls, spark: SparkSession, sf_dir: str) -> "PermitTables":
        """The fixture model over the driver tables in ``sf_dir``; nothing is read before it is used."""
        driver: dict[str, DataFrame] = {}

        def table(name: str) -> DataFrame:
            if name not in driver:
                driver[name] = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
            return driver[name]

        def derived(name: str) -> Callable[[], DataFrame]:
            def load() -> DataFrame:
                refs = {t: table(t) for t in fixtures.tables_used(name)}
                return spark.sql(fixtures.spark_sql_text(name), **refs)
            return load

        loaders = {n: derived(n) for n in fixtures.TEMPLATES}
        inst: PermitTables

        def segment() -> DataFrame:
            return segments_with_paths(inst.segment_attrs, inst.segment_edge)

        loaders["segment"] = segment
        loaders["inspector_zone"] = lambda: zones_from_boxes(inst.inspector_zone_box)
        loaders["dapcz_zone"] = lambda: zones_from_boxes(inst.dapcz_box)
        inst = cls(spark, loaders)
        return inst


def segments_with_paths(attrs: DataFrame, edges: DataFrame) -> DataFrame:
    """One polyline per segment from its ordered edges (fixture geometry).

    The group is one segment's edges (three in the fixture), so the
    collect_list is bounded by the vertex count of a single street segment.
    """
    pts = (edges.groupBy("segment_id")
           .agg(F.array_sort(F.collect_list(F.struct("edge_no", "x1", "y1", "x2", "y2"))).alias("e")))
    path = F.concat(
        F.array(F.struct(F.col("e")[0]["x1"].alias("x"), F.col("e")[0]["y1"].alias("y"))),
        F.transform("e", lambda s: F.struct(s["x2"].alias("x"), s["y2"].alias("y"))))
    paths = pts.select("segment_id", F.array(path).alias("path"))
    return attrs.join(paths, "segment_id", "left")


def zones_from_boxes(boxes: DataFrame) -> DataFrame:
    """Axis-aligned boxes as closed polygon rings (fixture geometry)."""
    def pt(x, y):
        return F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ring = F.array(pt("xmin", "ymin"), pt("xmax", "ymin"), pt("xmax", "ymax"),
                   pt("xmin", "ymax"), pt("xmin", "ymin"))
    return boxes.select("objectid", "zone_id", F.array(ring).alias("rings"))
