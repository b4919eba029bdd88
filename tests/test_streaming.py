"""Incremental tagging stream: new segment files are tagged once and upserted."""

import os

from pyspark.sql import functions as F

from curbwise.plans.tagging import segment_zone_tags
from curbwise.sources import sinks
from curbwise.sources.tables import PermitTables
from curbwise.streaming import segment_updates


def test_stream_tags_new_files_once(spark, tmp_path):
    t = PermitTables.from_fixture(spark, "/root/testdata/sf0.001")
    segs = t.segment
    src, target, ckpt = str(tmp_path / "in"), str(tmp_path / "road"), str(tmp_path / "ckpt")
    segs.filter(F.col("segment_id") % 2 == 0).write.parquet(os.path.join(src, "batch1"))

    q = segment_updates.start(spark, src + "/*", t, target, checkpoint=ckpt)
    q.awaitTermination(120)
    first = sinks.read_latest(spark, target).count()

    # a second arrival: the other segments; a re-run processes only this file
    segs.filter(F.col("segment_id") % 2 == 1).write.parquet(os.path.join(src, "batch2"))
    q = segment_updates.start(spark, src + "/*", t, target, checkpoint=ckpt)
    q.awaitTermination(120)
    got = sinks.read_latest(spark, target)
    expected = segment_zone_tags(t, "2022-06-01 00:00:00", full=True)
    assert first == segs.filter(F.col("segment_id") % 2 == 0).count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.select(*got.columns).collect()))
    n_versions = len(sinks.versions(spark, target))

    q = segment_updates.start(spark, src + "/*", t, target, checkpoint=ckpt)  # nothing new
    q.awaitTermination(120)
    assert len(sinks.versions(spark, target)) == n_versions
