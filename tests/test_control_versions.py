"""Watermarks of a versioned control table: no advance is lost where jobs meet."""
import datetime as dt

from lakestrata.session import scratch_dir
from lakestrata.sources import control as W


def events(spark, *rows):
    return spark.createDataFrame([(s, e, dt.datetime(2024, 1, d)) for s, e, d in rows], "source string, entity_name string, file_ts timestamp_ntz")


def marks(spark, root, version=None):
    return {r.EntityName: r.WatermarkValue.day for r in W.read_control(spark, root, version).collect()}


def test_interleaved_jobs_lose_no_advance(spark, monkeypatch):
    root = scratch_dir(spark, "t-control")
    start = spark.createDataFrame([(1, "web", "a", dt.datetime(2024, 1, 1), None, "web")], W.WATERMARK_SCHEMA)
    assert W.control_version(spark, root) == 0 and W.commit_control(spark, root, start, 0)
    assert not W.commit_control(spark, root, start, 0) and W.control_version(spark, root) == 1
    real, meanwhile = W.commit_control, [("web", "a", 5), ("web", "b", 2)]

    def commit(spark, root, state, expected):
        if meanwhile:  # another job gets in between reading and committing, twice
            other = meanwhile.pop()
            monkeypatch.setattr(W, "commit_control", real)
            W.advance_control(spark, root, events(spark, other))
            monkeypatch.setattr(W, "commit_control", commit)
        return real(spark, root, state, expected)

    monkeypatch.setattr(W, "commit_control", commit)
    version = W.advance_control(spark, root, events(spark, ("web", "a", 3), ("web", "c", 4)))
    assert version == 4 and marks(spark, root) == {"a": 5, "b": 2, "c": 4}
    assert marks(spark, root, 1) == {"a": 1} and marks(spark, root, 2) == {"a": 1, "b": 2}
