import json
import os

import pytest

from conftest import SF_SMALL, rows
from engage.sources import fixtures as FX
from engage.streaming import events as ST


def test_permissive_parse(spark):
    df = spark.createDataFrame(
        [("bad",), ('{"Click":"x","UserID":"U2"}',),
         ('{"UserID":"U1","NewsID":"N1","Category":"c","Click":1}',)], "value string")
    got = rows(ST.parse_events(df))
    assert (None, None, None, None) in got
    assert ("U2", None, None, None) in got
    assert ("U1", "N1", "c", 1) in got
    assert len(rows(ST.parse_events(df, drop_malformed=True))) == 2


def test_json_roundtrip(spark):
    vals = FX.event_values(spark, SF_SMALL)
    parsed = ST.parse_events(vals)
    again = ST.parse_events(ST.events_to_json(parsed))
    assert rows(parsed) == rows(again)


def test_stream_equals_batch(spark, tmp_path):
    src = tmp_path / "in"
    os.makedirs(src)
    batch = FX.event_values(spark, SF_SMALL).select("value")
    # the producer: write messages as JSON lines files
    batch.write.mode("overwrite").json(str(src / "part1"))
    stream = ST.read_event_stream(spark, "json", path=str(src / "part1"))
    q = ST.write_stream(ST.parse_events(stream), "parquet",
                        checkpoint=str(tmp_path / "ckpt"), path=str(tmp_path / "out"),
                        trigger={"availableNow": True})
    q.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert rows(out) == rows(ST.parse_events(batch))
    # restart from the checkpoint: nothing is processed twice
    q2 = ST.write_stream(ST.parse_events(ST.read_event_stream(spark, "json",
                                                              path=str(src / "part1"))),
                         "parquet", checkpoint=str(tmp_path / "ckpt"),
                         path=str(tmp_path / "out"), trigger={"availableNow": True})
    q2.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == batch.count()


def test_plain_consumer(spark):
    df = spark.createDataFrame([(bytearray(json.dumps({"a": 1}).encode()),)], "value binary")
    assert ST.message_text(df).first().value == '{"a": 1}'


def test_a_killed_stream_resumes_and_writes_each_event_once(spark, tmp_path, monkeypatch):
    src, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    os.makedirs(src)
    want = []
    for f in range(6):
        lines = [json.dumps({"value": json.dumps({"UserID": f"U{f}", "NewsID": f"N{f}-{i}", "Category": "c", "Click": 1})})
                 for i in range(5)]
        want += [f"N{f}-{i}" for i in range(5)]
        (tmp_path / "in" / f"{f}.json").write_text("\n".join(lines) + "\n")

    def start():
        events = ST.parse_events(ST.read_event_stream(spark, "json", {"maxFilesPerTrigger": "1"}, path=src))
        return ST.append_once(events, out, ckpt, trigger={"availableNow": True})
    write, seen = ST._write_batch, []

    def dies(batch, batch_id, path):
        """Dies after the write of batch 2 and before it is committed, and in
        the middle of batch 4."""
        seen.append(batch_id)
        if batch_id == 4 and seen.count(4) == 1:
            batch.limit(2).write.mode("overwrite").parquet(f"{path}/{ST.BATCH}=4")
            os.remove(f"{path}/{ST.BATCH}=4/_SUCCESS")
            raise RuntimeError("executor lost")
        write(batch, batch_id, path)
        if batch_id == 2 and seen.count(2) == 1:
            raise RuntimeError("driver lost")
    monkeypatch.setattr(ST, "_write_batch", dies)
    for n in (15, 20):                                      # whole batches seen after each crash
        with pytest.raises(Exception, match="lost"):
            start().awaitTermination()
        assert ST.read_batches(spark, out).count() == n
    start().awaitTermination()
    assert sorted(r.NewsID for r in ST.read_batches(spark, out).collect()) == sorted(want)
    assert seen == [0, 1, 2, 2, 3, 4, 4, 5]
    start().awaitTermination()                              # nothing new: nothing written
    assert len(seen) == 8
    assert ST.read_batches(spark, str(tmp_path / "none")).collect() == []


def test_stream_job_as_plain_text(spark, tmp_path):
    from engage.plans import jobs as J
    src = str(tmp_path / "in")
    FX.event_values(spark, SF_SMALL).select("value").write.json(src)
    q = J.stream_job(spark, "json", {}, "once", str(tmp_path / "ckpt"), path=str(tmp_path / "out"), source_path=src,
                     trigger={"availableNow": True}, parse=False)
    q.awaitTermination()
    got = ST.read_batches(spark, str(tmp_path / "out"), ST.VALUE_SCHEMA)
    assert rows(got) == rows(FX.event_values(spark, SF_SMALL).select("value"))
