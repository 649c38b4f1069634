from __future__ import annotations

from armlens.operators import staging
from armlens.sources.events_csv import write_events_csv
from armlens.sources.layers import read_layer
from armlens.streaming.landing import events_stream, land_stream
from conftest import event


def arrive(envelope, folder, name, rows):
    write_events_csv(envelope(rows), f"{folder}/{name}")


def test_each_file_lands_once_and_first_delivery_wins_over_batches(spark, envelope, tmp_path):
    incoming, root = str(tmp_path / "incoming"), str(tmp_path / "out")

    def start():
        land_stream(events_stream(spark, f"{incoming}/*", files_per_batch=1), root).awaitTermination()
        return read_layer(spark, root, "raw_events")

    arrive(envelope, incoming, "day1", [event("e1", session="first"), event("e2", note='a "quote"')])
    assert start().count() == 2
    arrive(envelope, incoming, "day2", [event("e1", session="again"), event("e3", arm="Z")])
    raw = start()
    assert raw.count() == 4 and start().count() == 4
    assert {r._source_file[-4:] for r in raw.collect()} == {".csv"}
    assert {(r.event_id, r.session_id) for r in staging.stage(raw).collect()} == {("e1", "first"), ("e2", "s1")}
    assert [r.event_id for r in staging.rejects(raw).collect()] == ["e3"]
