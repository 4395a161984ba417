"""Progress and backlog of a stream that is stopped half way, and positions as vectors of offsets."""

import random

from conftest import utc
from test_lifecycle import as_minutes

from adtally.operators import decode
from adtally.operators.lifecycle import deltas, lifecycle
from adtally.plans.rollup import minute_campaign
from adtally.schemas import BID_TOPIC, IMPRESSION_TOPIC, RECORD
from adtally.sources.topics import file_stream
from adtally.streaming import monitor, projector

AT = utc(2024, 6, 1, 12)


def log():
    """Two topics of three partitions, keyed by id; all records have one timestamp."""
    rng, rows, next_offset = random.Random(3), [], {}
    for _ in range(120):
        n = rng.randrange(30)
        topic = rng.choice([BID_TOPIC, IMPRESSION_TOPIC])
        value = f'{{"bid_id":"b{n}","campaign_id":"campaign{rng.randint(1, 2)}","user_idfv":"u","placement_id":"p","request_id":"r","timestamp":{int(AT.timestamp())}}}'
        place = (topic, n % 3)
        offset = next_offset.get(place, 0)
        next_offset[place] = offset + 1
        rows.append((topic, n % 3, offset, 1, f"b{n}", value, AT))
    return rows, next_offset


def test_a_stream_stopped_half_way(spark, tmp_path):
    rows, next_offset = log()
    progress = monitor.ProgressLog(spark, str(tmp_path / "progress"))
    assert progress.table().count() == 0
    spark.streams.addListener(progress)
    try:
        source = str(tmp_path / "in")

        def run(part):
            if part:
                spark.createDataFrame(part, RECORD).coalesce(1).write.mode("append").parquet(source)
            changes = decode.changes(decode.decode(file_stream(spark, source, files_per_trigger=1)))
            return projector.run_to_end(changes, str(tmp_path / "out"), str(tmp_path / "state"))

        run(rows[:50])
        spark.createDataFrame(rows[50:], RECORD).coalesce(1).write.mode("append").parquet(source)
        every = spark.read.schema(RECORD).parquet(source)
        wait_for(lambda: progress.table().agg({"input_rows": "sum"}).first()[0] == 50)
        assert monitor.pending_rows(progress.table(), every).first().pending == 70
        store = run([])
        wait_for(lambda: progress.table().agg({"input_rows": "sum"}).first()[0] == 120)
        assert monitor.pending_rows(progress.table(), every).first().pending == 0
    finally:
        spark.streams.removeListener(progress)
    # one timestamp for all: the order of each partition is that of its offsets
    batch = minute_campaign(deltas(lifecycle(decode.changes(decode.decode(every)))))
    assert as_minutes(store.minute_campaign()) == as_minutes(batch)


def wait_for(reached, seconds=30):
    """Progress is heard of a moment after the batch."""
    import time

    for _ in range(seconds * 5):
        if reached():
            return
        time.sleep(0.2)
    raise AssertionError("not reached")


def test_vectors(spark):
    rows, next_offset = log()
    records = spark.createDataFrame(rows, RECORD)
    latest = {(r.topic, r.partition): r.offset for r in monitor.ends(records).collect()}
    assert latest == next_offset
    seen = rows[:50]
    reached = {}
    for topic, partition, offset, *_ in seen:
        reached[(topic, partition)] = offset + 1
    notation = {}
    for (topic, partition), end in reached.items():
        notation.setdefault(topic, {})[str(partition)] = end
    import json

    earlier = {topic: {p: max(0, n - 2) for p, n in ends.items()} for topic, ends in notation.items()}
    told = spark.createDataFrame([(json.dumps(earlier),), (json.dumps(notation),), (None,)], "end_offsets STRING")
    position = monitor.vector(told, "end_offsets")
    assert {(r.topic, r.partition): r.offset for r in position.collect()} == reached
    pending = {(r.topic, r.partition): r.pending for r in monitor.backlog_by_partition(monitor.ends(records), position).collect()}
    assert pending == {place: n - reached.get(place, 0) for place, n in next_offset.items()}
    # the state there is that of the records before the vector, though all have the same time
    there = monitor.before(records, position)
    assert there.count() == 50
    one = lifecycle(decode.changes(decode.decode(there)))
    other = lifecycle(decode.changes(decode.decode(spark.createDataFrame(seen, RECORD))))
    assert as_minutes(minute_campaign(deltas(one))) == as_minutes(minute_campaign(deltas(other)))
