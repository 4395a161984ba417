"""A rebuild from facts that takes over from the served minutes, while the stream goes on."""

import pathlib

import model
import pytest
from conftest import CHANGES, utc
from test_lifecycle import LATE_BID, as_counter, as_minutes

from adtally.plans.serving import Serving
from adtally.sources.topics import file_stream
from adtally.streaming import projector
from adtally.streaming import store as S

FACTS = CHANGES + ", request_id STRING, user_idfv STRING, placement_id STRING, raw_json STRING"
MORE = [(7, "bid", "z", "c1", 70), (8, "impression", "z", None, 75), (9, "impression", "late", None, 76)]
LAST = [(10, "bid", "late", "c2", 80), (11, "bid", "z", "c2", 81), (12, "impression", "y", None, 82)]


class Stream:
    """Batches fed one by one into one projection."""

    def __init__(self, spark, changes_of, base, **options):
        self.spark, self.changes_of, self.base, self.options = spark, changes_of, base, options

    def feed(self, *batches):
        for rows in batches:
            full = self.changes_of(rows).selectExpr("*", "'r' AS request_id", "'u' AS user_idfv", "'p' AS placement_id", "'{}' AS raw_json")
            full.coalesce(1).write.mode("append").parquet(f"{self.base}/in")
        schema = self.spark.createDataFrame([], FACTS).schema
        stream = file_stream(self.spark, f"{self.base}/in", schema, files_per_trigger=1)
        return projector.run_to_end(stream, f"{self.base}/out", f"{self.base}/state", with_facts=True, **self.options)


@pytest.fixture
def stream(spark, changes_of, tmp_path):
    return lambda **options: Stream(spark, changes_of, str(tmp_path), **options)


def damage(store):
    """Served minutes of the current version, doubled."""
    version = store.version()
    rows = store._version_rows(S.COMPACTED, version).selectExpr("level", "campaign_id", "minute_ts", "bid_requests * 2 AS bid_requests", "deduped_impressions", "unknown_impressions + 1 AS unknown_impressions")
    place = store._of_version(S.COMPACTED, version)
    rows.write.partitionBy("level").parquet(place + "-new")
    import shutil

    shutil.rmtree(place)
    pathlib.Path(place + "-new").rename(place)


def test_a_rebuild_replaces_damaged_minutes_and_leaves_facts(stream):
    store = stream(compact_every=2).feed(LATE_BID, MORE, LAST)
    rows = LATE_BID + MORE + LAST
    right, facts = model.minutes(rows), store.read(S.BID_FACTS).count()
    damage(store)
    assert as_minutes(store.minute_campaign()) != right
    assert store.rebuild() == (1, 2)
    assert as_minutes(store.minute_campaign()) == right
    assert store.read(S.BID_FACTS).count() == facts
    assert as_counter(store.read(S.LEDGER)) == model.ledger(rows)
    # compaction goes on in the new generation
    assert store.compact() == 2 and store.versions()[-1] == (1, 2)
    assert store.rebuild() == (2, 2)
    assert as_minutes(store.minute_campaign()) == right


def test_a_rebuild_while_the_stream_runs(stream, monkeypatch):
    """Batches complete, versions are added and old ones vacuumed between the read of the facts and the commit."""
    source = stream(compact_every=1)
    store = source.feed(LATE_BID[:2], LATE_BID[2:])
    before, commit, waiting = store.version(), S.BatchStore._commit, [MORE[:1], MORE[1:], LAST]
    damage(store)
    assert as_minutes(store.minute_campaign()) != model.minutes(LATE_BID)

    def late(self, version, minutes, gone):
        if version[0] and waiting:
            batches, waiting[:] = list(waiting), []
            source.feed(*batches)
        commit(self, version, minutes, gone)

    monkeypatch.setattr(S.BatchStore, "_commit", late)
    assert store.rebuild() == (1, before[1])
    rows = LATE_BID + MORE + LAST
    assert as_minutes(store.minute_campaign()) == model.minutes(rows)
    assert store.versions()[-2][0] == 0 and store.versions()[-2][1] > before[1]
    # what the old generation adds later is not read
    commit(store, (0, 99), store.minute_campaign().where("false"), store._version_rows(S.EXPIRED, (0, -1)))
    assert as_minutes(store.minute_campaign()) == model.minutes(rows)
    # and the stream continues on the new one
    end = [(20, "bid", "y", "c1", 90)]
    store = source.feed(end)
    assert store.version()[0] == 1
    assert as_minutes(store.minute_campaign()) == model.minutes(rows + end)


def test_a_lost_driver_leaves_the_old_generation(stream, monkeypatch):
    source = stream(compact_every=1)
    store = source.feed(LATE_BID, MORE)
    right = model.minutes(LATE_BID + MORE)
    commit = S.BatchStore._commit

    def lost(self, version, minutes, gone):
        if version[0]:
            gone.write.mode("overwrite").parquet(self._of_version(S.EXPIRED, version))
            raise RuntimeError("lost")
        commit(self, version, minutes, gone)

    monkeypatch.setattr(S.BatchStore, "_commit", lost)
    with pytest.raises(RuntimeError, match="lost"):
        store.rebuild()
    assert store.version() == (0, 1)
    assert as_minutes(store.minute_campaign()) == right
    assert store.vacuum() == 0
    monkeypatch.undo()
    store = source.feed(LAST)
    assert store.rebuild() == (1, 2)
    assert as_minutes(store.minute_campaign()) == model.minutes(LATE_BID + MORE + LAST)
    assert not pathlib.Path(store.root, S.REBUILT).exists()
    assert store.vacuum() > 0
    assert as_minutes(store.minute_campaign()) == model.minutes(LATE_BID + MORE + LAST)


def test_a_rebuild_with_a_horizon_keeps_lifetime_totals(stream):
    store = stream().feed(LATE_BID, MORE, LAST)
    rows = LATE_BID + MORE + LAST
    whole = {tuple(r) for r in store.lifetime_campaign().collect() if any(r[1:])}
    store.rebuild(horizon=utc(2024, 1, 1, 1, 16))
    kept = {key: n for key, n in model.minutes(rows).items() if key[1] >= 76}
    assert as_minutes(store.minute_campaign()) == kept
    assert {tuple(r) for r in store.lifetime_campaign().collect() if any(r[1:])} == whole


def test_no_facts_no_rebuild(spark, changes_of, tmp_path):
    changes_of(LATE_BID).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = file_stream(spark, str(tmp_path / "in"), changes_of(LATE_BID).schema)
    store = projector.run_to_end(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    with pytest.raises(RuntimeError, match="facts"):
        store.rebuild()
    assert as_minutes(store.minute_campaign()) == model.minutes(LATE_BID)
    assert S.BatchStore(spark, str(tmp_path / "none")).rebuild() == (0, -1)


def test_merged_batches_read_as_before(stream):
    """Every batch merged and vacuumed: few directories, the same rows, also those after a batch."""
    source = stream(compact_every=1)
    parts = [LATE_BID[:2], LATE_BID[2:4], LATE_BID[4:], MORE, LAST]
    store = source.feed(*parts)
    rows = LATE_BID + MORE + LAST
    for table in (S.LEDGER, S.BID_FACTS, S.IMPRESSION_FACTS):
        assert len(store._committed(table, "batch_id")) <= 2
    assert len(store._committed(S.PROGRESS, "batch_id")) <= 2
    assert as_counter(store.read(S.LEDGER)) == model.ledger(rows)
    first = [r for part in parts[:3] for r in part]
    assert as_counter(store.read(S.LEDGER, upto=2)) == model.ledger(first)
    assert store.read(S.LEDGER, after=2).count() == sum(model.ledger(rows).values()) - sum(model.ledger(first).values())
    assert store.read(S.BID_FACTS).count() == len({r[2] for r in rows if r[1] == "bid"})
    assert store.freshness().first().last_projected_at is not None


def test_levels_of_the_store_take_corrections(stream):
    store = stream(compact_every=2).feed(LATE_BID, MORE, LAST)
    minutes, levels = store.minute_campaign(), store.levels()
    assert {r.level for r in levels.select("level").distinct().collect()} == {"minute", "hour", "day", "loose"}
    start, end = utc(2024, 1, 1), utc(2024, 1, 3)
    plain = Serving(None, minutes, utc(2023, 1, 1))
    by_cover = Serving(None, minutes, utc(2023, 1, 1), levels=levels)
    assert plain.by_campaign(start, end).collect() == by_cover.by_campaign(start, end).collect()
    assert plain.series(start, end, "hour").collect() == by_cover.series(start, end, "hour").collect()


def test_answers_as_of_a_change_read_the_tail_only(stream, monkeypatch):
    parts = [LATE_BID[:3], LATE_BID[3:], MORE, LAST]
    rows = [r for part in parts for r in part]
    store = stream(compact_every=1, snapshot_every=1).feed(*parts)
    assert [v[1] for v in store.versions()] == [0, 1, 2, 3]
    for seq in (2, rows[5][0], 8, 10, 99):
        assert as_minutes(store.minute_campaign_as_of(seq)) == model.minutes([r for r in rows if r[0] <= seq])
    # all before the last batch is in the version of the batch before: of the ledger only that batch is read
    read, asked = S.BatchStore.read, []
    monkeypatch.setattr(S.BatchStore, "read", lambda self, table, after=-1, upto=None: asked.append((table, after)) or read(self, table, after, upto))
    plan = store.minute_campaign_as_of(LAST[0][0] - 1)._jdf.queryExecution().executedPlan().toString()
    assert asked == [(S.LEDGER, 2)] and "seq#" in plan and "<= 9" in plan
    monkeypatch.undo()
    # without kept versions the answer is the same, from more of the ledger
    assert S.BatchStore(store.spark, store.root).vacuum() >= 2
    assert [v[1] for v in store.versions()] == [2, 3]
    assert as_minutes(store.minute_campaign_as_of(5)) == model.minutes([r for r in rows if r[0] <= 5])
