"""Stored layers compared by the digests that batches leave."""

import pathlib
from datetime import timedelta
from urllib.parse import urlparse

import pytest
from conftest import CHANGES, utc

from adtally.operators import digests
from adtally.sources.topics import file_stream
from adtally.streaming import projector
from adtally.streaming import store as S

T0 = utc(2024, 1, 1, 12)
SCHEMA = CHANGES + ", request_id STRING, user_idfv STRING, placement_id STRING, raw_json STRING"


def rows():
    """Three days of bids, impressions, repeats and late bids."""
    out = []
    for n in range(60):
        at = T0 + timedelta(hours=n)
        out.append((2 * n, "bid", f"b{n}", "c1" if n % 2 else "c2", at, at, "r", "u", "p", "{}"))
        # of every third impression the bid comes ten hours later, of every fifth never
        other = n + 10 if n % 3 == 0 else (f"x{n}" if n % 5 == 0 else n)
        at += timedelta(minutes=7)
        out.append((2 * n + 1, "impression", other if isinstance(other, str) else f"b{other}", None, at, at, "r", "u", "p", "{}"))
        if n % 7 == 0:
            out.append((2 * n + 1, "bid", f"b{n}", "c9", at, at, "r", "u", "p", "{}"))
    return out


@pytest.fixture
def project(spark, tmp_path):
    def run():
        every = rows()
        for part in (every[:40], every[40:90], every[90:]):
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], SCHEMA).schema, 1)
        return projector.run_to_end(
            stream, str(tmp_path / "out"), str(tmp_path / "state"), with_facts=True, with_digests=True, compact_every=None
        )

    return run


def test_layers_agree_and_damage_after_the_write_shows(project):
    store = project()
    cells = store.reconcile().collect()
    assert cells and all(c.ok for c in cells)
    per_subject = {c.subject: sum(x.rows for x in cells if x.subject == c.subject) for c in cells}
    assert per_subject["bids"] == 60 and per_subject["impressions"] == per_subject["deduped_impressions"] + per_subject["unknown_impressions"]
    assert store.drift().count() == 0
    # one file of the impression facts of the second day is lost
    lost = next(f for f in store.read(S.IMPRESSION_FACTS).inputFiles() if "event_date=2024-01-02" in f)
    pathlib.Path(urlparse(lost).path).unlink()
    found = store.drift().collect()
    assert {(r.subject, r.layer, str(r.event_date), r.side) for r in found} <= {
        ("impressions", "facts", "2024-01-02", side) for side in ("left_only", "right_only")
    } and found
    assert store.drift([utc(2024, 1, 1).date()]).count() == 0


@pytest.mark.parametrize("subject, table", [("bids", "new_bid_facts"), ("impressions", "new_impression_facts")])
def test_a_planted_difference_is_found_in_its_cell(project, monkeypatch, subject, table):
    """One fact is not written, another with a wrong time: both ids come out, and only their dates are read."""
    right = getattr(projector, table)

    def wrong(lives):
        facts = right(lives).where("bid_id != 'b34'")
        late = "CASE WHEN bid_id = 'b49' THEN event_ts + INTERVAL 1 SECOND ELSE event_ts END"
        return facts.selectExpr(*[f"{late} AS event_ts" if c == "event_ts" else c for c in facts.columns])

    monkeypatch.setattr(projector, table, wrong)
    store = project()
    bad = [c for c in store.reconcile().collect() if not c.ok]
    assert {c.subject for c in bad} == {subject} and 1 <= len(bad) <= 2
    differing = store.differing_rows(subject)
    got = sorted((r.bid_id, r.side, r.copies) for r in differing.collect())
    assert got == [("b34", "right_only", 1), ("b49", "left_only", 1), ("b49", "right_only", 1)]
    plan = differing._jdf.queryExecution().executedPlan().toString()
    dates = plan.split("PartitionFilters: [")[1:]
    assert any("event_date" in part.split("]")[0] for part in dates)
    assert store.differing_rows("impressions" if subject == "bids" else "bids").count() == 0


def test_digests_do_not_depend_on_order_and_add_up(spark):
    facts = spark.createDataFrame([(f"b{n}", T0 + timedelta(hours=n)) for n in range(50)], "bid_id STRING, event_ts TIMESTAMP")
    none = facts.where("false")
    whole = {tuple(r) for r in digests.added(digests.of_facts(facts, none)).collect()}
    parts = digests.of_facts(facts.where("bid_id < 'b3'"), none).unionByName(digests.of_facts(facts.where("bid_id >= 'b3'").orderBy("bid_id"), none))
    assert {tuple(r) for r in digests.added(parts).collect()} == whole
    other = {tuple(r) for r in digests.added(digests.of_facts(facts.where("bid_id != 'b7'"), none)).collect()}
    assert len(whole - other) == 1
