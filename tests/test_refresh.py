"""Panels from the state equal panels of the whole feed, after every refresh."""

import random

import pytest

from scoreloom.operators.feed import champion_feed, champion_metrics
from scoreloom.plans import panels
from scoreloom.plans.refresh import WEIGHT, PanelState
from scoreloom.schemas import FEED_SCHEMA
from scoreloom.sources.landing import documents_from_strings
from scoreloom.streaming.live import LiveStats


def rounded(df):
    return sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr
    )


def same_panels(spark, state, feed):
    assert rounded(state.feed(spark)) == rounded(feed)
    metrics = champion_metrics(feed)
    for panel, rows in (
        (panels.rate_histogram, state.rates(spark)),
        (panels.rate_moments, state.rates(spark)),
        (panels.tier_summary, state.rates(spark)),
        (panels.tier_counts, state.rates(spark)),
        (panels.volume_split, state.volumes(spark)),
    ):
        assert rounded(panel(rows, WEIGHT)) == rounded(panel(metrics)), panel.__name__


@pytest.fixture
def state(tmp_path):
    return PanelState(str(tmp_path / "panels"), buckets=4)


def test_refreshes_equal_the_whole_feed(spark, state):
    draw, whole = random.Random(4), {}
    for size in (3, 12, 1):
        names = [f"c{draw.randrange(20)}" for _ in range(size)]
        changed = {c: (draw.choice([None, 0.0, 48.9, 50.0, 52.1, 60.5]), draw.randrange(1, 9)) for c in names}
        whole |= changed
        rows = spark.createDataFrame([(c, *v) for c, v in changed.items()], FEED_SCHEMA)
        state.refresh(rows)
        same_panels(spark, state, spark.createDataFrame([(c, *v) for c, v in whole.items()], FEED_SCHEMA))
    before = rounded(state.state.read(spark))
    state.refresh(rows)  # run again after a failure
    assert rounded(state.state.read(spark)) == before


def test_the_highest_rate_may_fall(spark, state):
    first = spark.createDataFrame([("a", 90.0, 5), ("b", 50.0, 5), ("c", 40.0, 1)], FEED_SCHEMA)
    state.refresh(first)
    state.refresh(spark.createDataFrame([("a", 45.0, 6)], FEED_SCHEMA))
    same_panels(spark, state, spark.createDataFrame([("a", 45.0, 6), ("b", 50.0, 5), ("c", 40.0, 1)], FEED_SCHEMA))
    assert state.rates(spark).where("win_rate_pct = 90").isEmpty()


def test_only_buckets_of_changed_values_are_written(spark, tmp_path):
    state = PanelState(str(tmp_path / "panels"), buckets=64)
    state.refresh(spark.createDataFrame([(f"c{i}", 40.0 + i, i) for i in range(40)], FEED_SCHEMA))
    before = state.state.places(spark)
    state.refresh(spark.createDataFrame([("c1", 77.7, 500)], FEED_SCHEMA))
    after = state.state.places(spark)
    assert sum(before.get(b) != after.get(b) for b in {*before, *after}) <= 5


def test_after_each_batch_of_the_stream(spark, state, tmp_path):
    live = LiveStats(str(tmp_path / "live"))
    entry = '{{"puuid":"{}","championName":"{}","kills":1,"deaths":1,"assists":1,"win":{}}}'
    draw = random.Random(9)
    for batch in range(3):
        payloads = []
        for i in range(10):
            entries = [entry.format(f"p{k}", f"c{draw.randrange(6 + batch)}", draw.choice(["true", "false"])) for k in range(3)]
            payloads.append(f'{{"metadata":{{"matchId":"M{batch}_{i}"}},"info":{{"participants":[{",".join(entries)}]}}}}')
        live.take_batch(documents_from_strings(spark, payloads), batch)
        state.refresh(champion_feed(live.changed_stats(spark)))
        same_panels(spark, state, champion_feed(live.stats(spark)))
