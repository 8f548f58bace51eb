"""The feed: names, contract, fallback, tiers and derived metrics."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from scoreloom.fixed_values import DEMO_ROWS
from scoreloom.functions.tiers import tier_of, tier_table
from scoreloom.operators import feed as feeds
from scoreloom.schemas import FEED_SCHEMA
from scoreloom.sources.demo import demo_feed
from scoreloom.sources.tables import overwrite_table


def feed_of(spark, rows):
    return spark.createDataFrame(rows, FEED_SCHEMA)


@pytest.mark.parametrize(
    "rate,tier",
    [
        (-1.0, "B"), (0.0, "B"), (0.1, "C"), (49.0, "C"), (49.01, "B"), (51.0, "B"), (51.01, "A"),
        (53.0, "A"), (53.1, "S"), (100.0, "S"), (100.1, "B"), (None, "B"),
    ],
)
def test_tier_boundaries(spark, rate, tier):
    df = spark.createDataFrame([(rate,)], "rate double")
    assert df.select(tier_of(F.col("rate"))).first()[0] == f"{tier}-Tier"


def test_feed_names_and_default_volume(spark):
    stats = spark.createDataFrame(
        [("X", 50.0, 7), ("Y", 51.0, None)], "champion string, win_rate_pct double, total_partidas bigint"
    )
    assert sorted(map(tuple, feeds.champion_feed(stats).collect())) == [
        ("X", 50.0, 7),
        ("Y", 51.0, 1000),
    ]
    renamed = stats.withColumnRenamed("total_partidas", "matches_played")
    assert feeds.champion_feed(renamed).columns == ["champion", "win_rate_pct", "matches_played"]


def test_best_first_puts_unknown_rates_last(spark):
    df = feed_of(spark, [("B", 50.0, 1), ("A", 50.0, 1), ("N", None, 1), ("C", 60.0, 1)])
    assert [r.champion for r in feeds.best_first(df).collect()] == ["C", "A", "B", "N"]


def test_normalized_names(spark):
    df = feed_of(spark, [("X", 50.0, 1)]).toDF(" Champion", "WIN_RATE_PCT ", "Matches_Played")
    assert feeds.normalize_columns(df).columns == FEED_SCHEMA.names


class TestFallback:
    def served(self, spark, source):
        return [tuple(r) for r in feeds.feed_or_fallback(spark, source).collect()]

    def test_good_source(self, spark):
        assert self.served(spark, feed_of(spark, [("X", 50.0, 1)])) == [("X", 50.0, 1)]

    def test_untidy_names_are_accepted(self, spark):
        untidy = feed_of(spark, [("X", 50.0, 1)]).toDF("CHAMPION", "Win_Rate_Pct ", "matches_played")
        assert self.served(spark, untidy) == [("X", 50.0, 1)]

    def test_empty_incomplete_missing_and_failing(self, spark):
        def fails():
            return spark.read.parquet("/nonexistent/path")

        for source in (
            feed_of(spark, []),
            feed_of(spark, [("X", 50.0, 1)]).drop("champion"),
            "no_such_table",
            fails,
        ):
            assert self.served(spark, source) == DEMO_ROWS

    def test_table(self, spark):
        stats = spark.createDataFrame(
            [("X", 3, 50.0)], "champion string, total_partidas bigint, win_rate_pct double"
        )
        overwrite_table(stats, "served_stats")
        assert self.served(spark, "served_stats") == [("X", 50.0, 3)]


def test_metrics_of_the_demo_feed(spark):
    found = {r.champion: r for r in feeds.champion_metrics(demo_feed(spark)).collect()}
    assert len(found) == 30
    katarina = found["Katarina"]
    assert katarina.wr_normalized == pytest.approx(87.1794872, abs=1e-6)
    assert katarina.pop_normalized == pytest.approx(45.2380952, abs=1e-6)
    assert katarina.win_rate_delta == pytest.approx(4.3)
    tiers = [r.tier[0] for r in found.values()]
    assert [tiers.count(t) for t in "SABC"] == [3, 6, 13, 8]
    assert all(0 <= r.wr_normalized <= 100 and 0 <= r.pop_normalized <= 100 for r in found.values())


@pytest.mark.parametrize("n", [0, 1, 2])
def test_small_feeds_get_fixed_values(spark, n):
    rows = [("X", 70.0, 5), ("Y", 10.0, 9)][:n]
    found = feeds.champion_metrics(feed_of(spark, rows)).collect()
    assert len(found) == n
    assert all((r.tier, r.wr_normalized, r.pop_normalized) == ("B-Tier", 50.0, 50.0) for r in found)
    assert [r.win_rate_delta for r in found] == [r.win_rate_pct - 50 for r in found]


def test_three_rows_are_scored(spark):
    found = feeds.champion_metrics(feed_of(spark, [("X", 70.0, 5), ("Y", 10.0, 9), ("Z", 40.0, 7)]))
    assert sorted((r.champion, r.wr_normalized, r.pop_normalized) for r in found.collect()) == [
        ("X", 100.0, 0.0),
        ("Y", 0.0, 100.0),
        ("Z", 50.0, 50.0),
    ]


def test_equal_rates_score_zero(spark):
    found = feeds.champion_metrics(feed_of(spark, [(c, 50.0, 7) for c in "WXYZ"])).collect()
    assert {(r.wr_normalized, r.pop_normalized) for r in found} == {(0.0, 0.0)}


def test_records(spark):
    df = feed_of(spark, [("X", 50.5, 7)])
    assert feeds.feed_records(df).first().record == (
        '{"champion":"X","win_rate_pct":50.5,"matches_played":7}'
    )


def test_records_keep_null_fields(spark):
    df = feed_of(spark, [("a", None, 1)])
    assert feeds.feed_records(df).first().record == (
        '{"champion":"a","win_rate_pct":null,"matches_played":1}'
    )


def test_fallback_for_a_broken_file(spark, tmp_path, caplog):
    path = tmp_path / "broken"
    path.mkdir()
    (path / "part-0.parquet").write_bytes(b"PAR1 no parquet PAR1")
    broken = spark.read.schema(FEED_SCHEMA).parquet(str(path))
    served = feeds.feed_or_fallback(spark, broken)
    assert served.count() == len(DEMO_ROWS)
    assert "serving the demo feed" in caplog.text


def test_metrics_plan_has_no_join_or_window(spark, plan_of):
    plan = plan_of(feeds.champion_metrics(demo_feed(spark)))
    assert "Join" not in plan and "Window" not in plan
    assert plan.count("Subquery") <= 2


def test_tier_table_orders(spark):
    assert [r.tier[0] for r in tier_table(spark).orderBy("tier_rank").collect()] == list("SABC")
    worst = tier_table(spark, worst_first=True).orderBy("tier_rank").collect()
    assert [r.tier[0] for r in worst] == list("CBAS")


def damaged_feed(spark, path, rows=40):
    """A feed of as many files, the last of which is cut off."""
    feed = spark.createDataFrame([(f"c{i:02d}", 50.0, i) for i in range(rows)], FEED_SCHEMA)
    feed.repartitionByRange(rows, "champion").write.parquet(path)
    last = sorted(Path(path).glob("part-*"))[-1]
    last.write_bytes(last.read_bytes()[:60])
    return spark.read.schema(FEED_SCHEMA).parquet(path)


def test_a_feed_that_fails_after_its_first_rows(spark, tmp_path):
    broken = damaged_feed(spark, str(tmp_path / "feed"))
    assert not broken.isEmpty()  # the first row can be read
    served = feeds.feed_or_fallback(spark, broken)
    assert served.count() == len(DEMO_ROWS)

    snapshots = str(tmp_path / "snapshots")
    assert feeds.feed_or_fallback(spark, broken, snapshots).count() == len(DEMO_ROWS)
    good = feed_of(spark, [("X", 50.0, 1)])
    assert feeds.feed_or_fallback(spark, good, snapshots).collect() == good.collect()
    for bad in (broken, feed_of(spark, []), good.drop("champion"), lambda: 1 / 0, "no_such_table"):
        assert feeds.feed_or_fallback(spark, bad, snapshots).collect() == good.collect()


def test_a_served_feed_does_not_change_with_its_source(spark, tmp_path):
    path, snapshots = tmp_path / "feed", str(tmp_path / "snapshots")
    feed_of(spark, [("X", 50.0, 1)]).write.parquet(str(path))
    served = feeds.feed_or_fallback(spark, spark.read.parquet(str(path)), snapshots)
    for file in path.glob("part-*"):
        file.unlink()
    assert [tuple(r) for r in served.collect()] == [("X", 50.0, 1)]


def test_few_snapshots_are_kept(spark, tmp_path):
    snapshots = tmp_path / "snapshots"
    for n in range(5):
        served = feeds.feed_or_fallback(spark, feed_of(spark, [("X", 50.0, n)]), str(snapshots))
        assert served.first().matches_played == n
    assert len(list(snapshots.iterdir())) == feeds.KEPT_SNAPSHOTS
