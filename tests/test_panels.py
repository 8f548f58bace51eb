"""Panel tables over the demo feed, and their edge cases."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from scoreloom.fixed_values import DEMO_ROWS
from scoreloom.functions.positions import with_position
from scoreloom.operators.feed import champion_metrics
from scoreloom.plans import panels
from scoreloom.schemas import FEED_SCHEMA
from scoreloom.sources.shared import publish

RATES = [r for _, r, _ in DEMO_ROWS]
PLAYED = [p for _, _, p in DEMO_ROWS]


def metrics_of(spark, rows):
    return champion_metrics(spark.createDataFrame(rows, FEED_SCHEMA))


@pytest.fixture(scope="module")
def demo(spark):
    return publish(metrics_of(spark, DEMO_ROWS), "demo")


@pytest.fixture(scope="module")
def empty(spark):
    return metrics_of(spark, [])


def test_key_figures(demo):
    row = panels.kpi_summary(demo).first()
    assert row.avg_wr == pytest.approx(49.8533333)
    assert row.avg_delta == pytest.approx(-0.1466667)
    assert (row.top_champion, row.top_wr, row.n_champions) == ("Jinx", 55.8, 30)
    assert row.top_minus_avg == pytest.approx(55.8 - 49.8533333)


def test_leader_with_ties_and_unknown_rates(spark):
    rows = [("N", None, 1), ("B", 51.0, 1), ("A", 51.0, 1)]
    assert panels.kpi_summary(metrics_of(spark, rows)).first().top_champion == "A"
    only = panels.kpi_summary(metrics_of(spark, [("N", None, 1)])).first()
    assert (only.top_champion, only.top_wr, only.avg_wr) == ("N", None, None)


def test_mean_texts_do_not_depend_on_row_order(spark, demo):
    rows = [panels.kpi_summary(demo.repartition(n)).first() for n in (1, 2, 7, 16)]
    assert all(r.avg_wr == pytest.approx(49.85333333333333, abs=1e-12) for r in rows)
    assert {(r.avg_label, r.avg_delta_label, r.top_delta_label) for r in rows} == {("49.9%", "▼ 0.1", "▲ 5.9")}


def test_mean_keeps_all_decimals(spark):
    rates = [("A", 0.1234567890123, 1), ("B", 1.0, 1)]
    assert panels.kpi_summary(metrics_of(spark, rates)).first().avg_wr == pytest.approx(0.56172839450615, abs=1e-15)


def test_unknown_rates_come_last(spark):
    feed = metrics_of(spark, [("a", 51.0, 1), ("b", None, 1), ("c", 49.0, 1)])
    assert [r.champion for r in panels.top_rates(feed).collect()] == ["c", "a", "b"]
    assert [r.champion for r in panels.deep_dive(feed, ["a", "b", "c"]).collect()] == ["c", "a", "b"]


def test_tiers_of_a_feed_without_tiers(demo):
    counts = panels.tier_counts(demo.drop("tier")).orderBy("pos").collect()
    assert [r.value for r in counts] == [0, 30, 0, 0]


def test_positions_whatever_files_are_written(spark):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "10")
    try:
        rows = [(f"c{i:04d}", float(i % 7), 1) for i in range(1000)]
        found = panels.spark_all(spark.createDataFrame(rows, "champion string, win_rate_pct double, matches_played int"))
        assert sorted(r.pos for r in found.collect()) == list(range(1000))
        by_pos = [r.value for r in sorted(found.collect(), key=lambda r: r.pos)]
        assert by_pos == sorted(by_pos)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")


def test_series(demo):
    everyone = panels.spark_all(demo).orderBy("pos").collect()
    assert [r.pos for r in everyone] == list(range(30))
    assert [r.value for r in everyone] == sorted(RATES)
    top = panels.spark_top5(demo).orderBy("pos").collect()
    assert [(r.pos, r.value) for r in top] == list(enumerate(sorted(RATES)[-5:]))


def test_tier_counts_are_filled_with_zero(spark, demo):
    assert [r.value for r in panels.tier_counts(demo).orderBy("pos").collect()] == [8, 13, 6, 3]
    few = metrics_of(spark, [("A", 60.0, 1), ("B", 59.0, 2), ("C", 58.0, 3)])
    assert [r.value for r in panels.tier_counts(few).orderBy("pos").collect()] == [0, 0, 0, 3]


def test_top_bars(demo):
    found = panels.top_rates(demo).collect()
    assert [r.win_rate_pct for r in found] == sorted(RATES)[-10:]
    assert all(r.above_baseline for r in found)
    assert found[-1].label == "  55.8%" and found[-1].matches_label == "38,000"


def test_axis_bounds(spark, demo):
    found = {r.panel: (r.x_min, r.x_max) for r in panels.axis_bounds(demo).collect()}
    assert found == {"top": (40.0, 58.3), "selected": (40.0, 59.3)}
    low = metrics_of(spark, [("A", 44.0, 1), ("B", 43.0, 2), ("C", 42.0, 3)])
    found = {r.panel: r.x_max for r in panels.axis_bounds(low).collect()}
    assert found == {"top": 53.0, "selected": 54.0}


def test_volume(demo):
    assert tuple(panels.volume_split(demo).first()) == (17500.0, 3000, 45000)
    points = {r.champion: r for r in panels.volume_points(demo).collect()}
    quadrants = [r.quadrant for r in points.values()]
    assert [quadrants.count(q) for q in ("Meta Dominants", "Hidden Gems", "High-Volume low WR",
                                         "Niche & Weak")] == [12, 4, 3, 11]
    assert points["Yasuo"].bubble_size == pytest.approx(34.0)
    assert points["Shaco"].bubble_size == 8.0
    assert {r.symbol for r in points.values()} == {"circle"}


def test_highlight(demo):
    plain = {r.champion: r for r in panels.volume_points(demo).collect()}
    marked = {r.champion: r for r in panels.volume_points(demo, "Lux").collect()}
    assert marked["Lux"].symbol == "star"
    assert marked["Lux"].bubble_size == pytest.approx(plain["Lux"].bubble_size * 1.9)
    assert marked["Jinx"] == plain["Jinx"]


def numpy_histogram(values):
    counts, edges = np.histogram(np.array(values), bins=15)
    return counts.tolist(), edges.tolist()


def check_histogram(metrics, values):
    found = panels.rate_histogram(metrics).orderBy("bin").collect()
    counts, edges = numpy_histogram(values)
    assert [r.n for r in found] == counts
    assert [r.lo for r in found] == edges[:-1]
    assert [r.hi for r in found] == edges[1:]
    assert {r.width for r in found} == {edges[1] - edges[0]}


def test_histogram_of_the_demo_feed(demo):
    check_histogram(demo, RATES)
    counts = [r.n for r in panels.rate_histogram(demo).orderBy("bin").collect()]
    assert counts == [1, 2, 1, 2, 1, 1, 2, 8, 4, 3, 1, 1, 1, 1, 1]


def test_histogram_of_equal_rates(spark):
    check_histogram(metrics_of(spark, [(c, 50.0, 1) for c in "ABCD"]), [50.0] * 4)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 1000), min_size=3, max_size=60))
def test_histogram_agrees_with_numpy(spark, tenths):
    values = [t / 10 for t in tenths]
    rows = [(f"c{i}", v, i) for i, v in enumerate(values)]
    check_histogram(metrics_of(spark, rows), values)


def test_moments_and_curve(demo):
    moments = panels.rate_moments(demo).first()
    assert moments.std_wr == pytest.approx(np.std(RATES)) == pytest.approx(2.6474810)
    curve = panels.normal_curve(demo).orderBy("i").collect()
    x = np.linspace(min(RATES) - 1, max(RATES) + 1, 300)
    mean, deviation, width = np.mean(RATES), np.std(RATES), (55.8 - 44.1) / 15
    y = np.exp(-0.5 * ((x - mean) / deviation) ** 2) / (deviation * math.sqrt(2 * math.pi))
    assert [r.x for r in curve] == pytest.approx(x.tolist())
    assert [r.y for r in curve] == pytest.approx((y * 30 * width).tolist())


def test_curve_of_equal_rates_is_undefined(spark):
    curve = panels.normal_curve(metrics_of(spark, [(c, 50.0, 1) for c in "ABC"])).collect()
    assert len(curve) == 300 and all(r.y is None for r in curve)


def test_tier_summary(demo):
    found = panels.tier_summary(demo).collect()
    assert [(r.tier, r.n) for r in found] == [
        ("S-Tier", 3), ("A-Tier", 6), ("B-Tier", 13), ("C-Tier", 8),
    ]
    assert [r.avg_wr for r in found] == pytest.approx([54.666667, 51.716667, 50.030769, 46.3625])
    assert found[0].label == "Avg WR: 54.7%  ·  3 champs"
    assert found[0].color == "#FFD700"


def test_tier_colors(spark, demo):
    row = panels.tier_attributes(demo).where("champion = 'Shaco'").first()
    assert (row.map_color, row.bar_color) == ("#64748B", "#64748b")
    odd = spark.createDataFrame([("X", "D-Tier"), ("Y", None)], "champion string, tier string")
    assert {tuple(r)[2:] for r in panels.tier_attributes(odd).collect()} == {("#64748b", "#00f2fe")}


def test_options(demo):
    found = panels.options(demo).orderBy("rank").collect()
    assert [r.rank for r in found] == list(range(30))
    assert found[0].label == "Jinx  [S-Tier]"
    assert [r.value for r in found] == [c for c, _, _ in sorted(DEMO_ROWS, key=lambda r: (-r[1], r[0]))]
    lee = next(r for r in found if r.value == "Lee Sin")
    assert lee.icon_url.endswith("/LeeSin/square")


def test_positions_with_equal_and_unknown_rates(spark):
    rows = [("N", None, 1), ("B", 50.0, 1), ("A", 50.0, 1), ("C", 50.04, 1), ("Z", 0.0, 1)]
    found = panels.options(metrics_of(spark, rows)).orderBy("rank").collect()
    assert [r.value for r in found] == ["C", "A", "B", "Z", "N"]
    ascending = panels.spark_all(metrics_of(spark, rows)).orderBy("pos").collect()
    assert [r.value for r in ascending] == [0.0, 50.0, 50.0, 50.04, None]


def test_positions_over_many_files_and_a_shared_rate(spark):
    """Thousands of rows of one rate among others, sorted into several files."""
    rows = [(f"c{i:05d}", 50.0 if i % 3 else (i % 997) / 10, i) for i in range(6000)]
    settings_ = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "12",
    }
    before = {key: spark.conf.get(key) for key in settings_}
    try:
        for key, value in settings_.items():
            spark.conf.set(key, value)
        df = spark.createDataFrame(rows, FEED_SCHEMA).repartition(5)
        placed = with_position(df, "win_rate_pct", "champion", descending=True, name="rank")
        assert len(placed.inputFiles()) > 5
        found = {r.champion: r["rank"] for r in placed.collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    expected = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert found == {champion: i for i, (champion, _, _) in enumerate(expected)}


class TestSelection:
    def names(self, df):
        return [r.champion for r in df.collect()]

    def test_range_is_inclusive(self, spark):
        df = metrics_of(spark, [("A", 44.0, 1), ("B", 57.0, 1), ("C", 57.1, 1), ("D", None, 1)])
        assert sorted(self.names(panels.in_range(df, (44, 57)))) == ["A", "B"]

    def test_default_range(self, demo):
        assert panels.in_range(demo, (44.0, 57.0)).count() == 30
        assert panels.in_range(demo).count() == 30

    def test_default_selection_is_the_top_of_the_range(self, demo):
        found = self.names(panels.default_selection(demo, (44.0, 52.0)))
        assert found == ["Yasuo", "Zed", "Orianna", "Thresh", "Leona"]

    def test_selected_ignore_the_range(self, demo):
        found = self.names(panels.deep_dive(demo, ["Jinx", "Shaco", "Nobody"], (50, 51)))
        assert found == ["Shaco", "Jinx"]

    def test_more_than_five_selected_are_all_listed(self, demo):
        chosen = ["Jinx", "Shaco", "Lux", "Ahri", "Zed", "Corki"]
        assert sorted(self.names(panels.deep_dive(demo, chosen))) == sorted(chosen)

    @pytest.mark.parametrize("selected", [[], ["Nobody"], ["Nobody", "No One"]])
    def test_nothing_valid_selected(self, demo, selected):
        found = self.names(panels.deep_dive(demo, selected, (44.0, 52.0)))
        assert found == ["Leona", "Thresh", "Orianna", "Zed", "Yasuo"]

    def test_empty_range(self, demo):
        assert panels.deep_dive(demo, [], (90, 95)).count() == 0

    def test_labels(self, demo):
        found = {r.champion: r for r in panels.comparison_rows(demo).collect()}
        assert found["Jinx"].label == "  55.8%  ▲5.8"
        assert found["Shaco"].label == "  44.1%  ▼5.9"
        assert found["Camille"].label == "  50.0%  ▲0.0"
        assert (found["Jinx"].delta_label, found["Shaco"].delta_label) == ("+5.8", "-5.9")

    def test_places_follow_the_selection(self, demo):
        found = panels.selected_champions(demo, ["Zed", "Nobody", "Jinx"]).orderBy("place").collect()
        assert [tuple(r) for r in found] == [(0, "Zed"), (2, "Jinx")]

    def test_one_champion(self, demo):
        assert panels.champion_row(demo, "Lux").first().matches_played == 42000
        assert panels.champion_row(demo, "Nobody").count() == 0


class TestRadar:
    def shapes(self, df):
        rows = sorted(df.collect(), key=lambda r: (r.place, r.axis_pos))
        shapes: dict[str, list[float]] = {}
        for r in rows:
            shapes.setdefault(r.champion, []).append(r.value)
        return shapes

    def test_values_and_closing_axis(self, demo):
        shapes = self.shapes(panels.radar(demo, ["Katarina", "Shaco"]))
        assert list(shapes) == ["Katarina", "Shaco"]
        wr, pop = 87.1794872, 45.2380952
        assert shapes["Katarina"] == pytest.approx([wr, pop, 71.5, (wr + pop) / 2, wr])
        assert shapes["Shaco"] == pytest.approx([0, 0, 20.5, 0, 0])

    def test_five_at_most_in_selection_order(self, demo):
        chosen = ["Zed", "Nobody", "Lux", "Ahri", "Jinx", "Shaco", "Corki"]
        assert list(self.shapes(panels.radar(demo, chosen))) == ["Zed", "Lux", "Ahri", "Jinx", "Shaco"]

    def test_fewer_than_two(self, demo):
        assert panels.radar(demo, ["Zed"]).count() == 0
        assert panels.radar(demo, ["Zed", "Nobody"]).count() == 0

    def test_default_selection(self, demo):
        found = list(self.shapes(panels.radar(demo, [])))
        assert found == ["Jinx", "Katarina", "Fiora", "Lux", "Ahri"]
        assert list(self.shapes(panels.radar(demo, ["Nobody"]))) == found

    def test_clamped_score(self, spark):
        rows = [("A", 90.0, 1), ("B", 10.0, 2), ("C", 50.0, 3)]
        shapes = self.shapes(panels.radar(metrics_of(spark, rows), ["A", "B", "C"]))
        assert [shapes[c][2] for c in "ABC"] == [100.0, 0.0, 50.0]

    def test_feed_without_derived_columns(self, spark):
        feed = spark.createDataFrame([("A", 60.0, 1), ("B", 40.0, 2)], FEED_SCHEMA)
        shapes = self.shapes(panels.radar(feed, ["A", "B"]))
        assert shapes["A"] == [50.0, 50.0, 50.0, 50.0, 50.0]


def test_empty_feed(empty):
    assert panels.kpi_summary(empty).count() == 0
    for table in (panels.spark_all, panels.spark_top5, panels.top_rates, panels.volume_points,
                  panels.tier_summary, panels.options):
        assert table(empty).count() == 0
    assert panels.radar(empty, []).count() == 0
    assert panels.deep_dive(empty, ["A"]).count() == 0
    assert {r.n for r in panels.rate_histogram(empty).collect()} == {0}


def test_sums_of_counts(spark, demo):
    assert sum(r.n for r in panels.rate_histogram(demo).collect()) == 30
    assert sum(r.value for r in panels.tier_counts(demo).collect()) == 30


def test_panels_need_no_nested_loops(demo, plan_of):
    tables = [
        panels.kpi_summary(demo), panels.spark_all(demo), panels.tier_counts(demo),
        panels.top_rates(demo), panels.volume_points(demo), panels.rate_histogram(demo),
        panels.normal_curve(demo), panels.tier_summary(demo), panels.options(demo),
        panels.deep_dive(demo, ["Lux"]), panels.radar(demo, ["Lux", "Zed"]),
    ]
    for table in tables:
        plan = plan_of(table)
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_top_bars_are_not_sorted_whole(demo, plan_of):
    assert "TakeOrderedAndProject" in plan_of(panels.top_rates(demo))
