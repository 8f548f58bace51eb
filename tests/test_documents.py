"""Document status, quarantine, preview and the latest matches of each player."""


from pyspark.sql import functions as F

from scoreloom.operators import documents as docs
from scoreloom.operators.games import participant_games
from scoreloom.sources.landing import documents_from_strings, land_documents, read_documents

GOOD = (
    '{"metadata":{"matchId":"M1"},"info":{"gameEndTimestamp":5,'
    '"participants":[{"puuid":"a","championName":"X"},{"puuid":"b","championName":"Y"}]}}'
)
CASES = [
    (GOOD, "ok"),
    ("not json", "invalid_json"),
    (GOOD[:-4], "invalid_json"),
    ("", "invalid_json"),
    (None, "invalid_json"),
    ("[1]", "invalid_json"),
    ("null", "invalid_json"),
    ('{"status":{"status_code":429}}', "api_error"),
    ('{"metadata":{"matchId":"M6"}}', "no_participants"),
    ('{"metadata":{"matchId":"M7"},"info":{"participants":null}}', "no_participants"),
    ('{"metadata":{"matchId":"M8"},"info":{"participants":[]}}', "no_participants"),
    ("{}", "no_participants"),
    (GOOD.replace('{"matchId":"M1"}', "null"), "no_match_id"),
    (GOOD.replace('{"matchId":"M1"}', '"s"'), "no_match_id"),
    (GOOD.replace('"M1"', "null"), "no_match_id"),
    ('{"metadata":{"matchId":"M9"},"info":{"participants":[null]}}', "no_usable_participants"),
    ('{"info":{"participants":[{"puuid":"a"}]}}', "ok"),
    ('{"metadata":{},"info":{"participants":[null,{"puuid":"a"}]}}', "ok"),
]


def test_status_of_each_kind(spark):
    landed = documents_from_strings(spark, [payload for payload, _ in CASES])
    found = docs.with_status(landed).collect()
    assert sorted((r.json_payload or "", r.payload_status) for r in found) == sorted(
        (payload or "", status) for payload, status in CASES
    )


def test_quarantine_holds_everything_else(spark):
    landed = documents_from_strings(spark, [payload for payload, _ in CASES])
    found = [r.payload_status for r in docs.quarantine(landed).collect()]
    assert sorted(found) == sorted(status for _, status in CASES if status != "ok")


def test_quarantined_and_used_documents_are_all(spark):
    for payload, status in CASES:
        one = documents_from_strings(spark, [payload])
        used = participant_games(one).count() > 0
        assert (docs.quarantine(one).count() == 0) == used == (status == "ok"), payload


def test_landing_round_trip_keeps_text(spark, tmp_path):
    payloads = [GOOD, "not json", '{"quote":"\\"é"}']
    path = str(tmp_path / "landing")
    land_documents(documents_from_strings(spark, payloads), path)
    landed = read_documents(spark, path)
    assert landed.columns == ["json_payload"]
    assert sorted(r.json_payload for r in landed.collect()) == sorted(payloads)


def test_preview_is_ordered_and_short(spark):
    rows = docs.preview(spark.range(100), "id")
    assert [r.id for r in rows.collect()] == [0, 1, 2, 3, 4]


def _index(spark, rows):
    return spark.createDataFrame(rows, "puuid string, match_id string, game_ts bigint")


def test_latest_matches_order_and_ties(spark):
    index = _index(
        spark,
        [("a", "M1", 1), ("a", "M3", 3), ("a", "M2", 3), ("a", "M0", None), ("b", "M9", 9)],
    )
    found = docs.latest_matches(index, 3).orderBy("puuid", "rank").collect()
    assert [(r.puuid, r.rank, r.match_id) for r in found] == [
        ("a", 1, "M2"),
        ("a", 2, "M3"),
        ("a", 3, "M1"),
        ("b", 1, "M9"),
    ]


def test_latest_matches_above_the_group_limit(spark):
    """The two-step ranking used for long lists gives the plain ranking."""
    rows = [("hot", f"M{i:04d}", i % 97) for i in range(3000)] + [("b", "M1", 1)]
    index = _index(spark, rows)
    expected = sorted((r for r in rows if r[0] == "hot"), key=lambda r: (-r[2], r[1]))[:1500]
    found = docs.latest_matches(index, 1500).where("puuid = 'hot'").orderBy("rank").collect()
    assert [(r.match_id, r.game_ts) for r in found] == [(m, t) for _, m, t in expected]


def test_latest_matches_limits_before_the_shuffle(spark, plan_of):
    plan = plan_of(docs.latest_matches(docs.match_index(documents_from_strings(spark, [GOOD]))))
    assert "Partial" in plan and "WindowGroupLimit" in plan
    assert plan.count("from_json") == 1


def test_index_counts_copies_and_repeated_players_once(spark):
    twice = GOOD.replace('"puuid":"b"', '"puuid":"a"')
    index = docs.match_index(documents_from_strings(spark, [GOOD, GOOD, twice, "not json"]))
    assert sorted(index.collect()) == [("a", "M1", 5), ("b", "M1", 5)]


def test_index_makes_the_text_before_the_parse_and_shuffles_documents_once(spark, plan_of):
    made = F.to_json(F.struct(F.struct(F.col("id").cast("string").alias("matchId")).alias("metadata")))
    plan = plan_of(docs.match_index(spark.range(3).select(made.alias("json_payload"))))
    parse = [line for line in plan.splitlines() if "from_json(" in line]
    assert len(parse) == 1 and "StructsToJson" not in parse[0] and "StructsToJson" in plan
    assert plan.count("Exchange") == 1 and "Generate explode" in plan.split("Exchange")[0]


def test_index_of_odd_documents(spark):
    newer = GOOD.replace('"gameEndTimestamp":5', '"gameEndTimestamp":7').replace('{"puuid":"b"', '{"puuid":"c"')
    timeless = GOOD.replace('"gameEndTimestamp":5,', "").replace('"M1"', '"M2"')
    escaped = GOOD.replace('"puuid"', '"\\u0070uuid"').replace('"M1"', '"M3"')
    spaced = GOOD.replace('"puuid":', ' "puuid" : ').replace('"M1"', '"M4"').replace('"b"', "null")
    nobody = ['{"metadata":{"matchId":"M5"},"info":{"participants":%s}}' % p for p in ("null", "[]", "[null]", "[{}]")]
    unnamed = [GOOD.replace('"M1"', "null"), GOOD.replace('{"matchId":"M1"}', "{}"), GOOD.replace("puuid", "Puuid")]
    landed = [GOOD, newer, GOOD, timeless, escaped, spaced, *nobody, *unnamed, GOOD.replace('"', "'"), "", None]
    found = docs.match_index(documents_from_strings(spark, landed)).collect()
    assert sorted(map(tuple, found), key=repr) == [
        ("a", "M1", 7),
        ("a", "M2", None),
        ("a", "M3", 5),
        ("a", "M4", 5),
        ("b", "M1", 5),
        ("b", "M2", None),
        ("b", "M3", 5),
        ("c", "M1", 7),
    ]


def test_documents_of_a_list_of_matches(spark):
    other = GOOD.replace("M1", "M2")
    landed = documents_from_strings(spark, [GOOD, other, other, "not json"])
    wanted = spark.createDataFrame([("M2",), ("M5",)], "match_id string")
    assert [r.json_payload for r in docs.documents_of(landed, wanted).collect()] == [other]


def test_the_newest_copy_is_taken_and_ids_are_read_alike(spark):
    newer = GOOD.replace('"gameEndTimestamp":5', '"gameEndTimestamp":6').replace("X", "A")
    twice = GOOD.replace('{"matchId":"M1"}', '{"matchId":"D1","matchId":"D2"}')
    landed = documents_from_strings(spark, [newer, GOOD, twice])
    wanted = docs.latest_matches(docs.match_index(landed), 5).select("match_id").distinct()
    assert sorted(r[0] for r in wanted.collect()) == ["D2", "M1"]
    assert {r.json_payload for r in docs.documents_of(landed, wanted).collect()} == {newer, twice}


def test_documents_naming_a_player(spark):
    escaped = GOOD.replace('"a"', '"\\u0061"')
    other = GOOD.replace('"a"', '"q"').replace("metadata", "metadat")
    landed = documents_from_strings(spark, [GOOD, escaped, '{"x":"q"}', None, other])
    found = {r.json_payload for r in docs.documents_naming(landed, '"a"').collect()}
    assert found == {GOOD, escaped}
