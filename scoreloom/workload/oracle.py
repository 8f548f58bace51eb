"""The same queries in SQL for DuckDB, over the same parquet tables.

Statistics are rounded from exact integers, so the SQL does not depend on how an engine
rounds doubles; the win rate is rounded on the decimal text of the double, as Spark does.
"""

from __future__ import annotations

from scoreloom.fixed_values import (
    BUBBLE_MIN,
    BUBBLE_SPAN,
    CURVE_POINTS,
    DEMO_ROWS,
    HISTOGRAM_BINS,
    ICON_URL_PREFIX,
    ICON_URL_SUFFIX,
    LATEST_MATCHES,
    RADAR_AXES,
    SLIDER_INITIAL,
    TIER_BAR_COLORS,
    TIER_BAR_DEFAULT,
    TIER_MAP_COLORS,
    TIER_MAP_DEFAULT,
    TIERS_BEST_FIRST,
    TIERS_WORST_FIRST,
)
from scoreloom.workload.queries import (
    HIGHLIGHTED,
    PLACES,
    PLAYER,
    SELECTION,
    UNKNOWN_SELECTION,
)

_BASE = """
lines AS (
  SELECT row_number() OVER () AS doc, l_orderkey, l_linenumber, l_returnflag, l_linestatus,
    'M' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
      || epoch_ms(l_shipdate) AS match_id,
    epoch_ms(l_shipdate) AS game_end,
    'P' || l_suppkey AS own_puuid, p_name AS own_name,
    'P' || (l_partkey % 100) AS rival_puuid, p_brand AS rival_name,
    CAST(l_quantity AS INTEGER) AS qty,
    CAST(round(l_tax * 100) AS INTEGER) AS tax,
    CAST(round(l_discount * 100) AS INTEGER) AS discount,
    (l_orderkey * 31 + l_suppkey * 17 + l_linenumber * 7) % 100
      < 43 + (length(p_name) * 5 + ascii(right(p_name, 1))) % 14 AS own_win,
    l_linenumber % 2 = 0 AS rival_first
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
games AS (
  SELECT doc, match_id, l_returnflag, l_linestatus, own_puuid AS puuid, own_name AS champion,
    qty AS kills, l_linenumber AS deaths, tax AS assists, own_win AS win,
    CASE WHEN rival_first THEN 1 ELSE 0 END AS place
  FROM lines
  UNION ALL
  SELECT doc, match_id, l_returnflag, l_linestatus, rival_puuid, rival_name,
    l_linenumber, qty, discount, NOT own_win,
    CASE WHEN rival_first THEN 0 ELSE 1 END
  FROM lines
),
first_games AS (
  SELECT * FROM games
  QUALIFY row_number() OVER (PARTITION BY doc, puuid ORDER BY place) = 1
)"""


def _entry(puuid: str, name: str, kills: str, deaths: str, assists: str, win: str) -> str:
    return (
        f"""('{{"puuid":"' || {puuid} || '","championName":"' || {name} || '","kills":' || {kills}"""
        f""" || ',"deaths":' || {deaths} || ',"assists":' || {assists} || ',"win":' ||"""
        f""" CASE WHEN {win} THEN 'true' ELSE 'false' END || '}}')"""
    )


_OWN = _entry("own_puuid", "own_name", "qty", "l_linenumber", "tax", "own_win")
_RIVAL = _entry("rival_puuid", "rival_name", "l_linenumber", "qty", "discount", "NOT own_win")

_DOCUMENTS = f"""{_BASE},
documents_ AS (
  SELECT l_orderkey, match_id,
    '{{"metadata":{{"matchId":"' || match_id || '"}},"info":{{"gameEndTimestamp":' || game_end ||
    ',"participants":[' ||
    CASE WHEN rival_first THEN {_RIVAL} || ',' || {_OWN} ELSE {_OWN} || ',' || {_RIVAL} END
    || ']}}}}' AS json_payload
  FROM lines
)"""

_DAMAGED = f"""{_DOCUMENTS},
parts AS (
  SELECT *, '"metadata":{{"matchId":"' || match_id || '"}}' AS metadata,
    '"' || match_id || '"' AS id_text,
    '{{"metadata":{{"matchId":"' || match_id || '"}},"info":{{"participants":[' AS head,
    regexp_extract(json_payload, '"participants":\\[(.*)\\]', 1) AS entries
  FROM documents_
),
damaged AS (
  SELECT
    CASE l_orderkey % 50
      WHEN 0 THEN left(json_payload, length(json_payload) - 5)
      WHEN 1 THEN '{{"status":{{"message":"Rate limit exceeded","status_code":429}}}}'
      WHEN 2 THEN '{{"metadata":{{"matchId":"' || match_id || '"}},"info":{{"participants":null}}}}'
      WHEN 3 THEN ''
      WHEN 4 THEN replace(json_payload, metadata || ',', '')
      WHEN 5 THEN replace(json_payload, metadata, '"metadata":{{}}')
      WHEN 6 THEN replace(json_payload, metadata, '"metadata":null')
      WHEN 7 THEN replace(json_payload, metadata, '"metadata":"s"')
      WHEN 8 THEN replace(json_payload, id_text, 'null')
      WHEN 9 THEN replace(json_payload, id_text, l_orderkey::VARCHAR)
      WHEN 10 THEN replace(json_payload, id_text, '"D1","matchId":' || id_text)
      WHEN 11 THEN replace(json_payload, id_text, '{{"q":' || id_text || '}}')
      WHEN 12 THEN head || 'null]}}}}'
      WHEN 13 THEN head || 'null,' || entries || ']}}}}'
      WHEN 14 THEN head || '5,' || entries || ']}}}}'
      WHEN 15 THEN regexp_replace(json_payload, '"kills":(\\d+)', '"kills":"\\1"', 'g')
      WHEN 16 THEN regexp_replace(json_payload, '"win":(true|false)', '"win":"\\1"', 'g')
      WHEN 17 THEN replace(json_payload, '"assists":', '"assists":1.5,"none":')
      WHEN 18 THEN head || entries || repeat(',' || replace(entries, '"kills":', '"kills":9'), 4) || ']}}}}'
      ELSE json_payload END AS json_payload,
    CASE WHEN l_orderkey % 50 IN (0, 3) THEN 'invalid_json' WHEN l_orderkey % 50 = 1 THEN 'api_error'
      WHEN l_orderkey % 50 IN (2, 14) THEN 'no_participants'
      WHEN l_orderkey % 50 IN (6, 7, 8) THEN 'no_match_id'
      WHEN l_orderkey % 50 = 12 THEN 'no_usable_participants' ELSE 'ok' END AS payload_status
  FROM parts
)"""


def _average(column: str) -> str:
    """Mean of whole numbers to one decimal, halves up, in integer arithmetic."""
    return (
        f"CAST((20 * sum({column}) + count({column})) // (2 * count({column})) AS DOUBLE) / 10"
        f" AS media_{column}"
    )


def _stats(source: str, keys: str = "champion") -> str:
    rate = "CAST(sum(CAST(win AS INTEGER)) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100"
    return f"""
  SELECT {keys}, count(*) AS total_partidas,
    CAST(sum(CAST(win AS INTEGER)) AS BIGINT) AS vitorias,
    {_average('kills')}, {_average('deaths')}, {_average('assists')},
    CAST(round(CAST(CAST({rate} AS VARCHAR) AS DECIMAL(38,18)), 1) AS DOUBLE) AS win_rate_pct
  FROM {source} GROUP BY {keys}"""


_FEED = f"""{_BASE},
stats AS ({_stats('games')}),
feed AS (
  SELECT champion, win_rate_pct, coalesce(total_partidas, 1000) AS matches_played FROM stats
)"""


def _metrics_of(feed: str) -> str:
    return f"""
  SELECT f.*,
    CASE WHEN x.n < 3 THEN 'B-Tier'
      WHEN win_rate_pct > 0 AND win_rate_pct <= 49 THEN 'C-Tier'
      WHEN win_rate_pct > 49 AND win_rate_pct <= 51 THEN 'B-Tier'
      WHEN win_rate_pct > 51 AND win_rate_pct <= 53 THEN 'A-Tier'
      WHEN win_rate_pct > 53 AND win_rate_pct <= 100 THEN 'S-Tier'
      ELSE 'B-Tier' END AS tier,
    win_rate_pct - 50 AS win_rate_delta,
    CASE WHEN x.n < 3 THEN 50e0 ELSE (win_rate_pct - rate_min)
      / greatest(rate_max - rate_min, 1e-9) * 100 END AS wr_normalized,
    CASE WHEN x.n < 3 THEN 50e0 ELSE CAST(matches_played - played_min AS DOUBLE)
      / greatest(CAST(played_max - played_min AS DOUBLE), 1e-9) * 100 END AS pop_normalized
  FROM {feed} f, (
    SELECT count(*) AS n, min(win_rate_pct) AS rate_min, max(win_rate_pct) AS rate_max,
      min(matches_played) AS played_min, max(matches_played) AS played_max FROM {feed}) x"""


_MEAN = "avg(win_rate_pct)"
_BEST = "win_rate_pct DESC NULLS LAST, champion"
_METRICS = f"""{_FEED},
metrics AS ({_metrics_of('feed')})"""


def _case(column: str, values: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items())
    return f"CASE {column} {whens} ELSE '{default}' END"


def _names(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _ranked(values: list[str], name: str, rank: str) -> str:
    rows = ", ".join(f"('{v}', {i})" for i, v in enumerate(values))
    return f"(VALUES {rows}) t({name}, {rank})"


_DELTA = "round_even(win_rate_pct - 50, 1)"
_LABEL = (
    f"'  ' || format('{{:.1f}}', win_rate_pct) || '%  ' || CASE WHEN {_DELTA} >= 0 THEN '▲'"
    f" ELSE '▼' END || format('{{:.1f}}', abs({_DELTA}))"
)
_DELTA_LABEL = (
    f"CASE WHEN {_DELTA} < 0 THEN '' ELSE '+' END || format('{{:.1f}}', {_DELTA})"
)
_COMPARISON = f"""SELECT champion, win_rate_pct, {_DELTA} AS delta, {_LABEL} AS label,
  {_DELTA_LABEL} AS delta_label, tier, matches_played,
  format('{{:,}}', matches_played) AS matches_label,
  {_case('tier', TIER_BAR_COLORS, TIER_BAR_DEFAULT)} AS color"""
_LOW, _HIGH = SLIDER_INITIAL
_BUBBLE = (
    f"CAST(matches_played - low AS DOUBLE) / (CAST(high - low AS DOUBLE) + 1e-9)"
    f" * {BUBBLE_SPAN} + {BUBBLE_MIN}"
)
_SPLIT = """(SELECT median(matches_played) AS mid, min(matches_played) AS low,
  max(matches_played) AS high FROM metrics) s"""
_RANGE = f"""spread AS (
  SELECT *, (hi_end - lo_end) / {HISTOGRAM_BINS} AS step FROM (
    SELECT CASE WHEN lo = hi THEN lo - 0.5e0 ELSE lo END AS lo_end,
      CASE WHEN lo = hi THEN hi + 0.5e0 ELSE hi END AS hi_end, lo, hi
    FROM (SELECT min(win_rate_pct) AS lo, max(win_rate_pct) AS hi FROM metrics))
)"""
_ICON = f"'{ICON_URL_PREFIX}' || translate(champion, ' ''.', '') || '{ICON_URL_SUFFIX}'"


def _radar(places: str) -> str:
    axes = ", ".join(
        f"({i}, '{axis}')" for i, axis in enumerate([*RADAR_AXES, RADAR_AXES[0]])
    )
    return f"""WITH {_METRICS},
places AS ({places}),
compared AS (
  SELECT champion, row_number() OVER (ORDER BY place) - 1 AS place, count(*) OVER () AS n
  FROM places)
SELECT CAST(c.place AS INTEGER) AS place, champion, CAST(axis_pos AS INTEGER) AS axis_pos, axis,
  CASE axis_pos
    WHEN 1 THEN pop_normalized
    WHEN 2 THEN least(greatest((win_rate_delta + 10) * 5, 0e0), 100e0)
    WHEN 3 THEN (wr_normalized + pop_normalized) / 2
    ELSE wr_normalized END AS value
FROM compared c JOIN metrics USING (champion), (VALUES {axes}) a(axis_pos, axis)
WHERE c.n >= 2 AND c.place < 5"""


def _trend(delta: str) -> str:
    shown = f"round({delta}, {PLACES})"
    return f"CASE WHEN {shown} >= 0 THEN '▲ ' ELSE '▼ ' END || format('{{:.1f}}', abs({shown}))"


def _windowed_stats(keys: str) -> str:
    """Upsert of the later window's statistics into the earlier one's."""
    same = " AND ".join(f"s.{k} = t.{k}" for k in keys.split(", "))
    return f"""WITH {{base}},
earlier AS (SELECT * FROM {{source}} WHERE l_returnflag <> 'R'),
later AS (SELECT * FROM {{source}} WHERE l_returnflag = 'R'),
target AS ({_stats('earlier', keys)}),
source AS ({_stats('later', keys)})
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE {same})
UNION ALL SELECT * FROM source""".format(base=_BASE, source="games")


_DEMO = ", ".join(f"('{c}', CAST({r} AS DOUBLE), {p})" for c, r, p in DEMO_ROWS)

ORACLE: dict[str, str] = {
    "bronze_payloads": f"WITH {_DOCUMENTS} SELECT json_payload FROM documents_",
    "bronze_preview": f"""WITH {_DOCUMENTS}
SELECT json_payload FROM documents_ ORDER BY json_payload LIMIT 5""",
    "payload_status": f"""WITH {_DAMAGED}
SELECT payload_status, count(*) AS n FROM damaged GROUP BY payload_status""",
    "quarantined_payloads": f"""WITH {_DAMAGED}
SELECT json_payload, payload_status FROM damaged WHERE payload_status <> 'ok'""",
    "latest_n_matches": f"""WITH {_BASE},
played AS (
  SELECT own_puuid AS puuid, match_id, game_end AS game_ts FROM lines
  UNION SELECT rival_puuid, match_id, game_end FROM lines)
SELECT puuid, CAST(rank AS INTEGER) AS rank, match_id, game_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY puuid ORDER BY game_ts DESC, match_id) AS rank
  FROM played) WHERE rank <= {LATEST_MATCHES}""",
    "latest_documents": f"""WITH {_DOCUMENTS},
played AS (
  SELECT match_id FROM lines WHERE own_puuid = '{PLAYER}' OR rival_puuid = '{PLAYER}'
  ORDER BY game_end DESC, match_id LIMIT {LATEST_MATCHES})
SELECT json_payload FROM documents_ WHERE match_id IN (SELECT match_id FROM played)""",
    "latest_documents_indexed": f"""WITH {_DOCUMENTS},
played AS (
  SELECT match_id FROM lines WHERE own_puuid = '{PLAYER}' OR rival_puuid = '{PLAYER}'
  ORDER BY game_end DESC, match_id LIMIT {LATEST_MATCHES})
SELECT json_payload FROM documents_ WHERE match_id IN (SELECT match_id FROM played)""",
    "silver_player_games": f"""WITH {_BASE}
SELECT match_id, champion, kills, deaths, assists, win FROM first_games
WHERE puuid = '{PLAYER}'""",
    "silver_damaged_documents": f"""WITH {_BASE}
SELECT CASE l_orderkey % 50 WHEN 4 THEN '' WHEN 5 THEN '' WHEN 9 THEN l_orderkey::VARCHAR
    WHEN 11 THEN '{{"q":"' || g.match_id || '"}}' ELSE g.match_id END AS match_id,
  champion, CASE WHEN l_orderkey % 50 <> 15 THEN kills END AS kills, deaths,
  CASE WHEN l_orderkey % 50 <> 17 THEN assists END AS assists,
  CASE WHEN l_orderkey % 50 <> 16 THEN win END AS win
FROM first_games g JOIN lines l USING (doc)
WHERE puuid = '{PLAYER}' AND l_orderkey % 50 NOT IN (0, 1, 2, 3, 6, 7, 8, 12, 14)""",
    "silver_damaged_documents_strict": f"""WITH {_BASE}
SELECT CASE l_orderkey % 50 WHEN 4 THEN '' WHEN 5 THEN '' WHEN 9 THEN l_orderkey::VARCHAR
    WHEN 11 THEN '{{q=' || g.match_id || '}}' ELSE g.match_id END AS match_id,
  champion, CASE WHEN l_orderkey % 50 <> 15 THEN kills END AS kills, deaths,
  CASE WHEN l_orderkey % 50 <> 17 THEN assists END AS assists,
  CASE WHEN l_orderkey % 50 <> 16 THEN win END AS win
FROM first_games g JOIN lines l USING (doc)
WHERE puuid = '{PLAYER}' AND l_orderkey % 50 NOT IN (0, 1, 2, 3, 6, 7, 8, 12, 13, 14)""",
    "silver_all_participants": f"""WITH {_BASE}
SELECT puuid, match_id, champion, kills, deaths, assists, win FROM games""",
    "silver_every_player": f"""WITH {_BASE}
SELECT puuid, match_id, champion, kills, deaths, assists, win FROM first_games""",
    "silver_tracked_players": f"""WITH {_BASE}
SELECT puuid, match_id, champion, kills, deaths, assists, win FROM first_games
WHERE puuid IN (SELECT 'P' || s_suppkey FROM supplier WHERE s_acctbal > 0)""",
    "silver_listed_players": f"""WITH {_BASE}
SELECT puuid, match_id, champion, kills, deaths, assists, win FROM first_games
WHERE puuid IN (SELECT 'P' || (r_regionkey * 2 + 1) FROM region)""",
    "routed_games": f"""WITH {_BASE},
repeated AS (
  SELECT g.*, l.l_orderkey % 50 AS kind, copy FROM games g JOIN lines l USING (doc), range(5) c(copy)
  WHERE copy = 0 OR l.l_orderkey % 50 = 18)
SELECT puuid, CASE kind WHEN 4 THEN '' WHEN 5 THEN '' WHEN 9 THEN (SELECT l_orderkey::VARCHAR FROM lines l WHERE l.doc = r.doc)
    WHEN 11 THEN '{{"q":"' || match_id || '"}}' ELSE match_id END AS match_id, champion,
  CASE WHEN kind = 15 THEN NULL WHEN copy > 0 THEN ('9' || kills)::INTEGER ELSE kills END AS kills, deaths,
  CASE WHEN kind <> 17 THEN assists END AS assists, CASE WHEN kind <> 16 THEN win END AS win
FROM repeated r WHERE kind NOT IN (0, 1, 2, 3, 6, 7, 8, 12, 14)""",
    "routed_quarantine": f"""WITH {_DAMAGED}
SELECT json_payload, payload_status FROM damaged WHERE payload_status <> 'ok'""",
    "gold_champion_stats": f"""WITH {_BASE} {_stats('games')}
ORDER BY total_partidas DESC, champion""",
    "gold_one_player": f"""WITH {_BASE},
mine AS (SELECT * FROM first_games WHERE puuid = '{PLAYER}') {_stats('mine')}""",
    "gold_player_champion": f"WITH {_BASE} {_stats('first_games', 'puuid, champion')}",
    "gold_summed_batches": f"WITH {_BASE} {_stats('games')}",
    "gold_upsert": _windowed_stats("champion"),
    "gold_upsert_players": _windowed_stats("puuid, champion"),
    "gold_upsert_bucketed": _windowed_stats("champion"),
    "gold_upsert_players_bucketed": _windowed_stats("puuid, champion"),
    "table_schema_change": f"WITH {_BASE} {_stats('games')}",
    "table_roundtrip": f"""WITH {_BASE}
SELECT match_id, puuid, champion, kills, deaths, assists, win FROM games""",
    "stage_counts": f"""WITH {_BASE},
mine AS (SELECT * FROM first_games WHERE puuid = '{PLAYER}')
SELECT 'bronze' AS stage, count(*) AS n FROM lines
UNION ALL SELECT 'silver', count(*) FROM mine
UNION ALL SELECT 'gold', count(DISTINCT champion) FROM mine""",
    "stage_counts_latest": f"""WITH {_BASE},
mine AS (
  SELECT g.match_id, champion FROM first_games g JOIN lines l USING (doc)
  WHERE puuid = '{PLAYER}' ORDER BY game_end DESC, g.match_id LIMIT {LATEST_MATCHES})
SELECT 'bronze' AS stage, count(*) AS n FROM mine
UNION ALL SELECT 'silver', count(*) FROM mine
UNION ALL SELECT 'gold', count(DISTINCT champion) FROM mine""",
    "stream_gold": f"WITH {_BASE} {_stats('first_games')}",
    "stream_latest": f"""WITH {_BASE},
played AS (
  SELECT own_puuid AS puuid, match_id, game_end AS game_ts FROM lines
  UNION SELECT rival_puuid, match_id, game_end FROM lines)
SELECT puuid, CAST(rank AS INTEGER) AS rank, match_id, game_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY puuid ORDER BY game_ts DESC, match_id) AS rank
  FROM played) WHERE rank <= {LATEST_MATCHES}""",
    "feed_snapshots": f"""WITH {_FEED}
SELECT source, champion, win_rate_pct, matches_played FROM feed, (VALUES ('good'), ('failing')) s(source)""",
    "champion_feed": f"WITH {_FEED} SELECT * FROM feed ORDER BY {_BEST}",
    "normalize_columns": f"WITH {_FEED} SELECT champion, win_rate_pct, matches_played FROM feed",
    "feed_or_fallback": f"""WITH {_FEED},
demo(champion, win_rate_pct, matches_played) AS (VALUES {_DEMO})
SELECT 'good' AS source, champion, win_rate_pct, matches_played FROM feed
UNION ALL SELECT c.source, d.champion, d.win_rate_pct, d.matches_played
FROM demo d, (VALUES ('empty'), ('incomplete'), ('missing')) c(source)""",
    "champion_metrics": f"WITH {_METRICS} SELECT * FROM metrics",
    "champion_metrics_small": f"""WITH {_BASE},
by_status AS (SELECT * REPLACE (l_linestatus AS champion) FROM games),
stats AS ({_stats('by_status')}),
feed AS (SELECT champion, win_rate_pct, total_partidas AS matches_played FROM stats)
{_metrics_of('feed')}""",
    "feed_records_json": f"""WITH {_METRICS}
SELECT CAST(to_json(m) AS VARCHAR) AS record FROM metrics m""",
    "as_of_label": """
SELECT 'Last sync: ' || strftime(max(l_shipdate), '%d %b %Y  %H:%M') AS label FROM lineitem""",
    "win_rate_range": f"""WITH {_METRICS}
SELECT * FROM metrics WHERE win_rate_pct BETWEEN {_LOW} AND {_HIGH}""",
    "kpi_summary": f"""WITH {_METRICS},
figures AS (SELECT {_MEAN} AS avg_wr, count(*) AS n_champions FROM metrics),
top AS (SELECT champion, win_rate_pct FROM metrics ORDER BY {_BEST} LIMIT 1)
SELECT round(avg_wr, {PLACES}) AS avg_wr, round(avg_wr - 50, {PLACES}) AS avg_delta,
  champion AS top_champion, win_rate_pct AS top_wr,
  round(win_rate_pct - avg_wr, {PLACES}) AS top_minus_avg, n_champions,
  format('{{:.1f}}', round(avg_wr, {PLACES})) || '%' AS avg_label,
  {_trend('avg_wr - 50')} AS avg_delta_label,
  {_trend('win_rate_pct - avg_wr')} AS top_delta_label FROM figures, top""",
    "kpi_spark_all": f"""WITH {_METRICS}
SELECT row_number() OVER (ORDER BY win_rate_pct NULLS LAST, champion) - 1 AS pos,
  win_rate_pct AS value FROM metrics""",
    "kpi_spark_top5": f"""WITH {_METRICS},
top AS (SELECT win_rate_pct FROM metrics ORDER BY {_BEST} LIMIT 5)
SELECT CAST(row_number() OVER (ORDER BY win_rate_pct NULLS FIRST) - 1 AS INTEGER) AS pos,
  win_rate_pct AS value FROM top""",
    "tier_counts_zero_filled": f"""WITH {_METRICS}
SELECT t.pos, t.tier, count(champion) AS value
FROM {_ranked(TIERS_WORST_FIRST, 'tier', 'pos')} LEFT JOIN metrics m ON m.tier = t.tier
GROUP BY t.pos, t.tier""",
    "top10_win_rate": f"""WITH {_METRICS},
top AS (SELECT * FROM metrics ORDER BY {_BEST} LIMIT 10)
SELECT champion, win_rate_pct, matches_played, tier, win_rate_pct >= 50 AS above_baseline,
  '  ' || format('{{:.1f}}', win_rate_pct) || '%' AS label,
  format('{{:,}}', matches_played) AS matches_label FROM top""",
    "axis_bounds": f"""WITH {_METRICS},
shown AS (SELECT * FROM metrics WHERE win_rate_pct BETWEEN 40 AND 60 ORDER BY {_BEST} LIMIT 5)
SELECT 'top' AS panel, 40e0 AS x_min, greatest(max(win_rate_pct) + 2.5, 53e0) AS x_max
FROM metrics
UNION ALL SELECT 'selected', 40e0, greatest(max(win_rate_pct) + 3.5, 54e0) FROM shown""",
    "volume_median": f"""WITH {_METRICS}
SELECT median(matches_played) AS median_played, min(matches_played) AS min_played,
  max(matches_played) AS max_played FROM metrics""",
    "bubble_sizes": f"""WITH {_METRICS}
SELECT champion, matches_played, win_rate_pct, {_BUBBLE} AS bubble_size FROM metrics, {_SPLIT}""",
    "bubble_highlight": f"""WITH {_METRICS}
SELECT champion,
  CASE WHEN champion = '{HIGHLIGHTED}' THEN ({_BUBBLE}) * 1.9e0 ELSE {_BUBBLE} END AS bubble_size,
  CASE WHEN champion = '{HIGHLIGHTED}' THEN 'star' ELSE 'circle' END AS symbol,
  win_rate_pct >= 50 AS above_baseline FROM metrics, {_SPLIT}""",
    "quadrants": f"""WITH {_METRICS}
SELECT champion, matches_played, win_rate_pct,
  CASE WHEN win_rate_pct >= 50 AND matches_played >= mid THEN 'Meta Dominants'
    WHEN win_rate_pct >= 50 THEN 'Hidden Gems'
    WHEN matches_played >= mid THEN 'High-Volume low WR'
    ELSE 'Niche & Weak' END AS quadrant
FROM metrics, {_SPLIT}""",
    "win_rate_histogram": f"""WITH {_METRICS}, {_RANGE},
edges AS (
  SELECT i AS bin, i * step + lo_end AS lo,
    CASE WHEN i = {HISTOGRAM_BINS - 1} THEN hi_end ELSE (i + 1) * step + lo_end END AS hi,
    (step + lo_end) - lo_end AS width
  FROM spread, range({HISTOGRAM_BINS}) r(i)),
placed AS (
  SELECT (SELECT count(*) - 1 FROM edges e WHERE e.lo <= m.win_rate_pct) AS bin
  FROM metrics m WHERE win_rate_pct IS NOT NULL)
SELECT e.bin, e.lo, e.hi, (e.lo + e.hi) / 2 AS center, e.width, count(p.bin) AS n,
  (e.lo + e.hi) / 2 >= 50 AS above_baseline
FROM edges e LEFT JOIN placed p ON p.bin = e.bin GROUP BY e.bin, e.lo, e.hi, e.width""",
    "win_rate_moments": f"""WITH {_METRICS}
SELECT round({_MEAN}, {PLACES}) AS mean_wr, round(stddev_pop(win_rate_pct), {PLACES}) AS std_wr, count(*) AS n
FROM metrics""",
    "normal_curve": f"""WITH {_METRICS}, {_RANGE},
moments AS (
  SELECT {_MEAN} AS mean, stddev_pop(win_rate_pct) AS deviation, count(*) AS n FROM metrics),
grid AS (
  SELECT i, CASE WHEN i = {CURVE_POINTS - 1} THEN hi + 1
    ELSE i * (((hi + 1) - (lo - 1)) / {CURVE_POINTS - 1}) + (lo - 1) END AS x, step
  FROM spread, range({CURVE_POINTS}) r(i))
SELECT i, round(x, {PLACES}) AS x,
  round(CASE WHEN deviation > 0 THEN 1 / (deviation * sqrt(2 * pi()))
    * exp(-0.5 * ((x - mean) / deviation) * ((x - mean) / deviation)) * n * step END, {PLACES}) AS y
FROM grid, moments""",
    "tier_summary": f"""WITH {_METRICS},
per_tier AS (
  SELECT tier, count(champion) AS n, {_MEAN} AS avg_wr FROM metrics GROUP BY tier)
SELECT t.tier_rank, t.tier, n, round(avg_wr, {PLACES}) AS avg_wr,
  format('Avg WR: {{:.1f}}%  ·  {{}} champs', round(avg_wr, {PLACES}), n) AS label,
  {_case('t.tier', TIER_MAP_COLORS, TIER_MAP_DEFAULT)} AS color
FROM per_tier p JOIN {_ranked(TIERS_BEST_FIRST, 'tier', 'tier_rank')} ON p.tier = t.tier
ORDER BY t.tier_rank""",
    "tier_attributes": f"""WITH {_METRICS}
SELECT champion, tier, {_case('tier', TIER_MAP_COLORS, TIER_MAP_DEFAULT)} AS map_color,
  {_case('tier', TIER_BAR_COLORS, TIER_BAR_DEFAULT)} AS bar_color FROM metrics""",
    "champion_options": f"""WITH {_METRICS}
SELECT row_number() OVER (ORDER BY {_BEST}) - 1 AS rank, champion AS value,
  champion || '  [' || tier || ']' AS label, champion AS search, {_ICON} AS icon_url,
  {_case('tier', TIER_MAP_COLORS, TIER_MAP_DEFAULT)} AS border_color FROM metrics""",
    "champion_icon_url": f"WITH {_METRICS} SELECT champion, {_ICON} AS icon_url FROM metrics",
    "champion_lookup": f"""WITH {_METRICS}
SELECT * FROM metrics WHERE champion = '{HIGHLIGHTED}' ORDER BY {_BEST} LIMIT 1""",
    "default_selection": f"""WITH {_METRICS}
SELECT * FROM metrics WHERE win_rate_pct BETWEEN {_LOW} AND {_HIGH} ORDER BY {_BEST} LIMIT 5""",
    "selection_places": f"""WITH {_METRICS}
SELECT place, champion FROM {_ranked(SELECTION, 'champion', 'place')}
WHERE champion IN (SELECT champion FROM metrics)""",
    "selected_champions": f"""WITH {_METRICS} {_COMPARISON} FROM metrics
WHERE champion IN ({_names(SELECTION)}) ORDER BY win_rate_pct, champion""",
    "selected_unknown": f"""WITH {_METRICS},
pool AS (SELECT * FROM metrics WHERE win_rate_pct BETWEEN {_LOW} AND {_HIGH}),
known AS (SELECT * FROM metrics WHERE champion IN ({_names(UNKNOWN_SELECTION)})),
shown AS (
  SELECT * FROM known
  UNION ALL (SELECT * FROM pool WHERE (SELECT count(*) FROM known) = 0 ORDER BY {_BEST} LIMIT 5))
{_COMPARISON} FROM shown ORDER BY win_rate_pct, champion""",
    "selected_labels": f"""WITH {_METRICS}
SELECT champion, {_DELTA} AS delta, {_LABEL} AS label, {_DELTA_LABEL} AS delta_label
FROM metrics""",
    "radar_scores": _radar(
        f"SELECT place, champion FROM {_ranked(SELECTION, 'champion', 'place')}"
        " WHERE champion IN (SELECT champion FROM metrics)"
    ),
    "radar_default": _radar(
        f"SELECT row_number() OVER (ORDER BY {_BEST}) AS place, champion FROM metrics"
        f" WHERE win_rate_pct BETWEEN 40 AND 60 ORDER BY {_BEST} LIMIT 5"
    ),
}
# The stream counts a player's first entry of a document only.
ORACLE["stream_panels"] = ORACLE["win_rate_histogram"].replace("FROM games GROUP BY", "FROM first_games GROUP BY")
