"""The same results in SQL, written for DuckDB without looking at the Spark plans.

The pieces below are WITH items; each oracle lists the ones it needs.
"""

from __future__ import annotations

AS_OF = "2024-05-15"
CLUB_GAMES = 256

_MOVE = """CASE event_type WHEN 'view' THEN 'e4' WHEN 'click' THEN 'Nf3' WHEN 'signup' THEN 'O-O'
    WHEN 'error' THEN 'Bxc6+' WHEN 'purchase' THEN 'e8=Q#' END"""

# event -> (game g, ply n)
CUT = """cut AS (
  SELECT event_id, event_type, value,
    (event_id // 200) * 4 + CASE WHEN event_id % 200 = 0 THEN 1 WHEN event_id % 200 < 13 THEN 2
      WHEN event_id % 200 < 60 THEN 3 ELSE 4 END AS g,
    event_id % 200 + CASE WHEN event_id % 200 = 0 THEN 1 WHEN event_id % 200 < 13 THEN 0
      WHEN event_id % 200 < 60 THEN -12 ELSE -59 END AS n
  FROM events)"""

CUT_LONG = """cut AS (
  SELECT event_id, event_type, value, event_id + 1 AS n,
    CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 WHEN 'error' THEN 4
      WHEN 'purchase' THEN 5 END AS g
  FROM events)"""

MV = f"""raw AS (
  SELECT *, CAST(floor(value * 10) AS BIGINT) % 601 - 300 AS x,
    CAST(floor(value * 100) AS BIGINT) % 801 AS win, CAST(floor(value * 1000) AS BIGINT) % 200 AS draw,
    DATE '2023-01-01' + CAST(g * 11 % 500 AS INTEGER) AS day
  FROM cut),
mv AS (
  SELECT CAST(g AS BIGINT) AS g, CAST(n AS BIGINT) AS n, {_MOVE} AS mo,
    CASE WHEN event_id % 97 <> 0 THEN CASE WHEN event_id % 50 = 0 THEN 'mate' ELSE 'cp' END END AS et,
    CASE WHEN event_id % 97 <> 0 THEN x END AS ev,
    CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 53 = 0 THEN [win, draw]
      ELSE [win, draw, 1000 - win - draw] END AS wdl,
    'g/' || g AS link,
    'Customer#' || lpad(CAST(g // 8 AS VARCHAR), 9, '0') AS wh,
    'Customer#' || lpad(CAST(g // 8 + 1 + g % 5 AS VARCHAR), 9, '0') AS bl,
    day, strftime(day, '%Y.%m.%d') AS dd, lpad(CAST(g % 24 AS VARCHAR), 2, '0') AS hh,
    CASE g % 3 WHEN 0 THEN '1-0' WHEN 1 THEN '0-1' ELSE '1/2-1/2' END AS res
  FROM raw)"""

# Plies of the games that have a text with moves in it, scored by position digest.
TEXT_PLIES = """played AS (SELECT *, (n - 1) // 16 AS b FROM mv WHERE g % 11 <> 0 AND g % 13 <> 0),
blocks AS (SELECT g, b, string_agg(mo, ' ' ORDER BY n) AS t FROM played GROUP BY g, b),
chain AS (
  SELECT g, b, '' AS h FROM blocks WHERE b = 0
  UNION ALL SELECT c.g, c.b + 1, md5(c.h || ' ' || k.t) FROM chain c JOIN blocks k ON k.g = c.g AND k.b = c.b),
digests AS (
  SELECT p.* EXCLUDE (b), md5(h || ' ' || string_agg(mo, ' ') OVER (PARTITION BY p.g, p.b ORDER BY n)) AS pos
  FROM played p JOIN chain c ON c.g = p.g AND c.b = p.b),
numbers AS (
  SELECT *, ('0x' || substr(pos, 1, 6))::BIGINT % 601 - 300 AS v1, ('0x' || substr(pos, 7, 6))::BIGINT % 801 AS v2,
    ('0x' || substr(pos, 13, 6))::BIGINT % 200 AS v3, ('0x' || substr(pos, 19, 2))::BIGINT % 32 = 0 AS none
  FROM digests),
tx AS (
  SELECT * REPLACE (
    CASE WHEN g % 17 <> 0 THEN link END AS link,
    CASE WHEN NOT none THEN 'cp' END AS et,
    CASE WHEN NOT none THEN v1 END AS ev,
    CASE WHEN NOT none THEN [v2, v3, 1000 - v2 - v3] END AS wdl)
  FROM numbers)"""


def scored(source: str = "mv") -> str:
    """sp: one scored row per ply; means of the sides by join, not by window."""
    return f"""ago AS (
  SELECT *, list_extract(wdl, -3) AS w, list_extract(wdl, -2) AS d,
    lag(ev) OVER o AS ev0, lag(list_extract(wdl, -3)) OVER o AS w0, lag(list_extract(wdl, -2)) OVER o AS d0
  FROM {source} WINDOW o AS (PARTITION BY g ORDER BY n)),
chance AS (
  SELECT *, (w0 + 0.5 * d0) / 1000 AS wp0, 1 - (w + 0.5 * d) / 1000 AS wp1,
    CASE WHEN n % 2 = 1 THEN ev0 - ev ELSE ev - ev0 END AS loss,
    CASE WHEN n % 2 = 1 THEN wh ELSE bl END AS mover
  FROM ago),
curve AS (
  SELECT *, wp0 - wp1 AS del,
    CASE WHEN wp0 - wp1 IS NULL THEN 100.0::DOUBLE
      ELSE greatest(0.0, least(100.0, 103.1668 * exp(-0.04354 * (wp0 - wp1) * 100) - 3.1669)) END AS acc
  FROM chance),
means AS (
  SELECT g,
    round(avg(CASE WHEN n % 2 = 1 THEN CASE WHEN loss > 0 THEN loss ELSE 0 END END), 2) AS lw,
    round(avg(CASE WHEN n % 2 = 0 THEN CASE WHEN loss > 0 THEN loss ELSE 0 END END), 2) AS lb,
    round(avg(CASE WHEN n % 2 = 1 THEN acc END), 2) AS aw,
    round(avg(CASE WHEN n % 2 = 0 THEN acc END), 2) AS ab
  FROM curve GROUP BY g),
sp AS (
  SELECT c.*, lw, lb, aw, ab,
    CASE WHEN n >= 1 AND n <= 10 THEN 'opening' WHEN n >= 11 AND n <= 25 THEN 'middlegame' ELSE 'endgame' END AS ph
  FROM curve c JOIN means USING (g))"""


SIDES = """sheet AS (SELECT DISTINCT g, link, wh, bl, day, res, aw, ab FROM sp),
sides AS (
  SELECT g, day, lower(wh) AS player, 'white' AS colour, aw AS a,
    CASE WHEN res = '1-0' THEN 1 ELSE 0 END AS won, CASE WHEN res = '0-1' THEN 1 ELSE 0 END AS lost FROM sheet
  UNION ALL
  SELECT g, day, lower(bl), 'black', ab,
    CASE WHEN res = '0-1' THEN 1 ELSE 0 END, CASE WHEN res = '1-0' THEN 1 ELSE 0 END FROM sheet)"""

MISTAKES = """mi AS (
  SELECT lower(mover) AS player, n, ph, CAST(round(del * 2000) AS BIGINT) AS steps,
    CASE WHEN round(del, 6) >= 0.3 THEN 'blunder' WHEN round(del, 6) >= 0.2 THEN 'mistake' ELSE 'inaccuracy' END AS kind
  FROM sp WHERE round(del, 6) >= 0.1)"""

MONTHLY = """monthly AS (
  SELECT player, colour, date_trunc('month', day) AS m, count(*) AS c, round(sum(won) / count(*), 4) AS r,
    round(avg(CAST(round(a * 100) AS BIGINT))) / 100 AS a
  FROM sides GROUP BY ALL)"""

ARCHIVE = f"""games AS (
  SELECT DISTINCT g, 'club' || (g // {CLUB_GAMES}) AS player, strftime(day, '%Y-%m') AS "month", 'u/' || g AS url,
    g % 11 <> 0 AS has_text,
    CAST(date_diff('day', DATE '1970-01-01', CAST(day AS DATE)) * 86400 + g % 24 * 3600 + 2700 AS BIGINT) AS end_time
  FROM mv)"""

MONTHS = f"""months AS (
  SELECT CAST(unnest(generate_series(date_trunc('month', DATE '{AS_OF}' - 760), date_trunc('month', DATE '{AS_OF}'),
    INTERVAL 1 MONTH)) AS DATE) AS m)"""


def query(*items: str, select: str) -> str:
    return ("WITH RECURSIVE " if TEXT_PLIES in items else "WITH ") + ",\n".join(items) + "\n" + select


def _r6(expr: str, name: str) -> str:
    return f"round({expr} * 1000000) / 1000000 + 0.0 AS {name}"


def analysis(game: str) -> str:
    return f"""{game}, n AS "Move_Number", mo AS "Move", loss AS "CentiPawnLoss", mover AS "Player_To_Move",
  {_r6('acc', 'move_accuracy')}, lw AS "ACPL_White", lb AS "ACPL_Black", aw AS "Game_Accuracy_White",
  ab AS "Game_Accuracy_Black", ph AS game_phase"""


GAME = 'g AS "Game_Number"'
NULL_GAME = 'nullif(g, 1) AS "Game_Number"'
PLY = 'n AS "Move_Number"'
FLAT = f"""{GAME}, {PLY}, mo AS "Move", et AS eval_type, ev AS eval_value, array_to_string(wdl, '/') AS wdl,
  wh AS "White", bl AS "Black", dd AS "End_Date\""""
BASE = (CUT, MV)
SCORED = (CUT, MV, scored())
TEXT = (CUT, MV, TEXT_PLIES)
LINKED = """coalesce(link, 'none') AS "Game_Link\""""


def performance(where: str, *source: str) -> str:
    return query(
        *(source or SCORED),
        SIDES,
        MONTHLY,
        """spread AS (
  SELECT player, colour, m, c, r, a, 0 AS c0, CAST(NULL AS DOUBLE) AS r0, CAST(NULL AS DOUBLE) AS a0 FROM monthly
  UNION ALL SELECT player, colour, m + INTERVAL 1 MONTH, 0, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), c, r, a FROM monthly)""",
        select=f"""SELECT player, colour, strftime(m, '%Y-%m') AS "month", CAST(sum(c) AS BIGINT) AS games,
  max(r) AS win_rate, max(a) AS avg_accuracy, CAST(sum(c0) AS BIGINT) AS prev_games, max(r0) AS prev_win_rate,
  max(a0) AS prev_accuracy FROM spread WHERE {where} GROUP BY player, colour, m""",
    )


SNAPSHOTS = """snaps AS (
  SELECT '2024-01-01' AS snapshot, * FROM mv WHERE n <= 10
  UNION ALL SELECT '2024-01-08', * FROM mv WHERE n <= 25
  UNION ALL SELECT '2024-01-15', * FROM mv WHERE n > 10)"""


def per_snapshot(where: str) -> str:
    return query(
        *BASE,
        SNAPSHOTS,
        select=f"""SELECT snapshot, count(*) AS plies, CAST(sum(ev) AS BIGINT) AS eval_sum
  FROM snaps WHERE {where} GROUP BY snapshot""",
    )


def triggers(*items: str) -> str:
    return query(
        *items,
        """tr AS (
  SELECT lower(mover) AS player, g, n, ph,
    CASE WHEN round(del, 6) >= 0.3 THEN 'blunder' WHEN round(del, 6) >= 0.2 THEN 'mistake' ELSE 'inaccuracy' END AS kind,
    CASE WHEN wp0 IS NULL THEN 'unknown' WHEN wp0 < 0.35 THEN 'losing' WHEN wp0 > 0.65 THEN 'winning' ELSE 'even' END AS state
  FROM sp WHERE round(del, 6) >= 0.1)""",
        """ag AS (
  SELECT t.player, kind, state, t.ph AS game_phase, CASE WHEN b.mo IS NULL THEN 'none' WHEN b.mo LIKE 'O-O%' THEN 'castling'
    WHEN contains(b.mo, '=') THEN 'promotion' WHEN contains(b.mo, 'x') THEN 'capture'
    WHEN contains(b.mo, '+') OR contains(b.mo, '#') THEN 'check' ELSE 'quiet' END AS after_move
  FROM tr t LEFT JOIN sp b ON b.g = t.g AND b.n = t.n - 1)""",
        "ct AS (SELECT player, kind, after_move, state, game_phase, count(*) AS n FROM ag GROUP BY ALL)",
        select="""SELECT *, round(n / sum(n) OVER (PARTITION BY player), 4) AS share,
  row_number() OVER (PARTITION BY player ORDER BY n DESC, kind, after_move, state, game_phase) AS rank FROM ct""",
    )


REFRESHED = query(*TEXT, scored("tx"), select=f"SELECT {analysis(LINKED)} FROM sp")

ORACLES: dict[str, str] = {
    "move_analysis": query(*SCORED, select=f"SELECT {analysis(GAME)} FROM sp ORDER BY g, n"),
    "move_analysis_long_games": query(CUT_LONG, MV, scored(), select=f"SELECT {analysis(GAME)} FROM sp"),
    "move_analysis_null_game": query(CUT_LONG, MV, scored(), select=f"SELECT {analysis(NULL_GAME)} FROM sp"),
    "move_analysis_long_ordered": query(CUT_LONG, MV, scored(), select=f"SELECT {analysis(GAME)} FROM sp"),
    "eval_fields": query(
        *BASE, select=f'SELECT {GAME}, {PLY}, et AS "Evaluation_Type", ev AS "Evaluation_Value" FROM mv'
    ),
    "wdl_from_end": query(
        *BASE,
        select=f"""SELECT {GAME}, {PLY}, CASE WHEN len(wdl) >= 3 THEN wdl[len(wdl) - 2] END AS w,
  wdl[len(wdl) - 1] AS d FROM mv""",
    ),
    "player_to_move": query(
        *BASE, select=f'SELECT {GAME}, {PLY}, CASE n % 2 WHEN 1 THEN wh ELSE bl END AS "Player_To_Move" FROM mv'
    ),
    "centipawn_loss": query(*SCORED, select=f'SELECT {GAME}, {PLY}, loss AS "CentiPawnLoss" FROM sp'),
    "win_probability": query(
        *SCORED,
        select=f"SELECT {GAME}, {PLY}, {_r6('wp0', 'wp_before')}, {_r6('wp1', 'wp_after')}, {_r6('del', 'delta')} FROM sp",
    ),
    "move_accuracy": query(*SCORED, select=f"SELECT {GAME}, {PLY}, {_r6('acc', 'move_accuracy')} FROM sp"),
    "game_phase": query(*SCORED, select=f"SELECT {GAME}, {PLY}, ph AS game_phase FROM sp"),
    "side_aggregates": query(
        *SCORED,
        select=f"""SELECT {GAME}, lw AS "ACPL_White", lb AS "ACPL_Black", aw AS "Game_Accuracy_White",
  ab AS "Game_Accuracy_Black", count(*) AS plies FROM sp GROUP BY g, lw, lb, aw, ab""",
    ),
    "player_filter": query(
        *SCORED,
        select=f"""SELECT {analysis(GAME)} FROM sp
  WHERE lower(wh) = 'customer#000000001' OR lower(bl) = 'customer#000000001'""",
    ),
    "phase_breakdown": query(
        *SCORED,
        select="""SELECT lower(mover) AS player, ph AS game_phase, round(avg(acc), 2) AS avg_accuracy
  FROM sp GROUP BY ALL ORDER BY 1, 2""",
    ),
    "phase_drop": query(
        *SCORED,
        """pm AS (
  SELECT lower(mover) AS player, ph, CASE ph WHEN 'opening' THEN 1 WHEN 'middlegame' THEN 2 ELSE 3 END AS o,
    round(avg(acc), 2) AS a
  FROM sp GROUP BY ALL)""",
        """dr AS (
  SELECT *, CAST(round((lag(a) OVER (PARTITION BY player ORDER BY o) - a) * 100) AS BIGINT) AS fall FROM pm)""",
        select="""SELECT player, max(a) FILTER (ph = 'opening') AS opening, max(a) FILTER (ph = 'middlegame') AS middlegame,
  max(a) FILTER (ph = 'endgame') AS endgame,
  max_by(ph, fall * 10 - o) AS worst_phase, max(fall) / 100 AS accuracy_drop
  FROM dr GROUP BY player""",
    ),
    "performance_summary": performance("true"),
    "performance_as_of": performance(f"m = date_trunc('month', DATE '{AS_OF}')"),
    "performance_of_one": performance("player = 'customer#000000001'"),
    "blunder_triggers": triggers(*SCORED),
    "blunder_habits": query(
        *SCORED,
        MISTAKES,
        """mk AS (
  SELECT player, kind, count(*) AS n, round(sum(steps) * 5 / count(*)) / 10000 AS avg_loss,
    count(*) FILTER (ph = 'opening') AS in_opening, count(*) FILTER (ph = 'middlegame') AS in_middlegame,
    count(*) FILTER (ph = 'endgame') AS in_endgame
  FROM mi GROUP BY player, kind)""",
        select="""SELECT *, round(n / sum(n) OVER (PARTITION BY player), 4) AS share,
  row_number() OVER (PARTITION BY player ORDER BY n DESC, kind) AS rank FROM mk""",
    ),
    "blunder_plies": query(
        *SCORED,
        MISTAKES,
        "st AS (SELECT player, kind, (n - 1) // 10 AS s, count(*) AS c FROM mi GROUP BY ALL)",
        """rk AS (SELECT *, row_number() OVER (PARTITION BY player, kind ORDER BY c DESC, s) AS rank FROM st)""",
        select="""SELECT player, kind, s * 10 + 1 AS from_ply, s * 10 + 10 AS to_ply, c AS n, rank
  FROM rk WHERE rank <= 3""",
    ),
    "opening_repertoire": query(
        *SCORED,
        SIDES,
        "op AS (SELECT g, string_agg(mo, ' ' ORDER BY n) AS opening FROM mv WHERE n <= 2 GROUP BY g)",
        "os AS (SELECT * FROM sides JOIN op USING (g))",
        """po AS (
  SELECT player, opening, count(*) AS games, round(avg(won), 4) AS win_rate,
    round(avg(CAST(round(a * 100) AS BIGINT))) / 100 AS avg_accuracy
  FROM os GROUP BY player, opening)""",
        """rw AS (
  SELECT *, row_number() OVER (PARTITION BY player, opening
    ORDER BY lost DESC, a ASC NULLS LAST, g, colour DESC) AS k FROM os)""",
        "rv AS (SELECT player, opening, string_agg(CAST(g AS VARCHAR), ',' ORDER BY k) AS review_games FROM rw WHERE k <= 3 GROUP BY ALL)",
        """ls AS (
  SELECT 'best' AS side, *, row_number() OVER (PARTITION BY player
    ORDER BY win_rate DESC, avg_accuracy DESC NULLS LAST, opening) AS rank FROM po
  UNION ALL
  SELECT 'worst', *, row_number() OVER (PARTITION BY player
    ORDER BY win_rate, avg_accuracy ASC NULLS LAST, opening) FROM po)""",
        select="""SELECT ls.player, side, rank, ls.opening, games, win_rate, avg_accuracy,
  CASE WHEN side = 'worst' THEN review_games END AS review_games
  FROM ls LEFT JOIN rv ON rv.player = ls.player AND rv.opening = ls.opening WHERE rank <= 3""",
    ),
    "name_openings": query(
        *BASE,
        "op AS (SELECT g, list(mo ORDER BY n) AS ms FROM mv WHERE n <= 6 GROUP BY g)",
        "pr AS (SELECT g, ms, k, array_to_string(ms[1:k], ' ') AS pre FROM op, (SELECT unnest([1, 2, 3]) AS k))",
        """kn AS (
  SELECT DISTINCT pre FROM pr WHERE NOT (len(string_split(pre, ' ')) = 2 AND starts_with(pre, 'O-O')))""",
        """ok AS (
  SELECT g, max(k) AS k FROM pr WHERE k <= len(ms) AND pre IN (SELECT pre FROM kn) GROUP BY g)""",
        select=f"""SELECT {GAME}, array_to_string(ms, ' ') AS opening,
  CASE WHEN k IS NOT NULL THEN '<' || array_to_string(ms[1:k], ' ') || '>' END AS opening_name,
  CAST(k AS BIGINT) AS named_plies FROM op LEFT JOIN ok USING (g)""",
    ),
    "games_to_review": query(
        *SCORED,
        """wp AS (
  SELECT *, lower(mover) AS player, CAST(round(del * 2000) AS BIGINT) AS steps,
    row_number() OVER (PARTITION BY lower(mover), g ORDER BY round(del * 2000) DESC, n) AS k
  FROM sp WHERE del > 0)""",
        "wg AS (SELECT *, row_number() OVER (PARTITION BY player ORDER BY steps DESC, g) AS j FROM wp WHERE k = 1)",
        select=f"""SELECT player, {GAME}, link, n AS ply, mo AS move, steps / 2000 AS loss,
  'lost ' || CAST(round(steps / 20) AS BIGINT) || '% with ' || mo || ' in the ' || ph AS summary
  FROM wg WHERE j <= 5""",
    ),
    "analysis_context": query(
        *SCORED,
        select=f"""SELECT {GAME}, {PLY}, loss AS "CentiPawnLoss", link AS "Game_Link", wh AS "White", bl AS "Black",
  dd AS "End_Date" FROM sp""",
    ),
    "game_headers": query(
        *BASE,
        """hd AS (
  SELECT g, wh, bl, dd, hh, link, res, count(*) AS c, g % 13 = 0 AS junk FROM mv WHERE g % 11 <> 0 GROUP BY ALL)""",
        select=f"""SELECT {GAME}, CASE WHEN NOT junk THEN wh END AS "White", CASE WHEN NOT junk THEN bl END AS "Black",
  CASE WHEN NOT junk THEN dd END AS "Date", CASE WHEN NOT junk THEN hh || ':00:00' END AS "StartTime",
  CASE WHEN NOT junk THEN dd END AS "EndDate", CASE WHEN NOT junk THEN hh || ':45:00' END AS "EndTime",
  CASE WHEN NOT junk AND g % 17 <> 0 THEN link END AS "Link", CASE WHEN NOT junk THEN res END AS "Result",
  CASE WHEN junk THEN 0 ELSE c END AS ply_count FROM hd""",
    ),
    "game_plies": query(*TEXT, select=f'SELECT {GAME}, {PLY}, mo AS "Move" FROM tx'),
    "ply_count": query(
        *BASE,
        select=f"""SELECT {GAME}, CASE WHEN g % 13 = 0 THEN 0 ELSE count(*) END AS ply_count
  FROM mv WHERE g % 11 <> 0 GROUP BY g""",
    ),
    "quarantine": query(
        *BASE,
        select=f"""SELECT DISTINCT {GAME},
  CASE WHEN g % 11 = 0 THEN 'no_text' WHEN g % 13 = 0 THEN 'no_moves' END AS reason,
  CASE WHEN g % 11 = 0 OR g % 13 = 0 THEN 'White,Black,Date,StartTime,EndDate,EndTime,Link'
    WHEN g % 17 = 0 THEN 'Link' ELSE '' END AS missing_headers FROM mv""",
    ),
    "moves_fact": query(
        *TEXT,
        select=f"""SELECT {GAME}, link AS "Game_Link", {PLY}, mo AS "Move", wh AS "White", bl AS "Black",
  dd AS "Start_Date", hh || ':00:00' AS "Start_Time", dd AS "End_Date", hh || ':45:00' AS "End_Time",
  res AS "Result", pos AS position FROM tx""",
    ),
    "score_positions": query(*TEXT, select=f"SELECT {FLAT} FROM tx"),
    "score_book": query(*TEXT, select=f"SELECT {FLAT} FROM tx"),
    "score_join": query(
        *BASE,
        f"sc AS (SELECT {_MOVE} AS mo, max(event_id) AS e FROM events WHERE event_type <> 'signup' GROUP BY 1)",
        """js AS (
  SELECT mv.* REPLACE (CASE WHEN e IS NOT NULL THEN 'cp' END AS et, e % 601 - 300 AS ev,
    CASE WHEN e IS NOT NULL THEN [e % 500, 200, 800 - e % 500] END AS wdl)
  FROM mv LEFT JOIN sc USING (mo))""",
        select=f"SELECT {FLAT} FROM js",
    ),
    "game_numbering": """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS "Game_Number"
  FROM orders""",
    "month_keys": query(
        MONTHS,
        select="""SELECT c_name AS player, year(m) AS year, strftime(m, '%m') AS month_of_year,
  strftime(m, '%Y-%m') AS "month" FROM customer, months""",
    ),
    "archive_flatten": query(
        *BASE,
        ARCHIVE,
        select="""SELECT player, "month", url, has_text, end_time, NULL AS unread FROM games
  UNION ALL SELECT 'club0', '2022-12', NULL, false, NULL, NULL
  UNION ALL SELECT 'club0', '2022-11', NULL, false, NULL, '{"games": [{"pgn' || chr(10)""",
    ),
    "archive_gaps": query(
        *BASE,
        ARCHIVE,
        MONTHS,
        """want AS (SELECT DISTINCT player, strftime(m, '%Y-%m') AS "month" FROM games, months)""",
        select="""SELECT player, "month" FROM want
  EXCEPT SELECT player, "month" FROM games EXCEPT SELECT 'club0', '2022-12'""",
    ),
    "archive_source": query(
        *BASE,
        ARCHIVE,
        select="""SELECT player, "month", url, has_text, end_time, NULL AS unread FROM games
  UNION ALL SELECT 'club0', '2022-12', NULL, false, NULL, NULL
  UNION ALL SELECT 'club0', '2022-11', NULL, false, NULL, '{"games": [{"pgn'""",
    ),
    "archive_outcomes": query(
        *BASE,
        ARCHIVE,
        MONTHS,
        """want AS (SELECT DISTINCT player, strftime(m, '%Y-%m') AS "month" FROM games, months)""",
        select="""SELECT player, "month", CASE WHEN player = 'club0' AND "month" = '2022-11' THEN 'corrupt'
    WHEN player = 'club0' AND "month" = '2022-12' OR (player, "month") IN (SELECT (player, "month") FROM games) THEN 'found'
    ELSE 'absent' END AS status FROM want""",
    ),
    "clean_games": query(
        *BASE, ARCHIVE, select="""SELECT player, "month", url, end_time FROM games WHERE has_text"""
    ),
    "latest_snapshot": query(*BASE, select=f"SELECT {FLAT} FROM mv WHERE n > 10"),
    "snapshot_overwrite": per_snapshot("true"),
    "snapshot_empty_rerun": per_snapshot("snapshot <> '2024-01-15'"),
    "snapshot_crash": query(*BASE, select=f"SELECT {FLAT} FROM mv WHERE n > 10"),
    "moves_scan": query(*BASE, select=f"SELECT {FLAT} FROM mv"),
    "ndjson_inferred": query(*BASE, select=f"SELECT {FLAT} FROM mv"),
    "analysis_ndjson": query(*SCORED, select=f"SELECT {analysis(GAME)} FROM sp"),
    "staging_cleanup": per_snapshot("snapshot <> '2024-01-08'"),
    "ndjson_roundtrip": query(*BASE, select=f"SELECT {FLAT} FROM mv"),
    "run_audit": query(
        *BASE,
        select="""SELECT 'games' AS stage, 'rows' AS counter, count(DISTINCT g) AS "value" FROM mv
  UNION ALL SELECT 'games', 'null_pgn', count(DISTINCT g) FROM mv WHERE g % 11 = 0
  UNION ALL SELECT 'moves', 'rows', count(*) FROM mv
  UNION ALL SELECT 'moves', 'null_Evaluation', count(*) - count(ev) FROM mv
  UNION ALL SELECT 'moves', 'null_WDL Stats', count(*) - count(wdl) FROM mv""",
    ),
    "refresh": REFRESHED,
    "refresh_backfill": REFRESHED,
    "refresh_reports": triggers(*TEXT, scored("tx")),
    "incremental_refresh": REFRESHED,
    "incremental_analysis": REFRESHED,
    "incremental_relanded": REFRESHED,
    "incremental_numbering": query(
        *BASE,
        ARCHIVE,
        """keyed AS (
  SELECT CASE WHEN g % 13 = 0 THEN 'md5:' || md5('not a game record') WHEN g % 17 = 0 THEN 'md5:' ELSE 'g/' || g END AS k,
    CASE WHEN g % 13 <> 0 THEN g END AS one, max(end_time) AS t FROM games WHERE has_text GROUP BY ALL)""",
        select="""SELECT CASE WHEN k LIKE 'md5:%' THEN 'none' ELSE k END AS "Game_Link",
  row_number() OVER (ORDER BY t, k) AS "Game_Number" FROM keyed""",
    ),
    "stream_refresh": REFRESHED,
    "stream_audit": query(
        *BASE,
        ARCHIVE,
        "drops AS (SELECT 0 AS b, * FROM games WHERE g % 3 <> 2 UNION ALL SELECT 1, * FROM games WHERE g % 3 <> 0)",
        select="""SELECT CAST(b AS BIGINT) AS batch, 'raw_games' AS stage, 'rows' AS counter, count(*) AS "value" FROM drops GROUP BY b
  UNION ALL SELECT CAST(b AS BIGINT), 'raw_games', 'null_pgn', count(*) FILTER (WHERE NOT has_text) FROM drops GROUP BY b""",
    ),
    "incremental_reports": triggers(*TEXT, scored("tx")),
    "incremental_performance": performance("true", *TEXT, scored("tx")),
}
ORACLES["name_openings_shuffle"] = ORACLES["name_openings"]
ORACLES["move_analysis_arrays"] = ORACLES["move_analysis"]
ORACLES["player_layout"] = ORACLES["player_filter"]
