import random
from collections import Counter, defaultdict

import pytest

import plyscope as ps
from plyscope.operators import report as rp
from tests.helpers import SCHEMA

NAMES = ["Ann", "Bob", "Cy", "Dee"]
FULL = SCHEMA + ", Game_Link string, End_Date string, Result string"


def season(spark, games=60, seed=1, hot="Ann"):
    """Games in which one player takes part very often; names vary in case."""
    rnd = random.Random(seed)
    rows = []
    for g in range(1, games + 1):
        white = hot if rnd.random() < 0.5 else rnd.choice(NAMES)
        black = rnd.choice([n for n in NAMES if n != white])
        if rnd.random() < 0.5:
            white, black = black, white
        white = rnd.choice([white, white.upper()])
        date = rnd.choice(["2024.01.05", "2024.02.11", "2024.02.27", "2024.04.01", "????.??.??"])
        result = rnd.choice(["1-0", "0-1", "1/2-1/2", "*"])
        for n in range(1, rnd.randint(2, 40)):
            w, d = rnd.randint(0, 700), rnd.randint(0, 300)
            rows.append(
                (g, n, rnd.choice(["e4", "d4", "c4"]), ("cp", rnd.randint(-300, 300)), [w, d, 1000 - w - d],
                 white, black, f"g/{g}", date, result)
            )
    return spark.createDataFrame(rows, FULL)


@pytest.fixture(scope="module")
def played(spark):
    moves = season(spark).cache()
    scored = ps.score_plies(moves).cache()
    return moves, scored, scored.collect()


def by_player(rows):
    out = defaultdict(list)
    for r in rows:
        out[r.Player_To_Move.lower()].append(r)
    return out


def test_player_filter_ignores_case(played):
    _, scored, rows = played
    got = ps.for_player(scored, "aNN", ("White", "Black")).count()
    assert got == sum("ann" in (r.White.lower(), r.Black.lower()) for r in rows)


def test_phase_breakdown_for_one_and_for_all(played):
    _, scored, rows = played
    want = {}
    for player, plies in by_player(rows).items():
        for phase in {r.game_phase for r in plies}:
            acc = [r.move_accuracy for r in plies if r.game_phase == phase]
            want[player, phase] = sum(acc) / len(acc)
    got = {(r.player, r.game_phase): r.avg_accuracy for r in ps.phase_breakdown(scored).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 0.0051 for k in want)
    one = {(r.player, r.game_phase): r.avg_accuracy for r in ps.phase_breakdown(scored, "BOB").collect()}
    assert one == {k: v for k, v in got.items() if k[0] == "bob"}


def test_phase_drop(spark):
    rows = [("a", "opening", 90.0), ("a", "middlegame", 80.0), ("a", "endgame", 60.0), ("b", "opening", 90.0),
            ("b", "endgame", 85.5), ("c", "opening", 50.0), ("d", "middlegame", 50.0), ("d", "endgame", 70.0)]
    df = spark.createDataFrame(rows, "Player_To_Move string, game_phase string, move_accuracy double")
    got = {r.player: (r.worst_phase, r.accuracy_drop) for r in ps.phase_drop(df).collect()}
    assert got == {"a": ("endgame", 20.0), "b": ("endgame", 4.5), "c": (None, None), "d": ("endgame", -20.0)}


def sides_of(rows):
    seen = {}
    for r in rows:
        seen[r.Game_Number] = r
    for g, r in seen.items():
        score = {"1-0": 1.0, "0-1": 0.0, "1/2-1/2": 0.5}.get(r.Result)
        yield g, r, r.White.lower(), "white", score == 1.0, score == 0.0, r.Game_Accuracy_White
        yield g, r, r.Black.lower(), "black", score == 0.0, score == 1.0, r.Game_Accuracy_Black


def test_performance_summary(played):
    _, scored, rows = played
    months = defaultdict(list)
    for _, r, player, colour, won, _, acc in sides_of(rows):
        month = None if "?" in r.End_Date else r.End_Date[:7].replace(".", "-")
        months[player, colour, month].append((won, acc))
    got = {(r.player, r.colour, r.month): r for r in ps.performance_summary(ps.game_sheet(scored)).collect()}
    for key, games in months.items():
        r = got[key]
        accs = [a for _, a in games if a is not None]
        assert r.games == len(games)
        assert abs(r.win_rate - sum(w for w, _ in games) / len(games)) < 1e-4
        assert r.avg_accuracy is None if not accs else abs(r.avg_accuracy - sum(accs) / len(accs)) < 0.0051
    feb, mar = got["ann", "white", "2024-02"], got["ann", "white", "2024-03"]
    jan = got["ann", "white", "2024-01"]
    assert (feb.prev_games, feb.prev_win_rate, feb.prev_accuracy) == (jan.games, jan.win_rate, jan.avg_accuracy)
    assert (mar.games, mar.win_rate, mar.prev_games) == (0, None, feb.games)
    assert jan.prev_games == 0 and jan.prev_win_rate is None


def test_performance_as_of_is_one_month_of_the_history(played):
    _, scored, _ = played
    sheet = ps.game_sheet(scored)
    whole = {tuple(r) for r in ps.performance_summary(sheet).collect() if r.month == "2024-02"}
    assert {tuple(r) for r in ps.performance_summary(sheet, as_of="2024-02-29").collect()} == whole
    ann = {tuple(r) for r in ps.performance_summary(sheet, "ANN", "2024-02-01").collect()}
    assert ann == {r for r in whole if r[0] == "ann"} and len(ann) == 2


def kind_of(delta):
    if delta is None or round(delta, 6) < 0.1:
        return None
    return "blunder" if round(delta, 6) >= 0.3 else "mistake" if round(delta, 6) >= 0.2 else "inaccuracy"


def test_blunder_habits_and_plies(played):
    _, scored, rows = played
    kinds, stretches = defaultdict(Counter), defaultdict(Counter)
    for player, plies in by_player(rows).items():
        for r in plies:
            if kind_of(r.delta):
                kinds[player][kind_of(r.delta)] += 1
                stretches[player, kind_of(r.delta)][(r.Move_Number - 1) // 10] += 1
    habits = ps.blunder_habits(scored).collect()
    assert {(r.player, r.kind): r.n for r in habits} == {(p, k): n for p, c in kinds.items() for k, n in c.items()}
    for r in habits:
        assert r.in_opening + r.in_middlegame + r.in_endgame == r.n
        assert abs(r.share - r.n / kinds[r.player].total()) < 1e-4
        order = sorted(kinds[r.player].items(), key=lambda x: (-x[1], x[0]))
        assert order[r["rank"] - 1][0] == r.kind
    got = defaultdict(list)
    for r in sorted(ps.blunder_plies(scored, k=2).collect(), key=lambda r: r["rank"]):
        got[r.player, r.kind].append(((r.from_ply - 1) // 10, r.n))
    want = {k: sorted(c.items(), key=lambda x: (-x[1], x[0]))[:2] for k, c in stretches.items()}
    assert got == want


def test_boundary_losses_fall_in_the_upper_band(spark):
    df = spark.createDataFrame([("a", 1, "opening", d) for d in (0.1 - 1e-12, 0.2 - 1e-12, 0.0995)],
                               "Player_To_Move string, Move_Number int, game_phase string, delta double")
    assert {r.kind: r.n for r in ps.blunder_habits(df).collect()} == {"inaccuracy": 1, "mistake": 1}


def test_opening_repertoire(played):
    moves, scored, rows = played
    first = defaultdict(dict)
    for r in rows:
        first[r.Game_Number][r.Move_Number] = r.Move
    groups = defaultdict(list)
    for g, _, player, colour, won, lost, acc in sides_of(rows):
        opening = " ".join(first[g][n] for n in sorted(first[g]) if n <= 2)
        groups[player, opening].append((g, colour, won, lost, acc))
    sides = ps.opening_results(ps.game_sheet(scored), ps.first_moves(moves, 2))
    got = ps.opening_repertoire(sides, min_games=2, k=2, review=2).collect()
    players = {p for p, _ in groups}
    assert {r.player for r in got} == players
    for player in players:
        table = []
        for (p, opening), games in groups.items():
            if p == player and len(games) >= 2:
                accs = [a for *_, a in games if a is not None]
                mean = sum(accs) / len(accs) if accs else None
                table.append((round(sum(g[2] for g in games) / len(games), 4), mean, opening, len(games)))
        worst = [r for r in got if r.player == player and r.side == "worst"]
        best = [r for r in got if r.player == player and r.side == "best"]
        assert [r["rank"] for r in sorted(best, key=lambda r: r["rank"])] == list(range(1, min(2, len(table)) + 1))
        assert min(t[0] for t in table) == [r for r in worst if r["rank"] == 1][0].win_rate
        assert max(t[0] for t in table) == [r for r in best if r["rank"] == 1][0].win_rate
        assert all(r.review_games is None for r in best)
        for r in worst:
            games = sorted(groups[player, r.opening], key=lambda x: (not x[3], x[4] if x[4] is not None else 999, x[0]))
            assert r.review_games == ",".join(str(g[0]) for g in games[:2])
    one = ps.opening_repertoire(sides, "ANN", min_games=2, k=2, review=2).collect()
    assert {tuple(r) for r in one} == {tuple(r) for r in got if r.player == "ann"}


@pytest.mark.parametrize("limit", [0, 1000])
def test_name_openings_with_and_without_broadcast(spark, limit):
    openings = spark.createDataFrame(
        [(1, "e4 e5 Nf3"), (2, "e4 c5"), (3, "d4 d5"), (4, "e4 e5 f4"), (5, "e4")], "Game_Number long, opening string"
    )
    names = [("e4", "King's"), ("e4 e5 Nf3", "Open"), ("e4 e5", "Twin"), ("e4 e5", "Double"), ("e4 c5", None), (None, "x")]
    names = spark.createDataFrame(names, "moves string, name string")
    found = ps.name_openings(openings, names, broadcast_rows=limit).collect()
    got = {r.Game_Number: (r.opening_name, r.named_plies) for r in found}
    assert len(found) == 5
    assert got == {1: ("Open", 3), 2: ("King's", 1), 3: (None, None), 4: ("Double", 2), 5: ("King's", 1)}


def test_bounded_broadcast_checks_the_size(spark):
    df = spark.range(50)
    assert rp.bounded_broadcast(df, 50)[1] and not rp.bounded_broadcast(df, 49)[1]
    texts = df.selectExpr("repeat('x', 100) AS t")
    assert rp.bounded_broadcast(texts, 50, 5000)[1] and not rp.bounded_broadcast(texts, 50, 4999)[1]


def test_blunder_triggers(played):
    _, scored, rows = played
    by_ply = {(r.Game_Number, r.Move_Number): r for r in rows}
    kinds = {}
    for r in rows:
        if r.delta is None or round(r.delta, 6) < 0.1:
            continue
        kind = "blunder" if round(r.delta, 6) >= 0.3 else "mistake" if round(r.delta, 6) >= 0.2 else "inaccuracy"
        before = by_ply.get((r.Game_Number, r.Move_Number - 1))
        move = before.Move if before else None
        after = "none" if move is None else "castling" if move.startswith("O-O") else "promotion" if "=" in move else \
            "capture" if "x" in move else "check" if "+" in move or "#" in move else "quiet"
        state = "losing" if r.wp_before < 0.35 else "winning" if r.wp_before > 0.65 else "even"
        key = (r.Player_To_Move.lower(), kind, after, state, r.game_phase)
        kinds[key] = kinds.get(key, 0) + 1
    got = ps.blunder_triggers(scored).collect()
    assert {(r.player, r.kind, r.after_move, r.state, r.game_phase): r.n for r in got} == kinds
    one = ps.blunder_triggers(scored, "ann").collect()
    assert {tuple(r) for r in one} == {tuple(r) for r in got if r.player == "ann"}


def test_triggers_of_a_null_game_and_of_repeated_plies(spark):
    plies = [(g, n, "Ann", m, 0.4, 0.5, "opening") for g in (1, None) for n, m in enumerate(("Bxc6", "Nxd4", "Rxe5", "Qxf6"), 1)]
    columns = "Game_Number long, Move_Number int, Player_To_Move string, Move string, delta double, wp_before double, game_phase string"
    got = {r.after_move: r.n for r in ps.blunder_triggers(spark.createDataFrame(plies, columns)).collect()}
    assert got == {"capture": 6, "none": 2}  # the NULL game is a game like any other
    twice = spark.createDataFrame([*plies[:4], (1, 1, "Bob", "O-O", 0.0, 0.5, "opening")], columns)
    assert {r.after_move: r.n for r in ps.blunder_triggers(twice).collect()} == {"capture": 3, "none": 1}


def test_games_to_review(played):
    _, scored, rows = played
    worst = {}
    for r in rows:
        if r.delta is not None and r.delta > 0:
            key = (r.Player_To_Move.lower(), r.Game_Number)
            mine = (round(r.delta * 2000), -r.Move_Number)
            if key not in worst or mine > worst[key][0]:
                worst[key] = (mine, r)
    got = ps.games_to_review(scored, k=3).collect()
    for player in {p for p, _ in worst}:
        want = sorted(((-w[0][0], g) for (p, g), w in worst.items() if p == player))[:3]
        assert {r.Game_Number for r in got if r.player == player} == {g for _, g in want}
    for r in got:
        mine, row = worst[r.player, r.Game_Number]
        assert (r.ply, r.move, r.link) == (row.Move_Number, row.Move, row.Game_Link)
        assert r.loss == mine[0] / 2000
    one = ps.games_to_review(scored, "ann", k=3, link_prefix="x/").collect()
    assert [r.loss for r in one] == sorted((r.loss for r in one), reverse=True)
    assert {r.Game_Number for r in one} == {r.Game_Number for r in got if r.player == "ann"}
    assert one[0].link.startswith("x/g/")


def test_context_comes_back(played):
    moves, _, rows = played
    bare = ps.move_analysis(moves, ordered=False)
    back = ps.with_game_context(bare, moves).collect()
    assert len(back) == len(rows)
    want = {(r.Game_Number, r.Move_Number): (r.Game_Link, r.White, r.End_Date) for r in rows}
    assert all(want[r.Game_Number, r.Move_Number] == (r.Game_Link, r.White, r.End_Date) for r in back)
