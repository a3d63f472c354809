"""Small builders and a brute-force model of the scoring chain."""

import math

from plyscope.schemas import MOVES

SCHEMA = "Game_Number long, Move_Number long, Move string, Evaluation struct<type:string,value:long>, " \
    "`WDL Stats` array<long>, White string, Black string"


def moves(spark, rows):
    """rows: (game, ply, evaluation, wdl)"""
    data = [
        (g, n, f"m{n}", None if ev is None else ("cp", ev), wdl, f"White{g}", f"Black{g}")
        for g, n, ev, wdl in rows
    ]
    return spark.createDataFrame(data, SCHEMA)


def full_moves(spark, rows):
    return spark.createDataFrame(rows, MOVES)


def parity(n):
    return None if n is None else int(math.fmod(n, 2))


def brute_force(rows, skip_first=False):
    """{(game, ply): (loss, delta, accuracy, means)}, row by row in plain Python."""
    games = {}
    for g, n, ev, wdl in rows:
        games.setdefault(g, []).append((n, ev, wdl))
    out = {}
    for g, plies in games.items():
        plies.sort(key=lambda x: (x[0] is None, x[0]))
        scored, last = [], (None, None, None)
        for n, ev, wdl in plies:
            w = wdl[-3] if wdl and len(wdl) >= 3 else None
            d = wdl[-2] if wdl and len(wdl) >= 2 else None
            loss = delta = None
            if last[0] is not None and ev is not None:
                loss = last[0] - ev if parity(n) == 1 else ev - last[0]
            if None not in (last[1], last[2], w, d):
                delta = (last[1] + 0.5 * last[2]) / 1000 - (1 - (w + 0.5 * d) / 1000)
            acc = 100.0
            if delta is not None:
                acc = max(0.0, min(100.0, 103.1668 * math.exp(-0.04354 * delta * 100) - 3.1669))
            scored.append((n, loss, delta, acc))
            last = (ev, w, d)

        def mean(values):
            values = list(values)
            return round(sum(values) / len(values), 2) if values else None

        kept = [s for s in scored if not (skip_first and s[2] is None)]
        means = tuple(
            mean(pick(s) for s in kept if parity(s[0]) == side)
            for pick in (lambda s: max(s[1] or 0, 0), lambda s: s[3])
            for side in (1, 0)
        )
        for n, loss, delta, acc in scored:
            out[(g, n)] = (loss, delta, acc, means)
    return out


def check_scored(df, rows, **options):
    want = brute_force(rows, **options)
    got = df.collect()
    assert len(got) == len(rows)
    for r in got:
        loss, delta, acc, means = want[(r.Game_Number, r.Move_Number)]
        at = (r.Game_Number, r.Move_Number)
        assert r.CentiPawnLoss == loss, at
        assert (r.delta is None) == (delta is None), at
        if delta is not None:
            assert abs(r.delta - delta) < 1e-12, at
        assert abs(r.move_accuracy - acc) < 1e-9, at
        found = (r.ACPL_White, r.ACPL_Black, r.Game_Accuracy_White, r.Game_Accuracy_Black)
        for f, m in zip(found, means):
            assert (f is None) == (m is None), (at, found, means)
            assert f is None or abs(f - m) <= 0.0100001, (at, found, means)
