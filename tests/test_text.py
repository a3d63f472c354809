import pytest

import plyscope as ps


def tokens(spark, pgn):
    df = spark.createDataFrame([(pgn,)], "pgn string")
    return ps.parse_games(df).first().tokens


TAGS = '[White "a"]\n[Black "b"]\n\n'


@pytest.mark.parametrize(
    "movetext, want",
    [
        ("1. e4 e5 2. Nf3 Nc6 1-0", ["e4", "e5", "Nf3", "Nc6"]),
        ("1.e4 e5 2.Nf3 *", ["e4", "e5", "Nf3"]),
        ("1. e4 {[%clk 0:10:00]} 1... e5 {(a) 2. h4} 2. O-O O-O-O", ["e4", "e5", "O-O", "O-O-O"]),
        ("1. e4 (1. d4 d5 (1... Nf6 (1... g6 (1... f5))) 2. c4) e5 0-1", ["e4", "e5"]),
        ("1. e4 (1. d4 {:-)} d5) 1... c5 1/2-1/2", ["e4", "c5"]),
        ("1. e4 $1 e5! 2. exd5?? Qxd5+ 3. e8=Q# Nbd7 4. R1e2 a8=N", ["e4", "e5", "exd5", "Qxd5+", "e8=Q#", "Nbd7", "R1e2", "a8=N"]),
        ("1. e4 ; a rest-of-line {comment\n e5 {a ; in braces} 2. d4", ["e4", "e5", "d4"]),
        ("1. e4\n% 1. d4 escaped line\ne5", ["e4", "e5"]),
        ("1. e4 e5 {never closed 2. d4", ["e4", "e5"]),
        ("1. e2e4 e7e5 2. -- Z0 3. N@f3", ["e2e4", "e7e5", "--", "Z0", "N@f3"]),
        ("1. 0-0 0-0-0 2. e4) d5", ["0-0", "0-0-0", "e4", "d5"]),
        ("1. e4 e5\n2. d4\n\n3. c4 after the end", ["e4", "e5", "d4"]),
        ("1. e4 {a comment\n\nover a blank line} e5", ["e4", "e5"]),
        ("1-0", []),
        ("", []),
    ],
)
def test_movetext(spark, movetext, want):
    assert tokens(spark, TAGS + movetext) == want
    assert tokens(spark, movetext) == want
    assert tokens(spark, (TAGS + movetext).replace("\n", "\r\n")) == want


def test_only_the_first_game_counts(spark):
    assert tokens(spark, TAGS + "1. e4 1-0\n\n" + TAGS + "1. d4 0-1") == ["e4"]


def test_text_without_a_game(spark):
    assert tokens(spark, "not a game record") == []
    assert tokens(spark, TAGS) == []
    assert tokens(spark, None) is None


def test_deep_nesting_and_long_text(spark):
    deep = "1. e4 " + "(1. d4 " * 300 + ")" * 300 + " e5"
    assert tokens(spark, deep) == ["e4", "e5"]
    long = " ".join(f"{i}. Nf3 {{c}} Ng1" for i in range(1, 3001))
    assert len(tokens(spark, TAGS + long)) == 6000
    lines = "\n".join(f"{i}. Nf3 Ng1" for i in range(1, 5001))
    assert len(tokens(spark, TAGS + lines)) == 10000


def headers(spark, pgn):
    return ps.parse_games(spark.createDataFrame([(pgn,)], "pgn string")).first().headers


def test_headers(spark):
    pgn = (
        '\n[Event "Say \\"hi\\" [x]"]\n[White "one"]\n[White "two"]\n  [Black "b\\\\c"]\n[Empty ""]\n\n'
        '1. e4 {\n[Link "in a comment"]\n} e5'
    )
    assert headers(spark, pgn) == {"Event": 'Say "hi" [x]', "White": "two", "Black": "b\\c", "Empty": ""}
    assert headers(spark, "no tags") == {}
    assert headers(spark, None) is None


def test_missing_headers_keep_the_game(spark):
    df = spark.createDataFrame([(1, "1. e4 e5"), (2, None), (3, TAGS + "*")], "n int, pgn string")
    good, aside = ps.split_quarantine(ps.parse_games(df))
    assert [r.n for r in good.collect()] == [1]
    assert {r.n: r.reason for r in aside.collect()} == {2: "no_text", 3: "no_moves"}
    assert good.first().missing_headers == "White,Black,Date,StartTime,EndDate,EndTime,Link"
    rows = ps.build_moves(good).collect()
    assert [(r.Move_Number, r.Move, r.White) for r in rows] == [(1, "e4", None), (2, "e5", None)]
    assert rows[0].game_key.startswith("md5:")


def test_positions_name_prefixes(spark):
    df = spark.createDataFrame([("1. e4 e5 2. d4",), ("1. e4 e5 2. c4",), ("1. d4 e5 2. e4",)], "pgn string")
    rows = ps.build_moves(ps.parse_games(df)).collect()
    by = {}
    for r in rows:
        by.setdefault(r.game_key, []).append(r)
    keys = [[r.position for r in sorted(g, key=lambda r: r.Move_Number)] for g in by.values()]
    assert len({k[0] for k in keys}) == 2 and len({k[1] for k in keys}) == 2 and len({k[2] for k in keys}) == 3


def test_position_keys_of_long_games(spark):
    """A key stands for all moves before it, whichever block they are in."""
    base = ["e4", "Nf3", "O-O", "a3"] * 30
    games = [base, base[:100], base[:40] + ["h4"] + base[41:], base + ["h4"]]
    df = spark.createDataFrame([(i, " ".join(g)) for i, g in enumerate(games)], "n int, pgn string")
    rows = sorted(ps.build_moves(ps.parse_games(df), ("n",)).collect(), key=lambda r: (r.n, r.Move_Number))
    assert [[r.Move for r in rows if r.n == i] for i in range(4)] == games
    assert [r.Move_Number for r in rows if r.n == 0] == list(range(1, 121))
    prefix = {}
    for r in rows:
        prefix.setdefault(r.position, set()).add(tuple(games[r.n][: r.Move_Number]))
    assert all(len(p) == 1 for p in prefix.values())
    assert len(prefix) == len({p for ps_ in prefix.values() for p in ps_}) == 120 + 80 + 1


def test_distinct_games_keeps_the_latest_copy(spark):
    link = '[Link "g/1"]\n\n1. e4'
    df = spark.createDataFrame([(1, link), (5, link + " e5"), (3, link), (2, "1. d4"), (2, "1. d4")], "end_time long, pgn string")
    got = {r.game_key[:4]: (r.end_time, r.pgn) for r in ps.distinct_games(df).collect()}
    assert got == {"g/1": (5, link + " e5"), "md5:": (2, "1. d4")}
