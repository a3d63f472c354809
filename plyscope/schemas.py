"""Declared schemas: every reader in the package uses one of these, none infers."""

from pyspark.sql import types as T

EVALUATION = T.StructType(
    [T.StructField("type", T.StringType()), T.StructField("value", T.LongType())]
)

PLAYER = T.StructType(
    [
        T.StructField("username", T.StringType()),
        T.StructField("rating", T.LongType()),
        T.StructField("result", T.StringType()),
    ]
)

GAME = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("pgn", T.StringType()),
        T.StructField("end_time", T.LongType()),
        T.StructField("time_class", T.StringType()),
        T.StructField("white", PLAYER),
        T.StructField("black", PLAYER),
    ]
)

# One monthly document. `player` and `month` come from the landing path.
ARCHIVE = T.StructType(
    [
        T.StructField("games", T.ArrayType(GAME)),
        T.StructField("_corrupt_record", T.StringType()),
        T.StructField("player", T.StringType()),
        T.StructField("month", T.StringType()),
    ]
)

MOVES = T.StructType(
    [
        T.StructField("Game_Number", T.LongType()),
        T.StructField("Game_Link", T.StringType()),
        T.StructField("Move_Number", T.IntegerType()),
        T.StructField("Move", T.StringType()),
        T.StructField("Evaluation", EVALUATION),
        T.StructField("WDL Stats", T.ArrayType(T.LongType())),
        T.StructField("White", T.StringType()),
        T.StructField("Black", T.StringType()),
        T.StructField("Start_Date", T.StringType()),
        T.StructField("Start_Time", T.StringType()),
        T.StructField("End_Date", T.StringType()),
        T.StructField("End_Time", T.StringType()),
    ]
)

ANALYSIS = T.StructType(
    [
        T.StructField("Game_Number", T.LongType()),
        T.StructField("Move_Number", T.IntegerType()),
        T.StructField("Move", T.StringType()),
        T.StructField("CentiPawnLoss", T.LongType()),
        T.StructField("Player_To_Move", T.StringType()),
        T.StructField("move_accuracy", T.DoubleType()),
        T.StructField("ACPL_White", T.DoubleType()),
        T.StructField("ACPL_Black", T.DoubleType()),
        T.StructField("Game_Accuracy_White", T.DoubleType()),
        T.StructField("Game_Accuracy_Black", T.DoubleType()),
        T.StructField("game_phase", T.StringType()),
    ]
)

ANALYSIS_COLUMNS = ANALYSIS.fieldNames()
