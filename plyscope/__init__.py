"""Scoring and reporting over ordered, two-sided turn sequences, on Spark."""

from .operators import *  # noqa: F401,F403
from .plans import Refreshed, move_analysis, refresh, report_tables  # noqa: F401
from .session import clear_landed  # noqa: F401
from .sources import *  # noqa: F401,F403
from .streaming import (  # noqa: F401
    Incremental,
    add_games,
    current_tables,
    game_numbers,
    kept_reports,
    refresh_incremental,
    score_from_book,
    stream_games,
    update_numbers,
    update_reports,
    weekly_run,
)
