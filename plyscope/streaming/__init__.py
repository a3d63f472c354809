from .intake import Incremental, add_games, current_tables, refresh_incremental, stream_games  # noqa: F401
from .numbering import game_numbers, update_numbers  # noqa: F401
from .tallies import kept_reports, update_reports, weekly_run  # noqa: F401
from .scorebook import kept_scores, score_from_book  # noqa: F401
