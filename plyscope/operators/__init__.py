from .arrays import game_chunks, score_chunks  # noqa: F401
from .games import (  # noqa: F401
    build_moves,
    distinct_games,
    game_headers,
    game_plies,
    parse_games,
    ply_count,
    split_quarantine,
    tag_games,
)
from .report import (  # noqa: F401
    blunder_habits,
    blunder_plies,
    blunder_triggers,
    first_moves,
    for_player,
    game_sheet,
    games_to_review,
    name_openings,
    opening_repertoire,
    opening_results,
    performance_summary,
    phase_breakdown,
    phase_drop,
    with_game_context,
)
from .scores import normalise_scores, score_join, score_positions, score_table  # noqa: F401
from .sequence import (  # noqa: F401
    number_games,
    ordered,
    score_plies,
    side_aggregates,
)
