from .archive import (  # noqa: F401
    archive_gaps,
    clean_games,
    corrupt_documents,
    flatten_archive,
    month_keys,
    read_archive,
)
from .audit import audit_table, audited, stream_audit  # noqa: F401
from .months import month_outcomes, read_months, stream_months  # noqa: F401
from .players import by_player, read_player, write_by_player  # noqa: F401
from .tables import (  # noqa: F401
    drop_staging,
    latest_snapshot,
    read_moves,
    read_ndjson,
    read_snapshot,
    snapshot_dates,
    write_bucketed,
    write_ndjson,
    write_snapshot,
)
