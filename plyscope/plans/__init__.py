from .analysis import move_analysis  # noqa: F401
from .refresh import Refreshed, refresh, report_tables  # noqa: F401
