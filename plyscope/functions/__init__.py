from .scoring import *  # noqa: F401,F403
