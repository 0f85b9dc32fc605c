"""Column-level helpers (built-in expressions only; no Python UDFs)."""
from eventide.functions.columns import *  # noqa: F401,F403
