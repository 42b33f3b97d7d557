"""Streaming edge of the engine.

The surveyed jobs are batch only (no watermarks, state or late data), so no
streaming operator exists here.  What is offered is the A1 scan in streaming
form: raw text feeds that keep arriving as files are landed incrementally into
Parquet with the same width guard, ready for the batch plans.
"""

from .landing import land_feed

__all__ = ["land_feed"]
