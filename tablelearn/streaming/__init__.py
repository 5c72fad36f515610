"""Scoring streams with fitted models.

The textbook code has no streaming operators, and none are added here.  What
carries over is that every ``*_predict`` is a pure column expression with the
model as literals (no join, no state), so the same function scores a
Structured Streaming DataFrame micro-batch by micro-batch.
"""

from .scoring import score_stream, start_scoring

__all__ = ["score_stream", "start_scoring"]
