"""Structured Streaming: score files as they arrive with a saved model."""

from tabfit.streaming.scoring import score_files

__all__ = ["score_files"]
