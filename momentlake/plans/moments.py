"""From raw chat and transcript to ranked moments."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import chat, fusion


def ranked_moments(
    messages: DataFrame, segments: DataFrame, *, bin_seconds: int = 10, gap_seconds: int = 5
) -> DataFrame:
    """Chat spikes and excited lines of each video, merged and ranked by score."""
    spikes = chat.spikes(messages, bin_seconds)
    signals = fusion.moment_signals(spikes, segments)
    return fusion.rank_moments(fusion.merge_moments(signals, gap_seconds))
