"""momentlake: livestream-moment analytics as Spark DataFrame jobs.

Every operator is a function ``(DataFrame..., parameters) -> DataFrame``.  All
tables are keyed by ``vod_id``; ``pos`` is the source ordinal and the last sort
key wherever order matters.  Media time is seconds from the start of the video
(``t``, ``start_s``, ``end_s``).
"""
