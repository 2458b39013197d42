from churnkit.streaming.scoring import score_stream  # noqa: F401
