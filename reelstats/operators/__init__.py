from reelstats.operators import explore, prepare, profile, serving  # noqa: F401
