"""Newest recommendations held in keyed streaming state: restart, late batches, odd rows."""

from __future__ import annotations

from reelstats.operators import serving
from reelstats.session import scratch_path
from reelstats.streaming import latest, runner
from tests.conftest import rows

SCHEMA = "userId int, movieId int, rating float, batch_id long"


def test_state_equals_serving_over_all_batches(spark):
    out = scratch_path(spark, "newest-test")
    arrivals = [
        [(u, u * 10 + j, 0.5 * j, 3) for u in range(4) for j in range(7)] + [(9, 1, 5.0, 0), (9, 2, None, 0), (9, 2, 1.0, 0), (None, 1, 1.0, 9), (8, None, 1.0, 9)],
        [(u, 500 + j, 1.0, 2) for u in range(2, 6) for j in range(3)] + [(0, 7, 4.0, 4)],  # late for 2 and 3, newer for 0
        [(1, 99, 9.0, 3), (5, 1, 2.0, 10)] + [(7, m, 1.0, 11) for m in range(300)],  # more of user 1's newest batch; many rows of one user
    ]
    for i, part in enumerate(arrivals):
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(f"{out}/recs")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{out}/recs")
        runner.drain(latest.start_newest(stream, f"{out}/_ckpt", 5, trigger={"availableNow": True}))
        all_rows = [r for p in arrivals[: i + 1] for r in p if None not in (r[0], r[1], r[3])]
        movies = spark.createDataFrame([(7, "seven", "A|B"), (99, "ninety-nine", None)], "movieId int, title string, genres string")
        want = serving.user_top_recommendations(spark.createDataFrame(all_rows, SCHEMA), movies, 5)
        assert rows(latest.serve_newest(spark, f"{out}/_ckpt", movies)) == rows(want)
    state = spark.read.format("statestore").option("stateVarName", latest.STATE).load(f"{out}/_ckpt")
    assert state.count() == 8  # one row a user, whatever the number of batches
    assert spark.conf.get(latest._PROVIDER, "") != latest._ROCKS
