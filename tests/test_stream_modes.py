"""The legality table of output modes, each cell against Spark's own verdict at ``start()``."""

import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from corvid.session import scratch_path
from corvid.streaming import modes, run, spans
from corvid.streaming.sessions import stream_session


@pytest.fixture(scope="module")
def own(spark):
    return stream_session(spark, state_partitions=1)


def _counted(keys, batches, state):
    yield pd.DataFrame({"value": [keys[0]]})


def _state(mode):
    return lambda r: r.groupBy("value").applyInPandasWithState(_counted, "value long", "n long", mode,
                                                               GroupStateTimeout.NoTimeout)


def _windowed(r):
    return r.withWatermark("timestamp", "1 hour").groupBy(F.window("timestamp", "1 hour").alias("w")).count()


PLANS = {
    "stateless": [lambda r: r.where("value > 1").select("value"), lambda r: r.withWatermark("timestamp", "1 hour")],
    "deduplicate": [lambda r: r.dropDuplicates(["value"]),
                    lambda r: r.withWatermark("timestamp", "1 hour").dropDuplicatesWithinWatermark(["value"])],
    "aggregate": [lambda r: r.groupBy("value").count(), lambda r: r.groupBy(F.window("timestamp", "1 hour")).count(),
                  lambda r: r.withWatermark("timestamp", "1 hour").groupBy("value").count()],
    "windowed_watermark": [_windowed,
                           lambda r: r.withWatermark("timestamp", "1 hour").groupBy("timestamp", "value").count()],
    "sorted_aggregate": [lambda r: r.groupBy("value").count().orderBy("value"), lambda r: _windowed(r).orderBy("w")],
    "sorted": [lambda r: r.orderBy("value")],
    "limit": [lambda r: r.limit(5)],
    "limited_aggregate": [lambda r: r.groupBy("value").count().orderBy("value").limit(3)],
    "stream_join": [lambda r: r.join(r.withColumnRenamed("timestamp", "t"), "value")],
    "chained": [lambda r: _windowed(r).groupBy(F.window("w", "2 hours")).count(),
                lambda r: _windowed(r).join(_windowed(r).withColumnRenamed("count", "other"), "w")],
    "state_append": [_state("append"), lambda r: spans.activity_spans(r, "value", "timestamp", "1 hour", "1 hour", "append")],
    "state_update": [_state("update"), lambda r: spans.activity_spans(r, "value", "timestamp", "1 hour", "1 hour", "update")],
}


def test_every_kind_is_tried():
    assert set(PLANS) == set(modes.OUTPUT_MODES)


@pytest.mark.parametrize("kind,i", [(k, i) for k, plans in PLANS.items() for i in range(len(plans))])
def test_kind_and_legality(spark, own, kind, i):
    df = PLANS[kind][i](own.readStream.format("rate").load())
    assert modes.plan_kind(df) == kind
    stricter = kind.startswith("state") and i == 1  # transformWithState, see modes.OUTPUT_MODES
    for mode in ("append", "update", "complete"):
        try:
            q = df.writeStream.format("noop").outputMode(mode).option("checkpointLocation", scratch_path(spark, "mode")).start()
            q.stop()
            allowed = True
        except AnalysisException:
            allowed = False
        ours = mode in modes.OUTPUT_MODES[kind]
        assert allowed == ours or (stricter and allowed and not ours), (kind, mode)


def test_batch_frames_have_no_kind(spark):
    with pytest.raises(ValueError, match="not a streaming plan"):
        modes.plan_kind(spark.range(3))
    with pytest.raises(ValueError, match="unknown plan kind"):
        modes.check_output_mode("other", "append")


def test_sessions_are_apart(spark):
    before = {k: v for k, v in spark.conf.getAll.items()}
    own = stream_session(spark, state_partitions=3, **{"spark.sql.streaming.noDataMicroBatches.enabled": "false"})
    s = own.readStream.format("rate").load().groupBy("value").count()
    run.start(s, "update", scratch_path(spark, "apart"), fmt="noop").stop()
    assert own.conf.get("spark.sql.shuffle.partitions") == "3"
    assert {k: v for k, v in spark.conf.getAll.items()} == before
    assert own.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
