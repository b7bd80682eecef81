"""The live path as Structured Streaming: the same bodies as in batch."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from roadloom.functions.graphid import pseudo_edge
from roadloom.functions.timeslot import micros
from roadloom.operators.clean import valid_live
from roadloom.operators.live import decayed_mean, plausible
from roadloom.params import Params


def windowed_speeds(samples: DataFrame, p: Params, slide_s: int | None = None, late: str = "1 minute") -> DataFrame:
    """(edge, window_end, speed_kph, samples): time-decayed means over sliding event-time windows, for batch and stream alike.

    Event time stands for the arrival time of the live daemon: a window's end
    is its "now". The watermark bounds the state in a stream and does nothing
    in batch. ``samples`` has (edge, speed, ts timestamp).
    """
    slide = slide_s or p.interval_s
    marked = samples.withWatermark("ts", late)
    w = marked.withColumn("w", F.window("ts", f"{p.window_s} seconds", f"{slide} seconds"))
    age = (F.unix_micros(F.col("w.end")) - F.unix_micros(F.col("ts"))) / 1e6
    means = decayed_mean(w, ["edge", "w"], "speed", age, p.window_s, p.weight_floor)
    return plausible(means, p).select("edge", F.unix_seconds(F.col("w.end")).alias("window_end"), "speed_kph", "samples")


def samples_of(hb: DataFrame, p: Params) -> DataFrame:
    """(edge, speed, ts) of parsed heartbeats (lat, lon, speed, t seconds)."""
    good = hb.filter(valid_live(F.col("lat"), F.col("lon"), F.col("speed"), p))
    return good.select(pseudo_edge(F.col("lat"), F.col("lon")).alias("edge"), "speed", F.timestamp_seconds("t").alias("ts"))


# A stream's watermark begins at the epoch, where samples would count as late; event time is moved on by a day.
SHIFT_S = 86_400


def _latest(p: Params):
    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        times, speeds = (list(x) for x in state.get) if state.exists else ([], [])
        for batch in batches:
            times += batch["t"].tolist()
            speeds += batch["speed"].tolist()
        now = max(times)
        kept = [(t, s) for t, s in zip(times, speeds, strict=True) if t > now - p.window_s]
        state.update(([t for t, _ in kept], [s for _, s in kept]))
        # When event time has passed the window behind the last sample, none is left.
        state.setTimeoutTimestamp(max(int((now + SHIFT_S + p.window_s) * 1000), state.getCurrentWatermarkMs() + 1))
        weights = [max(p.weight_floor, 1 - (now - t) / p.window_s) for t, _ in kept]
        mean = sum(w * s for w, (_, s) in zip(weights, kept, strict=True)) / sum(weights)
        yield pd.DataFrame({"edge": [key[0]], "now": [now], "speed_kph": [mean], "samples": [len(kept)]})

    return update


def exact_state(samples: DataFrame, p: Params, late: str = "1 minute") -> DataFrame:
    """(edge, now, speed_kph, samples) after each batch: the kept samples of an edge as state, pruned to the window.

    ``samples`` has (edge, t double, speed). The state of an edge that falls
    silent is dropped once event time is a window past its last sample; samples
    that are ``late`` or later are left out.
    """
    timed = samples.select("edge", "t", "speed", F.timestamp_seconds(F.col("t") + SHIFT_S).alias("ts")).withWatermark("ts", late)
    return timed.groupBy("edge").applyInPandasWithState(
        _latest(p), "edge int, now double, speed_kph double, samples long", "times array<double>, speeds array<double>", "update", GroupStateTimeout.EventTimeTimeout
    )


def run_once(stream: DataFrame, checkpoint: str, out: str, mode: str = "append") -> None:
    """Drains what is there into Parquet; one query a checkpoint, exactly once."""
    q = stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint).option("path", out).trigger(availableNow=True).start()
    q.awaitTermination()


def publish_each(stream: DataFrame, checkpoint: str, publish, mode: str = "update"):
    """Calls ``publish(batch, batch_id)`` for each micro-batch; a batch id that comes again replaces its own output."""
    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(publish)


def event_seconds(ts):
    return F.floor(micros(ts) / 1_000_000)
