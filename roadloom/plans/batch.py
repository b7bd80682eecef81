"""The batch path as stages over an immutable state of named DataFrames.

A stage says what it needs and adds what it makes; nothing runs before a
result is asked for, so Catalyst sees the whole path as one plan. ``toggles``
leave stages out; a later stage whose input is then missing fails when the
plan is put together.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from roadloom.operators import clean, profiles, speeds, trips
from roadloom.params import Params
from roadloom.sources.matcher import Matcher

Frames = Mapping[str, DataFrame]


@dataclass(frozen=True)
class State:
    """Frames by name, and an observation (row count) for each stage's main result."""

    frames: Frames
    observed: Mapping[str, Observation] = field(default_factory=dict)

    def with_frames(self, stage: str, made: dict[str, DataFrame]) -> State:
        seen = Observation(stage)
        first = next(iter(made))
        counted = made | {first: made[first].observe(seen, F.count(F.lit(1)).alias("rows"))}
        return State(MappingProxyType({**self.frames, **counted}), MappingProxyType({**self.observed, stage: seen}))


@dataclass(frozen=True)
class Stage:
    name: str
    needs: tuple[str, ...]
    make: Callable[[Frames, Params], dict[str, DataFrame]]

    def run(self, state: State, p: Params) -> State:
        missing = [n for n in self.needs if n not in state.frames]
        if missing:
            raise ValueError(f"stage {self.name} needs {', '.join(missing)}")
        return state.with_frames(self.name, self.make(state.frames, p))


def _clean(f: Frames, p: Params) -> dict[str, DataFrame]:
    """heartbeats (vehicle, t, lat, lon, event_id) and trips (vehicle, trip_id, start_s, end_s) -> points of trips."""
    once = clean.dedup_first(f["heartbeats"], ["vehicle", "t"], ["event_id"])
    points = trips.in_interval(once, f["trips"].select("vehicle", "trip_id", "start_s", "end_s"), "vehicle", "t", "start_s", "end_s")
    rounded = points.withColumns({"lat": F.bround("lat", p.coordinate_digits), "lon": F.bround("lon", p.coordinate_digits)})
    return {"points": trips.long_enough(rounded.select("trip_id", "t", "lat", "lon", "event_id"), "trip_id", p.min_points)}


def match_stage(matcher: Callable[[DataFrame], Matcher] | Matcher) -> Stage:
    def make(f: Frames, p: Params) -> dict[str, DataFrame]:
        traces = trips.traces(f["points"], "trip_id", "t", "event_id", "lat", "lon")
        m = matcher if isinstance(matcher, Matcher) else matcher(traces)
        return {"matched": m.match(traces)}

    return Stage("match", ("points",), make)


def _speeds(f: Frames, p: Params) -> dict[str, DataFrame]:
    points = f["points"] if p.sampling_rate >= 1 else trips.sample_trips(f["points"], "trip_id", p.sampling_rate)
    return {"edge_speeds": speeds.on_edges(speeds.trace_speeds(points, "trip_id", p, ["event_id"]), f["matched"], "trip_id", p)}


def _fill(f: Frames, p: Params) -> dict[str, DataFrame]:
    return {"filled": profiles.fill_temporal(f["edge_speeds"], "edge_id", "slot", "speed_kph", p.neighbor_size)}


def _profiles(f: Frames, p: Params) -> dict[str, DataFrame]:
    """Profiles of filled speeds; a default for slots that stay empty."""
    filled = f["filled"]
    if p.exclude_tunnels and "tunnel_edges" in f:
        filled = profiles.without_edges(filled, f["tunnel_edges"], "edge_id")
    means = profiles.trimmed_means(filled, "edge_id", "slot", "speed_kph", p.iqr_factor)
    return {"profiles": profiles.smooth_profiles(means, p.freeflow_kph * p.default_speed_factor, "edge_id", p)}


def stages(matcher: Callable[[DataFrame], Matcher] | Matcher) -> list[Stage]:
    return [
        Stage("clean", ("heartbeats", "trips"), _clean),
        match_stage(matcher),
        Stage("speeds", ("points", "matched"), _speeds),
        Stage("fill", ("edge_speeds",), _fill),
        Stage("profiles", ("filled",), _profiles),
    ]


def run(frames: dict[str, DataFrame], matcher: Callable[[DataFrame], Matcher] | Matcher, p: Params, toggles: Mapping[str, bool] | None = None) -> State:
    """Puts the enabled stages together in order."""
    state = State(MappingProxyType(dict(frames)))
    for stage in stages(matcher):
        if (toggles or {}).get(stage.name, True):
            state = stage.run(state, p)
    return state
