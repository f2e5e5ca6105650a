"""Alert rules with a hold time, on a stream: since when a condition is true is state, with timers on event time.

A rule is evaluated on a grid of instants. Evaluations arrive as rows (rule, group, at, met), at most one for an instant of the
grid; what an instant without a row means is said by the rule: not met, met (silence, stalled growth), or as before (a gauge keeps
its value). An alert fires at the first evaluation at which the condition has been true for ``hold``, and is resolved at the first
one at which it is not. Groups whose rule is not met hold no state, unless silence itself meets it.

Evaluations come from closed windows, so the result does not depend on how rows are dealt to batches, nor on restarts.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from opinara.session import SETTINGS

# The processor travels to the workers by value, whether or not the package is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# State with timers needs this store; a session that was built elsewhere has Spark's default one.
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
STORE = {PROVIDER: SETTINGS[PROVIDER]}
MINUTE = 60_000
NOT_MET, MET, AS_BEFORE = "not met", "met", "as before"


@dataclass(frozen=True)
class Hold:
    """Minutes between evaluations, minutes a condition must hold, and what an instant without a row means."""

    hold: int
    step: int = 1
    silent: str = NOT_MET


# The hold times of the rules, in minutes.
HOLDS = {
    "error_rate": Hold(5),
    "source_error_rate": Hold(5),
    "error_ratio": Hold(5),
    "latency_p95": Hold(5),
    "login_failures": Hold(5),
    "nothing_collected": Hold(60, 5, MET),
    "growth_stalled": Hold(120, 5, MET),
    "low_enrichment": Hold(10, 1, AS_BEFORE),
    "high_drift": Hold(15, 1, AS_BEFORE),
}


@dataclass
class Episode:
    """What is known of one rule and group after the instant ``clock`` (milliseconds, as all instants here)."""

    clock: int | None = None
    since: int | None = None
    fired: bool = False

    def see(self, rule: Hold, first: int, last: int, met: bool) -> Iterator[tuple[str, int, int]]:
        """All instants from ``first`` to ``last`` give the same answer; yields (state, since, at)."""
        self.clock = last
        if met:
            self.since = first if self.since is None else self.since
            due = self.since + rule.hold * MINUTE
            if not self.fired and last >= due:
                self.fired = True
                yield "firing", self.since, due
            return
        if self.fired:
            yield "resolved", self.since, first
        self.since, self.fired = None, False

    def idle(self, rule: Hold) -> bool:
        """What an instant without a row would answer."""
        return rule.silent == MET or (rule.silent == AS_BEFORE and self.since is not None)

    def until(self, rule: Hold, last: int) -> Iterator[tuple[str, int, int]]:
        """Instants without rows, after the clock and up to ``last``."""
        if self.clock is not None and last > self.clock:
            yield from self.see(rule, self.clock + rule.step * MINUTE, last, self.idle(rule))

    def next_change(self, rule: Hold) -> int | None:
        """Instant at which silence alone would fire or resolve the alert."""
        if self.idle(rule):
            since = self.clock + rule.step * MINUTE if self.since is None else self.since
            return None if self.fired else since + rule.hold * MINUTE
        return self.clock + rule.step * MINUTE if self.since is not None else None

    def take(self, rule: Hold, rows: Iterable[tuple[int, bool]]) -> list[tuple[str, int, int]]:
        """Evaluations of closed windows, in any order."""
        events = []
        for at, met in sorted(rows):
            events += [*self.until(rule, at - rule.step * MINUTE), *self.see(rule, at, at, met)]
        return events


_EVENTS = "rule string, group string, state string, since timestamp, at timestamp"


class HoldProcessor(StatefulProcessor):
    """Keeps an episode per rule and group."""

    def __init__(self, holds: dict[str, Hold]) -> None:
        self.holds = holds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("episode", "clock bigint, since bigint, fired boolean")

    def _load(self) -> Episode:
        return Episode(*self.state.get()) if self.state.exists() else Episode()

    def _store(self, key: tuple[str, str], episode: Episode, events: list[tuple[str, int, int]]) -> Iterator[pd.DataFrame]:
        rule = self.holds[key[0]]
        for due in list(self.handle.listTimers()):
            self.handle.deleteTimer(due)
        due = episode.next_change(rule)
        if due is not None:
            self.handle.registerTimer(due)
        if episode.since is None and not episode.idle(rule):
            self.state.clear()  # nothing but the clock, which only silence would need
        else:
            self.state.update((episode.clock, episode.since, episode.fired))
        if events:
            instant = lambda i: pd.to_datetime([e[i] for e in events], unit="ms", utc=True).tz_convert(None)
            yield pd.DataFrame({"rule": key[0], "group": key[1], "state": [e[0] for e in events], "since": instant(1), "at": instant(2)})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = [pair for frame in rows for pair in zip(frame["millis"].tolist(), frame["met"].tolist())]
        episode = self._load()
        yield from self._store(key, episode, episode.take(self.holds[key[0]], found))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        episode, due = self._load(), expiredTimerInfo.getExpiryTimeInMs()
        events = list(episode.until(self.holds[key[0]], due))
        yield from self._store(key, episode, events)

    def close(self) -> None:
        pass


def alerts(evaluations: DataFrame, holds: dict[str, Hold] | None = None) -> DataFrame:
    """rule, group, state (``firing`` or ``resolved``), since and at. ``evaluations`` is a stream with rule, group, at and met,
    behind a watermark. It has to run under the settings ``STORE``."""
    keyed = evaluations.select("rule", "group", F.unix_millis("at").alias("millis"), "met")
    return keyed.groupBy("rule", "group").transformWithStateInPandas(HoldProcessor(holds or HOLDS), _EVENTS, "Append", "EventTime")


def evaluations(windows: DataFrame, conditions: dict[str, Column], group: Column) -> DataFrame:
    """One row per window and rule whose condition is not null; a null condition means that the rule does not ask this group."""
    asked = F.filter(
        F.array(*[F.struct(F.lit(rule).alias("rule"), met.alias("met")) for rule, met in conditions.items()]), lambda c: c.met.isNotNull()
    )
    rows = windows.select(F.col("window.end").alias("at"), group.alias("group"), F.explode(asked).alias("c"))
    return rows.select("c.rule", "group", "at", "c.met")
