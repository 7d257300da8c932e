"""Keyed machines over streams: lifecycles of records and receipts of attempts.

State is kept per key by transformWithState, in the state store that the session names (RocksDB);
it holds the machine's few values and the events that still wait for their turn.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tracesieve.operators.lifecycle import CAP, LEGAL, STATES, TERMINAL

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Life(NamedTuple):
    """Where a record stands: the code of its state, and what it was asked for."""

    state: int = 0
    steps: int = 0
    attempts: int = 0
    repeated: int = 0
    illegal: int = 0
    over_cap: int = 0

    def asked(self, state: str | None) -> Life:
        t = STATES.index(state) if state in STATES else None
        if t == self.state:
            return self._replace(repeated=self.repeated + 1)
        if t is None or not LEGAL[self.state][t]:
            return self._replace(illegal=self.illegal + 1)
        if self.steps >= CAP:
            return self._replace(over_cap=self.over_cap + 1)
        return self._replace(state=t, steps=self.steps + 1, attempts=self.attempts + (t == 0))


class LifecycleProcessor(StatefulProcessor):
    """Events wait until the watermark has passed them, and are then taken in the order of their
    time; so those that come late, but within the watermark's delay, are in their place."""

    FIELDS = "record_id long, state string, terminal boolean, steps long, attempts long, repeated long, illegal long, over_cap long, folded long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.life = handle.getValueState("life", "state int, steps int, attempts int, repeated long, illegal long, over_cap long, folded long")
        self.waiting = handle.getListState("waiting", "at long, event_id long, state string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new = []
        for part in rows:
            new += [(int(a), int(e), s) for a, e, s in zip(part["at_ms"], part["event_id"], part["state"], strict=True)]
        self.waiting.appendList(new)
        timers = {t for t in self.handle.listTimers()}
        at = min(a for a, _, _ in new) + 1
        if at not in timers:
            self.handle.registerTimer(at)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        until = timerValues.getCurrentWatermarkInMs()
        waiting = sorted(tuple(x) for x in self.waiting.get())
        ready = [x for x in waiting if x[0] < until]
        later = [x for x in waiting if x[0] >= until]
        if not ready:
            return
        kept = self.life.get()
        life, folded = (Life(*kept[:6]), kept[6]) if kept else (Life(), 0)
        for _, _, state in ready:
            life = life.asked(state)
        folded += len(ready)
        self.life.update((*life, folded))
        if later:
            self.waiting.put(later)
            self.handle.registerTimer(later[0][0] + 1)
        else:
            self.waiting.clear()
        name = STATES[life.state]
        yield pd.DataFrame({"record_id": [key[0]], "state": [name], "terminal": [name in TERMINAL], **{c: [getattr(life, c)] for c in Life._fields[1:]}, "folded": [folded]})

    def close(self) -> None:
        pass


def lifecycle_stream(events: DataFrame, delay: str) -> DataFrame:
    """The lifecycles of a stream of events (record_id, at, event_id, state), updated as the watermark
    goes on; delay: how late an event may come. folded: events so far; the row with the most is a record's
    last. Rows without record_id, at or event_id are left out: they have no place in a stream."""
    rows = events.select("record_id", "at", "event_id", "state").dropna(subset=["record_id", "at", "event_id"]).withWatermark("at", delay)
    rows = rows.withColumn("at_ms", F.unix_millis("at"))
    return rows.groupBy("record_id").transformWithStateInPandas(LifecycleProcessor(), LifecycleProcessor.FIELDS, "Update", "EventTime")


COUNTERS = ("prompt_tokens", "completion_tokens", "total_tokens", "reasoning_tokens")
NAMES = ("response_id", "model", "provider")


class ReceiptProcessor(StatefulProcessor):
    """The receipt of an attempt, event by event in the order of arrival."""

    FIELDS = (
        "attempt_id long, observations long, transport string, interpretation string, cost_state string, cost_usd double, cost_invalid boolean, conflicts string, events long, "
        + ", ".join([f"{c} long" for c in COUNTERS] + [f"{c} string" for c in NAMES])
    )
    _KEPT = "observations long, last long, transport string, interpretation string, cost_state string, cost_usd double, cost_invalid boolean, conflicts string, events long, " + ", ".join([f"{c} long" for c in COUNTERS] + [f"{c} string" for c in NAMES])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("receipt", self._KEPT)
        self.seen = handle.getMapState("seen", "operation string", "one boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        names = [f.split()[0] for f in self._KEPT.split(", ")]
        kept = self.kept.get()
        r = dict(zip(names, kept, strict=True)) if kept else {**dict.fromkeys(names), "observations": 0, "last": -1, "cost_state": "missing", "cost_invalid": False, "conflicts": "", "events": 0}
        conflicts = set(filter(None, r["conflicts"].split(",")))
        events = pd.concat(list(rows)).sort_values("event_id")
        for e in events.astype(object).where(events.notna(), None).to_dict("records"):
            r["events"] += 1
            kind = e["kind"]
            if kind in ("settle", "interpret"):
                field = "transport" if kind == "settle" else "interpretation"
                if r[field] is None:
                    r[field] = e["status"]
                elif r[field] != e["status"]:
                    conflicts.add(field)
            elif kind == "observe":
                conflicts |= self._observed(r, e)
        r["conflicts"] = ",".join(sorted(conflicts))
        self.kept.update(tuple(r[n] for n in names))
        yield pd.DataFrame([{"attempt_id": key[0], **{n: r[n] for n in names if n != "last"}}])[[f.split()[0] for f in self.FIELDS.split(", ")]]

    def _observed(self, r: dict, e: dict) -> set[str]:
        cost_state, cost = e["cost_state"], e["cost_usd"]
        if cost_state == "known" and (cost is None or cost != cost or cost in (float("inf"), float("-inf")) or cost < 0):
            cost_state = "invalid"
        operation = repr([e["sequence"], cost_state, cost if cost_state == "known" else None, *(e[c] for c in COUNTERS + NAMES)])
        if self.seen.containsKey((operation,)):
            return set()
        self.seen.updateValue((operation,), (True,))
        r["observations"] += 1
        expected, r["last"] = r["last"] + 1, max(r["last"], int(e["sequence"]))
        if e["sequence"] != expected:
            return {"observation_sequence"}
        found = set()
        for c in COUNTERS:
            if e[c] is not None:
                if r[c] is not None and e[c] < r[c]:
                    found.add(c)
                r[c] = int(e[c])
        for c in NAMES:
            if e[c] is not None:
                if r[c] is not None and e[c] != r[c]:
                    found.add(c)
                r[c] = e[c]
        if cost_state == "known":
            if r["cost_state"] == "known" and cost < r["cost_usd"]:
                found.add("cost_usd")
            r["cost_state"], r["cost_usd"] = "known", float(cost)
        elif cost_state == "invalid":
            r["cost_state"], r["cost_usd"], r["cost_invalid"] = "invalid", None, True
        return found

    def close(self) -> None:
        pass


def receipt_stream(events: DataFrame) -> DataFrame:
    """The receipts of a stream of attempts' events (attempt_id, event_id, kind, sequence, status, cost_state,
    cost_usd and the counters and names); the row with the most events is an attempt's last."""
    return events.groupBy("attempt_id").transformWithStateInPandas(ReceiptProcessor(), ReceiptProcessor.FIELDS, "Update", "None")
