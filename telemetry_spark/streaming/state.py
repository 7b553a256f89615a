"""Keyed state: trails, users, traces, queues and tallies with retries.

With a watermark, processors that follow ``InOrder`` see a key's rows in the order of ``at`` and ``seq`` whatever micro-batch they come in:
rows wait in state by slots of time and are replayed when the watermark has passed their slot. Without one they see each micro-batch's
rows in that order at once. What is kept is bounded by the rule itself, and by the rows that wait.

Processors of many small keys (``BUCKETS``) take the keys of a bucket in one call, with an entry of state per key: what a call costs is
shared by the keys of a bucket.
"""

from __future__ import annotations

import heapq
import pickle
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegralType

from telemetry_spark.config import MAX_CONSECUTIVE_FAILURES, MAX_PENDING_TRACES, MAX_SPANS, Config
from telemetry_spark.functions.delivery import FAILED, delivery_outcome_of
from telemetry_spark.functions.latency import BOUNDARIES_MS, LABELS
from telemetry_spark.functions.timefmt import iso_millis
from telemetry_spark.operators.traces import strict_spans
from telemetry_spark.plans.session import fresh_dir
from telemetry_spark.streaming.runs import control_stream, flush_now, state_rows

DAY_MS = 24 * 3600 * 1000
#: The kind of a control row: what waits is replayed at once.
FLUSH = "flush"
#: Keys are dealt to so many buckets by processors that take many keys at once; the columns with a row's bucket, and its key as text.
#: (In pandas a name must not begin with an underscore.)
BUCKETS, BUCKET, KEY = 512, "state_bucket", "state_key"
#: A chunk of fewer rows than this may hold rows of several slots.
MIXED_ROWS = 500
#: Rows go out in frames of so many, traces in frames of so many spans.
SENT_ROWS, SENT_SPANS = 10_000, 100_000
#: Spans of a trace that are rewritten when more come; beyond these they lie in parts of so many. Traces that are given up are listed by so many.
TAIL_SPANS, PART_SPANS, LISTED_TRACES = 64, 500, 100


def _records(chunk: pd.DataFrame) -> list[dict]:
    """Rows as records, ``at`` in microseconds. Nulls are ``None`` whatever their column's type."""
    columns = {c: [None if v is None or v != v else v for v in chunk[c].tolist()] for c in chunk.columns}
    columns["at"] = [None if v is None else pd.Timestamp(v).value // 1000 for v in columns["at"]]
    return [dict(zip(columns, values, strict=True)) for values in zip(*columns.values(), strict=True)]


def _in_order(records: list[dict]) -> list[dict]:
    """Records by ``at`` and ``seq``, those without one last."""
    return sorted(records, key=lambda r: (r["at"] is None, r["at"] or 0, r["seq"] is None, r["seq"] or 0))


def _ordered(chunks: Iterator[pd.DataFrame]) -> list[dict]:
    return _in_order([row for chunk in chunks for row in _records(chunk)])


def _frames(rows: Iterator[tuple], columns: list[str], spans: int | None = None) -> Iterator[pd.DataFrame]:
    """Rows as frames of a bounded size, also in spans if rows hold these in column ``spans``; none if there are no rows."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        if spans is not None:
            total += len(row[spans] or ())
        if len(held) >= SENT_ROWS or total >= SENT_SPANS:
            yield pd.DataFrame(held, columns=columns)
            held, total = [], 0
    if held:
        yield pd.DataFrame(held, columns=columns)


class Keyed(StatefulProcessor):
    """A processor with one state per key, or with the states of many keys in one call, kept apart by the key, if it has ``buckets``."""

    buckets: int | None = None
    in_order = False
    #: What ``keyed`` tells of the key: its column, and the type under which a bucket keeps it.
    key, key_type = "key", "string"

    def own_state(self, handle: StatefulProcessorHandle, name: str, value: str):
        """A state with an entry for each key of a bucket."""
        return handle.getMapState(name, f"`{self.key}` {self.key_type}", value)

    def state_key(self, text: str | None) -> tuple:
        return (text if text is None or self.key_type == "string" else int(text),)

    def close(self) -> None:
        pass


class InOrder(Keyed):
    """Replays rows in event time. A subclass says what rows do in ``replay``, and what has fallen due by a time in ``due``.

    Rows wait by slots of ``slot_ms``, as the chunks they came in: a hot key's rows are read chunk by chunk and never held together, and
    one slot's rows are what is sorted at a time. A small chunk waits whole under its first slot; when that is replayed, its rows of later
    slots wait anew. A slot is replayed when the watermark passes its end. A control row (kind ``flush``) has all that waits replayed at
    once; rows of earlier times that come after that are replayed after it.
    """

    slot_ms = 60_000

    def waiting(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getMapState("waiting", "slot bigint", "parts int")
        self.chunks = handle.getMapState("chunks", "slot bigint, part int", "rows binary")

    def handleInputRows(self, key, rows, timerValues):
        if not self.in_order:
            yield from self.replay(key, iter(_ordered(rows)))
            return
        asked, known = False, self._known()
        for chunk in rows:
            timed = [row for row in _records(chunk) if row["at"] is not None]
            held = [row for row in timed if row["kind"] != FLUSH]
            asked = asked or len(held) < len(timed)
            self._wait(held, known)
        if asked:
            yield from self._drain(key, None)

    def _known(self) -> dict[int, int]:
        """How many chunks wait, by slot."""
        return {slot: parts for (slot,), (parts,) in self.parts.iterator()}

    def _slot(self, row: dict) -> int:
        return row["at"] // 1000 // self.slot_ms

    def _wait(self, rows: list[dict], known: dict[int, int]) -> None:
        if not rows:
            return
        slots = {}
        for row in rows:
            slots.setdefault(self._slot(row), []).append(row)
        first = min(slots)
        # One timer at the end of the first slot is enough; it is set anew for the next.
        if not known or first < min(known):
            self.handle.registerTimer((first + 1) * self.slot_ms)
        for slot, own in ({first: rows} if len(rows) < MIXED_ROWS else slots).items():
            part = known.get(slot, 0)
            stored = (list(own[0]), [tuple(row.values()) for row in own])
            self.chunks.updateValue((slot, part), (pickle.dumps(stored, pickle.HIGHEST_PROTOCOL),))
            self.parts.updateValue((slot,), (part + 1,))
            known[slot] = part + 1

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._drain(key, timerValues.getCurrentWatermarkInMs())

    def _drain(self, key, upto: int | None):
        """Replay, slot by slot, what waits for the watermark; all of it if there is none."""
        known = self._known()
        if any(upto is None or (slot + 1) * self.slot_ms <= upto for slot in known):
            yield from self.replay(key, self._due_rows(known, upto))
        if upto is not None:
            yield from self.due(key, upto)

    def _due_rows(self, known: dict[int, int], upto: int | None) -> Iterator[dict]:
        slots, later = sorted(known), {}
        while slots and (upto is None or (slots[0] + 1) * self.slot_ms <= upto):
            slot = heapq.heappop(slots)
            rows = later.pop(slot, [])
            for part in range(known.get(slot, 0)):
                names, stored = pickle.loads(self.chunks.getValue((slot, part))[0])
                for row in (dict(zip(names, values, strict=True)) for values in stored):
                    own = self._slot(row)
                    if own == slot:
                        rows.append(row)
                        continue
                    if own not in later:
                        later[own] = []
                        if own not in known:
                            heapq.heappush(slots, own)
                    later[own].append(row)
                self.chunks.removeKey((slot, part))
            if known.pop(slot, None):
                self.parts.removeKey((slot,))
            yield from _in_order(rows)
        if known:
            self.handle.registerTimer((min(known) + 1) * self.slot_ms)
        self._wait([row for rows in later.values() for row in rows], known)

    def replay(self, key, rows: Iterator[dict]) -> Iterator[pd.DataFrame]:
        raise NotImplementedError

    def due(self, key, upto: int) -> Iterator[pd.DataFrame]:
        return iter(())


class BreadcrumbRing(InOrder):
    """Keeps a key's last breadcrumbs since the last clear and sends them with each error.

    Rows: ``at``, ``seq``, ``kind`` (crumb, clear or error), ``id``, ``crumb`` (text).
    """

    SCHEMA = "id string, crumbs int, trail array<string>"
    buckets = BUCKETS

    def __init__(self, size: int = 30):
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting(handle)
        self.ring = self.own_state(handle, "ring", "trail array<string>")

    def replay(self, key, rows):
        yield from _frames(self._sent(rows), ["id", "crumbs", "trail"])

    def _sent(self, rows):
        known, rings = {}, {}
        for row in rows:
            own = row[KEY]
            if own not in rings:
                found = self.ring.getValue(self.state_key(own))
                known[own] = list(found[0]) if found else []
                rings[own] = list(known[own])
            ring = rings[own]
            if row["kind"] == "crumb":
                ring.append(row["crumb"])
                del ring[: -self.size]
            elif row["kind"] == "clear":
                ring.clear()
            else:
                yield row["id"], len(ring), list(ring)
        for own, ring in rings.items():
            if ring and ring != known[own]:
                self.ring.updateValue(self.state_key(own), (ring,))
            elif known[own] and not ring:
                self.ring.removeKey(self.state_key(own))


class UserState(InOrder):
    """Keeps a key's current user. Rows: ``at``, ``seq``, ``kind`` (set or event), ``id``, ``user``.

    An event's own user wins; setting a null user clears.
    """

    SCHEMA = "id string, user string"
    buckets = BUCKETS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting(handle)
        self.user = self.own_state(handle, "user", "user string")

    def replay(self, key, rows):
        yield from _frames(self._sent(rows), ["id", "user"])

    def _sent(self, rows):
        known, users = {}, {}
        for row in rows:
            own = row[KEY]
            if own not in users:
                found = self.user.getValue(self.state_key(own))
                known[own] = users[own] = found[0] if found else None
            if row["kind"] == "set":
                users[own] = row["user"]
            else:
                yield row["id"], users[own] if row["user"] is None else row["user"]
        for own, user in users.items():
            if user is None and known[own] is not None:
                self.user.removeKey(self.state_key(own))
            elif user != known[own]:
                self.user.updateValue(self.state_key(own), (user,))


class TraceAssembler(Keyed):
    """Holds a trace's spans until its root comes, then sends them, root first, if the trace was slow.

    Rows: ``at`` (with a watermark), ``seq``, ``is_root``, ``duration_ms``, ``span`` (JSON text). The first root
    finishes the trace; spans after it are dropped, as are those beyond ``limit``, which counts the root: by default as many as
    a client's trace may have, with ``None`` all spans before the root are sent. A trace is forgotten, finished or
    not, once the watermark is ``ttl_ms`` past its first row. One that never got its root then comes out as a row
    without a root and without spans, with the number of spans that were given up. A root that comes after that starts
    a new trace of the same id.

    State: an entry per trace with its last spans, and one per part of up to ``PART_SPANS`` before them. Traces that came in together are listed
    under the time when the first of them is given up, which has a timer.
    """

    SCHEMA = "trace_id string, spans int, root string, rest array<string>"
    COLUMNS = ["trace_id", "spans", "root", "rest"]
    buckets = BUCKETS

    def __init__(self, threshold_s: float = 1.0, limit: int | None = MAX_SPANS, ttl_ms: int = DAY_MS):
        self.threshold_s, self.limit, self.ttl_ms = threshold_s, limit, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.traces = self.own_state(handle, "traces", "closed boolean, parts int, n int, spans array<string>")
        self.spans = handle.getMapState("spans", f"`{self.key}` {self.key_type}, part int", "spans array<string>")
        self.listed = handle.getMapState("listed", "at bigint", "traces array<string>, due array<bigint>")

    def handleInputRows(self, key, rows, timerValues):
        yield from _frames(self._sent(rows), self.COLUMNS, self.COLUMNS.index("rest"))

    def _sent(self, rows):
        traces, changed, new = {}, set(), []
        for row in _ordered(rows):
            if row["at"] is None:
                continue
            own = row[KEY]
            if own not in traces:
                found = self.traces.getValue(self.state_key(own))
                if not found:
                    new.append((row["at"] // 1000 + self.ttl_ms, own))
                    changed.add(own)
                traces[own] = [*found[:3], list(found[3])] if found else [False, 0, 0, []]
            trace = traces[own]
            closed, parts, n, tail = trace
            if closed:
                continue
            if row["is_root"]:
                changed.add(own)
                held = self._taken(own, parts)
                traces[own] = [True, 0, 0, []]
                # A root without a duration finishes its trace, which is not known to be slow.
                if row["duration_ms"] is not None and row["duration_ms"] >= self.threshold_s * 1000:
                    yield own, n + 1, row["span"], held + tail
            elif self.limit is None or n < self.limit - 1:
                changed.add(own)
                tail.append(row["span"])
                trace[2] = n + 1
        for own in changed:
            closed, parts, n, tail = traces[own]
            if len(tail) > TAIL_SPANS:
                for start in range(0, len(tail), PART_SPANS):
                    self.spans.updateValue((*self.state_key(own), parts), (tail[start : start + PART_SPANS],))
                    parts += 1
                tail = []
            self.traces.updateValue(self.state_key(own), (closed, parts, n, tail))
        self._list(new)

    def _taken(self, own: str | None, parts: int) -> list[str]:
        """The parts of a trace's spans, which are no longer kept."""
        held = []
        for part in range(parts):
            entry = (*self.state_key(own), part)
            held += self.spans.getValue(entry)[0]
            self.spans.removeKey(entry)
        return held

    def _list(self, traces: list[tuple[int, str | None]]) -> None:
        """Remember when traces are to be given up."""
        traces.sort(key=lambda t: t[0])
        for i in range(0, len(traces), LISTED_TRACES):
            due, names = (list(c) for c in zip(*traces[i : i + LISTED_TRACES], strict=True))
            at, before = due[0], self.listed.getValue((due[0],))
            if before:
                names, due = [*before[0], *names], [*before[1], *due]
            self.listed.updateValue((at,), (names, due))
            self.handle.registerTimer(at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from _frames(self._given_up(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()), self.COLUMNS)

    def _given_up(self, at: int, watermark: int):
        found = self.listed.getValue((at,))
        if not found:
            return
        self.listed.removeKey((at,))
        later = []
        for own, due in zip(*found, strict=True):
            if due > watermark:
                later.append((due, own))
                continue
            _, parts, n, _ = self.traces.getValue(self.state_key(own))
            for part in range(parts):
                self.spans.removeKey((*self.state_key(own), part))
            self.traces.removeKey(self.state_key(own))
            if n:
                yield own, n, None, None
        self._list(later)


class QueueAdmission(Keyed):
    """Admits a source's finished traces (``delta`` +1) while fewer than ``limit`` wait; deliveries (-1) make room."""

    SCHEMA = "source string, trace_id string, admitted boolean, pending int"
    buckets = BUCKETS

    def __init__(self, limit: int = MAX_PENDING_TRACES):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pending = self.own_state(handle, "pending", "pending int")

    def handleInputRows(self, key, rows, timerValues):
        yield from _frames(self._sent(rows), ["source", "trace_id", "admitted", "pending"])

    def _sent(self, rows):
        sources = {}
        for row in _ordered(rows):
            own = row[KEY]
            if own not in sources:
                found = self.pending.getValue(self.state_key(own))
                sources[own] = found[0] if found else 0
            if row["delta"] is None:
                continue
            wanted = sources[own] + int(row["delta"])
            sources[own] = min(wanted, self.limit)
            yield own, row["trace_id"], wanted <= self.limit, sources[own]
        for own, pending in sources.items():
            self.pending.updateValue(self.state_key(own), (pending,))


class _Source:
    """What ``TallyFlusher`` holds of a source: its tallies, their labels, and where its flushes stand."""

    def __init__(self, name: str | None, settings: tuple | None, tally: dict, label: dict):
        self.name, self.stored_tally, self.stored_label, self.tally, self.label = name, tally, label, dict(tally), dict(label)
        self.failures, self.started, self.ended, self.due, self.flushes = settings or (0, None, None, None, 0)
        self.stored_due = self.due

    def settings(self) -> tuple:
        return self.failures, self.started, self.ended, self.due, self.flushes

    @staticmethod
    def by_transaction(tally: dict, label: dict) -> dict[str | None, tuple]:
        """Tallies with their labels' counts, those held and those sent."""
        pairs = {name: [label.get((name, x), (0, 0)) for x in LABELS] for (name,) in tally}
        return {name: (*held, [n for n, _ in pairs[name]], [sent for _, sent in pairs[name]]) for (name,), held in tally.items()}

    def add(self, name: str | None, duration: float) -> None:
        n, total, longest, newest, sent_n, sent_total = self.tally.get((name,), (0, 0.0, 0.0, 0.0, 0, 0.0))
        self.tally[(name,)] = (n + 1, total + duration, max(longest, duration), max(newest, duration), sent_n, sent_total)
        entry = (name, LABELS[bisect_left(BOUNDARIES_MS, duration)])
        held, sent = self.label.get(entry, (0, 0))
        self.label[entry] = (held + 1, sent)

    def snapshot(self, seq: int, ended_us: int) -> Iterator[tuple]:
        """Send every tally, and remember what of it is on its way. Without tallies there is nothing to settle."""
        histograms = {}
        for (name, label), (n, _) in self.label.items():
            histograms.setdefault(name, {})[label] = n
            self.label[(name, label)] = (n, n)
        period = [pd.Timestamp(us, unit="us") for us in (self.started, ended_us)]
        for (name,), (n, total, longest, _, _, _) in self.tally.items():
            yield (self.name, seq, name, n, total, longest, histograms.get(name, {}), *period)
            self.tally[(name,)] = (n, total, longest, 0.0, n, total)
        if self.tally:
            self.ended = ended_us

    def take_off(self, carry_max: bool) -> None:
        """Subtract what was sent, and only that: records that came in while it was on its way stay."""
        self.label = {entry: (n - sent, 0) for entry, (n, sent) in self.label.items() if n > sent}
        self.tally = {
            name: (n - sent_n, max(0.0, total - sent_total), longest if carry_max else newest, newest, 0, 0.0)
            for name, (n, total, longest, newest, sent_n, sent_total) in self.tally.items() if n > sent_n
        }


class TallyFlusher(InOrder):
    """Tallies of one source between deliveries.

    Rows: ``at``, ``seq``, ``kind``, ``transaction_name``, ``duration_ms``, ``status``. A ``record`` is tallied, a
    ``snapshot`` sends every tally, an ``outcome`` settles the last snapshot by its status: delivered and rejected
    tallies go, failed ones stay for the next snapshot until ``limit`` failures in a row drop them too.
    ``carry_max`` keeps a maximum that has been sent on a tally that still holds newer records; without it such a tally
    goes on with the maximum of its newer records.

    A snapshot covers the period from where the last settled one ended, at first from the source's first row, to its own moment. With a
    watermark and ``interval_ms`` snapshots also fall due by themselves, at every multiple of the interval that finds a tally; a timer
    sends the last one when no row follows it.

    State: one entry per transaction with what is held and what of it has been sent. Without a watermark a source has a state of its own,
    with an entry per transaction and label and one of its settings; with one the sources of a bucket share a state, a transaction's labels
    lie in its entry, and sources are listed under the time when their next snapshot falls due. A source's entries are read once for all
    rows that are replayed together, and those that have changed are written.
    """

    SCHEMA = (
        "source string, flush_seq bigint, transaction_name string, request_count bigint, duration_sum_ms double, "
        "max_duration_ms double, histogram map<string,bigint>, period_started_at timestamp, period_ended_at timestamp"
    )
    COLUMNS = ["source", "flush_seq", "transaction_name", "request_count", "duration_sum_ms", "max_duration_ms", "histogram",
               "period_started_at", "period_ended_at"]

    def __init__(self, limit: int = MAX_CONSECUTIVE_FAILURES, carry_max: bool = True, interval_ms: int | None = None):
        self.limit, self.carry_max, self.interval_ms = limit, carry_max, interval_ms

    @property
    def buckets(self) -> int | None:
        return BUCKETS if self.in_order else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting(handle)
        settings = "failures int, started_us bigint, ended_us bigint, next_ms bigint, flushes bigint"
        tally = "n bigint, total double, longest double, newest double, sent_n bigint, sent_total double"
        if self.in_order:
            self.sources = self.own_state(handle, "sources", f"{settings}, names array<string>")
            self.tallies = handle.getMapState(
                "tallies", f"`{self.key}` {self.key_type}, transaction_name string", f"{tally}, labels array<bigint>, sent_labels array<bigint>")
            self.listed = handle.getMapState("listed", "at bigint", "sources array<string>")
            return
        self.tallies = handle.getMapState("tallies", "transaction_name string", tally)
        self.labels = handle.getMapState("labels", "transaction_name string, label string", "n bigint, sent_n bigint")
        self.settings = handle.getValueState("settings", settings)

    def replay(self, key, rows):
        yield from _frames(self._sent(key, rows), self.COLUMNS)

    def _sent(self, key, rows):
        sources = {}
        for row in rows:
            name = row[KEY] if self.in_order else key[0]
            if name not in sources:
                sources[name] = self._held(name)
            own, at_us = sources[name], row["at"]
            own.started = at_us if own.started is None else own.started
            if own.due is not None and at_us >= own.due * 1000:
                yield from self._fell_due(own)
            if row["kind"] == "record":
                if row["duration_ms"] is not None:  # else nothing was measured
                    own.add(row["transaction_name"], float(row["duration_ms"]))
                    own.due = self._next(at_us) if own.due is None else own.due
            elif row["kind"] == "snapshot":
                yield from own.snapshot(row["seq"], at_us)
            elif own.ended is not None:
                # No status is no answer, which the rules count as a failure.
                failed = delivery_outcome_of(0 if row["status"] is None else int(row["status"])) == FAILED
                own.failures = own.failures + 1 if failed else 0
                if not failed or own.failures >= self.limit:
                    own.take_off(self.carry_max)
                    own.failures, own.started = 0, own.ended
                own.ended = None
                if own.due is None and self.interval_ms is not None and own.tally:
                    own.due = self._next(at_us)  # what failed, or came in meanwhile, is tried again
        self._keep(list(sources.values()))

    def _fell_due(self, own: _Source):
        if own.ended is None:  # else the last snapshot is still on its way
            own.flushes += 1
            yield from own.snapshot(own.flushes, own.due * 1000)
        own.due = None

    def due(self, key, upto):
        if self.interval_ms is not None:  # else nothing falls due by itself
            yield from _frames(self._sent_by(upto), self.COLUMNS)

    def _sent_by(self, upto):
        for at in sorted(at for (at,) in self.listed.keys()):
            if at > upto:
                break
            for name in self.listed.getValue((at,))[0]:
                own = self._held(name)
                if own.due is not None and own.due <= upto:
                    yield from self._fell_due(own)
                    self._keep([own])
            self.listed.removeKey((at,))

    def _next(self, at_us: int) -> int | None:
        return None if self.interval_ms is None else (at_us // 1000 // self.interval_ms + 1) * self.interval_ms

    def _held(self, name: str | None) -> _Source:
        """What is held of a source."""
        if not self.in_order:
            return _Source(name, self.settings.get() if self.settings.exists() else None, dict(self.tallies.iterator()), dict(self.labels.iterator()))
        found, tally, label = self.sources.getValue(self.state_key(name)), {}, {}
        for transaction in found[5] if found else ():
            *held, n, sent = self.tallies.getValue((*self.state_key(name), transaction))
            tally[(transaction,)] = tuple(held)
            label |= {(transaction, LABELS[i]): pair for i, pair in enumerate(zip(n, sent, strict=True)) if any(pair)}
        return _Source(name, found[:5] if found else None, tally, label)

    def _keep(self, sources: list[_Source]) -> None:
        listed = {}
        for own in sources:
            if not self.in_order:
                self.settings.update(own.settings())
                self._store(self.tallies, own.stored_tally, own.tally)
                self._store(self.labels, own.stored_label, own.label)
                continue
            if own.due is not None and own.due != own.stored_due:
                listed.setdefault(own.due, []).append(own.name)
            names = [transaction for (transaction,) in own.tally]
            before, after = own.by_transaction(own.stored_tally, own.stored_label), own.by_transaction(own.tally, own.label)
            key = self.state_key(own.name)
            self._store(self.tallies, *({(*key, transaction): entry for transaction, entry in held.items()} for held in (before, after)))
            self.sources.updateValue(key, (*own.settings(), names))
        for at, names in listed.items():
            others = self.listed.getValue((at,))
            self.listed.updateValue((at,), ([*(others[0] if others else []), *names],))
            self.handle.registerTimer(at)

    @staticmethod
    def _store(kept, stored: dict, held: dict) -> None:
        for entry, value in held.items():
            if stored.get(entry) != value:
                kept.updateValue(entry, value)
        for entry in stored.keys() - held.keys():
            kept.removeKey(entry)


def keyed(df: DataFrame, key: str, processor: Keyed, watermark: str | None = None, control: DataFrame | None = None) -> DataFrame:
    """Run a processor over a stream, one state per key; with a watermark on ``at`` where its state expires or rows are to be in order.

    ``control`` is a stream of control rows: the key, or the bucket of a processor that has buckets, ``at`` and ``kind``.
    """
    kind, group = df.schema[key].dataType, key
    processor.in_order = watermark is not None
    if processor.buckets:
        # The key goes as text, which stays as it is beside nulls; a bucket keeps whole numbers as what they are.
        processor.key, processor.key_type = key, kind.simpleString() if isinstance(kind, IntegralType) else "string"
        group, number = BUCKET, F.pmod(F.xxhash64(key), F.lit(processor.buckets)).cast("int")
        df = df.withColumns({BUCKET: number, KEY: F.col(key).cast("string")})
    if control is not None:
        df = df.unionByName(control, allowMissingColumns=True)
    if watermark is not None:
        df = df.withWatermark("at", watermark)
    return df.groupBy(group).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=processor.SCHEMA,
        outputMode="Append",
        timeMode="None" if watermark is None else "EventTime",
    )


def stream_traces(
    df: DataFrame, cfg: Config = Config(), watermark: str = "10 minutes", limit: int | None = MAX_SPANS, ttl_ms: int = DAY_MS,
) -> DataFrame:
    """Slow traces out of a stream of recorded spans (``operators.traces.spans``, with ``seq``): root and rest as JSON texts.

    Names and data are reduced before a span is kept when privacy is strict, so no state holds what may not be sent.
    """
    reduced = strict_spans(df) if cfg.strict_privacy else df
    fields = ["span_id", "parent_span_id", "name", "kind", iso_millis(F.col("started_at")).alias("started_at"), "duration_ms",
              "environment", "release", "data"]
    rows = reduced.where(F.lit(cfg.track_tracing)).select(
        "trace_id", F.col("started_at").alias("at"), "seq", F.col("parent_span_id").isNull().alias("is_root"), "duration_ms",
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("span"),
    )
    return keyed(rows, "trace_id", TraceAssembler(cfg.trace_capture_threshold, limit, ttl_ms), watermark)


def waiting_keys(spark: SparkSession, checkpoint: str, slot_ms: int) -> DataFrame:
    """A control row for each key, or bucket, with rows that wait, as of the last committed batch. Its time lies in the last slot it has an
    entry for, just before that slot's end, so that it is never late itself and moves the watermark by less than a slot."""
    held = state_rows(spark, checkpoint, "waiting")
    return held.groupBy("key").agg(F.max("user_map_key.slot").alias("slot")).select(
        "key.*", F.timestamp_millis((F.col("slot") + 1) * slot_ms - 1).alias("at"), F.lit(FLUSH).alias("kind"))


def flush_waiting(df: DataFrame, key: str, processor: InOrder, watermark: str, path: str, checkpoint: str, control: str) -> DataFrame:
    """Process everything that has arrived in order, then replay what still waits, and stop. The stream's output is what is returned."""
    spark, processor.in_order = df.sparkSession, True
    group = f"{BUCKET} int" if processor.buckets else f"`{key}` {df.schema[key].dataType.simpleString()}"
    asks = control_stream(spark, control, f"{group}, at timestamp, kind string")
    stream = keyed(df, key, processor, watermark, asks)
    schema = stream.schema
    flush_now(stream, path, checkpoint)
    waiting_keys(spark, checkpoint, processor.slot_ms).write.mode("append").parquet(control)
    flush_now(stream, path, checkpoint)
    return spark.read.schema(schema).parquet(path)


def collected_in_order(df: DataFrame, key: str, processor: InOrder, watermark: str, checkpoint: str | None = None) -> DataFrame:
    """All that a finite stream comes to in event time, out of a fresh folder."""
    out, own, control = (fresh_dir(df.sparkSession, f"in-order-{name}") for name in ("out", "checkpoint", "control"))
    return flush_waiting(df, key, processor, watermark, out, checkpoint or own, control)


def kept_trails(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The trails that a stream of ``BreadcrumbRing`` keeps, oldest crumb first: its key and ``trail``, as of the last committed batch."""
    return state_rows(spark, checkpoint, "ring").select("user_map_key.*", F.col("user_map_value.trail").alias("trail"))
