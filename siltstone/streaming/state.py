"""Keyed state machines on streams: status histories, and payments that wait for their orders.

State lies in RocksDB, one entry for each key (payments: for each bucket of orders), and moves with the stream's checkpoint, so a restarted query goes on where it
stopped. Times are held as microseconds.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructField, StructType

from siltstone import vocab
from siltstone.operators.status import SHIPPING_STAMPS

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state_in_rocks(spark: SparkSession) -> None:
    """State machines need this store; it holds for queries started from now on."""
    spark.conf.set(_STORE, _ROCKS)


class StatusHistory(StatefulProcessor):
    """Folds a key's status events and judges each step as it comes."""

    def __init__(self, names: Sequence[str], event: StructField, allowed: Sequence[tuple[str, str]], stamps: Mapping[str, str]):
        self.names, self.event, self.allowed, self.stamps = list(names), event, frozenset(allowed), dict(stamps)

    def _row(self, *values) -> Row:
        return Row(**dict(zip(self.names, values)))

    def init(self, handle: StatefulProcessorHandle) -> None:
        kind = self.event.dataType.simpleString()
        times = "".join(f", {s} bigint" for s in self.stamps)
        self.state = handle.getValueState(
            "history", f"status string, at bigint, event {kind}, changes bigint, seen string, seen_at bigint, seen_event {kind}{times}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.state.get()
        status, at, event, changes, seen, seen_at, seen_event, *times = held or (None, None, None, 0, None, None, None, *[None] * len(self.stamps))
        before = changes
        steps = sorted((((r["at"], r["event"]), r["event"], r["status"]) for r in rows), key=lambda step: step[0])
        for place, name, now in steps:
            if seen_at is not None and place < (seen_at, seen_event):
                yield self._row(*key, "out_of_order", name, place[0], None, now, None, *[None] * len(times))
            else:
                if seen is not None and now is not None and seen != now and (seen, now) not in self.allowed:
                    yield self._row(*key, "illegal", name, place[0], seen, now, None, *[None] * len(times))
                seen, (seen_at, seen_event) = now, place
            if now is None:
                continue
            changes += 1
            if at is None or place >= (at, event):
                status, (at, event) = now, place
            times = [min(place[0], t) if t is not None and now == value else place[0] if now == value else t
                     for t, value in zip(times, self.stamps.values())]
        self.state.update((status, at, event, changes, seen, seen_at, seen_event, *times))
        if changes > before:
            yield self._row(*key, "state", event, at, None, status, changes, *times)

    def close(self) -> None:
        pass


def status_stream(
    events: DataFrame, key: str, at: str, event: str, status_to: str = "status_to",
    allowed: Sequence[tuple[str, str]] = vocab.SHIPPING_FLOW, stamps: Mapping[str, str] = SHIPPING_STAMPS,
) -> DataFrame:
    """Q7 and Q8 on a stream: (key, kind, event, at, status_from, status_to, changes, one time for each stamp).

    For each key that a micro-batch moves, a `state` row gives its status as the newest event has it, how many events it
    has had, and the first time of each stamped status: the row with most `changes` is the current one, whatever order the events came in. A step
    that doesn't follow from the event before it comes out at once as `illegal`; one that is older than what its key has seen is
    not judged, and comes out as `out_of_order`. Events without a status change nothing, those without a time are left out. Events
    without a key are one history. A key's events of one micro-batch are put in order in memory.
    """
    rows = events.filter(F.col(at).isNotNull()).select(
        key, F.unix_micros(F.col(at).cast("timestamp")).alias("at"), F.col(event).alias("event"), F.col(status_to).alias("status"))
    times = "".join(f", {s} bigint" for s in stamps)
    shape = StructType([events.schema[key], *StructType.fromDDL("kind string").fields, StructField("event", events.schema[event].dataType),
                        *StructType.fromDDL(f"at bigint, status_from string, status_to string, changes bigint{times}").fields])
    keep_state_in_rocks(events.sparkSession)
    out = rows.groupBy(key).transformWithState(StatusHistory(shape.names, rows.schema["event"], allowed, stamps), shape, "Append", "None")
    return out.withColumns({c: F.timestamp_micros(c) for c in ("at", *stamps)}).withColumnRenamed("event", event)


class PaymentDesk(StatefulProcessor):
    """Keeps orders' times, and payments that have come before their order, for all the orders of one bucket.

    A call into the store costs far more than a few dozen entries do, so a bucket is read and written as one value, and has
    one timer, for the first of its entries that falls due.
    """

    def __init__(self, names: Sequence[str], key: StructField, payment: StructField, band: int, remember: int):
        self.names, self.key, self.payment, self.band, self.remember = list(names), key, payment, band, remember

    def _row(self, *values) -> Row:
        return Row(**dict(zip(self.names, values)))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        key, payment = self.key.dataType.simpleString(), self.payment.dataType.simpleString()
        self.state = handle.getValueState(
            "desk", f"orders array<{key}>, ordered array<bigint>, owing array<{key}>, payments array<{payment}>, paid array<bigint>, wake bigint")

    def _held(self) -> tuple[dict, dict, int | None]:
        """Orders' times; times of waiting payments by order and payment; when the bucket wakes."""
        held = self.state.get()
        if not held:
            return {}, {}, None
        orders, ordered, owing, payments, paid, wake = held
        waiting: dict = {}
        for order, payment, at in zip(map(_hashed, owing), map(_hashed, payments), paid):
            waiting.setdefault(order, {})[payment] = at
        return dict(zip(map(_hashed, orders), ordered)), waiting, wake

    def _keep(self, orders: dict, waiting: dict, wake: int | None, due: int | None) -> None:
        """Writes a bucket whose first entry falls due at `due`; it is woken anew if it wouldn't wake by then."""
        if due is None:
            self.state.clear()
            return
        at = -(-due // 1000)
        if wake is None or at < wake:
            self.handle.registerTimer(at)
            wake = at
        owing = [(order, payment, paid) for order, own in waiting.items() for payment, paid in own.items()]
        self.state.update((
            list(orders), list(orders.values()), [o for o, _, _ in owing], [p for _, p, _ in owing], [t for _, _, t in owing], wake))

    def _due(self, orders: dict, waiting: dict) -> int | None:
        return min((*(o + self.remember for o in orders.values()), *(p + self.band for own in waiting.values() for p in own.values())), default=None)

    def _judged(self, order, payment, paid: int, ordered: int) -> Row:
        result = "joined" if abs(paid - ordered) <= self.band else "late"
        return self._row(order, payment, paid, ordered, result)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        orders, waiting, wake = self._held()
        changed = False
        for r in rows:
            order, payment, at = _hashed(r["order"]), _hashed(r["payment"]), r["at_us"]
            ordered = orders.get(order)
            if payment is not None and ordered is not None:
                yield self._judged(order, payment, at, ordered)
            elif payment is not None:
                waiting.setdefault(order, {})[payment] = at
                changed = True
            elif ordered is None:
                orders[order] = at
                changed = True
                for own, paid in waiting.pop(order, {}).items():
                    yield self._judged(order, own, paid, at)
        if changed:
            self._keep(orders, waiting, wake, self._due(orders, waiting))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        orders, waiting, wake = self._held()
        # All that the watermark has passed, as if each entry had a timer of its own.
        now = timerValues.getCurrentWatermarkInMs() * 1000
        if wake is None or wake * 1000 > now:
            return
        for order, own in waiting.items():
            for payment, paid in own.items():
                if paid + self.band <= now:
                    yield self._row(order, payment, paid, None, "no_order")
        waiting = {o: kept for o, own in waiting.items() if (kept := {p: t for p, t in own.items() if t + self.band > now})}
        orders = {o: t for o, t in orders.items() if t + self.remember > now}
        self._keep(orders, waiting, None, self._due(orders, waiting))

    def close(self) -> None:
        pass


def _hashed(value):
    return bytes(value) if isinstance(value, bytearray) else value


#: Entries of the state that orders are dealt to.
BUCKETS = 1 << 16


def payment_desk_stream(
    payments: DataFrame, orders: DataFrame, key: str, payment: str, paid_at: str, ordered_at: str,
    minutes: int = vocab.LATE_MINUTES, delay: str | None = None, remember: int = 24 * 60, *, salts: int = 1, buckets: int = BUCKETS,
) -> DataFrame:
    """J7 with a reason for every payment: (key, payment, paid_at, ordered_at, result).

    `joined`: the order is at most `minutes` away, either way; `late`: the order is known, but further away. Both come out as soon as
    payment and order are there. `no_order`: no order has come until the watermark passed the payment by `minutes`. A payment
    in neither is waiting in the state. Orders are remembered for `remember` minutes of event time, after which a payment for one counts as having none.
    There is one order for each key. Payments and orders without a key, a time or (payments) an id are left out.
    Where single orders have very many payments, `salts` spreads them over so many state entries; orders are kept once for each.
    Orders are dealt to `buckets` by a hash of their key. A bucket that a micro-batch touches is read and written whole, so there should be
    one for every few dozen to few hundred orders that are remembered at a time; a checkpoint goes with its number.
    """
    spark = payments.sparkSession
    delay = delay or f"{minutes} minutes"
    known = F.col(key).isNotNull()
    salt = F.pmod(F.xxhash64(payment), F.lit(salts)).cast("int")
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    left = payments.filter(known & F.col(paid_at).isNotNull() & F.col(payment).isNotNull()).select(
        bucket.alias("bucket"), F.col(key).alias("order"), salt.alias("salt"), F.col(payment).alias("payment"), F.col(paid_at).cast("timestamp").alias("at"))
    right = orders.filter(known & F.col(ordered_at).isNotNull()).select(
        bucket.alias("bucket"), F.col(key).cast(payments.schema[key].dataType).alias("order"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
        F.lit(None).cast(payments.schema[payment].dataType).alias("payment"), F.col(ordered_at).cast("timestamp").alias("at"))
    rows = left.unionByName(right).withWatermark("at", delay).withColumn("at_us", F.unix_micros("at"))
    shape = StructType([payments.schema[key], StructField(payment, payments.schema[payment].dataType),
                        *StructType.fromDDL(f"{paid_at} bigint, {ordered_at} bigint, result string").fields])
    keep_state_in_rocks(spark)
    desk = PaymentDesk(shape.names, rows.schema["order"], rows.schema["payment"], minutes * 60_000_000, remember * 60_000_000)
    out = rows.groupBy("bucket", "salt").transformWithState(desk, shape, "Append", "EventTime")
    return out.withColumns({c: F.timestamp_micros(c) for c in (paid_at, ordered_at)})
