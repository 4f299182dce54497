"""Look-back columns of a stream, from state that is kept per customer.

A customer's state has the instants of its rows with their sums, in one value
while they are few; the hours of a longer history move to entries of their own,
and the value keeps the sums of each whole hour. A row needs the sums of the
hours inside its period and the instants of the two hours that the period cuts,
so a batch reads one value per customer and, of a long history, a few hours'
instants. Hours that the watermark leaves behind are removed as rows arrive, and
a timer clears the state of a customer who has gone quiet.

Rows go to and from Python as plain rows, and many answered ones as one row of
arrays: most customers have a handful of rows in a batch, for which a data frame
each would cost far more than the sums.
"""

from __future__ import annotations

import struct
import sys
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import cache
from itertools import accumulate

from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskspark.contract import DEFAULT_CONTRACT, Contract
from riskspark.functions import micros_of
from riskspark.operators.velocity import ACTIVITY_HOURS, AVERAGE_DAYS

# Executors run the processor without this package.
register_pickle_by_value(sys.modules[__name__])

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_HOUR = 3_600_000_000
_LONGEST = AVERAGE_DAYS * 24
# Rows without a time are one instant, before all others.
_NO_TIME = -(1 << 62)
# Of an instant or an hour: rows, amounts, sum of the finite ones, and a bit for each kind of the others.
Sums = tuple[int, int, float, int]
_NOTHING: Sums = (0, 0, 0.0, 0)
_NAN, _HIGH, _LOW = 1, 2, 4
_INFINITE = float("inf")
_POINT = "<qqqdB"
# Instants in a customer's own value before its hours move, and answered rows in one row of arrays.
_FEW = 4096
_PACK = 4096


def _packed(sums: Mapping[int, Sums]) -> bytes:
    return b"".join([struct.pack(_POINT, at, *sums[at]) for at in sorted(sums)])


def _unpacked(points: bytes) -> dict[int, Sums]:
    return {p[0]: p[1:] for p in struct.iter_unpack(_POINT, points)}


def _of_amount(amount: float, missing: bool) -> Sums:
    if missing:
        return 1, 0, 0.0, 0
    if -_INFINITE < amount < _INFINITE:
        return 1, 1, amount, 0
    return 1, 1, 0.0, _HIGH if amount > 0 else _LOW if amount < 0 else _NAN


def _plus(a: Sums, b: Sums) -> Sums:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2], a[3] | b[3]


def _average(sums: Sums) -> float | None:
    _, amounts, total, odd = sums
    if not amounts:
        return None
    if odd & _NAN or odd & _HIGH and odd & _LOW:
        return float("nan")
    return _INFINITE if odd & _HIGH else -_INFINITE if odd & _LOW else total / amounts


def _added(into: dict[int, Sums], sums: Mapping[int, Sums]) -> None:
    for at, more in sums.items():
        into[at] = _plus(into[at], more) if at in into else more


def _by_hour(points: Iterable[tuple[int, Sums]]) -> dict[int, dict[int, Sums]]:
    hours: dict[int, dict[int, Sums]] = {}
    for at, sums in points:
        hours.setdefault(at // _HOUR, {})[at] = sums
    return hours


def _whole(points: Mapping[int, Sums]) -> Sums:
    n, amounts, totals, odds = zip(*points.values())
    return sum(n), sum(amounts), sum(totals), _bits(odds)


def _bits(odds: Iterable[int]) -> int:
    found = 0
    for odd in odds:
        found |= odd
    return found


def look_back(
    wanted: Mapping[int, Iterable[int]], hours: Mapping[int, Sums], instants: Callable[[int], Mapping[int, Sums]]
) -> dict[int, tuple[int, float | None]]:
    """Rows of the shorter period and average of the longer one, both ends included, at the wanted instants by hour.

    A period is whole hours, the beginning of its last hour and the end of the
    one it begins in; amounts are only ever added, so a huge one leaves no trace
    in the periods after it.
    """
    known = sorted(hours)
    rows, amounts = (list(accumulate((hours[h][i] for h in known), initial=0)) for i in (0, 1))
    totals, odds = [hours[h][2] for h in known], [hours[h][3] for h in known]
    any_odd = any(odds)

    @cache
    def ends(hour: int) -> tuple[list[int], list[Sums]]:
        """Instants of an hour, and the sums from each to the hour's end."""
        points = instants(hour)
        places = sorted(points)
        since = list(accumulate((points[at] for at in reversed(places)), _plus, initial=_NOTHING))
        return places, since[::-1]

    def inside(hour: int, length: int) -> Sums:
        first, last = bisect_left(known, hour - length + 1), bisect_left(known, hour)
        return rows[last] - rows[first], amounts[last] - amounts[first], sum(totals[first:last]), _bits(odds[first:last]) if any_odd else 0

    found = {}
    for hour, places in wanted.items():
        points, upto, so_far = instants(hour), {}, _NOTHING
        for at in sorted(points):
            upto[at] = so_far = _plus(so_far, points[at])
        periods = [(length * _HOUR, inside(hour, length), *ends(hour - length)) for length in (ACTIVITY_HOURS, _LONGEST)]
        for at in places:
            day, month = [_plus(_plus(whole, upto[at]), since[bisect_left(begin, at - span)]) for span, whole, begin, since in periods]
            found[at] = day[0], _average(month)
    return found


class LookBack(StatefulProcessor):
    """Adds the two look-back columns; ``columns`` are those of the output rows, given as arrays."""

    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.own = handle.getValueState("own", "points binary, hours binary, newest long, timer long")
        self.moved = handle.getMapState("moved", "hour long", "points binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rows = list(rows)
        columns = dict(zip(rows[0].__fields__, zip(*rows)))
        del rows
        times = [_NO_TIME if at is None else at for at in columns["micros"]]
        fresh: dict[int, Sums] = {}
        for at, amount, missing in zip(times, columns["amount"], columns["no_amount"]):
            sums = _of_amount(amount, missing)
            fresh[at] = _plus(fresh[at], sums) if at in fresh else sums
        wanted = _by_hour(fresh.items())
        points, moved, newest, timer = self.own.get() or (b"", b"", _NO_TIME, _NO_TIME)
        # The batch's rows go into the state first: a row counts those of its batch that are not later.
        points, moved = _by_hour(_unpacked(points).items()), _unpacked(moved)
        cut = self._put(points, moved, wanted)

        def instants(hour: int) -> dict[int, Sums]:
            if hour in moved and hour not in cut:
                cut[hour] = self._hour(hour)
            return points.get(hour) or cut.get(hour) or {}

        found = look_back(wanted, moved | {hour: _whole(p) for hour, p in points.items()}, instants)
        self._keep(points, moved, max(newest, *fresh), timer, timerValues.getCurrentWatermarkInMs() * 1000)
        columns["activity"], columns["average"] = zip(*[found[at] for at in times])
        names = [*self.columns, "activity", "average"]
        packed = Row(*names)
        return (packed(*[list(columns[c][i : i + _PACK]) for c in names]) for i in range(0, len(times), _PACK))

    def _put(self, points: dict[int, dict[int, Sums]], moved: dict[int, Sums], fresh: Mapping[int, dict[int, Sums]]) -> dict[int, dict[int, Sums]]:
        """Put the fresh points into the customer's value or its moved hours; returns the moved hours written."""
        cut = {}
        for hour, more in fresh.items():
            if hour in moved:
                cut[hour] = self._hour(hour)
                _added(cut[hour], more)
            else:
                _added(points.setdefault(hour, {}), more)
        if sum(map(len, points.values())) > _FEW:
            cut |= points
            points.clear()
        for hour, all_points in cut.items():
            self.moved.updateValue((hour,), (_packed(all_points),))
            moved[hour] = _whole(all_points)
        return cut

    def _hour(self, hour: int) -> dict[int, Sums]:
        return _unpacked(self.moved.getValue((hour,))[0])

    def _keep(self, points: Mapping[int, dict[int, Sums]], moved: Mapping[int, Sums], newest: int, timer: int, watermark: int) -> None:
        # The next row of the customer is at the watermark or later.
        oldest = watermark // _HOUR - _LONGEST
        for hour in moved:
            if hour < oldest:
                self.moved.removeKey((hour,))
        if timer == _NO_TIME:
            timer = _due(newest, watermark)
            self.handle.registerTimer(timer)
        own = {at: sums for hour, inside in points.items() if hour >= oldest for at, sums in inside.items()}
        self.own.update((_packed(own), _packed({h: s for h, s in moved.items() if h >= oldest}), newest, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        points, moved, newest, _ = self.own.get() or (b"", b"", _NO_TIME, _NO_TIME)
        timer = _due(newest, 0)
        if timer > watermark:
            # Rows came after the timer was set.
            self.handle.registerTimer(timer)
            self.own.update((points, moved, newest, timer))
        else:
            self.own.clear()
            self.moved.clear()
        return iter([])

    def close(self) -> None:
        pass


def _due(newest: int, watermark: int) -> int:
    """Milliseconds at which no row of the customer's state can count any more."""
    return max(newest, watermark) // 1000 + (_LONGEST + 1) * _HOUR // 1000


def velocity_stream(
    rows: DataFrame, *, customer: str = "customer_id", lateness: str = "1 hour", contract: Contract = DEFAULT_CONTRACT
) -> DataFrame:
    """The stream with ``transactions_last_24h`` and ``avg_amount_last_30d``, the row itself included.

    A row is answered in the micro-batch in which it arrives, from what has
    arrived by then, rows of its own micro-batch included. Rows that come in
    order of time, in micro-batches of any size, get what
    ``velocity.velocity_features`` gives; one that comes late by up to
    ``lateness`` gets its own figures right and does not change those of rows
    answered before. Later ones are left out by the watermark, which counts
    them. Rows without a customer are one customer. The session must keep its
    state in RocksDB (``PROVIDER``).
    """
    amount = F.col(contract.amount).cast("double")
    # Rows go through under plain names, so that theirs may be any.
    carried = [f"c{i}" for i in range(len(rows.columns))]
    micros = micros_of(rows, contract.time)
    prepared = rows.select(
        *[F.col(f"`{name}`").alias(c) for name, c in zip(rows.columns, carried)],
        F.col(customer).alias("customer"), micros.alias("micros"), F.timestamp_micros(micros).alias("event"),
        F.coalesce(amount, F.lit(0.0)).alias("amount"), amount.isNull().alias("no_amount"),
    ).withWatermark("event", lateness)
    found = [*[(c, f.dataType) for c, f in zip(carried, rows.schema)], ("activity", T.IntegerType()), ("average", T.DoubleType())]
    out = T.StructType([T.StructField(c, T.ArrayType(kind)) for c, kind in found])
    packed = prepared.groupBy("customer").transformWithState(LookBack(carried), out, "Append", "EventTime")
    answered = packed.select(F.explode(F.arrays_zip(*[c for c, _ in found])).alias("row")).select("row.*")
    return answered.select(
        *[F.col(c).alias(name) for c, name in zip(carried, rows.columns)],
        F.col("activity").alias("transactions_last_24h"), F.col("average").alias("avg_amount_last_30d"),
    )
