"""Stateful operators that take the rows of a key in event time, whatever order they arrive in.

Rows wait in list state until the watermark has reached them; timers in event time take them out, oldest first. What
comes before them is a small value in state (rings of the last bars, running sums), never the rows themselves, so no
batch reads a day again. State of a key goes when nothing waits and its day is over.
"""

from __future__ import annotations

import math
import pickle
import sys
from collections.abc import Iterator
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tideline import config
from tideline.config import IntradayConfig
from tideline.functions.scalars import with_labels
from tideline.functions.time import market_time, minute_of_day, session_of

#: Day's end in event time: 36 hours after the start of a date, when it is over in any time zone west of UTC, too.
DAY_MS, DAY_END_MS = 86_400_000, 129_600_000


class InOrder(StatefulProcessor):
    """Rows (ms, ...) of a key, in order, to step(state, rows, now), which changes the state and returns output rows.

    A null key (a heartbeat, which only moves the watermark) is passed over. `waits` is the DDL of the waiting rows, ms
    first; `gives` the names of the output columns. state is a dict; its item "wake" (ms, or None) asks for a timer, and a
    state without items is removed.
    """

    waits, gives = "", ()

    def step(self, state: dict[str, Any], rows: list[tuple], now: int) -> list[tuple]:
        raise NotImplementedError

    def init(self, handle: Any) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.waits)
        self.kept = handle.getValueState("kept", "payload binary")
        self.names = [c.split()[0] for c in self.waits.split(",")]

    def handleInputRows(self, key: Any, rows: Iterator, timerValues: Any) -> Iterator:
        new = [x for frame in rows for x in zip(*(frame[c].tolist() for c in self.names))]
        if key[0] is not None and new:
            self.waiting.appendList([tuple(None if isinstance(v, float) and math.isnan(v) else v for v in x) for x in new])
            # The rows are due when the watermark gets here; one timer will do, as it sets the next.
            self.handle.registerTimer(max(min(x[0] for x in new), timerValues.getCurrentWatermarkInMs() + 1))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator:
        import pandas as pd

        now = timerValues.getCurrentWatermarkInMs()
        every = sorted(self.waiting.get(), key=lambda x: tuple((v is not None, v) for v in x)) if self.waiting.exists() else []
        due, rest = [x for x in every if x[0] <= now], [x for x in every if x[0] > now]
        state = pickle.loads(self.kept.get()[0]) if self.kept.exists() else {}
        out = self.step(state, due, now)
        if due:
            self.waiting.put(rest) if rest else self.waiting.clear()
        wake = state.pop("wake", None)
        if state:
            self.kept.update((pickle.dumps(state),))
        elif self.kept.exists():
            self.kept.clear()
        for at in {rest[0][0] if rest else None, wake} - {None}:
            self.handle.registerTimer(max(at, now + 1))
        if out:
            yield pd.DataFrame([(*key, *x) for x in out], columns=list(self.gives))

    def close(self) -> None:
        pass


class Cooldown(InOrder):
    """Events at least `seconds` after the last accepted one of their key and day; all of an accepted second stay."""

    waits, gives = "ms long, second long, day int, us long", ("symbol", "event_type", "us")

    def __init__(self, seconds: int):
        self.seconds = seconds

    def step(self, state: dict[str, Any], rows: list[tuple], now: int) -> list[tuple]:
        out = []
        for _, second, day, us in rows:
            last = state.get(day)
            if last is None or second == last or second - last >= self.seconds:
                state.clear()  # rows come in order: the days before are over
                state[day] = second
                out.append((us,))
        over = [day for day in state if day * DAY_MS + DAY_END_MS <= now]
        for day in over:
            del state[day]
        if state:
            state["wake"] = max(state) * DAY_MS + DAY_END_MS
        return out


def _ratio(a: float | None, b: float | None) -> float | None:
    return None if a is None or b is None or b == 0 else a / b


def _median(xs: list[float]) -> float | None:
    xs = sorted(x for x in xs if x is not None)
    if not xs:
        return None
    middle = (len(xs) - 1) / 2
    low, high = xs[math.floor(middle)], xs[math.ceil(middle)]
    return low if low == high else (high + low) * 0.5 if middle % 1 else low


def _least(test: str, a: float | None, b: float) -> bool:
    return a is not None and (a >= b if test == ">=" else a <= b)


class LiveDetectors(InOrder):
    """The intraday detectors, bar by bar: the same events as operators.detectors.intraday_events finds in all bars.

    State holds the last bars that the frames reach back to, running sums of the VWAP, the day's high and opening range,
    the hits of a day that doesn't yet have cfg.min_bars bars, and the best hit of each open bucket. A hit comes out once
    its bucket is over; with best=False every hit comes out with its bar.
    """

    waits = "ms long, us long, day int, session string, minute int, open double, high double, low double, close double, volume double, transactions double"
    gives = ("symbol", "us", "day", "event_type", "direction", "session", "open", "high", "low", "close", "volume", "spike_x", "range_pct", "volume_x", "vwap_dist_pct", "score")

    def __init__(self, cfg: IntradayConfig, best: bool = True):
        self.best = best
        if cfg.compat or cfg.cooldown_minutes or cfg.max_per_symbol_day:
            raise ValueError("live detectors follow the intended rules; cooldown and caps are operators of their own")
        self.cfg = cfg
        self.depth = max(21, cfg.spike_window, cfg.base_window + 1, 2 * cfg.momentum_window + 1, cfg.flush_red_bars, cfg.flush_window, cfg.bearish_red_bars, cfg.vwap_up_bars, cfg.vwap_down_bars, cfg.failed_reclaim_bars)

    def step(self, state: dict[str, Any], rows: list[tuple], now: int) -> list[tuple]:
        out: list[tuple] = []
        for row in rows:
            if state.get("day") != row[2]:
                self._end(state)
                state.update(day=row[2], bars=[], n=0, money=0.0, volume=0.0, on=False, top=None, or_high=None, or_low=None, held=[], open=state.get("open", {}))
            hits = self._bar(state, row)
            state["n"] += 1
            if state["n"] >= self.cfg.min_bars:
                for hit in [*state["held"], *hits]:
                    self._compete(state, hit, out) if self.best else out.append(hit)
                state["held"] = []
            else:
                state["held"] += hits
        if "day" in state:
            if state["day"] * DAY_MS + DAY_END_MS <= now:
                self._end(state)
            self._close(state, now, out)
            ends = [b for b, _ in state["open"].values()]
            wakes = [*([] if state["held"] else ((b + 1) * self.cfg.dedup_minutes * 60_000 for b in ends)), *([state["day"] * DAY_MS + DAY_END_MS] if state["bars"] is not None else [])]
            if wakes:
                state["wake"] = min(wakes)
            else:
                state.clear()
        return out

    def _end(self, state: dict[str, Any]) -> None:
        """The day is over: hits of a day with too few bars go."""
        state.update(held=[], bars=None)

    def _close(self, state: dict[str, Any], now: int, out: list[tuple]) -> None:
        if not state["held"]:  # held hits may yet belong to an open bucket
            width = self.cfg.dedup_minutes * 60_000
            for kind in sorted(k for k, (b, _) in state["open"].items() if (b + 1) * width <= now):
                out.append(state["open"].pop(kind)[1])

    def _compete(self, state: dict[str, Any], hit: tuple, out: list[tuple]) -> None:
        """Keeps the bucket's best: the highest score, then the earliest, then up before down."""
        kind, bucket = hit[2], hit[0] // (self.cfg.dedup_minutes * 60_000_000)
        known = state["open"].get(kind)
        if known is None or known[0] != bucket:
            if known:
                out.append(known[1])
            state["open"][kind] = (bucket, hit)
        elif (-hit[-1], hit[0], hit[3] == "down") < (-known[1][-1], known[1][0], known[1][3] == "down"):
            state["open"][kind] = (bucket, hit)

    def _bar(self, s: dict[str, Any], row: tuple) -> list[tuple]:
        """The hits of one bar; s takes the bar up."""
        cfg = self.cfg
        _, us, day, session, minute, o, h, low, c, v, trades = row
        bar = {"o": o, "h": h, "l": low, "c": c, "v": v, "n": trades}
        past = s["bars"]
        bars = [*past, bar][-self.depth :]
        last = lambda n, k: [x for b in bars[-n:] if (x := b[k]) is not None]
        s["on"] = s["on"] or session == "RTH" or cfg.vwap_reference != "RTH"
        typical = None if None in (h, low, c) else (h + low + c) / 3
        if s["on"]:
            s["money"] += typical * v if typical is not None and v is not None else 0.0
            s["volume"] += v or 0.0
        vwap = bar["w"] = _ratio(s["money"], s["volume"]) if s["on"] else None
        base = _median([b["v"] for b in bars[-cfg.spike_window :]]) if cfg.spike_method == "median" else _mean(last(cfg.spike_window, "v"))
        spike, volume_x = _ratio(v, base), _ratio(v, _mean(last(20, "v")))
        span = _ratio(None if None in (h, low) else h - low, o)
        range_pct, dollars = None if span is None else span * 100, None if None in (c, v) else c * v
        off = _ratio(None if None in (c, vwap) else c - vwap, vwap)
        off = None if off is None else off * 100
        before = bars[-1 - cfg.momentum_window]["c"] if len(bars) > cfg.momentum_window else None
        ret = _ratio(c, before)
        ret = bar["r"] = None if ret is None else (ret - 1) * 100
        high20, low20 = max((b["h"] for b in past[-20:] if b["h"] is not None), default=None), min((b["l"] for b in past[-20:] if b["l"] is not None), default=None)
        bar["bh"], bar["bl"] = max(last(cfg.base_window, "h"), default=None), min(last(cfg.base_window, "l"), default=None)
        usual = _median([None if None in (b["h"], b["l"]) else b["h"] - b["l"] for b in bars[-cfg.base_window :]])
        width = _ratio(None if bar["bh"] is None or bar["bl"] is None else bar["bh"] - bar["bl"], o)
        bar["calm"] = width is not None and usual is not None and width * 100 <= cfg.base_range_multiple * usual * 100
        prior = past[-1] if past else {"calm": False, "bh": None, "bl": None}
        in_or = 570 <= minute <= 570 + cfg.or_minutes - 1
        if in_or:
            s["or_high"] = max(x for x in (s["or_high"], h, -math.inf) if x is not None)
            s["or_low"] = min(x for x in (s["or_low"], low, math.inf) if x is not None)
        s["top"] = h if s["top"] is None else s["top"] if h is None else max(s["top"], h)
        top = max(last(cfg.flush_window, "h"), default=None) if cfg.flush_window else s["top"]
        drop = _ratio(None if None in (top, c) else top - c, top)
        drop = None if drop is None else drop * 100
        red = [None not in (b["c"], b["o"]) and b["c"] < b["o"] for b in bars]
        held = lambda n, test: len(bars) >= n and all(map(test, bars[-n:]))
        over = lambda b: None not in (b["c"], b["w"]) and b["c"] > b["w"]
        under = lambda b: None not in (b["c"], b["w"]) and b["c"] < b["w"]
        s["bars"] = bars
        if None in (c, o):
            up = down = False
        else:
            up, down = c > o, c <= o
        rth, far = session == "RTH", lambda a, b: _ratio(None if None in (a, b) else a - b, b)
        spiked = _least(">=", spike, cfg.rth_spike if rth else cfg.ext_spike) and _least(">=", v, cfg.rth_volume if rth else cfg.ext_volume) and _least(">=", dollars, cfg.rth_dollar_volume if rth else cfg.ext_dollar_volume) and _least(">=", range_pct, cfg.min_range_pct)
        bearish = not cfg.bearish_red_bars or (len(red) >= cfg.bearish_red_bars and all(red[-cfg.bearish_red_bars :]) and _least(">=", drop, cfg.bearish_drop_pct))
        above, below = cfg.vwap_up_bars <= 1 or held(cfg.vwap_up_bars, over), cfg.vwap_down_bars <= 1 or held(cfg.vwap_down_bars, under)
        if cfg.failed_reclaim_bars:
            below = below and any(under(b) and b["h"] is not None and b["h"] >= b["w"] for b in bars[-cfg.failed_reclaim_bars :])
        faster = True
        if cfg.min_acceleration:
            then = bars[-1 - cfg.momentum_window].get("r") if len(bars) > cfg.momentum_window else None
            faster = _least(">=", _ratio(None if ret is None else abs(ret), None if then is None else abs(then)), cfg.min_acceleration)
        moved = _least(">=", volume_x, cfg.momentum_volume)
        broke = not in_or and 570 + cfg.or_minutes <= minute < 960 and _least(">=", volume_x, cfg.or_volume) and s["or_high"] is not None
        calm = prior["calm"] and _least(">=", volume_x, cfg.base_volume)
        pct = lambda x: None if x is None else x * 100
        found = [
            ("volume_spike", "up", spiked and up),
            ("volume_spike", "down", spiked and down and bearish),
            ("vwap_break", "up", _least(">=", off, cfg.vwap_up_pct) and _least(">=", volume_x, cfg.vwap_up_volume) and above),
            ("vwap_break", "down", _least("<=", off, -cfg.vwap_down_pct) and _least(">=", volume_x, cfg.vwap_down_volume) and below),
            ("price_momentum", "up", _least(">=", ret, cfg.momentum_up_pct) and moved and None not in (c, high20) and c > high20),
            ("price_momentum", "down", _least("<=", ret, -cfg.momentum_down_pct) and moved and None not in (c, low20) and c < low20 and faster),
            ("consolidation_break", "up", calm and _least(">=", pct(far(c, prior["bh"])), cfg.base_break_pct)),
            ("consolidation_break", "down", calm and prior["bl"] is not None and c is not None and _least(">=", pct(_ratio(prior["bl"] - c, prior["bl"])), cfg.base_break_pct)),
            ("opening_range_break", "up", broke and _least(">=", pct(far(c, s["or_high"])), cfg.or_break_pct)),
            ("opening_range_break", "down", broke and c is not None and _least(">=", pct(_ratio(s["or_low"] - c, s["or_low"])), cfg.or_break_pct)),
            ("flush", "down", _least(">=", drop, cfg.flush_drop_pct) and _least(">=", volume_x, cfg.flush_volume) and sum(red[-cfg.flush_red_bars :]) >= cfg.flush_red_bars),
        ]
        if cfg.tape_transactions:
            speed = _ratio(trades, _median([b["n"] for b in bars[-cfg.spike_window :]]))
            fast = _least(">=", trades, cfg.tape_transactions) and _least(">=", speed, cfg.tape_spike)
            found += [("tape_speed", "up", fast and up), ("tape_speed", "down", fast and down)]
        score = 0.3 * (1.0 if spike is None else spike) + 0.25 * (range_pct or 0.0) + 0.2
        if cfg.full_score:
            ups = [None not in (b["c"], b["o"]) and b["c"] > b["o"] for b in bars[-3:]]
            score += 0.15 * (sum(ups) if up else len(ups) - sum(ups)) + 0.1 * abs(off or 0.0)
        return [(us, day, kind, way, session, o, h, low, c, v, spike, range_pct, volume_x, off, score) for kind, way, hit in found if hit]


def _mean(xs: list[float]) -> float | None:
    return sum(xs) / len(xs) if xs else None


def _run(keyed: DataFrame, keys: list[str], processor: InOrder, schema: str) -> DataFrame:
    """The processor travels by value: Spark also starts it in a worker beside the driver, which doesn't get the files sent to executors."""
    modules = (sys.modules[__name__], config)
    for m in modules:
        cloudpickle.register_pickle_by_value(m)
    try:
        return keyed.groupBy(*keys).transformWithStateInPandas(processor, schema, "Append", "EventTime")
    finally:
        for m in modules:
            cloudpickle.unregister_pickle_by_value(m)


def live_events(bars: DataFrame, cfg: IntradayConfig = IntradayConfig(), late: str = "5 minutes", best: bool = True) -> DataFrame:
    """Events of a stream of bars (symbol, timestamp, date, open, high, low, close, volume; transactions with the tape option):
    those that intraday_events finds in all bars, each once its bucket is over and the watermark has passed it.

    Bars may come in any order within `late`. A symbol's state is its last bars and sums, whatever the length of the day.
    best=False: all hits, as `detected` has them, each as soon as the watermark has reached its bar (and the day has cfg.min_bars bars).
    """
    clock = market_time(F.col("timestamp"))
    number = lambda c: (F.col(c) if c in bars.columns else F.lit(None)).cast("double").alias(c)
    rows = bars.withWatermark("timestamp", late).select(
        "symbol", "timestamp", F.unix_millis("timestamp").alias("ms"), F.unix_micros("timestamp").alias("us"), F.unix_date("date").alias("day"), session_of(clock, "CLOSED").alias("session"), minute_of_day(clock).cast("int").alias("minute"),
        *[number(c) for c in ("open", "high", "low", "close", "volume", "transactions")],
    )
    schema = "symbol string, us long, day int, event_type string, direction string, session string, open double, high double, low double, close double, volume double, spike_x double, range_pct double, volume_x double, vwap_dist_pct double, score double"
    out = _run(rows, ["symbol"], LiveDetectors(cfg, best), schema)
    out = out.withColumn("timestamp", F.timestamp_micros("us")).withColumn("date", F.date_from_unix_date("day")).withColumn("volume", F.col("volume").cast("long")).drop("us", "day")
    return with_labels(out)


def cooldown(events: DataFrame, minutes: int, late: str = "1 hour") -> DataFrame:
    """Events (symbol, event_type, timestamp) at least `minutes` after the last accepted one of their symbol, day and type, as
    `with_cooldown` has them, also where they come in other batches and in another order, within `late`.

    Times count in whole seconds, and all events of an accepted second stay. State holds what the watermark hasn't reached
    and one time per key, which goes when the day is over.
    """
    columns = ["symbol", "event_type", "timestamp", F.unix_millis("timestamp").alias("ms"), F.unix_timestamp("timestamp").alias("second"), F.unix_date(F.to_date("timestamp")).alias("day"), F.unix_micros("timestamp").alias("us")]
    rows = events.withWatermark("timestamp", late).select(*columns)
    out = _run(rows, ["symbol", "event_type"], Cooldown(60 * minutes), "symbol string, event_type string, us long")
    return out.select("symbol", "event_type", F.timestamp_micros("us").alias("timestamp"))
