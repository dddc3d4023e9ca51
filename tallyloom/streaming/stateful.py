"""Keyed stream state: the walk over a store's pages, and a watchdog of stores that fall silent.

Each key has its own entries in the state store, changed where rows or timers of that key are, so a batch costs as much as
it brings, not as the state is large. Timers fire as the watermark or the clock goes on, also where no row comes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import catalog as C
from ..operators.reconcile import END_STATUSES

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: New ids of a domain that a worker remembers before they are put into the state store.
MOST_FRESH = 100_000

PAGE_EVENTS = "domain string, kind string, product_id string, page int, reason string, complete boolean, products long"


class PageWalk(StatefulProcessor):
    """The state of a domain: pages that came before those in front of them, with what they list and why they end the walk, if
    they do; the next page due; ids seen, an entry each; and whether the walk has ended. Ids of the rows at hand go to the
    store when these are through, or when there are many: most walks end with the rows that began them, and leave none."""

    def __init__(self, cap: int, idle_ms: int) -> None:
        self.cap, self.idle_ms = cap, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.walk = handle.getValueState("walk", "due int, last int, products long, ended boolean, timer long")
        self.ahead = handle.getMapState("ahead", "page int", "stop string, ids array<string>")
        self.ids = handle.getMapState("ids", "id string", "page int")

    def _rows(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=[x.split()[0] for x in PAGE_EVENTS.split(", ")]).astype({"page": "Int32", "complete": "boolean", "products": "Int64"})

    def _take(self, domain: str, page: int, ids: list[str], fresh: dict[str, int], stored: bool) -> list[tuple]:
        """A page's turn: its ids that were not seen before, neither in fresh nor, where there are any, in the store."""
        new = [i for i in dict.fromkeys(ids) if i not in fresh and not (stored and self.ids.containsKey((i,)))]
        fresh.update(dict.fromkeys(new, page))
        return [(domain, "id", i, page, None, None, None) for i in new]

    def _store(self, fresh: dict[str, int]) -> bool:
        for i, page in fresh.items():
            self.ids.updateValue((i,), (page,))
        fresh.clear()
        return True

    def _end(self, domain: str, page: int, reason: str, products: int) -> list[tuple]:
        """The walk is over; all that is remembered from now on is that it is."""
        self.ahead.clear()
        self.ids.clear()
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.walk.update((page, page, products, True, 0))
        return [(domain, "end", None, page, reason, reason in ("empty", "end of catalog"), products)]

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        stored, fresh = self.walk.exists(), {}
        due, last, products, ended, timer = self.walk.get() if stored else (1, 0, 0, False, 0)
        latest = 0
        for batch in rows:
            if ended:  # a page behind the end changes nothing
                continue
            for page, stop, ids, at in zip(batch["page"], batch["stop"], batch["ids"], batch["at_ms"], strict=True):
                latest, last = max(latest, int(at)), max(last, int(page))
                if page >= due and not self.ahead.containsKey((int(page),)):  # of a page that comes again the first counts
                    self.ahead.updateValue((int(page),), (stop or "", list(ids) if ids is not None else []))
        if ended:
            return
        while self.ahead.containsKey((due,)):
            stop, ids = self.ahead.getValue((due,))
            new = [] if stop else self._take(key[0], due, ids, fresh, stored)
            products += len(new)
            stored = self._store(fresh) if len(fresh) > MOST_FRESH else stored
            if stop or due >= self.cap:
                new += self._end(key[0], due, stop or "cap", products)
            else:
                self.ahead.removeKey((due,))
            if new:
                yield self._rows(new)
            if stop or due >= self.cap:
                return
            due += 1
        self._store(fresh)
        if latest + self.idle_ms > timer:
            if timer:
                self.handle.deleteTimer(timer)
            timer = latest + self.idle_ms
            self.handle.registerTimer(timer)
        self.walk.update((due, last, products, False, timer))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        """Nothing came for a while: what lies behind gaps is taken too, up to its earliest stop, else to the last page."""
        due, last, products, ended, _ = self.walk.get()
        if ended:
            return
        pages, stored, fresh = sorted((k[0], v[0], v[1]) for k, v in self.ahead.iterator()), True, {}
        page, reason = last, "cap" if last >= self.cap else "budget"
        for at, stop, ids in pages:
            if stop or at > self.cap:
                page, reason = at, stop or "cap"
                break
            new = self._take(key[0], at, ids, fresh, stored)
            products += len(new)
            stored = self._store(fresh) if len(fresh) > MOST_FRESH else stored
            if new:
                yield self._rows(new)
        yield self._rows(self._end(key[0], page, reason, products))

    def close(self) -> None:
        pass


def walked_pages(pages: DataFrame, watermark: str = "1 hour", idle_seconds: int = 600, cap: int = 100, excluded: Column | None = None) -> DataFrame:
    """domain, kind, product_id, page, reason, complete, products: a stream of what pages (landed, domain, page,
    http_status, body) say, in any order. kind id: a listed product, once each, but for those that `excluded` (of a
    product p) names; kind end: the walk over the domain's pages is over, once. It ends at the first page, with all pages before it
    there, that is failed (an error on page 1), an error, the end of catalog (400, 404, 410 behind page 1), without the key or
    empty; at page `cap`; or when idle_seconds pass in the pages' own time without a page: then the earliest stop that
    is there decides, else cap or budget. Pages behind the end are ignored. complete: empty or end of catalog.

    Rows without a domain or page are left out.
    """
    own = C.parse_pages(pages.where("domain IS NOT NULL AND page IS NOT NULL")).withWatermark("landed", watermark)
    error, first = F.col("http_status") >= 400, F.col("page") <= 1
    stop = F.when(error & first, "failed").when(error & F.col("http_status").isin(*END_STATUSES), "end of catalog").when(error, "error").when(F.col("products").isNull(), "missing key").when(F.size("products") == 0, "empty")
    listed = F.filter("products", lambda p: p["id"].isNotNull() & ~p["id"].isin("", "0") & (F.lit(True) if excluded is None else ~F.coalesce(excluded(p), F.lit(False))))
    ids = F.when(~F.coalesce(error, F.lit(False)), F.transform(listed, lambda p: p["id"]))
    rows = own.select("landed", "domain", F.col("page").cast("int").alias("page"), stop.alias("stop"), ids.alias("ids"), F.unix_millis(F.col("landed").cast("timestamp")).alias("at_ms"))
    return rows.groupBy("domain").transformWithStateInPandas(PageWalk(cap, idle_seconds * 1000), PAGE_EVENTS, "append", "eventTime")


VERDICTS = "store string, start_ms long, at_ms long, verdict string, beats long"


class Watchdog(StatefulProcessor):
    """The state of a store: beats that the time has not reached (in event time), and the open session."""

    def __init__(self, idle_ms: int, hard_ms: int, terminal: tuple[str, ...], event_time: bool) -> None:
        self.idle_ms, self.hard_ms, self.terminal, self.event_time = idle_ms, hard_ms, terminal, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "start long, last long, beats long, verdict boolean")
        self.waiting = handle.getMapState("waiting", "at long", "beats long, final boolean")

    def _step(self, store: str, at: int, n: int, final: bool, out: list) -> None:
        """Time goes on to `at`; with n beats at that time."""
        session = self.open.get() if self.open.exists() else None
        if session:
            start, last, beats, told = session
            over, silent = start + self.hard_ms, last + self.idle_ms
            if not told and over < silent and at > over:
                out.append((store, start, over, "over limit", beats))
                told = True
            if at >= silent:
                if not told:
                    out.append((store, start, silent, "stalled", beats))
                session = None
                self.open.clear()
            else:
                session = (start, last, beats, told)
        if n:
            start, _, beats, told = session or (at, at, 0, False)
            if final and not told:
                out.append((store, start, at, "finished", beats + n))
                told = True
            session = (start, at, beats + n, told)
        if session:
            self.open.update(session)

    def _advance(self, store: str, now: int) -> pd.DataFrame:
        """Beats up to now in order, then now itself; the next timer is that of what is due first."""
        out: list = []
        due = sorted((k[0], v[0], v[1]) for k, v in self.waiting.iterator() if k[0] <= now)
        for at, n, final in due:
            self._step(store, at, n, final, out)
            self.waiting.removeKey((at,))
        self._step(store, now, 0, False, out)
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        times = [k[0] for k, _ in self.waiting.iterator()]
        if self.open.exists():
            start, last, _, told = self.open.get()
            times.append(min(last + self.idle_ms, last + self.idle_ms if told else start + self.hard_ms + 1))
        if times:
            self.handle.registerTimer(max(min(times), now + 1))
        return pd.DataFrame(out, columns=[x.split()[0] for x in VERDICTS.split(", ")])

    def _now(self, timers: Any) -> int:
        return int(timers.getCurrentWatermarkInMs() if self.event_time else timers.getCurrentProcessingTimeInMs())

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        now = self._now(timerValues)
        for batch in rows:
            for at, kind in zip(batch["at_ms"], batch["kind"], strict=True):
                at = (int(at) if self.event_time else now,)
                n, final = self.waiting.getValue(at) if self.waiting.containsKey(at) else (0, False)
                self.waiting.updateValue(at, (n + 1, bool(final or kind in self.terminal)))
        yield self._advance(key[0], now)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        yield self._advance(key[0], self._now(timerValues))

    def close(self) -> None:
        pass


def watchdog(beats: DataFrame, idle_seconds: int = 600, hard_seconds: int = 7200, terminal: tuple[str, ...] = (), watermark: str | None = None) -> DataFrame:
    """store, start_ms, at_ms, verdict, beats: a stream of one verdict for each session of a store's heartbeats (ts, store,
    kind), at the time it is due and with the beats till then. A session is a run of beats without a gap of idle_seconds.

    finished: its first beat of a terminal kind; over limit: hard_seconds after its start it goes on without one;
    stalled: idle_seconds after its last beat, if none of these came before. With a watermark time is that of the
    beats, which may come in any order within it, and a beat that comes later is left out; without one it is the
    clock's, and a beat counts when it comes: then a store that falls silent is told of while the stream runs, though no
    row arrives. Beats without a store or time are left out.
    """
    rows = beats.where("store IS NOT NULL AND ts IS NOT NULL").select(F.col("store").cast("string").alias("store"), "ts", F.unix_millis(F.col("ts").cast("timestamp")).alias("at_ms"), "kind")
    rows = rows.withWatermark("ts", watermark) if watermark else rows
    processor = Watchdog(idle_seconds * 1000, hard_seconds * 1000, terminal, watermark is not None)
    return rows.groupBy("store").transformWithStateInPandas(processor, VERDICTS, "append", "eventTime" if watermark else "processingTime")


def with_state_store(spark, memory_mb: int = 256) -> None:
    """Processors keep several states a key, which takes the state store on RocksDB. All stores of an executor share
    memory_mb outside the heap, however many partitions and states there are; the rest is on its disk."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", str(memory_mb))
