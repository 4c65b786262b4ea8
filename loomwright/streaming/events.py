"""An event store that grows by micro-batches: each article joins an event or opens one, in order of time within its market."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from loomwright.operators.decisions import MARGIN, MERGE_SIMILARITY

#: Days between an article and an event's last one, the least similarity of a candidate, and how many candidates count.
GAP, LEAST, CANDIDATES = 7.0, 0.55, 3
DAY = 86_400.0
#: Takes an article's fields, the two best similarities (the second may be None) and whether a token is shared.
Decide = Callable[[dict, float, float | None, bool], bool]
OUT = "market string, id long, ts timestamp, decision string, event_id long, similarity double, second double"


def by_similarity(article: dict, best: float, second: float | None, token: bool) -> bool:
    """Merge if a token is shared or the best candidate is like enough and no other one is as near."""
    return token or (best >= MERGE_SIMILARITY and (second is None or best - second >= MARGIN))


@dataclass
class Event:
    """What is kept of an event: its first article's id, the sum of its articles' vectors, its tokens, when it was last seen."""

    id: int
    total: np.ndarray
    last: float
    tokens: set[str] = field(default_factory=set)

    @property
    def direction(self) -> np.ndarray:
        norm = float(np.linalg.norm(self.total))
        return self.total / norm if norm else self.total

    def add(self, article: dict, at: float) -> None:
        self.total = self.total + np.asarray(article["vector"], dtype=float)
        self.last = max(self.last, at)
        if article["token"]:
            self.tokens.add(article["token"])


def seconds(ts: pd.Timestamp) -> float:
    return pd.Timestamp(ts).timestamp()


def assign(events: dict[int, Event], article: dict, keep: float, decide: Decide) -> tuple:
    """(decision, event_id, similarity, second) of one article; events take it in.

    Candidates were last seen within GAP days and are LEAST alike, or share the article's token and were last seen within keep days.
    """
    at, vector = seconds(article["ts"]), np.asarray(article["vector"], dtype=float)
    found = []
    for event in events.values():
        token = bool(article["token"]) and article["token"] in event.tokens
        age = abs(at - event.last) / DAY
        if age > keep or (age > GAP and not token):
            continue
        similarity = float(event.direction @ vector)
        if token or similarity >= LEAST:
            found.append((similarity, event, token))
    found.sort(key=lambda x: (-x[0], x[1].id))
    found = found[:CANDIDATES]
    second = found[1][0] if len(found) > 1 else None
    if found and decide(article, found[0][0], second, found[0][2]):
        found[0][1].add(article, at)
        return "merged", found[0][1].id, found[0][0], second
    event = Event(article["id"], np.zeros(len(vector)), at)
    event.add(article, at)
    events[event.id] = event
    return "new_event", event.id, found[0][0] if found else None, second


class EventStore(StatefulProcessor):
    """The events of one market: a map by id in the state store. Timers retire events that no article can join any more."""

    def __init__(self, keep: float, decide: Decide) -> None:
        self.keep, self.decide = keep, decide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getMapState("events", "id long", "last double, tokens array<string>, total array<double>")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        batch = pd.concat(list(rows)).sort_values(["ts", "id"], kind="stable")
        events = {k[0]: Event(k[0], np.array(total), last, set(tokens)) for k, (last, tokens, total) in self.events.iterator()}
        out, touched = [], set()
        for article in batch.to_dict("records"):
            decision, event_id, similarity, second = assign(events, article, self.keep, self.decide)
            touched.add(event_id)
            out.append((key[0], article["id"], article["ts"], decision, event_id, similarity, second))
        for event_id in touched:
            e = events[event_id]
            self.events.updateValue((e.id,), (e.last, sorted(e.tokens), e.total.tolist()))
            self.handle.registerTimer(int((e.last + self.keep * DAY) * 1000) + 1)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = timerValues.getCurrentWatermarkInMs() / 1000
        gone = [k for k, (last, _, _) in self.events.iterator() if last + self.keep * DAY < now]
        for k in gone:
            self.events.removeKey(k)
        yield pd.DataFrame(columns=[c.split()[0] for c in OUT.split(", ")])

    def close(self) -> None:
        pass


def checked(articles: DataFrame) -> DataFrame:
    rows = articles.select(F.col("market").cast("string").alias("market"), "id", F.col("ts").cast("timestamp").alias("ts"), "token", F.col("vector").cast("array<double>").alias("vector"))
    return rows.filter("market IS NOT NULL AND id IS NOT NULL AND ts IS NOT NULL AND vector IS NOT NULL")


def resolved_stream(articles: DataFrame, late: str = "0 seconds", keep: float = 30.0, decide: Decide = by_similarity) -> DataFrame:
    """OUT for each article of a stream (market, id, ts, token, vector), as its micro-batch comes.

    An event is named by its first article. Articles of a micro-batch are taken in order of ts and id; a stream that comes in
    this order gives what resolved_batch gives of the same rows, however it is cut into batches and wherever it was restarted. Articles later
    than `late` behind the newest one are dropped by the watermark. An event is forgotten `keep` days after it was last
    seen. The markets are dealt over tasks; the order within one market is one task's work. Rows with a null market, id, ts or vector are left out.
    Needs the state store provider of RocksDB.
    """
    rows = checked(articles).withWatermark("ts", late)
    return rows.groupBy("market").transformWithStateInPandas(EventStore(keep, decide), outputStructType=OUT, outputMode="append", timeMode="eventtime")


def resolved_batch(articles: DataFrame, keep: float = 30.0, decide: Decide = by_similarity) -> DataFrame:
    """OUT for each article of a table, by one walk over each market in order; a market's rows are read as a stream, and only events that can still be joined are held."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        articles = (row for batch in batches for row in batch.to_dict("records"))
        for market, group in itertools.groupby(articles, key=lambda a: a["market"]):
            events: dict[int, Event] = {}
            out = []
            for article in group:
                at = seconds(article["ts"])
                for old in [k for k, e in events.items() if at - e.last > keep * DAY]:
                    del events[old]
                out.append((market, article["id"], article["ts"], *assign(events, article, keep, decide)))
                if len(out) >= 10_000:
                    yield pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])
                    out = []
            yield pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])

    order = ["market", "ts", "id"]
    return checked(articles).repartition("market").sortWithinPartitions(*order).mapInPandas(walk, OUT)
