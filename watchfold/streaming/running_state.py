"""Running features of a stream in event time: the state of the entities between micro-batches.

Entities are dealt to buckets by a hash, and a bucket is a key of the state: what comes for its
entities is computed together, and their totals are read and written in pages.

Arriving rows wait in the state, in parts sorted by time, until the watermark has passed
them; a timer then releases them in (event_ts, event_id) order. So the features do not
depend on the order of arrival, as long as no row comes later than the watermark's
delay. Later ones are dropped before they reach the state; ``late_rows`` counts them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import MapState

_METRICS = {"session": "session_duration_min", "bytes_up": "bytes_uploaded", "bytes_down": "bytes_downloaded"}
_RATES = {"entity_failed_rate": "login_status", "new_device_rate": "new_device", "new_location_rate": "new_location"}
_ZSCORES = {"session": "session_duration_zscore", "bytes_up": "bytes_uploaded_zscore",
            "bytes_down": "bytes_downloaded_zscore"}

# n, last time (us), streak, sum of n*log2(n) over the resources; per metric: count, shift, sum and sum of squares about the shift; per rate: count, sum
_STATE_FIELDS = (
    ["n", "last_us", "streak", "spread"]
    + [f"{p}_{m}" for m in _METRICS for p in ("cnt", "shift", "sum", "sq")]
    + [f"{p}_{r}" for r in _RATES for p in ("cnt", "sum")]
)
_AT = {f: i for i, f in enumerate(_STATE_FIELDS)}
NEW_COLUMNS = (
    "entity_login_count long, time_since_last_login_min double, "
    "entity_avg_session double, entity_avg_bytes_up double, entity_avg_bytes_down double, "
    "entity_std_session double, session_duration_zscore double, bytes_uploaded_zscore double, "
    "bytes_downloaded_zscore double, consecutive_failures long, entity_failed_rate double, "
    "new_device_rate double, new_location_rate double, resource_access_entropy_to_date double"
)
#: Waiting rows are stored in parts of this many, and released when this many times ten are at hand.
PART = 1000
#: Entities share so many state keys: a call of the state store costs more than the rows of one entity.
BUCKETS = 512
#: Totals and counts are stored in pages of about this many; a page is read or written whole.
PAGE = 2000


def _divide(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.full(len(a), np.nan), where=b != 0)


def _term(n: np.ndarray) -> np.ndarray:
    return n * np.log2(np.maximum(n, 1))


def advance(
    pdf: pd.DataFrame, who: np.ndarray, state: np.ndarray, median_gap: float | None
) -> tuple[pd.DataFrame, np.ndarray]:
    """Features of the next events of some entities, but the entropy, and their state after them.

    ``pdf`` is sorted by entity, time and id; ``who`` is the entity's place in ``state``, which has a
    row (``_STATE_FIELDS``) for each.
    """
    first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
    last = np.r_[first[1:], len(who)] - 1
    old = lambda f: state[:, _AT[f]]
    run = lambda x: pd.Series(x).groupby(who).cumsum().to_numpy()
    after, made = state.copy(), {}
    at = np.arange(len(who)) - first[who] + 1
    made["entity_login_count"] = (old("n")[who] + at).astype(np.int64)
    us = pdf["order_us"].to_numpy(dtype=np.int64)
    seen = old("n") > 0
    before = np.r_[us[:1], us[:-1]]
    before[first] = np.where(seen, old("last_us").astype(np.int64), us[first])
    gap = (us - before) / 6e7
    gap[first[~seen]] = np.nan if median_gap is None else median_gap
    made["time_since_last_login_min"] = gap
    after[:, _AT["n"]], after[:, _AT["last_us"]] = made["entity_login_count"][last], us[last]
    for m, column in _METRICS.items():
        x = pd.to_numeric(pdf[column], errors="coerce").to_numpy(dtype=float)
        known = ~np.isnan(x)
        start = np.zeros(len(state))
        to, one = np.unique(who[known], return_index=True)
        start[to] = x[known][one]
        shift = np.where(old(f"cnt_{m}") > 0, old(f"shift_{m}"), start)
        d = np.where(known, x - shift[who], 0.0)
        cnt = old(f"cnt_{m}")[who] + run(known.astype(float))
        total = old(f"sum_{m}")[who] + run(d)
        square = old(f"sq_{m}")[who] + run(d * d)
        mean = shift[who] + _divide(total, cnt)
        spread = np.maximum(square - _divide(total * total, cnt), 0.0)
        std = np.sqrt(_divide(spread, np.where(cnt > 1, cnt - 1, 0)))
        made[f"entity_avg_{m}"] = mean
        if m == "session":
            made["entity_std_session"] = np.nan_to_num(std, nan=0.0)
        divisor = np.where(np.isnan(std) | (std == 0), 1.0, std)
        made[_ZSCORES[m]] = np.clip((x - mean) / divisor, -10, 10)
        for p, values in (("cnt", cnt[last]), ("shift", shift), ("sum", total[last]), ("sq", square[last])):
            after[:, _AT[f"{p}_{m}"]] = values
    failed = (pdf["login_status"] == "Failed").to_numpy()
    last_ok = pd.Series(np.where(failed, -old("streak")[who], at)).groupby(who).cummax().to_numpy()
    made["consecutive_failures"] = (at - last_ok).astype(np.int64)
    after[:, _AT["streak"]] = made["consecutive_failures"][last]
    for r, column in _RATES.items():
        flag = failed.astype(float) if column == "login_status" else pdf[column].astype("float").to_numpy()
        known = ~np.isnan(flag)
        cnt = old(f"cnt_{r}")[who] + run(known.astype(float))
        total = old(f"sum_{r}")[who] + run(np.where(known, flag, 0.0))
        made[r] = _divide(total, cnt)
        after[:, _AT[f"cnt_{r}"]], after[:, _AT[f"sum_{r}"]] = cnt[last], total[last]
    return pd.concat([pdf, pd.DataFrame(made, index=pdf.index)], axis=1), after


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


class Pages:
    """Rows of numbers by text, in a map state: dealt to pages by a hash, twice as many pages when they are full.

    Only the pages of the wanted texts are read, and those of the changed ones written.
    """

    def __init__(self, state: MapState, width: int):
        self.state, self.width = state, width

    @staticmethod
    def places(keys: np.ndarray, pages: int) -> np.ndarray:
        return pd.util.hash_array(keys.astype(object), categorize=False) % np.uint64(pages)

    def page(self, place: int) -> tuple[np.ndarray, np.ndarray]:
        known = self.state.getValue((int(place),))
        if known is None:
            return np.empty(0, object), np.empty((0, self.width))
        table = pa.ipc.open_stream(known[0]).read_all().combine_chunks()
        keys = table["key"].to_numpy().astype(object)
        return keys, table["x"].chunk(0).flatten().to_numpy().reshape(-1, self.width) if len(keys) else np.empty((0, self.width))

    def put(self, place: int, keys: np.ndarray, values: np.ndarray) -> None:
        x = pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(values).ravel(), pa.float64()), self.width)
        batch = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), x], names=["key", "x"])
        self.state.updateValue((int(place),), (_packed(batch),))

    def get(self, keys: np.ndarray, pages: int) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
        """The rows of some distinct texts, zeros where none is stored; and the pages that were read."""
        held = {int(p): self.page(p) for p in np.unique(self.places(keys, pages))}
        stored = np.concatenate([k for k, _ in held.values()])
        at = pd.Index(stored).get_indexer(keys)
        out = np.zeros((len(keys), self.width))
        out[at >= 0] = np.concatenate([x for _, x in held.values()])[at[at >= 0]]
        return out, held

    def update(
        self, keys: np.ndarray, values: np.ndarray, held: dict[int, tuple[np.ndarray, np.ndarray]], pages: int, stored: int
    ) -> tuple[int, int]:
        """Store rows whose pages ``get`` has read; the number of pages and of rows after that."""
        where = self.places(keys, pages)
        for place, (old, x) in held.items():
            mine = where == place
            rest = pd.Index(keys[mine]).get_indexer(old) < 0
            stored += int(mine.sum()) - int((~rest).sum())
            held[place] = np.concatenate([old[rest], keys[mine]]), np.concatenate([x[rest], values[mine]])
        if stored <= pages * PAGE:
            for place, (k, x) in held.items():
                self.put(place, k, x)
            return pages, stored
        whole = [held[p] if p in held else self.page(p) for p in range(pages)]
        keys, values = (np.concatenate(c) for c in zip(*whole))
        while stored > pages * PAGE // 2:
            pages *= 2
        where = self.places(keys, pages)
        for place in np.unique(where):
            self.put(place, keys[where == place], values[where == place])
        return pages, stored


class EntityState(StatefulProcessor):
    """Waiting rows, running totals and the counts of the resources used, of the entities of a bucket."""

    _FIELDS = ("parts", "wake", "entity_pages", "entities", "use_pages", "uses")

    def __init__(self, columns: list[str], median_gap: float | None):
        self.columns, self.median_gap = columns, median_gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Stored parts so far, when the timer rings (ms; -1: none), pages and rows of totals and of counts.
        self.about = handle.getValueState("about", ", ".join(f"{f} long" for f in self._FIELDS))
        self.waiting = handle.getMapState("waiting", "start long, part long", "rows binary")
        self.totals = Pages(handle.getMapState("totals", "page long", "rows binary"), len(_STATE_FIELDS))
        self.uses = Pages(handle.getMapState("uses", "page long", "rows binary"), 1)

    def _about(self) -> dict:
        known = self.about.get() if self.about.exists() else None
        return dict(zip(self._FIELDS, known if known else (0, -1, 1, 0, 1, 0)))

    def _put(self, about: dict) -> None:
        self.about.update(tuple(int(about[f]) for f in self._FIELDS))

    def _store(self, rows: pd.DataFrame, about: dict) -> None:
        rows = rows.sort_values("order_us", ignore_index=True)
        for at in range(0, len(rows), PART):
            part = rows.iloc[at : at + PART]
            key = (int(part["order_us"].iloc[0]), int(about["parts"]))
            self.waiting.updateValue(key, (_packed(pa.RecordBatch.from_pandas(part, preserve_index=False)),))
            about["parts"] += 1

    def _wake(self, us: int, about: dict) -> None:
        """One timer for the first row that waits."""
        ms = -(-us // 1000)
        if 0 <= about["wake"] <= ms:
            return
        if about["wake"] >= 0:
            self.handle.deleteTimer(about["wake"])
        self.handle.registerTimer(ms)
        about["wake"] = ms

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        about, first = self._about(), None
        for frame in rows:
            if len(frame):
                self._store(frame, about)
                low = int(frame["order_us"].min())
                first = low if first is None else min(first, low)
        if first is not None:
            self._wake(first, about)
        self._put(about)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        about = self._about()
        about["wake"] = -1
        keys = sorted(tuple(k) for k in self.waiting.keys())
        held, n, rest, waits = [], 0, None, []
        for i, (start, part) in enumerate(keys):
            if start > passed:
                waits.append(start)
                break
            frame = pa.ipc.open_stream(self.waiting.getValue((start, part))[0]).read_pandas()
            self.waiting.removeKey((start, part))
            held.append(frame)
            n += len(frame)
            # Rows before the start of the next part have no others before them.
            after = keys[i + 1][0] if i + 1 < len(keys) else passed + 1
            if n < 10 * PART and after <= passed:
                continue
            rows = pd.concat(held, ignore_index=True)
            ready = rows["order_us"] < min(after, passed + 1)
            if ready.any():
                yield self._released(rows[ready], about)[self.columns]
            rest = rows[~ready]
            held, n = [rest], len(rest)
        if n:
            self._store(rest, about)
            waits.append(int(rest["order_us"].min()))
        if waits:
            self._wake(min(waits), about)
        self._put(about)

    def _released(self, rows: pd.DataFrame, about: dict) -> pd.DataFrame:
        """The features of rows whose time has come, and the state after them."""
        names, which = np.unique(_texts(rows["entity_id"]), return_inverse=True)
        order = rows.assign(_who=which).sort_values(["_who", "order_us", "event_id"], ignore_index=True)
        who, rows = order["_who"].to_numpy(), order.drop(columns="_who")
        state, held = self.totals.get(names, about["entity_pages"])
        out, after = advance(rows, who, state, self.median_gap)
        used, use = np.unique(_texts(rows["resource_accessed"]), return_inverse=True)
        entropy, after[:, _AT["spread"]] = self._entropies(out, who, names, used, use, state[:, _AT["spread"]], about)
        about["entity_pages"], about["entities"] = self.totals.update(
            names, after, held, about["entity_pages"], about["entities"]
        )
        out["resource_access_entropy_to_date"] = entropy
        return out

    def _entropies(
        self, rows: pd.DataFrame, who: np.ndarray, names: np.ndarray, used: np.ndarray, use: np.ndarray, spread: np.ndarray,
        about: dict,
    ) -> tuple[np.ndarray, np.ndarray]:
        """log2(N) - sum(n*log2 n) / N after each row, equal times see each other; and that sum. One use changes one count."""
        pairs, pair = np.unique(who * len(used) + use, return_inverse=True)
        keys = np.array([f"{len(names[w])}:{names[w]}{used[u]}" for w, u in zip(*divmod(pairs, len(used)))], object)
        counts, held = self.uses.get(keys, about["use_pages"])
        nth = counts[pair, 0] + pd.Series(pair).groupby(pair).cumcount().to_numpy() + 1
        counts[:, 0] += np.bincount(pair, minlength=len(pairs))
        about["use_pages"], about["uses"] = self.uses.update(keys, counts, held, about["use_pages"], about["uses"])
        run = spread[who] + pd.Series(_term(nth) - _term(nth - 1)).groupby(who).cumsum().to_numpy()
        n, us = rows["entity_login_count"].to_numpy(), rows["order_us"].to_numpy()
        out = np.log2(n) - run / n
        ends = np.r_[who[1:] != who[:-1], True]
        last = ends | np.r_[us[1:] != us[:-1], True]
        to_last = np.flatnonzero(last)[np.cumsum(np.r_[0, last[:-1]])]
        return np.maximum(out[to_last], 0.0), run[ends]

    def close(self) -> None:
        pass


def _texts(column: pd.Series) -> np.ndarray:
    """Texts in which a missing value is one of its own."""
    return np.array(["" if v is None or v != v else f"={v}" for v in column], object)


STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def running_stream(events: DataFrame, median_gap: float | None = None, delay: str = "1 hour") -> DataFrame:
    """Stream counterpart of ``running_features`` and of the entropy to date.

    A row comes out when the watermark, ``delay`` behind the latest time seen, has
    passed it; those of the last ``delay`` of a stream wait for later rows.  State
    grows with the entities, the resources each has used and the rows of one delay; a
    bucket's waiting rows are read some parts at a time.
    """
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    kinds = ", ".join(f"{n} {t}" for n, t in events.dtypes)
    columns = [*events.columns, *[c.split()[0] for c in NEW_COLUMNS.split(", ")]]
    marked = events.withColumn("order_us", F.unix_micros("event_ts")).withWatermark("event_ts", delay)
    marked = marked.withColumn("_bucket", F.pmod(F.xxhash64("entity_id"), F.lit(BUCKETS)))
    return marked.groupBy("_bucket").transformWithStateInPandas(
        EntityState(columns, median_gap), f"{kinds}, {NEW_COLUMNS}", "Append", "EventTime"
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark had passed them, and were dropped."""
    return sum(
        int(op.numRowsDroppedByWatermark) for p in query.recentProgress for op in p.stateOperators
    )
