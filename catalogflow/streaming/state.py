"""Asset status and error runs kept across batches (T3, W13) with keyed state.

``follow_assets`` takes a log stream (asset, status, at, ord) and gives changes, each a row that replaces an earlier one of the same
(asset, what, from_at, from_ord):

* ``latest``: the latest record of the asset, by (at, ord);
* ``run``: a run of records of one error status, as soon as it has ``threshold`` of them, and again when it grows;
* ``idle``: an asset whose latest record is ``idle`` old by the watermark.

Records may come late, in any order, and more than once. They wait in the state until the watermark has passed them, then they are
taken in order, so runs are those of the whole log; records behind the watermark are left out, as everywhere in streams.

State of an asset: one value with its latest record, its current run and its next timer, and a list with the records of the last ``delay``.
Nothing else grows with the log. The state of an asset is read and written once a batch for its new records and once for its timer, however
many records these are; a call to the state store for every record would take most of the time. Checkpoints of another layout are not read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from catalogflow.streaming.jobs import _exists

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_ASSET = (
    T.StructType().add("at", T.LongType()).add("ord", T.LongType()).add("status", T.StringType()).add("due", T.LongType())
    .add("run_status", T.StringType()).add("run_length", T.LongType()).add("run_at", T.LongType()).add("run_ord", T.LongType())
)
_WAITING = T.StructType().add("at", T.ArrayType(T.LongType())).add("ord", T.ArrayType(T.LongType())).add("status", T.ArrayType(T.StringType()))
_CHUNK = 4096  # waiting records in one entry of the list
_OUT = "what string, status string, length long, from_at long, from_ord long, to_at long, to_ord long"


class _Follow(StatefulProcessor):
    def __init__(self, errors: Sequence[str], threshold: int, idle_ms: int):
        self._errors, self._threshold, self._idle = frozenset(errors), threshold, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._asset = handle.getValueState("asset", _ASSET)
        self._waiting = handle.getListState("waiting", _WAITING)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        state = self._asset.get()
        latest, due, run = (state[:3], state[3], state[4:]) if state else (None, None, (None,) * 4)
        came = [(r["_at"], r["ord"], r["status"]) for r in rows]
        self._waiting.appendList(self._chunks(came))
        last = max(came, key=lambda r: r[:2])
        newer = latest is None or last[:2] >= latest[:2]
        if newer:
            latest = last
        wanted = self._next(came, latest)
        if due is None or wanted < due:
            self._handle.registerTimer(wanted)
            due = wanted
        self._asset.update((*latest, due, *run))
        if newer:
            yield self._row(key, "latest", latest[2], 1, None, None, latest[0], latest[1])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self._asset.get()
        if state is None or state[3] != expiredTimerInfo.getExpiryTimeInMs():
            return  # another timer has taken its place
        latest, run = state[:3], state[4:] if state[4] is not None else None
        now = timerValues.getCurrentWatermarkInMs()
        waiting = {(at, ord_): status for ats, ords, statuses in self._waiting.get() for at, ord_, status in zip(ats, ords, statuses)}
        rest = [(*k, v) for k, v in waiting.items() if k[0] >= now]
        grown = None
        for at, ord_ in sorted(k for k in waiting if k[0] < now):  # no earlier record can come
            status = waiting[at, ord_]
            if status not in self._errors:
                run = None
            elif run is not None and run[0] == status:
                run = (status, run[1] + 1, run[2], run[3])
            else:
                run = (status, 1, at, ord_)
            if run is not None and run[1] >= self._threshold:
                if grown is not None and grown[2:4] != run[2:4]:
                    yield self._row(key, "run", *grown)
                grown = (*run, at, ord_)
        if grown is not None:
            yield self._row(key, "run", *grown)
        if not rest:
            self._waiting.clear()
        elif len(rest) < len(waiting):
            self._waiting.put(self._chunks(rest))
        idle = latest[0] + self._idle <= now
        due = None if idle and not rest else self._next(rest, None if idle else latest)
        if due is not None:
            self._handle.registerTimer(due)
        self._asset.update((*latest, due, *(run or (None,) * 4)))
        if idle:
            yield self._row(key, "idle", latest[2], 1, None, None, latest[0], latest[1])

    def _next(self, waiting, latest) -> int:
        """When the asset has to be looked at again: the watermark is past its first waiting record, or it is idle."""
        times = [r[0] + 1 for r in waiting]
        return min([*times, latest[0] + self._idle] if latest is not None else times)

    @staticmethod
    def _chunks(records) -> list[tuple]:
        return [tuple(map(list, zip(*records[i : i + _CHUNK]))) for i in range(0, len(records), _CHUNK)]

    @staticmethod
    def _row(key, what, status, length, from_at, from_ord, to_at, to_ord) -> Row:
        return Row(asset=key[0], what=what, status=status, length=length, from_at=from_at, from_ord=from_ord, to_at=to_at, to_ord=to_ord)

    def close(self) -> None:
        pass


def follow_assets(stream: DataFrame, errors: Sequence[str], threshold: int, idle: dt.timedelta, delay: str = "1 hour") -> DataFrame:
    """The changes of a stream (asset, status, at, ord). A status that is null counts as no error."""
    out = T.StructType([stream.schema["asset"], *T._parse_datatype_string(_OUT).fields])
    # times are microseconds in the log and milliseconds in timers; order inside a millisecond is kept by ord
    at = F.col("at").cast("timestamp")
    rows = stream.where("at IS NOT NULL").select("asset", "status", at.alias("at"), F.col("ord").cast("long").alias("ord"), F.unix_millis(at).alias("_at")).withWatermark("at", delay)
    return rows.groupBy("asset").transformWithState(
        statefulProcessor=_Follow(errors, threshold, int(idle.total_seconds() * 1000)), outputStructType=out, outputMode="Update", timeMode="EventTime")


def start_following(changes: DataFrame, out: str, checkpoint: str):
    """Write the changes of all new files and end; a batch that runs again replaces its own rows."""
    spark = changes.sparkSession
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    try:
        query = changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(_PROVIDER, before)
    return query


def followed(spark: SparkSession, out: str, what: str) -> DataFrame:
    """The current rows of one kind: of each (asset, from_at, from_ord) the one of the last batch, within a batch the longest or latest."""
    if not _exists(spark, out):
        raise FileNotFoundError(out)
    rows = spark.read.option("basePath", out).parquet(out).where(F.col("what") == what)
    rest = [c for c in rows.columns if c not in ("asset", "from_at", "from_ord", "batch", "what")]
    best = F.max_by(F.struct(*rest), F.struct("batch", "length", "to_at", "to_ord"))
    return rows.groupBy("asset", "from_at", "from_ord").agg(best.alias("x")).select("asset", "from_at", "from_ord", "x.*")
