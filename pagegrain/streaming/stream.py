"""Structured Streaming versions of the stateless jobs and of first-seen."""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import timedelta

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from pagegrain.plans.jobs import brassring_jobs
from pagegrain.plans.offer_rules import RULES
from pagegrain.plans.offers import extract_all_offers, extract_offers
from pagegrain.plans.vitamins import vitamin_products
from pagegrain.session import remove

# the processor travels with its tasks
cloudpickle.register_pickle_by_value(importlib.import_module(__name__))

#: A commit uploads what changed, not a snapshot of each store.
CHANGES = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: The four tables of a join lie in one store instead of four. Only RocksDB can; a checkpoint keeps the format it began with.
JOINS, ONE_STORE = "spark.sql.streaming.join.stateFormatVersion", "3"


def read_page_stream(spark: SparkSession, folder: str, schema: StructType, names: str = "*.parquet",
                     files: int | None = None, size: str | None = None) -> DataFrame:
    """Pages as they arrive as parquet files in a folder; ``files`` or ``size`` (such as ``10g``) bound a micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", names)
    if files is not None:
        reader = reader.option("maxFilesPerTrigger", files)
    if size is not None:
        reader = reader.option("maxBytesPerTrigger", size)
    return reader.parquet(folder)


def stream_batches(pages: DataFrame, extract: Callable[[DataFrame, int], DataFrame], checkpoint: str, out: str,
                   after: Callable[[int], None] | None = None) -> StreamingQuery:
    """A batch job over arriving pages: all there is now, then stop.

    Each micro-batch replaces its own partition of ``out``, so a batch that is run again after a failure leaves no duplicates.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        extract(batch, batch_id).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        if after is not None:
            after(batch_id)

    return (pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_offers(pages: DataFrame, checkpoint: str, out: str, staging: str, rules=RULES) -> StreamingQuery:
    """Offers of arriving pages. A micro-batch's staged blocks are removed once its offers are written."""
    rules = list(rules)

    def extract(batch: DataFrame, batch_id: int) -> DataFrame:
        return extract_offers(batch, rules) if len(rules) == 1 else extract_all_offers(batch, f"{staging}/{batch_id}", rules)

    spark = pages.sparkSession
    return stream_batches(pages, extract, checkpoint, out, lambda batch_id: remove(spark, f"{staging}/{batch_id}"))


def stream_jobs(pages: DataFrame, checkpoint: str, out: str) -> StreamingQuery:
    """Job postings of arriving brassring pages. For pentair's, which need all pages of a listing, see ``products.stream_pentair``."""
    return stream_batches(pages, lambda batch, _: brassring_jobs(batch), checkpoint, out)


def stream_vitamins(pages: DataFrame, checkpoint: str, out: str) -> StreamingQuery:
    """Supplements of arriving pages."""
    return stream_batches(pages, lambda batch, _: vitamin_products(batch), checkpoint, out)


def first_seen_stream(stream: DataFrame, keys: list[str], event_time: str | None = None,
                      delay: str | None = None) -> DataFrame:
    """One row per key, whichever arrives first.

    Without a watermark the key state grows with the number of keys; with one (``event_time`` and ``delay``)
    keys are forgotten after the delay.
    """
    if delay is None:
        return stream.dropDuplicates(keys)
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


class OnePerKey(StatefulProcessor):
    """Keeps the first (or with ``latest`` the last) row of each key in order, and sends it when ``delay`` has passed since the key was met.

    One call sees all rows and keys of a group, since a call costs milliseconds and a row microseconds. Rows are told apart by ``each_`` inside a
    key; a key's rows go out together. A key that was sent is remembered, and what comes for it later is not read; with ``forget`` it is
    remembered so long only. A group's timer stands at the first time at which one of its keys is due.
    """

    def __init__(self, latest: bool, delay_ms: int, forget_ms: int | None):
        self.latest, self.delay_ms, self.forget_ms = latest, delay_ms, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        #: by key: when it is due, and by ``each_`` the place and the body of the row that counts
        self.best = handle.getValueState("best", "rows string")
        #: by key: when it was sent
        self.sent = handle.getValueState("sent", "at string")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802  the interface's names
        best, sent, new = self.held(self.best), self.held(self.sent), set()
        for batch in rows:
            for name, each, place, ms, body in zip(*(batch[c].tolist() for c in ("key_", "each_", "place_", "ms_", "body_"))):
                if name in sent:
                    continue
                known = best.get(name)
                if known is None:
                    known = best[name] = [ms + self.delay_ms, {}]
                    new.add(name)
                elif name in new and ms + self.delay_ms < known[0]:
                    known[0] = ms + self.delay_ms
                kept = known[1].get(each)
                if kept is None or (place > kept[0] if self.latest else place < kept[0]):
                    known[1][each] = [place, body]
        if best:
            self.best.update((json.dumps(best),))
            if new:
                self.handle.registerTimer(min(best[name][0] for name in new))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802
        # all that is due goes out with the first of the group's timers; the others find nothing
        end = max(expiredTimerInfo.getExpiryTimeInMs() + 1, timerValues.getCurrentWatermarkInMs())
        best, sent = self.held(self.best), self.held(self.sent)
        due = {name: known for name, known in best.items() if known[0] < end}
        gone = [] if self.forget_ms is None else [name for name, at in sent.items() if at + self.forget_ms < end]
        if not due and not gone:
            return
        for name in gone:
            del sent[name]
        for name, (at, _) in due.items():
            del best[name]
            sent[name] = at
        self.best.update((json.dumps(best),)) if best else self.best.clear()
        self.sent.update((json.dumps(sent),)) if sent else self.sent.clear()
        later = [at for at, _ in best.values()] + ([] if self.forget_ms is None else [at + self.forget_ms for at in sent.values()])
        if later:
            self.handle.registerTimer(max(min(later), end))
        rows = [(at, body) for at, kept in due.values() for _, body in kept.values()]
        if rows:
            yield pd.DataFrame({"settled_at": pd.to_datetime([at for at, _ in rows], unit="ms", utc=True), "body_": [body for _, body in rows]})

    @staticmethod
    def held(state) -> dict:
        return json.loads(state.get()[0]) if state.exists() else {}

    def close(self) -> None:
        pass


#: Timestamps keep their microseconds in the state.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
#: Groups of keys whose state is read and written together.
GROUPS = 1024


def one_per_key(stream: DataFrame, keys: list[str], order: list[str], event_time: str, delay: timedelta, latest: bool = False,
                forget: timedelta | None = None, each: str | None = None, groups: int = GROUPS) -> DataFrame:
    """The row per key that comes first (with ``latest``: last) in ``order``, with ``settled_at``, when it was sent.

    A key's row goes out when ``delay`` has passed, in event time, since the key was first met; so rows may arrive in any order within
    the delay. The state holds the rows of one delay, and a mark per key that was sent (bounded by ``forget``). ``order`` are integers or
    timestamps, missing ones come first; a row without ``event_time`` is late, one without any key only moves the clock. With ``each`` there
    is one row per value of that column and key; a key's rows go out together. The result has ``settled_at`` as its event time.

    Keys are dealt over ``groups`` by their hash. A group's keys are one value of the state, so more keys at a time want more groups; a
    checkpoint keeps the number it began with.
    """
    kinds = dict(stream.dtypes)

    def number(name: str) -> Column:
        value = F.unix_micros(F.col(name).cast("timestamp")) if kinds[name].startswith("timestamp") else F.col(name).cast("bigint")
        return F.coalesce(value, F.lit(-(1 << 63)))

    ms = lambda t: int(t.total_seconds() * 1000)
    timed = stream.withColumn("at_", F.coalesce(F.col(event_time).cast("timestamp"), F.timestamp_seconds(F.lit(0)))).withWatermark("at_", f"{ms(delay)} milliseconds")
    # one condition on the event time: it is not moved below the watermark, which sees every row
    keyed = timed.where(F.when(F.col("at_") >= F.timestamp_seconds(F.lit(-62135596800)), F.coalesce(*[F.col(k).cast("string") for k in keys]).isNotNull()))
    # places compare as text: the sign bit is turned over and the digits are of one length
    place = F.concat(*[F.lpad(F.hex(number(o).bitwiseXOR(F.lit(-(1 << 63)))), 16, "0") for o in order])
    packed = keyed.select(F.pmod(F.xxhash64(*keys), F.lit(groups)).alias("group_"), F.to_json(F.struct(*keys), JSON).alias("key_"), "at_",
                          F.unix_millis("at_").alias("ms_"), place.alias("place_"),
                          (F.lit("") if each is None else F.coalesce(F.col(each).cast("string"), F.lit(""))).alias("each_"),
                          F.to_json(F.struct(*stream.columns), JSON).alias("body_"))
    schema = StructType([StructField("settled_at", TimestampType()), StructField("body_", StringType())])
    done = packed.groupBy("group_").transformWithStateInPandas(
        OnePerKey(latest, ms(delay), None if forget is None else ms(forget)), outputStructType=schema, outputMode="Append", timeMode="EventTime",
        eventTimeColumnName="settled_at")
    read = done.select("settled_at", F.from_json("body_", stream.schema, JSON).alias("__row"))
    return read.select(*[F.col(f"__row.{k}") for k in keys], "settled_at", *[F.col(f"__row.{c}") for c in stream.columns if c not in keys])


def wait(query: StreamingQuery) -> None:
    """Until the query has used up its present input."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


@contextmanager
def stores_on_disk(spark: SparkSession, settings: dict[str, str] | None = None) -> Iterator[None]:
    """Queries started inside keep their state on disk, not in executor memory, unless the session names another store; with further settings."""
    key = "spark.sql.streaming.stateStore.providerClass"
    now = spark.conf.get(key, None)
    wanted = dict(settings or {})
    if not (now or "").endswith("RocksDBStateStoreProvider") and (now is None or now.endswith("HDFSBackedStateStoreProvider")):
        wanted[key] = ROCKSDB
    if wanted.get(key, now or "").endswith("RocksDBStateStoreProvider"):
        wanted[JOINS] = ONE_STORE
    if spark.conf.get(CHANGES, None) in (None, "false"):
        wanted[CHANGES] = "true"
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_to_end(df: DataFrame, checkpoint: str, out: str) -> None:
    """Write a stream to parquet until its present input is used up."""
    with stores_on_disk(df.sparkSession):
        wait(df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
