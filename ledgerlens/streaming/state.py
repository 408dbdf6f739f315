"""The graph as state of a stream: a vertex for each address, an entry for each edge, token and time.

Spark's state store holds the tables: it is versioned with the offsets of the stream, so a batch that is cut off runs
again from the state before it, and ``table`` reads the state of any batch still kept. Event-time timers take away what
is older than ``keep`` seconds before the watermark, which moves ``late`` behind the newest transfer; a transfer behind
the watermark is left out. Nothing is pulled to the driver, and a key's rows pass through its task one at a time.

State that nothing takes away, and entries that leave just as the watermark passes them, need no timers: they are kept by
Spark's own aggregates, which put rows of one key together before the shuffle and call no Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from ..operators import graph

#: The store that such state needs.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class _Expiring(StatefulProcessor):
    """State under one name, with one timer at a time, ``keep`` seconds after the time that the state stands for."""

    name: str
    schema: StructType

    def __init__(self, keep: int | None):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState(self.name, self.schema)

    def _due(self, ts: int | None) -> int | None:
        # one millisecond on: what is exactly at the border stays
        return None if self.keep is None or ts is None else (ts + self.keep) * 1000 + 1

    def _move_timer(self, before: int | None, after: int | None) -> None:
        if before != after:
            if before is not None:
                self.handle.deleteTimer(before)
            if after is not None:
                self.handle.registerTimer(after)

    def close(self) -> None:
        pass


class _Vertex(_Expiring):
    name = "vertex"
    schema = StructType([StructField("last_transfer_at", LongType()), StructField("hot_wallet", BooleanType()), StructField("deposit_wallet", BooleanType())])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        old = self.state.get() if self.state.exists() else (None, False, False)
        last, hot, deposit = old
        for r in rows:
            last = r["ts"] if last is None else last if r["ts"] is None else max(last, r["ts"])
            hot, deposit = hot or r["hot"], deposit or r["deposit"]
        self.state.update((last, hot, deposit))
        self._move_timer(self._due(old[0]), self._due(last))
        yield Row(address=key[0], last_transfer_at=last, hot_wallet=hot, deposit_wallet=deposit, gone=False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        last, hot, deposit = self.state.get()
        self.state.clear()
        yield Row(address=key[0], last_transfer_at=last, hot_wallet=hot, deposit_wallet=deposit, gone=True)


class _Entry(_Expiring):
    """Of several transfers the last by the ``rank`` columns counts, in whatever order they arrive; nulls come first."""

    name = "entry"

    def __init__(self, keep: int | None, schema: StructType):
        super().__init__(keep)
        self.schema = schema

    @staticmethod
    def _rank(value: tuple) -> tuple:
        return tuple((x is not None, x) for x in value[2:])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        old = self.state.get() if self.state.exists() else None
        best = None if old is None else tuple(old)
        for r in rows:
            value = tuple(r[c] for c in self.schema.names)
            if best is None or self._rank(value) > self._rank(best):
                best = value
        self.state.update(best)
        if old is None:
            self._move_timer(None, self._due(key[3]))
        yield Row(f=key[0], t=key[1], tok=key[2], ts=key[3], amt=best[0], usd=best[1], gone=False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        best = self.state.get()
        self.state.clear()
        yield Row(f=key[0], t=key[1], tok=key[2], ts=key[3], amt=best[0], usd=best[1], gone=True)


def _combined(ends: DataFrame) -> DataFrame:
    """The newest of the rows of each address and tags in each Arrow batch, so that a busy address shuffles few rows.

    A row behind the watermark hides none before it: only rows with the same tags are put together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = pa.Table.from_batches([batch]).group_by(["address", "hot", "deposit"]).aggregate([("ts", "max")])
            yield from least.rename_columns(["address", "hot", "deposit", "ts"]).to_batches()

    return ends.select("address", "hot", "deposit", "ts").mapInArrow(run, "address string, hot boolean, deposit boolean, ts long")


def _timed(rows: DataFrame, late: str) -> DataFrame:
    return rows.withColumn("at", F.timestamp_seconds("ts")).withWatermark("at", late)


def vertices(transfers: DataFrame, hot: DataFrame, burn: DataFrame, late: str | None = "1 hour", keep: int | None = None) -> DataFrame:
    """Each vertex that a batch changes, as it is then; ``gone`` where its last transfer has become too old.

    Addresses that are null are one vertex, as in a batch. A transfer without a time is behind every watermark. Where
    ``late`` is None there is no watermark: nothing is left out and nothing goes.
    """
    admitted = graph.admit(transfers, hot, burn)
    if late is None:
        # both tags as bits of one number, as columns of the state are told apart by their aggregates
        tags = F.col("hot").cast("int") + F.col("deposit").cast("int") * 2
        found = graph.ends_of(admitted, hot).groupBy("address").agg(F.max("ts").alias("last_transfer_at"), F.bit_or(tags).alias("tags"))
        return _never_late(keep, _tagged(found))
    ends = _timed(_combined(graph.ends_of(admitted, hot)), late)
    return ends.groupBy("address").transformWithState(_Vertex(keep), "address string, last_transfer_at long, hot_wallet boolean, deposit_wallet boolean, gone boolean", "update", "eventTime")


def _tagged(rows: DataFrame) -> DataFrame:
    bit = lambda k: F.col("tags").bitwiseAND(F.lit(k)) != 0
    return rows.select("address", "last_transfer_at", bit(1).alias("hot_wallet"), bit(2).alias("deposit_wallet"))


def _never_late(keep: int | None, kept: DataFrame) -> DataFrame:
    if keep is not None:
        raise ValueError("without a watermark nothing becomes too old")
    return kept.withColumn("gone", F.lit(False))


def entries(transfers: DataFrame, hot: DataFrame, burn: DataFrame, prices: DataFrame, order: tuple[str, ...], late: str | None = "1 hour", keep: int | None = None) -> DataFrame:
    """Each log entry that a batch changes, priced, as it is then; ``gone`` where it has become too old.

    Where ``late`` is None there is no watermark: nothing is left out and nothing goes. Where ``keep`` is 0 an entry goes
    as the watermark passes it, without a row that says so.
    """
    priced = graph.price(graph.admit(transfers, hot, burn), prices)
    if late is None:
        return _never_late(keep, graph.fold_logs(priced, order))
    if keep == 0:
        # state goes at the watermark itself, and what is exactly at the border stays: a second more
        timed = _timed(priced.where("ts IS NOT NULL"), f"{late} 1 second")
        found = timed.groupBy("f", "t", "tok", "at").agg(F.max_by(F.struct("amt", "usd"), F.struct(*order)).alias("v"))
        return found.select("f", "t", "tok", F.unix_seconds("at").alias("ts"), "v.*", F.lit(False).alias("gone"))
    rows = _timed(priced.select("f", "t", "tok", F.col("ts").cast("long").alias("ts"), "amt", "usd", *(F.col(c).alias(f"rank{i}") for i, c in enumerate(order))), late)
    kind = StructType([StructField(x.name, x.dataType) for x in rows.schema if x.name in ("amt", "usd") or x.name.startswith("rank")])
    out = StructType([StructField(x.name, x.dataType) for x in rows.schema if x.name in ("f", "t", "tok", "ts", "amt", "usd")] + [StructField("gone", BooleanType())])
    return rows.groupBy("f", "t", "tok", "ts").transformWithState(_Entry(keep, kind), out, "update", "eventTime")


def run_available(changes: DataFrame, checkpoint: str, sink=None) -> StreamingQuery:
    """Take in what has arrived since the checkpoint, then stop; ``sink`` gets the changes of each batch and its number."""
    spark = changes.sparkSession
    before = spark.conf.get(PROVIDER[0], None)
    spark.conf.set(*PROVIDER)
    try:
        writer = changes.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
        query = (writer.foreachBatch(sink) if sink else writer.format("noop")).start()
    finally:
        spark.conf.set(PROVIDER[0], before) if before else spark.conf.unset(PROVIDER[0])
    query.awaitTermination()
    return query


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """The number of the last batch that is whole."""
    return spark.read.format("state-metadata").load(checkpoint).agg(F.max("maxBatchId")).first()[0]


#: The columns of aggregates that stand for either state, in their order.
AGGREGATES = {"vertex": ("last_transfer_at", "tags"), "entry": ("v", "rank")}


def table(spark: SparkSession, checkpoint: str, name: str, batch: int | None = None) -> DataFrame:
    """The state ``vertex`` or ``entry`` after the last batch, or after ``batch``, as a table."""
    by_hand = spark.read.format("state-metadata").load(checkpoint).where(F.col("operatorName").startswith("transformWithState"))
    reader = spark.read.format("statestore").option("path", checkpoint)
    reader = reader if batch is None else reader.option("batchId", batch)
    if by_hand.isEmpty():
        rows = reader.load().select("key.*", "value.*")
        keys = rows.columns[: len(rows.columns) - len(AGGREGATES[name])]
        held = rows.toDF(*keys, *AGGREGATES[name])
        if name == "vertex":
            return _tagged(held)
        at = F.unix_seconds("at").alias("ts") if "at" in keys else "ts"
        return held.select("f", "t", "tok", at, "v.*")
    held = reader.option("stateVarName", name).load().select("key.*", "value.*")
    return held.select(*(c for c in held.columns if not c.startswith("rank")))
