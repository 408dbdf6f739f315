"""The graph kept by a stream of transfers; what each twin gives is what one batch over all of them gives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..fixtures import LAST, Relations
from ..sources.store import shared_path, written
from ..streaming import state
from .registry import query

#: Behind the newest transfer.
HALF_YEAR = "180 days"


def streamed(r: Relations, changes: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """The state after two runs, of which the second takes up where the first has ended."""
    transfers, spark = r.share().transfers(), r.spark
    source, checkpoint = shared_path(spark), shared_path(spark)
    for leg in (0, 1):
        transfers.where(f"leg = {leg}").write.mode("append").parquet(source)
        state.run_available(changes(spark.readStream.schema(transfers.schema).parquet(source)), checkpoint)
    return state.table(spark, checkpoint, name)


@query("SELECT address, last_transfer_at, hot_wallet, deposit_wallet FROM vert")
def stream_vertices(r: Relations) -> DataFrame:
    hot, burn = written(r.hot()), written(r.burn())
    return streamed(r, lambda t: state.vertices(t, hot, burn, None), "vertex")


@query("SELECT f, t, tok, ts, amt, usd FROM logs")
def stream_entries(r: Relations) -> DataFrame:
    hot, burn, prices = written(r.hot()), written(r.burn()), written(r.prices())
    return streamed(r, lambda t: state.entries(t, hot, burn, prices, LAST, None), "entry")


@query("SELECT f, t, tok, ts, amt, usd FROM logs WHERE ts >= (SELECT max(ts) FROM adm) - 180 * 86400")
def stream_recent_entries(r: Relations) -> DataFrame:
    """What is behind the watermark never enters, or leaves by its timer."""
    hot, burn, prices = written(r.hot()), written(r.burn()), written(r.prices())
    return streamed(r, lambda t: state.entries(t, hot, burn, prices, LAST, HALF_YEAR, keep=0), "entry")
