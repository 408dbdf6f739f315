"""Names of addresses: registrations, address changes, reverse records, and the hash that keys them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import latest


def merge_events(events: DataFrame) -> DataFrame:
    """``node, kind, name, new_address, block_number``: registered names with their last address, and addresses
    that changed without a registration as ``leftover``."""
    last = lambda kind: events.where(F.col("event_type") == kind).groupBy("node").agg(F.max_by(F.struct("name", "new_address", "block_number"), "block_number").alias("e"))
    registered, changed = last("NAMEREGISTERED").select("node", F.col("e").alias("g")), last("ADDRESSCHANGED").select("node", F.col("e").alias("c"))
    met = registered.join(changed, "node", "full_outer")
    return met.select(
        "node", F.when(F.col("g").isNotNull(), "registered").otherwise("leftover").alias("kind"), F.coalesce("g.name", "c.name").alias("name"), F.col("c.new_address").alias("new_address"),
        F.greatest("g.block_number", "c.block_number").alias("block_number"),
    )


def reverse_records(events: DataFrame, step: int = 1024) -> DataFrame:
    """``node, claimed_at, named_at``: each reverse claim with the first name set on its node after it, if any."""
    # looking back in blocks counted downwards, from the block after the claim
    claims = events.where("event_type = 'REVERSECLAIMED'").select("node", (-F.col("block_number") - 1).alias("at"))
    named = events.where("event_type = 'RVERSENAMESET'").select("node", (-F.col("block_number")).alias("at"), (-F.col("block_number")).alias("value"))
    met = latest(claims, named, ["node"], step).where("value IS NOT NULL")
    return met.select("node", (-F.col("at") - 1).alias("claimed_at"), (-F.col("value")).alias("named_at"))


def enrich(vertices: DataFrame, names: DataFrame, key: str = "address") -> DataFrame:
    """Vertices that have a name, with it added once to their ``names``."""
    return vertices.join(names, key).withColumn("names", F.array_union("names", F.array("name"))).drop("name")


def forget(vertices: DataFrame, names: DataFrame, key: str = "address") -> DataFrame:
    """All vertices, those of ``names`` without the name that stands there."""
    return vertices.join(names, key, "left").withColumn("names", F.when(F.col("name").isNotNull(), F.array_remove("names", F.col("name"))).otherwise(F.col("names"))).drop("name")


#: The rotation of each lane of the permutation, and the feedback of the register behind its constants.
_ROTATIONS = ((0, 36, 3, 41, 18), (1, 44, 10, 45, 2), (62, 6, 43, 15, 61), (28, 55, 25, 21, 56), (27, 20, 39, 8, 14))
_FEEDBACK = 0x171
_RATE = 136


def _constants() -> list[int]:
    out, state = [], 1
    for _ in range(24):
        value = 0
        for j in range(7):
            if state & 1:
                value |= 1 << ((1 << j) - 1)
            state = (state << 1) ^ ((state >> 7) * _FEEDBACK)
        out.append(value)
    return out


_ROUNDS = np.array(_constants(), np.uint64)


def _permute(a: np.ndarray) -> np.ndarray:
    """The permutation of many states at once: ``a[x, y]`` is a lane of each of them."""
    turn = lambda x, n: x << np.uint64(n) | x >> np.uint64(64 - n) if n else x
    b = np.empty_like(a)
    for constant in _ROUNDS:
        c = np.bitwise_xor.reduce(a, axis=1)
        d = np.roll(c, 1, axis=0) ^ turn(np.roll(c, -1, axis=0), 1)
        for x in range(5):
            for y in range(5):
                b[y, (2 * x + 3 * y) % 5] = turn(a[x, y] ^ d[x], _ROTATIONS[x][y])
        a = b ^ (~np.roll(b, -1, axis=0) & np.roll(b, -2, axis=0))
        a[0, 0] ^= constant
    return a


def keccak256(messages: list[bytes], pad: int = 1) -> list[bytes]:
    """The hash of each message; ``pad`` 1 is the original padding, as chains use it, and 6 that of the later standard."""
    padded = []
    for m in messages:
        block = bytearray(m + bytes([pad]) + bytes(-(len(m) + 1) % _RATE))
        block[-1] |= 0x80
        padded.append(bytes(block))
    blocks = np.array([len(p) // _RATE for p in padded], np.int64)
    state = np.zeros((5, 5, len(messages)), np.uint64)
    for k in range(int(blocks.max(initial=0))):
        on = np.flatnonzero(blocks > k)
        lanes = np.frombuffer(b"".join(padded[i][_RATE * k : _RATE * (k + 1)] for i in on), "<u8").reshape(len(on), -1)
        part = state[:, :, on]
        for i in range(lanes.shape[1]):
            part[i % 5, i // 5] ^= lanes[:, i]
        state[:, :, on] = _permute(part)
    out = np.ascontiguousarray(state[:4, 0].T.astype("<u8")).tobytes()
    return [out[32 * i : 32 * i + 32] for i in range(len(messages))]


def namehash(names: list[str | None]) -> list[str]:
    """The hash of each dotted name, from its last label to its first. Names that end alike share the work on what is alike."""
    labels = [n.split(".")[::-1] if n else [] for n in names]
    distinct = sorted({x for one in labels for x in one})
    own = dict(zip(distinct, keccak256([x.encode() for x in distinct]), strict=True))
    nodes: list[bytes] = [bytes(32)] * len(labels)
    for depth in range(max(map(len, labels), default=0)):
        at = [i for i, one in enumerate(labels) if len(one) > depth]
        parts = [nodes[i] + own[labels[i][depth]] for i in at]
        new = list(dict.fromkeys(parts))
        hashed = dict(zip(new, keccak256(new), strict=True))
        for i, p in zip(at, parts, strict=True):
            nodes[i] = hashed[p]
    return ["0x" + n.hex() for n in nodes]


def with_namehash(names: DataFrame, column: str = "name") -> DataFrame:
    """With ``namehash`` of the dotted name; there is no built-in of this hash, so Arrow batches go to numpy.

    Null and empty names have the hash of the root, 32 bytes of 0.
    """

    @F.pandas_udf("string")
    def hashed(s: pd.Series) -> pd.Series:
        return pd.Series(namehash([x or None for x in s]), index=s.index)

    return names.withColumn("namehash", hashed(F.col(column)))
