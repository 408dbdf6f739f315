"""Byte-level BPE: encoding and decoding with content-defined chunks that documents share.

Rolling-hash cuts depend on the bytes around them only, so a passage yields the same chunks wherever it stands.
Documents are dealt out by their smallest line hash, which brings copies together; a task keeps the encoded chunks
that it has met, up to a bound on their text, and encodes each of them once. A cut may split a token, so each join is
repaired: the text around it is encoded again over a window that doubles until its outer tokens agree with those of
both chunks. Tokens of which any two neighbours are what the encoder makes of both are what it makes of the whole, so
agreement at one token on either side is enough, also within a run of letters without a blank. Joins at which no window agrees are given up together, the chunks around them become one and are
encoded anew, until every join agrees exactly.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import OrderedDict
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: Fixed value: how byte-level BPE files of this family split text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts of these characters are split alike by both libraries, whatever Unicode version they know.
COMMON = re.compile(r"[\x00-ɏͰ-ϿЀ-ӿ‐-‧‰-⁞₠-₿]*\Z")


class Codec:
    """A tokenizer file of the ``tokenizers`` library; common text goes through ``tiktoken`` on the same vocabulary."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added, split, model = spec.get("added_tokens") or [], spec.get("pre_tokenizer") or {}, spec["model"]
        self.special, self.vocab = {t["content"]: t["id"] for t in added}, model["vocab"]
        #: Whether ``tiktoken`` does the same: bytes only, whole special strings, and merges in the order of their ids.
        self.plain = (
            spec.get("normalizer") is None and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
            and model.get("type", "BPE") == "BPE" and not model.get("dropout") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
            and not any(t.get(flag) for t in added for flag in ("lstrip", "rstrip", "single_word")) and self._ordered(model.get("merges") or [])
        )

    def _ordered(self, merges: list) -> bool:
        ids = [self.vocab.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in merges]
        return bool(ids) and None not in ids and all(a < b for a, b in zip(ids, ids[1:], strict=False))

    @cached_property
    def slow(self):
        from tokenizers import Tokenizer

        out = Tokenizer.from_file(self.path)
        out.no_truncation()
        out.no_padding()
        return out

    @cached_property
    def fast(self):
        import tiktoken

        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
        ranks = {bytes(byte[c] for c in t): i for t, i in self.vocab.items() if t not in self.special}
        return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)

    def encode(self, text: str) -> list[int]:
        if self.plain and COMMON.match(text):
            try:
                return self.fast.encode(text, allowed_special="all")
            except BaseException as e:  # its pattern engine gives up on very long runs: a panic, whose class can't be imported
                if type(e).__name__ != "PanicException":
                    raise
        return self.slow.encode(text, add_special_tokens=False).ids

    def decode_bytes(self, ids: list[int]) -> bytes:
        return self.fast.decode_bytes(ids) if self.plain else self.slow.decode(ids, skip_special_tokens=False).encode()

    @cached_property
    def lengths(self) -> np.ndarray:
        """Bytes of each token, by id."""
        out = np.zeros(max([0, *self.vocab.values(), *self.special.values()]) + 1, np.int32)
        for token in (*self.vocab.values(), *self.special.values()):
            out[token] = len(self.fast.decode_single_token_bytes(token))
        return out

    @cached_property
    def reach(self) -> int:
        """Bytes of the longest special string."""
        return max((len(t.encode()) for t in self.special), default=0)

    @cached_property
    def names(self) -> list[str]:
        """Each id in decimal."""
        return [str(i) for i in range(max([0, *self.vocab.values(), *self.special.values()]) + 1)]

    def listed(self, ids: list[int]) -> str:
        names = self.names
        return ",".join([names[i] for i in ids])


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def cuts(data: bytes, bits: int = 11, least: int = 512, most: int = 65536) -> list[int]:
    """Ends of the chunks of ``data``: where a hash of the last 16 bytes has ``bits`` zero bits, at characters."""
    n, out, last = len(data), [], 0
    if n > least:
        b = np.frombuffer(data, np.uint8)
        h = b.astype(np.uint64) + np.uint64(1)
        factor = 0x9E3779B97F4A7C15
        for width in (1, 2, 4, 8):
            h[width:] = h[width:] + h[:-width] * np.uint64(pow(factor, width, 2**64))
        h *= np.uint64(0xD6E8FEB86659FD93)
        found = np.flatnonzero((h[:-1] >> np.uint64(64 - bits) == 0) & (b[1:] & 0xC0 != 0x80)) + 1
        for p in found.tolist():
            while p - last > most:
                q = last + most
                while q > last and data[q] & 0xC0 == 0x80:
                    q -= 1
                out.append(last := q)
            if p - last >= least:
                out.append(last := p)
    return [*out, n]


#: Any text splits before a white-space character that follows another kind, for this pattern and special tokens.
SAFE = re.compile(rb"(?<=[!-~])[ \n](?=[!-~])")
#: Where text has few of these: a blank beside letters of any script, a place between letters and digits, within digits,
#: or within a run of letters whose last four no short form such as 've can hold. Only those that begin a token count.
INNER = regex.compile(r"(?<=[\p{L}\p{N}\p{M}!-~])(?=[ \n][\p{L}\p{N}!-~])|(?<=\p{L}{4})(?=\p{L})|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=[\p{L}\p{N}])")
#: A cut needs two safe points, or ``INNER_POINTS`` of the others, among so many bytes on either side.
NEAR, INNER_POINTS = 256, 4


def inner(data: bytes, low: int, high: int) -> list[int]:
    """Bytes of ``INNER`` points in a part of ``data``, which may begin and end within characters."""
    low += next((k for k in range(4) if low + k >= high or data[low + k] & 0xC0 != 0x80), 0)
    part = data[low:high].decode("utf-8", "ignore")
    points = np.frombuffer(part.encode("utf-32-le"), np.uint32)
    at = low + np.concatenate([[0], np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))])
    return [int(at[m.start()]) for m in INNER.finditer(part)]


class Chunk:
    """An encoded chunk and what its parts give, kept for the next document that holds it."""

    __slots__ = ("c", "data", "ids", "marks", "parts", "safe")

    def __init__(self, data: bytes, c: Codec):
        self.c, self.data, self.ids, self.marks, self.parts, self.safe = c, data, c.encode(data.decode()), None, {}, {}

    @property
    def starts(self) -> np.ndarray:
        """The byte at which each token begins, and the end."""
        if self.marks is None:
            self.marks = np.concatenate([[0], np.cumsum(self.c.lengths[np.array(self.ids, np.int32)])])
        return self.marks

    def point(self, k: int) -> tuple[int, int] | None:
        """Byte and token of the ``k``-th point from the start, or from the end where ``k`` is negative.

        A side with safe points near its end has only these; another has those inner ones that begin a token, so far
        from the end that no special string reaches from there to the join.
        """
        n, size, side, whole = abs(k), NEAR * abs(k), k > 0, len(self.data)

        def safe_points(size: int) -> list[int]:
            return [m.start() for m in (SAFE.finditer(self.data, 0, size) if side else SAFE.finditer(self.data, max(0, whole - size)))]

        if side not in self.safe:
            self.safe[side] = len(safe_points(NEAR)) > 1
        while True:
            if self.safe[side]:
                found = safe_points(size)
            else:
                low, high = (self.c.reach, size) if side else (whole - size, whole - self.c.reach)
                found = [p for p in inner(self.data, max(0, low - 32), min(whole, high)) if p >= low and self.token(p) is not None]
            if len(found) >= n:
                break
            if size >= whole:
                return None
            size *= 2
        byte = found[k - 1 if k > 0 else k]
        token = self.token(byte)
        return None if token is None else (byte, token)

    def token(self, byte: int) -> int | None:
        """The token that begins at a byte, if one does."""
        token = int(np.searchsorted(self.starts, byte))
        return token if token < len(self.starts) and self.starts[token] == byte else None

    def part(self, first: int, last: int) -> tuple[int, str, bytes]:
        """Number of tokens, decimal ids and bytes from one token to another."""
        if (first, last) not in self.parts:
            ids = self.ids[first:last]
            self.parts[first, last] = len(ids), self.c.listed(ids), self.c.decode_bytes(ids)
        return self.parts[first, last]


def repair(left: Chunk, right: Chunk) -> tuple[int, int, list[int]] | None:
    """The token of ``left`` at which a window over the join begins, that of ``right`` at which it ends, and its own.

    The window reaches ``width`` + 1 safe points to each side, and what it gives for the outermost of these must be
    what the chunks have there; else the width doubles. None if the chunks end before that.
    """
    width = 1
    while True:
        ends = left.point(-width - 1), left.point(-width), right.point(width), right.point(width + 1)
        if None in ends:
            return None
        (a, la), (_, lb), (_, ra), (b, rb) = ends
        got = left.c.encode((left.data[a:] + right.data[:b]).decode())
        head, foot = left.ids[la:lb], right.ids[ra:rb]
        if len(got) >= len(head) + len(foot) and got[: len(head)] == head and got[len(got) - len(foot) :] == foot:
            return la, rb, got
        width *= 2


class Encoder:
    """Encodes texts one after another; keeps chunks of up to ``limit`` bytes of text, least recently used first out."""

    def __init__(self, path: str, limit: int = 16 << 20):
        self.c, self.limit, self.held, self.kept = codec(path), limit, 0, OrderedDict()
        self.encoded = self.reused = 0

    def chunk(self, data: bytes) -> Chunk:
        got = self.kept.get(data)
        if got is None:
            got = self.kept[data] = Chunk(data, self.c)
            self.encoded += 1
            self.held += len(data)
            while self.held > self.limit and len(self.kept) > 1:
                self.held -= len(self.kept.popitem(last=False)[0])
        else:
            self.reused += 1
            self.kept.move_to_end(data)
        return got

    def pieces(self, text: str) -> list[tuple[Chunk, int, int] | list[int]]:
        """The text as parts of chunks, from one token to another, and tokens of repaired joins, in order."""
        data = text.encode()
        ends, spread = (cuts(data) if self.c.plain else [len(data)]), 1
        enough = lambda a, b: len(SAFE.findall(data, a, b)) > 1 or len(inner(data, a, min(b, len(data)))) >= INNER_POINTS
        ends = [e for e in ends[:-1] if enough(max(0, e - NEAR), e) and enough(e, e + NEAR)] + ends[-1:]
        while True:
            parts = [self.chunk(data[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
            joints = [repair(x, y) for x, y in zip(parts, parts[1:], strict=False)]
            failed = {i for i, j in enumerate(joints) if j is None}
            # the windows of two joins must not overlap in the chunk between them
            failed |= {i for i in range(1, len(joints)) if joints[i] and joints[i - 1] and joints[i - 1][1] > joints[i][0]}
            if not failed:
                break
            gone = {i + k for i in failed for k in range(1 - spread, spread)}
            ends, spread = [e for i, e in enumerate(ends) if i not in gone or i == len(ends) - 1], 2 * spread
        out: list = []
        for i, part in enumerate(parts):
            out.append((part, joints[i - 1][1] if i else 0, joints[i][0] if i < len(joints) else len(part.ids)))
            if i < len(joints):
                out.append(joints[i][2])
        return out

    def ids(self, text: str) -> list[int]:
        out: list[int] = []
        for piece in self.pieces(text):
            out += piece if isinstance(piece, list) else piece[0].ids[piece[1] : piece[2]]
        return out

    def digests(self, text: str) -> tuple[int, str, str]:
        """Tokens, SHA-256 of the decimal ids joined by commas, SHA-256 of the decoded text."""
        n, listed, decoded = 0, [], hashlib.sha256()
        for piece in self.pieces(text):
            k, names, data = (len(piece), self.c.listed(piece), self.c.decode_bytes(piece)) if isinstance(piece, list) else piece[0].part(*piece[1:])
            if k:
                n += k
                listed.append(names)
                decoded.update(data)
        return n, hashlib.sha256(",".join(listed).encode()).hexdigest(), decoded.hexdigest()


def _dealt(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id and text, copies near each other; Spark splits what a hot group makes too large."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    key = F.array_min(F.transform(F.split("text", "\n", -1), lambda x: F.xxhash64(x)))
    return rows.withColumn("near", key).hint("rebalance", "near").select("doc_id", "text")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids``, the tokens of each row's whole text; a null text counts as empty and has none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = Encoder(path)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "ids": [e.ids(t) for t in b["text"]]})

    out = _dealt(docs, id_col, text_col)
    return out.mapInPandas(run, f"doc_id {out.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id`` and ``text`` from tokens; null tokens give an empty text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(path)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "text": [c.decode_bytes([int(i) for i in x] if x is not None else []).decode("utf-8", "replace") for x in b["ids"]]})

    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInPandas(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    A null text counts as empty: no tokens, and the digests of nothing. Repeated rows are encoded once in a task and
    returned as often as they came; an empty table gives an empty result; other columns are ignored. Texts of any
    length and script are cut into chunks; one without letters, digits and blanks is encoded whole.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = Encoder(path)
        for b in batches:
            rows = [e.digests(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_tokens": [r[0] for r in rows], "ids_sha256": [r[1] for r in rows], "decoded_sha256": [r[2] for r in rows]})

    out = _dealt(docs, id_col, text_col)
    return out.mapInPandas(run, f"doc_id {out.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
