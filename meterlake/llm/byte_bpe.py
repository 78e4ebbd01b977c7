"""Byte-level BPE encoding and decoding in padded numpy matrices.

A batch's texts are cut into pieces; the distinct pieces that no earlier batch of
the task has seen are put into matrices of one width class each (padded rows of
token ids).  In every round each row merges its leftmost pair of least rank; the
rank of a pair comes from a hash table; merged rows are compacted and finished
rows leave the matrix.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import text_of

# Distinct spans a task remembers; beyond it (and the batch at hand) it starts anew.
CACHE_SPANS = 200_000
# Cells of one matrix: bounds a task's memory.
MATRIX_CELLS = 1 << 20
# A row wider than this is merged with a heap instead: the matrix form needs a
# round per merge and time in the square of the width.
MATRIX_WIDTH = 1024
_NONE = np.int64(1 << 40)
# Patterns known to begin a match at every lone space between two non-spaces.
SPACE_SAFE = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""",
)
UNEVEN = re.compile(r"\s | \s|^ | \Z")
LONE = re.compile(r"(?<=\S) (?=\S)")


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file (read where the call runs)."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return ranks


class PairTable:
    """Open-addressing hash table from a pair of ids to the id of their merge."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = [(ranks[token[:k]], ranks[token[k:]], rank) for token, rank in ranks.items()
                 for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks]
        left, right, merged = (np.array(x, dtype=np.int64) for x in zip(*pairs, strict=True)) if pairs else (
            np.empty(0, np.int64),) * 3
        self.bits = max(4, int(2 * max(1, len(pairs))).bit_length() + 1)
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, _NONE, dtype=np.int64)
        keys = (left << 24) | right
        slot, todo = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = todo[self.keys[slot[todo]] < 0]
            self.keys[slot[free]] = keys[free]  # of several for a slot, the last one stays
            done = self.keys[slot[todo]] == keys[todo]
            self.values[slot[todo[done]]] = merged[todo[done]]
            todo = todo[~done]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the merges, elementwise; _NONE where the pair has none."""
        keys = (left << 24) | right
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.values[slot], _NONE)
        open_ = np.flatnonzero((self.keys[slot] != keys).ravel() & (self.keys[slot] >= 0).ravel())
        flat, keys = out.ravel(), keys.ravel()
        slot = slot.ravel()[open_]
        for _ in range(self.probes):
            if not len(open_):
                break
            slot = (slot + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot]
            hit = found == keys[open_]
            flat[open_[hit]] = self.values[slot[hit]]
            more = ~hit & (found >= 0)
            open_, slot = open_[more], slot[more]
        return flat.reshape(out.shape)


class ByteBpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.apart = pattern in SPACE_SAFE
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.table = PairTable(ranks)
        self.cache: dict[str, bytes] = {}

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as bytes; pieces of one width class share matrices."""
        out = [b""] * len(pieces)
        classes: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(piece) > MATRIX_WIDTH:
                out[i] = self._by_heap(piece)
            elif len(piece) < 2:
                out[i] = self.byte_ids[list(piece)].astype("<u4").tobytes()
            else:
                classes.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
        for width, members in classes.items():
            rows = max(1, MATRIX_CELLS // width)
            for at in range(0, len(members), rows):
                part = members[at:at + rows]
                for i, ids in zip(part, self._by_matrix([pieces[i] for i in part]), strict=True):
                    out[i] = ids
        return out

    def _by_matrix(self, pieces: list[bytes]) -> list[bytes]:
        lengths = np.array([len(p) for p in pieces])
        width = int(lengths.max())
        grid = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8).reshape(len(pieces), width)
        ids = self.byte_ids[grid]
        merged = self.table.merge(ids[:, :-1], ids[:, 1:])
        columns = np.arange(width)
        merged[columns[None, 1:] >= lengths[:, None]] = _NONE
        rows, done = np.arange(len(pieces)), [b""] * len(pieces)
        while True:
            at = merged.argmin(axis=1) if merged.shape[1] else np.zeros(len(rows), dtype=np.int64)
            live = (merged[np.arange(len(rows)), at] < _NONE) if merged.shape[1] else np.zeros(len(rows), dtype=bool)
            if not live.all():  # finished rows leave
                over = ids[~live].astype("<u4")
                for row, full, n in zip(rows[~live].tolist(), over, lengths[~live].tolist(), strict=True):
                    done[row] = full[:n].tobytes()
                ids, merged, lengths, rows, at = ids[live], merged[live], lengths[live], rows[live], at[live]
                if not len(rows):
                    return done
                width = int(lengths.max())  # and the padding that only they needed
                ids, merged = ids[:, :width], merged[:, :width - 1]
            width, n = ids.shape[1], np.arange(len(rows))
            ids[n, at] = merged[n, at]
            # compaction: drop the right half of the merged pair
            step = np.arange(width - 1)[None, :] > at[:, None]
            ids = np.where(step, ids[:, 1:], ids[:, :-1])
            if width > 2:
                # pair k moves from k + 1 right of the merge; the two beside it change
                step = np.arange(width - 2)[None, :] >= at[:, None]
                merged = np.where(step, merged[:, 1:], merged[:, :-1])
                lengths = lengths - 1
                right = np.flatnonzero(at + 1 < lengths)
                if len(right):
                    merged[right, at[right]] = self.table.merge(ids[right, at[right]], ids[right, at[right] + 1])
                left = np.flatnonzero(at > 0)
                if len(left):
                    merged[left, at[left] - 1] = self.table.merge(ids[left, at[left] - 1], ids[left, at[left]])
                end = np.flatnonzero(at + 1 >= lengths)
                inside = end[at[end] < width - 2]
                merged[inside, at[inside]] = _NONE
            else:
                lengths, merged = lengths - 1, merged[:, :0]

    def _by_heap(self, piece: bytes) -> bytes:
        """The same merges for a very wide row, in n log n steps."""
        import heapq

        ids = [int(x) for x in self.byte_ids[np.frombuffer(piece, dtype=np.uint8)]]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.table.merge(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(int(r), i) for i, r in enumerate(first) if r < _NONE]
        heapq.heapify(heap)
        rank_at = {i: r for r, i in heap}

        def renew(i: int) -> None:
            j = after[i]
            rank_at.pop(i, None)
            if j < n:
                r = self.ranks.get(self.bytes_of[ids[i]] + self.bytes_of[ids[j]])
                if r is not None:
                    rank_at[i] = r
                    heapq.heappush(heap, (r, i))

        while heap:
            rank, i = heapq.heappop(heap)
            if rank_at.get(i) != rank:
                continue
            j = after[i]
            ids[i], after[i] = rank, after[j]
            if after[j] < n:
                before[after[j]] = i
            rank_at.pop(j, None)
            ids[j] = -1
            renew(i)
            if before[i] >= 0:
                renew(before[i])
        return np.array([x for x in ids if x >= 0], dtype="<u4").tobytes()

    def spans(self, text: str) -> list[str]:
        """The text in spans that no match crosses; every span but the first has
        lost the space before it.  A lone space between two non-spaces begins a
        match of a ``SPACE_SAFE`` pattern, so such a text may be cut there; spans
        that come again need no second look."""
        if not self.apart:
            return [text]
        return LONE.split(text) if UNEVEN.search(text) else text.split(" ")

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        cut = [self.spans(text) for text in texts]
        firsts = [spans.pop(0) for spans in cut]
        if len(self.cache) > CACHE_SPANS:
            self.cache = {}
        cache = self.cache
        new = list(set().union(*cut).difference(cache))
        pieces = [self.pattern.findall(" " + span) for span in new] + [self.pattern.findall(x) for x in firsts]
        distinct = list(set().union(*pieces))
        ids = dict(zip(distinct, self.encode_pieces([p.encode("utf-8") for p in distinct]), strict=True))
        for span, found in zip(new, pieces):
            cache[span] = b"".join(map(ids.__getitem__, found))
        return [np.frombuffer(b"".join([*map(ids.__getitem__, found), *map(cache.__getitem__, spans)]), dtype="<u4")
                for found, spans in zip(pieces[len(new):], cut, strict=True)]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


def _slices(texts: list[str], most: int = 4 << 20) -> Iterator[list[str]]:
    """Runs of texts of about ``most`` characters."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _encoded(bpe: ByteBpe, texts: list[str], keep_ids: bool) -> pd.DataFrame:
    ids = bpe.encode_batch(texts)
    out = {"n_tokens": [len(x) for x in ids],
           "ids_sha256": [hashlib.sha256(x.tobytes()).hexdigest() for x in ids],
           "decoded_sha256": [hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids]}
    if keep_ids:
        out["ids"] = [x.astype(np.int32) for x in ids]
    return pd.DataFrame(out)


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_column: str = "doc_id", text_column: str = "text",
           keep_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and (``keep_ids``) ids of every row.

    ``vocabulary``: path of the ranks on the driver; they are sent to the tasks.
    ids_sha256 is over the ids as little-endian unsigned 32-bit integers,
    decoded_sha256 over the bytes decoded from the ids.  Null texts count as
    empty (no ids); texts of any length are encoded whole; repeated rows give
    repeated results; other columns are ignored.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(vocabulary))  # fixed size: the vocabulary
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if keep_ids else "")

    @F.pandas_udf(fields)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = ByteBpe(ranks.value, pattern)
        for part in parts:
            yield pd.concat([_encoded(bpe, some, keep_ids) for some in _slices(part.tolist())], ignore_index=True)

    return docs.select(F.col(id_column).alias("doc_id"), run(text_of(text_column)).alias("r")).select("doc_id", "r.*")


def decode(encoded: DataFrame, vocabulary: str, id_column: str = "doc_id") -> DataFrame:
    """doc_id, text of every row of ids; invalid UTF-8 becomes the replacement character."""
    spark = encoded.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(vocabulary))

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = {i: b for b, i in ranks.value.items()}
        for part in parts:
            yield pd.Series([b"".join([of[i] for i in ids]).decode("utf-8", "replace") if ids is not None else "" for ids in part])

    return encoded.select(F.col(id_column).alias("doc_id"), run("ids").alias("text"))
