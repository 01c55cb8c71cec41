"""Byte-level BPE: encoding by rounds over padded numpy matrices, and decoding.

A text is split by the vocabulary's pattern; matches that are no token
themselves go into matrices, one row per match, bucketed by length. In each
round every row finds its leftmost pair of minimum rank, merges it, and closes
the gap; rows without a mergeable pair leave the matrix. Ranks of pairs come
from an open-addressing hash table. After a merge only the two pairs beside
it are looked up again.

Matches longer than ``LONGEST_ROW`` bytes would make rounds over long rows
quadratic; they merge through a heap of pairs instead, with the same result.

Tables of the vocabulary (about 10 MB, its size is fixed) are broadcast; a
task keeps a bounded memory of matches that it has seen. No shuffle.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroframe.llm.common import named, sliced, texts_and_ids

LONGEST_ROW = 1024
REMEMBERED = 200_000
MATCHES_AT_ONCE = 400_000
NO_RANK = np.int32(2**31 - 1)
MIX_LEFT, MIX_RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank, which is its id, a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def vocabulary_tables(ranks: dict[bytes, int]) -> dict[str, np.ndarray]:
    """The vocabulary as plain arrays: token bytes and their places for
    decoding, the ids of single bytes, and the hash table of pairs."""
    size = max(ranks.values()) + 1
    tokens = [b""] * size
    for token, rank in ranks.items():
        tokens[rank] = token
    lengths = np.array([len(t) for t in tokens], np.int64)
    pairs = {}
    for token, rank in ranks.items():
        for at in range(1, len(token)):
            left, right = ranks.get(token[:at]), ranks.get(token[at:])
            if left is not None and right is not None:
                pairs[left << 32 | right] = rank
    keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
    values = np.fromiter(pairs.values(), np.int32, len(pairs))
    slots = 1 << max(4, (4 * len(pairs)).bit_length())
    table, found = np.full(slots, -1, np.int64), np.full(slots, NO_RANK, np.int32)
    at, todo = slot_of(keys >> 32, keys & 0xFFFFFFFF, slots), np.arange(len(keys))
    while len(todo):
        free = table[at[todo]] == -1
        first = todo[free][np.unique(at[todo[free]], return_index=True)[1]]
        table[at[first]], found[at[first]] = keys[first], values[first]
        todo = np.setdiff1d(todo, first, assume_unique=True)
        at[todo] = (at[todo] + 1) & (slots - 1)
    return {"blob": np.frombuffer(b"".join(tokens), np.uint8), "token_start": np.concatenate([[0], np.cumsum(lengths)[:-1]]),
            "token_bytes": lengths, "byte_ids": np.array([ranks[bytes([b])] for b in range(256)], np.int32),
            "pair_keys": table, "pair_ranks": found}


def slot_of(left: np.ndarray, right: np.ndarray, slots: int) -> np.ndarray:
    mixed = (left.astype(np.uint64) + np.uint64(1)) * MIX_LEFT ^ (right.astype(np.uint64) + np.uint64(1)) * MIX_RIGHT
    return ((mixed ^ (mixed >> np.uint64(29))) * MIX_LEFT >> np.uint64(40)).astype(np.int64) & (slots - 1)


def spread_ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The indexes start[0], start[0] + 1, ... of all ranges one after another."""
    ends = np.cumsum(length)
    return np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    """Encodes and decodes with the tables of ``vocabulary_tables``."""

    def __init__(self, tables: dict[str, np.ndarray], pattern: str) -> None:
        self.t, self.find = tables, regex.compile(pattern)
        blob, start, size = tables["blob"].tobytes(), tables["token_start"], tables["token_bytes"]
        self.whole = {blob[s:s + n]: i for i, (s, n) in enumerate(zip(start.tolist(), size.tolist())) if n}
        self.forget()

    def forget(self) -> None:
        self.seen: dict[str, int] = {}
        self.flat, self.start, self.length = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks (also the merged ids) of pairs; NO_RANK where there is none."""
        table, ranks = self.t["pair_keys"], self.t["pair_ranks"]
        out = np.full(len(left), NO_RANK, np.int32)
        key = left.astype(np.int64) << 32 | right
        at, todo = slot_of(left, right, len(table)), np.arange(len(left))
        while len(todo):
            held = table[at]
            hit = held == key
            out[todo[hit]] = ranks[at[hit]]
            on = ~hit & (held != -1)
            todo, key, at = todo[on], key[on], (at[on] + 1) & (len(table) - 1)
        return out

    def merge_rows(self, rows: list[bytes], width: int) -> list[np.ndarray]:
        """Ids of byte strings of at most ``width`` bytes, by rounds."""
        n = len(rows)
        size = np.fromiter(map(len, rows), np.int64, n)
        ids = np.full((n, width + 1), -1, np.int32)  # the last column stays a pad
        cols = np.arange(width + 1)
        ids[cols < size[:, None]] = self.t["byte_ids"][np.frombuffer(b"".join(rows), np.uint8)]
        rank = np.full((n, width + 1), NO_RANK, np.int32)  # of the pair that begins here
        real = cols < size[:, None] - 1
        r, c = np.nonzero(real)
        rank[r, c] = self.pair_rank(ids[r, c], ids[r, c + 1])
        out: list[np.ndarray | None] = [None] * n
        where = np.arange(n)
        while len(where):
            at = rank.argmin(axis=1)  # the leftmost minimum
            row = np.arange(len(where))
            best = rank[row, at]
            done = best == NO_RANK
            if done.any():
                for i in np.flatnonzero(done):
                    out[where[i]] = ids[i, :size[i]].copy()
                go = ~done
                where, ids, rank, size, at, best = where[go], ids[go], rank[go], size[go], at[go], best[go]
                if not len(where):
                    break
                row = np.arange(len(where))
            size = size - 1
            most = int(size.max()) + 1
            shift = cols[:most][None, :] + (cols[:most][None, :] > at[:, None])  # close the gap
            ids, rank = np.take_along_axis(ids, shift, 1), np.take_along_axis(rank, shift, 1)
            ids[row, at] = best
            ids[cols[:most] >= size[:, None]] = -1
            rank[row, at] = NO_RANK
            has_next = np.flatnonzero(at + 1 < size)
            rank[has_next, at[has_next]] = self.pair_rank(ids[has_next, at[has_next]], ids[has_next, at[has_next] + 1])
            has_before = np.flatnonzero(at > 0)
            rank[has_before, at[has_before] - 1] = self.pair_rank(ids[has_before, at[has_before] - 1], ids[has_before, at[has_before]])
        return out

    def merge_long(self, row: bytes) -> np.ndarray:
        """The same merges for one long byte string, through a heap of pairs."""
        ids = self.t["byte_ids"][np.frombuffer(row, np.uint8)]
        n = len(ids)
        ranks = self.pair_rank(ids[:-1], ids[1:])
        ids, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(ranks.tolist()) if r != NO_RANK]
        heapq.heapify(heap)

        def rank_of(i: int, j: int) -> None:
            r = int(self.pair_rank(np.array([ids[i]]), np.array([ids[j]]))[0])
            if r != NO_RANK:
                heapq.heappush(heap, (r, i, ids[i], ids[j]))

        while heap:
            r, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # one side has merged since
            ids[i], ids[j] = r, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                rank_of(i, after[j])
            if before[i] >= 0:
                rank_of(before[i], i)
        return np.array([x for x in ids if x >= 0], np.int32)

    def learn(self, matches: set[str]) -> None:
        """Encode matches that are not remembered yet."""
        if len(self.seen) + len(matches) > REMEMBERED:
            self.forget()
        names = list(matches)
        out: list = [None] * len(names)
        buckets: dict[int, list[int]] = {}
        raw = [m.encode() for m in names]
        for i, b in enumerate(raw):
            token = self.whole.get(b)
            if token is not None:
                out[i] = np.array([token], np.int32)
            elif len(b) > LONGEST_ROW:
                out[i] = self.merge_long(b)
            else:
                width = 4
                while width < len(b):
                    width *= 2
                buckets.setdefault(width, []).append(i)
        for width, rows in buckets.items():
            step = max(1, (1 << 20) // width)
            for at in range(0, len(rows), step):
                part = rows[at:at + step]
                for i, ids in zip(part, self.merge_rows([raw[i] for i in part], width)):
                    out[i] = ids
        length = np.fromiter(map(len, out), np.int64, len(out))
        start = len(self.flat) + np.cumsum(length) - length
        self.seen.update(zip(names, range(len(self.seen), len(self.seen) + len(names))))
        self.flat = np.concatenate([self.flat, *out])
        self.start, self.length = np.concatenate([self.start, start]), np.concatenate([self.length, length])

    def encode_matches(self, matches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all matches one after another, number of ids of each match)."""
        distinct = set(matches)
        new = distinct.difference(self.seen)
        if new:
            if len(self.seen) + len(new) > REMEMBERED:
                self.forget()
                new = distinct
            self.learn(new)
        at = np.fromiter(map(self.seen.__getitem__, matches), np.int64, len(matches))
        count = self.length[at]
        return self.flat[spread_ranges(self.start[at], count)], count

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (little-endian unsigned 32-bit) of each text. Long texts go
        through in steps of a bounded number of matches."""
        if sum(map(len, texts)) > 8 * MATCHES_AT_ONCE:
            if len(texts) > 1:
                return [ids for text in texts for ids in self.encode([text])]
            found, parts = (m.group() for m in self.find.finditer(texts[0])), []
            while step := list(islice(found, MATCHES_AT_ONCE)):
                parts.append(self.encode_matches(step)[0].astype("<u4"))
            return [np.concatenate(parts)]
        each = [self.find.findall(t) for t in texts]
        ids, count = self.encode_matches(list(chain.from_iterable(each)))
        ends = np.concatenate([[0], np.cumsum(count)])[np.cumsum([0, *map(len, each)])]
        ids = ids.astype("<u4")
        return [ids[a:b] for a, b in zip(ends, ends[1:])]

    def decode(self, ids: np.ndarray) -> bytes:
        start, size = self.t["token_start"][ids], self.t["token_bytes"][ids]
        return self.t["blob"][spread_ranges(start, size)].tobytes()


def encode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): every text's token ids, as the bytes of little-endian
    unsigned 32-bit integers. Null and empty texts have no ids; special tokens
    are ordinary text; every row gives a row. Other columns are not read."""
    rows = texts_and_ids(df, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    tables = df.sparkSession.sparkContext.broadcast(vocabulary_tables(read_ranks(ranks_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Encoder(tables.value, pattern)
        for batch in sliced(batches, "text", 2 << 20):
            ids = [x.tobytes() for x in codec.encode(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {id_type}, ids binary")


def decode(df: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with ``out_col`` (which replaces a column of that name): the bytes
    of the tokens. Null ids decode to null."""
    keep = [c for c in df.columns if c != out_col]
    schema = df.select(*map(named, keep)).withColumn(out_col, F.lit(b"")).schema
    schema[out_col].nullable = True
    tables = df.sparkSession.sparkContext.broadcast(vocabulary_tables(read_ranks(ranks_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Encoder(tables.value, pattern)
        for batch in sliced(batches, ids_col, 4 << 20):
            out = [None if x is None else codec.decode(np.frombuffer(x, "<u4")) for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(out, pa.binary())], [*keep, out_col])

    return df.select(*map(named, keep)).mapInArrow(run, schema)
