"""Importance resampling towards a target: hashed word n-gram features, their
buckets found by length-bucketed CRC matrices, and a Gumbel draw.

A batch of texts becomes one byte array; words are found with array operations
and written one space apart, so that every run of consecutive words is a slice
of that array. Distinct runs are grouped by their length into two-dimensional
uint8 arrays, all CRCs of a group are updated column by column, and the buckets
are scattered back to where the runs stand. Runs longer than ``PART`` bytes go
through the same matrices in parts, which are folded together (a CRC is linear
in its state), so a word of a megabyte costs no loop over its bytes.

Texts are read once; what is kept of them is a row with its features' buckets.
Bucket counts of both sides (``buckets`` numbers each, whatever the input) meet
on the driver, where the gains are worked out. The draw needs no global sort:
scores are whole numbers, of which there are some ten thousand, so the rows
before a score are counted per score and only rows of one score are sorted.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metroframe.llm.common import sliced, stored, texts_and_ids

BUCKETS = 10_000
MAX_WORDS = 2
#: documents of fewer words are not drawn
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
#: bytes of text handled at once, and of a feature's part
SEGMENT, PART = 2 << 20, 512
BREAK = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = np.zeros(256, bool)
IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


TABLE = crc_table()


def update(state: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """CRC states after the bytes of the rows of ``matrix``, column by column."""
    for column in np.ascontiguousarray(matrix.T):
        state = TABLE[(state ^ column) & np.uint32(0xFF)] ^ (state >> np.uint32(8))
    return state


#: what PART zero bytes make of each bit of a state
SKIP = update(np.uint32(1) << np.arange(32, dtype=np.uint32), np.zeros((32, PART), np.uint8))


def skip_part(state: int) -> int:
    bits = (np.uint32(state) >> np.arange(32, dtype=np.uint32)) & np.uint32(1)
    return int(np.bitwise_xor.reduce(SKIP[bits.astype(bool)], initial=np.uint32(0)))


def crcs(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of each slice of ``data``."""
    out = np.empty(len(start), np.uint32)

    def states(where: np.ndarray, first: np.ndarray, size: int, state: int) -> None:
        step = max(1, (4 << 20) // max(size, 1))
        for at in range(0, len(where), step):
            rows = where[at:at + step]
            out[rows] = update(np.full(len(rows), state, np.uint32), data[first[at:at + step, None] + np.arange(size)])

    order = np.argsort(length, kind="stable")
    sizes, begin = np.unique(length[order], return_index=True)
    for size, where in zip(sizes.tolist(), np.split(order, begin[1:])):
        if size <= PART:
            states(where, start[where], size, 0xFFFFFFFF)
            continue
        states(where, start[where], size % PART, 0xFFFFFFFF)
        for i in where.tolist():
            state, at, end = int(out[i]), int(start[i]) + size % PART, int(start[i]) + size
            parts = np.concatenate([update(np.zeros(min(1024, (end - a) // PART), np.uint32), data[a:min(a + 1024 * PART, end)].reshape(-1, PART))
                                    for a in range(at, end, 1024 * PART)])
            for part in parts.tolist():
                state = skip_part(state) ^ part
            out[i] = state
    return ~out


def distinct_words(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each word's distinct form, a place of each form)."""
    form, place, n = np.empty(len(start), np.int64), [], 0
    order = np.argsort(length, kind="stable")
    sizes, begin = np.unique(length[order], return_index=True)
    for size, where in zip(sizes.tolist(), np.split(order, begin[1:])):
        rows = np.ascontiguousarray(data[start[where, None] + np.arange(size)]).view(f"S{size}").ravel()
        _, first, which = np.unique(rows, return_index=True, return_inverse=True)
        form[where] = which.ravel() + n
        place.append(where[first])
        n += len(first)
    return form, np.concatenate(place) if place else np.empty(0, np.int64)


class Features:
    """Buckets of the runs of 1 to ``max_words`` words of texts."""

    def __init__(self, buckets: int, max_words: int) -> None:
        self.buckets, self.max_words = buckets, max_words
        self.dtype = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def of(self, texts: list[bytes], carried: int = 0) -> tuple[np.ndarray, list[list[np.ndarray]], list[bytes]]:
        """(words of each text, its buckets per run length, the last words).
        Runs that end within the first ``carried`` words are left out."""
        data = LOWER[np.frombuffer(b"\0".join([*texts, b""]), np.uint8)]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], IN_WORD[data], [False]]).view(np.int8)))
        begin, length = edges[::2], edges[1::2] - edges[::2]
        text_end = np.cumsum([len(t) + 1 for t in texts])
        text = np.searchsorted(text_end, begin, side="right")
        # the words one space apart
        start = np.cumsum(length + 1) - (length + 1)
        spaced = np.full(int((length + 1).sum()), 32, np.uint8)
        spread = np.repeat(begin - start, length) + (into := np.repeat(start - (np.cumsum(length) - length), length) + np.arange(int(length.sum())))
        spaced[into] = data[spread]
        form, place = distinct_words(spaced, start, length)
        run, out = form, []
        for n in range(1, self.max_words + 1):
            if n > 1:
                # runs of n words: a run of n - 1 words and the form of the next
                whole = np.flatnonzero(text[:-1] == text[1:]) if n == 2 else whole[np.isin(whole + 1, previous)]
                previous = whole
                key = run_at[whole] * (len(form) + 1) + form[whole + n - 1]
                _, place, run = np.unique(key, return_index=True, return_inverse=True)
                place, run = whole[place], run.ravel()
            else:
                whole = previous = np.arange(len(form))
            run_at = np.zeros(len(form), np.int64)
            run_at[whole] = run
            size = start[place + n - 1] + length[place + n - 1] - start[place]
            bucket = (crcs(spaced, start[place], size) % np.uint32(self.buckets)).astype(self.dtype)[run]
            new = whole + n - 1 >= carried
            ends = np.searchsorted(text[whole[new]], np.arange(len(texts) + 1))
            out.append((bucket[new], ends))
        words = np.bincount(text, minlength=len(texts))
        last = [spaced[s:s + k].tobytes() for s, k in zip(start[len(start) - self.max_words + 1:], length[len(start) - self.max_words + 1:])] if self.max_words > 1 else []
        return words, [[b[e[i]:e[i + 1]] for b, e in out] for i in range(len(texts))], last

    def long(self, text: bytes) -> tuple[int, list[np.ndarray]]:
        """(words, buckets) of a long text, a segment at a time; the last words
        of a segment are carried into the next one."""
        n, parts, held, at = 0, [], [], 0
        while at < len(text):
            end = min(at + SEGMENT, len(text))
            if end < len(text):
                m = BREAK.search(text, end)
                end = m.start() if m else len(text)
            words, buckets, last = self.of([b" ".join([*held, text[at:end]])], len(held))
            n += int(words[0]) - len(held)
            parts += buckets[0]
            held, at = last, end
        return n, parts

    def batch(self, texts: list[bytes]) -> list[tuple[int, bytes]]:
        if len(texts) == 1 and len(texts[0]) > SEGMENT:
            n, parts = self.long(texts[0])
            return [(n, b"".join(p.tobytes() for p in parts))]
        words, buckets, _ = self.of(texts)
        return [(int(n), b"".join(p.tobytes() for p in parts)) for n, parts in zip(words, buckets)]


def featurized(df: DataFrame, id_col: str, text_col: str, buckets: int, max_words: int) -> DataFrame:
    """(doc_id, text_key, n_words, features): the features' buckets as the
    bytes of little-endian unsigned integers of 16 bits (32 with more than
    65,536 buckets)."""
    rows = texts_and_ids(df, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Features(buckets, max_words)
        for batch in sliced(batches, "text", SEGMENT):
            found = find.batch(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array([n for n, _ in found], pa.int64()), pa.array([b for _, b in found], pa.binary())],
                ["doc_id", "text_key", "n_words", "features"])

    return rows.mapInArrow(run, f"doc_id {id_type}, text_key long, n_words long, features binary")


def bucket_counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs in all ``rows``: one array of that size a
    task is shuffled, one comes to the driver."""
    dtype = Features(buckets, 1).dtype

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for cell in batch.column("features"):
                total += np.bincount(np.frombuffer(cell.as_buffer(), dtype), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in rows.select("features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of the two smoothed shares, floored."""
    k = len(raw)
    s_all, t_all = float(int(raw.sum()) + k), float(int(target.sum()) + k)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def gumbel(seed: int, doc_id) -> int:
    """A thousand times a Gumbel number fixed by the seed and the id, floored."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", percent: int = PERCENT,
             least_words: int = LEAST_WORDS, buckets: int = BUCKETS, max_words: int = MAX_WORDS, seed: int = SEED) -> DataFrame:
    """One row per row of ``df``: doc_id, n_words, n_features, weight, score,
    rank (null: not drawn).

    ``weight`` is the floored mean gain of the text's features, 0 without any;
    ``score`` adds the Gumbel number of the id. Of the documents of at least
    ``least_words`` words floor(percent * N / 100) of the highest scores are
    drawn, ties to the smaller id (nulls last), then to the smaller text hash.
    Rows equal in id and text are one document: they count once in N and share
    a rank, but all rows count in the bucket counts. Null and empty texts have
    no features; a null id draws its number from the empty id; an empty table
    or target gives counts of 0. Other columns are not read."""
    rows = stored(featurized(df, id_col, text_col, buckets, max_words), "features")
    # the target's texts need no ids
    aims = featurized(target.select(F.lit(0).alias("i"), F.col("`" + target_text_col.replace("`", "``") + "`").alias("t")), "i", "t", buckets, max_words)
    gains = df.sparkSession.sparkContext.broadcast(bucket_gains(bucket_counts(rows, buckets), bucket_counts(aims, buckets)))  # `buckets` numbers
    dtype = Features(buckets, 1).dtype

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = gains.value
        for batch in batches:
            features, weights, scores = [], [], []
            for cell, doc in zip(batch.column("features"), batch.column("doc_id").to_pylist()):
                own = np.frombuffer(cell.as_buffer(), dtype)
                features.append(len(own))
                weights.append(int(g[own].sum()) // len(own) if len(own) else 0)
                scores.append(weights[-1] + gumbel(seed, doc))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "text_key", "n_words")), *(pa.array(x, pa.int64()) for x in (features, weights, scores))],
                                             ["doc_id", "text_key", "n_words", "n_features", "weight", "score"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    scored = stored(rows.mapInArrow(run, f"doc_id {id_type}, text_key long, n_words long, n_features long, weight long, score long"), "scored")
    able = stored(scored.where(F.col("n_words") >= least_words).select("doc_id", "text_key", "score").distinct(), "able")
    # a row per score, a whole number within some tens of thousands
    down = Window.orderBy(F.desc("score"))
    counts = able.groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("score", (F.sum("n").over(down) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy()).alias("all"))
    quota = F.expr(f"({int(percent)} * all) div 100")
    within = Window.partitionBy("score").orderBy(F.col("doc_id").isNull(), "doc_id", "text_key")
    drawn = able.join(counts.where(F.col("before") < quota), "score").withColumn("rank", F.col("before") + F.row_number().over(within))
    drawn = drawn.where(F.col("rank") <= quota).select(F.col("doc_id").alias("drawn_id"), F.col("text_key").alias("drawn_key"), F.col("rank").cast("long").alias("rank"))
    joined = scored.join(stored(drawn, "drawn"), F.expr("text_key = drawn_key and doc_id <=> drawn_id"), "left")
    return joined.select("doc_id", "n_words", "n_features", "weight", "score", "rank")
