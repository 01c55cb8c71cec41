"""Harmonic packing of token streams into sequences of a fixed capacity.

Class k holds pieces of length at most ``capacity // k``, and a bin of class k
takes exactly k of them: full bins waste next to nothing when pieces fill
their class. So a document is cut to class sizes: full sequences first, then
the largest class size that fits the rest, and so on, until what remains lies
within 1/128 of its class size or is used up (three or four pieces a document).

Workers fill the bins of every class on their own, while they tokenize. The
pieces left over, fewer than k per class and worker, are numbered over all
workers by prefix sums over per-worker counts and fill bins again; what is
then left, fewer than k pieces of each of the ~90 classes whatever the input,
is put together by first-fit decreasing in one task.

Only a row per piece is ever shuffled, no text and no token ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metroframe.llm.common import sliced, stored, texts_and_ids

CAPACITY = 2048
END_ID = 1
#: a piece may stay this fraction short of its class size
SLACK = 1 / 128
#: sequence_id: worker + 1 (0: bins filled over all workers), class, bin
CLASS_BITS, BIN_BITS = 16, 24


def cut(length: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a document of ``length`` tokens."""
    pieces = [(capacity, 1)] * (length // capacity)
    rest = length % capacity
    while rest:
        k = capacity // rest
        size = capacity // k
        if size - rest > slack * size:
            rest_piece = capacity // (k + 1)
            k = capacity // rest_piece
        else:
            rest_piece = rest
        pieces.append((rest_piece, k))
        rest -= rest_piece
    return pieces


def encoder(path: str):
    """bytes -> ids of a byte-level BPE. A JSON tokenizer (``*.json``) gives the
    ids of the ``tokenizers`` library without post-processing: its added tokens
    are matched wherever they stand. A rank file has none, all is ordinary text."""
    import base64
    import json

    import public_tokenizers
    import tiktoken

    special = {}
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec["added_tokens"]
        level = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        merged = [model["vocab"].get("".join(m if isinstance(m, list) else m.split(" "))) for m in model.get("merges", ())]
        # a rank codec gives the same ids where merges go by id and nothing else touches the text
        same = (spec["normalizer"] is None and level.items() <= (spec["pre_tokenizer"] or {}).items() and merged == list(range(256, 256 + len(merged)))
                and not any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip"))
                and not any(t["content"] in u["content"] for t in added for u in added if t is not u)
                and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")))
        if not same:
            from tokenizers import Tokenizer

            codec = Tokenizer.from_file(path)
            return lambda text: codec.encode(text, add_special_tokens=False).ids
        # the JSON writes printable bytes as themselves, the others as the characters from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}
        special = {t["content"]: t["id"] for t in added}
        ranks = {bytes(byte[c] for c in token): rank for token, rank in model["vocab"].items() if token not in special}
    else:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    codec = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    fast = codec.encode_to_numpy if hasattr(codec, "encode_to_numpy") else codec.encode
    slow: list = []

    def encode(text: str):
        try:
            return fast(text, allowed_special="all")
        except Exception:  # the rank codec's search gives up on runs of about a million blanks
            if not slow:
                slow.append(patient_encoder(path, codec))
            return slow[0](text)

    return encode


def patient_encoder(path: str, codec):
    """The same ids without a limit on the length of a run: a JSON tokenizer is
    used itself; of a rank file the pattern's matches are found by ``regex``."""
    import public_tokenizers
    import regex
    from tokenizers import Tokenizer

    if path.endswith(".json"):
        whole = Tokenizer.from_file(path)
        return lambda text: whole.encode(text, add_special_tokens=False).ids
    find = regex.compile(public_tokenizers.PATTERN).finditer
    return lambda text: [i for m in find(text) for i in codec._encode_single_piece(m.group())]


class Worker:
    """Cuts documents and fills the bins of each class in one task."""

    def __init__(self, number: int, capacity: int, slack: float) -> None:
        self.number, self.capacity, self.slack = number, capacity, slack
        self.count: dict[int, int] = {}
        self.offset: dict[int, int] = {}

    def place(self, length: int) -> list[tuple[int, int, int, int, int]]:
        """(start, length, class, rank in the class, offset in the bin) of each piece."""
        out, start = [], 0
        for size, k in cut(length, self.capacity, self.slack):
            rank = self.count.get(k, 0)
            offset = self.offset.get(k, 0) if rank % k else 0
            self.count[k], self.offset[k] = rank + 1, offset + size
            out.append((start, size, k, rank, offset))
            start += size
        return out


def pieces(df: DataFrame, id_col: str, text_col: str, codec_path: str, end_id: int, capacity: int, slack: float) -> DataFrame:
    """One row per piece, with the worker that cut it and its place in the
    worker's own bins."""
    rows = texts_and_ids(df, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(codec_path)
        number = pyspark.TaskContext.get().partitionId()
        worker = Worker(number, capacity, slack)
        for batch in sliced(batches, "text"):
            at, placed, crcs, totals = [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = np.append(np.asarray(encode(text), dtype="<u4"), np.uint32(end_id)).astype("<u4")
                for piece in worker.place(len(ids)):
                    at.append(i)
                    placed.append(piece)
                    crcs.append(zlib.crc32(ids[piece[0]:piece[0] + piece[1]].tobytes()))
                    totals.append(len(ids))
            start, length, k, rank, offset = np.array(placed, np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(start), pa.array(length), pa.array(crcs, pa.int64()),
                 pa.array(totals, pa.int64()), pa.array(np.full(len(at), number, np.int32)), pa.array(k.astype(np.int32)), pa.array(rank), pa.array(offset)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "worker", "class", "rank", "offset"])

    return rows.mapInArrow(run, f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, "
                                "worker int, class int, rank long, offset long")


def first_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece, longest first into the first bin with room."""
    bins, offsets, room = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), np.zeros(0, np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        fits = np.flatnonzero(room >= lengths[i])
        if not len(fits):
            room = np.append(room, capacity)
            fits = [len(room) - 1]
        bins[i], offsets[i] = fits[0], capacity - room[fits[0]]
        room[fits[0]] -= lengths[i]
    return bins, offsets


def pack(df: DataFrame, codec_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
         capacity: int = CAPACITY, slack: float = SLACK) -> DataFrame:
    """Pack every document's tokens, with ``end_id`` after each document.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, class. Null and empty texts are documents of one
    token; repeated rows and null ids are documents like any other; a very
    long text fills whole sequences; an empty table gives no piece. Other
    columns of ``df`` are not read."""
    cut_up = stored(pieces(df, id_col, text_col, codec_path, end_id, capacity, slack), "pieces")
    # a row per worker and class, of ~90 classes
    counts = stored(cut_up.groupBy("worker", "class").agg(F.max("rank").alias("last")), "counts")
    full = (F.col("last") + 1) - F.pmod(F.col("last") + 1, F.col("class").cast("long"))
    before = Window.partitionBy("class").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    counts = (counts.select("worker", "class", full.alias("full"), (F.col("last") + 1 - full).alias("left"))
              .withColumn("skip", F.coalesce(F.sum("left").over(before), F.lit(0)))
              .withColumn("all_left", F.sum("left").over(Window.partitionBy("class"))))
    known = cut_up.join(stored(counts, "left"), ["worker", "class"])
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "class"]

    def sequence(first, number):
        return (F.shiftleft(first.cast("long"), CLASS_BITS + BIN_BITS).bitwiseOR(F.shiftleft(F.col("class").cast("long"), BIN_BITS))
                .bitwiseOR(number.cast("long"))).alias("sequence_id")

    whole = F.col("rank") < F.col("full")
    own = known.where(whole).withColumn("sequence_id", sequence(F.col("worker") + 1, F.floor(F.col("rank") / F.col("class")))).select(out)

    rest = stored(known.where(~whole).withColumn("place", F.col("skip") + F.col("rank") - F.col("full"))
                  .withColumn("bin", F.floor(F.col("place") / F.col("class"))), "rest")
    filled = (F.col("bin") + 1) * F.col("class") <= F.col("all_left")
    in_bin = Window.partitionBy("class", "bin").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    shared = (rest.where(filled).withColumn("offset", F.coalesce(F.sum("length").over(in_bin), F.lit(0)))
              .withColumn("sequence_id", sequence(F.lit(0), F.col("bin"))).select(out))

    # fewer than k pieces of class k: under `capacity` tokens for each of ~90 classes
    last = rest.where(~filled)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if batches:
            t = pa.Table.from_batches(batches).sort_by([("class", "ascending"), ("place", "ascending")]).combine_chunks()
            bins, offsets = first_fit(t.column("length").to_numpy(), capacity)
            t = t.drop_columns("offset").append_column("sequence_id", pa.array(bins)).append_column("offset", pa.array(offsets))
            yield from t.select(out).to_batches()

    tail = last.repartition(1).mapInArrow(fit, shared.schema)
    return own.unionByName(shared).unionByName(tail)
