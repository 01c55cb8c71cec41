"""SimHash near-duplicates: word-shingle fingerprints and a binary trie
self-join under a Hamming budget.

Rows of equal fingerprint collapse to one representative before anything is
compared. The 64 bits are cut into ``max_bits + 1`` blocks; two fingerprints
within the budget agree in at least one block, so each fingerprint goes to one
bucket per block and a pair is reported in the first block it agrees in.
Inside the buckets of a task one binary trie over the sorted codes is walked:
pairs of trie nodes go down together, each level adds the bit in which the two
sides differ, and a pair of nodes is dropped as soon as the budget is
exceeded. The walk advances all buckets of a batch level by level in numpy.

A hot bucket is dealt into blocks of about ``bucket_rows`` codes by hash, and
each pair of blocks is a group of its own, walked as a pair of tries: no group
grows with the data, no pair is lost.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroframe.llm.common import grouped_batches, named, sliced, stored, texts_and_ids, unused
from metroframe.llm.components import components

BITS = 64
SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
RUN_BYTES = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0d]")


def word_runs(text: bytes, overlap: int) -> Iterator[list[bytes]]:
    """The lower-cased words (A-Z only; words end at ASCII white space) in runs
    of about ``RUN_BYTES`` of text, each beginning with the last ``overlap``
    words of the one before: memory does not follow the text's length."""
    at, held = 0, []
    while at < len(text):
        cut = SPACE.search(text, at + RUN_BYTES)
        end = cut.start() if cut else len(text)
        words = held + text[at:end].lower().split()
        yield words
        at, held = end, words[len(words) - overlap:] if overlap and len(words) >= overlap else words if overlap else []


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """SimHash of one UTF-8 text: a bit is set if it is set in over half of the
    XXH64 hashes of its word shingles (of the whole sequence if it has fewer
    words than a shingle); 0 without words."""
    digest, join = xxhash.xxh64_intdigest, b" ".join
    total, count, words = np.zeros(BITS, np.int64), 0, []
    for words in word_runs(text, shingle - 1):
        hashes = [digest(join(t), SEED) for t in zip(*(words[i:] for i in range(shingle)))]
        if hashes:
            total += bit_counts(hashes)
            count += len(hashes)
    if not count:
        if not words:
            return 0
        total, count = bit_counts([digest(join(words), SEED)]), 1
    return int(np.packbits(2 * total > count, bitorder="little").view("<u8")[0])


def bit_counts(hashes: list[int]) -> np.ndarray:
    """In how many of the hashes each bit is set."""
    rows = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_key, fp): the fingerprint of every row as a signed long;
    text_key is a hash of the text that tells rows of one id apart."""
    rows = texts_and_ids(df, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            fps = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(fps.view(np.int64))],
                                             ["doc_id", "text_key", "fp"])

    keyed = rows.select("doc_id", F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("text"))
    return keyed.mapInArrow(run, f"doc_id {id_type}, text_key long, fp long")


def block_bounds(max_bits: int) -> list[int]:
    return [BITS * i // (max_bits + 1) for i in range(max_bits + 2)]


def trie_pairs(codes: np.ndarray, left: np.ndarray, right: np.ndarray, first_bit: int, max_bits: int,
               most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Walk pairs of trie nodes down together.

    ``codes`` holds uint64 codes, sorted and without repeats inside each node;
    ``left`` and ``right`` are (n, 2) index ranges, the nodes to pair up (the
    same range twice: a node with itself), whose codes agree in the bits above
    ``first_bit`` (counted from the highest). Yields (i, j, distance) for all
    code pairs within ``max_bits``. At most about ``most`` node pairs are held
    per level; the rest waits on a stack."""
    ones = {}

    def set_before(bit: int) -> np.ndarray:
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((codes >> np.uint64(BITS - 1 - bit)) & np.uint64(1))]).astype(np.int64)
        return ones[bit]

    stack = [(first_bit, left, right, np.zeros(len(left), np.int64))]
    while stack:
        bit, a, b, diff = stack.pop()
        if len(a) > most:
            half = len(a) // 2
            stack += [(bit, a[half:], b[half:], diff[half:]), (bit, a[:half], b[:half], diff[:half])]
            continue
        # a pair of single codes needs no more levels: count its remaining bits
        single = (a[:, 1] - a[:, 0] == 1) & (b[:, 1] - b[:, 0] == 1)
        if single.any():
            i, j = a[single, 0], b[single, 0]
            d = np.bitwise_count(codes[i] ^ codes[j]).astype(np.int64)
            ok = (d <= max_bits) & (i != j)
            yield i[ok], j[ok], d[ok]
            a, b, diff = a[~single], b[~single], diff[~single]
        if not len(a) or bit == BITS:
            continue
        count = set_before(bit)
        mid_a = a[:, 1] - (count[a[:, 1]] - count[a[:, 0]])
        mid_b = b[:, 1] - (count[b[:, 1]] - count[b[:, 0]])
        same = (a[:, 0] == b[:, 0])
        a0, a1 = np.stack([a[:, 0], mid_a], 1), np.stack([mid_a, a[:, 1]], 1)
        b0, b1 = np.stack([b[:, 0], mid_b], 1), np.stack([mid_b, b[:, 1]], 1)
        na = np.concatenate([a0, a1, a0, a1[~same]])
        nb = np.concatenate([b0, b1, b1, b0[~same]])
        nd = np.concatenate([diff, diff, diff + 1, diff[~same] + 1])
        keep = (nd <= max_bits) & (na[:, 0] < na[:, 1]) & (nb[:, 0] < nb[:, 1])
        stack.append((bit + 1, na[keep], nb[keep], nd[keep]))


def links(codes: DataFrame, fp: str = "fp", max_bits: int = MAX_BITS, bucket_rows: int = 1024) -> DataFrame:
    """(a, b, distance) for all pairs a < b (as signed longs) of the distinct
    fingerprints in ``codes`` that differ in at most ``max_bits`` bits. Nulls
    are ignored; an empty table has no links."""
    bounds = block_bounds(max_bits)

    def block(r: int):
        width = bounds[r + 1] - bounds[r]
        if width == BITS:
            return F.col("fp")
        return F.shiftrightunsigned("fp", BITS - bounds[r + 1]).bitwiseAND(F.lit((1 << width) - 1))

    placed = (codes.select(named(fp).alias("fp")).where("fp is not null")
              .select("fp", F.posexplode(F.array(*(block(r) for r in range(max_bits + 1)))).alias("r", "v")))
    # at most (max_bits + 1) * 2^(64 / (max_bits + 1)) buckets, whatever the input: 262,144 for 3 bits
    sizes = placed.groupBy("r", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = F.broadcast(sizes) if max_bits >= 3 else sizes
    shared = placed.join(sizes, ["r", "v"]).withColumn("parts", F.ceil(F.col("n") / bucket_rows).cast("int"))
    shared = shared.withColumn("own", F.pmod(F.xxhash64("fp", "r"), F.col("parts")).cast("int"))
    dealt = shared.select("r", "v", "own", "fp", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    dealt = dealt.select("r", "v", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                         F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "fp")
    keys = ["r", "v", "x", "y"]

    def pairs(group: pa.Table) -> Iterator[pa.RecordBatch]:
        r, v, x, y, side = (group.column(k).to_numpy() for k in [*keys, "side"])
        fps = group.column("fp").to_numpy().view(np.uint64)
        shift = np.array(bounds, np.uint64)[r]
        # the bucket's block comes first; a rotation keeps distances
        code = (fps << shift) | np.where(shift > 0, fps >> ((np.uint64(BITS) - shift) % np.uint64(BITS)), np.uint64(0))
        order = np.lexsort((code, side, y, x, v, r))
        r, v, x, y, side, code, fps = (c[order] for c in (r, v, x, y, side, code, fps))
        new_group = np.concatenate([[True], (r[1:] != r[:-1]) | (v[1:] != v[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
        new_node = new_group | np.concatenate([[False], side[1:] != side[:-1]])
        start = np.flatnonzero(new_node)
        nodes = np.stack([start, np.append(start[1:], len(code))], 1)
        self_pair = x[start] == y[start]
        second = ~self_pair & ~new_group[start]  # the second node of a pair of blocks
        left = np.concatenate([nodes[self_pair], nodes[np.flatnonzero(second) - 1]])
        right = np.concatenate([nodes[self_pair], nodes[second]])
        for i, j, d in trie_pairs(code, left, right, BITS // (max_bits + 1), max_bits):
            diff, ok = fps[i] ^ fps[j], np.ones(len(i), bool)
            for k in range(max_bits):  # reported where the first equal block is
                mask = np.uint64(((1 << (bounds[k + 1] - bounds[k])) - 1) << (BITS - bounds[k + 1]))
                ok &= (r[i] <= k) | ((diff & mask) != 0)
            a, b = fps[i[ok]].view(np.int64), fps[j[ok]].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(d[ok].astype(np.int32))],
                                             ["a", "b", "distance"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from grouped_batches(batches, keys, pairs)

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long, distance int")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``df``: doc_id, text_key, fp, root, component_id.

    component_id is the smallest id reachable over links of at most
    ``max_bits`` differing bits, the row's own included; root is a fingerprint
    that names the component. Null and empty texts have fingerprint zero and
    link like any other; a null id never is the smallest, and a component of
    null ids only has a null component_id; equal rows get equal results; an
    empty table gives an empty one. Other columns of ``df`` are not read."""
    rows = stored(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(links(classes, "fp", max_bits))
    placed = stored(classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                    .select("fp", "first", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked")), "placed")
    # only linked classes need a look at others
    least = stored(placed.where("linked").groupBy("root").agg(F.min("first").alias("component_id")), "least")
    known = stored(placed.where("linked").join(least, "root").select("fp", "root", "component_id")
                   .union(placed.where("not linked").select("fp", "root", "first")), "known")
    return rows.join(known, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS,
               max_bits: int = MAX_BITS) -> DataFrame:
    """``df`` with one row of each near-duplicate component: that of the
    smallest id (ties: of the smallest text hash, then any one of the equal
    rows). Null ids come last. All columns are kept as they are."""
    rows = near_duplicates(df, id_col, text_col, shingle, max_bits)
    counted = rows.groupBy("root", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    first = counted.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key", "n")).alias("first"))
    own_id, own_key, its_id, its_key, copies = unused(df.columns, "own_id", "own_key", "its_id", "its_key", "copies")
    first = stored(first.select(F.col("first.doc_id").alias(its_id), F.col("first.text_key").alias(its_key), F.col("first.n").alias(copies)), "first")
    own = df.withColumn(own_id, named(id_col)).withColumn(own_key, F.xxhash64(F.coalesce(named(text_col), F.lit(""))))

    def kept(which: DataFrame) -> DataFrame:
        return own.join(which, (F.col(own_key) == F.col(its_key)) & F.col(own_id).eqNullSafe(F.col(its_id)), "left_semi")

    alone = kept(first.where(F.col(copies) == 1))
    if not first.where(F.col(copies) > 1).isEmpty():  # rows equal in id and text: one of each
        alone = alone.union(kept(first.where(F.col(copies) > 1)).dropDuplicates([own_id, own_key]))
    return alone.drop(own_id, own_key)
