"""Embedding near-duplicates through spherical-cap filters.

The filter directions are two structured random product codes: a random rotation,
then ``BLOCKS`` blocks of coordinates with a small random codebook each; a
direction is one codeword per block. A vector is list-decoded to all
directions whose inner product exceeds a threshold (partial sums that cannot
reach it are pruned), vectors are joined on shared directions, and every pair
that meets there is verified by its exact cosine.

Equal vectors collapse to one representative first. A pair that meets at
several directions counts at the smallest of them, so nothing but a count and
a local component per vector leaves a bucket, never a row per pair. A bucket
of more than ``bucket_rows`` vectors is dealt into blocks, each pair of blocks
a group of its own.

The number of directions follows the number of vectors (256 for each). The
threshold is fitted on at most ``SAMPLE`` vectors for ``HITS`` directions a
vector on average, and lowered for a vector that gets fewer than
``LEAST_HITS``. Recall against brute force is measured in the tests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroframe.llm.common import grouped_batches, named, stored
from metroframe.llm.components import components

THRESHOLD = 0.95
CODES, BLOCKS, HITS, LEAST_HITS, SAMPLE, DIRECTIONS_PER_VECTOR = 2, 4, 20, 12, 512, 256
#: of a codebook; beyond it directions are shared by more vectors, and buckets split
MOST_WORDS = 4096


class ProductCode:
    """Rotation and codebooks for vectors of ``dims`` coordinates, drawn from a seed."""

    def __init__(self, dims: int, words: int, seed: int) -> None:
        rng = np.random.default_rng([seed, dims, words])
        self.rotation = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
        self.parts = np.array_split(np.arange(dims), min(BLOCKS, dims))
        self.books = [book / np.linalg.norm(book, axis=1, keepdims=True)
                      for book in (rng.normal(size=(words, len(part))) for part in self.parts)]
        self.words = words

    def scores(self, unit: np.ndarray) -> list[np.ndarray]:
        """Inner products of the rows with the codewords, one array per block."""
        turned = unit @ self.rotation
        return [turned[:, part] @ book.T for part, book in zip(self.parts, self.books)]

    def decode(self, scores: list[np.ndarray], least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, direction, inner product) of all directions of at least ``least[row]``."""
        best = [s.max(axis=1) for s in scores]
        rest = np.zeros(len(least))
        tails = []
        for b in reversed(best):  # the most that the blocks after this one can add
            tails.append(rest)
            rest = rest + b
        row, total, code = np.arange(len(least)), np.zeros(len(least)), np.zeros(len(least), np.int64)
        for s, tail in zip(scores, reversed(tails)):
            grown = total[:, None] + s[row]
            at, word = np.nonzero(grown + (tail - least)[row][:, None] >= -1e-12)
            row, total, code = row[at], grown[at, word], code[at] * self.words + word
        return row, code, total

    def fit(self, unit: np.ndarray, hits: int = HITS) -> float:
        """The threshold at which the rows have ``hits`` directions on average."""
        if not len(unit):
            return 0.0
        scores = self.scores(unit)
        top = sum(s.max(axis=1) for s in scores)
        low, high = float(np.median(top)) / 2, float(top.max())
        for _ in range(20):
            mid = (low + high) / 2
            found = sum(len(self.decode([s[i:i + 64] for s in scores], np.full(len(unit[i:i + 64]), mid))[0]) for i in range(0, len(unit), 64))
            low, high = (mid, high) if found > hits * len(unit) else (low, mid)
        return high

    def filters(self, unit: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, direction): all directions over the threshold. The threshold of
        a row with fewer than LEAST_HITS goes down until it has them."""
        scores = self.scores(unit)
        least = np.minimum(threshold, sum(s.max(axis=1) for s in scores))
        enough = min(LEAST_HITS, self.words ** len(self.parts))
        row, code, _ = self.decode(scores, least)
        while len(few := np.flatnonzero(np.bincount(row, minlength=len(unit)) < enough)):
            least[few] -= 0.02
            more = self.decode([s[few] for s in scores], least[few])
            other = ~np.isin(row, few)
            row, code = np.concatenate([row[other], few[more[0]]]), np.concatenate([code[other], more[1]])
        return row, code


def usable(vector):
    """True for vectors that are not null or zero and have finite components only."""
    return (vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(vector, lambda x: x != 0))


def by_length(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) of the vectors of each length."""
    lists = batch.column(column)
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum(pa.compute.list_value_length(lists).to_numpy())
    size = np.diff(np.concatenate([[0], ends]))
    for dims in np.unique(size):
        rows = np.flatnonzero(size == dims)
        yield rows, flat[(ends[rows] - dims)[:, None] + np.arange(dims)]


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def local_links(vectors: np.ndarray, weight: np.ndarray, filters: list[np.ndarray], here: int, side: np.ndarray | None,
                threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Links inside one block (or between the two of ``side``) that have no smaller
    direction in common: (row, links by weight, smallest row of its local
    component), for rows with links."""
    unit = unit_rows(vectors)
    linked = unit @ unit.T >= threshold
    np.fill_diagonal(linked, False)
    if side is not None:
        linked &= side[:, None] != side[None, :]
    if not linked.any():
        return None
    rows = np.flatnonzero(linked.any(axis=1))
    linked = linked[np.ix_(rows, rows)]
    smaller = [f[f < here] for f in (filters[i] for i in rows)]
    known, place = np.unique(np.concatenate(smaller), return_inverse=True)
    if len(known):
        has = np.zeros((len(rows), len(known)), np.float32)
        has[np.repeat(np.arange(len(rows)), [len(s) for s in smaller]), place] = 1
        linked &= has @ has.T == 0
        if not linked.any():
            return None
    count = linked @ weight[rows]
    label = np.arange(len(rows))
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], len(rows)).min(axis=1))
        new = new[new]
        if (new == label).all():
            break
        label = new
    some = count > 0
    return rows[some], count[some], rows[label[some]]


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                    bucket_rows: int = 128) -> DataFrame:
    """One row per row of ``df``: vec_id, n_links, component_id.

    n_links counts the other rows whose cosine is at least ``threshold`` (in
    double precision), component_id is the smallest id reachable over links,
    the row's own included. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing, nor do vectors of different
    lengths with each other. Rows count one by one, equal ids too; a null id is
    never the smallest. An empty table gives an empty one. Other columns are
    not read."""
    rows = df.select(named(id_col).alias("vec_id"), named(vector_col).alias("vector"))
    classes = (rows.where(usable(F.col("vector"))).groupBy("vector").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("weight"))
               .withColumn("class", F.monotonically_increasing_id()).withColumn("dims", F.size("vector")))
    classes = stored(classes, "vector-classes")

    # the codes of each length: 256 directions per vector, threshold fitted on a bounded sample
    codes: dict[int, list[tuple[ProductCode, float]]] = {}
    for r in classes.groupBy("dims").count().collect():  # one row per length of vectors
        words = max(4, int(np.ceil((DIRECTIONS_PER_VECTOR * r["count"]) ** (1 / min(BLOCKS, r.dims)))))
        sample = classes.where(F.col("dims") == r.dims).select("vector").orderBy(F.xxhash64("class")).limit(SAMPLE).collect()
        unit = unit_rows(np.array([x.vector for x in sample], float))
        drawn = [ProductCode(r.dims, min(words, MOST_WORDS), seed) for seed in range(CODES)]
        codes[r.dims] = [(code, code.fit(unit)) for code in drawn]

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = part.column("class").to_numpy()
                for where, matrix in by_length(part, "vector"):
                    dims, unit = matrix.shape[1], unit_rows(matrix)
                    for number, (code, threshold) in enumerate(codes[dims]):
                        row, direction = code.filters(unit, threshold)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), dims, np.int32)), pa.array(direction * CODES + number),
                                                          pa.array(ids[where[row]])], ["dims", "filter", "class"])

    postings = stored(classes.select("class", "vector").mapInArrow(post, "dims int, filter long, class long"), "postings")
    sizes = stored(postings.groupBy("dims", "filter").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "filter-sizes")
    met = postings.join(sizes, ["dims", "filter"]).withColumn("parts", F.ceil(F.col("n") / bucket_rows).cast("int"))
    lists = met.groupBy("class").agg(F.sort_array(F.collect_list(F.struct("filter", "parts"))).alias("met"))
    held = classes.join(stored(lists, "filter-lists"), "class").withColumn("filters", F.col("met.filter"))
    held = held.select("class", "dims", "vector", "weight", "filters", F.explode("met").alias("m")).select("*", "m.filter", "m.parts").drop("m")
    held = held.withColumn("own", F.pmod(F.xxhash64("class", "filter"), F.col("parts")).cast("int"))
    dealt = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("dims", "filter", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                         (F.col("own") > F.col("other")).alias("side"), "class", "weight", "vector", "filters")
    keys = ["dims", "filter", "x", "y"]

    def verify(group: pa.Table) -> Iterator[pa.RecordBatch]:
        group = group.combine_chunks()
        key = [group.column(k).to_numpy() for k in keys]
        new = np.concatenate([[True], np.any([k[1:] != k[:-1] for k in key], axis=0)])
        start = np.flatnonzero(new)
        stop = np.append(start[1:], len(new))
        flat = group.column("vector").combine_chunks().flatten().to_numpy().astype(np.float64)
        vector_at = np.concatenate([[0], np.cumsum(key[0])])
        lists = group.column("filters").combine_chunks()
        list_flat, list_at = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pa.compute.list_value_length(lists).to_numpy())])
        side, ids, weight = (group.column(c).to_numpy() for c in ("side", "class", "weight"))
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for a, b in zip(start, stop):
            if b - a < 2:
                continue
            found = local_links(flat[vector_at[a]:vector_at[b]].reshape(b - a, -1), weight[a:b],
                                [list_flat[list_at[i]:list_at[i + 1]] for i in range(a, b)], key[1][a], side[a:b] if key[2][a] != key[3][a] else None, threshold)
            if found:
                out.append((ids[a + found[0]], found[1], ids[a + found[2]]))
        if out:
            node, links, to = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(links), pa.array(to)], ["class", "links", "to"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from grouped_batches(batches, keys, verify)

    found = dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "class long, links long, to long")
    found = stored(found, "local-links")
    roots = components(found.select(F.col("class").alias("a"), F.col("to").alias("b")))
    counts = stored(found.groupBy("class").agg(F.sum("links").alias("links")), "link-counts")
    placed = (classes.select("class", "first", "weight", "vector").join(counts, "class", "left")
              .join(roots.withColumnRenamed("node", "class"), "class", "left")
              .select("vector", "first", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "class").alias("root")))
    placed = stored(placed, "placed")
    least = stored(placed.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    known = stored(placed.join(least, "root").select("vector", "n_links", "component_id"), "known")
    return rows.join(known, "vector", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                                                     F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
