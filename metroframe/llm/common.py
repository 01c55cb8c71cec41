"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metroframe.session import cut_lineage


def named(column: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + column.replace("`", "``") + "`")


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, with underscores in front where ``columns`` has one already
    (letter case aside, as Spark resolves names)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: the work behind it
    is done once and survives lost executors."""
    return cut_lineage(df, df.sparkSession, f"llm-{name}")


def texts_and_ids(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text) with null texts as empty ones and every other column left out."""
    return df.select(named(id_col).alias("doc_id"), F.coalesce(named(text_col), F.lit("")).alias("text"))


def sliced(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most_bytes`` of one text or binary
    column, so that memory does not follow the batch size. A single longer row
    makes a batch of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy()
        start, held = 0, 0
        for i, n in enumerate(lengths):
            if held and held + n > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        yield batch.slice(start)


def grouped_batches(batches: Iterable[pa.RecordBatch], keys: list[str],
                    handle: Callable[[pa.Table], Iterable[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """Feed rows that arrive sorted by ``keys`` to ``handle`` in tables that
    hold whole groups only. A group that a batch cuts is kept until its end;
    groups must be of bounded size."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k) for k in keys]
        last = [c[batch.num_rows - 1] for c in columns]
        cut = batch.num_rows - 1
        while cut > 0 and all(c[cut - 1] == v for c, v in zip(columns, last)):
            cut -= 1
        if cut == 0 and held and all(held[-1].column(k)[-1] == v for k, v in zip(keys, last)):
            held.append(batch)
            continue
        # rows before `cut` end the held group or are whole groups themselves
        ready = [*held, batch.slice(0, cut)] if cut else held
        if ready:
            yield from handle(pa.Table.from_batches(ready))
        held = [batch.slice(cut)]
    if held:
        yield from handle(pa.Table.from_batches(held))
