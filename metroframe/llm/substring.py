"""Substring dedup by sentence, line or paragraph hashing.

Every unit (by default a sentence: a line, cut where a word ends in ``.``, ``!``
or ``?``) is normalised and hashed, however short; digests are grouped over the
whole corpus and the earliest occurrence (smallest id, text hash, offset) keeps
the unit. Repeated units that stand next to each other in a text are joined to
one span, which keeps its offsets in the original text; spans of at least
``span_words`` words are listed. A short line that stands alone, a menu entry
or a greeting, is no copied passage, but it counts within a longer span.

Only digests and offsets are shuffled, never text, and a digest's rows are
counted and minimised before the exchange. The join back to the occurrences
reads two written tables, so adaptive execution can split a line that a third
of all documents hold.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metroframe.llm.common import named, sliced, stored, texts_and_ids, unused

#: a passage of fifty words may lose its first or last sentence to the words around it
SPAN_WORDS = 25
BLANK = " \t\r\f\v"
#: unit -> what it is made of; blanks around it are cut off
UNITS = {
    "sentence": r"(?:[^\n.!?]++|[.!?]++(?![ \t\r\f\v\n]|\Z))++[.!?]*+|[.!?]++",
    "line": r"[^\n]++",
    "paragraph": r"[^\n]++(?:\n(?![ \t\r\f\v]*+\n)[^\n]++)*+",
}


def units(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "sentence") -> DataFrame:
    """(doc_id, text_key, unit_no, start, end, words, hi, lo): every unit with
    a word, its half-open character range in the original text, its number of
    words and the 128-bit digest of its normal form (A-Z lower-cased, runs of
    ASCII white space made one space, none at the ends)."""
    rows = texts_and_ids(df, id_col, text_col)
    id_field = rows.schema["doc_id"].dataType.simpleString()
    find = re.compile(UNITS[unit]).finditer

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 2 << 20):
            at, number, begin, end, size, digests = [], [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                k = 0
                for m in find(text):
                    body = m.group()
                    words = body.encode().lower().split()
                    if words:
                        bare = body.lstrip(BLANK + "\n")
                        start = m.end() - len(bare)
                        at.append(i)
                        number.append(k)
                        begin.append(start)
                        end.append(start + len(bare.rstrip(BLANK + "\n")))
                        size.append(len(words))
                        digests.append(xxhash.xxh3_128_digest(b" ".join(words)))
                        k += 1
            halves = np.frombuffer(b"".join(digests), dtype=">i8").astype(np.int64).reshape(-1, 2)
            index = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(index), batch.column("text_key").take(index), pa.array(number, pa.int64()), pa.array(begin, pa.int64()),
                 pa.array(end, pa.int64()), pa.array(size, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1])],
                ["doc_id", "text_key", "unit_no", "start", "end", "words", "hi", "lo"])

    schema = f"doc_id {id_field}, text_key long, unit_no long, start long, end long, words long, hi long, lo long"
    return rows.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, schema)


def repeated_units(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "sentence") -> DataFrame:
    """Every unit of any length that an earlier place holds: doc_id, text_key,
    unit_no, start, end, words, and where the kept occurrence stands: kept_id,
    kept_start. Occurrences are ranked by id (nulls last), text hash and start."""
    found = stored(units(df, id_col, text_col, unit), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key", "start")
    keepers = (found.groupBy("hi", "lo").agg(F.min(rank).alias("kept"), F.max(rank).alias("last")).where("kept <> last")
               .select("hi", "lo", "kept"))
    joined = found.join(stored(keepers, "keepers"), ["hi", "lo"]).where(~rank.eqNullSafe(F.col("kept")))
    return joined.select("doc_id", "text_key", "unit_no", "start", "end", "words", F.col("kept.doc_id").alias("kept_id"),
                         F.col("kept.start").alias("kept_start"))


def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "sentence",
            span_words: int = SPAN_WORDS) -> DataFrame:
    """The spans to remove: doc_id, text_key, start, end, n_units, n_words, and
    where the first unit's kept occurrence stands: kept_id, kept_start.

    A span is a run of repeated units without another unit between them, of
    ``span_words`` words or more in all; with 1 every repeated unit is in a
    span. Rows equal in id and text are one document and give its spans once.
    Empty and null texts have no units; an empty table has no spans. Other
    columns of ``df`` are not read."""
    doc = ["doc_id", "text_key"]
    again = repeated_units(df, id_col, text_col, unit).dropDuplicates([*doc, "unit_no"])
    # the repeated units of one text: bounded by the text, which is one row
    run = F.col("unit_no") - F.row_number().over(Window.partitionBy(*doc).orderBy("unit_no"))
    runs = again.withColumn("run", run).groupBy(*doc, "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n_units"), F.sum("words").alias("n_words"),
        F.min_by(F.struct("kept_id", "kept_start"), "unit_no").alias("kept"))
    return runs.where(F.col("n_words") >= span_words).select(*doc, "start", "end", "n_units", "n_words", "kept.kept_id", "kept.kept_start")


def remove_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the spans and the blanks after each of them; a line
    that is gone as a whole takes its line break with it."""
    out, at = [], 0
    for start, end in sorted(spans):
        out.append(text[at:start])
        at = max(at, end)
        while at < len(text) and text[at] in BLANK:
            at += 1
        if text.startswith("\n", at) and (start == 0 or text[start - 1] == "\n"):
            at += 1
    out.append(text[at:])
    return "".join(out)


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "sentence",
                    span_words: int = SPAN_WORDS) -> DataFrame:
    """``df`` with the repeated spans cut from its texts; every row and every
    other column stays, whatever their names. Null texts stay null."""
    listed = repeats(df, id_col, text_col, unit, span_words).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    own_id, own_key, its_id, its_key, cut = unused(df.columns, "own_id", "own_key", "its_id", "its_key", "spans")
    listed = stored(listed.select(F.col("doc_id").alias(its_id), F.col("text_key").alias(its_key), F.col("spans").alias(cut)), "spans")
    own = df.withColumn(own_id, named(id_col)).withColumn(own_key, F.xxhash64(F.coalesce(named(text_col), F.lit(""))))
    marked = own.join(listed, (F.col(own_key) == F.col(its_key)) & F.col(own_id).eqNullSafe(F.col(its_id)), "left")
    marked = marked.drop(own_id, own_key, its_id, its_key)

    columns = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text_col):
            texts, found = batch.column(text_col), batch.column(cut)
            new = [t.as_py() if t.as_py() is None or s.as_py() is None else remove_spans(t.as_py(), [(x["start"], x["end"]) for x in s.as_py()])
                   for t, s in zip(texts, found)]
            arrays = [pa.array(new, texts.type) if name == text_col else batch.column(name) for name in columns]
            yield pa.RecordBatch.from_arrays(arrays, columns)

    return marked.mapInArrow(run, df.schema)
