"""Exact dedup by content sort.

Sampled splitters range-partition the normalised bytes, the external sort of each range places equal texts side by side, and
each text is compared in full with its neighbour. The range key ends with the id, so a text with very many copies spreads over
several ranges; runs that touch the edge of a range are put together afterwards, two rows a range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrimlens.llm.common import id_in, id_out, settle, tidy

#: Characters of a text in the range key. Splitters are sampled to the driver, so the key must not hold whole texts.
KEY_CHARS = 32
_RUNS = "id long, range int, run long, n long, low long, high long, sha string, edge string"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours in a sorted range; the first and the last run also carry their text."""
    tidy()
    place, schema = TaskContext.get().partitionId(), pa.schema(
        [(n, {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}[t]) for n, t in (c.split() for c in _RUNS.split(", "))])
    text: str | None = None
    mark: int | None = None
    ids: list[int] = []
    number = 0

    def closed(last: bool) -> pa.RecordBatch:
        n = len(ids)
        sha = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
        edge = text if number == 0 or last else None
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([place] * n, pa.int32()), pa.array([number] * n, pa.int64()),
            pa.array([n] * n, pa.int64()), pa.array([ids[0]] * n, pa.int64()), pa.array([ids[-1]] * n, pa.int64()),
            pa.array([sha] * n, pa.string()), pa.array([edge] + [None] * (n - 1), pa.string())], schema=schema)

    done: list[pa.RecordBatch] = []
    for batch in batches:
        texts = batch.column("text")
        for i, (doc, h) in enumerate(zip(batch.column("id").to_pylist(), batch.column("h").to_pylist(), strict=True)):
            now = texts[i].as_py() if h != mark or text is None else None
            if now is None:  # the same hash: compare in full
                now = texts[i].as_py()
                if now == text:
                    ids.append(doc)
                    continue
            if text is not None:
                done.append(closed(False))
                number += 1
            text, mark, ids = now, h, [doc]
        if len(done) > 500:
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()
            done = []
    if text is not None:
        done.append(closed(True))
        yield from pa.Table.from_batches(done).combine_chunks().to_batches()


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
    normalise: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256 (of the normalised text in UTF-8).

    Texts are equal when identical after `normalise` (nothing by default); of equal texts the row with the smallest id stays,
    or the largest with keep="max". A null text is empty, and empty texts are equal. A null id counts as the smallest. Rows
    repeated under one id are copies of each other: the group counts each, and `kept` is true for each row of the kept id. Other
    columns are not read; an empty table gives an empty result. Texts are compared whole; a very long one alone fills its place in a
    range.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep is min or max")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(id_in(id_col).alias("id"), (normalise(text) if normalise else text).alias("text"))
    rows = rows.select("id", "text", F.substring("text", 1, KEY_CHARS).alias("key"), F.xxhash64("text").alias("h"))
    ranges = rows.repartitionByRange("key", "h", "id").sortWithinPartitions("key", "h", "text", "id")
    runs = settle(ranges.select("id", "text", "h").mapInArrow(_runs, _RUNS))
    # Two rows a range at most: a run that goes on in the next range meets its other parts here.
    edges = runs.where("edge IS NOT NULL").select("range", "run", "edge", "n", "low", "high")
    whole = edges.groupBy("edge").agg(F.sum("n").alias("all_n"), F.min("low").alias("all_low"), F.max("high").alias("all_high"))
    joint = edges.join(whole, "edge").select("range", "run", "all_n", "all_low", "all_high")
    best = F.coalesce("all_low", "low") if keep == "min" else F.coalesce("all_high", "high")
    return runs.join(F.broadcast(joint), ["range", "run"], "left").select(
        id_out("id").alias(id_col), id_out(best).alias("keep_id"), F.coalesce("all_n", "n").alias("group_size"),
        (F.col("id") == best).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """The documents without exact copies, all columns: of equal texts one row stays, with the smallest (or largest) id.

    A row is told by its id and its text, so an id that several texts carry keeps those of them that are no copies. A null text equals
    an empty one; of rows repeated under one id and text one stays. A null id is the smallest. An empty table gives an empty result.
    """
    key, sha = "_exact_dedup_key", "_exact_dedup_sha"  # joined by what repeated rows share, so the texts are moved once for both
    kept = exact_dedup(docs, id_col, text_col, keep).where("kept").select(id_in(id_col).alias(key), F.col("text_sha256").alias(sha)).distinct()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marked = docs.withColumns({key: id_in(id_col), sha: F.sha2(text.cast("binary"), 256)})
    return marked.join(kept, [key, sha], "left_semi").dropDuplicates([key, sha]).drop(key, sha)
