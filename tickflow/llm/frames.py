"""Small helpers every operator of this package shares: row-wise Arrow maps and durable stages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.session import work_path

ROW = "_row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32(doc_id as text) mod ``mod``; a row without an id has none (null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % mod


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there: lineage ends, nothing is computed twice."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(df: DataFrame) -> DataFrame:
    """All columns of ``df`` in one struct, so that added columns never clash with them."""
    if not df.columns:
        raise ValueError("a table without columns")
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW))


def strings(column: pa.Array) -> pa.Array:
    """A string array without nulls: null texts are empty ones."""
    if column.null_count:
        column = column.fill_null("")
    return column.cast(pa.large_string())


PIECE = 1 << 22
"""Bytes of text a worker turns into Python objects or result columns at once."""


def pieces(batch: pa.RecordBatch, texts: list[pa.Array]) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``PIECE`` bytes of ``texts``; a longer row is a run of its own."""
    sizes = sum(np.asarray(pc.binary_length(t).fill_null(0), np.int64) for t in texts)
    ends = np.cumsum(sizes)
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PIECE, "right")))
        yield batch.slice(a, b - a)
        a = b


def annotate(
    df: DataFrame,
    fields: list[T.StructField],
    fn: Callable[[pa.Array], dict[str, object]],
    text: str = "text",
) -> DataFrame:
    """Add columns computed from the whole text of each row.

    ``fn`` gets the texts of one batch (nulls are empty) and returns a list or array for each field.
    The result has the struct ``_row`` with the columns of ``df``, then the fields.
    """
    source = packed(df)
    schema = T.StructType([source.schema[0], *fields])
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            at = batch.column(0).type.get_field_index(text)
            for piece in pieces(batch, [batch.column(0).field(at)]):
                # A sliced struct hands on whole children; flattening slices them too.
                row = pa.StructArray.from_arrays(piece.column(0).flatten(), fields=list(piece.column(0).type))
                got = fn(strings(row.field(at)))
                columns = [row.cast(arrow.field(0).type)]
                columns += [
                    got[n] if isinstance(got[n], pa.Array) else pa.array(got[n], arrow.field(n).type) for n in names
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return source.mapInArrow(run, schema)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal ``keys`` in a sorted partition, also where they cross batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in cols)
        if last is not None and first != last:
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """The rows of a sorted partition in tables of whole groups of equal ``keys``, about a batch at a time, and
    where the groups begin (and the last one ends)."""

    def changes(rows: pa.RecordBatch | pa.Table) -> np.ndarray:
        new = np.zeros(rows.num_rows, bool)
        for k in keys:
            c = rows.column(k).to_numpy(zero_copy_only=False) if isinstance(rows, pa.RecordBatch) else rows.column(k).to_numpy()
            new[1:] |= c[1:] != c[:-1]
        return np.flatnonzero(new)

    def out(held: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
        rows = pa.Table.from_batches(held).combine_chunks()
        return rows, np.r_[0, changes(rows), rows.num_rows]

    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cuts = changes(batch)
        fresh = last is not None and last != tuple(batch.column(k)[0].as_py() for k in keys)
        if len(cuts) or fresh:
            at = int(cuts[-1]) if len(cuts) else 0
            whole = [*held, batch.slice(0, at)] if at else held
            if whole:
                yield out(whole)
            held = []
            batch = batch.slice(at)
        held.append(batch)
        last = tuple(batch.column(k)[batch.num_rows - 1].as_py() for k in keys)
    if held:
        yield out(held)
