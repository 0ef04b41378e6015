"""Concatenating arrays and giving them new chunks.

chunks: dataset, var, chunk, origin, shape, values (row-major).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import closest_divisor


def rechunk_scheme(dims: DataFrame, preferred: DataFrame | None = None) -> DataFrame:
    """New chunk length of each dimension (dataset, dim, size): a preferred one, else near 10000 * size / total where the total is over 20000, else near a tenth; always a divisor."""
    total = dims.groupBy("dataset").agg(F.sum("size").alias("total"))
    rows = dims.join(total, "dataset")
    target = F.when(F.col("total") > 20000, 10000.0 * F.col("size") / F.col("total")).otherwise(F.col("size") / 10)
    if preferred is not None:
        rows = rows.join(preferred.select("dataset", "dim", "target"), ["dataset", "dim"], "left")
        target = F.coalesce(F.col("target").cast("double"), target)
    return rows.select("dataset", "dim", "size", closest_divisor(F.col("size"), target).alias("chunk"))


def to_cells(chunks: DataFrame) -> DataFrame:
    """Cells of chunks: the value's place in row-major order plus the chunk's origin."""
    each = chunks.select("dataset", "var", "origin", "shape", F.posexplode("values").alias("k", "value"))
    below = lambda i: F.aggregate(F.slice("shape", i + 2, F.size("shape")), F.lit(1).cast("bigint"), lambda a, x: a * x)
    idx = F.transform("shape", lambda s, i: (F.get("origin", i) + F.pmod(F.floor(F.col("k") / below(i)), s)).cast("int"))
    return each.select("dataset", "var", idx.alias("idx"), "value")


def to_chunks(cells: DataFrame, sides: list[int]) -> DataFrame:
    """Chunks of given side lengths from dense cells."""
    side = F.array(*[F.lit(s) for s in sides])
    rows = cells.withColumn("chunk", F.zip_with("idx", side, lambda i, s: F.floor(i / s).cast("int")))
    group = rows.groupBy("dataset", "var", "chunk").agg(F.array_sort(F.collect_list(F.struct("idx", "value"))).alias("c"))
    first, last = F.get("c", 0)["idx"], F.element_at("c", -1)["idx"]
    return group.select("dataset", "var", "chunk", first.alias("origin"), F.zip_with(first, last, lambda a, b: b - a + 1).alias("shape"), F.transform("c", lambda x: x["value"]).alias("values"))


def concatenate(cells: DataFrame, lengths: DataFrame, axis: int = 0) -> DataFrame:
    """Cells of ordered files as one array: each file is moved by the lengths of earlier ones.

    ``cells`` has file_ord; ``lengths`` (dataset, file_ord, length).
    """
    from .combine import chunk_offsets

    starts = chunk_offsets(lengths.select(F.col("dataset").alias("project_id"), "file_ord", F.lit("").alias("var"), F.col("length").alias("n"))).select(F.col("project_id").alias("dataset"), "file_ord", "start")
    moved = F.transform("idx", lambda c, i: F.when(i == axis, c + F.col("start").cast("int")).otherwise(c))
    return cells.join(starts, ["dataset", "file_ord"]).select("dataset", "var", moved.alias("idx"), "value")


#: Bytes of pieces that a task holds before it hands them on.
PIECE_BYTES = 100_000_000


def rechunk(chunks: DataFrame, sides: list[int]) -> DataFrame:
    """Chunks with new side lengths. Source chunks are cut along the new bounds first and whole blocks move, one task's new chunk at a time.

    A new chunk is one block in memory, so sides should keep it to some 100 MB.
    """
    import pyarrow as pa

    names = ["dataset", "var", "chunk", "origin", "shape", "values"]
    ints = pa.list_(pa.int32())
    kinds = [pa.string(), pa.string(), ints, ints, ints, pa.list_(pa.float64())]

    def pieces_of(row, values):
        """Cuts of one source chunk."""
        block = values.reshape(row["shape"])
        spans = [range(o // s, (o + n - 1) // s + 1) for o, n, s in zip(row["origin"], block.shape, sides, strict=True)]
        for target in np.ndindex(*[len(s) for s in spans]):
            new = [s[t] for s, t in zip(spans, target, strict=True)]
            low = [max(o, c * s) for o, c, s in zip(row["origin"], new, sides, strict=True)]
            high = [min(o + n, (c + 1) * s) for o, n, c, s in zip(row["origin"], block.shape, new, sides, strict=True)]
            piece = block[tuple(slice(a - o, b - o) for a, b, o in zip(low, high, row["origin"], strict=True))]
            yield row["dataset"], row["var"], new, low, list(piece.shape), piece.ravel()

    def cut(batches):
        held, size = [], 0

        def batch():
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)
            held.clear()
            return out

        for b in batches:
            about = b.select(["dataset", "var", "origin", "shape"]).to_pylist()
            lists = b.column(b.schema.get_field_index("values"))
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *lists.value_lengths().to_pylist()])
            for k, row in enumerate(about):
                for piece in pieces_of(row, flat[ends[k] : ends[k + 1]]):
                    held.append(piece)
                    size += piece[-1].nbytes
                    if size > PIECE_BYTES:
                        yield batch()
                        size = 0
        if held:
            yield batch()

    def join(key, pdf):
        low = np.min(np.stack(pdf["origin"].to_list()), axis=0)
        high = np.max(np.stack([np.add(o, s) for o, s in zip(pdf["origin"], pdf["shape"], strict=True)]), axis=0)
        block = np.full(high - low, np.nan)
        for row in pdf.itertuples(index=False):
            at = tuple(slice(o - a, o - a + n) for o, a, n in zip(row.origin, low, row.shape, strict=True))
            block[at] = np.asarray(row.values).reshape([int(x) for x in row.shape])
        return pd.DataFrame([(key[0], key[1], list(pdf["chunk"].iloc[0]), low.tolist(), list(block.shape), block.ravel())], columns=names)

    schema = "dataset string, var string, chunk array<int>, origin array<int>, shape array<int>, values array<double>"
    pieces = chunks.select(*names).mapInArrow(cut, schema)
    return pieces.withColumn("key", F.array_join(F.col("chunk").cast("array<string>"), ".")).groupBy("dataset", "var", "key").applyInPandas(join, schema)
