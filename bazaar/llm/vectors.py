"""Blocks of vectors that meet blocks of queries."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.common import pick, stored


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           nonzero: bool = False) -> DataFrame:
    """(id, vector) of the rows that take part: an id, and a vector that is not
    null or empty and holds no null or non-finite component; with ``nonzero``
    not zero throughout either. Components are doubles."""
    own = pick(vectors, **{id_col: "long", vector_col: "array<double>"})
    v = F.col(vector_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    if nonzero:
        fine = fine & F.exists(v, lambda x: x != 0)
    return own.where(F.col(id_col).isNotNull() & (F.size(v) > 0) & fine).select(
        F.col(id_col).alias("id"), v.alias("vector"))


def matrix(column: pa.ChunkedArray | pa.Array, dtype) -> np.ndarray:
    """Rows of equal length as a matrix."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = array.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(len(array), -1), dtype=dtype)


def numbered(rows: DataFrame) -> DataFrame:
    """The rows with a number each. Only for frames read from files without a
    shuffle, where a task that runs again gives its rows the same numbers."""
    return rows.withColumn("row_", F.monotonically_increasing_id())


def asked(queries: DataFrame) -> DataFrame:
    """The queries, one row for each id with its least vector; stored, so that
    their numbers are the same for every task that reads them."""
    return numbered(stored(queries.groupBy("id").agg(F.min("vector").alias("vector")), "queries"))


def in_blocks(candidates: DataFrame, queries: DataFrame, keys: list[str], blocks: Column, query_blocks: Column,
              compare, schema: str) -> DataFrame:
    """Bring each block of candidates together with each block of the queries
    of the same keys, and run ``compare(candidates, queries)`` on the two Arrow
    tables. ``blocks`` and ``query_blocks`` give the number of blocks for the
    keys. Both frames are ``numbered``: rows are dealt to blocks evenly,
    whatever their ids and vectors, so that neither repeated rows nor a large
    group make a large block.

    ``compare`` returns (query_id, id, score).
    """
    row = F.xxhash64("row_")
    left = (candidates.withColumn("block_", F.pmod(row, blocks).cast("int"))
            .withColumn("query_block_", F.explode(F.sequence(F.lit(0), (query_blocks - 1).cast("int")))))
    right = (queries.withColumn("query_block_", F.pmod(row, query_blocks).cast("int"))
             .withColumn("block_", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int")))))
    key = [*keys, "block_", "query_block_"]
    empty = pa.table({"query_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()),
                      "score": pa.array([], pa.int64() if schema == "long" else pa.float64())})

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        return compare(a, b) if a.num_rows and b.num_rows else empty

    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        meet, f"query_id long, id long, score {schema}")


def best_first(found: DataFrame, k: int, id_col: str = "vec_id") -> DataFrame:
    """(query_id, rank, id, score): the ``k`` highest scores of each query
    among the blocks' results, ties to the smaller id. Each task keeps ``k``
    rows of a query before they are shuffled."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
