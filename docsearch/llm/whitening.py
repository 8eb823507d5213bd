"""Embedding whitening with distributed block matrices.

Rows hold a vector of whole numbers (fixed-point entries, ``array<long>``), so the number of
rows ``n`` and the sum ``S`` of each dimension are exact. Centred rows ``x - S/n`` are indexed
into the blocks of a tall ``BlockMatrix``; its transpose times itself, split along the rows,
is the scatter, which ``eigh`` on the driver takes apart (a matrix of dimension by dimension).
A product with the whitening matrix projects the rows. For it the blocks are laid out as a
nearly square grid with the whitening matrix repeated down a diagonal: Spark deals a grid of
blocks over partitions by both sides, and would leave a tall one in a few large partitions.

A block holds up to ``block_rows`` rows of one task of the scan. One that holds fewer stands
for one filled up with zero rows, which change no product. ``BlockMatrix`` lists its block
numbers on the driver, so blocks grow with the table (``BLOCKS``).

Defined results: rows whose vector is null, holds a null or is shorter than the longest one
are left out, as is everything of a table without entries. Ids may be null, repeated and of
any type; repeated rows count as often as they stand there. A component without variance
(rank below the number of components, or a single row) has whitened values of 0 and does not
count for ``identity_error``. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.llm import common as C

COMPONENTS = 32
#: Bytes of a block, up to the number of blocks from which blocks grow instead.
BLOCK_BYTES = 1 << 20
BLOCKS = 100_000
#: Bytes of blocks that meet in one task of a product.
TASK_BYTES = 32 << 20
#: Share of the largest eigenvalue below which a component has no variance.
NO_VARIANCE = 1e-13


def fixed_point(entries: Column, scale: int, shift: int) -> Column:
    """Whole numbers ``floor(scale * entry) + shift`` of real entries; null for a vector that is
    null or holds null or non-finite entries."""
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(finite, F.transform(
        entries, lambda c: F.floor(c.cast("double") * scale).cast("long") + shift))


@dataclass(frozen=True)
class Whitening:
    """Number of rows, exact sums, eigenvalues from the largest, and the whitening matrix."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    trace: float
    matrix: np.ndarray


def _matrix_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _summer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and sums of each dimension, by length of the vector."""
    held: dict[int, list] = {}
    for batch in batches:
        lengths = np.asarray(batch.column(0).value_lengths())
        for length in np.unique(lengths).tolist():
            x = _matrix_of(batch.column(0).filter(pa.array(lengths == length)))
            of = held.setdefault(length, [0, np.zeros(length, np.int64)])
            of[0] += len(x)
            of[1] += x.sum(axis=0, dtype=np.int64) if length else 0
    for length, (n, sums) in held.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([length] * max(length, 1)), pa.array(range(max(length, 1))),
             pa.array([n] * max(length, 1)), pa.array(sums if length else [0])],
            names=["length", "dimension", "n", "total"])


def _blocker(n: int, sums: np.ndarray, block_rows: int):
    """Blocks of centred rows with the ids and the exact deviations of their rows."""
    most = int(np.sqrt((1 << 63) / max(len(sums), 1))) - 1

    def block(part: int, number: int, ids: list, rows: list) -> pa.RecordBatch:
        spread = np.concatenate(rows) * n - sums
        if np.abs(spread).max() > most:
            spread_wide = spread.astype(object)
            deviation = [Decimal(int(x)) for x in np.square(spread_wide).sum(axis=1)]
        else:
            deviation = np.square(spread).sum(axis=1)
        # A matrix keeps its values column by column.
        values = pa.array((spread / n).ravel(order="F"))
        ids = pa.concat_arrays(ids)
        matrix = [
            pa.array([1], pa.int8()), pa.array([len(spread)], pa.int32()),
            pa.array([len(sums)], pa.int32()), pa.nulls(1, pa.list_(pa.int32())),
            pa.nulls(1, pa.list_(pa.int32())), pa.ListArray.from_arrays([0, len(values)], values),
            pa.array([False])]
        return pa.RecordBatch.from_arrays([
            pa.array([part], pa.int64()), pa.array([number], pa.int64()),
            pa.ListArray.from_arrays([0, len(ids)], ids),
            pa.ListArray.from_arrays(
                [0, len(ids)], pa.array(deviation).cast(pa.decimal128(38, 0))),
            pa.StructArray.from_arrays(matrix, [f.name for f in MatrixUDT.sqlType().fields]),
        ], names=["part", "number", "ids", "deviations", "matrix"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, ids, rows, held = TaskContext.get().partitionId(), 0, [], [], 0
        for batch in batches:
            x, at = _matrix_of(batch.column(1)), 0
            while at < len(x):
                take = min(block_rows - held, len(x) - at)
                ids.append(batch.column(0).slice(at, take))
                rows.append(x[at:at + take])
                held, at = held + take, at + take
                if held == block_rows:
                    yield block(part, number, ids, rows)
                    number, ids, rows, held = number + 1, [], [], 0
        if held:
            yield block(part, number, ids, rows)
    return run


def _block_matrix(blocks: DataFrame, rows: int, columns: int) -> BlockMatrix:
    """Blocks (``row, column, matrix``) as a matrix: what its constructor does for an RDD, but
    without passing every value through a Python object."""
    at = F.struct(F.col("row").cast("long"), F.col("column").cast("long"))
    typed = blocks.select(at.alias("at"), "matrix")
    return BlockMatrix(callMLlibFunc("createBlockMatrix", typed, rows, columns, 0, 0), rows, columns)


def _split_product(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """A product whose inner dimension is split over tasks; the Python method lacks the number."""
    a, b = (m._java_matrix_wrapper._java_model for m in (left, right))
    return BlockMatrix(a.multiply(b, splits), left.rowsPerBlock, right.colsPerBlock)


def _blocks_of(matrix: BlockMatrix) -> DataFrame:
    """The blocks of a matrix: ``row, column, size, values`` (column by column)."""
    found = callMLlibFunc("getMatrixBlocks", matrix._java_matrix_wrapper._java_model)
    at, block = (F.col(c) for c in found.columns)
    block = F.unwrap_udt(block)
    return found.select(at.getItem("_1").alias("row"), at.getItem("_2").alias("column"),
                        block["numRows"].alias("size"), block["values"].alias("values"))


def _totals(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of the longest vectors and their exact sums."""
    parts = rows.select("x").mapInArrow(
        _summer, "length long, dimension long, n long, total long").groupBy(
        "length", "dimension").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    longest = parts.groupBy("length").agg(
        F.max("n").alias("n"), F.collect_list(F.struct("dimension", "total")).alias("sums")
    ).orderBy(F.desc("length")).first()
    if longest is None or longest["length"] == 0:
        return 0, np.zeros(0, np.int64)
    return longest["n"], np.array([s["total"] for s in sorted(longest["sums"])], np.int64)


def _moments(width: int):
    """Sums and products of projected rows, for their covariance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, product = np.zeros(width), np.zeros((width, width))
        for batch in batches:
            for values in batch.column(0):
                block = values.values.to_numpy(zero_copy_only=False).reshape(width, -1)
                total += block.sum(axis=1)
                product += block @ block.T
        cells = np.concatenate((total, product.ravel()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(cells))), pa.array(cells)], names=["cell", "value"])
    return run


def _rows_of(width: int):
    """Rows of (ids, deviations, values): one for each id, with its projected row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, deviations, values in zip(*batch.columns, strict=True):
                block = values.values.to_numpy(zero_copy_only=False).reshape(width, -1)
                flat = pa.array(np.ascontiguousarray(block.T).ravel())
                offsets = np.arange(block.shape[1] + 1, dtype=np.int32) * width
                yield pa.RecordBatch.from_arrays(
                    [ids.values, deviations.values, pa.ListArray.from_arrays(offsets, flat)],
                    names=["id", "deviation", "whitened"])
    return run


def _decompose(scatter: np.ndarray, n: int, sums: np.ndarray, components: int) -> Whitening:
    covariance = (scatter + scatter.T) / (2 * n)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = values[order], vectors[:, order]
    held = values > NO_VARIANCE * max(float(values[0]), 1e-300)
    scale = np.where(held, 1 / np.sqrt(np.where(held, values, 1.0)), 0.0)
    return Whitening(n, sums, np.where(held, values, 0.0), float(np.trace(covariance)),
                     vectors * scale)


def whiten(vectors: DataFrame, column: str = "x", id_column: str = "id",
           components: int = COMPONENTS, block_rows: int | None = None,
           task_bytes: int = TASK_BYTES) -> DataFrame:
    """``id, n, deviation, whitened, explained, identity_error`` for every row that is kept.

    ``column`` holds the vectors (``array<long>``). ``deviation`` is the exact sum of the squares
    of ``n*x - S`` as a decimal, ``whitened`` and ``explained`` are arrays with an entry for
    each component, up to ``components``, and ``identity_error`` is the largest absolute entry
    of the covariance of the whitened rows minus the identity, measured on these rows.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema[id_column].dataType
    whole = F.col(column).isNotNull() & F.forall(F.col(column), lambda c: c.isNotNull())
    rows = vectors.select(F.col(id_column).alias("id"), F.col(column).alias("x")).filter(whole)
    n, sums = _totals(rows)
    schema = T.StructType([
        T.StructField("id", id_type), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.DecimalType(38, 0)),
        T.StructField("whitened", T.ArrayType(T.DoubleType())),
        T.StructField("explained", T.ArrayType(T.DoubleType())),
        T.StructField("identity_error", T.DoubleType())])
    if n == 0:
        return spark.createDataFrame([], schema)
    dimension, width = len(sums), min(components, len(sums))
    if block_rows is None:
        block_rows = max(BLOCK_BYTES // (8 * dimension), -(-n // BLOCKS), 1)
    per_task = max(task_bytes // (8 * dimension * block_rows), 1)

    # The same scan gives the same blocks each time, so a block is known by its task and number.
    made = rows.filter(F.size("x") == dimension).mapInArrow(
        _blocker(n, sums, block_rows), T.StructType([
            T.StructField("part", T.LongType()), T.StructField("number", T.LongType()),
            T.StructField("ids", T.ArrayType(id_type)),
            T.StructField("deviations", T.ArrayType(T.DecimalType(38, 0))),
            T.StructField("matrix", MatrixUDT())]))
    parts = made.rdd.getNumPartitions()
    blocks = made.withColumn("row", F.col("number") * parts + F.col("part"))
    most = -(-n // block_rows) + parts
    tall = _block_matrix(blocks.withColumn("column", F.lit(0)), block_rows, dimension)
    tasks = max(-(-most // per_task), min(C.parallelism(spark), most))
    scatter = _split_product(tall.transpose(), tall, tasks).toLocalMatrix().toArray()
    fitted = _decompose(scatter, n, sums, components)

    grid = max(int(np.sqrt(most)), 1)
    folded = _block_matrix(blocks.withColumns(
        {"row": F.floor(F.col("row") / grid), "column": F.col("row") % grid}), block_rows, dimension)
    # The product has as many partitions as the larger of its sides.
    diagonal = spark.sparkContext.parallelize(range(grid), tasks)
    matrix = DenseMatrix(dimension, width, fitted.matrix.ravel(order="F"))
    projected = folded.multiply(BlockMatrix(
        diagonal.map(lambda g: ((g, g), matrix)), dimension, width))
    found = _blocks_of(projected).select(
        (F.col("row") * grid + F.col("column")).alias("row"), "values")
    cells = found.select("values").mapInArrow(
        _moments(width), "cell long, value double").groupBy("cell").agg(
        F.sum("value").alias("value")).orderBy("cell").collect()
    flat = np.array([c["value"] for c in cells])
    mean = flat[:width] / n
    covariance = flat[width:].reshape(width, width) / n - np.outer(mean, mean)
    held = fitted.values > 0
    error = np.abs(covariance - np.eye(width))[np.ix_(held, held)].max(initial=0.0)
    explained = fitted.values / fitted.trace if fitted.trace > 0 else fitted.values
    out = blocks.select("row", "ids", "deviations").join(found, "row").select(
        "ids", "deviations", "values").mapInArrow(_rows_of(width), T.StructType(
            [schema["id"], schema["deviation"], schema["whitened"]]))
    return out.select(
        "id", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.array(*[F.lit(float(e)) for e in explained]).alias("explained"),
        F.lit(float(error)).alias("identity_error"))
