"""Whitening of embeddings with distributed block matrices.

Rows are numbered densely and cut into blocks of rows. The transposed block matrix times
itself is the scatter of the centred rows, a matrix of the dimensions' size, whose
eigenvectors are computed on the driver. The block matrix times the whitening matrix gives
the whitened rows. The middle dimension of the first product is split, so every block
meets its transpose in a task of its own and only sums of the dimensions' size are shuffled.

Sums of the integer entries are exact; rows are centred as n * x - S, an exact integer, and
divided by n once.

Defined results: vectors that are null, that hold null or non-finite entries, or entries whose integer
does not fit a long, are dropped; of vectors of several lengths those of the most frequent
length stay (of equally frequent ones the longer), and empty vectors are dropped; repeated rows and
ids are rows each, also with null ids; a deviation beyond a long is null; components without variance
whiten to 0.0 and count in identity_error as 0.0 - 1; an empty table gives an empty table. All columns
but the id are left out, so none can clash.
"""

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.session import materialize

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
# Entries of a block (8 bytes each). The driver plans a product by the places of its
# blocks, so more rows give larger blocks, up to 64 MB, before they give more of them.
BLOCK_ENTRIES = 1 << 17
MOST_ENTRIES = 1 << 23
FEW_BLOCKS = 20_000
# Blocks multiplied in one task of the scatter.
BLOCKS_A_TASK = 8
# A component has no variance below this share of the largest eigenvalue.
NO_VARIANCE = 1e-12

RESULT = T.StructType([
    T.StructField("component", T.IntegerType()),
    T.StructField("whitened", T.DoubleType()),
    T.StructField("explained", T.DoubleType()),
])


def integer_vectors(vectors: DataFrame, key="vec_id", vector="embedding") -> DataFrame:
    """(key, x) of the rows that remain; x is an array of longs of one length."""
    entry = F.col("v").cast("array<double>")
    scaled = F.transform(entry, lambda c: F.floor(SCALE * c))
    # 2^62 keeps the shifted value within a long.
    good = F.forall(entry, lambda c: F.coalesce(F.abs(c) < float(2**62) / SCALE, F.lit(False)))
    rows = vectors.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").alias("v"))
    rows = rows.filter(F.col("v").isNotNull() & (F.size("v") > 0)).filter(good)
    rows = rows.select("id", F.transform(scaled, lambda c: c.cast("bigint") + SHIFT).alias("x"))
    lengths = rows.groupBy(F.size("x").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    usual = lengths.orderBy(F.desc("rows"), F.desc("n")).first()
    return rows.filter(F.size("x") == (usual.n if usual else 0))


def numbered(rows: DataFrame) -> DataFrame:
    """Stored `rows` with `at`, a dense number from 0, without sorting or moving them.

    Rows are numbered in their stored part; the parts' counts give the first number of each.
    """
    marked = rows.withColumn("mark", F.monotonically_increasing_id())
    marked = materialize(marked.select("*", F.shiftright("mark", 33).alias("part")))
    counts = marked.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    starts, first = [], 0
    for part, n in sorted(map(tuple, counts.collect())):  # a row per task
        starts.append((part, first))
        first += n
    offsets = rows.sparkSession.createDataFrame(starts, "part bigint, first bigint")
    within = F.col("mark").bitwiseAND(F.lit((1 << 33) - 1))
    return marked.join(F.broadcast(offsets), "part").withColumn("at", F.col("first") + within)


def exact_sums(rows: DataFrame, size: int):
    """(number of rows, sums of each dimension) as Python integers."""
    columns = [F.sum(F.col("x")[i].cast("decimal(20,0)")) for i in range(size)]
    found = rows.agg(F.count(F.lit(1)), *columns).first()
    return found[0], [int(total or 0) for total in found[1:]]


def block_matrix(rows: DataFrame, n: int, size: int) -> BlockMatrix:
    """Block matrix of (at, row): columns `at` and `row`, an array of doubles."""
    entries = min(max(BLOCK_ENTRIES, n * size // FEW_BLOCKS), MOST_ENTRIES)
    block_rows = max(1, min(entries // size, n))
    vectors = rows.select("at", array_to_vector("row").alias("row"))
    vectors = MLUtils.convertVectorColumnsFromML(vectors, "row")
    return IndexedRowMatrix(vectors, n, size).toBlockMatrix(block_rows, size)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The transposed matrix times the matrix, split along its rows."""
    blocks = -(-matrix.numRows() // matrix.rowsPerBlock)
    splits = max(1, -(-blocks // BLOCKS_A_TASK))
    left = matrix.transpose()._java_matrix_wrapper._java_model
    product = left.multiply(matrix._java_matrix_wrapper._java_model, splits)
    size = matrix.numCols()
    return np.array(product.toLocalMatrix().toArray()).reshape(size, size, order="F")


def projected(matrix: BlockMatrix, basis: np.ndarray) -> DataFrame:
    """(at, row) of the rows times `basis`."""
    spark_context = matrix.blocks.context
    size, width = basis.shape
    local = DenseMatrix(size, width, basis.flatten(order="F").tolist())
    right = BlockMatrix(spark_context.parallelize([((0, 0), local)], 1), size, width)
    product = matrix.multiply(right).toIndexedRowMatrix()
    rows = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    return rows.select(F.col(rows.columns[0]).alias("at"), vector_to_array(rows.columns[1]).alias("row"))


def principal_components(covariance: np.ndarray):
    """(eigenvalues, unit eigenvectors as columns) by falling eigenvalue."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    return values[::-1], vectors[:, ::-1]


def whiten(vectors: DataFrame, key="vec_id", vector="embedding", components=COMPONENTS) -> DataFrame:
    """Rows (key, at, component, n, deviation, whitened, explained, identity_error).

    A row for each vector that remains and each component; `at` tells rows of one id apart.
    """
    spark = vectors.sparkSession
    rows = numbered(integer_vectors(vectors, key, vector))
    first = rows.select(F.size("x").alias("size")).first()
    size = first.size if first else 0
    n, sums = exact_sums(rows, size) if size else (0, [])
    if not n:
        empty = f"`{key}` {dict(vectors.dtypes)[key]}, at bigint, component int, n bigint, deviation bigint, "
        return spark.createDataFrame([], empty + "whitened double, explained double, identity_error double")

    totals = F.array(*[F.lit(total).cast("decimal(38,0)") for total in sums])
    # n * x - S is exact in decimals of 38 digits; a double holds it to its last bit.
    apart = F.zip_with("x", totals, lambda x, s: (x.cast("decimal(19,0)") * F.lit(n).cast("decimal(18,0)") - s))
    centred = rows.select("at", "id", apart.alias("d"))
    over = F.transform("d", lambda d: F.try_multiply(d.try_cast("bigint"), d.try_cast("bigint")))
    deviation = F.aggregate(over, F.lit(0).cast("bigint"), lambda a, b: F.try_add(a, b))
    shares = F.transform("d", lambda d: d.cast("double") / float(n))
    centred = materialize(centred.select("at", "id", deviation.alias("deviation"), shares.alias("row")))

    matrix = block_matrix(centred, n, size)
    covariance = scatter(matrix) / n
    values, basis = principal_components(covariance)
    width = min(components, size)
    varies = values[:width] > max(values[0], 0.0) * NO_VARIANCE
    with np.errstate(divide="ignore", invalid="ignore"):
        scale = np.where(varies, 1 / np.sqrt(np.where(varies, values[:width], 1.0)), 0.0)
    whitened = materialize(projected(matrix, basis[:, :width] * scale))

    check = scatter(block_matrix(whitened, n, width)) / n
    error = float(np.abs(check - np.eye(width)).max())
    trace = float(np.trace(covariance))
    parts = [float(value / trace) if trace > 0 else 0.0 for value in values[:width]]

    both = centred.select("at", "id", "deviation").join(whitened, "at")
    both = both.select(
        F.col("id").alias(key), "at", F.lit(n).cast("bigint").alias("n"), "deviation",
        F.posexplode("row").alias("component", "whitened"),
    )
    explained = F.array(*[F.lit(part) for part in parts])
    return both.select(
        f"`{key}`", "at", (F.col("component") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
        explained[F.col("component")].alias("explained"), F.lit(error).alias("identity_error"),
    )
