"""Places in an order, counted in pieces so that neither a table nor a key has to fit one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of a piece of the order, about, and how many pieces there may be.
PIECE_ROWS, MOST_PIECES = 1_000_000, 2000


def placed(rows: DataFrame, keys: Sequence[str] = (), order: str = "ord", name: str = "_n", piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``rows`` with their place, from 1, in the order of the number ``order`` among those with equal keys.

    Quantiles cut the order into pieces; places within a piece come from a
    window over key and piece, and what lies before it from the pieces' counts,
    of which there are no more than keys times pieces.  Rows that tie in
    ``order`` share a piece; those without one come last.
    """
    total, by = rows.count(), F.col(order).asc_nulls_last()
    pieces = min(MOST_PIECES, -(-total // piece_rows))
    if pieces <= 1:
        return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(by)).cast("long"))
    cuts = rows.agg(F.percentile_approx(order, [k / pieces for k in range(1, pieces)], 10 * pieces).alias("q")).first()["q"]
    cuts = F.array(*[F.lit(x) for x in sorted(set(cuts))])
    # the random zero keeps the optimizer from carrying the lambda over to the other side of the join, where ``order`` isn't
    cut = rows.withColumn("_piece", F.size(F.filter(cuts, lambda x: F.coalesce(x < F.col(order), F.lit(True)))) + (F.rand(0) * 0).cast("int"))
    counts = cut.groupBy(*keys, "_piece").agg(F.count("*").alias("_count"))
    before = F.coalesce(F.sum("_count").over(Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_piece").alias("_p"), before.alias("_before"))
    on = F.col("_piece") == F.col("_p")
    for i, k in enumerate(keys):
        on &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    here = F.row_number().over(Window.partitionBy(*keys, "_piece").orderBy(by))
    return cut.withColumn("_here", here).join(counts, on).select(*rows.columns, (F.col("_before") + F.col("_here")).alias(name))
