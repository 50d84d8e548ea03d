"""Order statistics without sorting one group inside one task.

Every row gets a cell that never decreases in the sort order. A histogram of the
cells (small) gives each cell the weight that lies before it, and only the rows of
one cell are sorted together: a group that holds a third of all rows is spread over
its cells. Cells of hashes come from the hash alone; those of numbers, texts and scores, which may sit close together,
come from sampled bounds.
Rows should be distinct in the sort order (group first): one repeated value is then
one row with a weight and not a crowded cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salvor.operators.sizes import stored

NULLS_LAST = 2**62


def id_cell(row_id: Column, block: int = 1_000_000) -> Column:
    """Cells of ``block`` consecutive row numbers."""
    return F.coalesce(F.floor(row_id / F.lit(block)).cast("bigint"), F.lit(NULLS_LAST))


def hash_cell(hashed: Column, bits: int = 20, width: int = 64) -> Column:
    """2^bits equal cells for a uniform hash of ``width`` bits; ``cell_bits`` has the bits for a number of rows."""
    return F.shiftright(hashed, width - bits)


def cell_bits(rows: int, cell_rows: int = 4096) -> int:
    """Bits of ``hash_cell`` for cells of about ``cell_rows`` of so many rows; more cells are never listed than rows need."""
    return max(1, min(40, (rows // cell_rows).bit_length()))


def ranged(df: DataFrame, order: Sequence[Column | str], into: str, parts: int | None = None) -> DataFrame:
    """Add a cell that follows ``order``, from bounds that Spark samples, so that cells have even sizes for any
    values. The frame is kept, as a second sampling could set other bounds."""
    dealt = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    return stored(dealt.withColumn(into, F.spark_partition_id()))


def _weights(weights: dict[str, Column | str]) -> dict[str, Column]:
    return {n: F.col(w) if isinstance(w, str) else w for n, w in weights.items()}


def _offsets(placed: DataFrame, by: list[str], weights: dict[str, Column]) -> DataFrame:
    """Per (group, cell): its weight, the weight in earlier cells, the group's weight."""
    sizes = placed.groupBy("_at").agg(*[F.sum(w).alias(f"{n}_size") for n, w in weights.items()])
    group = Window.partitionBy(*[F.col(f"_at.{b}") for b in by])
    earlier = group.orderBy("_at._cell").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        "*",
        *[F.coalesce(F.sum(f"{n}_size").over(earlier), F.lit(0)).alias(f"{n}_offset") for n in weights],
        *[F.sum(f"{n}_size").over(group).alias(f"{n}_total") for n in weights],
    )


def _running(
    placed: DataFrame, offsets: DataFrame, order: list[Column], weights: dict[str, Column]
) -> DataFrame:
    # One struct key: its missing parts compare as equal, and the join and the
    # window below share one hash partitioning.
    inside = Window.partitionBy("_at").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = placed.join(offsets, "_at")
    for n, w in weights.items():
        before = F.col(f"{n}_offset") + F.coalesce(F.sum(w).over(inside), F.lit(0))
        joined = joined.withColumn(f"{n}_before", before)
    return joined


def _placed(df: DataFrame, by: list[str], cell: Column) -> DataFrame:
    return df.withColumn("_at", F.struct(*by, cell.alias("_cell")))


def running_position(
    df: DataFrame,
    order: Sequence[Column | str],
    cell: Column,
    weights: dict[str, Column | str],
    *,
    by: Sequence[str] = (),
) -> DataFrame:
    """Add ``<name>_before`` and ``<name>_total`` for each of ``weights``: the weight
    sorted before the row inside its group, and the weight of the whole group."""
    by, weights = list(by), _weights(weights)
    order = [o if isinstance(o, Column) else F.col(o).asc_nulls_last() for o in order]
    placed = _placed(df, by, cell)
    ranked = _running(placed, _offsets(placed, by, weights), order, weights)
    return ranked.drop("_at", *[f"{n}_{part}" for n in weights for part in ("size", "offset")])


def number_rows(df: DataFrame, order, cell: Column, into: str, *, start: int = 1, by=()) -> DataFrame:
    """Dense numbers from ``start`` in sort order, over the frame or inside each group."""
    placed = running_position(df, order, cell, {"row": F.lit(1)}, by=by)
    return placed.withColumn(into, (F.col("row_before") + start).cast("bigint")).drop("row_before", "row_total")


def frequencies(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct present values with their counts; the map side combines copies."""
    return df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))


def exact_quantiles(
    freq: DataFrame,
    value: str,
    probabilities: Sequence[float],
    *,
    by: Sequence[str] = (),
    weight: str = "n",
    cell: Column | None = None,
) -> DataFrame:
    """Linear-interpolated quantiles per group from a frequency table.

    Returns ``by`` + ``q`` (array in the order of ``probabilities``). Only the cells
    that hold a wanted position are sorted; all others drop out at the join. Cells come from sampled
    bounds of the values, so close values and outliers alike fill them evenly; ``cell`` gives others.
    """
    by, weights = list(by), _weights({"w": weight})
    if cell is None:
        freq = ranged(freq, [*by, F.col(value).asc_nulls_last()], "_range")
    placed = _placed(freq, by, F.col("_range") if cell is None else cell)

    def position(p: float) -> Column:
        return (F.col("w_total") - 1) * F.lit(float(p))

    holds = F.lit(False)
    for k in (end(position(p)) for p in probabilities for end in (F.floor, F.ceil)):
        holds = holds | ((F.col("w_offset") <= k) & (k < F.col("w_offset") + F.col("w_size")))
    ranked = _running(placed, _offsets(placed, by, weights).filter(holds), [F.col(value)], weights)

    def at(k: Column) -> Column:
        covers = (F.col("w_before") <= k) & (k < F.col("w_before") + F.col(weight))
        return F.max(F.when(covers, F.col(value).cast("double")))

    ends = ranked.groupBy(*by).agg(
        *[
            part
            for i, p in enumerate(probabilities)
            for part in (
                at(F.floor(position(p))).alias(f"_lo{i}"),
                at(F.ceil(position(p))).alias(f"_hi{i}"),
            )
        ],
        F.max("w_total").alias("w_total"),
    )
    values = []
    for i, p in enumerate(probabilities):
        share = position(p) - F.floor(position(p))
        values.append(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * share)
    return ends.select(*by, F.array(*values).alias("q"))


def percent_ranks(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Frequency table of (by, value) with ``p_rank`` = (rank - 1) / (rows - 1), nulls last."""
    freq = df.groupBy(*by, value).agg(F.count("*").alias("n"))
    cells = ranged(freq, [*by, F.col(value).asc_nulls_last()], "_range")
    placed = running_position(cells, [value], F.col("_range"), {"w": "n"}, by=by)
    share = F.when(F.col("w_total") > 1, F.col("w_before") / (F.col("w_total") - 1)).otherwise(F.lit(0.0))
    return placed.select(*by, value, "n", share.alias("p_rank"))
