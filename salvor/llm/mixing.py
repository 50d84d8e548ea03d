"""Mixing sources to target weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salvor.llm.common import SPACES, WORD, key60, staged, table

WEIGHTS = (5.0, 2.0, 1.0)
CELL_ROWS = 16_384
# Cells of rows that carry their texts.
CARRIED_ROWS = 2048


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """sizes (source, source_size, rows) with ``target``.

    The table has a row for each source, so its windows over all of it are small. Weights
    repeat over the sources in code-point order, null last. All words are shared by weight; a source
    stops at ``most`` times its size, and the excess is shared by weight again. The fixed point
    is a water level: in order of cap / weight the first sources are full, and the level of the
    others is what remains over their weights.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    listed = sizes.select(
        "*",
        F.element_at(cycle, (F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights))) + 1).cast("int")).alias("weight"),
        (F.lit(float(most)) * F.col("source_size")).alias("cap"),
    )
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    rest = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    levels = listed.withColumn("level", level).withColumn("order", F.row_number().over(filling))
    water = F.min_by(F.when(F.col("level") * F.col("weight") < F.col("cap"), F.col("level")), F.when(F.col("level") * F.col("weight") < F.col("cap"), F.col("order"))).over(everything)
    return levels.withColumn("target", F.least(F.col("cap"), F.coalesce(water * F.col("weight"), F.col("cap")))).drop("level", "order", "cap", "weight")


def mix(docs: DataFrame, *, weights: Sequence[float] = WEIGHTS, most: float = 3.0, seed: str = "mix", cell_rows: int = CELL_ROWS, carry: bool = False) -> DataFrame:
    """doc_id, source, size, source_size, target, epochs, part, taken (words, repeats counted), and with ``carry`` the
    row itself as ``doc``.

    Every row gets a hash key; inside its source it lies in a cell of the key range (about
    ``cell_rows`` rows each, so a hot source has many), cells are summed and their offsets added
    to the running sum inside the cell: a distributed prefix sum in key order. The source takes
    whole epochs and then the rows up to its exact budget; the row at the cut gives its first
    ``part`` words.

    Null text has size 0; a null source is a source. Rows that repeat are rows of their own; ties
    of the key go by id and size. A source without words has target 0. An empty table gives none.
    """
    columns = ["doc_id", "source", word_count(F.col("text")).alias("size"), key60(F.lit(seed), F.col("doc_id")).alias("key")]
    base = staged(docs.select(*columns), "mix-base")
    # Carried rows are read again and not staged; among ties of key, id and size the text decides.
    carried, last = (["doc"], [F.xxhash64("doc.text")]) if carry else ([], [])
    whole = docs.select(*columns, F.struct(*docs.columns).alias("doc")) if carry else base
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    targets = source_targets(sizes, weights, most).withColumn("cells", F.greatest(F.lit(1), F.ceil(F.col("rows") / cell_rows))).drop("rows")
    targets = staged(targets.coalesce(1), "mix-targets").withColumnRenamed("source", "_source")
    # One row a source: Spark broadcasts it by its measured size.
    rows = whole.join(targets, whole["source"].eqNullSafe(targets["_source"])).drop("_source")
    rows = rows.withColumn("cell", F.floor(F.col("key") / F.lit(2.0**60) * F.col("cells")).cast("bigint"))
    cells = rows.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    offsets = cells.select(
        F.struct("source", "cell").alias("at"),
        F.coalesce(F.sum("cell_size").over(Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
    )
    inside = Window.partitionBy("at").orderBy("key", "doc_id", "size", *last).rowsBetween(Window.unboundedPreceding, -1)
    budget = F.floor("target").cast("bigint")
    words = F.greatest(F.col("source_size"), F.lit(1))
    placed = rows.withColumn("at", F.struct("source", "cell")).join(offsets, "at").select(
        *carried,
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.floor(budget / words).cast("bigint").alias("epochs"),
        (budget - F.floor(budget / words).cast("bigint") * words - F.col("offset") - F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("room"),
    )
    part = F.greatest(F.lit(0), F.least("size", "room")).cast("bigint")
    return placed.select("doc_id", "source", "size", "source_size", "target", "epochs", part.alias("part"), (F.col("epochs") * F.col("size") + part).alias("taken"), *carried)


def mixed_documents(docs: DataFrame, *, cell_rows: int = CARRIED_ROWS, **options) -> DataFrame:
    """The mix as documents: a row for each epoch that takes it whole, and one with its first words
    (single spaces between) where the budget cuts it. Every row keeps its own share, also where ids are missing or
    repeat. Rows travel through the mix as one struct, so no column clashes."""
    joined = mix(docs, cell_rows=cell_rows, carry=True, **options)
    part, text = F.col("part"), F.col("doc.text")
    copies = F.col("epochs") + F.when(part > 0, 1).otherwise(0)
    repeated = joined.filter(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies)))
    # The row at the cut gives a part in its last copy alone.
    cut = (F.col("copy") > F.col("epochs")) & (part < F.col("size"))
    words = F.split(F.regexp_replace(text, f"^{SPACES}", ""), SPACES)
    start = F.concat_ws(" ", F.slice(words, 1, F.greatest(F.lit(1), part).cast("int")))
    changed = {"text": start, "n_chars": F.length(start)}
    kinds = {f.name: f.dataType for f in docs.schema}
    return repeated.select(
        *[
            (F.when(cut, changed[c].cast(kinds[c])).otherwise(F.col("doc")[c]) if c in changed else F.col("doc")[c]).alias(c)
            for c in docs.columns
        ]
    )


def query(spark, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         ('0x' || substr(md5(concat('mix:', coalesce(doc_id::varchar, ''))), 1, 15))::bigint as key
  from documents
), s as (
  select source, sum(size)::bigint as source_size,
         [5.0, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight
  from d group by source
), f as (
  select *, 3.0::double * source_size as cap,
         row_number() over (order by 3.0::double * source_size / weight, source nulls last) as place
  from s
), l as (
  select *, ((select sum(source_size) from s)::double
             - coalesce(sum(cap) over (order by place rows between unbounded preceding and 1 preceding), 0))
            / sum(weight) over (order by place rows between current row and unbounded following) as level
  from f
), t as (
  select source, source_size,
         least(cap, coalesce((select arg_min(level, place) from l where level * weight < cap) * weight, cap)) as target
  from l
), p as (
  select d.*, t.source_size, t.target, floor(t.target)::bigint as budget, greatest(t.source_size, 1) as words,
         coalesce(sum(size) over (partition by d.source order by key, doc_id, size
                                  rows between unbounded preceding and 1 preceding), 0) as before
  from d join t on d.source is not distinct from t.source
)
select doc_id, size, source_size, target,
       ((budget // words) * size + greatest(0, least(size, budget % words - before)))::bigint as taken
from p
"""
