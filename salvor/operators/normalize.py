"""Split a wide claim file into the star, and put it back together."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salvor.functions.scalars import stripped, to_bool, whole
from salvor.operators.ordering import id_cell, number_rows
from salvor.operators.sizes import beside, split_by_slots, stored
from salvor.schema import DIMENSION_KEYS

CLAIM_COLUMNS = (
    "claim_number",
    "subrogation",
    "claim_est_payout",
    "liab_prct",
    "claim_date",
    "claim_day_of_week",
    "channel",
    "zip_code",
    "zip",
    "witness_present_ind",
    "policy_report_filed_ind",
    "in_network_bodyshop",
)
# Natural columns of each dimension, in the order the dimensions are attached.
DIMENSION_COLUMNS = {
    "accident": ("accident_site", "accident_type"),
    "policyholder": (
        "annual_income",
        "high_education_ind",
        "email_or_tel_available",
        "address_change_ind",
        "living_status",
        "past_num_of_claims",
    ),
    "vehicle": (
        "vehicle_made_year",
        "vehicle_category",
        "vehicle_price",
        "vehicle_color",
        "vehicle_weight",
        "vehicle_mileage",
        "age_of_vehicle",
    ),
    "driver": ("year_of_born", "gender", "age_of_DL", "safety_rating"),
}


def strip_all(df: DataFrame) -> DataFrame:
    """Trim every text column; other types pass through."""
    return df.select(
        *[
            stripped(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema
        ]
    )


def pick(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The wanted columns that exist, in the wanted order."""
    return [n for n in names if n in df.columns]


def claim_columns(df: DataFrame, key: str = "claim_number") -> list[str]:
    """Fact columns that exist: key first, ``zip`` only without ``zip_code``."""
    kept = pick(df, CLAIM_COLUMNS)
    if "zip_code" in kept:
        kept = [c for c in kept if c != "zip"]
    return ([key] if key in kept else []) + [c for c in kept if c != key]


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    )


def build_dimension(df: DataFrame, columns: Sequence[str], key: str, row_id: str = "row_id") -> DataFrame:
    """Distinct attribute rows with keys 1..n in first-seen order.

    Rows whose attributes are all empty are left out. The distinct rows are
    numbered by blocks of row ids, so no task sorts the whole dimension.
    """
    columns = pick(df, columns)
    some = reduce(lambda a, b: a | b, [F.coalesce(F.col(c), F.lit("")) != "" for c in columns])
    first = df.filter(some).groupBy(*columns).agg(F.min(row_id).alias("_first"))
    numbered = number_rows(first, ["_first"], id_cell(F.col("_first")), key)
    return numbered.select(*columns, key)


def keep_first(df: DataFrame, key: str, order: str | Column) -> DataFrame:
    """One row per key: the earliest. The rank limit also runs before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return df.withColumn("_rn", rank).filter("_rn = 1").drop("_rn")


def keep_first_stored(df: DataFrame, key: str, order: str | Column) -> DataFrame:
    """``keep_first`` of a frame that may be read twice: keys are counted alone, and only the rows of keys that repeat are shuffled."""
    again = stored(df.groupBy(key).count().filter("count > 1").select(key))
    once, more = split_by_slots(df, F.col(key), again)
    return once.unionByName(keep_first(more, key, order))


def attach_key(base: DataFrame, dimension: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Left join on all natural columns; missing equals missing."""
    columns = [c for c in columns if c in dimension.columns]
    if not columns:
        return base
    return base.alias("b").join(dimension.alias("d"), _same("b", "d", columns), "left").select(
        "b.*", f"d.{key}"
    )


def split_wide(df: DataFrame, row_id: str = "row_id") -> dict[str, DataFrame]:
    """Wide text frame -> the five tables (claim carries the surrogate keys).

    Each dimension is made from its few columns and stored, so that Spark knows its size and broadcasts it where it is small;
    those of more columns meet the claims last, when the columns of the others are gone. ``df`` is read once per
    dimension and twice for the claims, so it should be a file or a staged table.
    """
    clean = strip_all(df)
    tables = {
        name: stored(build_dimension(clean, columns, DIMENSION_KEYS[name], row_id))
        for name, columns in DIMENSION_COLUMNS.items()
        if pick(clean, columns)
    }
    kept = claim_columns(clean)
    claim = keep_first_stored(clean, "claim_number", row_id) if "claim_number" in kept else clean
    for name, dimension in sorted(tables.items(), key=lambda t: len(t[1].columns)):
        claim = attach_key(claim, dimension, DIMENSION_COLUMNS[name], DIMENSION_KEYS[name])
    tables["claim"] = claim.select(*kept, *pick(claim, DIMENSION_KEYS.values()))
    return tables


def repair_keys(df: DataFrame, keys: Iterable[str] = tuple(DIMENSION_KEYS.values())) -> DataFrame:
    """Missing or unparsable foreign keys become 0."""
    return df.withColumns({k: F.coalesce(whole(k), F.lit(0).cast("bigint")) for k in pick(df, keys)})


def orphans(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key has no dimension row."""
    return fact.join(dimension.select(key), key, "left_anti")


def attach_dimensions(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Fact left-joined to each dimension.

    No hint: Spark broadcasts a dimension only when its measured size allows it,
    and otherwise sort-merge joins with skewed keys split at run time.
    """
    for name, dimension in dimensions.items():
        fact = fact.join(dimension, DIMENSION_KEYS[name], "left")
    return fact


# Slots of a comparison: their digests are what it shuffles, and the rows of those that differ.
COMPARED = 1 << 12
WORDS = [f"_w{i}" for i in range(8)]


def _cell_text(name: str, kind: T.DataType) -> Column | None:
    """Text that two values of a column share if and only if a grouping takes them as equal; None for kinds without such a text."""
    value = F.col(f"`{name}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return (value + F.lit(0).cast(kind)).cast("string")  # one zero
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    plain = (T.IntegralType, T.DecimalType, T.BooleanType, T.DateType, T.TimestampNTZType)
    return value.cast("string") if kind == T.StringType() or isinstance(kind, plain) else None


def _with_digest(df: DataFrame, cells: Sequence[Column]) -> DataFrame:
    """Add the SHA-256 of a row as eight numbers of 32 bits, and its slot. Each cell is written with its length, so no two
    rows have one text."""
    text = F.concat(*[F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in cells])
    words = [F.conv(F.substring("_digest", 1 + 8 * i, 8), 16, 10).cast("bigint").alias(w) for i, w in enumerate(WORDS)]
    digested = df.withColumn("_digest", F.sha2(text.cast("binary"), 256)).select("*", *words).drop("_digest")
    return digested.withColumn("_slot", F.pmod(F.col(WORDS[0]), F.lit(COMPARED)).cast("int"))


def compare_frames(left: DataFrame, right: DataFrame, label: str = "subrogation") -> DataFrame:
    """One row: same column set, rows on each side, rows found on one side only.

    Rows are compared as a multiset, in slots of a SHA-256 of the whole row. Of each slot the rows of both sides are counted
    and their digests summed, 256 bits wide; a slot whose counts and sums agree has the same rows on both sides. The rows of
    all other slots are grouped together whole, which reads the frames a second time. Frames with columns that have no plain
    text (arrays, maps, collated text) are grouped whole at once.
    """
    columns = sorted(set(left.columns) & set(right.columns))
    match = set(left.columns) == set(right.columns)

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.filter(F.col(label).isNotNull()).select(*columns, F.lit(sign).alias("_side"))

    both = side(left, 1).unionByName(side(right, -1))
    rows = [F.count_if(F.col("_side") == 1).alias("_l"), F.count_if(F.col("_side") == -1).alias("_r")]
    cells = [_cell_text(f.name, f.dataType) for f in both.schema if f.name != "_side"]
    sums = None
    if all(c is not None for c in cells):
        both = _with_digest(both, cells)
        sums = stored(both.groupBy("_slot").agg(*rows, *[F.sum(F.col("_side") * F.col(w)).alias(w) for w in WORDS]))
        differ = sums.filter(reduce(lambda a, b: a | b, [F.col(w) != 0 for w in WORDS], F.col("_l") != F.col("_r")))
        both = both.join(F.broadcast(differ.select("_slot")), "_slot", "left_semi")
    net = both.groupBy(*columns).agg(*rows)
    only = F.greatest(F.col("_l") - F.col("_r"), F.lit(0))
    other = F.greatest(F.col("_r") - F.col("_l"), F.lit(0))
    counts = [F.coalesce(F.sum("_l"), F.lit(0)).alias("left_rows"), F.coalesce(F.sum("_r"), F.lit(0)).alias("right_rows")]
    alone = [F.coalesce(F.sum(only), F.lit(0)).alias("only_left"), F.coalesce(F.sum(other), F.lit(0)).alias("only_right")]
    matched = F.lit(int(match)).alias("columns_match")
    if sums is None:
        return net.agg(matched, *counts, *alone)
    if differ.isEmpty():
        return sums.agg(matched, *counts, *[F.lit(0).cast("bigint").alias(n) for n in ("only_left", "only_right")])
    return beside(sums.agg(matched, *counts), net.agg(*alone))


def lenient_cast(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Cast the named columns that exist; what does not parse becomes missing."""
    casts = {
        c: (whole(c) if kind in ("bigint", "int") else F.col(c).try_cast(kind)).cast(kind)
        for c, kind in kinds.items()
        if c in df.columns
    }
    return df.withColumns(casts)


CLAIM_KINDS = {
    "subrogation": "double",
    "claim_est_payout": "double",
    "liab_prct": "double",
    "vehicle_key": "bigint",
    "channel": "string",
    "claim_day_of_week": "string",
    "witness_present_ind": "string",
    "policy_report_filed_ind": "string",
}
VEHICLE_KINDS = {
    "vehicle_price": "double",
    "vehicle_weight": "double",
    "vehicle_mileage": "double",
    "vehicle_made_year": "bigint",
    "vehicle_key": "bigint",
    "vehicle_category": "string",
    "vehicle_color": "string",
}


def clean_claim(df: DataFrame) -> DataFrame:
    return lenient_cast(df, CLAIM_KINDS).withColumns(
        {
            "witness_present": to_bool("witness_present_ind"),
            "policy_report_filed": to_bool("policy_report_filed_ind"),
        }
    )


def clean_vehicle(df: DataFrame) -> DataFrame:
    return lenient_cast(df, VEHICLE_KINDS)
