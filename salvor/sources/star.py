"""The claim star derived from the TPC-H-like test tables (mapping in FIXTURES.md).

Every frame is lazy: a query that uses three columns of ``claim`` reads only the
Parquet columns those three need.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salvor import schema as S
from salvor.functions.scalars import digest_below, flag
from salvor.operators.sizes import split_by_slots

DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
HOLD_OUT = (2000, 9)


def _conform(df: DataFrame, table_schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table_schema])


def learnable_label() -> Column:
    """A label that depends on liability and evidence, with a tenth of the rows flipped: about a quarter are 1."""
    evidence = (F.col("witness_present_ind") == "Y") | (F.col("policy_report_filed_ind") == 1)
    rule = flag((F.col("liab_prct") < 25) & evidence)
    return F.when(digest_below(F.col("claim_number"), "label", 10), 1 - rule).otherwise(rule)


# The columns of a line that say which of the lines with one claim number comes first.
SEEN = ("vehicle_key", "driver_key", "l_shipdate", "l_extendedprice", "l_quantity")


def _number() -> Column:
    """The claim number of a line."""
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def _claim_columns() -> dict[str, Column]:
    """The columns of a claim, from the stored values of its line."""
    order_key = F.col("l_orderkey")
    number = F.col("claim_number") - order_key * 10
    date = F.expr("l_shipdate + make_dt_interval(0, cast(l_orderkey % 24 as int))")
    return {
        "claim_number": F.col("claim_number"),
        "subrogation": F.when(F.col("_returned"), 1).otherwise(0),
        "claim_est_payout": F.col("l_extendedprice"),
        "liab_prct": ((F.col("vehicle_key") * 7 + number * 13) % 101).cast("double"),
        "claim_date": date,
        "claim_day_of_week": F.element_at(F.array(*map(F.lit, DAY_NAMES)), F.weekday(date) + 1),
        "channel": F.when(number % 3 == 0, "Broker").when(number % 3 == 1, "Phone").otherwise("Online"),
        "zip_code": F.lpad(((F.col("policyholder_key") * 37) % 99999).cast("string"), 5, "0"),
        "witness_present_ind": F.when(number == 7, F.lit(None)).when(F.col("_taxed"), "Y").otherwise("N"),
        "policy_report_filed_ind": F.when(F.col("_finished"), 1).otherwise(0),
        "in_network_bodyshop": F.when(F.col("l_quantity") < 25, "yes").otherwise("no"),
        "accident_key": 1 + order_key % 12,
        "policyholder_key": F.col("policyholder_key"),
        "vehicle_key": F.col("vehicle_key"),
        "driver_key": F.col("driver_key"),
    }


def _accident_columns(k: Column) -> dict[str, Column]:
    site = (
        F.when(k % 4 == 0, "Parking Area")
        .when(k % 4 == 1, "Highway/Intersection")
        .when(k % 4 == 2, "Local")
        .otherwise("Unknown")
    )
    kind = (
        F.when(k % 3 == 0, "single_car")
        .when(k % 3 == 1, "multi_vehicle_clear")
        .otherwise("multi_vehicle_unclear")
    )
    return {"accident_site": site, "accident_type": kind}


def _driver_columns(k: Column) -> dict[str, Column]:
    return {
        "year_of_born": 1940 + k % 60,
        "gender": F.when(k % 2 == 0, "F").otherwise("M"),
        "age_of_DL": 15 + (k * 3) % 35,
        "safety_rating": 1 + (k * 17) % 100,
    }


def _policyholder_columns(k: Column) -> dict[str, Column]:
    return {
        "annual_income": 20000 + (k % 40) * 2500,
        "high_education_ind": k % 2,
        "email_or_tel_available": (k + 1) % 2,
        "address_change_ind": F.when(k % 5 == 0, 1).otherwise(0),
        "living_status": F.when(F.col("c_nationkey") % 3 == 0, "Own").otherwise("Rent"),
        "past_num_of_claims": k % 8,
    }


def _vehicle_columns(k: Column) -> dict[str, Column]:
    size = F.col("p_size")
    return {
        "vehicle_made_year": 2000 + size % 17,
        "vehicle_category": F.when(size % 3 == 0, "Compact").when(size % 3 == 1, "Medium").otherwise("Large"),
        "vehicle_price": F.when(k % 97 != 0, 10000 + (k * 131) % 50000),
        "vehicle_color": F.col("p_brand"),
        "vehicle_weight": 2500 + size * 50,
        "vehicle_mileage": F.when(k % 89 != 0, (k * 997) % 150000),
    }


DERIVED = {
    "accident": _accident_columns,
    "policyholder": _policyholder_columns,
    "vehicle": _vehicle_columns,
    "driver": _driver_columns,
}


class Star:
    """Lazily built frames of one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    @cached_property
    def _stored_dimensions(self) -> dict[str, DataFrame]:
        """The key of each dimension and the stored values that its columns follow from."""
        return {
            "accident": self.raw("orders").select((1 + F.col("o_orderkey") % 12).alias("accident_key")).distinct(),
            "policyholder": self.raw("customer").select(F.col("c_custkey").alias("policyholder_key"), "c_nationkey"),
            "vehicle": self.raw("part").select(F.col("p_partkey").alias("vehicle_key"), "p_size", "p_brand"),
            "driver": self.raw("supplier").select(F.col("s_suppkey").alias("driver_key")),
        }

    def _dimension(self, name: str) -> DataFrame:
        key = S.DIMENSION_KEYS[name]
        columns = DERIVED[name](F.col(key))
        return _conform(self._stored_dimensions[name].select(key, *[c.alias(n) for n, c in columns.items()]), S.TABLES[name])

    @cached_property
    def accident(self) -> DataFrame:
        return self._dimension("accident")

    @cached_property
    def driver(self) -> DataFrame:
        return self._dimension("driver")

    @cached_property
    def policyholder(self) -> DataFrame:
        return self._dimension("policyholder")

    @cached_property
    def vehicle(self) -> DataFrame:
        return self._dimension("vehicle")

    def _with_orders(self, line: DataFrame) -> DataFrame:
        """Lines joined to their orders, with the stored values that a claim follows from: what is derived is added after the shuffles."""
        line = line.select(
            "l_orderkey",
            "l_linenumber",
            F.col("l_partkey").alias("vehicle_key"),
            F.col("l_suppkey").alias("driver_key"),
            "l_shipdate",
            "l_extendedprice",
            "l_quantity",
            (F.col("l_returnflag") == "R").alias("_returned"),
            (F.col("l_linestatus") == "F").alias("_finished"),
            (F.col("l_tax") < 0.04).alias("_taxed"),
        )
        orders = self.raw("orders").select("o_orderkey", F.col("o_custkey").alias("policyholder_key"))
        line = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        return line.withColumn("claim_number", _number()).drop("l_linenumber", "o_orderkey")

    @cached_property
    def _lines(self) -> DataFrame:
        """One row per line item."""
        return self._with_orders(self.raw("lineitem"))

    @cached_property
    def _kept_lines(self) -> DataFrame:
        """The first line of each claim number in the order of ``_seen``, of which these are the parts.

        Lines 0 to 9 of an order share their numbers with other lines of that order alone, so they are picked where the join
        with the orders has put them. Only lines beyond these, and those that may have the number of one, are shuffled by number.
        """
        line = self.raw("lineitem")
        beyond = line.filter(~F.coalesce(F.col("l_linenumber").between(0, 9), F.lit(False)))
        alone, shared = split_by_slots(line, _number(), beyond.select(_number().alias("claim_number")))

        def first(lines: DataFrame, *by: str) -> DataFrame:
            seen = Window.partitionBy(*by).orderBy(*SEEN)
            return self._with_orders(lines).withColumn("_rn", F.row_number().over(seen)).filter("_rn = 1").drop("_rn")

        return first(alone, "l_orderkey", "claim_number").unionByName(first(shared, "claim_number"))

    @cached_property
    def line_claims(self) -> DataFrame:
        """One row per line item, claim numbers still repeated; ``_seen`` orders the copies."""
        stored_names = {"vehicle_key": "l_partkey", "driver_key": "l_suppkey"}
        seen = F.struct(*[F.col(c).alias(stored_names.get(c, c)) for c in SEEN]).alias("_seen")
        return self._lines.select(*[c.alias(n) for n, c in _claim_columns().items()], seen)

    @cached_property
    def claim(self) -> DataFrame:
        return self._kept_lines.select(*[c.alias(n) for n, c in _claim_columns().items()])

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    @cached_property
    def wide(self) -> DataFrame:
        """Fact with its four dimensions attached.

        Only stored values are joined, those of the wider dimensions last; what is derived from a line or from a row of a
        dimension is added to the joined rows, so that no shuffle carries it.
        """
        from salvor.operators.normalize import attach_dimensions

        derived = _claim_columns()

        def met(*names: str) -> dict[str, DataFrame]:
            return {n: self._stored_dimensions[n].withColumn(f"_{n}", F.lit(True)) for n in names}

        fact = attach_dimensions(self._kept_lines, met("driver", "policyholder", "vehicle"))
        fact = attach_dimensions(fact.withColumn("accident_key", derived["accident_key"]), met("accident"))
        keys = list(reversed(S.DIMENSION_KEYS.values()))
        own = [c for c in derived if c not in keys]
        attached = []
        for name, key in S.DIMENSION_KEYS.items():
            columns = DERIVED[name](F.col(key))
            kinds = [f for f in S.TABLES[name] if f.name != key]
            attached += [F.when(F.col(f"_{name}"), columns[f.name].cast(f.dataType)).alias(f.name) for f in kinds]
        return fact.select(*keys, *[derived[c].alias(c) for c in own], *attached)

    @property
    def dimensions(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in S.DIMENSION_KEYS}

    @cached_property
    def wide_text(self) -> DataFrame:
        """A wide all-text file image: padded cells, blanks for missing, no keys.

        ``row_id`` is the position in the file and is a real input column.
        """
        drop = list(S.DIMENSION_KEYS.values())
        text = self.wide.drop(*drop)
        padded = {"channel", "accident_site", "vehicle_color"}
        cells = []
        for field in text.schema:
            value = F.coalesce(F.col(field.name).cast("string"), F.lit(""))
            if field.name in padded:
                value = F.concat(F.lit(" "), value, F.lit("\t "))
            cells.append(value.alias(field.name))
        return text.select(F.col("claim_number").alias("row_id"), *cells)

    @cached_property
    def scored(self) -> DataFrame:
        """Claims with a learnable label and three fixed scores.

        The scores stand for model outputs so that every metric can be checked
        exactly; they are rational functions of liability and evidence.
        """
        witness = flag(F.col("witness_present_ind") == "Y")
        police = F.col("policy_report_filed_ind")
        number = F.col("claim_number")
        base = (100 - F.col("liab_prct")) / 250.0
        return self.claim.select(
            "claim_number",
            "claim_date",
            "claim_est_payout",
            "liab_prct",
            "claim_day_of_week",
            learnable_label().alias("y"),
            (base + (witness * 3 + police) / 20.0 + (number % 97) / 1000.0).alias("p_a"),
            (base + (witness + police) / 10.0 + (number % 89) / 500.0).alias("p_b"),
            ((base * 2 + (number % 83) / 100.0) / 2.0).alias("p_c"),
        )

    @cached_property
    def learnable(self) -> DataFrame:
        """The wide claims with the learnable label in place of the random one."""
        return self.wide.withColumn("subrogation", learnable_label())


def star(spark: SparkSession, folder: str) -> Star:
    return Star(spark, folder)
