"""Sources, sinks, normalisation, quality, and the single operations."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import functions as F

from salvor import schema as S
from salvor.functions import scalars as X
from salvor.functions.stats import avg_where, count_where, distinct_with_null, pearson, rate
from salvor.operators import analysis as A
from salvor.operators import normalize as N
from salvor.operators import ordering as O
from salvor.operators import quality as Q
from salvor.entries.features import engineered
from salvor.operators.features import SELECTED
from salvor.operators.sizes import stored
from salvor.plans import accidents, claims, drivers, policyholders, vehicles
from salvor.session import scratch
from salvor.sources import files, warehouse
from salvor.sources.star import HOLD_OUT

C = F.col


# --- sources and sinks -------------------------------------------------------


def _as_csv(s, name, df=None):
    path = scratch(s.spark, f"csv-{name}")
    files.write_csv(s.table(name) if df is None else df, path)
    return path


def csv_scan(s, name):
    return files.read_csv(s.spark, _as_csv(s, name), S.TABLES[name])


def csv_text_scan(s):
    return files.read_csv_text(s.spark, _as_csv(s, "claim"), S.CLAIM)


def dirty_vehicle(s):
    """Vehicles as text with prices and years that do not parse."""
    k = C("vehicle_key")
    text = s.vehicle.select(*[C(c).cast("string").alias(c) for c in s.vehicle.columns])
    return text.withColumns(
        {
            "vehicle_price": F.when(k.cast("bigint") % 10 == 0, "unknown")
            .when(k.cast("bigint") % 10 == 1, " ")
            .otherwise(C("vehicle_price")),
            "vehicle_made_year": F.when(k.cast("bigint") % 15 == 0, "n/a").otherwise(C("vehicle_made_year")),
        }
    )


def csv_bad_cells(s):
    return files.read_csv(s.spark, _as_csv(s, "vehicle", dirty_vehicle(s)), S.VEHICLE, lenient=True)


def csv_key_cast(s):
    key = C("driver_key")
    text = F.when(key % 9 == 0, F.concat(F.lit("x"), key.cast("string"))).otherwise(key.cast("string"))
    path = _as_csv(s, "driver", s.driver.withColumn("driver_key", text))
    return files.read_csv_key(s.spark, path, S.DRIVER, "driver_key")


def staged(s):
    paths = {name: _as_csv(s, name) for name in S.TABLES}
    paths["archive"] = scratch(s.spark, "absent")
    return warehouse.stage_tables(
        s.spark, paths, {**S.TABLES, "archive": S.CLAIM}, location=scratch(s.spark, "warehouse")
    )


def discovered(s):
    staged(s)
    tables = warehouse.discover(s.spark)
    return warehouse.table_sizes({n: tables[n] for n in S.TABLES})


def registered(s):
    policyholders.register({"claim": s.claim, "policyholder": s.policyholder})
    return s.spark.sql(
        """SELECT p.living_status, COUNT(*) AS num_claims
           FROM claim c JOIN policyholder p ON c.policyholder_key = p.policyholder_key
           GROUP BY p.living_status"""
    )


def csv_round_trip(s):
    result = accidents.priority_view(s.accident, s.claim)
    path = _as_csv(s, "result", result)
    return files.read_csv(s.spark, path, result.schema)


def staged_by_month(s):
    """Claims staged by month and read back whole, with the month of their partition."""
    path = scratch(s.spark, "stage")
    month = F.date_format(C("claim_date").cast("timestamp"), "yyyy-MM")
    files.write_stage(s.claim.withColumn("claim_month", month), path, "claim_month")
    return files.read_stage(s.spark, path)


def parquet_stage(s):
    """Stage claims by month, then read the hold-out month through its partition."""
    year, number = HOLD_OUT
    return staged_by_month(s).filter(C("claim_month") == f"{year}-{number:02d}").drop("claim_month")


QUERIES = {f"src01_{name}": partial(csv_scan, name=name) for name in S.TABLES}
QUERIES |= {
    "src02": csv_text_scan,
    "src03": csv_bad_cells,
    "src04": csv_key_cast,
    "src05": discovered,
    "src06": lambda s: claims.preview(s.vehicle, "vehicle_key", 10),
    "src07": registered,
    "snk01": staged,
    "snk02": csv_round_trip,
    "snk03": parquet_stage,
    "snk03_all": staged_by_month,
}


# --- normalisation and quality -----------------------------------------------


def staged_text(s):
    """The wide text as staged Parquet: the split reads it once per table, and a columnar
    stage gives each of those reads only its own columns."""
    path = scratch(s.spark, "wide")
    files.write_stage(s.wide_text, path)
    return files.read_stage(s.spark, path)


def _dimension(s, name):
    clean = N.strip_all(s.wide_text)
    return N.build_dimension(clean, N.DIMENSION_COLUMNS[name], S.DIMENSION_KEYS[name])


def keyed_claims(s):
    return N.split_wide(staged_text(s))["claim"].select("claim_number", *S.DIMENSION_KEYS.values())


def first_of_repeated(s):
    first = N.keep_first(s.line_claims, "claim_number", C("_seen"))
    return first.select("claim_number", "claim_est_payout", "subrogation", "vehicle_key", "driver_key")


def broken_keys(s):
    """Claims whose keys went missing or became text."""
    return s.claim.select(
        "claim_number",
        F.nullif(C("accident_key"), F.lit(12)).alias("accident_key"),
        "policyholder_key",
        F.when(C("vehicle_key") % 50 == 0, "?").otherwise(C("vehicle_key").cast("string")).alias("vehicle_key"),
        C("driver_key").cast("double").cast("string").alias("driver_key"),
    )


def orphan_claims(s):
    """Claims whose repaired key has no row in a dimension, for each dimension."""
    claims = stored(N.repair_keys(broken_keys(s)))
    found = [N.orphans(claims, d, S.DIMENSION_KEYS[n]).withColumn("dimension", F.lit(n)) for n, d in s.dimensions.items()]
    return reduce(lambda a, b: a.unionByName(b), found)


def rebuilt(text):
    """The wide frame again. Dimensions of more rows meet the claims first, before the columns of the others are there."""
    tables = N.split_wide(text)
    dims = {n: tables[n] for n in sorted(S.DIMENSION_KEYS, key=lambda n: tables[n].count(), reverse=True)}
    return N.attach_dimensions(tables["claim"], dims)


def lossless(s):
    text = staged_text(s)
    original = N.strip_all(text).drop("row_id")
    return N.compare_frames(rebuilt(text).drop(*S.DIMENSION_KEYS.values()), original)


def cleaned_claims(s):
    number = C("claim_number")
    text = s.claim.withColumns(
        {
            "claim_est_payout": F.when(number % 10 == 3, "n/a").otherwise(C("claim_est_payout").cast("string")),
            "vehicle_key": F.concat(C("vehicle_key").cast("string"), F.lit(".0")),
            "subrogation": C("subrogation").cast("string"),
        }
    )
    return N.clean_claim(text).select(
        "claim_number",
        "subrogation",
        "claim_est_payout",
        "liab_prct",
        "vehicle_key",
        "witness_present",
        "policy_report_filed",
    )


def spelled_flags(s):
    """Witness flags in every spelling the files use."""
    w, n = C("witness_present_ind"), C("claim_number") % 4
    spelled = (
        F.when(w == "Y", F.element_at(F.array(F.lit(" Yes "), F.lit("TRUE"), F.lit("1"), F.lit("y")), n.cast("int") + 1))
        .when(w == "N", F.element_at(F.array(F.lit("No"), F.lit("false"), F.lit("0"), F.lit("maybe")), n.cast("int") + 1))
    )
    return s.claim.select("claim_number", spelled.alias("spelled")).withColumn("witness", X.to_bool("spelled"))


QUERIES |= {f"nrm03_{name}": partial(_dimension, name=name) for name in S.DIMENSION_KEYS}
QUERIES |= {
    "nrm01": lambda s: N.strip_all(s.wide_text).select(
        "claim_number", "channel", "accident_site", "vehicle_color", "witness_present_ind"
    ),
    "nrm02": lambda s: s.wide_text.withColumn("zip", C("zip_code")).transform(
        lambda df: df.select(*N.claim_columns(df))
    ),
    "nrm04": first_of_repeated,
    "nrm05": keyed_claims,
    "nrm06": lambda s: N.split_wide(staged_text(s))["claim"],
    "nrm07": lambda s: N.repair_keys(broken_keys(s)),
    "nrm08": lambda s: N.repair_keys(broken_keys(s)).filter("accident_key = 0"),
    "nrm08_anti": orphan_claims,
    "nrm09": lambda s: Q.duplicate_keys(s.vehicle, "vehicle_key"),
    "nrm09_repeated": lambda s: Q.duplicate_keys(s.line_claims, "claim_number"),
    "nrm10": lambda s: s.wide,
    "nrm11": lossless,
    "nrm12": lambda s: Q.profile(s.wide),
    "nrm13_claim": cleaned_claims,
    "nrm13_vehicle": lambda s: N.clean_vehicle(dirty_vehicle(s)),
    "nrm14": lambda s: Q.uncastable(
        dirty_vehicle(s), ["vehicle_price", "vehicle_made_year", "vehicle_weight", "absent"]
    ),
    "nrm15": spelled_flags,
    "nrm16": lambda s: Q.completeness(s.line_claims, claims.COMPLETENESS),
    "nrm17": lambda s: claims.distinct_keys(s.line_claims),
    "nrm18": lambda s: Q.violations(s.claim, Q.claim_rules(s.claim)),
    "nrm19": lambda s: Q.join_integrity(s.claim, s.dimensions),
    "nrm20": lambda s: (lambda f: Q.violations(f, Q.feature_rules(f, SELECTED)))(engineered(s)),
}


# --- filters, projections, joins, aggregates, windows, sorts ------------------


def hold_out(s):
    from salvor.operators.prep import in_month

    return s.claim.filter(in_month("claim_date", *HOLD_OUT)).select("claim_number", "claim_date")


def not_hold_out(s):
    from salvor.operators.prep import in_month

    late = s.claim.withColumn("claim_date", F.when(C("claim_number") % 100 != 0, C("claim_date")))
    kept = late.filter(~F.coalesce(in_month("claim_date", *HOLD_OUT), F.lit(False)))
    return kept.agg(F.count("*").alias("kept"), count_where(C("claim_date").isNull()).alias("undated"))


def to_group_average(s):
    """Each driver beside the average of its gender."""
    mean = s.driver.groupBy("gender").agg(F.avg("safety_rating").alias("gender_avg"))
    return s.driver.join(mean, "gender").select("driver_key", "gender", "safety_rating", "gender_avg")


def map_lookup(s):
    """Channel means as a lookup; what the map lacks takes the overall mean."""
    means = s.claim.filter("channel <> 'Broker'").groupBy("channel").agg(F.avg("subrogation").alias("m"))
    overall = s.claim.agg(F.avg("subrogation")).scalar()
    return s.claim.join(means, "channel", "left").select(
        "claim_number", F.round(F.coalesce("m", overall), 9).alias("encoded")
    )


def missed(column, other):
    """``column`` with every eleventh claim's value missing and every thirteenth's as ``other``, which no lookup has."""
    number = C("claim_number")
    return F.when(number % 11 == 0, None).when(number % 13 == 0, other).otherwise(C(column))


def left_with_misses(s):
    """Every claim beside all policyholders; some keys are missing or below zero."""
    claim = s.claim.withColumn("policyholder_key", missed("policyholder_key", -1 - C("policyholder_key")))
    return claim.join(s.policyholder, "policyholder_key", "left").select("claim_number", "annual_income")


def map_lookup_all(s):
    """Means of all channels as a lookup; missing and respelled channels take the overall mean."""
    means = s.claim.groupBy("channel").agg(F.avg("subrogation").alias("m"))
    overall = s.claim.agg(F.avg("subrogation")).scalar()
    claim = s.claim.withColumn("channel", missed("channel", F.lower("channel")))
    return claim.join(means, "channel", "left").select("claim_number", F.round(F.coalesce("m", overall), 9).alias("encoded"))


def one_quantile_row(s):
    q = O.exact_quantiles(O.frequencies(s.claim, "claim_est_payout"), "claim_est_payout", [0.01, 0.5, 0.75, 0.99])
    names = ("p01", "p50", "p75", "p99")
    return q.select(*[F.round(C("q")[i], 6).alias(n) for i, n in enumerate(names)])


def quantiles_by_channel(s):
    freq = O.frequencies(s.claim, "claim_est_payout", ["channel"])
    q = O.exact_quantiles(freq, "claim_est_payout", [0.5], by=["channel"])
    return q.select("channel", F.round(C("q")[0], 6).alias("median"))


def ranked_drivers(s):
    r = drivers.safety_ranks(s.driver)
    return r.withColumn("p_rank", F.round("p_rank", 12))


_TYPES = ["accident_site", "accident_type"]

QUERIES |= {
    "flt01": lambda s: s.claim.filter(claims.both_indicators()).select("claim_number"),
    "flt01_literal": lambda s: s.claim.filter(claims.both_indicators("Y")).select("claim_number"),
    "flt02": lambda s: s.accident.filter(C("accident_type").contains("multi_vehicle")),
    "flt02_regex": lambda s: s.accident.filter(C("accident_type").rlike("multi.*unclear")),
    "flt03": lambda s: s.claim.filter(C("liab_prct").between(20, 80)).select("claim_number", "liab_prct"),
    "flt04": hold_out,
    "flt04_rest": not_hold_out,
    "flt05": lambda s: s.wide.select(
        "claim_number", "witness_present_ind", "vehicle_price", "vehicle_mileage"
    ).dropna(subset=["witness_present_ind", "vehicle_price"]),
    "flt06": lambda s: s.claim.filter(F.month("claim_date").isin(12, 1, 2)).select("claim_number"),
    "flt07": lambda s: s.claim.groupBy("vehicle_key")
    .agg(F.count("*").alias("claim_count"))
    .filter("claim_count > 25"),
    "flt08": lambda s: s.vehicle.select(
        "vehicle_key", vehicles._band("vehicle_price", vehicles.PRICE_BANDS, vehicles.PRICE_REST)[0].alias("price_band")
    ),
    "flt08_safety": lambda s: s.driver.select(
        "driver_key",
        F.when(C("safety_rating") >= 80, "High").when(C("safety_rating") >= 60, "Medium").otherwise("Low").alias("safety"),
    ),
    "prj01": lambda s: s.claim.drop("zip_code").select(
        C("claim_number").alias("id"), "channel", F.lit("claim").alias("source")
    ),
    "prj02": lambda s: s.wide.select(
        "claim_number",
        F.round(
            X.ratio(C("claim_est_payout"), F.nullif(C("vehicle_price") - 10000, F.lit(0.0))), 6
        ).alias("value_ratio"),
    ),
    "jn01": lambda s: accidents.join_accident_claim(s.accident, s.claim).select("claim_number", "accident_key", *_TYPES),
    "jn02": lambda s: drivers.merge_driver_claim(s.driver, s.claim).select("claim_number", "driver_key", "safety_rating"),
    "jn03": lambda s: s.claim.join(s.vehicle, "vehicle_key").select("claim_number", "vehicle_key", "vehicle_price"),
    "jn04": lambda s: s.claim.join(s.policyholder, "policyholder_key").select("claim_number", "annual_income"),
    "jn04_left": lambda s: s.claim.join(
        s.policyholder.filter("past_num_of_claims > 3"), "policyholder_key", "left"
    ).select("claim_number", "annual_income"),
    "jn05": to_group_average,
    "jn06": lambda s: s.wide.select("claim_number", "accident_site", "annual_income", "vehicle_color", "gender"),
    "jn04_left_all": left_with_misses,
    "jn07": map_lookup,
    "jn07_all": map_lookup_all,
    "agg01": lambda s: s.claim.groupBy("channel").agg(
        F.count("*").alias("n"), F.count("witness_present_ind").alias("with_witness_field")
    ),
    "agg02": lambda s: s.claim.agg(
        F.count_distinct("witness_present_ind").alias("present_values"),
        distinct_with_null("witness_present_ind").alias("values_with_null"),
    ),
    "agg03": lambda s: s.claim.groupBy("accident_key").agg(
        F.round(F.avg("claim_est_payout"), 4).alias("mean_payout"),
        F.round(F.sum("claim_est_payout"), 2).alias("sum_payout"),
        F.max("liab_prct").alias("max_liability"),
    ),
    "agg04": lambda s: s.claim.groupBy("channel").agg(
        count_where(X.is_yes("witness_present_ind")).alias("witnessed"),
        count_where(C("policy_report_filed_ind") == 1).alias("reported"),
    ),
    "agg05": lambda s: s.claim.groupBy("channel").agg(
        F.round(avg_where(C("subrogation") > 0, C("claim_est_payout")), 4).alias("avg_payout_subro")
    ),
    "agg06": lambda s: s.claim.groupBy("channel").agg(F.round(rate(C("subrogation") > 0), 6).alias("subro_rate")),
    "agg07": quantiles_by_channel,
    "agg08": one_quantile_row,
    "agg09": lambda s: s.claim.withColumn("flat", F.lit(1.0)).agg(
        F.round(pearson("claim_est_payout", "liab_prct"), 9).alias("corr_payout_liability"),
        pearson("claim_est_payout", "flat").alias("corr_flat"),
    ),
    "agg10": lambda s: s.spark.sql(
        "SELECT channel, policy_report_filed_ind, COUNT(*) AS n FROM {claim} GROUP BY 1, 2", claim=s.claim
    ),
    "agg11": lambda s: s.claim.groupBy("accident_key")
    .agg(F.max("liab_prct").alias("top"), F.min("liab_prct").alias("low"))
    .select("top", "low")
    .distinct(),
    "agg12": lambda s: s.claim.groupBy("channel")
    .agg(F.count("*").alias("n"))
    .withColumn("share", F.round(C("n") / A.row_count(s.claim), 6)),
    "agg13": lambda s: A.value_counts(s.claim, vehicles.CATEGORICAL_CLAIM),
    "win01": lambda s: A.distribution(s.claim, "claim_day_of_week", "n"),
    "win02": lambda s: ranked_drivers(s).select("driver_key", "gender", "safety_rating", "p_rank"),
    "win03": lambda s: ranked_drivers(s).select("driver_key", "group_label"),
    "srt01": lambda s: s.claim.groupBy("witness_present_ind")
    .agg(F.count("*").alias("n"))
    .orderBy(F.desc_nulls_first("witness_present_ind")),
    "srt02": lambda s: s.claim.groupBy("channel", "claim_day_of_week")
    .agg(F.count("*").alias("n"))
    .orderBy(F.asc("channel"), F.desc("n"), F.asc("claim_day_of_week")),
    "srt03": lambda s: vehicles.by_price_band(s.claim, s.vehicle).select("price_band", "num_claims"),
    "srt04": lambda s: A.top(
        s.claim.select("claim_number", "claim_est_payout"), 20, F.desc("claim_est_payout"), C("claim_number")
    ),
}


# --- scalar functions --------------------------------------------------------


def _text_dates(s):
    shown = F.date_format(C("claim_date").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    return s.claim.select(
        "claim_number", F.when(C("claim_number") % 7 == 0, "not a date").otherwise(shown).alias("text")
    )


def _per_claim(**columns):
    def build(s):
        return s.claim.select("claim_number", *[make().alias(name) for name, make in columns.items()])

    return build


def _per_wide(**columns):
    def build(s):
        return s.wide.select("claim_number", *[make().alias(name) for name, make in columns.items()])

    return build


def categories_all(s):
    """The categories of every row of both frames, missing and respelled ones too."""
    frames = [
        s.claim.select(missed("channel", F.lower("channel")).alias("category")),
        s.claim.select(C("claim_day_of_week").alias("category")),
        s.vehicle.select(C("vehicle_category").alias("category")),
    ]
    return reduce(lambda a, b: a.unionByName(b), [f.distinct() for f in frames]).distinct()


def categories(s):
    frames = [
        s.claim.filter("subrogation = 1").select(C("channel").alias("category")),
        s.claim.filter("subrogation = 0").select(C("claim_day_of_week").alias("category")),
        s.vehicle.select(C("vehicle_category").alias("category")),
    ]
    return reduce(lambda a, b: a.unionByName(b), [f.distinct() for f in frames]).distinct()


QUERIES |= {
    "scl01": lambda s: _text_dates(s).select("claim_number", C("text").try_cast("timestamp_ntz").alias("parsed")),
    "scl02": _per_claim(
        y=lambda: F.year("claim_date"),
        m=lambda: F.month("claim_date"),
        h=lambda: F.hour("claim_date"),
        d=lambda: F.dayofmonth("claim_date"),
        dow=lambda: F.weekday("claim_date"),
    ),
    "scl03": _per_claim(quarter=lambda: F.floor((F.month("claim_date") - 1) / 3) + 1),
    "scl04": lambda s: dirty_vehicle(s).select(
        "vehicle_key", X.num("vehicle_price").alias("price"), X.num("vehicle_made_year", 1980).alias("made")
    ),
    "scl05": _per_wide(
        both=lambda: X.clip("vehicle_price", 15000.0, 40000.0), floor=lambda: X.clip("vehicle_mileage", 50000.0)
    ),
    "scl06": _per_claim(
        log=lambda: F.round(F.log1p("claim_est_payout"), 9),
        root=lambda: F.round(F.sqrt("liab_prct"), 9),
        square=lambda: C("liab_prct") * C("liab_prct"),
        cube=lambda: C("liab_prct") * C("liab_prct") * C("liab_prct"),
        size=lambda: F.abs(C("liab_prct") - 50),
    ),
    "scl07": _per_claim(rounded=lambda: F.round(C("claim_est_payout") / 7, 2)),
    "scl08": lambda s: s.wide_text.select(
        "claim_number", F.lower(X.stripped("channel")).alias("low"), F.upper(X.stripped("accident_site")).alias("up")
    ),
    "scl09": _per_wide(
        single=lambda: X.matches("accident_type", "SINGLE"),
        multi_clear=lambda: X.matches("accident_type", "multi.*clear"),
        highway=lambda: X.matches("accident_site", "highway"),
        witness=lambda: X.matches("witness_present_ind", "y"),
    ),
    "scl10": _per_claim(
        padded=lambda: X.zero_pad((C("policyholder_key") * 37) % 99999, 5),
        long=lambda: X.zero_pad("claim_number", 5),
        zip3=lambda: F.nullif(F.substring("zip_code", 1, 3), F.lit("000")),
    ),
    "scl11": _per_wide(combo=lambda: F.concat_ws("_", "accident_site", "accident_type")),
    "scl12": _per_claim(
        seen=lambda: X.flag(C("witness_present_ind") == "Y"),
        unseen=lambda: X.flag(C("witness_present_ind") != "Y"),
        weekend=lambda: X.flag(F.weekday("claim_date") >= 5),
    ),
    "scl13": _per_wide(
        payout=lambda: X.display_number("claim_est_payout"), price=lambda: X.display_number("vehicle_price"),
        witness=lambda: X.display_text("witness_present_ind"),
    ),
    "scl14": categories,
    "scl14_all": categories_all,
}
