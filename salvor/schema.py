"""Declared schemas of the five tables; nothing is inferred at read time."""

from pyspark.sql import types as T

_L, _I, _D, _S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


CLAIM = _table(
    claim_number=_L,
    subrogation=_I,
    claim_est_payout=_D,
    liab_prct=_D,
    claim_date=T.TimestampNTZType(),
    claim_day_of_week=_S,
    channel=_S,
    zip_code=_S,
    witness_present_ind=_S,
    policy_report_filed_ind=_I,
    in_network_bodyshop=_S,
    accident_key=_L,
    policyholder_key=_L,
    vehicle_key=_L,
    driver_key=_L,
)
ACCIDENT = _table(accident_key=_L, accident_site=_S, accident_type=_S)
DRIVER = _table(driver_key=_L, year_of_born=_I, gender=_S, age_of_DL=_I, safety_rating=_D)
POLICYHOLDER = _table(
    policyholder_key=_L,
    annual_income=_D,
    high_education_ind=_I,
    email_or_tel_available=_I,
    address_change_ind=_I,
    living_status=_S,
    past_num_of_claims=_I,
)
VEHICLE = _table(
    vehicle_key=_L,
    vehicle_made_year=_I,
    vehicle_category=_S,
    vehicle_price=_D,
    vehicle_color=_S,
    vehicle_weight=_D,
    vehicle_mileage=_D,
)

TABLES = {
    "accident": ACCIDENT,
    "claim": CLAIM,
    "driver": DRIVER,
    "policyholder": POLICYHOLDER,
    "vehicle": VEHICLE,
}
# Dimension -> the key that the claim table carries for it.
DIMENSION_KEYS = {
    "accident": "accident_key",
    "policyholder": "policyholder_key",
    "vehicle": "vehicle_key",
    "driver": "driver_key",
}


def all_strings(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema])
