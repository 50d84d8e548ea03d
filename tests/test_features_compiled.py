"""The generated code of the wide feature projections stays compiled."""

from salvor.entries.features import compared
from salvor.operators import features as E
from salvor.session import METHOD_LIMIT


def test_stages_with_methods_too_large_to_compile_are_not_fused(spark, star):
    spark.conf.set(METHOD_LIMIT, "65535")
    frame = compared(E.row_local(star.wide).select("claim_number", *E.LIABILITY), "claim_number")
    assert spark.conf.get(METHOD_LIMIT) == "8000"
    assert frame.count() == star.claim.count()


def test_a_limit_of_the_session_stays(spark, star):
    spark.conf.set(METHOD_LIMIT, "7000")
    E.row_local(star.wide)
    assert spark.conf.get(METHOD_LIMIT) == "7000"
    spark.conf.set(METHOD_LIMIT, "8000")
