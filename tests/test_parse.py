from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from engage.operators.interactions import format_impressions, parse_impressions
from engage.schemas import BEH_SCHEMA
from engage.sources import fixtures as FX


def _beh(spark, imps):
    data = [(str(i), "U1", "2024-01-01 10:00:00", "", imp) for i, imp in enumerate(imps)]
    return spark.createDataFrame(data, BEH_SCHEMA)


def test_token_cases(spark):
    beh = _beh(spark, ["N1-1 N2 N3-x N-4-0", "", None, "N5-0  N6-1"])
    got = rows(parse_impressions(beh).select("NewsID", "Click"))
    # N2 (no dash), N3-x (not an int), "" (empty) and the empty token of a
    # double space are dropped; N-4-0 gives (N, 4); the null row is skipped.
    assert got == sorted([("N1", 1), ("N", 4), ("N5", 0), ("N6", 1)])


def test_strict_drops_three_parts(spark):
    beh = _beh(spark, ["N1-1 N-4-0 N7-0"])
    got = rows(parse_impressions(beh, strict=True).select("NewsID", "Click"))
    assert got == [("N1", 1), ("N7", 0)]


def test_positions(spark):
    beh = _beh(spark, ["N1-1 bad N2-0"])
    got = rows(parse_impressions(beh, with_position=True).select("NewsID", "ImpPos"))
    assert got == [("N1", 0), ("N2", 2)]


def test_format_parse_identity(spark):
    beh = _beh(spark, ["N1-1 N2-0 N3-1", "N9-0"])
    inter = parse_impressions(beh, with_position=True)
    again = parse_impressions(format_impressions(inter), with_position=True)
    assert rows(inter.drop("ImpPos")) == rows(again.drop("ImpPos"))


def test_fixture_behaviors_cover_branches(spark):
    beh = FX.behaviors(spark, SF_SMALL)
    n_null = beh.filter(F.col("Impressions").isNull()).count()
    malformed = (beh.select(F.explode(F.split("Impressions", " ")).alias("t"))
                    .filter(~F.col("t").contains("-")).count())
    assert n_null > 0 and malformed > 0
    # one behaviour row per order
    orders = FX.table(spark, SF_SMALL, "orders").count()
    assert beh.count() == orders
