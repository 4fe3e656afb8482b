"""Counts recorded in FIXTURES.md section 3, reproduced on the driver tables."""

import pytest
from pyspark.sql import functions as F

from blockwise.plans import catalog, jobs
from blockwise.sources import tables as TB
from conftest import SF_CHECK, SF_SMALL

# FIXTURES.md section 3 (text-concatenated house numbers).
SEGMENT_COUNTS = {SF_SMALL: {"matched": 161, "segments": 200, "records": 162},
                  SF_CHECK: {"matched": 1752, "segments": 2000, "records": 1753}}
RATE_ZONES = {SF_SMALL: 22, SF_CHECK: 25}


@pytest.mark.parametrize("sf", [SF_SMALL, SF_CHECK])
def test_segment_counts(spark, sf):
    for keep, n in SEGMENT_COUNTS[sf].items():
        df = jobs.segment_trend(TB.records(spark, sf), TB.segments(spark, sf), catalog.YEARS,
                                mode="concat_text", keep=keep)
        assert df.count() == n, keep


@pytest.mark.parametrize("sf", [SF_SMALL, SF_CHECK])
def test_rate_zones(spark, sf):
    assert catalog.queries()["zone_rate"](spark, sf).count() == RATE_ZONES[sf]


def test_pickup_matches(spark):
    pip = catalog.queries()["pip_assign"](spark, SF_CHECK).where(F.col("zone_id").isNotNull())
    assert pip.count() == 5814
    assert pip.select("zone_id").distinct().count() == 25


def test_top3_rows(spark):
    assert catalog.queries()["topk_per_group"](spark, SF_SMALL).count() == 15
