"""The measured fixture properties published in FIXTURES.md §3, at two scales."""

import pytest
from pyspark.sql import functions as F

from adtally import catalog
from adtally.plans import anomalies
from tests.conftest import SF_MID, SF_SMALL

# ---- fixed values: FIXTURES.md §3 (sf0.001, sf0.01) -------------------------------------
EXPECTED = {
    SF_SMALL: dict(raw=1016, unique=1000, fct=970, perf=596, domain=11, future=4, orphan=5, flight=483,
                   unit=12, advertiser=4, device=386, inactive=12, below_floor=361, unserved=8, hot=237, burst_max=22),
    SF_MID: dict(raw=10154, unique=10000, fct=8945, perf=629, domain=104, future=29, orphan=37, flight=5055,
                 unit=113, advertiser=58, device=3919, inactive=153, below_floor=3928, unserved=77, hot=1830, burst_max=94),
}


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_fixture_properties(spark, sf):
    e = EXPECTED[sf]
    m = catalog.models_for(spark, sf)
    assert m.raw.ad_events.count() == e["raw"]
    assert m.stg_ad_events.count() == e["unique"]
    assert m.fct_ad_events_daily.count() == e["fct"]
    assert m.fct_publisher_performance.count() == e["perf"]
    assert anomalies.domain_mismatch(m).count() == e["domain"]
    assert anomalies.future_events(m).count() == e["future"]
    assert anomalies.orphan_campaign_events(m).count() == e["orphan"]
    assert anomalies.out_of_flight_delivery(m).count() == e["flight"]
    assert anomalies.ad_unit_mismatch(m).count() == e["unit"]
    assert anomalies.advertiser_mismatch(m).count() == e["advertiser"]
    assert anomalies.targeting_violations(m).agg(F.sum("device_violation")).first()[0] == e["device"]
    assert anomalies.inactive_unit_events(m).count() == e["inactive"]
    assert anomalies.below_floor_events(m).count() == e["below_floor"]
    served = m.dim_campaigns.agg(F.count_if(F.col("total_events") == 0), F.max("total_events")).first()
    assert tuple(served) == (e["unserved"], e["hot"])
    hourly = m.stg_ad_events.groupBy("publisher_id", F.date_trunc("hour", "event_timestamp"),
                                     "device_type", "country_code", "browser").count()
    assert hourly.agg(F.max("count")).first()[0] == e["burst_max"]
