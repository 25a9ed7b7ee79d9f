"""Statistics against the published readout."""

import pytest
from pyspark.sql import functions as F

from marketloom.functions.stats import normal_sf
from marketloom.plans import reports

# Published session and order counts: group, device, bot, sessions, orders.
PUBLISHED = [
    ("control", "Android", False, 30115, 16551), ("control", "Desktop", False, 11766, 7653),
    ("control", "Desktop", True, 367, 0), ("control", "iOS", False, 6714, 4175),
    ("treatment", "Android", False, 30063, 18332), ("treatment", "Desktop", False, 11678, 7615),
    ("treatment", "Desktop", True, 882, 0), ("treatment", "iOS", False, 6722, 4554)]
# Published results: control and treatment sessions, lift, interval, z, p.
RESULTS = {
    "All devices": (48595, 48463, 4.537661094365086, 3.9236884645727463, 5.151633724157426, 14.469655072815735, 1.884146381245217e-47),
    "Android": (30115, 30063, 6.019288985631144, 5.2319936399777465, 6.806584331284542, 14.957100286578232, 1.399943097405697e-50),
    "iOS": (6714, 6722, 5.564196968556878, 3.9535318047515102, 7.174862132362246, 6.759632253385195, 1.3834242831518278e-11),
    "Desktop": (11766, 11678, 0.16473834393031517, -1.055376293790294, 1.3848529816509243, 0.26463524996382376, 0.7912904623971808),
    "All devices, bots included": (48962, 49345, 3.8504576199593243, 3.2381283740068656, 4.462786865911783, 12.31614954582374, 7.415100202868905e-35)}


@pytest.fixture
def ab(spark):
    return spark.createDataFrame(PUBLISHED, "experiment_group string, device_type string, is_bot boolean, sessions bigint, orders bigint")


def test_two_proportion_rows(ab):
    got = {r.segment: r for r in reports.ab_results(ab).collect()}
    assert set(got) == set(RESULTS)
    for segment, want in RESULTS.items():
        r = got[segment]
        values = (r.control_sessions, r.treatment_sessions, r.lift_pts, r.ci_low_pts, r.ci_high_pts, r.z, r.p_value)
        assert values == pytest.approx(want, rel=1e-9)


def test_sample_ratio(ab):
    got = {r.population: r for r in reports.sample_ratio(ab).collect()}
    clean, everyone = got["bots removed"], got["all sessions, bots included"]
    assert (clean.chi2, clean.p_value) == pytest.approx((0.180, 0.672), abs=1e-3)
    assert (everyone.chi2, everyone.p_value) == pytest.approx((1.492, 0.222), abs=1e-3)
    assert {r.verdict for r in got.values()} == {"split holds"}


def test_broken_split(spark):
    ab = spark.createDataFrame([("control", "iOS", False, 5000, 1), ("treatment", "iOS", False, 4000, 1)],
                               "experiment_group string, device_type string, is_bot boolean, sessions bigint, orders bigint")
    assert reports.sample_ratio(ab).first().verdict == "split is broken, investigate"


def test_normal_tail(spark):
    got = spark.range(1).select(normal_sf(F.lit(1.959963984540054)), normal_sf(F.lit(0.0))).first()
    assert tuple(got) == pytest.approx((0.025, 0.5))
