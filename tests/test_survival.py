"""Golden survival values: 6-MP leukaemia remission trial (Freireich et al. 1963)."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import survival as sv

SIX_MP = "6 6 6 6+ 7 9+ 10 10+ 11+ 13 16 17+ 19+ 20+ 22 23 25+ 32+ 32+ 34+ 35+"
CONTROL = "1 1 2 2 3 4 4 5 5 8 8 8 8 11 11 12 12 15 17 22 23"


@pytest.fixture(scope="module")
def leuk(spark):
    rows, i = [], 0
    for arm, s in (("6-MP", SIX_MP), ("control", CONTROL)):
        for tok in s.split():
            i += 1
            rows.append((i, int(tok.rstrip("+")), 0 if tok.endswith("+") else 1, arm))
    return spark.createDataFrame(rows, "subject INT, time INT, event INT, arm STRING")


def test_km_values(leuk):
    km = {(r.arm, r.time): r for r in sv.kaplan_meier(leuk, "time", "event", "arm").collect()}
    for t, n, s in [(6, 21, .8571), (7, 17, .8067), (10, 15, .7529), (13, 12, .6902),
                    (16, 11, .6275), (22, 7, .5378), (23, 6, .4482)]:
        assert km[("6-MP", t)].n_risk == n
        assert km[("6-MP", t)].surv == pytest.approx(s, abs=5e-5)
    for t, se in [(6, .0764), (10, .0963), (23, .1346)]:
        assert km[("6-MP", t)].std_err == pytest.approx(se, abs=5e-5)
    assert km[("6-MP", 7)].lower == pytest.approx(.6531, abs=5e-5)
    assert km[("6-MP", 7)].upper == pytest.approx(.9964, abs=5e-5)
    for t, s in [(1, .9048), (8, .3810), (22, .0476), (23, 0.0)]:
        assert km[("control", t)].surv == pytest.approx(s, abs=5e-5)
    # invariant: non-increasing within [0, 1]
    for arm in ("6-MP", "control"):
        vals = [km[k].surv for k in sorted(k for k in km if k[0] == arm)]
        assert all(0 <= b <= a <= 1 for a, b in zip(vals, vals[1:]))


def test_km_median(leuk):
    km = sv.kaplan_meier(leuk, "time", "event", "arm")
    med = {r.arm: r.median for r in sv.km_median(km, "time", ["arm"]).collect()}
    assert med == {"6-MP": 23, "control": 8}


def test_logrank(leuk):
    per, pair = sv.logrank_terms(leuk, "time", "event", "arm")
    o = {r.arm: r for r in per.collect()}
    assert o["6-MP"].observed == 9 and o["control"].observed == 21
    assert o["6-MP"].expected == pytest.approx(19.2505, abs=1e-4)
    assert o["control"].expected == pytest.approx(10.7495, abs=1e-4)
    assert o["6-MP"].var == pytest.approx(6.25696, abs=1e-5)
    assert sum(r.observed for r in o.values()) == pytest.approx(sum(r.expected for r in o.values()))
    t = sv.logrank_test(leuk, "time", "event", "arm").collect()[0]
    assert t.chisq == pytest.approx(16.79294, abs=1e-4)
    assert t.df == 1
    assert t.p_value == pytest.approx(4.1688e-05, rel=1e-3)


def test_cox_efron(leuk):
    d = leuk.withColumn("ctl", (F.col("arm") == "control").cast("double"))
    coefs, tests = sv.cox_ph(d, "time", "event", ["ctl"])
    c = coefs.collect()[0]
    assert c.coef == pytest.approx(1.572125, abs=1e-5)
    assert c.se == pytest.approx(.412397, abs=1e-5)
    assert c.z == pytest.approx(3.812167, abs=1e-4)
    assert c.hr == pytest.approx(4.816874, abs=1e-4)
    t = tests.collect()[0]
    assert t.lrt == pytest.approx(16.35169, abs=1e-4)
    assert t.wald == pytest.approx(14.53262, abs=1e-4)
    assert t.score == pytest.approx(17.24654, abs=1e-4)
    assert t.loglik0 == pytest.approx(-93.18427, abs=1e-4)
    assert t.loglik == pytest.approx(-85.00842, abs=1e-4)


def test_cox_curve_monotone(leuk):
    d = leuk.withColumn("ctl", (F.col("arm") == "control").cast("double"))
    coefs, _ = sv.cox_ph(d, "time", "event", ["ctl"])
    curve = sorted(sv.cox_curve(d, "time", "event", ["ctl"], coefs).collect(), key=lambda r: r.time)
    vals = [r.surv for r in curve]
    assert all(0 <= b <= a <= 1 for a, b in zip(vals, vals[1:]))
    assert not math.isnan(vals[-1])


def test_risk_table(leuk):
    rt = {(r.arm, r.time): r for r in sv.risk_table(leuk, "time", "event", 10, "arm").collect()}
    assert rt[("6-MP", 0)].n_risk == 21
    assert rt[("6-MP", 10)].n_risk == 15     # times >= 10
    assert rt[("control", 20)].n_risk == 2


def test_curve_crossings(leuk):
    km = sv.kaplan_meier(leuk, "time", "event", "arm")
    r = sv.curve_crossings(km, "time", "arm", "6-MP", "control").collect()[0]
    assert r.n_crossings == 0


def test_concordance(leuk):
    d = leuk.withColumn("ctl", (F.col("arm") == "control").cast("double"))
    coefs, _ = sv.cox_ph(d, "time", "event", ["ctl"])
    r = sv.concordance(d, "time", "event", ["ctl"], coefs).collect()[0]
    # brute force over subject pairs with the same definition
    rows = d.collect()
    beta = coefs.collect()[0].coef
    conc = disc = tie = 0
    for a in rows:
        if a.event != 1:
            continue
        for b in rows:
            if b.time > a.time or (b.time == a.time and b.event == 0):
                ra, rb = beta * a.ctl, beta * b.ctl
                conc += ra > rb
                disc += ra < rb
                tie += ra == rb
    assert (r.concordant, r.discordant, r.tied_risk) == (conc, disc, tie)
    assert 0.5 < r.concordance < 1.0


def test_km_median_flat_half(spark):
    """R's rule: a curve exactly at 0.5 on [2, 3) has median 2.5."""
    df = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 1)], "time INT, event INT")
    km = sv.kaplan_meier(df, "time", "event")
    assert sv.km_median(km, "time", []).first().median == 2.5
