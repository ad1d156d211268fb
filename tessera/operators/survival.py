"""Survival analysis (SUR-02..13, WIN-01..03): Kaplan–Meier, risk tables,
log-rank and Cox proportional hazards (Efron ties).

Every operator first collapses subjects to (stratum, group, time) counts with
a partial aggregation, so running sums go over *distinct times* of a group, and
:mod:`scan` runs them range by range where there are many, stratum or not.  All
strata and groups are computed in one plan (no per-stratum loop).  The Cox Newton loop runs one aggregation per
iteration over collapsed (stratum, time, covariate pattern) counts that are
checkpointed once; the driver only sees p + p² numbers per stratum.
"""

from __future__ import annotations

import math
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import stats
from tessera.operators.models import levels_of
from tessera.operators.scan import dense_rank, ordered, running
from tessera.session import materialize

Z975 = 1.959963984540054


def _keys(stratum, group):
    return ([stratum] if stratum else []) + ([group] if group else [])


def collapse(df: DataFrame, time: str, event: str, keys: list[str]) -> DataFrame:
    """(keys, time) → d events, c censored, m subjects."""
    return df.groupBy(*keys, time).agg(
        F.sum(F.col(event).cast("long")).alias("n_event"),
        F.sum((1 - F.col(event)).cast("long")).alias("n_censor"),
        F.count(F.lit(1)).alias("n_obs"))


def kaplan_meier(df: DataFrame, time: str, event: str, group: str | None = None,
                 stratum: str | None = None) -> DataFrame:
    """SUR-02/03: KM table per (stratum, group) at every distinct time:
    n_risk, n_event, n_censor, surv, std_err (Greenwood), log-type 95 % CI.

    S(t) = Π(1 − d/n) is evaluated as exp(Σ log(1 − d/n)); a factor with
    d = n makes S = 0 from there on (tracked by a zero counter).
    """
    keys = _keys(stratum, group)
    c = ordered(collapse(df, time, event, keys), keys, time)
    c = running(c, keys, time, {"n_risk": ("sum", "n_obs")}, descending=True)
    d, n = F.col("n_event"), F.col("n_risk")
    c = c.withColumns({
        "__log": F.when(d < n, F.log1p(-d / n)).otherwise(F.lit(0.0)),
        "__zero": F.when(d >= n, 1).otherwise(0),
        "__gw": F.when(d < n, d / (n * (n - d))).otherwise(F.lit(0.0)),
    })
    c = running(c, keys, time, {"__slog": ("sum", "__log"), "__nz": ("sum", "__zero"), "__sgw": ("sum", "__gw")})
    surv = F.when(F.col("__nz") > 0, F.lit(0.0)).otherwise(F.exp("__slog"))
    c = c.withColumn("surv", surv)
    se_log = F.sqrt("__sgw")
    ok = (F.col("__nz") == 0)
    return c.select(*keys, time, "n_risk", "n_event", "n_censor", "surv",
                    F.when(ok, F.col("surv") * se_log).alias("std_err"),
                    F.when(ok, F.col("surv") * F.exp(-Z975 * se_log)).alias("lower"),
                    F.when(ok, F.least(F.lit(1.0), F.col("surv") * F.exp(Z975 * se_log))).alias("upper"))


def clip_time(curve: DataFrame, time: str, lo=None, hi=None) -> DataFrame:
    """SUR-07: the rows of a curve or risk table inside a plotting window [lo, hi]
    (either may be None); the estimates are those of the whole data."""
    if lo is not None:
        curve = curve.filter(F.col(time) >= lo)
    return curve if hi is None else curve.filter(F.col(time) <= hi)


def _half_time(curve: str, time: str):
    """First time the curve reaches 0.5; if it sits exactly at 0.5, the
    midpoint between that time and the time it drops below (R's rule)."""
    eps = 1e-12
    t_eq = F.min(F.when(F.abs(F.col(curve) - 0.5) < eps, F.col(time)))
    t_lt = F.min(F.when(F.col(curve) < 0.5 - eps, F.col(time)))
    return F.when(t_eq.isNotNull(), (t_eq + F.coalesce(t_lt, t_eq)) / 2.0).otherwise(t_lt.cast("double"))


def km_median(km: DataFrame, time: str, keys: list[str]) -> DataFrame:
    """SUR-04: per group n, events, median survival time and its 95 % CI
    (the time the curve / its lower / upper band reaches 0.5)."""
    return km.groupBy(*keys).agg(
        F.max("n_risk").alias("n"), F.sum("n_event").alias("events"),
        _half_time("surv", time).alias("median"),
        _half_time("lower", time).alias("median_lcl"),
        _half_time("upper", time).alias("median_ucl"))


def risk_table(df: DataFrame, time: str, event: str, step: int, group: str | None = None,
               stratum: str | None = None) -> DataFrame:
    """SUR-05: number at risk, cumulative events and censored at break
    times 0, step, 2·step, … up to the group's last time.

    Counts are bucketed by floor(time/step) first, so the break grid costs
    groups × breaks, whatever the number of subjects.
    """
    keys = _keys(stratum, group)
    b = df.withColumn("__k", F.floor(F.col(time) / step).cast("int")).groupBy(*keys, "__k").agg(
        F.count(F.lit(1)).alias("__m"), F.sum(F.col(event).cast("long")).alias("__d"),
        F.sum((1 - F.col(event)).cast("long")).alias("__c"))
    top = b.groupBy(*keys).agg(F.max("__k").alias("__kmax"))
    grid = top.select(*keys, F.explode(F.sequence(F.lit(0), F.col("__kmax"))).alias("__k"))
    g = grid.join(b, keys + ["__k"], "left").na.fill(0, ["__m", "__d", "__c"])
    rev = (Window.partitionBy(*keys).orderBy(F.col("__k").desc())
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    fwd = (Window.partitionBy(*keys).orderBy(F.col("__k").asc())
           .rowsBetween(Window.unboundedPreceding, -1))
    return g.select(*keys, (F.col("__k") * step).alias("time"),
                    F.sum("__m").over(rev).alias("n_risk"),
                    F.coalesce(F.sum("__d").over(fwd), F.lit(0)).alias("cum_events"),
                    F.coalesce(F.sum("__c").over(fwd), F.lit(0)).alias("cum_censored"))


def censor_counts(df: DataFrame, time: str, event: str, group: str | None = None,
                  stratum: str | None = None) -> DataFrame:
    """SUR-06: censored subjects per time (the censoring plot's data)."""
    keys = _keys(stratum, group)
    return collapse(df, time, event, keys).filter(F.col("n_censor") > 0) \
        .select(*keys, time, "n_censor")


def logrank_terms(df: DataFrame, time: str, event: str, group: str,
                  stratum: str | None = None) -> tuple[DataFrame, DataFrame]:
    """SUR-08: observed, expected and the covariance of O − E per group.

    The grid is every distinct time of a stratum × the stratum's groups, so
    at-risk counts of a group are right even at times it has no subjects.
    Returns (per-group O/E/V_gg, pairwise V_gh) — both bounded by groups².
    """
    sk = [stratum] if stratum else []
    c = collapse(df, time, event, sk + [group])
    times = c.select(*sk, time).distinct()
    if sk:
        grid = times.join(c.select(*sk, group).distinct(), sk)
    else:       # the levels of one factor, bounded
        known = F.array(*[F.lit(v) for v in levels_of(c, [group])[group]])
        grid = times.withColumn(group, F.explode(known))
    g = grid.join(c, sk + [group, time], "left").na.fill(0, ["n_event", "n_censor", "n_obs"])
    g = running(ordered(g, [*sk, group], time), [*sk, group], time, {"n_g": ("sum", "n_obs")}, descending=True)
    at_t = Window.partitionBy(*sk, time)
    g = g.withColumns({"n_t": F.sum("n_g").over(at_t), "d_t": F.sum("n_event").over(at_t)})
    g = g.filter(F.col("d_t") > 0)
    w = F.when(F.col("n_t") > 1, F.col("d_t") * (F.col("n_t") - F.col("d_t")) / (F.col("n_t") - 1)) \
        .otherwise(F.lit(0.0))
    g = materialize(g.withColumns({"__p": F.col("n_g") / F.col("n_t"), "__w": w}))      # read three times
    per = g.groupBy(*sk, group).agg(
        F.sum("n_event").alias("observed"),
        F.sum(F.col("d_t") * F.col("__p")).alias("expected"),
        F.sum(F.col("__w") * F.col("__p") * (1 - F.col("__p"))).alias("var"))
    a = g.select(*sk, time, F.col(group).alias("g"), F.col("__p").alias("pg"), "__w")
    b = g.select(*sk, time, F.col(group).alias("h"), F.col("__p").alias("ph"))
    pair = (a.join(b, sk + [time])
            .groupBy(*sk, "g", "h")
            .agg(F.sum(F.col("__w") * F.col("pg") * (F.when(F.col("g") == F.col("h"), 1.0).otherwise(0.0)
                                                      - F.col("ph"))).alias("v")))
    return per, pair


def logrank_test(df: DataFrame, time: str, event: str, group: str,
                 stratum: str | None = None) -> DataFrame:
    """SUR-08: χ² = U' V⁻ U with df = rank(V), p from the χ² tail — one row
    per stratum.  The k×k matrices are solved on the driver, so there may be at
    most ``MAX_CELLS`` of their cells over all strata; more raise an error."""
    per, pair = logrank_terms(df, time, event, group, stratum)
    sk = [stratum] if stratum else []
    pair_rows = pair.limit(MAX_CELLS + 1).collect()
    if len(pair_rows) > MAX_CELLS:
        raise ValueError(f"over {MAX_CELLS} pairs of groups: {stratum} or {group} is no factor")
    per_rows = per.collect()          # fewer than the pairs
    cells, by = {}, {}
    for r in pair_rows:
        cells.setdefault(tuple(r[k] for k in sk), []).append(r)
    for r in per_rows:
        by.setdefault(tuple(r[k] for k in sk), []).append(r)
    out = []
    for s in sorted(by):
        rows = sorted(by[s], key=lambda r: str(r[group]))
        lv = {r[group]: k for k, r in enumerate(rows)}
        u = np.array([r["observed"] - r["expected"] for r in rows], dtype=float)
        v = np.zeros((len(lv), len(lv)))
        for r in cells.get(s, []):
            v[lv[r["g"]], lv[r["h"]]] = r["v"]
        dof = int(np.linalg.matrix_rank(v, tol=1e-10)) if len(lv) > 1 else 0
        chi = stats.quad_form_inv(u, v) if dof > 0 else float("nan")
        out.append((*s, len(lv), float(chi), dof, stats.chi2_sf(chi, dof) if dof > 0 else float("nan")))
    schema = ", ".join([f"{k} STRING" for k in sk] + ["n_groups INT", "chisq DOUBLE", "df INT", "p_value DOUBLE"])
    return df.sparkSession.createDataFrame(out, schema)


def curve_crossings(km: DataFrame, time: str, group: str, a, b, stratum: str | None = None) -> DataFrame:
    """SUR-13: do the KM curves of groups a and b cross?  Both curves are
    carried forward on the union of their times; sign changes of S_a − S_b
    (ignoring ties) are counted per stratum."""
    sk = [stratum] if stratum else []
    sa = km.filter(F.col(group) == a).select(*sk, time, F.col("surv").alias("sa"))
    sb = km.filter(F.col(group) == b).select(*sk, time, F.col("surv").alias("sb"))
    j = sa.join(sb, sk + [time], "full")
    j = running(ordered(j, sk, time), sk, time, {"__sa": ("last", "sa"), "__sb": ("last", "sb")})
    gap = F.coalesce("__sa", F.lit(1.0)) - F.coalesce("__sb", F.lit(1.0))
    nz = j.withColumn("__sign", F.signum(F.round(gap, 12))).filter(F.col("__sign") != 0)
    nz = running(nz, sk, time, {"__prev": ("last", "__sign")}, own=False)
    cross = nz.filter(F.col("__prev").isNotNull() & (F.col("__prev") != F.col("__sign")))
    base = km.select(*sk).distinct() if sk else km.sparkSession.range(1).select()
    agg = cross.groupBy(*sk).agg(F.count(F.lit(1)).alias("n_crossings"),
                                 F.min(time).alias("first_crossing"))
    out = base.join(agg, sk, "left") if sk else agg
    return out.select(*sk, F.coalesce("n_crossings", F.lit(0)).alias("n_crossings"), "first_crossing")


# --------------------------------------------------------------------- Cox
def design(df: DataFrame, factors: list[str], interactions: list[tuple[str, str]] = (),
           levels: dict | None = None) -> tuple[DataFrame, list[str]]:
    """Treatment (dummy) coding with the first level (sorted) as reference, as
    R factors do; interaction columns are products of the dummies."""
    levels = levels or {}
    cols, exprs = [], {}
    dummies = {}
    for f in factors:
        lv = levels.get(f) or levels_of(df, [f])[f]
        dummies[f] = []
        for v in lv[1:]:
            name = f"{f}_{v}"
            exprs[name] = (F.col(f) == F.lit(v)).cast("double")
            cols.append(name)
            dummies[f].append(name)
    out = df.withColumns(exprs)
    inter = {}
    for a, b in interactions:
        for x in dummies[a]:
            for y in dummies[b]:
                name = f"{x}:{y}"
                inter[name] = F.col(x) * F.col(y)
                cols.append(name)
    if inter:
        out = out.withColumns(inter)
    return out, cols


TIE_BLOCK = 1 << 16
MAX_CELLS = 1_000_000
MAX_STRATA = 10_000


def _tied(t: DataFrame, d: str, keys: list[str]) -> DataFrame:
    """One row per tied event number ``__l`` in [0, d): times with many ties are
    cut into blocks that are spread over tasks before they are expanded, so
    neither an array nor a task holds all ties of a time."""
    blocks = t.withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col(d) - 1, F.lit(TIE_BLOCK).cast("long"))))
    return (blocks.repartition(*keys, "__from")
            .withColumn("__l", F.explode(F.sequence("__from", F.least(F.col("__from") + TIE_BLOCK, F.col(d)) - 1)))
            .drop("__from"))


def _cox_pass(coll: DataFrame, sk: list[str], xs: list[str], beta: DataFrame, time: str) -> DataFrame:
    """One Efron pass: per stratum loglik, score U and information I."""
    p = len(xs)
    pairs = list(combinations_with_replacement(range(p), 2))
    j = coll.join(F.broadcast(beta), sk) if sk else coll.crossJoin(F.broadcast(beta))
    eta = sum((F.col(x) * F.col(f"__b{i}") for i, x in enumerate(xs)), F.lit(0.0))
    j = j.withColumn("__w", F.exp(eta)).withColumn("__eta", eta)
    a = {"__A0": F.sum(F.col("n_obs") * F.col("__w")), "__E0": F.sum(F.col("n_event") * F.col("__w")),
         "__d": F.sum("n_event"), "__xe": F.sum(F.col("n_event") * F.col("__eta"))}
    for i, x in enumerate(xs):
        a[f"__A1_{i}"] = F.sum(F.col("n_obs") * F.col("__w") * F.col(x))
        a[f"__E1_{i}"] = F.sum(F.col("n_event") * F.col("__w") * F.col(x))
        a[f"__X_{i}"] = F.sum(F.col("n_event") * F.col(x))
    for i, k in pairs:
        a[f"__A2_{i}_{k}"] = F.sum(F.col("n_obs") * F.col("__w") * F.col(xs[i]) * F.col(xs[k]))
        a[f"__E2_{i}_{k}"] = F.sum(F.col("n_event") * F.col("__w") * F.col(xs[i]) * F.col(xs[k]))
    t = j.groupBy(*sk, time, *[c for c in coll.columns if c == "__range"]).agg(*[v.alias(k) for k, v in a.items()])
    s_cols = ["__A0"] + [f"__A1_{i}" for i in range(p)] + [f"__A2_{i}_{k}" for i, k in pairs]
    t = running(t, sk, time, {c.replace("__A", "__S"): ("sum", c) for c in s_cols}, descending=True)
    t = t.filter(F.col("__d") > 0)
    t = _tied(t, "__d", [*sk, time])
    f = F.col("__l") / F.col("__d")
    den = F.col("__S0") - f * F.col("__E0")
    m1 = [(F.col(f"__S1_{i}") - f * F.col(f"__E1_{i}")) / den for i in range(p)]
    aggs = [F.sum(F.when(F.col("__l") == 0, F.col("__xe")).otherwise(0.0) - F.log(den)).alias("loglik")]
    for i in range(p):
        aggs.append(F.sum(F.when(F.col("__l") == 0, F.col(f"__X_{i}")).otherwise(0.0) - m1[i]).alias(f"u{i}"))
    for i, k in pairs:
        m2 = (F.col(f"__S2_{i}_{k}") - f * F.col(f"__E2_{i}_{k}")) / den
        aggs.append(F.sum(m2 - m1[i] * m1[k]).alias(f"i{i}_{k}"))
    return t.groupBy(*sk).agg(*aggs) if sk else t.agg(*aggs)


def cox_ph(df: DataFrame, time: str, event: str, xs: list[str], stratum: str | None = None,
           max_iter: int = 25, eps: float = 1e-9) -> tuple[DataFrame, DataFrame]:
    """SUR-09/10/11: Cox PH with Efron ties, one model per stratum.

    ``xs`` are numeric design columns (see :func:`design`).  Newton–Raphson
    from β = 0 with step halving; stops when the relative log-likelihood
    change is below ``eps``.  Columns constant within a stratum are aliased:
    their coefficient is reported as NULL (R prints NA).

    Returns (coefficients, tests): coef, hr, se, z, p, CI per covariate and
    loglik0/loglik, LRT, Wald and score tests per stratum; ``converged`` tells
    whether the stratum's last step was below ``eps`` within ``max_iter``.
    The models are solved on the driver, so there may be at most ``MAX_STRATA``
    strata; more raise an error.
    """
    spark = df.sparkSession
    sk = [stratum] if stratum else []
    if stratum:
        df = df.withColumn(stratum, F.col(stratum).cast("string"))
    p = len(xs)
    pairs = list(combinations_with_replacement(range(p), 2))
    coll = ordered(df.groupBy(*sk, time, *xs).agg(
        F.sum(F.col(event).cast("long")).alias("n_event"), F.count(F.lit(1)).alias("n_obs")), sk, time)
    # aliased columns: constant within a stratum
    var = coll.groupBy(*sk).agg(*[(F.max(x) - F.min(x)).alias(x) for x in xs]).limit(MAX_STRATA + 1).collect()
    if len(var) > MAX_STRATA:
        raise ValueError(f"over {MAX_STRATA} strata: {stratum} is no stratum")
    strata = [tuple(r[k] for k in sk) for r in var]
    active = {tuple(r[k] for k in sk): [i for i, x in enumerate(xs) if (r[x] or 0) > 0] for r in var}

    def run(beta):
        rows = [(*s, *[float(v) for v in beta[s]]) for s in strata]
        schema = ", ".join([f"{k} STRING" for k in sk] + [f"__b{i} DOUBLE" for i in range(p)])
        res = {}
        for r in _cox_pass(coll, sk, xs, spark.createDataFrame(rows, schema), time).collect():
            u = np.array([r[f"u{i}"] for i in range(p)], dtype=float)
            info = np.zeros((p, p))
            for i, k in pairs:
                info[i, k] = info[k, i] = r[f"i{i}_{k}"]
            res[tuple(r[k] for k in sk)] = (r["loglik"], u, info)
        return res

    def newton_step(s, u, info):
        idx = active[s]
        step = np.zeros(p)
        if idx:
            step[idx] = np.linalg.pinv(info[np.ix_(idx, idx)]) @ u[idx]
        return step

    beta = {s: np.zeros(p) for s in strata}
    cur = first = run(beta)
    conv = {s: False for s in strata}
    for _ in range(max_iter):
        todo = [s for s in strata if not conv[s]]
        if not todo:
            break
        cand = dict(beta)
        for s in todo:
            cand[s] = beta[s] + newton_step(s, cur[s][1], cur[s][2])
        nxt = run(cand)
        for _ in range(10):                       # step halving
            worse = [s for s in todo if nxt[s][0] < cur[s][0] - 1e-12]
            if not worse:
                break
            for s in worse:
                cand[s] = (beta[s] + cand[s]) / 2
            res = run(cand)
            for s in worse:
                nxt[s] = res[s]
        for s in todo:
            if abs(nxt[s][0] - cur[s][0]) <= eps * abs(nxt[s][0]):
                conv[s] = True
        beta, cur = cand, nxt

    coef_rows, test_rows = [], []
    for s in strata:
        ll, u, info = cur[s]
        ll0, u0, info0 = first[s]
        idx = active[s]
        cov = np.full((p, p), np.nan)
        if idx:
            cov[np.ix_(idx, idx)] = np.linalg.pinv(info[np.ix_(idx, idx)])
        for i, x in enumerate(xs):
            if i in idx:
                b, se = float(beta[s][i]), float(math.sqrt(max(cov[i, i], 0.0)))
                z = b / se if se > 0 else float("nan")
                coef_rows.append((*s, x, b, math.exp(b), se, z, 2 * stats.norm_sf(abs(z)),
                                  math.exp(b - Z975 * se), math.exp(b + Z975 * se)))
            else:
                coef_rows.append((*s, x, None, None, None, None, None, None, None))
        bi = beta[s][idx]
        wald = float(bi @ info[np.ix_(idx, idx)] @ bi) if idx else 0.0
        score = float(u0[idx] @ np.linalg.pinv(info0[np.ix_(idx, idx)]) @ u0[idx]) if idx else 0.0
        lrt = 2 * (ll - ll0)
        k = len(idx)
        test_rows.append((*s, k, float(ll0), float(ll), float(lrt), stats.chi2_sf(lrt, k),
                          wald, stats.chi2_sf(wald, k), score, stats.chi2_sf(score, k), conv[s]))
    sks = [f"{k} STRING" for k in sk]
    coefs = spark.createDataFrame(coef_rows, ", ".join(sks + [
        "term STRING", "coef DOUBLE", "hr DOUBLE", "se DOUBLE", "z DOUBLE", "p_value DOUBLE",
        "hr_lower DOUBLE", "hr_upper DOUBLE"]))
    tests = spark.createDataFrame(test_rows, ", ".join(sks + [
        "df INT", "loglik0 DOUBLE", "loglik DOUBLE", "lrt DOUBLE", "lrt_p DOUBLE", "wald DOUBLE",
        "wald_p DOUBLE", "score DOUBLE", "score_p DOUBLE", "converged BOOLEAN"]))
    return coefs, tests


def cox_curve(df: DataFrame, time: str, event: str, xs: list[str], coefs: DataFrame,
              stratum: str | None = None) -> DataFrame:
    """SUR-12: survival curve at the mean covariate values with the Efron
    hazard increment dH(t) = Σ_{l<d} 1/(S0 − (l/d)·E0), weights exp((x − x̄)β)."""
    sk = [stratum] if stratum else []
    if stratum:
        df = df.withColumn(stratum, F.col(stratum).cast("string"))
    b = (coefs.withColumn("__i", F.expr("0"))
         .groupBy(*sk).pivot("term", xs).agg(F.first(F.coalesce("coef", F.lit(0.0)))))
    b = b.select(*sk, *[F.coalesce(F.col(f"`{x}`"), F.lit(0.0)).alias(f"__b{i}") for i, x in enumerate(xs)])
    means = df.groupBy(*sk).agg(*[F.avg(x).alias(f"__m{i}") for i, x in enumerate(xs)])
    coll = df.groupBy(*sk, time, *xs).agg(F.sum(F.col(event).cast("long")).alias("n_event"),
                                          F.count(F.lit(1)).alias("n_obs"))
    par = b.join(means, sk) if sk else b.crossJoin(means)
    j = coll.join(F.broadcast(par), sk) if sk else coll.crossJoin(F.broadcast(par))
    eta = sum(((F.col(x) - F.col(f"__m{i}")) * F.col(f"__b{i}") for i, x in enumerate(xs)), F.lit(0.0))
    j = j.withColumn("__w", F.exp(eta))
    t = j.groupBy(*sk, time).agg(F.sum(F.col("n_obs") * F.col("__w")).alias("__A0"),
                                 F.sum(F.col("n_event") * F.col("__w")).alias("__E0"),
                                 F.sum("n_event").alias("n_event"), F.sum("n_obs").alias("__m"))
    t = running(ordered(t, sk, time), sk, time, {"__S0": ("sum", "__A0"), "n_risk": ("sum", "__m")}, descending=True)
    ev = _tied(t.filter(F.col("n_event") > 0), "n_event", [*sk, time])
    dh = ev.groupBy(*sk, time).agg(
        F.sum(1.0 / (F.col("__S0") - F.col("__l") / F.col("n_event") * F.col("__E0"))).alias("__dh"))
    t = t.join(dh, sk + [time], "left")
    t = running(t.withColumn("__dh", F.coalesce("__dh", F.lit(0.0))), sk, time, {"cumhaz": ("sum", "__dh")})
    return t.select(*sk, time, "n_risk", "n_event", "cumhaz", F.exp(-F.col("cumhaz")).alias("surv"))


def concordance(df: DataFrame, time: str, event: str, xs: list[str], coefs: DataFrame,
                stratum: str | None = None) -> DataFrame:
    """SUR-11: Harrell's C of the Cox risk score xβ, per stratum.

    A pair is comparable when the shorter time is an event; the partner has a
    longer time or is censored at that same time.  Concordant when the event
    subject has the higher risk score, half credit for equal scores.
    Distinct risk scores are numbered in order, and pairs are counted bit by
    bit of that number: two scores differ first at one bit, under one common
    prefix, where the higher has 1 and the lower 0.  Per (bit, prefix, time)
    the counts of both sides are collapsed and multiplied with those still at
    risk later: patterns × log(patterns) rows, no pairs of patterns.
    """
    sk = [stratum] if stratum else []
    if stratum:
        df = df.withColumn(stratum, F.col(stratum).cast("string"))
    b = (coefs.groupBy(*sk).pivot("term", xs).agg(F.first(F.coalesce("coef", F.lit(0.0)))))
    b = b.select(*sk, *[F.coalesce(F.col(f"`{x}`"), F.lit(0.0)).alias(f"__b{i}") for i, x in enumerate(xs)])
    j = df.join(F.broadcast(b), sk) if sk else df.crossJoin(F.broadcast(b))
    r = sum((F.col(x) * F.col(f"__b{i}") for i, x in enumerate(xs)), F.lit(0.0))
    c = (j.withColumn("__r", F.round(r, 12)).groupBy(*sk, time, "__r")
         .agg(F.sum(F.col(event).cast("long")).alias("__d"),
              F.sum((1 - F.col(event)).cast("long")).alias("__c"), F.count(F.lit(1)).alias("__m")))
    c = materialize(c.join(dense_rank(c.select(*sk, "__r").distinct(), sk, "__r", "__k"), [*sk, "__r"]))
    most = c.agg(F.max("__k")).first()[0] or 0
    bits = F.explode(F.sequence(F.lit(-1), F.lit(int(most).bit_length() - 1)) if most else F.array(F.lit(-1)))
    g = c.select("*", bits.alias("__bit"))
    tied = F.col("__bit") < 0
    one = F.expr("shiftright(__k, greatest(__bit, 0)) & 1") == 1
    g = g.withColumns({"__prefix": F.when(tied, F.col("__k")).otherwise(F.expr("shiftright(__k, greatest(__bit, 0) + 1)")),
                       "__one": ~tied & one})
    sums = {f"{v}{x}": F.sum(F.when(F.col("__one") == bool(x), F.col(v)).otherwise(0)) for v in ("__d", "__c", "__m") for x in (0, 1)}
    g = g.groupBy(*sk, "__bit", "__prefix", time).agg(*[v.alias(k) for k, v in sums.items()])
    same = [*sk, "__bit", "__prefix"]
    g = running(ordered(g, same, time), same, time, {f"__late{x}": ("sum", f"__m{x}") for x in (0, 1)}, descending=True, own=False)
    after = {x: F.col(f"__late{x}") + F.col(f"__c{x}") for x in (0, 1)}
    g = g.withColumns({"__after0": after[0], "__after1": after[1]})
    split = F.col("__bit") >= 0
    agg = g.groupBy(*sk).agg(
        F.sum(F.when(split, F.col("__d1") * F.col("__after0")).otherwise(0)).alias("concordant"),
        F.sum(F.when(split, F.col("__d0") * F.col("__after1")).otherwise(0)).alias("discordant"),
        F.sum(F.when(~split, F.col("__d0") * F.col("__after0")).otherwise(0)).alias("tied_risk"))
    return agg.withColumn("concordance", (F.col("concordant") + 0.5 * F.col("tied_risk"))
                          / (F.col("concordant") + F.col("discordant") + F.col("tied_risk")))
