"""DuckDB SQL twins of :mod:`tessera.plans.catalog` (the correctness oracle).

The tables are pre-registered views.  Fixture views are CTE snippets built
from the same constants as :mod:`tessera.plans.views`.
"""

from __future__ import annotations

from pathlib import Path

from tessera.functions.hashing import TWO_32, cumulative_cutoffs, sql_hash32
from tessera.plans import views as V

ORACLE: dict[str, str] = {}


def _q(lst) -> str:
    return ", ".join("'" + s.replace("'", "''") + "'" for s in lst)


# ---------------------------------------------------------------- V1 family
V1 = """v1 AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id, CAST(sum(l_quantity) AS BIGINT) AS plays
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey)"""
IPROF = """iprof AS (
  SELECT v.item_id, p_name AS name, v.total_plays, v.n_users,
         CAST(v.total_plays AS DOUBLE) / v.n_users AS plays_per_user
  FROM (SELECT item_id, CAST(sum(plays) AS BIGINT) AS total_plays, count(user_id) AS n_users FROM v1 GROUP BY item_id) v
  JOIN part ON p_partkey = v.item_id)"""
UPROF = """uprof AS (
  SELECT user_id, CAST(sum(plays) AS BIGINT) AS total_plays, count(item_id) AS n_items,
         CAST(sum(plays) AS DOUBLE) / count(item_id) AS plays_per_item
  FROM v1 GROUP BY user_id)"""
_like = " ".join(f"AND name NOT LIKE '{p}'" for p in V.V1_ITEM_EXCLUDE_LIKE)
_names = " ".join(f"AND name <> '{n}'" for n in V.V1_ITEM_EXCLUDE_NAMES)
ELIG = f"""ie AS (SELECT item_id FROM iprof WHERE n_users > {V.V1_ITEM_MIN_USERS} {_names} {_like}),
ut AS (SELECT avg(plays_per_item) + {V.V1_USER_K} * stddev_samp(plays_per_item) AS cutoff FROM uprof),
ue AS (SELECT user_id FROM uprof, ut WHERE plays_per_item < cutoff AND n_items > {V.V1_USER_MIN_ITEMS}),
elig AS (SELECT user_id, item_id, plays FROM v1
         WHERE item_id IN (SELECT item_id FROM ie) AND user_id IN (SELECT user_id FROM ue))"""
_cut = cumulative_cutoffs(list(V.SPLIT_WEIGHTS))[0]
SPLIT = f"""sp AS (SELECT *, CASE WHEN {sql_hash32(V.SPLIT_SEED, 'user_id', 'item_id')} < {_cut}
                       THEN 'train' ELSE 'test' END AS split FROM elig),
train AS (SELECT * FROM sp WHERE split = 'train'),
test AS (SELECT * FROM sp WHERE split = 'test'),
pop AS (SELECT item_id, count(*) AS n_users FROM train GROUP BY item_id)"""
POOL = f"""pool AS (SELECT item_id, row_number() OVER (ORDER BY n_users DESC, item_id) - 1 AS idx
          FROM (SELECT * FROM pop ORDER BY n_users DESC, item_id LIMIT {V.TOP_K})),
psize AS (SELECT count(*) AS p FROM pool),
pc AS (SELECT user_id, count(DISTINCT item_id) AS n_pos FROM test GROUP BY user_id),
draws AS (SELECT user_id, n_pos, unnest(range(1, (SELECT p FROM psize) + 1)) AS draw FROM pc),
dh AS (SELECT user_id, n_pos, draw, {sql_hash32(V.SPLIT_SEED, 'user_id', 'draw')} % (SELECT p FROM psize) AS idx FROM draws),
dj AS (SELECT dh.user_id, dh.n_pos, dh.draw, pool.item_id FROM dh JOIN pool ON pool.idx = dh.idx),
ds AS (SELECT dj.* FROM dj ANTI JOIN test t ON t.user_id = dj.user_id AND t.item_id = dj.item_id),
neg AS (SELECT user_id, draw, item_id FROM
        (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY draw) AS rn FROM ds) WHERE rn <= n_pos)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE["item_profile"] = with_(V1, IPROF) + """
SELECT item_id, name, total_plays, n_users, round(plays_per_user, 6) AS plays_per_user FROM iprof"""
ORACLE["user_profile"] = with_(V1, UPROF) + """
SELECT user_id, total_plays, n_items, round(plays_per_item, 6) AS plays_per_item FROM uprof"""
ORACLE["outlier_thresholds"] = with_(V1, IPROF, UPROF) + f"""
SELECT 'item' AS entity, round(avg(plays_per_user), 6) AS mean, round(stddev_samp(plays_per_user), 6) AS sd,
       CAST({V.V1_ITEM_K} AS DOUBLE) AS k, round(avg(plays_per_user) + {V.V1_ITEM_K} * stddev_samp(plays_per_user), 6) AS cutoff
FROM iprof
UNION ALL
SELECT 'user', round(avg(plays_per_item), 6), round(stddev_samp(plays_per_item), 6),
       {V.V1_USER_K}, round(avg(plays_per_item) + {V.V1_USER_K} * stddev_samp(plays_per_item), 6)
FROM uprof"""
ORACLE["eligible_interactions"] = with_(V1, IPROF, UPROF, ELIG) + "SELECT * FROM elig"
ORACLE["hash_split_counts"] = with_(V1, IPROF, UPROF, ELIG, SPLIT) + """
SELECT split, count(*) AS n_rows, count(DISTINCT user_id) AS n_users,
       count(DISTINCT item_id) AS n_items, CAST(sum(plays) AS BIGINT) AS total_plays FROM sp GROUP BY split"""
ORACLE["top_items"] = with_(V1, IPROF, UPROF, ELIG, SPLIT) + f"""
SELECT item_id, n_users FROM pop ORDER BY n_users DESC, item_id LIMIT {V.TOP_K}"""
ORACLE["sampled_negatives"] = with_(V1, IPROF, UPROF, ELIG, SPLIT, POOL) + "SELECT * FROM neg"
_AUC = with_(V1, IPROF, UPROF, ELIG, SPLIT, POOL) + """,
ps AS (SELECT t.user_id, CAST(coalesce(p.n_users, 0) AS DOUBLE) AS score FROM test t LEFT JOIN pop p USING (item_id)),
ns AS (SELECT n.user_id, CAST(coalesce(p.n_users, 0) AS DOUBLE) AS score FROM neg n LEFT JOIN pop p USING (item_id)),
np AS (SELECT user_id, count(*) AS n_pos FROM ps GROUP BY user_id),
nn AS (SELECT user_id, count(*) AS n_neg FROM ns GROUP BY user_id),
wins AS (SELECT ps.user_id, count(*) FILTER (WHERE ps.score > ns.score) AS n_correct
         FROM ps JOIN ns USING (user_id) GROUP BY ps.user_id),
per AS (SELECT user_id, n_pos, n_neg, n_correct,
               round(CAST(n_correct AS DOUBLE) / (n_pos * n_neg), 6) AS auc
        FROM np JOIN nn USING (user_id) JOIN wins USING (user_id))
"""
ORACLE["user_auc"] = _AUC + "SELECT * FROM per"
ORACLE["mean_user_auc"] = _AUC + "SELECT round(avg(auc), 6) AS mean_auc, count(*) AS n_users FROM per"

V5 = """v5 AS (SELECT d.doc_id, n_chars, lang, source, quality, toxic
         FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""
ORACLE["stratified_partition"] = with_(V5) + f"""
SELECT doc_id, toxic,
  CASE WHEN row_number() OVER (PARTITION BY toxic ORDER BY {sql_hash32(20161117, 'doc_id')}, doc_id)
            <= ceil(count(*) OVER (PARTITION BY toxic) * 0.7) THEN 1 ELSE 0 END AS partition
FROM v5"""


# ------------------------------------------------------- cohort (V4) family
from tessera.functions.binning import sql_bin_right_closed  # noqa: E402

_T = V.EVENT_TYPES


def _txt(expr: str, missing: str) -> str:
    return f"coalesce(strftime({expr}, '%-m/%-d/%Y'), '{missing}')"


_flag_dt = ",\n    ".join(
    f"min(CASE WHEN event_type = '{t}' AND value >= {V.V4_FLAG_VALUE} THEN CAST(ts AS DATE) END) AS {t}_dt"
    for t in _T)
_races = _q(V.RACES)
V4 = f"""g4 AS (SELECT user_id,
    {_flag_dt},
    max(CASE WHEN value >= {V.V4_DEATH_VALUE} THEN CAST(ts AS DATE) END) AS death_dt
  FROM events GROUP BY user_id),
v4 AS (SELECT user_id,
    {_txt("DATE '1940-01-01' + CAST(((user_id * 7919) % 20000 + 20000) % 20000 AS INTEGER)", '#N/A')} AS birth_date,
    {_txt('death_dt', 'NULL')} AS death_date,
    CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
    [{_races}][CAST(((user_id * 3 + 1) % {len(V.RACES)} + {len(V.RACES)}) % {len(V.RACES)} AS INTEGER) + 1] AS race,
    {", ".join(f"CAST({t}_dt IS NOT NULL AS INTEGER) AS {t}_flag" for t in _T)},
    {", ".join(_txt(f"{t}_dt", "#N/A") + f" AS {t}_dt" for t in _T)}
  FROM g4)"""


def _clean(c: str) -> str:
    return f"nullif(nullif({c}, 'NULL'), '#N/A')"


def _parse(c: str) -> str:
    return f"CAST(try_strptime({_clean(c)}, '%m/%d/%Y') AS DATE)"


_dates = [f"{t}_dt" for t in _T]
_flags = [f"{t}_flag" for t in _T]


def _first_flagged(vals):
    whens = " ".join(f"WHEN {f} = 1 THEN {v}" for f, v in zip(_flags, vals))
    return f"(CASE {whens} END)"


COH = f"""c0 AS (SELECT user_id, sex, {_clean('race')} AS race,
    {", ".join(_flags)},
    {_parse('birth_date')} AS birth_date, {_parse('death_date')} AS death_date,
    {", ".join(_parse(d) + f" AS {d}" for d in _dates)}
  FROM v4),
c1 AS (SELECT *,
    date_diff('day', birth_date, {_first_flagged(_dates)}) / 365.25 AS dx_age,
    date_diff('day', birth_date, death_date) / 365.25 AS death_age,
    {_first_flagged([f"'{t}'" for t in _T])} AS cancer_type,
    greatest({", ".join(_dates)}) AS dx_date
  FROM c0),
c2 AS (SELECT *, {sql_bin_right_closed('dx_age', [10, 20, 30, 40, 50, 60, 70, 80, 90, 100])} AS age_cat,
    death_age - dx_age AS dx2death,
    CAST(date_diff('day', dx_date, least(coalesce(death_date, DATE '{V.V4_STUDY_END}'), DATE '{V.V4_STUDY_END}')) AS DOUBLE) AS tt_event,
    CAST(death_date IS NOT NULL AND death_date <= DATE '{V.V4_STUDY_END}' AS INTEGER) AS death
  FROM c1)"""
_steps = [
    ("has_dx_date", f"coalesce({', '.join(_dates)}) IS NOT NULL"),
    ("dx_before_cutoff", " AND ".join(f"({d} IS NULL OR {d} < DATE '{V.V4_DX_CUTOFF}')" for d in _dates)),
    ("single_type", " + ".join(f"coalesce({f}, 0)" for f in _flags) + " = 1"),
    ("non_negative_dx2death", "(dx2death IS NULL OR dx2death >= 0)"),
    ("dx_after_early_date", f"dx_date > DATE '{V.V4_EARLY_DATE}'"),
    ("race_known", "race IS NOT NULL"),
]
_cum = []
_acc = []
for _n, _c in _steps:
    _acc.append(f"({_c})")
    _cum.append(" AND ".join(_acc))
ORACLE["cohort_attrition"] = with_(V4, COH) + "SELECT * FROM (\n" + "\nUNION ALL\n".join(
    [f"SELECT 0 AS step_no, 'input' AS step, count(*) AS n_rows FROM c2"]
    + [f"SELECT {i}, '{n}', count(*) FILTER (WHERE coalesce({c}, false)) FROM c2"
       for i, ((n, _), c) in enumerate(zip(_steps, _cum), 1)]) + ")"
ORACLE["cohort_derived"] = with_(V4, COH) + f"""
SELECT user_id, sex, race, cancer_type, round(dx_age, 6) AS dx_age, round(death_age, 6) AS death_age,
       age_cat, round(dx2death, 6) AS dx2death, dx_date, CAST(year(dx_date) AS INTEGER) AS dx_year,
       tt_event, death
FROM c2 WHERE {_cum[-1]}"""


# -------------------------------------------------- descriptive (V3/V5) family
V3 = f"""per3 AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS start,
    min(CASE WHEN o_totalprice > {V.V3_EVENT_PRICE} THEN CAST(o_orderdate AS DATE) END) AS event_date
  FROM orders GROUP BY o_custkey),
v3 AS (SELECT c_custkey AS subject_id, c_mktsegment AS stratum, CAST(n_regionkey AS VARCHAR) AS region,
    CASE WHEN c_acctbal < {V.V3_GROUP2_BALANCE} THEN 'low' ELSE 'high' END AS group2,
    CAST(10 + c_custkey % 95 AS DOUBLE) AS age, start, event_date,
    CAST(date_diff('day', start, coalesce(event_date, DATE '{V.V3_STUDY_END}')) AS INTEGER) AS time,
    CAST(event_date IS NOT NULL AS INTEGER) AS event
  FROM per3 JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
_STRATA = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_REGIONS = ["0", "1", "2", "3", "4"]

ORACLE["age_bins"] = with_(V3) + f"""
SELECT {sql_bin_right_closed('age', [10, 20, 30, 40, 50, 60, 70, 80, 90, 100])} AS age_cat, count(*) AS n
FROM v3 GROUP BY 1"""


def _freq(src: str, col: str) -> str:
    return f"""SELECT {col}, n, round(n * 100.0 / sum(n) OVER (), 6) AS pct,
       CAST(sum(n) OVER (ORDER BY {col} NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_n,
       round(sum(n) OVER (ORDER BY {col} NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
             * 100.0 / sum(n) OVER (), 6) AS cum_pct,
       count(*) OVER () AS n_levels
FROM (SELECT {col}, count(*) AS n FROM {src} GROUP BY {col})"""


ORACLE["freq_one_way"] = with_(V3) + _freq("v3", "stratum")
ORACLE["rare_event_rate"] = with_(V5) + _freq("v5", "toxic")
_CT = """ct AS (SELECT a.stratum, b.region, coalesce(c.n, 0) AS n
  FROM (SELECT DISTINCT stratum FROM v3) a CROSS JOIN (SELECT DISTINCT region FROM v3) b
  LEFT JOIN (SELECT stratum, region, count(*) AS n FROM v3 GROUP BY ALL) c
    ON c.stratum = a.stratum AND c.region = b.region)"""
ORACLE["freq_two_way"] = with_(V3, _CT) + "SELECT * FROM ct"
ORACLE["column_percent"] = with_(V3, _CT) + """
SELECT stratum, region, n, round(n * 100.0 / sum(n) OVER (PARTITION BY stratum), 6) AS pct FROM ct"""
ORACLE["group_summary"] = with_(V3) + """
SELECT stratum, count(*) AS n, CAST(sum(event) AS BIGINT) AS n_event,
       round(sum(event) * 100.0 / count(*), 2) AS pct_event,
       count(*) FILTER (WHERE event = 1 AND time <= 1000) AS n_event_1000,
       round(count(*) FILTER (WHERE event = 1 AND time <= 1000) * 100.0 / count(*), 2) AS pct_event_1000,
       round(quantile_cont(time, 0.5), 6) AS median_time, min(time) AS min_time
FROM v3 GROUP BY stratum"""
ORACLE["group_means"] = with_(V3) + """
SELECT stratum, region, round(avg(age), 6) AS mean_age, count(*) AS n FROM v3 GROUP BY stratum, region"""
_PIV = "piv AS (SELECT stratum, " + ", ".join(
    f"round(avg(age) FILTER (WHERE region = '{r}'), 6) AS r_{r}" for r in _REGIONS) + \
    " FROM v3 GROUP BY stratum)"
ORACLE["pivot_means"] = with_(V3, _PIV) + "SELECT * FROM piv"
ORACLE["transpose_means"] = with_(V3, _PIV) + "SELECT region, " + ", ".join(
    f"max(value) FILTER (WHERE stratum = '{s}') AS {s}" for s in _STRATA) + \
    " FROM (UNPIVOT piv ON " + ", ".join(f"r_{r}" for r in _REGIONS) + \
    " INTO NAME region VALUE value) GROUP BY region"


def _hist(src: str, x: str, bins: int, by: str) -> str:
    return f"""hb AS (SELECT {by}, min({x}) AS lo, max({x}) AS hi, count({x}) AS nn FROM {src} GROUP BY {by}),
hj AS (SELECT s.{by}, s.{x}, hb.lo, (hb.hi - hb.lo) / {float(bins)} AS w, hb.nn FROM {src} s JOIN hb USING ({by})
       WHERE s.{x} IS NOT NULL),
hg AS (SELECT {by}, CAST(CASE WHEN w = 0 THEN 0 ELSE least(floor(({x} - lo) / w), {bins - 1}) END AS INTEGER) AS bin,
              lo, w, nn, count(*) AS n FROM hj GROUP BY ALL),
hist AS (SELECT {by}, bin, lo + bin * w AS bin_lo, lo + (bin + 1) * w AS bin_hi, n,
                CASE WHEN w > 0 THEN n / (nn * w) END AS density FROM hg)"""


ORACLE["histogram"] = with_(V3, _hist("v3", "time", 20, "stratum")) + """
SELECT stratum, bin, round(bin_lo, 6) AS bin_lo, round(bin_hi, 6) AS bin_hi, n, round(density, 6) AS density
FROM hist"""
ORACLE["box_stats"] = with_(V3) + """,
q AS (SELECT stratum, count(time) AS n, min(time) AS min, quantile_cont(time, 0.25) AS q1,
             quantile_cont(time, 0.5) AS median, quantile_cont(time, 0.75) AS q3, max(time) AS max
      FROM v3 GROUP BY stratum),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q),
w AS (SELECT v3.stratum, min(time) FILTER (WHERE time >= lo AND time <= hi) AS whisker_lo,
             max(time) FILTER (WHERE time >= lo AND time <= hi) AS whisker_hi,
             count(*) FILTER (WHERE NOT (time >= lo AND time <= hi)) AS n_outliers
      FROM v3 JOIN f USING (stratum) GROUP BY v3.stratum)
SELECT stratum, n, min, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, max,
       round(iqr, 6) AS iqr, whisker_lo, whisker_hi, n_outliers
FROM f JOIN w USING (stratum)"""
ORACLE["density"] = with_(V3, _hist("v3", "age", 64, "stratum")) + """,
ds AS (SELECT stratum, count(age) AS n, stddev_samp(age) AS sd,
              quantile_cont(age, 0.75) - quantile_cont(age, 0.25) AS iqr, min(age) AS lo, max(age) AS hi
       FROM v3 GROUP BY stratum),
dg AS (SELECT stratum, n, 0.9 * least(sd, iqr / 1.34) * pow(n, -0.2) AS bw, lo, hi,
              unnest(range(0, 32)) AS point FROM ds),
dx AS (SELECT *, lo + point * (hi - lo) / 31 AS x FROM dg)
SELECT dx.stratum, CAST(dx.point AS INTEGER) AS point, round(dx.x, 6) AS x,
       round(sum(h.n * exp(-0.5 * ((dx.x - (h.bin_lo + h.bin_hi) / 2) / dx.bw) ** 2) / sqrt(2 * pi()))
             / (dx.n * dx.bw), 6) AS density
FROM dx JOIN hist h USING (stratum) GROUP BY dx.stratum, dx.point, dx.x, dx.n, dx.bw"""


# ----------------------------------------------------- survival (V3) family
_KMSQL = """kc AS (SELECT stratum, group2, time, CAST(sum(event) AS BIGINT) AS n_event,
                   CAST(sum(1 - event) AS BIGINT) AS n_censor, count(*) AS n_obs FROM v3 GROUP BY ALL),
kr AS (SELECT *, CAST(sum(n_obs) OVER (PARTITION BY stratum, group2 ORDER BY time DESC
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS n_risk FROM kc),
kk AS (SELECT *,
   sum(CASE WHEN n_event < n_risk THEN ln(1 - n_event / n_risk) ELSE 0 END) OVER w AS slog,
   sum(CASE WHEN n_event >= n_risk THEN 1 ELSE 0 END) OVER w AS nz,
   sum(CASE WHEN n_event < n_risk THEN n_event / (n_risk * (n_risk - n_event)) ELSE 0 END) OVER w AS sgw
  FROM kr WINDOW w AS (PARTITION BY stratum, group2 ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
km AS (SELECT stratum, group2, time, n_risk, n_event, n_censor,
   CASE WHEN nz > 0 THEN 0.0 ELSE exp(slog) END AS surv,
   CASE WHEN nz = 0 THEN exp(slog) * sqrt(sgw) END AS std_err,
   CASE WHEN nz = 0 THEN exp(slog) * exp(-1.959963984540054 * sqrt(sgw)) END AS lower,
   CASE WHEN nz = 0 THEN least(1.0, exp(slog) * exp(1.959963984540054 * sqrt(sgw))) END AS upper
  FROM kk)"""
ORACLE["km_curve"] = with_(V3, _KMSQL) + """
SELECT stratum, group2, time, n_risk, n_event, n_censor, round(surv, 6) AS surv FROM km"""
ORACLE["km_ci"] = with_(V3, _KMSQL) + """
SELECT stratum, group2, time, round(surv, 6) AS surv, round(std_err, 6) AS std_err,
       round(lower, 6) AS lower, round(upper, 6) AS upper FROM km"""
ORACLE["km_median"] = with_(V3, _KMSQL) + """
SELECT stratum, group2, max(n_risk) AS n, CAST(sum(n_event) AS BIGINT) AS events,
       CASE WHEN min(time) FILTER (WHERE abs(surv - 0.5) < 1e-12) IS NOT NULL THEN (min(time) FILTER (WHERE abs(surv - 0.5) < 1e-12) + coalesce(min(time) FILTER (WHERE surv < 0.5 - 1e-12), min(time) FILTER (WHERE abs(surv - 0.5) < 1e-12))) / 2.0 ELSE CAST(min(time) FILTER (WHERE surv < 0.5 - 1e-12) AS DOUBLE) END AS median,
       CASE WHEN min(time) FILTER (WHERE abs(lower - 0.5) < 1e-12) IS NOT NULL THEN (min(time) FILTER (WHERE abs(lower - 0.5) < 1e-12) + coalesce(min(time) FILTER (WHERE lower < 0.5 - 1e-12), min(time) FILTER (WHERE abs(lower - 0.5) < 1e-12))) / 2.0 ELSE CAST(min(time) FILTER (WHERE lower < 0.5 - 1e-12) AS DOUBLE) END AS median_lcl,
       CASE WHEN min(time) FILTER (WHERE abs(upper - 0.5) < 1e-12) IS NOT NULL THEN (min(time) FILTER (WHERE abs(upper - 0.5) < 1e-12) + coalesce(min(time) FILTER (WHERE upper < 0.5 - 1e-12), min(time) FILTER (WHERE abs(upper - 0.5) < 1e-12))) / 2.0 ELSE CAST(min(time) FILTER (WHERE upper < 0.5 - 1e-12) AS DOUBLE) END AS median_ucl
FROM km GROUP BY stratum, group2"""
ORACLE["risk_table"] = with_(V3) + """,
b AS (SELECT stratum, group2, CAST(floor(time / 500) AS INTEGER) AS k, count(*) AS m,
             CAST(sum(event) AS BIGINT) AS d, CAST(sum(1 - event) AS BIGINT) AS c FROM v3 GROUP BY ALL),
top AS (SELECT stratum, group2, max(k) AS kmax FROM b GROUP BY ALL),
grid AS (SELECT stratum, group2, unnest(range(0, kmax + 1)) AS k FROM top),
g AS (SELECT grid.stratum, grid.group2, grid.k, coalesce(m, 0) AS m, coalesce(d, 0) AS d, coalesce(c, 0) AS c
      FROM grid LEFT JOIN b USING (stratum, group2, k))
SELECT stratum, group2, CAST(k * 500 AS INTEGER) AS time,
  CAST(sum(m) OVER (PARTITION BY stratum, group2 ORDER BY k DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS n_risk,
  CAST(coalesce(sum(d) OVER (PARTITION BY stratum, group2 ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS cum_events,
  CAST(coalesce(sum(c) OVER (PARTITION BY stratum, group2 ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS cum_censored
FROM g"""
ORACLE["censor_counts"] = with_(V3) + """
SELECT stratum, group2, time, CAST(sum(1 - event) AS BIGINT) AS n_censor FROM v3 GROUP BY ALL
HAVING sum(1 - event) > 0"""
ORACLE["logrank"] = with_(V3) + """,
c AS (SELECT stratum, group2, time, CAST(sum(event) AS BIGINT) AS d, count(*) AS m FROM v3 GROUP BY ALL),
grid AS (SELECT t.stratum, t.time, g.group2 FROM (SELECT DISTINCT stratum, time FROM c) t
         JOIN (SELECT DISTINCT stratum, group2 FROM c) g USING (stratum)),
gg AS (SELECT grid.*, coalesce(d, 0) AS d, coalesce(m, 0) AS m FROM grid LEFT JOIN c USING (stratum, group2, time)),
r AS (SELECT *, sum(m) OVER (PARTITION BY stratum, group2 ORDER BY time DESC
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ng FROM gg),
t AS (SELECT *, sum(ng) OVER (PARTITION BY stratum, time) AS nt, sum(d) OVER (PARTITION BY stratum, time) AS dt FROM r),
e AS (SELECT *, ng / nt AS p, CASE WHEN nt > 1 THEN dt * (nt - dt) / (nt - 1) ELSE 0 END AS w FROM t WHERE dt > 0)
SELECT stratum, group2, CAST(sum(d) AS BIGINT) AS observed, round(sum(dt * p), 6) AS expected,
       round(sum(w * p * (1 - p)), 6) AS var
FROM e GROUP BY stratum, group2"""
ORACLE["curve_crossings"] = with_(V3, _KMSQL) + """,
sa AS (SELECT stratum, time, surv AS sa FROM km WHERE group2 = 'low'),
sb AS (SELECT stratum, time, surv AS sb FROM km WHERE group2 = 'high'),
j AS (SELECT coalesce(sa.stratum, sb.stratum) AS stratum, coalesce(sa.time, sb.time) AS time, sa, sb
      FROM sa FULL JOIN sb ON sa.stratum = sb.stratum AND sa.time = sb.time),
f AS (SELECT stratum, time,
        coalesce(last_value(sa IGNORE NULLS) OVER w, 1.0) AS sa,
        coalesce(last_value(sb IGNORE NULLS) OVER w, 1.0) AS sb
      FROM j WINDOW w AS (PARTITION BY stratum ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
s AS (SELECT stratum, time, sign(round(sa - sb, 12)) AS sg FROM f),
nz AS (SELECT *, lag(sg) OVER (PARTITION BY stratum ORDER BY time) AS prev FROM s WHERE sg <> 0),
cr AS (SELECT stratum, count(*) AS n_crossings, min(time) AS first_crossing FROM nz
       WHERE prev IS NOT NULL AND prev <> sg GROUP BY stratum)
SELECT k.stratum, coalesce(n_crossings, 0) AS n_crossings, first_crossing
FROM (SELECT DISTINCT stratum FROM km) k LEFT JOIN cr USING (stratum)"""


# ---------------------------------------------------- text pairs (V2) family
from tessera.functions import text as TX  # noqa: E402

_tc = int(round(V.V2_TEST_FRACTION * TWO_32))
V2 = f"""d2 AS (SELECT doc_id, text FROM documents),
rep2 AS (SELECT text, min(doc_id) AS rep_id FROM d2 GROUP BY text),
p20 AS (SELECT rep2.rep_id AS a_id, d2.doc_id AS b_id, d2.text AS q1, d2.text AS q2, 1 AS is_duplicate
        FROM d2 JOIN rep2 USING (text) WHERE d2.doc_id <> rep2.rep_id
        UNION ALL
        SELECT a.doc_id, b.doc_id, a.text, b.text, 0 FROM d2 a JOIN d2 b ON b.doc_id = a.doc_id + 1
        WHERE a.text <> b.text),
p21 AS (SELECT *, a_id * {TWO_32} + b_id AS id FROM p20),
v2 AS (SELECT id, q1, q2,
    CASE WHEN {sql_hash32('v2split', 'id')} < {_tc} THEN NULL ELSE is_duplicate END AS is_duplicate,
    CASE WHEN {sql_hash32('v2split', 'id')} < {_tc} THEN 'test' ELSE 'train' END AS split
  FROM p21)"""


def _words(s: str) -> str:
    return f"list_filter(regexp_split_to_array({s}, '\\s+'), lambda x: x <> '')"


# What the lemma step should do, told in SQL on its own: dictionary, else suffix rules; noun, then verb.
_DOUBLE = "(" + "|".join(c + c for c in "bdgkmnprt") + ")"
_NOUN = """CASE WHEN suffix(x, 'ies') AND length(x) > 4 THEN x[:-4] || 'y'
  WHEN suffix(x, 'sses') AND length(x) > 4 THEN x[:-3]
  WHEN (suffix(x, 'ches') OR suffix(x, 'shes') OR suffix(x, 'xes') OR suffix(x, 'zes')) AND length(x) > 4 THEN x[:-3]
  WHEN suffix(x, 's') AND length(x) > 3 AND NOT (suffix(x, 'ss') OR suffix(x, 'us') OR suffix(x, 'is')) THEN x[:-2] ELSE x END"""
_VERB = f"""CASE WHEN length(y) > 6 AND regexp_matches(y, '{_DOUBLE}ing$') THEN y[:-5]
  WHEN length(y) > 5 AND suffix(y, 'ing') THEN y[:-4]
  WHEN length(y) > 5 AND regexp_matches(y, '{_DOUBLE}ed$') THEN y[:-4]
  WHEN length(y) > 4 AND suffix(y, 'ed') THEN y[:-3] ELSE y END"""
_STOPS = _q(TX.STOP_WORDS_EN)      # the same fixed list
_LISTED = [x.split("\t") for x in Path(TX.__file__).with_name("lemma_exceptions.tsv").read_text().splitlines()[1:]]


def _dictionary(tag: str) -> str:
    return "MAP {" + ", ".join(f"'{w}': '{lem}'" for w, t, lem in _LISTED if t == tag) + "}"


def _lemma_tokens(s: str) -> str:
    kept = (f"list_filter({_words(f'lower({s})')}, lambda x: regexp_full_match(x, '\\p{{L}}+') "
            f"AND NOT list_contains([{_STOPS}], x))")
    return f"list_transform(list_transform({kept}, lambda x: coalesce({_dictionary('n')}[x], {_NOUN})), " \
           f"lambda y: coalesce({_dictionary('v')}[y], {_VERB}))"


def _clean_tokens(s: str) -> str:
    return (f"list_filter(list_transform({_words(f'lower({s})')}, "
            f"lambda t: regexp_replace(t, '[^\\p{{L}}\\p{{N}}]', '', 'g')), lambda x: x <> '')")


def _ngrams(t: str, n: int) -> str:
    if n == 1:
        return t
    return f"list_transform(range(1, len({t}) - {n - 2}), lambda i: array_to_string({t}[i:i + {n - 1}], ' '))"


def _wc(s: str) -> str:
    return f"len({_words(s)})"


def _ratio(x: str, y: str) -> str:
    return f"abs({x} - {y}) / ({x} + {y} + 1e-15)"


TOK = f"""tk AS (SELECT id, q1, q2, is_duplicate, split,
    {_lemma_tokens('q1')} AS lemma_tok1, {_lemma_tokens('q2')} AS lemma_tok2,
    {_clean_tokens('q1')} AS q_tok1, {_clean_tokens('q2')} AS q_tok2 FROM v2),
tk2 AS (SELECT *, array_to_string(lemma_tok1, ' ') AS lemma1, array_to_string(lemma_tok2, ' ') AS lemma2 FROM tk),
tk3 AS (SELECT *, {_clean_tokens('lemma1')} AS l_tok1, {_clean_tokens('lemma2')} AS l_tok2 FROM tk2),
ft AS (SELECT id,
    {_wc('lemma1')} AS lWCount1, {_wc('lemma2')} AS lWCount2, {_wc('q1')} AS qWCount1, {_wc('q2')} AS qWCount2,
    CAST(length(lemma1) AS INTEGER) AS lLen1, CAST(length(lemma2) AS INTEGER) AS lLen2,
    CAST(length(q1) AS INTEGER) AS qLen1, CAST(length(q2) AS INTEGER) AS qLen2,
    {", ".join(f"len(list_intersect({_ngrams('q_tok1', n)}, {_ngrams('q_tok2', n)})) AS qNgrams_{n}" for n in (1, 2, 3))},
    {", ".join(f"len(list_intersect({_ngrams('l_tok1', n)}, {_ngrams('l_tok2', n)})) AS lNgrams_{n}" for n in (1, 2, 3))}
  FROM tk3)"""

ORACLE["pair_dropna"] = """
SELECT CASE WHEN a.doc_id % 2 = 0 THEN 'train' ELSE 'test' END AS split, count(*) AS n_before,
       count(*) FILTER (WHERE a.text IS NOT NULL AND b.text IS NOT NULL) AS n_after
FROM documents a LEFT JOIN documents b ON b.doc_id = a.doc_id * 2 GROUP BY ALL"""
ORACLE["pair_union_shift"] = with_(V2) + """,
mx AS (SELECT max(id) AS m FROM v2 WHERE split = 'train')
SELECT id, id AS orig_id, is_duplicate, m AS max_train_id FROM v2, mx WHERE split = 'train'
UNION ALL
SELECT id + m + 1, id, -1, m FROM v2, mx WHERE split = 'test'"""
ORACLE["pair_lemmas"] = with_(V2, TOK) + "SELECT id, lemma1, lemma2 FROM tk3"
ORACLE["pair_counts"] = with_(V2, TOK) + """
SELECT id, CAST(lWCount1 AS INTEGER) AS lWCount1, CAST(lWCount2 AS INTEGER) AS lWCount2,
       CAST(qWCount1 AS INTEGER) AS qWCount1, CAST(qWCount2 AS INTEGER) AS qWCount2,
       lLen1, lLen2, qLen1, qLen2 FROM ft"""
ORACLE["pair_ratios"] = with_(V2, TOK) + f"""
SELECT id, {_ratio('lWCount1', 'lWCount2')} AS lWCount_ratio, {_ratio('qWCount1', 'qWCount2')} AS qWCount_ratio,
       {_ratio('lLen1', 'lLen2')} AS lLen_ratio, {_ratio('qLen1', 'qLen2')} AS qLen_ratio,
       qNgrams_1 / (1 + greatest(qWCount1, qWCount2)) AS qUnigram_ratio,
       lNgrams_1 / (1 + greatest(lWCount1, lWCount2)) AS lUnigram_ratio FROM ft"""
ORACLE["pair_ngrams"] = with_(V2, TOK) + "SELECT id, " + ", ".join(
    f"CAST({k}Ngrams_{n} AS INTEGER) AS {k}Ngrams_{n}" for k in "ql" for n in (1, 2, 3)) + " FROM ft"
ORACLE["pair_corpus_full_join"] = with_(V2, TOK) + """,
a AS (SELECT array_to_string(lemma_tok1, ' ') AS k FROM tk),
b AS (SELECT array_to_string(lemma_tok2, ' ') AS k FROM tk),
ca AS (SELECT k, count(*) AS n FROM a GROUP BY k),
cb AS (SELECT k, count(*) AS n FROM b GROUP BY k),
j AS (SELECT coalesce(a.k, b.k) AS corpus_key FROM a FULL JOIN b ON a.k = b.k)
SELECT corpus_key, ca.n AS n_left, cb.n AS n_right, count(*) AS n_rows
FROM j LEFT JOIN ca ON ca.k = corpus_key LEFT JOIN cb ON cb.k = corpus_key
GROUP BY corpus_key, ca.n, cb.n"""


# DuckDB's levenshtein counts bytes: every other character of the corpus is put in the place of an ASCII one that
# no text has, so a character is a byte.
_BYTES = """used AS MATERIALIZED (SELECT DISTINCT unnest(string_split(q1 || q2 || lemma1 || lemma2, '')) AS c FROM tk2),
wide AS (SELECT c, row_number() OVER (ORDER BY c) AS r FROM used WHERE octet_length(encode(c)) > 1),
free AS (SELECT chr(i::INTEGER) AS c, row_number() OVER (ORDER BY i) AS r FROM (SELECT unnest(range(1, 128)) AS i) WHERE chr(i::INTEGER) NOT IN (SELECT c FROM used)),
put AS (SELECT string_agg(wide.c, '' ORDER BY wide.r) AS old, string_agg(free.c, '' ORDER BY wide.r) AS new FROM wide JOIN free USING (r)),
lev AS (SELECT id, levenshtein(translate(lemma1, old, new), translate(lemma2, old, new)) AS lemma_leven,
               levenshtein(translate(q1, old, new), translate(q2, old, new)) AS question_leven FROM tk2, put)"""
ORACLE["pair_levenshtein"] = with_(V2, TOK, _BYTES) + """
SELECT id, CAST(lemma_leven AS INTEGER) AS lemma_leven, CAST(question_leven AS INTEGER) AS question_leven FROM lev"""


def _tfidf(corpus: str) -> str:
    if corpus == "union":
        docs = """docs AS (SELECT lemma_tok1 AS words, 1 AS w FROM tk UNION ALL SELECT lemma_tok2, 1 FROM tk)"""
    else:
        docs = """ka AS (SELECT lemma_tok1 AS words, count(*) AS n FROM tk GROUP BY 1),
kb AS (SELECT lemma_tok2 AS words, count(*) AS n FROM tk GROUP BY 1),
docs AS (SELECT coalesce(ka.words, kb.words) AS words,
                CASE WHEN ka.n IS NOT NULL AND kb.n IS NOT NULL THEN ka.n * kb.n ELSE coalesce(ka.n, kb.n) END AS w
         FROM ka FULL JOIN kb ON ka.words = kb.words)"""
    return with_(V2, TOK) + "," + docs + """,
nd AS (SELECT sum(w) AS n FROM docs),
dfq AS (SELECT token, sum(w) AS df FROM (SELECT unnest(list_distinct(words)) AS token, w FROM docs) GROUP BY token),
voc AS (SELECT token, ln((n + 1) / (df + 1)) AS idf FROM dfq, nd WHERE df >= 2),
diff AS (SELECT id, token, sum(s) AS d FROM (
           SELECT id, unnest(lemma_tok1) AS token, 1 AS s FROM tk
           UNION ALL SELECT id, unnest(lemma_tok2), -1 FROM tk) GROUP BY id, token),
dist AS (SELECT id, sum(pow(d * idf, 2)) AS dd FROM diff JOIN voc USING (token) WHERE d <> 0 GROUP BY id)
SELECT tk.id, round(coalesce(dd, 0.0), 6) AS tfidfDistance FROM tk LEFT JOIN dist USING (id)"""


ORACLE["pair_tfidf_distance"] = _tfidf("union")
ORACLE["pair_features"] = with_(V2, TOK, _BYTES) + f""",
counts AS ({ORACLE["pair_counts"].split(TOK)[1]}),
ratios AS ({ORACLE["pair_ratios"].split(TOK)[1]}),
grams AS ({ORACLE["pair_ngrams"].split(TOK)[1]}),
td AS (WITH {_tfidf("union").split(TOK)[1].lstrip("\n,")})
SELECT counts.*, ratios.* EXCLUDE (id), grams.* EXCLUDE (id), td.tfidfDistance, CAST(lemma_leven AS INTEGER) AS lemma_leven,
  CAST(question_leven AS INTEGER) AS question_leven, is_duplicate, split
FROM counts JOIN ratios USING (id) JOIN grams USING (id) JOIN td USING (id) JOIN lev USING (id) JOIN v2 USING (id)"""
ORACLE["pair_tfidf_full_join"] = _tfidf("full_join")


# --------------------------------------------- models / clustering (oracle part)
ORACLE["model_metrics_fixed"] = with_(V5) + """,
s AS (SELECT toxic AS y, least(1.0, n_chars / 20000.0) AS p FROM v5),
c AS (SELECT count(*) AS n,
        count(*) FILTER (WHERE p >= 0.1 AND y = 1) AS tp, count(*) FILTER (WHERE p >= 0.1 AND y = 0) AS fp,
        count(*) FILTER (WHERE p < 0.1 AND y = 0) AS tn, count(*) FILTER (WHERE p < 0.1 AND y = 1) AS fn,
        avg((p - y) * (p - y)) AS brier,
        -avg(y * ln(least(greatest(p, 1e-15), 1 - 1e-15)) + (1 - y) * ln(1 - least(greatest(p, 1e-15), 1 - 1e-15))) AS log_loss
      FROM s),
a AS (SELECT sum(CASE WHEN a.p > b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0.0 END)
             / (count(*)) AS auc
      FROM s a JOIN s b ON a.y = 1 AND b.y = 0)
SELECT n, tp, fp, tn, fn, round(brier, 6) AS brier, round(log_loss, 6) AS log_loss,
       round((fp + fn) / n, 6) AS misclassification,
       round(tp / nullif(tp + fn, 0), 6) AS sensitivity, round(tn / nullif(tn + fp, 0), 6) AS specificity,
       round(tp / nullif(tp + fp, 0), 6) AS precision, round(auc, 6) AS auc
FROM c, a"""
_KM_COLS = ["lang", "source", "quality", "toxic"]
ORACLE["kmodes_assign"] = with_(V5) + f""",
init AS (SELECT row_number() OVER (ORDER BY {sql_hash32(20161117, 'doc_id')}, doc_id) - 1 AS cluster,
                {", ".join(_KM_COLS)} FROM v5 ORDER BY {sql_hash32(20161117, 'doc_id')}, doc_id LIMIT 4),
d AS (SELECT v5.doc_id, init.cluster,
             {" + ".join(f"CASE WHEN v5.{c} = init.{c} THEN 0 ELSE 1 END" for c in _KM_COLS)} AS mismatch
      FROM v5 CROSS JOIN init)
SELECT doc_id, CAST(arg_min(cluster, mismatch * 1000 + cluster) AS INTEGER) AS cluster,
       CAST(min(mismatch) AS INTEGER) AS mismatch
FROM d GROUP BY doc_id"""

ORACLE["surrogate_ids"] = with_(V5) + """
SELECT doc_id, toxic, row_number() OVER (ORDER BY doc_id) AS patient_id FROM v5"""

ORACLE["surrogate_ids_lines"] = """
SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS line_id,
       l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem"""
ORACLE["km_curve_window"] = with_(V3, _KMSQL) + """
SELECT stratum, group2, time, n_risk, n_event, n_censor, round(surv, 6) AS surv FROM km WHERE time BETWEEN 100 AND 1000"""
ORACLE["cohort_filled"] = (
    "SELECT user_id, race, coalesce(dx2death, -1) AS dx2death FROM (" + ORACLE["cohort_derived"] + ")")
ORACLE["cohort_subset"] = (
    "SELECT race, count(*) AS n FROM (" + ORACLE["cohort_derived"] + ") WHERE race IN ('Asian', 'Black') GROUP BY race")
ORACLE["column_summary"] = " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count({c}) AS n, count(*) - count({c}) AS n_null, round(CAST(min({c}) AS DOUBLE), 6) AS min,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q1, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median,
       round(avg({c}), 6) AS mean, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q3,
       round(CAST(max({c}) AS DOUBLE), 6) AS max FROM orders""" for c in ("o_totalprice", "o_custkey"))
ORACLE["delimited_round_trip"] = "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer"
ORACLE["tail_split_orders"] = """
SELECT CASE WHEN r <= floor(n * (1 - 0.1)) THEN 'train' ELSE 'valid' END AS split, count(*) AS n,
       min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS r, count(*) OVER () AS n FROM orders) GROUP BY 1"""

ORACLE["schema_listing"] = "SELECT CAST(position AS INTEGER) AS position, column_name, data_type, true AS nullable, label, n_rows, n_null, n_distinct FROM (" + \
    " UNION ALL ".join(f"""SELECT (SELECT column_index FROM duckdb_columns() WHERE table_name = 'customer' AND column_name = '{c}' LIMIT 1) AS position,
  '{c}' AS column_name, '{t}' AS data_type, {label} AS label, count(*) AS n_rows, count(*) - count({c}) AS n_null,
  count(DISTINCT {c}) AS n_distinct FROM customer""" for c, t, label in (
        ("c_custkey", "bigint", "NULL"), ("c_name", "string", "NULL"), ("c_nationkey", "int", "NULL"),
        ("c_acctbal", "double", "'account balance'"), ("c_mktsegment", "string", "NULL"))) + ")"
ORACLE["two_tower_features"] = with_(V2) + f""",
vn AS (SELECT count(*) AS n FROM embeddings),
tk AS (SELECT id, {_clean_tokens('q1')} AS t1, {_clean_tokens('q2')} AS t2 FROM v2),
tt AS (SELECT id, 1 AS side, unnest(t1) AS token FROM tk UNION ALL SELECT id, 2, unnest(t2) FROM tk),
tc AS (SELECT id, side, {sql_hash32('tok', 'token')} % n AS vec_id, count(*) AS m FROM tt, vn GROUP BY ALL),
td AS (SELECT id, side, dim, sum(m * x) / sum(m) AS x FROM tc JOIN (
         SELECT vec_id, unnest(range(64)) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings) USING (vec_id) GROUP BY id, side, dim),
grid AS (SELECT id, unnest(range(64)) AS dim FROM v2)
SELECT grid.id, CAST(grid.dim AS INTEGER) AS dim, round(pow(coalesce(a.x, 0) - coalesce(b.x, 0), 2), 6) AS sq_diff,
  round(coalesce(a.x, 0) + coalesce(b.x, 0), 6) AS sum
FROM grid LEFT JOIN td a ON a.id = grid.id AND a.dim = grid.dim AND a.side = 1
LEFT JOIN td b ON b.id = grid.id AND b.dim = grid.dim AND b.side = 2"""



def _kmodes(k: int, steps: int, cols: list[str]) -> str:
    """k-modes unrolled: k farthest-first seeds, then so many steps (a fixed point stays one)."""
    p = ", ".join(cols)
    differ = lambda a, b: " + ".join(f"CASE WHEN {a}.{c} = {b}.{c} THEN 0 ELSE 1 END" for c in cols)
    ctes = [f"pt AS MATERIALIZED (SELECT {p}, count(*) AS n, min({sql_hash32(20161117, 'doc_id')}) AS h FROM v5p WHERE partition = 1 GROUP BY {p})",
            f"s0 AS MATERIALIZED (SELECT 0 AS cluster, {p} FROM (SELECT * FROM pt ORDER BY h, {p} LIMIT 1))"]
    for i in range(1, k):
        ctes.append(f"""s{i} AS MATERIALIZED (SELECT * FROM s{i - 1} UNION ALL SELECT {i}, {p} FROM (
  SELECT pt.*, far FROM pt JOIN (SELECT pt.h AS hh, min({differ('pt', 'm')}) AS far FROM pt, s{i - 1} m GROUP BY pt.h) ON hh = pt.h
  WHERE far > 0 ORDER BY far DESC, h, {p} LIMIT 1))""")
    mode = f"s{k - 1}"
    for i in range(steps):
        ctes.append(f"""a{i} AS MATERIALIZED (SELECT pt.*, (SELECT min_by(m.cluster, ({differ('pt', 'm')}) * 1000 + m.cluster) FROM {mode} m) AS c FROM pt)""")
        for c in cols:
            ctes.append(f"""u{i}{c} AS (SELECT c, min_by(v, (-n, v)) AS v FROM (SELECT c, {c} AS v, sum(n) AS n FROM a{i} GROUP BY c, {c}) GROUP BY c)""")
        joins = " ".join(f"LEFT JOIN u{i}{c} ON u{i}{c}.c = m.cluster" for c in cols)
        values = ", ".join(f"CASE WHEN u{i}{c}.c IS NULL THEN m.{c} ELSE u{i}{c}.v END AS {c}" for c in cols)
        ctes.append(f"m{i} AS MATERIALIZED (SELECT m.cluster, {values} FROM {mode} m {joins})")
        mode = f"m{i}"
    return ",\n".join(ctes) + f""",
near AS (SELECT x.doc_id, x.partition, min(({differ('x', 'm')}) * 1000 + m.cluster) AS best FROM v5p x, {mode} m GROUP BY x.doc_id, x.partition)
SELECT doc_id, CASE WHEN partition = 1 THEN 'train' ELSE 'valid' END AS part, CAST(best % 1000 AS INTEGER) AS cluster,
  CAST(best // 1000 AS INTEGER) AS mismatch FROM near"""


# ------------------------------------------------ entropy trees (MOD-04..06)
def _mass(n: str, k: str) -> str:
    """n times the entropy of n rows with k events, in nats."""
    return " + ".join(f"CASE WHEN {c} > 0 THEN -{c} * ln({c}::DOUBLE / {n}) ELSE 0 END" for c in (k, f"({n} - {k})"))


def _tree_ctes(depth: int, leaf: int, interval: list[str], nominal: list[str], bins: int, p: str) -> str:
    """CTEs of one tree grown by plain SQL over long rows (row, input, bin): ``{p}n0`` .. ``{p}n{depth}`` hold the
    node of every row, ``{p}s0`` .. the splits, of each level."""
    inputs = interval + nominal
    long = []
    for i, c in enumerate(inputs):
        if c in interval:
            at = (f"CASE WHEN {c} IS NOT NULL THEN CASE WHEN hi = lo THEN 0 ELSE "
                  f"greatest(0, least({bins - 1}, floor(({c} - lo) / ((hi - lo) / {float(bins)})))) END END")
            src = f"v5p, (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM v5p WHERE partition = 1)"
            long.append(f"SELECT doc_id, partition, toxic, {i} AS i, CAST({at} AS INTEGER) AS b, "
                        f"lo + (CAST({at} AS INTEGER) + 1) * ((hi - lo) / {float(bins)}) AS edge, NULL AS level FROM {src}")
        else:
            long.append(f"SELECT doc_id, partition, toxic, {i}, CAST(r AS INTEGER), NULL, {c} FROM v5p LEFT JOIN "
                        f"(SELECT {c} AS lev, row_number() OVER (ORDER BY {c}) - 1 AS r FROM v5p "
                        f"WHERE partition = 1 AND {c} IS NOT NULL GROUP BY {c}) ON lev = {c}")
    out = [f"{p}l AS MATERIALIZED ({' UNION ALL '.join(long)})",
           f"{p}n0 AS MATERIALIZED (SELECT doc_id, partition, toxic, 1::BIGINT AS node FROM v5p)"]
    gain = (f"round((({_mass('tn', 'tk')}) - ({_mass('n', 'k')}) - ({_mass('(tn - n)', '(tk - k)')})) / tn / ln(2), 9)")
    for d in range(depth):
        out.append(f"""{p}h{d} AS MATERIALIZED (
  SELECT node, i, b, any_value(edge) AS edge, any_value(level) AS level, count(*) AS n, sum(l.toxic) AS k
  FROM {p}l l JOIN {p}n{d} USING (doc_id) WHERE l.partition = 1 GROUP BY node, i, b),
{p}t{d} AS (SELECT node, count(*) AS tn, sum(toxic) AS tk FROM {p}n{d} WHERE partition = 1 GROUP BY node),
{p}o{d} AS MATERIALIZED (
  SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY node, i) AS m,
    sum(n) OVER w AS cn, sum(k) OVER w AS ck, sum(n) OVER (PARTITION BY node, i) AS alln
  FROM {p}h{d} WHERE b IS NOT NULL
  WINDOW w AS (PARTITION BY node, i ORDER BY CASE WHEN i >= {len(interval)} THEN k::DOUBLE / n ELSE 0 END, b
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{p}c{d} AS (
  SELECT o.node, o.i, o.pos, o.b, o.edge, cn >= alln - cn AS miss_left, tn, tk,
    cn + CASE WHEN cn >= alln - cn THEN coalesce(g.n, 0) ELSE 0 END AS n,
    ck + CASE WHEN cn >= alln - cn THEN coalesce(g.k, 0) ELSE 0 END AS k
  FROM {p}o{d} o JOIN {p}t{d} USING (node) LEFT JOIN {p}h{d} g ON g.node = o.node AND g.i = o.i AND g.b IS NULL
  WHERE o.pos < o.m AND tk > 0 AND tk < tn AND o.node >= {2 ** d}),
{p}s{d} AS MATERIALIZED (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, i, pos) AS r
                 FROM (SELECT *, {gain} AS gain FROM {p}c{d}) WHERE gain > 0 AND least(n, tn - n) >= {leaf}) WHERE r = 1),
{p}n{d + 1} AS MATERIALIZED (
  SELECT x.doc_id, x.partition, x.toxic, CASE WHEN s.node IS NULL THEN x.node ELSE 2 * x.node + CASE WHEN
    CASE WHEN l.b IS NULL OR (s.i >= {len(interval)} AND o.pos IS NULL) THEN s.miss_left
         WHEN s.i >= {len(interval)} THEN o.pos <= s.pos ELSE l.b <= s.b END THEN 0 ELSE 1 END END AS node
  FROM {p}n{d} x LEFT JOIN {p}s{d} s USING (node)
  LEFT JOIN {p}l l ON l.doc_id = x.doc_id AND l.i = s.i
  LEFT JOIN {p}o{d} o ON o.node = x.node AND o.i = s.i AND o.b = l.b)""")
    every = " UNION ".join(f"SELECT node, doc_id, toxic FROM {p}n{d} WHERE partition = 1" for d in range(depth + 1))
    out.append(f"{p}every AS MATERIALIZED (SELECT node, count(*) AS n, sum(toxic)::BIGINT AS n_event FROM ({every}) GROUP BY node)")
    out.append(f"{p}scored AS MATERIALIZED (SELECT doc_id, x.partition, toxic, node, n_event::DOUBLE / n AS score "
               f"FROM {p}n{depth} x JOIN {p}every USING (node))")
    return ",\n".join(out)


def _catalog_trees() -> None:
    from tessera.plans import catalog as C
    v5p = f"""v5n AS (SELECT a.*, b.n_chars AS next_chars, b.lang AS next_lang FROM v5 a LEFT JOIN v5 b ON b.doc_id = a.doc_id + 1),
v5p AS MATERIALIZED (SELECT *, CASE WHEN row_number() OVER (PARTITION BY toxic ORDER BY {sql_hash32(20161117, 'doc_id')}, doc_id)
            <= ceil(count(*) OVER (PARTITION BY toxic) * 0.7) THEN 1 ELSE 0 END AS partition FROM v5n)"""

    def ctes(name: str) -> tuple[str, int, list[str]]:
        depth, leaf, cols = C.TREE_CONFIGS[name]
        own = [c for c in cols if c in C.V5_INTERVAL], [c for c in cols if c in C.V5_NOMINAL]
        return _tree_ctes(depth, leaf, *own, C.TREE_BINS, name), depth, own[0] + own[1]

    text, depth, inputs = ctes("tree2")
    names = "[" + ", ".join(f"'{c}'" for c in inputs) + "]"
    splits = " UNION ALL ".join(f"""SELECT s.node, s.i, s.edge, s.miss_left, s.gain,
  (SELECT string_agg(level, ',' ORDER BY b) FROM tree2o{d} o WHERE o.node = s.node AND o.i = s.i AND o.pos <= s.pos) AS levels
  FROM tree2s{d} s""" for d in range(depth))
    bits = f"({_mass('n', 'n_event')}) / n / ln(2)"
    ORACLE["tree_nodes"] = with_(V5, v5p, text) + f""",
sp AS ({splits})
SELECT e.node, CASE WHEN e.node > 1 THEN e.node // 2 END AS parent, CAST(floor(log2(e.node)) AS INTEGER) AS depth, n, n_event,
  round(n_event::DOUBLE / n, 6) AS p_event, round({bits}, 6) AS entropy, {names}[i + 1] AS input, round(edge, 6) AS cut,
  CASE WHEN i >= {sum(c in C.V5_INTERVAL for c in inputs)} THEN levels END AS left_levels,
  CASE WHEN miss_left THEN 'left' WHEN NOT miss_left THEN 'right' END AS missing_to, round(gain, 6) AS gain
FROM tree2every e LEFT JOIN sp USING (node)"""
    pairs = "(SELECT avg(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END) FROM {t}scored a " \
            "JOIN {t}scored b ON a.toxic = 1 AND b.toxic = 0 AND a.partition = 0 AND b.partition = 0)"
    ORACLE["tree_sweep"] = with_(V5, v5p, *[ctes(t)[0] for t in C.TREE_CONFIGS]) + " UNION ALL ".join(
        f"SELECT '{t}' AS config, {d} AS max_depth, {leaf} AS min_leaf, {len(cols)} AS n_inputs, round({pairs.format(t=t)}, 6) AS auc, "
        f"(SELECT count(*) FROM {t}every)::INTEGER AS n_nodes" for t, (d, leaf, cols) in C.TREE_CONFIGS.items())
    text = ctes("tree5")[0]
    ORACLE["persisted_scores"] = with_(V5, v5p, text) + "SELECT doc_id, node, round(score, 6) AS score FROM tree5scored WHERE partition = 0"
    ORACLE["model_metrics"] = with_(V5, v5p, text) + f""",
s AS (SELECT toxic AS y, score AS p, (SELECT avg(toxic) FROM v5p WHERE partition = 1) AS cut FROM tree5scored WHERE partition = 0),
c AS (SELECT count(*) AS n,
        count(*) FILTER (WHERE p >= cut AND y = 1) AS tp, count(*) FILTER (WHERE p >= cut AND y = 0) AS fp,
        count(*) FILTER (WHERE p < cut AND y = 0) AS tn, count(*) FILTER (WHERE p < cut AND y = 1) AS fn,
        avg((p - y) * (p - y)) AS brier,
        -avg(y * ln(least(greatest(p, 1e-15), 1 - 1e-15)) + (1 - y) * ln(1 - least(greatest(p, 1e-15), 1 - 1e-15))) AS log_loss
      FROM s)
SELECT n, tp, fp, tn, fn, round(brier, 6) AS brier, round(log_loss, 6) AS log_loss,
       round((fp + fn) / n, 6) AS misclassification,
       round(tp / nullif(tp + fn, 0), 6) AS sensitivity, round(tn / nullif(tn + fp, 0), 6) AS specificity,
       round(tp / nullif(tp + fp, 0), 6) AS precision, round({pairs.format(t='tree5')}, 6) AS auc
FROM c"""
    ORACLE["kmodes_fit"] = with_(V5, v5p, _kmodes(C.KMODES_MOST, 20, C.KMODES_COLS))


_catalog_trees()


# Sources and sinks: what went out must come back.
ORACLE["quoted_round_trip"] = "SELECT doc_id, text, lang, n_chars FROM documents"
ORACLE["inferred_schema"] = "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, {t} AS data_type,
  count(*) AS n_rows, count(*) - count({c}) AS n_null FROM orders""" for i, (c, t) in enumerate((
        ("o_orderkey", "CASE WHEN max(o_orderkey) > 2147483647 THEN 'bigint' ELSE 'int' END"), ("o_orderstatus", "'string'"),
        ("o_totalprice", "'double'"), ("o_orderdate", "'date'")), 1)) + ")"
ORACLE["headerless_tsv"] = with_(V1) + "SELECT user_id, item_id, plays FROM v1"
ORACLE["split_sink"] = with_(V2) + """
SELECT CASE split WHEN 'train' THEN 'labelled' ELSE 'unlabelled' END AS part, id,
       CASE split WHEN 'train' THEN is_duplicate ELSE -1 END AS is_duplicate FROM v2"""
ORACLE["eligible_items_optional"] = with_(V1, IPROF) + f"""
SELECT item_id, name, n_users, round(plays_per_user, 6) AS plays_per_user
FROM iprof, (SELECT avg(plays_per_user) + {V.V1_ITEM_K} * stddev_samp(plays_per_user) AS cutoff FROM iprof)
WHERE n_users > {V.V1_ITEM_MIN_USERS} {_names} {_like}
  AND NOT regexp_matches(name, '{V.V1_ITEM_EXCLUDE_RLIKE}') AND plays_per_user < cutoff"""


# Tests and models of two groups: closed forms of one covariate x = (group2 = 'low').
def _tail(chi: str) -> str:
    """Upper tail of χ² with one degree of freedom: 1 - erf(sqrt(chi / 2)), as a series of positive terms."""
    terms = (f"list_transform(range(0, 400), lambda n: exp(2 * n * ln(2) + (n + 0.5) * ln({chi} / 2) - {chi} / 2 "
             f"- lgamma(2 * n + 2) + lgamma(n + 1)))")
    return f"CASE WHEN {chi} > 0 THEN greatest(0, 1 - 2 / sqrt(pi()) * list_sum({terms})) ELSE 1 END"


ORACLE["logrank_two_groups"] = f"""
SELECT stratum, CAST(2 AS INTEGER) AS n_groups, round(chi, 6) AS chisq, CAST(1 AS INTEGER) AS df,
       round({_tail('chi')}, 6) AS p_value
FROM (SELECT stratum, (observed - expected) ** 2 / var AS chi FROM ({ORACLE['logrank'].replace('round(sum(dt * p), 6)', 'sum(dt * p)').replace('round(sum(w * p * (1 - p)), 6)', 'sum(w * p * (1 - p))')})
      WHERE group2 = 'low')"""

_STEPS = 12
#: Per stratum and time: at risk, events (n, d; n1, d1 of x = 1); then one row a tied event (Efron).
_COX = """cc AS (SELECT stratum, time, sum(event) AS d, sum(event) FILTER (WHERE group2 = 'low') AS d1,
                   count(*) AS m, count(*) FILTER (WHERE group2 = 'low') AS m1,
                   count(*) FILTER (WHERE event = 0) AS c, count(*) FILTER (WHERE event = 0 AND group2 = 'low') AS c1
            FROM v3 GROUP BY ALL),
cr AS (SELECT stratum, time, d, coalesce(d1, 0) AS d1, m, m1, c, c1, sum(m) OVER w AS n, sum(m1) OVER w AS n1
       FROM cc WINDOW w AS (PARTITION BY stratum ORDER BY time DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ct AS (SELECT stratum, l, d, d1, n1 - l / d * d1 AS a1, n - n1 - l / d * (d - d1) AS a0
       FROM (SELECT *, unnest(range(0, CAST(d AS BIGINT))) AS l FROM cr WHERE d > 0)),
b0 AS (SELECT DISTINCT stratum, CAST(0 AS DOUBLE) AS beta FROM v3),
""" + ",\n".join(f"""b{k + 1} AS MATERIALIZED (SELECT stratum, beta + sum(CASE WHEN l = 0 THEN d1 ELSE 0 END - p) / sum(p * (1 - p)) AS beta
  FROM (SELECT *, a1 * exp(beta) / (a1 * exp(beta) + a0) AS p FROM ct JOIN b{k} USING (stratum)) GROUP BY stratum, beta)"""
                for k in range(_STEPS)) + f""",
cf AS (SELECT stratum, beta, sum(p * (1 - p)) AS info, sum(p0 * (1 - p0)) AS info0, sum(x - p0) AS u0,
              sum(x * beta - ln(a1 * exp(beta) + a0)) AS ll, -sum(ln(a1 + a0)) AS ll0
       FROM (SELECT *, a1 * exp(beta) / (a1 * exp(beta) + a0) AS p, a1 / (a1 + a0) AS p0, CASE WHEN l = 0 THEN d1 ELSE 0 END AS x
             FROM ct JOIN b{_STEPS} USING (stratum)) GROUP BY stratum, beta)"""
ORACLE["cox_fit"] = with_(V3, _COX) + f"""
SELECT stratum, 'group2_low' AS term, round(beta, 6) AS coef, round(exp(beta), 6) AS hr, round(se, 6) AS se,
       round(beta / se, 6) AS z, round({_tail('((beta / se) ** 2)')}, 6) AS p_value,
       round(exp(beta - 1.959963984540054 * se), 6) AS hr_lower, round(exp(beta + 1.959963984540054 * se), 6) AS hr_upper
FROM (SELECT *, 1 / sqrt(info) AS se FROM cf)"""
ORACLE["cox_tests"] = with_(V3, _COX) + f"""
SELECT stratum, CAST(1 AS INTEGER) AS df, round(ll0, 6) AS loglik0, round(ll, 6) AS loglik, round(lrt, 6) AS lrt,
       round({_tail('lrt')}, 6) AS lrt_p, round(wald, 6) AS wald, round({_tail('wald')}, 6) AS wald_p,
       round(score, 6) AS score, round({_tail('score')}, 6) AS score_p, true AS converged
FROM (SELECT *, 2 * (ll - ll0) AS lrt, beta * beta * info AS wald, u0 * u0 / info0 AS score FROM cf)"""
ORACLE["cox_concordance"] = with_(V3, _COX) + """,
pc AS (SELECT stratum, beta, sum(d1 * (n - n1 - (m - m1) + c - c1)) AS low_first, sum((d - d1) * (n1 - m1 + c1)) AS high_first,
              sum(d1 * (n1 - m1 + c1) + (d - d1) * (n - n1 - (m - m1) + c - c1)) AS tied_risk
       FROM cr JOIN cf USING (stratum) GROUP BY stratum, beta)
SELECT stratum, CAST(CASE WHEN beta > 0 THEN low_first ELSE high_first END AS BIGINT) AS concordant,
       CAST(CASE WHEN beta > 0 THEN high_first ELSE low_first END AS BIGINT) AS discordant, CAST(tied_risk AS BIGINT) AS tied_risk,
       round((CASE WHEN beta > 0 THEN low_first ELSE high_first END + 0.5 * tied_risk) / (low_first + high_first + tied_risk), 6) AS concordance
FROM pc"""
ORACLE["cox_curve"] = with_(V3, _COX) + """,
w AS (SELECT stratum, exp((1 - x) * beta) AS w1, exp(-x * beta) AS w0
      FROM (SELECT stratum, avg(CASE WHEN group2 = 'low' THEN 1.0 ELSE 0 END) AS x FROM v3 GROUP BY stratum) JOIN cf USING (stratum)),
dh AS (SELECT stratum, time, sum(1 / (n1 * w1 + (n - n1) * w0 - l / d * (d1 * w1 + (d - d1) * w0))) AS h
       FROM (SELECT *, unnest(range(0, CAST(d AS BIGINT))) AS l FROM cr WHERE d > 0) JOIN w USING (stratum) GROUP BY ALL),
ch AS (SELECT stratum, time, n, d, sum(coalesce(h, 0)) OVER (PARTITION BY stratum ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumhaz
       FROM cr LEFT JOIN dh USING (stratum, time))
SELECT stratum, time, CAST(n AS BIGINT) AS n_risk, CAST(d AS BIGINT) AS n_event, round(cumhaz, 6) AS cumhaz, round(exp(-cumhaz), 6) AS surv
FROM ch"""
