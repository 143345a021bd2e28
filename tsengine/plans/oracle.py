"""Independent SQL for the registered queries (DuckDB dialect).

Each statement recomputes a query's result from the raw tables with plain
SQL (windows, joins, aggregates); no code is shared with the Spark side.
Tables ``events``, ``customer`` ... are views over the same parquet files.
Numeric choices mirror the Spark side so that equal math gives equal bits:
fixed-point sums on unscaled integers (HUGEINT), one conversion to double,
and 12-decimal rounding after transcendental functions.
"""

from __future__ import annotations

from tsengine.functions.settings import MINIMAL, feature_specs
from tsengine.plans import registry as R

_METRICS = R.METRICS
_COINS = R.COINS
_R = R.ROUND

TICKS = """ticks AS (
  SELECT event_type AS coin, ts, event_id AS seq,
         CAST(value AS DECIMAL(18,2)) AS prices,
         CAST(user_id AS DECIMAL(18,2)) AS market_caps,
         CAST(json_extract_string(props, '$.k') AS DECIMAL(18,2)) AS total_volumes
  FROM events)"""


def _binned(name: str, step_s: int, dense: bool, coins=None) -> str:
    step = step_s * 1_000_000
    where = "" if coins is None else "WHERE coin IN (" + ", ".join(f"'{c}'" for c in coins) + ")"
    aggs = ",\n         ".join(f"arg_max({m}, (ts, seq)) FILTER (WHERE {m} IS NOT NULL) AS {m}" for m in _METRICS)
    sql = f"""{name}_a AS (
  SELECT coin, epoch_us(date_trunc('day', min(ts))) AS a FROM ticks {where} GROUP BY coin),
{name}_r AS (
  SELECT t.coin, make_timestamp(a.a + ((epoch_us(t.ts) - a.a) // {step}) * {step}) AS bin,
         t.ts, t.seq, {", ".join("t." + m for m in _METRICS)}
  FROM ticks t JOIN {name}_a a USING (coin)),
{name}_s AS (
  SELECT coin, bin,
         {aggs}
  FROM {name}_r GROUP BY coin, bin)"""
    if not dense:
        return sql + f",\n{name} AS (SELECT * FROM {name}_s)"
    return sql + f""",
{name}_lim AS (SELECT coin, min(bin) AS lo, max(bin) AS hi FROM {name}_s GROUP BY coin),
{name}_g AS (
  SELECT coin, unnest(generate_series(lo, hi, INTERVAL '{step_s} seconds')) AS bin FROM {name}_lim),
{name} AS (
  SELECT g.coin, g.bin, {", ".join("s." + m for m in _METRICS)}
  FROM {name}_g g LEFT JOIN {name}_s s USING (coin, bin))"""


def _aligned(name: str, step_s: int) -> str:
    """Long aligned series ``datetime, variable, value`` of the fixed coin universe."""
    b = f"{name}_b"
    coins = ", ".join(f"('{c}', {i})" for i, c in enumerate(_COINS))
    parts = []
    for m in _METRICS:
        parts.append(f"SELECT bin AS datetime, CASE WHEN rnk = 0 THEN '{m}' ELSE '{m} ' || coin END AS variable, "
                     f"{m} AS value FROM {name}_j")
    union = "\n  UNION ALL ".join(parts)
    return _binned(b, step_s, True, _COINS) + f""",
{name}_c AS (SELECT * FROM (VALUES {coins}) AS t(coin, rnk)),
{name}_base AS (SELECT bin FROM {b} WHERE coin = '{_COINS[0]}'),
{name}_j AS (
  SELECT base.bin, c.coin, c.rnk, {", ".join("b." + m for m in _METRICS)}
  FROM {name}_base base CROSS JOIN {name}_c c
  LEFT JOIN {b} b ON b.coin = c.coin AND b.bin = base.bin),
{name} AS (
  {union})"""


def _minimal(name: str, src: str) -> str:
    """Minimal features (and raw values) over expanding windows of non-null rows of ``src``."""
    return f"""{name}_s AS (
  SELECT variable, datetime, value, CAST(value * 100 AS HUGEINT) AS u FROM {src} WHERE value IS NOT NULL),
{name}_w AS (
  SELECT variable, datetime, value,
         count(*) OVER w AS n, sum(u) OVER w AS su, sum(u * u) OVER w AS suu,
         CAST(max(value) OVER w AS DOUBLE) AS mx, CAST(min(value) OVER w AS DOUBLE) AS mn,
         quantile_cont(CAST(value AS DOUBLE), 0.5) OVER w AS med
  FROM {name}_s
  WINDOW w AS (PARTITION BY variable ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{name}_v AS (
  SELECT variable, datetime, value, med, mx, mn, su, suu, CAST(n AS DOUBLE) AS nd,
         CAST(CAST(n AS HUGEINT) * suu - su * su AS DOUBLE)
           / (CAST(n AS DOUBLE) * CAST(n AS DOUBLE) * CAST(10000.0 AS DOUBLE)) AS var
  FROM {name}_w),
{name} AS (
  SELECT variable, datetime, variable || '__sum_values' AS feature, CAST(su AS DOUBLE) / CAST(100.0 AS DOUBLE) AS value FROM {name}_v
  UNION ALL SELECT variable, datetime, variable || '__median', med FROM {name}_v
  UNION ALL SELECT variable, datetime, variable || '__mean', CAST(su AS DOUBLE) / (nd * CAST(100.0 AS DOUBLE)) FROM {name}_v
  UNION ALL SELECT variable, datetime, variable || '__length', nd FROM {name}_v
  UNION ALL SELECT variable, datetime, variable || '__standard_deviation', sqrt(var) FROM {name}_v
  UNION ALL SELECT variable, datetime, variable || '__variance', var FROM {name}_v
  UNION ALL SELECT variable, datetime, variable || '__root_mean_square',
                   sqrt(CAST(suu AS DOUBLE) / (nd * CAST(10000.0 AS DOUBLE))) FROM {name}_v
  UNION ALL SELECT variable, datetime, variable || '__maximum', mx FROM {name}_v
  UNION ALL SELECT variable, datetime, variable || '__absolute_maximum', greatest(abs(mx), abs(mn)) FROM {name}_v
  UNION ALL SELECT variable, datetime, variable || '__minimum', mn FROM {name}_v
  UNION ALL SELECT variable, datetime, variable, CAST(value AS DOUBLE) FROM {name}_v)"""


def _targets(name: str, feats: str, target: str, kind: str) -> str:
    src = {"price": "target", "log_return": "lr", "volatility": "vol"}[kind]
    return f"""{name}_idx AS (SELECT DISTINCT datetime FROM {feats} WHERE value IS NOT NULL),
{name}_raw AS (SELECT datetime, avg(value) AS target FROM {feats} WHERE feature = '{target}' GROUP BY datetime),
{name}_p AS (
  SELECT i.datetime, r.target, row_number() OVER (ORDER BY i.datetime) AS pos
  FROM {name}_idx i LEFT JOIN {name}_raw r USING (datetime)),
{name}_l AS (
  SELECT datetime, target, pos,
         (CASE WHEN target > 0 THEN ln(target) END)
         - (CASE WHEN lag(target) OVER (ORDER BY pos) > 0 THEN ln(lag(target) OVER (ORDER BY pos)) END) AS lr
  FROM {name}_p),
{name}_v AS (SELECT datetime, target, pos, lr, abs(lr) AS vol FROM {name}_l),
{name} AS (
  SELECT datetime, target, lr, vol, lead({src}) OVER (ORDER BY pos) AS y_future FROM {name}_v
  QUALIFY y_future IS NOT NULL)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _matrix() -> str:
    """Imputed hourly matrix ``m (datetime, feature, value)`` and targets ``tg``."""
    return ",\n".join([
        TICKS, _aligned("al", R.HOUR), _minimal("fe", "al"), _targets("tg", "fe", "prices", "price"),
        """names AS (SELECT DISTINCT feature FROM fe),
src AS (SELECT datetime, feature, value FROM fe WHERE datetime IN (SELECT datetime FROM tg)),
cells AS (SELECT tg.datetime, names.feature FROM tg CROSS JOIN names),
filled AS (SELECT c.datetime, c.feature, s.value FROM cells c LEFT JOIN src s USING (datetime, feature)),
st AS (
  SELECT feature, quantile_cont(value, 0.5) AS med, min(value) AS lo, max(value) AS hi
  FROM src WHERE value IS NOT NULL AND NOT isnan(value) AND isfinite(value) GROUP BY feature),
m AS (
  SELECT f.datetime, f.feature,
         CASE WHEN f.value IS NULL OR isnan(f.value) THEN coalesce(st.med, 0.0)
              WHEN f.value = 'inf'::DOUBLE THEN coalesce(st.hi, 0.0)
              WHEN f.value = '-inf'::DOUBLE THEN coalesce(st.lo, 0.0)
              ELSE f.value END AS value
  FROM filled f LEFT JOIN st USING (feature))"""])


def _relevance() -> str:
    """``rel (feature, type, n, stat, p_value)``: Kendall tau-b by pairs with its
    normal approximation (erf as a series), KS by ECDFs with its exact
    distribution (lattice paths that stay inside the observed distance)."""
    return """cy AS (SELECT m.datetime, m.feature, m.value AS x, CAST(tg.y_future AS DOUBLE) AS y
           FROM m JOIN tg USING (datetime)),
kinds AS (SELECT feature, count(*) AS n, count(DISTINCT x) AS nx FROM cy GROUP BY feature),
pairs AS (
  SELECT a.feature,
         sum(sign(a.x - b.x) * sign(a.y - b.y)) AS s,
         sum(CASE WHEN a.x = b.x THEN 1 ELSE 0 END) AS tx,
         sum(CASE WHEN a.y = b.y THEN 1 ELSE 0 END) AS ty
  FROM cy a JOIN cy b ON a.feature = b.feature AND a.datetime < b.datetime
  GROUP BY a.feature),
tau AS (
  SELECT k.feature, CAST(p.s AS DOUBLE)
           / sqrt((CAST(k.n * (k.n - 1) / 2 AS DOUBLE) - p.tx) * (CAST(k.n * (k.n - 1) / 2 AS DOUBLE) - p.ty)) AS stat
  FROM kinds k JOIN pairs p USING (feature) WHERE k.nx > 2),
lo AS (SELECT feature, min(x) AS x0 FROM cy GROUP BY feature),
grp AS (SELECT cy.feature, cy.y, cy.x = lo.x0 AS first FROM cy JOIN lo USING (feature)
        WHERE cy.feature IN (SELECT feature FROM kinds WHERE nx = 2)),
sizes AS (SELECT feature, sum(CASE WHEN first THEN 1 ELSE 0 END) AS n1,
                 sum(CASE WHEN first THEN 0 ELSE 1 END) AS n2 FROM grp GROUP BY feature),
ecdf AS (
  SELECT v.feature, v.y,
         (SELECT count(*) FROM grp g WHERE g.feature = v.feature AND g.first AND g.y <= v.y) AS c1,
         (SELECT count(*) FROM grp g WHERE g.feature = v.feature AND NOT g.first AND g.y <= v.y) AS c2
  FROM grp v),
ks AS (
  SELECT e.feature, CAST(max(abs(e.c1 * s.n2 - e.c2 * s.n1)) AS DOUBLE) / CAST(s.n1 * s.n2 AS DOUBLE) AS stat
  FROM ecdf e JOIN sizes s USING (feature) GROUP BY e.feature, s.n1, s.n2),
tiex AS (SELECT feature, sum(c * (c - 1) // 2) AS t, sum(c * (c - 1) * (c - 2)) AS t0, sum(c * (c - 1) * (2 * c + 5)) AS t1
         FROM (SELECT feature, x, count(*) AS c FROM cy GROUP BY feature, x) GROUP BY feature),
tiey AS (SELECT feature, sum(c * (c - 1) // 2) AS t, sum(c * (c - 1) * (c - 2)) AS t0, sum(c * (c - 1) * (2 * c + 5)) AS t1
         FROM (SELECT feature, y, count(*) AS c FROM cy GROUP BY feature, y) GROUP BY feature),
za AS (
  SELECT k.feature, abs(CAST(p.s AS DOUBLE)) / sqrt(
           (CAST(k.n * (k.n - 1) * (2 * k.n + 5) - a.t1 - b.t1 AS DOUBLE)) / 18
           + 2 * CAST(a.t AS DOUBLE) * b.t / (k.n * (k.n - 1))
           + CASE WHEN k.n > 2 THEN CAST(a.t0 AS DOUBLE) * b.t0 / (9 * CAST(k.n AS DOUBLE) * (k.n - 1) * (k.n - 2)) ELSE 0 END)
           / sqrt(2.0) AS z
  FROM kinds k JOIN pairs p USING (feature) JOIN tiex a USING (feature) JOIN tiey b USING (feature) WHERE k.nx > 2),
erf(feature, k, z, term, total) AS (
  SELECT feature, 0, z, z, z FROM za
  UNION ALL SELECT feature, k + 1, z, term * 2 * z * z / (2 * k + 3), total + term * 2 * z * z / (2 * k + 3)
  FROM erf WHERE k < 250),
kp AS (SELECT feature, greatest(0.0, 1 - 2 / sqrt(pi()) * exp(-z * z) * total) AS p FROM erf WHERE k = 250),
far AS (SELECT e.feature, s.n1, s.n2, max(abs(e.c1 * s.n2 - e.c2 * s.n1)) AS d
        FROM ecdf e JOIN sizes s USING (feature) GROUP BY e.feature, s.n1, s.n2),
walk(feature, step, i, paths, n1, n2, d) AS (
  SELECT feature, 0, 0, CAST(1 AS DOUBLE), n1, n2, d FROM far
  UNION ALL SELECT feature, step, i, sum(paths) / 2, n1, n2, d FROM (
    SELECT w.feature, w.step + 1 AS step, w.i + m.up AS i, w.paths, w.n1, w.n2, w.d
    FROM walk w, (VALUES (0), (1)) m(up)) q
  WHERE i <= n1 AND step - i <= n2 AND abs(i * n2 - (step - i) * n1) < d
  GROUP BY feature, step, i, n1, n2, d),
bp AS (SELECT f.feature, 1 - coalesce(max(w.paths), 0) / (   -- paths are halved at every step
         SELECT exp(sum(ln(CAST(f.n1 + j AS DOUBLE) / j)) - (f.n1 + f.n2) * ln(2.0)) FROM range(1, CAST(f.n2 AS BIGINT) + 1) r(j)) AS p
       FROM far f LEFT JOIN walk w ON w.feature = f.feature AND w.step = f.n1 + f.n2 GROUP BY f.feature, f.n1, f.n2),
rel AS (
  SELECT k.feature,
         CASE WHEN k.nx <= 1 THEN 'constant' WHEN k.nx = 2 THEN 'binary' ELSE 'real' END AS type,
         k.n, CASE WHEN k.nx = 2 THEN ks.stat WHEN k.nx > 2 THEN greatest(-1.0, least(1.0, tau.stat)) END AS stat,
         CASE WHEN k.nx = 2 THEN bp.p WHEN k.nx > 2 THEN kp.p END AS p_value
  FROM kinds k LEFT JOIN tau USING (feature) LEFT JOIN ks USING (feature)
       LEFT JOIN kp USING (feature) LEFT JOIN bp USING (feature))"""


def _hourly_features() -> str:
    return ",\n".join([TICKS, _aligned("al", R.HOUR), _minimal("fe", "al")])


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["q01_time_range_scan"] = _with(TICKS) + """SELECT coin, ts, seq, prices, market_caps, total_volumes
FROM ticks WHERE ts >= TIMESTAMP '2024-01-13 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00'"""

    q["q02_market_chart_json"] = """SELECT event_type AS coin, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts,
       row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts, event_id) - 1 AS seq,
       CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS prices,
       CAST(user_id AS DOUBLE) AS market_caps,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS total_volumes
FROM events"""

    q["q03_top_n"] = """SELECT c_name AS id, c_acctbal AS market_cap,
       row_number() OVER (ORDER BY c_acctbal DESC, c_name) AS rank
FROM customer ORDER BY rank LIMIT 10"""

    q["q04_id_lookup"] = """SELECT r.c_custkey AS pos, r.c_name AS name, CAST(c.c_custkey AS VARCHAR) AS id
FROM customer r JOIN customer c ON c.c_name = r.c_name"""

    q["q05_resample_last"] = _with(TICKS, _binned("b", R.HOUR, False)) + "SELECT coin, bin, prices, market_caps, total_volumes FROM b"
    q["q06_resample_dense_anchor"] = _with(TICKS, _binned("b", R.ODD_STEP, True)) + \
        "SELECT coin, bin, prices, market_caps, total_volumes FROM b"

    names = [f"{m}" if r == 0 else f"{m} {c}" for r, c in enumerate(_COINS) for m in _METRICS]
    cols = ",\n       ".join(f"max(value) FILTER (WHERE variable = '{n}') AS \"{n}\"" for n in names)
    q["q07_wide_left_join"] = _with(TICKS, _aligned("al", R.HOUR)) + f"SELECT datetime,\n       {cols}\nFROM al GROUP BY datetime"
    q["q08_unpivot"] = _with(TICKS, _aligned("al", R.HOUR)) + "SELECT datetime, variable, value FROM al"

    q["q09_roll_windows"] = _with(TICKS, _aligned("al", R.DAY)) + """SELECT variable, datetime AS "end",
       row_number() OVER (PARTITION BY variable ORDER BY datetime) AS length
FROM al WHERE value IS NOT NULL"""
    q["q10_ffill"] = _with(TICKS, _aligned("al", R.HOUR)) + """SELECT * FROM (
  SELECT variable, datetime,
         last_value(value IGNORE NULLS) OVER (PARTITION BY variable ORDER BY datetime
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
  FROM al) WHERE value IS NOT NULL"""
    q["q11_minimal_features"] = _with(_hourly_features()) + "SELECT variable, datetime, feature, value FROM fe"
    q["q12_drop_policy"] = _with(TICKS, _aligned("al", R.HOUR)) + "SELECT variable, datetime, value FROM al WHERE value IS NOT NULL"

    feat_names = sorted([f"{v}__{s[2]}" for v in names for s in feature_specs(MINIMAL)] + names)
    pcols = ",\n       ".join(f"avg(value) FILTER (WHERE feature = '{n}') AS \"{n}\"" for n in feat_names)
    q["q13_pivot"] = _with(TICKS, _aligned("al", R.DAY), _minimal("fe", "al")) + \
        f"SELECT datetime,\n       {pcols}\nFROM fe WHERE value IS NOT NULL GROUP BY datetime"

    q["q14_window_last_union"] = _with(TICKS, _aligned("al", R.HOUR)) + """, ff AS (
  SELECT variable, datetime,
         last_value(value IGNORE NULLS) OVER (PARTITION BY variable ORDER BY datetime
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
  FROM al),
s AS (SELECT variable, datetime, value, CAST(value * 100 AS HUGEINT) AS u FROM ff WHERE value IS NOT NULL),
w AS (SELECT variable, datetime, value, count(*) OVER w AS n, sum(u) OVER w AS su FROM s
      WINDOW w AS (PARTITION BY variable ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT variable, datetime, variable || '__mean' AS feature,
       CAST(su AS DOUBLE) / (CAST(n AS DOUBLE) * CAST(100.0 AS DOUBLE)) AS value FROM w
UNION ALL SELECT variable, datetime, variable, CAST(value AS DOUBLE) FROM w"""

    for key, kind in (("q15_target_price", "price"), ("q16_target_log_return", "log_return"),
                      ("q17_target_volatility", "volatility")):
        q[key] = _with(_hourly_features(), _targets("tg", "fe", R.TARGET, kind)) + \
            f"SELECT datetime, target, round(lr, {_R}) AS lr, round(vol, {_R}) AS vol, " \
            f"round(y_future, {_R}) AS y_future FROM tg"

    q["q52_target_percent_ahead"] = _with(_hourly_features(), _targets("tg", "fe", R.TARGET, "price").replace("\n  QUALIFY y_future IS NOT NULL", "")) + \
        f""", far AS (SELECT datetime, target, lr, vol, lead(lr, 3) OVER (ORDER BY datetime) AS later FROM tg)
SELECT datetime, target, round(100 * lr, {R.P_ROUND}) AS lr, round(100 * vol, {R.P_ROUND}) AS vol,
       round(100 * later, {R.P_ROUND}) AS y_future FROM far WHERE later IS NOT NULL"""
    q["q18_impute"] = _with(_matrix()) + "SELECT datetime, feature, value FROM m"
    rel = _with(_matrix(), _relevance()).replace("WITH ", "WITH RECURSIVE ", 1)
    q["q20_relevance"] = rel + f"SELECT feature, type, n, stat, round(p_value, {R.P_ROUND}) AS p_value FROM rel"
    by = f""", rk AS (SELECT *, row_number() OVER (ORDER BY p_value, feature) AS rank, count(*) OVER () AS m
        FROM rel WHERE p_value IS NOT NULL),
cm AS (SELECT sum(1.0::DOUBLE / rank) AS c FROM rk),
adj AS (SELECT a.feature, least(1.0, min(b.p_value * b.m * cm.c / b.rank)) AS p_adj
        FROM rk a JOIN rk b ON b.rank >= a.rank, cm GROUP BY a.feature),
fdr AS (SELECT rel.*, rk.rank, adj.p_adj, coalesce(adj.p_adj <= {R.FDR_LEVEL}, false) AS relevant
        FROM rel LEFT JOIN rk USING (feature) LEFT JOIN adj USING (feature))
"""
    q["q22_fdr"] = rel + by + f"SELECT feature, rank, round(p_adj, {R.P_ROUND}) AS p_adj, relevant FROM fdr"
    q["q23_select"] = rel + by + f"""SELECT feature, type, n, round(stat, {R.P_ROUND}) AS stat,
       round(p_value, {R.P_ROUND}) AS p_value, rank, round(p_adj, {R.P_ROUND}) AS p_adj, relevant,
       relevant OR feature = 'prices' AS kept,
       (SELECT count(*) FROM fdr WHERE relevant AND feature <> 'prices') + 2 > 5 AS enough FROM fdr"""

    q["q44_nan_as_null"] = _with(TICKS, _aligned("al", R.HOUR)) + """, f AS (
  SELECT variable, datetime, last_value(CASE WHEN hour(datetime) % 5 <> 0 THEN CAST(value AS DOUBLE) END IGNORE NULLS)
           OVER (PARTITION BY variable ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
  FROM al)
SELECT variable, datetime, value FROM f WHERE value IS NOT NULL"""

    idx = _with(_hourly_features(), _targets("tg", "fe", R.TARGET, "price"))
    q["q24_time_split"] = idx + """, p AS (SELECT datetime, row_number() OVER (ORDER BY datetime) - 1 AS pos, count(*) OVER () AS n FROM tg)
SELECT datetime, CASE WHEN pos >= n - CAST(floor(0.2 * n) AS BIGINT) THEN 'test' ELSE 'train' END AS split FROM p"""
    q["q25_folds"] = idx + f""", p AS (SELECT datetime, row_number() OVER (ORDER BY datetime) - 1 AS pos, count(*) OVER () AS n FROM tg),
f AS (SELECT datetime, pos, n, n // {R.SPLITS + 1} AS t, unnest(range(0, {R.SPLITS})) AS fold FROM p),
g AS (SELECT *, n - ({R.SPLITS} - fold) * t AS start FROM f)
SELECT datetime, CAST(fold AS INTEGER) AS fold, CASE WHEN pos < start THEN 'train' ELSE 'test' END AS role
FROM g WHERE pos < start + t"""

    q["q26_metrics"] = _with(TICKS, _aligned("al", R.HOUR)) + f""", s AS (
  SELECT variable, datetime, value AS predicted,
         lead(value) OVER (PARTITION BY variable ORDER BY datetime) AS actual
  FROM al WHERE value IS NOT NULL),
a AS (
  SELECT variable, count(actual) AS n,
         sum(CAST(actual - predicted AS DECIMAL(38,2)) * (actual - predicted)) AS sse,
         sum(actual) AS sy, sum(CAST(actual AS DECIMAL(38,2)) * actual) AS syy,
         sum(abs(actual - predicted)) AS sae,
         avg(CASE WHEN actual <> 0 THEN CAST(abs(actual - predicted) AS DOUBLE) / CAST(abs(actual) AS DOUBLE) END) AS mape
  FROM s WHERE actual IS NOT NULL GROUP BY variable),
b AS (SELECT *, CAST(n * syy - sy * sy AS DOUBLE) AS sst FROM a)
SELECT variable, n,
       round(1.0 - (CAST(sse AS DOUBLE) * CAST(n AS DOUBLE)) / sst, {_R}) AS r2,
       round(CAST(sae AS DOUBLE) / CAST(n AS DOUBLE), {_R}) AS mae,
       round(mape, {_R}) AS mape,
       round(sqrt(sst / (CAST(n AS DOUBLE) * (CAST(n AS DOUBLE) - 1))), {_R}) AS std,
       round(CAST(sae AS DOUBLE) / CAST(n AS DOUBLE) / sqrt(sst / (CAST(n AS DOUBLE) * (CAST(n AS DOUBLE) - 1))), {_R}) AS mae_per_std
FROM b"""

    q["q45_market_path"] = _with(
        TICKS.replace("ticks AS", "raw_ticks AS", 1),
        f"""rk AS (SELECT event_type AS coin, row_number() OVER (ORDER BY sum(value) DESC, event_type) - 1 AS rnk
       FROM events GROUP BY event_type QUALIFY rnk < {R.TOP_COINS}),
landed AS (
  SELECT coin, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts,
         row_number() OVER (PARTITION BY coin, CAST(ts AS DATE) ORDER BY ts, seq) AS seq,
         {", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in _METRICS)}
  FROM raw_ticks WHERE coin IN (SELECT coin FROM rk)),
ticks AS (SELECT * FROM landed WHERE ts >= TIMESTAMP '2024-01-13 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00')""",
        _binned("b", R.HOUR, True),
        """grid AS (SELECT g.bin, rk.coin, rk.rnk FROM rk CROSS JOIN (SELECT bin FROM b JOIN rk USING (coin) WHERE rnk = 0) g),
j AS (SELECT grid.*, b.prices, b.market_caps, b.total_volumes FROM grid LEFT JOIN b USING (coin, bin))""") + \
        "\nUNION ALL ".join(f"SELECT bin AS datetime, CASE WHEN rnk = 0 THEN '{m}' ELSE '{m} ' || coin END AS variable, "
                            f"{m} AS value FROM j" for m in _METRICS)

    q["q46_actual_vs_predicted"] = _with(TICKS, _aligned("al", R.HOUR)) + f""", s AS (
  SELECT datetime, CAST(value AS DOUBLE) AS value, lead(CAST(value AS DOUBLE)) OVER (ORDER BY datetime) AS nxt,
         row_number() OVER (ORDER BY datetime) AS pos, count(*) OVER () AS n
  FROM al WHERE variable = '{R.TARGET}' AND value IS NOT NULL)
SELECT datetime, nxt AS actual, CASE WHEN pos > n - CAST(floor(0.2 * n) AS BIGINT) THEN value END AS predicted
FROM s WHERE nxt IS NOT NULL OR pos > n - CAST(floor(0.2 * n) AS BIGINT)"""

    q["q27_timezone"] = _with(TICKS, _binned("b", R.HOUR, False)) + \
        "SELECT coin, bin, timezone('CET', timezone('UTC', bin)) AS bin_cet FROM b"
    q["q28_tail"] = _with(_hourly_features(), _targets("tg", "fe", R.TARGET, "price")) + \
        f"""SELECT datetime, target, round(lr, {_R}) AS lr, round(vol, {_R}) AS vol, round(y_future, {_R}) AS y_future
FROM tg ORDER BY datetime DESC LIMIT {R.TAIL_ROWS}"""
    q["q32_change_features"] = _with(TICKS, _aligned("al", R.HOUR), _native_base("nb", "al")) + _change_sql("nb")
    q["q33_distribution_features"] = _with(TICKS, _aligned("al", R.HOUR), _native_base("nb", "al")) + \
        _distribution_sql("nb")
    q["q34_autocorr"] = _with(TICKS, _aligned("al", R.HOUR)) + _autocorr_sql("al")
    q["q35_trend"] = _with(TICKS, _aligned("al", R.HOUR)) + _trend_sql("al")
    q["q39_locations"] = _with(TICKS, _aligned("al", R.HOUR)) + _locations_sql("al")
    q["q42_bounded_windows"] = _with(TICKS, _aligned("al", R.HOUR)) + f""", s AS (
  SELECT variable, datetime, CAST(value AS DOUBLE) AS x, CAST(value * 100 AS HUGEINT) AS u FROM al WHERE value IS NOT NULL),
w AS (
  SELECT variable, datetime, x, sum(u) OVER w AS su, sum(u * u) OVER w AS suu, max(x) OVER w AS mx,
         min(x) OVER w AS mn, count(*) OVER w AS n
  FROM s WINDOW w AS (PARTITION BY variable ORDER BY datetime ROWS BETWEEN {R.WINDOW_ROWS} PRECEDING AND CURRENT ROW))
SELECT variable, datetime, variable || '__sum_values' AS feature, CAST(su AS DOUBLE) / CAST(100.0 AS DOUBLE) AS value FROM w
UNION ALL SELECT variable, datetime, variable || '__mean', CAST(su AS DOUBLE) / (CAST(n AS DOUBLE) * CAST(100.0 AS DOUBLE)) FROM w
UNION ALL SELECT variable, datetime, variable || '__variance', CAST(n * suu - su * su AS DOUBLE)
  / (CAST(n AS DOUBLE) * CAST(n AS DOUBLE) * CAST(10000.0 AS DOUBLE)) FROM w
UNION ALL SELECT variable, datetime, variable || '__maximum', mx FROM w
UNION ALL SELECT variable, datetime, variable || '__minimum', mn FROM w
UNION ALL SELECT variable, datetime, variable || '__length', CAST(n AS DOUBLE) FROM w
UNION ALL SELECT variable, datetime, variable, x FROM w"""
    qs = [.1, .2, .3, .4, .6, .7, .8, .9]
    qcols = ",\n         ".join(f"quantile_cont(x, {q}) OVER w AS q{i}" for i, q in enumerate(qs))
    qrows = "\nUNION ALL ".join(
        [f"SELECT variable, datetime, variable || '__median' AS feature, round(med, 9) AS value FROM w"]
        + [f"SELECT variable, datetime, variable || '__quantile__q_{q}', round(q{i}, 9) FROM w"
           for i, q in enumerate(qs)])
    q["q43_running_quantiles"] = _with(TICKS, _aligned("al", R.HOUR)) + f""", s AS (
  SELECT variable, datetime, CAST(value AS DOUBLE) AS x FROM al WHERE value IS NOT NULL),
w AS (
  SELECT variable, datetime, median(x) OVER w AS med,
         {qcols}
  FROM s WINDOW w AS (PARTITION BY variable ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
{qrows}"""
    q["q48_moving_thresholds"] = _with(TICKS, _aligned("al", R.HOUR)) + _thresholds_sql("al")
    q["q49_reoccurring_values"] = _with(TICKS, _aligned("al", R.HOUR)) + _reoccurring_sql("al")
    q["q53_prefix_lookups"] = _with(TICKS, _aligned("al", R.HOUR)) + _prefix_sql("al")
    q["q50_payload_metrics"] = _with(TICKS) + """, s AS (
  SELECT coin, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts_ms,
         row_number() OVER (PARTITION BY coin, CAST(ts AS DATE) ORDER BY ts, seq) - 1 AS seq,
         prices, market_caps, total_volumes, prices - total_volumes AS spreads FROM ticks)
""" + "\nUNION ALL ".join(f"SELECT coin, ts_ms AS ts, seq, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM s"
                          for m in (*_METRICS, "spreads"))
    q["q51_impute_infinite"] = _with(TICKS, _aligned("al", R.HOUR)) + """, c AS (
  SELECT datetime, variable AS feature, hour(datetime) % 7 AS h, CAST(value AS DOUBLE) AS x FROM al),
st AS (SELECT feature, median(x) AS med, min(x) AS lo, max(x) AS hi FROM c WHERE h > 3 AND x IS NOT NULL GROUP BY feature)
SELECT datetime, feature, coalesce(CASE WHEN h = 0 THEN hi WHEN h = 1 THEN lo WHEN h IN (2, 3) OR x IS NULL THEN med ELSE x END, 0.0) AS value
FROM c LEFT JOIN st USING (feature)"""
    dec = {"q01_time_range_scan": list(_METRICS), "q05_resample_last": list(_METRICS),
           "q06_resample_dense_anchor": list(_METRICS),
           "q07_wide_left_join": [f"{m}" if r == 0 else f"{m} {c}" for r, c in enumerate(_COINS) for m in _METRICS],
           "q08_unpivot": ["value"], "q10_ffill": ["value"], "q12_drop_policy": ["value"]}
    for key, cols in dec.items():
        casts = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in cols)
        q[key] = f"SELECT * REPLACE ({casts}) FROM (\n{q[key]}\n)"
    return q


def _dbl_exact(expr: str) -> str:
    return f"CAST(CAST({expr} AS VARCHAR) AS DOUBLE)"


def _autocorr_sql(src: str) -> str:
    lags = ", ".join(f"lag(u, {k}) OVER o AS l{k}" for k in range(1, 10))
    sums = ",\n         ".join(f"sum(coalesce(u * l{k}, 0)) OVER w AS p{k}" for k in range(1, 10))
    firsts = ",\n         ".join(f"sum(CASE WHEN rn <= {k} THEN u ELSE 0 END) OVER w AS f{k}" for k in range(1, 10))
    rows = []
    n2 = "CAST(n AS HUGEINT)"
    for k in range(10):
        if k == 0:
            expr = "CASE WHEN abs(var) <= 1e-8 THEN NULL ELSE 1.0 END"
        else:
            last = " + ".join(["u"] + [f"l{j}" for j in range(1, k)])
            num = _dbl_exact(f"{n2} * {n2} * p{k} - {n2} * s1 * (2 * s1 - ({last}) - f{k}) + ({n2} - {k}) * s1 * s1")
            expr = f"CASE WHEN n <= {k} OR abs(var) <= 1e-8 THEN NULL ELSE {num} / ((CAST(n AS DOUBLE) - {k}) * a2) END"
        rows.append(f"SELECT variable, datetime, variable || '__autocorrelation__lag_{k}' AS feature, "
                    f"round(CAST({expr} AS DOUBLE), 9) AS value FROM v")
    union = "\nUNION ALL ".join(rows)
    return f""", s AS (
  SELECT variable, datetime, CAST(value * 100 AS HUGEINT) AS u,
         row_number() OVER (PARTITION BY variable ORDER BY datetime) AS rn FROM {src} WHERE value IS NOT NULL),
l AS (SELECT *, {lags} FROM s WINDOW o AS (PARTITION BY variable ORDER BY datetime)),
w AS (
  SELECT *, count(*) OVER w AS n, sum(u) OVER w AS s1, sum(u * u) OVER w AS s2,
         {sums},
         {firsts}
  FROM l WINDOW w AS (PARTITION BY variable ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
v AS (
  SELECT *, {_dbl_exact("CAST(n AS HUGEINT) * s2 - s1 * s1")} AS a2,
         {_dbl_exact("CAST(n AS HUGEINT) * s2 - s1 * s1")} / (CAST(n AS DOUBLE) * CAST(n AS DOUBLE) * CAST(10000.0 AS DOUBLE)) AS var
  FROM w)
{union}"""


def _trend_sql(src: str) -> str:
    n = "CAST(n AS DOUBLE)"
    items = {
        "slope": "CASE WHEN n > 1 THEN ssxym / ssxm END",
        "intercept": f"CASE WHEN n > 1 THEN mean - ssxym / ssxm * ({n} - 1) / 2 END",
        "rvalue": "CASE WHEN n > 1 THEN r END",
        "stderr": f"CASE WHEN n = 2 THEN 0.0 WHEN n > 2 THEN sqrt((1.0 - r * r) * ssym / ssxm / ({n} - 2)) END",
    }
    rows = "\nUNION ALL ".join(
        f"SELECT variable, datetime, variable || '__linear_trend__attr_\"{a}\"' AS feature, "
        f"round(CAST({e} AS DOUBLE), 9) AS value FROM r" for a, e in items.items())
    return f""", s AS (
  SELECT variable, datetime, CAST(value * 100 AS HUGEINT) AS u,
         row_number() OVER (PARTITION BY variable ORDER BY datetime) - 1 AS pos FROM {src} WHERE value IS NOT NULL),
w AS (
  SELECT *, count(*) OVER w AS n, sum(u) OVER w AS s1, sum(u * u) OVER w AS s2, sum(u * pos) OVER w AS sxi
  FROM s WINDOW w AS (PARTITION BY variable ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
v AS (
  SELECT *, ({n} * {n} - 1) * {n} / 12 AS ssxm,
         {_dbl_exact("CAST(n AS HUGEINT) * s2 - s1 * s1")} / ({n} * CAST(10000.0 AS DOUBLE)) AS ssym,
         {_dbl_exact("CAST(n AS HUGEINT) * sxi - (CAST(n AS HUGEINT) * (CAST(n AS HUGEINT) - 1) // 2) * s1")}
           / ({n} * CAST(100.0 AS DOUBLE)) AS ssxym,
         CAST(s1 AS DOUBLE) / ({n} * CAST(100.0 AS DOUBLE)) AS mean
  FROM w),
r AS (
  SELECT *, greatest(-1.0, least(1.0, CASE WHEN ssxm = 0 OR ssym = 0 THEN 0.0
                                      ELSE ssxym / sqrt(ssxm * ssym) END)) AS r
  FROM v)
{rows}"""


def _locations_sql(src: str) -> str:
    items = {
        "first_location_of_maximum": "fmax / n", "last_location_of_maximum": "(lmax + 1) / n",
        "first_location_of_minimum": "fmin / n", "last_location_of_minimum": "(lmin + 1) / n",
        "has_duplicate_max": "CASE WHEN fmax <> lmax THEN 1.0 ELSE 0.0 END",
        "has_duplicate_min": "CASE WHEN fmin <> lmin THEN 1.0 ELSE 0.0 END",
    }
    rows = "\nUNION ALL ".join(
        f"SELECT variable, datetime, variable || '__{a}' AS feature, round(CAST({e} AS DOUBLE), 9) AS value FROM w"
        for a, e in items.items())
    return f""", s AS (
  SELECT variable, datetime, CAST(value AS DOUBLE) AS x,
         row_number() OVER (PARTITION BY variable ORDER BY datetime) - 1 AS pos FROM {src} WHERE value IS NOT NULL),
w AS (
  SELECT variable, datetime, CAST(count(*) OVER w AS DOUBLE) AS n,
         arg_max(pos, (x, -pos)) OVER w AS fmax, arg_max(pos, (x, pos)) OVER w AS lmax,
         arg_min(pos, (x, pos)) OVER w AS fmin, arg_min(pos, (x, -pos)) OVER w AS lmin
  FROM s WINDOW w AS (PARTITION BY variable ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
{rows}"""


def _thresholds_sql(src: str) -> str:
    """Every window's rows against its own mean and deviation, by a self-join."""
    rs = [p["r"] for p in R.SHARES["ratio_beyond_r_sigma"]]
    looks = [p["r"] for p in R.SHARES["symmetry_looking"]]
    counts = ",\n         ".join(f"count(*) FILTER (WHERE b.x > a.mean + CAST({r!r} AS DOUBLE) * a.std "
                                 f"OR b.x < a.mean - CAST({r!r} AS DOUBLE) * a.std) AS k{i}" for i, r in enumerate(rs))
    items = [("count_above_mean", "above"), ("count_below_mean", "below")]
    items += [(f"ratio_beyond_r_sigma__r_{r}", f"CAST(k{i} AS DOUBLE) / n") for i, r in enumerate(rs)]
    items += [(f"symmetry_looking__r_{r}", f"CASE WHEN abs(mean - med) < CAST({r!r} AS DOUBLE) * (mx - mn) THEN 1.0 ELSE 0.0 END")
              for r in looks]
    rows = "\nUNION ALL ".join(
        f"SELECT variable, datetime, variable || '__{name}' AS feature, round(CAST({expr} AS DOUBLE), 9) AS value FROM j"
        for name, expr in items)
    return f""", s AS (
  SELECT variable, datetime, CAST(value AS DOUBLE) AS x, CAST(value * 100 AS HUGEINT) AS u,
         row_number() OVER (PARTITION BY variable ORDER BY datetime) AS pos FROM {src} WHERE value IS NOT NULL),
w AS (
  SELECT *, CAST(count(*) OVER w AS DOUBLE) AS n, sum(u) OVER w AS s1, sum(u * u) OVER w AS s2, max(x) OVER w AS mx,
         min(x) OVER w AS mn, median(x) OVER w AS med
  FROM s WINDOW w AS (PARTITION BY variable ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
m AS (
  SELECT *, CAST(s1 AS DOUBLE) / (n * CAST(100.0 AS DOUBLE)) AS mean,
         sqrt(CAST(CAST(n AS HUGEINT) * s2 - s1 * s1 AS DOUBLE) / (n * n * CAST(10000.0 AS DOUBLE))) AS std FROM w),
j AS (
  SELECT a.variable, a.datetime, a.n, a.mean, a.med, a.mx, a.mn,
         count(*) FILTER (WHERE b.x > a.mean) AS above, count(*) FILTER (WHERE b.x < a.mean) AS below,
         {counts}
  FROM m a JOIN s b ON b.variable = a.variable AND b.pos <= a.pos
  GROUP BY a.variable, a.datetime, a.n, a.mean, a.med, a.mx, a.mn)
{rows}"""


def _prefix_sql(src: str) -> str:
    """Every window cut into its segments, and its mass summed up, by a self-join."""
    qs = [p["q"] for p in R.PREFIXES["index_mass_quantile"]]
    m = 10
    items = [(f"energy_ratio_by_chunks__num_segments_{m}__segment_focus_{i}", f"CASE WHEN e > 0 THEN CAST(e{i} AS DOUBLE) / CAST(e AS DOUBLE) END")
             for i in range(m)]
    items += [(f"index_mass_quantile__q_{q}", f"CASE WHEN mass > 0 THEN CAST(m{i} AS DOUBLE) / n END") for i, q in enumerate(qs)]
    rows = "\nUNION ALL ".join(
        f"SELECT variable, datetime, variable || '__{name}' AS feature, round(CAST({expr} AS DOUBLE), 9) AS value FROM j"
        for name, expr in items)
    edge = lambda k: f"({k} * (a.pos // {m}) + least({k}, a.pos % {m}))"
    energies = ",\n         ".join(f"coalesce(sum(b.u * b.u) FILTER (WHERE b.pos > {edge(i)} AND b.pos <= {edge(i + 1)}), 0) AS e{i}"
                                   for i in range(m))
    masses = ",\n         ".join(f"min(b.pos) FILTER (WHERE 10 * b.mass >= {int(round(q * 10))} * a.mass) AS m{i}" for i, q in enumerate(qs))
    return f""", s AS (
  SELECT variable, datetime, u, pos, sum(abs(u)) OVER (PARTITION BY variable ORDER BY pos) AS mass FROM (
    SELECT variable, datetime, CAST(value * 100 AS HUGEINT) AS u, row_number() OVER (PARTITION BY variable ORDER BY datetime) AS pos
    FROM {src} WHERE value IS NOT NULL)),
j AS (
  SELECT a.variable, a.datetime, a.pos AS n, a.mass, sum(b.u * b.u) AS e,
         {energies},
         {masses}
  FROM s a JOIN s b ON b.variable = a.variable AND b.pos <= a.pos GROUP BY a.variable, a.datetime, a.pos, a.mass)
{rows}"""


def _reoccurring_sql(src: str) -> str:
    """Values of every window counted by a self-join."""
    items = [("has_duplicate", "CASE WHEN kinds < n THEN 1.0 ELSE 0.0 END"),
             ("percentage_of_reoccurring_values_to_all_values", "CAST(again AS DOUBLE) / kinds"),
             ("percentage_of_reoccurring_datapoints_to_all_datapoints", "CAST(points AS DOUBLE) / n"),
             ("sum_of_reoccurring_values", "CAST(ksum AS DOUBLE) / 100"),
             ("sum_of_reoccurring_data_points", "CAST(psum AS DOUBLE) / 100"),
             ("ratio_value_number_to_time_series_length", "CAST(kinds AS DOUBLE) / n")]
    rows = "\nUNION ALL ".join(
        f"SELECT variable, datetime, variable || '__{name}' AS feature, round(CAST({expr} AS DOUBLE), 9) AS value FROM j"
        for name, expr in items)
    return f""", s AS (
  SELECT variable, datetime, CAST(value * 100 AS HUGEINT) AS u,
         row_number() OVER (PARTITION BY variable ORDER BY datetime) AS pos FROM {src} WHERE value IS NOT NULL),
c AS (SELECT a.variable, a.datetime, b.u, count(*) AS c FROM s a JOIN s b ON b.variable = a.variable AND b.pos <= a.pos
      GROUP BY a.variable, a.datetime, b.u),
j AS (SELECT variable, datetime, sum(c) AS n, count(*) AS kinds, count(*) FILTER (WHERE c > 1) AS again,
             coalesce(sum(c) FILTER (WHERE c > 1), 0) AS points, coalesce(sum(u) FILTER (WHERE c > 1), 0) AS ksum,
             coalesce(sum(u * c) FILTER (WHERE c > 1), 0) AS psum FROM c GROUP BY variable, datetime)
{rows}"""


def _native_base(name: str, src: str) -> str:
    """Running exact sums on unscaled integers ``u`` (value x 100) per window end."""
    lags = ", ".join(f"lag(u, {k}) OVER o AS l{k}" for k in range(1, 7))
    return f"""{name}_s AS (
  SELECT variable, datetime, value, CAST(value * 100 AS HUGEINT) AS u FROM {src} WHERE value IS NOT NULL),
{name}_l AS (
  SELECT *, {lags}, lag(value) OVER o AS lagv
  FROM {name}_s WINDOW o AS (PARTITION BY variable ORDER BY datetime)),
{name} AS (
  SELECT variable, datetime, value, lagv, l1,
         CAST(count(*) OVER w AS DOUBLE) AS n,
         sum(u) OVER w AS s1, sum(u * u) OVER w AS s2, sum(u * u * u) OVER w AS s3,
         sum(u * u * u * u) OVER w AS s4,
         sum(coalesce(abs(u - l1), 0)) OVER w AS sad,
         sum(coalesce((u - l1) * (u - l1), 0)) OVER w AS sdd,
         sum(coalesce(u * l1 * l2, 0)) OVER w AS c3_1, sum(coalesce(u * l2 * l4, 0)) OVER w AS c3_2,
         sum(coalesce(u * l3 * l6, 0)) OVER w AS c3_3,
         sum(coalesce(u * u * l1 - l1 * l2 * l2, 0)) OVER w AS tra_1,
         sum(coalesce(u * u * l2 - l2 * l4 * l4, 0)) OVER w AS tra_2,
         sum(coalesce(u * u * l3 - l3 * l6 * l6, 0)) OVER w AS tra_3,
         first_value(value) OVER w AS h1, nth_value(value, 2) OVER w AS h2,
         max(value) OVER w AS mx, min(value) OVER w AS mn,
         sum(CASE WHEN value >= 0 THEN 1 ELSE 0 END) OVER w AS ca,
         sum(CASE WHEN value <= 0 THEN 1 ELSE 0 END) OVER w AS cb,
         sum(CASE WHEN value = 0 THEN 1 ELSE 0 END) OVER w AS vc0,
         sum(CASE WHEN value = 1 THEN 1 ELSE 0 END) OVER w AS vc1,
         sum(CASE WHEN value = -1 THEN 1 ELSE 0 END) OVER w AS vcm1,
         sum(CASE WHEN value >= -1 AND value < 1 THEN 1 ELSE 0 END) OVER w AS rc1,
         sum(CASE WHEN value >= -1e12 AND value < 0 THEN 1 ELSE 0 END) OVER w AS rc2,
         sum(CASE WHEN value >= 0 AND value < 1e12 THEN 1 ELSE 0 END) OVER w AS rc3,
         sum(CASE WHEN (value > 0) <> (lagv > 0) THEN 1 ELSE 0 END) OVER w AS nc0,
         sum(CASE WHEN (value > -1) <> (lagv > -1) THEN 1 ELSE 0 END) OVER w AS ncm1,
         sum(CASE WHEN (value > 1) <> (lagv > 1) THEN 1 ELSE 0 END) OVER w AS nc1
  FROM {name}_l
  WINDOW w AS (PARTITION BY variable ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{name}_v AS (
  SELECT *, CAST(CAST(n AS HUGEINT) * s2 - s1 * s1 AS DOUBLE) AS a2,
         CAST(CAST(n AS HUGEINT) * s2 - s1 * s1 AS DOUBLE) / (n * n * CAST(10000.0 AS DOUBLE)) AS var
  FROM {name})"""


def _feature_rows(name: str, items: list[tuple[str, str]]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT variable, datetime, variable || '__{suffix}' AS feature, CAST({expr} AS DOUBLE) AS value FROM {name}_v"
        for suffix, expr in items)


def _change_sql(nb: str) -> str:
    D = "CAST({} AS DOUBLE)"
    items = [
        ("abs_energy", "CAST(s2 AS DOUBLE) / CAST(10000.0 AS DOUBLE)"),
        ("absolute_sum_of_changes", "CAST(sad AS DOUBLE) / CAST(100.0 AS DOUBLE)"),
        ("mean_abs_change", "CASE WHEN n > 1 THEN (CAST(sad AS DOUBLE) / CAST(100.0 AS DOUBLE)) / (n - 1) END"),
        ("mean_change", "CASE WHEN n > 1 THEN (CAST(value AS DOUBLE) - CAST(h1 AS DOUBLE)) / (n - 1) END"),
        ("mean_second_derivative_central",
         "CASE WHEN n > 2 THEN (CAST(value AS DOUBLE) - CAST(lagv AS DOUBLE) - CAST(h2 AS DOUBLE) + CAST(h1 AS DOUBLE))"
         " / (CAST(2.0 AS DOUBLE) * (n - 2)) END"),
        ("cid_ce__normalize_True", "CASE WHEN sqrt(var) = 0 THEN 0.0 ELSE sqrt(CAST(sdd AS DOUBLE) / "
                                   "CAST(10000.0 AS DOUBLE)) / sqrt(var) END"),
        ("cid_ce__normalize_False", "sqrt(CAST(sdd AS DOUBLE) / CAST(10000.0 AS DOUBLE))"),
    ]
    for k in (1, 2, 3):
        items.append((f"c3__lag_{k}", f"CASE WHEN n <= {2 * k} THEN 0.0 ELSE "
                                      f"(CAST(c3_{k} AS DOUBLE) / CAST(1000000.0 AS DOUBLE)) / (n - {2 * k}) END"))
    for k in (1, 2, 3):
        items.append((f"time_reversal_asymmetry_statistic__lag_{k}",
                      f"CASE WHEN n <= {2 * k} THEN 0.0 ELSE "
                      f"(CAST(tra_{k} AS DOUBLE) / CAST(1000000.0 AS DOUBLE)) / (n - {2 * k}) END"))
    items += [("number_crossing_m__m_0", "nc0"), ("number_crossing_m__m_-1", "ncm1"), ("number_crossing_m__m_1", "nc1")]
    del D
    return _feature_rows(nb, items)


def _distribution_sql(nb: str) -> str:
    std = "sqrt(var)"
    mean = "(CAST(s1 AS DOUBLE) / (n * CAST(100.0 AS DOUBLE)))"
    # HUGEINT -> text -> DOUBLE rounds once (a direct cast of values above 2^64 may round twice)
    a3 = "CAST(CAST(CAST(n AS HUGEINT) * CAST(n AS HUGEINT) * s3 - 3 * CAST(n AS HUGEINT) * s1 * s2 + 2 * s1 * s1 * s1 AS VARCHAR) AS DOUBLE)"
    a4 = ("CAST(CAST(CAST(n AS HUGEINT) * CAST(n AS HUGEINT) * CAST(n AS HUGEINT) * s4"
          " - 4 * CAST(n AS HUGEINT) * CAST(n AS HUGEINT) * s1 * s3"
          " + 6 * CAST(n AS HUGEINT) * s1 * s1 * s2 - 3 * s1 * s1 * s1 * s1 AS VARCHAR) AS DOUBLE)")
    items = [
        ("skewness", f"CASE WHEN n < 3 THEN NULL WHEN a2 = 0 THEN 0.0 "
                     f"ELSE sqrt(n) * sqrt(n - 1) / (n - 2) * {a3} / (a2 * sqrt(a2)) END"),
        ("kurtosis", f"CASE WHEN n < 4 THEN NULL WHEN (n - 2) * (n - 3) * a2 * a2 = 0 THEN 0.0 "
                     f"ELSE (n + 1) * (n - 1) * {a4} / ((n - 2) * (n - 3) * a2 * a2) "
                     f"- CAST(3.0 AS DOUBLE) * (n - 1) * (n - 1) / ((n - 2) * (n - 3)) END"),
        ("variation_coefficient", f"CASE WHEN {mean} <> 0 THEN {std} / {mean} END"),
        ("variance_larger_than_standard_deviation", f"CASE WHEN var > {std} THEN 1.0 ELSE 0.0 END"),
    ]
    for r in range(1, 20):
        rv = r * 0.05
        items.append((f"large_standard_deviation__r_{rv}",
                      f"CASE WHEN {std} > CAST({rv!r} AS DOUBLE) * (CAST(mx AS DOUBLE) - CAST(mn AS DOUBLE)) "
                      f"THEN 1.0 ELSE 0.0 END"))
    items += [("count_above__t_0", "CAST(ca AS DOUBLE) / n"), ("count_below__t_0", "CAST(cb AS DOUBLE) / n"),
              ("value_count__value_0", "vc0"), ("value_count__value_1", "vc1"), ("value_count__value_-1", "vcm1"),
              ("range_count__max_1__min_-1", "rc1"), ("range_count__max_0__min_-1000000000000.0", "rc2"),
              ("range_count__max_1000000000000.0__min_0", "rc3")]
    return _feature_rows(nb, items)
