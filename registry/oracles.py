"""DuckDB twins of the registered queries, written from the definitions and not from the Spark plans."""

from __future__ import annotations

from registry.sqlparts import (
    ACCU, AD_SETS_ALL, AD_SETS_NATION, EVENTS, IMP_CLICK, INSTALLS, LABELS, USER_SETS, key_text, rollup,
)

PACKAGES = "('app.one', 'app.two', 'app.three')"
RT_SETS = tuple(s for s in AD_SETS_ALL if "category" not in s)
WINDOW_ORDER = "list_position(['7d', '14d', '30d', '1d', '3d', 'Bj1d'], window_tag)"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


AD_LONG = f"ad_long AS ({rollup('accu', AD_SETS_ALL, ['window_tag'])})"
AD_LONG_NATION = f"ad_long AS ({rollup('accu', AD_SETS_NATION, ['nation', 'window_tag'])})"
USER_LONG = f"user_long AS ({rollup('accu', USER_SETS, ['user_id', 'window_tag'])})"
USER_LONG_NATION = (
    "user_long AS (" + rollup("accu", USER_SETS, ["user_id", "window_tag"], where="window_tag = '3d' AND nation = 'EG'") + ")"
)


def counts_json(install: str = "attrInstall") -> str:
    return (
        "'{' || concat_ws(',', CASE WHEN imp > 0 THEN '\"imp\":' || imp END, CASE WHEN click > 0 THEN '\"click\":' || click END, "
        f"CASE WHEN attr_install > 0 THEN '\"{install}\":' || attr_install END) || '}}'"
    )


def cells(source: str, by: str, install: str = "attrInstall") -> str:
    slot = f"'\"countFeatures' || window_tag || '\":' || {counts_json(install)}"
    return (
        f"SELECT {by}, dim_set, dim_key, '{{' || string_agg({slot}, ',' ORDER BY {WINDOW_ORDER}) || '}}' AS cell "
        f"FROM {source} GROUP BY {by}, dim_set, dim_key"
    ).replace("SELECT , ", "SELECT ").replace("GROUP BY , ", "GROUP BY ")


def quoted(col: str) -> str:
    return f"coalesce('\"' || {col} || '\"', 'null')"


# recent events

LAST_24 = "(SELECT hour FROM (SELECT DISTINCT hour FROM ev WHERE {w}) ORDER BY hour DESC LIMIT 24)"
RECENT = f"""recent AS (
  SELECT package_name, pos_id, ad_package_name, ad_id, c_id, CASE event_name WHEN 'AD_CpiShow' THEN 'imp' ELSE 'click' END AS kind, hour
  FROM imp_click WHERE hour IN {LAST_24.format(w='true')}
  UNION ALL
  SELECT package_name, pos_id, ad_package_name, ad_id, c_id, 'attr_install', hour
  FROM installs WHERE package_name <> 'app.excluded' AND hour IN {LAST_24.format(w="event_type = 'purchase'")})"""
COUNTS = "count(*) FILTER (kind = 'imp') AS imp, count(*) FILTER (kind = 'click') AS click, count(*) FILTER (kind = 'attr_install') AS attr_install"
RECOUNT = "recount AS (" + rollup("(SELECT *, '1d' AS window_tag FROM recent)", RT_SETS, ["window_tag"], COUNTS) + ")"
BJ = """bj AS (SELECT 'Bj1d' AS window_tag, 'ad_id' AS dim_set, cast(ad_id AS varchar) AS dim_key, cast(0 AS bigint) AS imp,
  cast(0 AS bigint) AS click, count(*) AS attr_install
  FROM recent WHERE kind = 'attr_install' AND hour >= '2024013016' AND hour < '2024013116' GROUP BY ad_id)"""
EV_RECENT = (EVENTS, IMP_CLICK, INSTALLS, RECENT, RECOUNT, BJ)

MERGED = f"""accu_day AS (SELECT * REPLACE (CASE ad_package_name WHEN 'Brand#1' THEN 'Brand#1x' ELSE ad_package_name END AS ad_package_name) FROM accu),
day AS ({rollup('accu_day', ('ad_package_name', 'ad_package_category'), [], where="window_tag = '7d'").replace('SELECT , ', 'SELECT ')}),
hourly AS ({rollup('accu', ('ad_package_name', 'ad_package_category'), [], where="window_tag = '30d'").replace('SELECT , ', 'SELECT ')}),
totals AS (SELECT sum(imp) AS all_imp, sum(attr_install) AS all_install FROM day WHERE dim_set = 'ad_package_category'),
both_sides AS (
  SELECT dim_set, dim_key, coalesce(d.imp, 0) + coalesce(h.imp, 0) AS imp, coalesce(d.click, 0) + coalesce(h.click, 0) AS click,
    coalesce(d.attr_install, 0) + coalesce(h.attr_install, 0) AS attr_install,
    coalesce(d.click, 0) AS day_click, coalesce(d.attr_install, 0) AS day_install
  FROM day d FULL JOIN hourly h USING (dim_set, dim_key)),
merged AS (
  SELECT dim_set, dim_key,
    cast(CASE WHEN dim_set = 'ad_package_category' AND imp < 12000 THEN all_imp
      WHEN dim_set = 'ad_package_name' AND imp < 3000 THEN 50 ELSE imp END AS bigint) AS imp,
    cast(click AS bigint) AS click,
    cast(CASE WHEN dim_set = 'ad_package_category' AND imp < 12000 THEN all_install
      WHEN dim_set = 'ad_package_name' AND imp < 3000 THEN attr_install
      WHEN day_install = 0 THEN floor(imp / 1000.0) ELSE attr_install END AS bigint) AS attr_install,
    CASE WHEN day_click > 0 THEN round(least(cast(day_install AS double) / day_click, 0.01), 9) END AS day_cvr
  FROM both_sides, totals)"""

# profiles

ACTION = """CASE WHEN event_type = 'view' THEN 'app_use' WHEN event_type = 'signup' AND value < 5 THEN 'app_install'
      WHEN event_type = 'click' THEN 'ad_app_click' WHEN event_type = 'purchase' THEN 'ad_app_install' END"""
BASE = """base AS (
  SELECT CASE WHEN c_acctbal >= 0 THEN '' ELSE 'x' END || c_custkey AS user_id,
    coalesce(CASE WHEN c_custkey % 4 <> 0 THEN cast(20 + c_custkey % 50 AS varchar) END, '') AS age,
    coalesce(CASE WHEN c_custkey % 3 <> 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 'm' ELSE 'f' END END, '') AS gender,
    n_name AS country, r_name AS province, c_mktsegment AS city
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def app_list(action: str, restricted: bool) -> str:
    inner = " FILTER (ad_package_name IN ('pkg0', 'pkg1', 'pkg2', 'pkg3'))" if restricted else ""
    return f"""(SELECT user_id, coalesce(list_sort(list(DISTINCT ad_package_name){inner}), []) AS l
      FROM acts WHERE action_type = '{action}' GROUP BY user_id)"""


PROFILE = f"""acts AS (SELECT beyla_id AS user_id, {ACTION} AS action_type, ad_package_name FROM ev),
users AS (SELECT user_id FROM base UNION SELECT user_id FROM acts WHERE action_type IS NOT NULL),
prof AS (
  SELECT u.user_id, b.age, b.gender, b.country, b.province, b.city, b.user_id IS NOT NULL AS has_base,
    i.l AS installs, s.l AS uses, c.l AS clicks, a.l AS ad_installs
  FROM users u LEFT JOIN base b ON u.user_id = b.user_id
  LEFT JOIN {app_list('app_install', True)} i ON u.user_id = i.user_id
  LEFT JOIN {app_list('app_use', True)} s ON u.user_id = s.user_id
  LEFT JOIN {app_list('ad_app_click', False)} c ON u.user_id = c.user_id
  LEFT JOIN {app_list('ad_app_install', False)} a ON u.user_id = a.user_id)"""


def list_json(name: str, col: str) -> str:
    return (
        f"CASE WHEN {col} IS NOT NULL THEN '\"{name}\":[' || "
        f"array_to_string(list_transform({col}, lambda x: '\"' || x || '\"'), ',') || ']' END"
    )


BASE_JSON = (
    "'{\"age\":\"' || age || '\",\"gender\":\"' || gender || '\",\"country\":\"' || country || '\",\"province\":\"' "
    "|| province || '\",\"city\":\"' || city || '\"}'"
)
BEHAVIOUR_JSON = "'{' || concat_ws(',', " + ", ".join([
    list_json("installAppList", "installs"), list_json("useAppList", "uses"),
    list_json("clickAdAppList", "clicks"), list_json("installAdAppList", "ad_installs"),
]) + ") || '}'"
PROFILE_JSON = f"""prof_json AS (SELECT user_id, CASE WHEN has_base THEN {BASE_JSON} ELSE '{{}}' END AS base_json,
  {BEHAVIOUR_JSON} AS behaviour_json FROM prof)"""


# training samples

def slot_name(name: str) -> str:
    head, *tail = name.replace("#", "_").split("_")
    return head + "".join(t.capitalize() for t in tail)


def sample_sql(parts: tuple[str, ...], ad_sets, install: str, nation: bool, where: str, profile: str) -> str:
    """One join per counter table: the keys of a label are unnested, its cells gathered again by conditional aggregates."""

    def found(name: str, table: str, sets, owner: str) -> str:
        names = "[" + ", ".join(f"'{x}'" for x in sets) + "]"
        keys = "[" + ", ".join(key_text(x, "lab.") for x in sets) + "]"
        own = f", {owner}" if owner else ""
        columns = ", ".join(f"max(cell) FILTER (dim_set = '{x}') AS {name}{i}" for i, x in enumerate(sets))
        using = f"({f'{owner}, ' if owner else ''}dim_set, dim_key)"
        return (f"{name}_found AS (SELECT rid, {columns} FROM (SELECT rid{own}, unnest({names}) AS dim_set, unnest({keys}) AS dim_key FROM lab) "
                f"JOIN {table} USING {using} GROUP BY rid)")

    ad_json = [f"'\"{slot_name(x)}\":' || coalesce(a{i}, '{{}}')" for i, x in enumerate(ad_sets)]
    user_json = [f"'\"{slot_name(x)}\":' || coalesce(u{i}, '{{}}')" for i, x in enumerate(USER_SETS)]
    nation_json = "',\"nation\":' || " + quoted("lab.nation") + " || " if nation else ""
    context = (
        f"'{{\"posId\":' || {quoted('lab.pos_id')} || ',\"appName\":' || {quoted('lab.package_name')} || {nation_json}"
        f"',\"osVersion\":' || {quoted('os_version')} || ',\"brand\":' || {quoted('brand')} || ',\"model\":' || {quoted('model')} || "
        f"',\"language\":' || {quoted('system_language')} || ',\"appVersionCode\":' || {quoted('app_version_code')} || "
        f"',\"clientIp\":' || {quoted('client_ip')} || ',\"reqTime\":' || server_time || '}}'"
    )
    info = (
        f"'{{\"adId\":' || lab.ad_id || ',\"appId\":' || {quoted('lab.ad_package_name')} || ',\"category\":' || "
        f"{quoted('lab.ad_package_category')} || ',\"isAutoDownload\":' || is_auto_download || ',\"creativeId\":\"' || "
        "coalesce(cast(lab.c_id AS varchar), 'None') || '\"}'"
    )
    return with_(
        *parts,
        f"ad_cells AS MATERIALIZED ({cells('ad_long', 'nation' if nation else '', install)})",
        f"user_cells AS MATERIALIZED ({cells('user_long', 'user_id', install)})",
        found("a", "ad_cells", ad_sets, "nation" if nation else ""), found("u", "user_cells", USER_SETS, "user_id"),
    ) + f"""SELECT rid, '{{"label":{{"click":' || is_click || ',"{install}":' || is_attr_install || '}},"feature":{{"userProfile":{{"userId":'
  || {quoted('lab.user_id')} || ',"userBase":' || coalesce(p.base_json, '{{}}') || ',"userBehavior":' || coalesce(p.behaviour_json, '{{}}')
  || ',"userCounter":{{' || {user_json[0]} || '}}}},"userAdFeature":{{"userAdCount":{{' || {" || ',' || ".join(user_json[1:])}
  || '}}}},"context":' || {context} || ',"adData":{{"adInfo":' || {info} || ',"adCounter":{{' || {" || ',' || ".join(ad_json)} || '}}}}}}}}' AS sample
FROM lab LEFT JOIN {profile} p ON lab.user_id = p.user_id LEFT JOIN a_found USING (rid) LEFT JOIN u_found USING (rid)
WHERE {where}"""


LOGGED = """logged AS (SELECT ad_id, coalesce(c_id, -1) AS creative_id, CASE WHEN bid_price >= 11 THEN '' ELSE 'x' END || rid AS request_id,
  '{"ip":"' || client_ip || '","auto":' || is_auto_download || '}' AS feature
  FROM lab)"""

# feature analysis

FEATURES = {
    "ctx_pos": "pos_id", "ctx_ad_pkg": "ad_package_name", "up_uid": "user_id", "ad_ai_cid": "c_id", "ad_ai_aid": "ad_id",
    "ctx_ne3": "k % 2", "ctx_ip": "k", "up_uc/7d": "k % 8", "ad_ac": "CASE WHEN k % 6 <> 5 THEN k % 6 END", "const": "1",
}
FEATURE_ROWS = "feature_rows AS (" + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS fea_k, cast({e} AS varchar) AS fea_v, cast(k % 3 = 0 AS integer) AS click, cast(k % 9 = 0 AS integer) AS install "
    f"FROM ev WHERE event_type = 'view'" for n, e in FEATURES.items()
) + "),\nfeature_counts AS (SELECT fea_k, fea_v, click, install, count(*) AS imp FROM feature_rows WHERE fea_v IS NOT NULL GROUP BY ALL)"


def mi_sql(label: str, where: str = "true") -> str:
    return with_(EVENTS, FEATURE_ROWS) + f""", vy AS (SELECT fea_k, fea_v, {label} AS y, sum(imp) AS n FROM feature_counts WHERE {where} GROUP BY ALL),
tot AS (SELECT fea_k, sum(n) AS n, count(DISTINCT fea_v) AS n_values FROM vy GROUP BY fea_k),
py AS (SELECT fea_k, y, sum(n) AS n FROM vy GROUP BY ALL), pv AS (SELECT fea_k, fea_v, sum(n) AS n FROM vy GROUP BY ALL),
mi AS (SELECT fea_k, sum(vy.n / tot.n * log2((vy.n / tot.n) / ((py.n / tot.n) * (pv.n / tot.n)))) AS mi
  FROM vy JOIN tot USING (fea_k) JOIN py USING (fea_k, y) JOIN pv USING (fea_k, fea_v) GROUP BY fea_k),
classes AS (SELECT fea_k, count(*) AS c FROM py GROUP BY fea_k)
SELECT fea_k AS feature, n_values, CASE WHEN c = 2 THEN round(mi, 9) END AS mi FROM tot JOIN mi USING (fea_k) JOIN classes USING (fea_k)"""


def chi_sql(yates: bool) -> str:
    shift = "CASE WHEN k.n_values = 2 THEN least(abs(o - e), 0.5) ELSE 0 END" if yates else "0"
    return with_(EVENTS, FEATURE_ROWS) + f""", vals AS (SELECT DISTINCT fea_k, fea_v FROM feature_counts),
ys AS (SELECT unnest([0, 1]) AS y),
o AS (SELECT v.fea_k, v.fea_v, ys.y, coalesce(sum(f.imp), 0) AS o FROM vals v CROSS JOIN ys
  LEFT JOIN feature_counts f ON f.fea_k = v.fea_k AND f.fea_v = v.fea_v AND f.click = ys.y GROUP BY ALL),
k AS (SELECT fea_k, count(*) AS n_values FROM vals GROUP BY fea_k),
m AS (SELECT *, sum(o) OVER (PARTITION BY fea_k) AS n, sum(o) OVER (PARTITION BY fea_k, y) AS ny, sum(o) OVER (PARTITION BY fea_k, fea_v) AS nv FROM o),
x AS (SELECT *, cast(ny AS double) * nv / nullif(n, 0) AS e FROM m)
SELECT fea_k AS feature, k.n_values, CASE WHEN min(ny) = 0 OR k.n_values = 1 THEN -1.0
    ELSE round(sum((abs(o - e) - {shift}) * (abs(o - e) - {shift}) / nullif(e, 0)), 6) END AS stat,
  CASE WHEN min(ny) > 0 AND k.n_values > 1 THEN k.n_values - 1 END AS dof
FROM x JOIN k USING (fea_k) GROUP BY fea_k, k.n_values"""


def lower_tail(x: str, dof: str) -> str:
    """P(X <= x) of a chi-square variable as a sum of positive terms."""
    h, a = f"({x}) / 2.0", f"({dof}) / 2.0"
    return (
        f"coalesce(list_sum(list_transform(range(0, cast({h} + 12 * sqrt({h}) + 300 AS bigint)), "
        f"lambda n: exp(({a} + n) * ln({h}) - {h} - lgamma({a} + n + 1)))), 0)"
    )


# critical values by halving an interval that holds them
CHI_TEST = "WITH RECURSIVE stats AS (" + chi_sql(True).replace("round(sum", "(sum").replace(", 6) END AS stat", ") END AS stat") + f"""),
halving AS (
  SELECT feature, dof, 1e-9::double AS lo, dof + 10 * sqrt(2.0 * dof) + 50 AS hi, 0 AS step FROM stats WHERE dof IS NOT NULL
  UNION ALL
  SELECT feature, dof, CASE WHEN below THEN mid ELSE lo END, CASE WHEN below THEN hi ELSE mid END, step + 1
  FROM (SELECT *, (lo + hi) / 2 AS mid, {lower_tail('(lo + hi) / 2', 'dof')} < 0.8 AS below FROM halving WHERE step < 60)),
critical AS (SELECT feature, (lo + hi) / 2 AS critical FROM halving WHERE step = 60)
SELECT feature, n_values, round(stat, 6) AS stat, round(critical, 6) AS critical,
  CASE WHEN dof IS NOT NULL THEN abs(round(1 - {lower_tail('greatest(stat, 1e-12)', 'dof')}, 8)) END AS p_value
FROM stats LEFT JOIN critical USING (feature)"""


def index_sql(rules: str, where: str = "true") -> str:
    return with_(EVENTS, FEATURE_ROWS) + f"""SELECT fea_k AS name, 0 AS f1, cast({rules} AS bigint) AS size, 'int' AS type, 0 AS f2, 0 AS f3, 0 AS f4
FROM (SELECT fea_k, count(DISTINCT fea_v) AS n FROM feature_counts GROUP BY fea_k) WHERE n > 1 AND {where}"""


# calibration and ranking

RATES = """rates AS (
  SELECT cast(l_orderkey AS varchar) AS beyla_id, cast(l_partkey AS varchar) AS ad_id, cast(l_suppkey AS varchar) AS c_id,
    l_discount + l_tax / 100 AS pctr, l_tax AS pcvr, l_extendedprice / 1000 AS bid_price, l_linenumber,
    cast(l_returnflag = 'A' AS integer) AS is_click, cast(l_returnflag = 'A' AND l_linestatus = 'F' AS integer) AS is_attr_install,
    l_extendedprice - 50000 AS margin
  FROM lineitem)"""
BUCKETS = "buckets AS (SELECT cast(floor(pctr * 10000) AS bigint) AS bucket, count(*) AS n, cast(sum(is_click) AS bigint) AS clicks FROM rates GROUP BY 1)"
# pushes the next bucket, or pools the last two blocks while the last rate is the lower one
MODEL = """ordered AS (SELECT *, row_number() OVER (ORDER BY bucket) AS i FROM buckets),
pav AS (
  SELECT cast(0 AS bigint) AS i, cast([] AS bigint[]) AS ks, cast([] AS bigint[]) AS ns, cast([] AS bigint[]) AS cs, 0 AS step
  UNION ALL
  SELECT CASE WHEN p.bad THEN p.i ELSE p.i + 1 END,
    CASE WHEN p.bad THEN p.ks[:-2] ELSE list_append(p.ks, o.bucket) END,
    CASE WHEN p.bad THEN list_append(p.ns[:-3], p.ns[-1] + p.ns[-2]) ELSE list_append(p.ns, o.n) END,
    CASE WHEN p.bad THEN list_append(p.cs[:-3], p.cs[-1] + p.cs[-2]) ELSE list_append(p.cs, o.clicks) END, p.step + 1
  FROM (SELECT *, len(ks) > 1 AND cs[-1] / ns[-1] < cs[-2] / ns[-2] AS bad FROM pav) p LEFT JOIN ordered o ON o.i = p.i + 1
  WHERE p.bad OR o.i IS NOT NULL),
final AS (SELECT * FROM pav ORDER BY step DESC LIMIT 1),
model AS (SELECT unnest(ks) AS bucket, unnest(ns) AS n, unnest(cs) AS clicks FROM final),
rated AS (SELECT bucket, n, clicks, bucket / 10000.0::double AS prate, clicks / n AS rate FROM model)"""
REC = "WITH RECURSIVE " + ",\n".join((RATES, BUCKETS, MODEL)) + "\n"


def calibrated(op: str) -> str:
    return f""", first_row AS (SELECT rate FROM rated ORDER BY prate LIMIT 1),
cal AS (SELECT r.*, coalesce(m.rate, (SELECT rate FROM first_row)) AS calibrated FROM rates r ASOF LEFT JOIN rated m ON r.pctr {op} m.prate)
"""


CAL_ROWS = "SELECT beyla_id, ad_id, c_id, round(pctr, 9) AS pctr, round(calibrated, 9) AS calibrated FROM cal"


def auc_sql(score: str, label: str) -> str:
    return with_(RATES) + f""", s AS (SELECT {score} AS score, cast(sum({label}) AS double) AS p, cast(sum(1 - {label}) AS double) AS q FROM rates GROUP BY 1),
w AS (SELECT *, coalesce(sum(q) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
SELECT round(sum(p * (below + q / 2)) / nullif(sum(p) * sum(q), 0), 9) AS auc FROM w"""


BID_AUC = with_(RATES) + """, e AS (SELECT (pctr * pcvr) * bid_price * 1000 AS ecpm, bid_price AS bid, is_attr_install > 0 AS pos FROM rates WHERE l_linenumber <> 7),
s AS (SELECT ecpm, count(*) FILTER (pos) AS p, count(*) FILTER (NOT pos) AS q, coalesce(sum(bid) FILTER (pos), 0) AS pb, coalesce(sum(bid) FILTER (NOT pos), 0) AS qb FROM e GROUP BY 1),
w AS (SELECT *, coalesce(sum(p) OVER o, 0) AS p_below, coalesce(sum(q) OVER o, 0) AS q_below FROM s
  WINDOW o AS (ORDER BY ecpm ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT sum(pb * (q_below + q / 2)) AS good, sum(qb * (p_below + p / 2)) AS bad FROM w)
SELECT round(good / (good + bad), 9) AS auc FROM t"""

MIXER = """SELECT cast(l_orderkey AS varchar) AS request_id, CASE WHEN l_linenumber > 1 THEN 'e' || l_linenumber || ',x' ELSE '' END AS exp_ids,
  cast(l_partkey AS varchar) AS user_id, l_linestatus AS pos_id, cast(floor(epoch(l_shipdate)) AS bigint) AS timestamp,
  l_returnflag AS app_id, cast(l_partkey % 50 + i AS varchar) AS camp_id, cast(l_suppkey AS varchar) AS creative_id,
  l_extendedprice + i AS ecpm, 'spec' || l_linenumber AS pctcvr
FROM lineitem, (SELECT unnest([0, 1]) AS i) WHERE l_linenumber < 7 AND (i = 0 OR l_linenumber % 2 = 0)"""


def ads_json(with_feature: bool) -> str:
    feature = " || ',\"feature\":{\"k\":' || k || ',\"p\":\"' || pos_id || '\"}'" if with_feature else ""
    return f"""SELECT '{{"camp_id":' || (ad_id + i) || ',"creative_id":"' || c_id || '","request_id":"' || requestid || '","note":' ||
  CASE WHEN k % 2 = 0 THEN '"n"' ELSE 'null' END || ',"tags":["a","' || pos_id || '"]'{feature} || '}}' AS value
FROM ev, (SELECT unnest([0, 1]) AS i) WHERE k % 7 <> 0"""


STREAM = """items AS (
  SELECT *, ad_package_name AS pkg, ad_id AS camp FROM ev
  UNION ALL SELECT *, CASE WHEN k % 6 <> 0 THEN ad_package_name END, ad_id + 1 FROM ev WHERE k % 2 = 0)
SELECT event_name, beyla_id, package_name, CASE WHEN k % 4 <> 0 THEN pos_id ELSE '' END AS pos_id, pkg AS ad_package_name,
  cast(camp AS varchar) AS ad_id, cast(c_id AS varchar) AS c_id
FROM items WHERE value >= 1 AND k % 11 <> 0 AND event_type IN ('view', 'click') AND package_name IN ('app.one', 'app.two')
  AND k % 9 <> 0 AND pkg IS NOT NULL AND camp <> 0 AND c_id <> 0"""

AD_INFO = """SELECT p_brand AS info_key, max(p_type) AS category, cast(NULL AS bigint) AS creative_create_time,
  cast(NULL AS bigint) AS day_attr_install_cap FROM part GROUP BY p_brand
UNION ALL SELECT 'c_id#' || s_suppkey, NULL, cast(epoch(TIMESTAMP '2024-01-30' - to_days(cast(s_suppkey AS integer))) AS bigint), NULL
FROM supplier WHERE s_suppkey < 3
UNION ALL SELECT 'ad_id#' || p_partkey, NULL, NULL, cast(p_size - 10 AS bigint) FROM part WHERE p_size > 10"""

SNAPSHOT_ROWS = "SELECT dim_set, dim_key, window_tag, imp, click, attr_install FROM ad_long"
ENTRY_EXPIRY = 1_706_659_200 + 259_200

ORACLES = {
    "ad_counter_rollup": with_(ACCU, AD_LONG) + "SELECT * FROM ad_long",
    "ad_counter_rollup_nation": with_(ACCU, AD_LONG_NATION) + "SELECT * FROM ad_long",
    "user_counter_rollup": with_(ACCU, USER_LONG) + "SELECT * FROM user_long",
    "user_counter_rollup_nation": with_(ACCU, USER_LONG_NATION) + "SELECT * FROM user_long",
    "ad_counter_documents": with_(ACCU, AD_LONG) + f"SELECT dim_set || '#' || dim_key AS counter_key, cell AS value FROM ({cells('ad_long', '')})",
    "ad_counter_documents_nation": with_(ACCU, AD_LONG_NATION)
    + f"SELECT nation || '#' || dim_set || '#' || dim_key AS counter_key, cell AS value FROM ({cells('ad_long', 'nation', 'install')})",
    "counter_documents_read": with_(ACCU, AD_LONG) + SNAPSHOT_ROWS,
    "global_totals": with_(ACCU) + """SELECT cast(sum(imp) AS bigint) AS all_imp, cast(sum(attr_install) AS bigint) AS all_install
FROM accu WHERE window_tag = '7d'""",
    "project_imp_click": with_(EVENTS, IMP_CLICK) + """SELECT requestid, beyla_id, country, pos_id, package_name, event_name, ad_package_name,
  cast(ad_id AS varchar) AS ad_id, cast(c_id AS varchar) AS c_id FROM imp_click""",
    "project_install": with_(EVENTS, INSTALLS) + f"""SELECT requestid, beyla_id, country, pos_id, package_name, ad_package_name,
  cast(ad_id AS varchar) AS ad_id, cast(c_id AS varchar) AS c_id FROM installs WHERE package_name IN {PACKAGES}""",
    "imp_click_tsv": with_(EVENTS, IMP_CLICK) + """SELECT concat_ws(chr(9), requestid, beyla_id, country, pos_id, package_name, event_name,
  ad_package_name, ad_id, c_id) AS value FROM imp_click""",
    "last_24_partitions": with_(EVENTS) + f"SELECT event_id, hour FROM ev WHERE hour IN {LAST_24.format(w='true')}",
    "latest_snapshot": """SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y%m%d') AS dt FROM orders
WHERE strftime(o_orderdate, '%Y%m%d') = (SELECT max(strftime(o_orderdate, '%Y%m%d')) FROM orders)""",
    "source_hours": """SELECT event_id, strftime(ts, '%Y%m%d%H') AS out_hour, strftime(ts + INTERVAL 8 HOURS, '%Y%m%d%H') AS log_hour FROM events""",
    "hourly_recount": with_(*EV_RECENT) + "SELECT * FROM recount",
    "bj_day_install": with_(*EV_RECENT) + "SELECT * FROM bj",
    "counter_refresh": with_(ACCU, AD_LONG, *EV_RECENT) + """, fresh AS (
  SELECT dim_set, dim_key, w AS window_tag, imp, click, attr_install FROM recount, (SELECT unnest(['1d', '3d', '7d']) AS w)
  UNION ALL SELECT dim_set, dim_key, window_tag, imp, click, attr_install FROM bj)
SELECT dim_set, dim_key, window_tag,
  CASE WHEN f.imp IS NULL THEN s.imp WHEN s.imp IS NULL OR window_tag IN ('1d', 'Bj1d') THEN f.imp ELSE s.imp + f.imp END AS imp,
  CASE WHEN f.imp IS NULL THEN s.click WHEN s.imp IS NULL OR window_tag IN ('1d', 'Bj1d') THEN f.click ELSE s.click + f.click END AS click,
  CASE WHEN f.imp IS NULL THEN s.attr_install WHEN s.imp IS NULL OR window_tag IN ('1d', 'Bj1d') THEN f.attr_install
    ELSE s.attr_install + f.attr_install END AS attr_install
FROM ad_long s FULL JOIN fresh f USING (dim_set, dim_key, window_tag)""",
    "counter_merge_smooth": with_(ACCU, MERGED) + "SELECT * FROM merged",
    "merged_views": with_(ACCU, MERGED) + f"""SELECT dim_set || '#' || dim_key AS counter_key,
  '{{"countFeatures30d":' || {counts_json()} || '}}' AS nested, {counts_json()} AS flat FROM merged""",
    "wilson_scores": with_(ACCU, AD_LONG) + """SELECT dim_set, dim_key, window_tag,
  round((p + 4 / (2 * n) - 2 * sqrt((p * (1 - p) + 4 / (4 * n)) / n)) / (1 + 4 / n), 9) AS score
FROM (SELECT *, cast(imp AS double) AS n, attr_install / nullif(cast(imp AS double), 0) AS p FROM ad_long)""",
    "flatten_mixer_log": MIXER,
    "flatten_rec_log": with_(EVENTS) + ads_json(False),
    "flatten_req_ads": with_(EVENTS) + ads_json(True),
    "flatten_train_feature": with_(EVENTS) + """SELECT ad_id + i AS ad_id, c_id AS creative_id, requestid AS request_id,
  '{"k":' || k || ',"p":"' || pos_id || '"}' AS feature FROM ev, (SELECT unnest([0, 1]) AS i) WHERE k % 7 <> 0""",
    "user_profile": with_(EVENTS, BASE, PROFILE) + """SELECT user_id, age, gender, country, province, city,
  array_to_string(installs, ',') AS install_apps, array_to_string(uses, ',') AS use_apps, array_to_string(clicks, ',') AS click_apps,
  array_to_string(ad_installs, ',') AS install_ad_apps FROM prof""",
    "user_profile_base": with_(BASE) + "SELECT * FROM base",
    "ascii_guard": """SELECT conv_id, turn, CASE WHEN strlen(text) = length(text) THEN text ELSE '' END AS kept,
  CASE WHEN unicode(text) < 128 THEN substr(text, 1, 1) ELSE '' END AS head FROM conversations""",
    "package_category": "SELECT p_brand AS package_name, max(p_type) AS category FROM part GROUP BY p_brand",
    "adinfo_overlay": AD_INFO,
    "adinfo_documents": f"""SELECT info_key, CASE WHEN category IS NOT NULL THEN '{{"category":"' || category || '"}}'
  WHEN creative_create_time IS NOT NULL THEN '{{"creativeCreateTime":' || creative_create_time || '}}'
  ELSE '{{"dayAttrInstallCap":' || day_attr_install_cap || '}}' END AS value FROM ({AD_INFO})""",
    "train_sample_lookup": sample_sql(
        (ACCU, AD_LONG, USER_LONG, EVENTS, LABELS, BASE, PROFILE, PROFILE_JSON), AD_SETS_ALL, "attrInstall", False,
        f"lab.package_name IN {PACKAGES}", "prof_json",
    ),
    "train_sample_nation": sample_sql(
        (ACCU, AD_LONG_NATION, USER_LONG_NATION, EVENTS, LABELS, BASE,
         f"base_json AS (SELECT user_id, {BASE_JSON} AS base_json, '{{}}' AS behaviour_json FROM base)"),
        AD_SETS_NATION, "install", True, "lab.nation = 'EG'", "base_json",
    ),
    "train_sample_logged": with_(EVENTS, LABELS, LOGGED) + f"""SELECT rid, '{{"label":{{"click":' || is_click || ',"attrInstall":' || is_attr_install
  || '}},"feature":' || feature || '}}' AS sample
FROM lab JOIN logged ON rid = request_id AND lab.ad_id = logged.ad_id AND lab.c_id = creative_id WHERE package_name IN {PACKAGES}""",
    "scored_labels": with_(EVENTS, LABELS) + """SELECT user_id AS beyla_id, ad_package_name, cast(ad_id AS varchar) AS ad_id, cast(c_id AS varchar) AS c_id,
  is_auto_download / 4 AS pctr, ad_id / 64 AS pcvr, bid_price, is_click, is_attr_install
FROM lab WHERE package_name = 'app.two' AND bid_price >= 5 AND c_id IS NOT NULL""",
    "feature_label_counts": with_(EVENTS, FEATURE_ROWS) + "SELECT * FROM feature_counts",
    "mi_ctr": mi_sql("click"),
    "mi_cvr": mi_sql("install", "click > 0"),
    "chi_square_stat": chi_sql(True),
    "chi_square_uncorrected": chi_sql(False),
    "chi_square_test": CHI_TEST,
    "index_allocation": index_sql("""CASE fea_k WHEN 'up_uid' THEN 200000 WHEN 'ctx_ip' THEN 100000 WHEN 'up_uc/7d' THEN 10000 WHEN 'ad_ac' THEN 5000
  WHEN 'ad_ai_cid' THEN 10000 WHEN 'ad_ai_aid' THEN 3000 WHEN 'ctx_ad_pkg' THEN 3 * n ELSE 10 * n END""", "fea_k <> 'ctx_ne3'"),
    "feature_index_lines": "SELECT concat_ws(chr(9), name, f1, size, type, f2, f3, f4) AS value FROM (" + index_sql("""CASE fea_k WHEN 'up_uid' THEN 200000 WHEN 'ctx_ip' THEN 100000 WHEN 'up_uc/7d' THEN 10000 WHEN 'ad_ac' THEN 5000
  WHEN 'ad_ai_cid' THEN 10000 WHEN 'ad_ai_aid' THEN 3000 WHEN 'ctx_ad_pkg' THEN 3 * n ELSE 10 * n END""", "fea_k <> 'ctx_ne3'") + ")",
    "index_allocation_compact": index_sql("""CASE fea_k WHEN 'ctx_ip' THEN 100000 WHEN 'up_uc/7d' THEN 10000 WHEN 'ad_ac' THEN 10000
  WHEN 'ad_ai_cid' THEN 10000 ELSE 10 * n END"""),
    "encoded_examples": with_(EVENTS, LABELS) + "SELECT base64(encode(concat_ws('|', rid, client_ip, cast(c_id AS varchar)))) AS value FROM lab",
    "ctr_buckets": with_(RATES, BUCKETS) + "SELECT * FROM buckets",
    "isotonic_model": REC + "SELECT bucket, n, clicks, prate, round(rate, 9) AS rate FROM rated",
    "calibrated_scores": REC + calibrated(">") + CAL_ROWS,
    "calibrated_scores_inclusive": REC + calibrated(">=") + CAL_ROWS,
    "calibration_bias": REC + calibrated(">") + """SELECT round(avg(calibrated * pcvr), 9) AS mean_score, round(avg(is_attr_install), 9) AS mean_label FROM cal""",
    "auc": auc_sql("pctr", "is_click"),
    "auc_signed": auc_sql("margin", "is_attr_install"),
    "bid_weighted_auc": BID_AUC,
    "stream_events": with_(EVENTS, STREAM),
    "stream_events_live": with_(EVENTS, STREAM),
    "stream_flush_live": with_(EVENTS, STREAM).replace("SELECT event_name,", "SELECT concat_ws(chr(9), event_name, beyla_id, package_name, pos_id, ad_package_name, ad_id, c_id) AS value FROM (SELECT event_name,") + ")",
    "rolling_24h_live": with_(EVENTS) + """, passed AS (SELECT max(ts) - INTERVAL 6 HOURS AS mark FROM ev WHERE k % 17 <> 0),
kept AS (SELECT ts, ad_id FROM ev, passed WHERE k % 17 <> 0 OR date_trunc('hour', ts) + INTERVAL 1 HOUR > mark),
spread AS (SELECT unnest(generate_series(1, 24)) AS h)
SELECT strftime(date_trunc('hour', ts) + to_hours(h), '%Y%m%d%H') AS end_hour, ad_id, count(*) AS n FROM kept, spread GROUP BY 1, 2""",
    "calibration_model_file": REC + "SELECT row_number() OVER (ORDER BY prate) - 1 AS position, bucket, n, clicks, round(rate, 9) AS rate FROM rated",
    "recount_from_files": with_(
        EVENTS, *[x.replace(" pos_id,", " CASE pos_id WHEN 'p3' THEN '' ELSE pos_id END AS pos_id,") for x in (IMP_CLICK, INSTALLS)],
        RECENT.replace(LAST_24.format(w="true"), LAST_24.format(w="true").replace("FROM ev", "FROM imp_click"))
        .replace(LAST_24.format(w="event_type = 'purchase'"), LAST_24.format(w="true").replace("FROM ev", "FROM installs")), RECOUNT,
    ) + "SELECT * FROM recount",
    "catalogue_hours": with_(EVENTS) + "SELECT event_id, event_type, k, hour FROM ev",
    "hour_lines_read": with_(EVENTS) + "SELECT event_id, pos_id, k FROM ev WHERE hour LIKE '202401%'",
    "log_hour_read": with_(EVENTS) + "SELECT event_id, k FROM ev WHERE hour = (SELECT max(hour) FROM ev)",
    "feature_counts_sparse": with_(EVENTS) + """SELECT f.fea_k, f.fea_v, cast(k % 3 = 0 AS integer) AS click, cast(k % 9 = 0 AS integer) AS install, count(*) AS imp
FROM (SELECT k, unnest([{'fea_k': 'rare', 'fea_v': CASE WHEN k % 10 = 0 THEN cast(k AS varchar) END}, {'fea_k': 'pos', 'fea_v': CASE WHEN k % 20 = 0 THEN pos_id END}]) AS f
  FROM ev WHERE event_type = 'view') WHERE f.fea_v IS NOT NULL GROUP BY ALL""",
    "allow_list_read": with_(EVENTS) + "SELECT DISTINCT ad_package_name AS app FROM ev",
    "entity_store_lookup": with_(ACCU, USER_LONG) + """SELECT user_id, dim_set, dim_key, window_tag, imp, click, attr_install FROM user_long
WHERE user_id IN (SELECT cast(user_id * 5 AS varchar) FROM events)""",
    "paired_days": with_(EVENTS) + """, days AS (SELECT user_id, date_trunc('day', ts) AS day, count(*) AS n, max(event_id) AS last FROM ev GROUP BY ALL)
SELECT strftime(ev.ts - INTERVAL 1 DAY, '%Y%m%d') AS feature_dt, ev.user_id, ev.event_id, strftime(ev.ts, '%Y%m%d') AS dt, n, last
FROM ev LEFT JOIN days d ON d.user_id = ev.user_id AND d.day = date_trunc('day', ev.ts) - INTERVAL 1 DAY""",
    "published_counters": with_(ACCU, AD_LONG) + "SELECT * FROM ad_long",
    "rolling_24h": with_(EVENTS) + """, spread AS (SELECT unnest(generate_series(1, 24)) AS h)
SELECT strftime(date_trunc('hour', ts) + to_hours(h), '%Y%m%d%H') AS end_hour, ad_id, count(*) AS n FROM ev, spread GROUP BY 1, 2""",
    "kv_export": with_(ACCU, USER_LONG) + f"""SELECT 'nt:ads:user_counter:' || user_id AS entity_key, 0 AS part,
  '{{"storeUserCounter":{{' || string_agg('"' || dim_set || '#' || dim_key || '":' || cell, ',' ORDER BY dim_set || '#' || dim_key) || '}}}}' AS value,
  cast({ENTRY_EXPIRY} AS bigint) AS expire_at
FROM ({cells('user_long', 'user_id')}) GROUP BY user_id""",
    "kv_profile_export": with_(EVENTS, BASE, PROFILE, PROFILE_JSON) + f"""SELECT 'nt:ads:user_profile:' || user_id AS entity_key, 0 AS part,
  '{{"userBase":' || base_json || ',"userBehavior":' || behaviour_json || '}}' AS value, cast({ENTRY_EXPIRY} AS bigint) AS expire_at FROM prof_json""",
    "kv_lookup": with_(EVENTS, BASE, PROFILE, PROFILE_JSON) + """SELECT e.event_id, 'nt:ads:user_profile:' || (e.user_id * 5) AS entity_key,
  '{"userBase":' || base_json || ',"userBehavior":' || behaviour_json || '}' AS value
FROM events e LEFT JOIN prof_json p ON p.user_id = cast(e.user_id * 5 AS varchar)""",
    "validate_export": with_(ACCU, AD_LONG) + """SELECT * FROM (SELECT dim_set, dim_key, CASE window_tag WHEN '14d' THEN '45d' ELSE window_tag END AS window_tag,
  imp * 100000 AS imp, click - 20 AS click, attr_install,
  CASE WHEN window_tag = '14d' THEN 'window_tag' WHEN imp * 100000 > 2147483647 THEN 'imp' WHEN click < 20 THEN 'click' END AS reason FROM ad_long)
WHERE reason IS NOT NULL""",
    "artefact_manifest": with_(ACCU, AD_LONG) + f""", lines AS (
  SELECT split_part(dim_set, '#', 1) AS part, dim_set || '#' || dim_key || chr(9) || cell AS value FROM ({cells('ad_long', '')}))
SELECT part, n_rows, md5(n_rows || '|' || s) AS checksum
FROM (SELECT part, count(*) AS n_rows, sum(cast('0x' || substr(md5(value), 1, 15) AS bigint)) AS s FROM lines GROUP BY part)""",
}
