"""SQL for the fixtures, shared by the twins in ``oracles.py`` (DuckDB dialect)."""

from __future__ import annotations

ACCU = """accu AS (
  SELECT cast(o_custkey AS varchar) AS user_id,
    CASE l_linenumber WHEN 1 THEN '1d' WHEN 2 THEN '3d' WHEN 3 THEN '7d' WHEN 4 THEN '14d' WHEN 5 THEN '30d' ELSE '7d' END AS window_tag,
    CASE l_suppkey % 3 WHEN 0 THEN 'EG' WHEN 1 THEN 'ID' ELSE 'IN' END AS nation,
    CASE l_returnflag WHEN 'A' THEN 'app.one' WHEN 'N' THEN 'app.two' ELSE 'app.three' END AS package_name,
    l_linestatus AS pos_id, l_partkey % 50 AS ad_id, p_brand AS ad_package_name, p_type AS ad_package_category,
    CASE WHEN l_suppkey % 13 <> 0 THEN l_suppkey END AS c_id,
    cast(floor(l_quantity) AS bigint) AS imp, cast(floor(l_quantity * l_discount) AS bigint) AS click,
    cast(floor(l_quantity * l_tax) AS bigint) AS attr_install
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey)"""

EVENTS = """ev AS (
  SELECT event_id, user_id, event_type, value, k, ts, cast(event_id AS varchar) AS requestid, cast(user_id AS varchar) AS beyla_id,
    CASE event_type WHEN 'view' THEN 'AD_CpiShow' WHEN 'click' THEN 'AD_CpiClick' END AS event_name,
    'p' || (k % 4) AS pos_id,
    CASE k % 5 WHEN 0 THEN 'app.one' WHEN 1 THEN 'app.two' WHEN 2 THEN 'app.three' WHEN 3 THEN 'app.excluded' ELSE 'app.other' END AS package_name,
    cast(k % 10 AS bigint) AS ad_id, cast(k % 25 AS bigint) AS c_id, 'pkg' || (k % 7) AS ad_package_name,
    strftime(ts, '%Y%m%d%H') AS hour
  FROM (SELECT *, cast(regexp_extract(props, '([0-9]+)', 1) AS integer) AS k FROM events))"""

# impressions and clicks, installs as the projections leave them
IMP_CLICK = """imp_click AS (
  SELECT requestid, beyla_id, 'EG' AS country, pos_id, package_name, event_name, ad_package_name, ad_id, c_id, hour FROM ev
  WHERE event_type IN ('view', 'click') AND k % 11 <> 0 AND package_name IN ('app.one', 'app.two', 'app.three'))"""
INSTALLS = """installs AS (
  SELECT requestid, beyla_id, 'EG' AS country, pos_id, package_name, ad_package_name, ad_id, c_id, hour FROM ev
  WHERE event_type = 'purchase' AND k % 11 <> 0 AND package_name IN ('app.one', 'app.two', 'app.three', 'app.excluded'))"""

LABELS = """lab AS (
  SELECT cast(event_id AS varchar) AS rid, CASE WHEN k % 17 <> 0 THEN beyla_id END AS user_id,
    CASE WHEN k % 3 = 0 THEN 'EG' ELSE 'ID' END AS nation, package_name,
    CASE k % 3 WHEN 0 THEN 'O' WHEN 1 THEN 'F' END AS pos_id, '10.0.0.' || k AS client_ip,
    cast(floor(epoch(ts)) AS bigint) AS server_time, '11' AS os_version, 'b' AS brand, 'm' || (k % 3) AS model,
    CASE WHEN k % 4 <> 0 THEN 'en' END AS system_language, '100' AS app_version_code, 'Brand#' || (k % 30) AS ad_package_name,
    CASE k % 3 WHEN 0 THEN 'ECONOMY' WHEN 1 THEN 'STANDARD' ELSE 'PROMO' END AS ad_package_category,
    cast(k % 50 AS bigint) AS ad_id, CASE WHEN k % 13 <> 0 THEN cast(k AS bigint) END AS c_id,
    cast(k % 2 AS bigint) AS is_auto_download, cast(k % 3 = 0 AS integer) AS is_click,
    cast(k % 9 = 0 AS integer) AS is_attr_install, value AS bid_price, k, event_id
  FROM ev WHERE event_type = 'view')"""

AD_SETS = ("c_id", "ad_id", "ad_package_name", "ad_package_category")
AD_SETS_ALL = AD_SETS + tuple(f"package_name#{s}" for s in AD_SETS) + tuple(f"pos_id#{s}" for s in AD_SETS)
AD_SETS_NATION = AD_SETS + tuple(f"pos_id#{s}" for s in AD_SETS)
USER_SETS = ("user_id",) + tuple(f"user_id#{s}" for s in ("ad_id", "c_id", "ad_package_name", "ad_package_category")) + tuple(
    f"user_id#pos_id#{s}" for s in ("ad_id", "c_id", "ad_package_name", "ad_package_category")
)
SUMS = "cast(sum(imp) AS bigint) AS imp, cast(sum(click) AS bigint) AS click, cast(sum(attr_install) AS bigint) AS attr_install"


def key_text(name: str, prefix: str = "") -> str:
    return " || '#' || ".join(f"coalesce(cast({prefix}{d} AS varchar), 'None')" for d in name.split("#"))


def rollup(source: str, sets, by, aggs: str = SUMS, where: str = "true") -> str:
    """One plain GROUP BY per dimension set, glued by UNION ALL."""
    lead = ", ".join(by)
    return "\nUNION ALL\n".join(
        f"SELECT {lead}, '{s}' AS dim_set, {key_text(s)} AS dim_key, {aggs} FROM {source} WHERE {where} "
        f"GROUP BY {', '.join(dict.fromkeys([*by, *s.split('#')]))}"
        for s in sets
    )
