"""Stand-in layers derived from the driver's tables; the same SQL runs in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FIXTURES = {
    "fx_waterbody": """SELECT CAST(n_nationkey AS BIGINT) AS fid, concat('GB1040', CAST(1000+n_nationkey AS VARCHAR)) AS wb_id, n_name AS wb_name, CAST(n_regionkey AS BIGINT) AS region,
  400000+2000*(n_nationkey % 5) AS minx, 300000+2000*CAST(floor(n_nationkey/5) AS INT) AS miny, 402000+2000*(n_nationkey % 5) AS maxx, 302000+2000*CAST(floor(n_nationkey/5) AS INT) AS maxy FROM nation""",
    "fx_boundary": """SELECT CAST(r_regionkey AS BIGINT) AS fid, CASE WHEN r_regionkey<2 THEN 'ST' ELSE 'HD' END AS subsidiary, CASE WHEN r_regionkey % 2 = 0 THEN 'clean_water' ELSE 'waste' END AS service_type,
  400500+1000*r_regionkey AS minx, 300500+1500*r_regionkey AS miny, 404000+1000*r_regionkey AS maxx, 304000+1000*r_regionkey AS maxy FROM region WHERE r_regionkey<4""",
    "fx_landcover": """SELECT p_partkey AS fid, CASE WHEN p_partkey % 97 = 0 THEN 'n/a' ELSE CAST(p_size % 23 AS VARCHAR) END AS mode,
  400000+200*(p_partkey % 50) AS minx, 300000+200*(CAST(floor(p_partkey/50) AS INT) % 50) AS miny, 400200+200*(p_partkey % 50) AS maxx, 300200+200*(CAST(floor(p_partkey/50) AS INT) % 50) AS maxy FROM part""",
    "fx_flood": """SELECT o_orderkey AS fid, CASE substr(o_orderpriority,1,1) WHEN '1' THEN 'High' WHEN '2' THEN 'Medium' WHEN '3' THEN 'Low' WHEN '4' THEN 'Very Low' END AS risk_band,
  400000+10*((o_orderkey*131) % 991) AS minx, 300000+10*((o_orderkey*277) % 983) AS miny, 400000+10*((o_orderkey*131) % 991)+20+10*(o_custkey % 9) AS maxx, 300000+10*((o_orderkey*277) % 983)+20+10*(o_custkey % 7) AS maxy FROM orders""",
    "fx_raf": """SELECT l_orderkey AS fid, 400000+10*((l_orderkey*173) % 977) AS minx, 300000+10*((l_orderkey*59) % 971) AS miny, 400040+10*((l_orderkey*173) % 977) AS maxx, 300030+10*((l_orderkey*59) % 971) AS maxy FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey % 5 = 0) t""",
    "fx_line": """SELECT c_custkey AS fid, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Local' WHEN 'BUILDING' THEN 'Regional' WHEN 'FURNITURE' THEN 'National' WHEN 'HOUSEHOLD' THEN 'District' ELSE 'Canal' END AS type,
  400000+10*((c_custkey*37) % 907) AS x1, 300000+10*((c_custkey*53) % 887) AS y1, 400000+10*((c_custkey*37) % 907)+CASE WHEN c_custkey % 2 = 0 THEN 30*(c_nationkey+1) ELSE 0 END AS x2, 300000+10*((c_custkey*53) % 887)+CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE 30*(c_nationkey+1) END AS y2 FROM customer""",
    "fx_spz": """SELECT s_suppkey AS fid, CASE s_suppkey % 6 WHEN 0 THEN '1' WHEN 1 THEN ' 1C ' WHEN 2 THEN '2' WHEN 3 THEN '2c' WHEN 4 THEN '3' END AS number,
  400000+100*((s_suppkey*13) % 89) AS minx, 300000+100*((s_suppkey*29) % 83) AS miny, 400300+100*((s_suppkey*13) % 89) AS maxx, 300300+100*((s_suppkey*29) % 83) AS maxy FROM supplier""",
    "fx_grid1k": """SELECT p_partkey AS fid, CASE p_partkey % 8 WHEN 0 THEN 'Grade 1' WHEN 1 THEN 'Grade 2' WHEN 2 THEN 'Grade 3' WHEN 3 THEN 'Grade 4' WHEN 4 THEN 'Grade 5' WHEN 5 THEN 'Urban' WHEN 6 THEN 'Grade 3a' ELSE 'Not Surveyed' END AS alc_grade,
  CASE p_partkey % 5 WHEN 0 THEN 'ALL' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'LIGHT(SANDY)' WHEN 3 THEN 'HEAVY TO MEDIUM' ELSE 'PEAT' END AS soil_group,
  CASE p_partkey % 4 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'LOW' ELSE 'VERY HIGH' END AS prioritisation,
  CASE p_partkey % 6 WHEN 0 THEN 'SSSI' WHEN 1 THEN 'Network Expansion Zone' WHEN 2 THEN 'Restorable Habitat' WHEN 3 THEN 'Lakes' WHEN 4 THEN 'Unknown class' END AS class,
  400000+1000*(p_partkey % 10) AS minx, 300000+1000*CAST(floor(p_partkey/10) AS INT) AS miny, 401000+1000*(p_partkey % 10) AS maxx, 301000+1000*CAST(floor(p_partkey/10) AS INT) AS maxy FROM part WHERE p_partkey < 100""",
    "fx_point": """SELECT l_orderkey*8+l_linenumber AS fid, 400000+(l_orderkey*389+l_linenumber*1013) % 9973 AS x, 300000+(l_orderkey*683+l_linenumber*2027) % 9967 AS y FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) t""",
    "fx_shape": """SELECT p_partkey AS fid, p_partkey % 4 AS shape_kind, 400000+20*((p_partkey*37) % 149) AS ox, 300000+20*((p_partkey*91) % 151) AS oy, 20*(1+p_size % 10) AS s FROM part WHERE p_partkey % 3 = 0""",
    "fx_status": """SELECT event_id, concat('GB1040', CAST(1000+user_id % 25 AS VARCHAR)) AS tile_id, CASE event_id % 7 WHEN 0 THEN 'pond_pool_scrape' WHEN 1 THEN 'leaky_barriers' WHEN 2 THEN 'bunds' WHEN 3 THEN 'floodplain_reconnection' WHEN 4 THEN 'riparian_buffer_strips' WHEN 5 THEN 'woodland_planting' ELSE 'peat_restoration' END AS layer,
  CASE event_type WHEN 'purchase' THEN concat('ok:', CAST(user_id AS VARCHAR)) WHEN 'view' THEN 'empty' WHEN 'click' THEN 'missing:file' WHEN 'error' THEN 'error:KeyError:x' ELSE 'skip' END AS status, ts FROM events""",
    "fx_page": """SELECT event_id, CAST(floor(event_id/100) AS BIGINT) AS page, CASE WHEN event_id % 50 = 49 THEN event_id-1 ELSE event_id END AS objectid, concat('ds', CAST(event_id % 3 AS VARCHAR)) AS dataset, props FROM events""",
    "fx_pixel": """SELECT CAST(px AS BIGINT) px, CAST(py AS BIGINT) py, 400050+100*px AS x, 300050+100*py AS y, CASE WHEN (px*7+py*3) % 11 = 0 THEN -9999.0 ELSE CAST((px*13+py*17) % 120 AS DOUBLE) END AS value FROM (SELECT DISTINCT p_partkey % 100 AS px FROM part) a CROSS JOIN (SELECT DISTINCT p_partkey % 100 AS py FROM part) b""",
}


def layer(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named stand-in over the tables of ``sf_dir``."""
    text = FIXTURES[name].replace("VARCHAR", "STRING")
    for table in ("nation", "region", "part", "orders", "lineitem", "customer", "supplier", "events"):
        text = text.replace(f"FROM {table}", f"FROM parquet.`{sf_dir}/{table}.parquet`")
    return spark.sql(text)


def cte(*names: str) -> str:
    """The stand-ins as the head of a DuckDB query."""
    return "WITH " + ", ".join(f"{n} AS ({FIXTURES[n]})" for n in names) + " "
