"""Adapter views: the test tables in the shape of toll records.

Each view has one SQL text. Spark runs it over the table it reads; the oracle inlines the same text as a CTE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

EV_SPARK = """
select *, cast(ts as timestamp) as event_ts, unix_seconds(cast(ts as timestamp)) as unix_s,
  cast(floor(value * 30) as bigint) as delay_s, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k
from {src}"""

EV_DUCK = """
select *, ts as event_ts, cast(floor(epoch(ts)) as bigint) as unix_s,
  cast(floor(value * 30) as bigint) as delay_s, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k
from events"""

# name: (source, SQL)
VIEWS: dict[str, tuple[str, str]] = {
    "v_gantry": ("ev", """
select concat('T', cast(event_id as string)) as trade_id, concat('G', cast(user_id as string)) as gantry_id,
  concat('S', cast(user_id % 25 as string)) as station_id, concat('L', cast(event_id % 7 as string)) as lane_id,
  concat('C', cast(user_id % 5 as string)) as sub_center,
  event_ts, unix_s as event_unix, delay_s, unix_s + delay_s as receive_unix,
  case event_type when 'view' then 1 when 'purchase' then 1 when 'click' then 2 when 'signup' then 3 else 9 end
    as media_type,
  event_id % 2 as trade_result,
  case when k % 7 = 0 then null when k % 7 = 1 then ''
    else concat(cast(100 + k as string), '|', cast(k as string)) end as special_type
from {src}"""),
    "v_dim": ("supplier", """
select concat('G', cast(s_suppkey as string)) as mjid, concat('R', cast(s_nationkey as string)) as roadid,
  s_name as tollstation
from {src}"""),
    "v_heartbeat": ("ev", """
select concat('H', cast(event_id as string)) as hb_id, concat('L', cast(user_id as string)) as lane_id,
  concat('G', cast(user_id as string)) as gantry_id,
  concat('G00', cast(100000000 + user_id % 10 as string), 'X') as station_id,
  concat('S00', cast(100000000 + k % 5 as string), 'U') as charge_unit_id, event_ts,
  case k % 4 when 0 then '11' when 1 then '10' when 2 then '2' else '21' end as rsu_status,
  case k % 3 when 0 then '0' when 1 then '00' else '099' end as vplr_status,
  case when k % 5 = 0 then '2' else '1' end as lane_controller_status
from {src}"""),
    "v_etc": ("ev", """
select concat('E', cast(event_id as string)) as trade_id, concat('G', cast(user_id % 30 as string)) as gantry_id,
  concat('P', cast(user_id as string), '_', cast(k % 2 as string)) as plate, unix_s as trans_unix
from {src} where event_type in ('purchase', 'signup')"""),
    "v_viu": ("ev", """
select concat('V', cast(event_id as string)) as pic_id, concat('G', cast(user_id % 30 as string)) as gantry_id,
  concat('P', cast(user_id as string), '_', cast(k % 2 as string)) as plate, unix_s as pic_unix
from {src} where event_type in ('view', 'click')"""),
    "v_exit": ("lineitem", """
select concat('S', cast(l_suppkey as string)) as station_id, concat('Station ', cast(l_suppkey as string)) as station_name,
  cast(l_shipdate as date) as event_day,
  case when l_quantity >= 50 then 9 when l_quantity >= 49 then 4 when l_returnflag = 'A' then 1
    when l_returnflag = 'R' then 2 else 3 end as media_type,
  case when l_linenumber <= 4 then l_linenumber when l_linenumber = 5 then 11 when l_linenumber = 6 then 21
    else 26 end as vehicle_type,
  case when l_partkey % 4 = 0 then 0 when l_partkey % 4 = 1 then 8 when l_partkey % 4 = 2 then 10
    else 21 + l_partkey % 8 end as vehicle_class,
  case when l_linestatus = 'O' then 1 else 2 end as sign_status,
  case when l_orderkey % 11 = 0 then null else cast(l_extendedprice as decimal(10,4)) end as fee,
  cast(cast(l_extendedprice as decimal(10,4)) * cast(l_discount as decimal(10,4)) as decimal(10,4)) as discount_fee,
  l_linenumber % 2 as multi_province, l_partkey % 8 as pay_type, l_orderkey % 12 as actual_fee_class
from {src}"""),
    "v_exit_large": ("lineitem", """
select concat('S', cast(l_suppkey as string)) as station_id, concat('Station ', cast(l_suppkey as string)) as station_name,
  cast(l_shipdate as date) as event_day,
  case when l_quantity >= 50 then 9 when l_quantity >= 49 then 4 when l_returnflag = 'A' then 1
    when l_returnflag = 'R' then 2 else 3 end as media_type,
  l_linenumber as vehicle_type, case when l_partkey % 2 = 0 then 0 else 8 end as vehicle_class,
  case when l_linestatus = 'O' then 1 else 2 end as sign_status,
  case when l_orderkey % 97 = 0 then cast(l_extendedprice as decimal(10,2)) * 1000
    else cast(l_extendedprice as decimal(10,2)) end as fee,
  cast(null as decimal(10,4)) as discount_fee,
  l_linenumber % 2 as multi_province, l_partkey % 8 as pay_type, l_orderkey % 12 as actual_fee_class
from {src}"""),
    "v_exit_evt": ("ev", """
select concat('S', cast(user_id % 25 as string)) as station_id,
  concat('Station ', cast(user_id % 25 as string)) as station_name, event_ts,
  case event_type when 'view' then 1 when 'click' then 2 when 'purchase' then 3 when 'signup' then 4 else 9 end
    as media_type,
  case when k % 6 = 0 then 11 else 1 + k % 4 end as vehicle_type,
  case when k % 2 = 0 then 0 else 21 end as vehicle_class,
  1 + event_id % 2 as sign_status, cast(value as decimal(10,4)) as fee,
  cast(value / 10 as decimal(10,4)) as discount_fee, k % 2 as multi_province, 1 + k % 7 as pay_type,
  1 + k % 6 as actual_fee_class
from {src}"""),
    "v_issue": ("ev", """
select concat('POS', cast(user_id % 15 as string)) as pos_id, cast(event_ts as date) as event_day,
  case event_id % 3 when 0 then 1 when 1 then 2 else 3 end as card_type,
  case event_id % 3 when 0 then 9 when 1 then 82 else 65 end as oper_type
from {src}"""),
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def over(name: str, base: DataFrame) -> DataFrame:
    """The view `name` over its base table or stream."""
    source, sql = VIEWS[name]
    spark = base.sparkSession
    if source == "ev":
        base = spark.sql(EV_SPARK, src=base)
    return spark.sql(sql, src=base)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source = VIEWS[name][0]
    return over(name, table(spark, sf_dir, "events" if source == "ev" else source))


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(EV_SPARK, src=table(spark, sf_dir, "events"))


def ctes(*names: str) -> str:
    """`with ...` clause that defines the named views for the oracle."""
    parts = [f"ev as ({EV_DUCK})"] if any(n == "ev" or VIEWS[n][0] == "ev" for n in names) else []
    parts += [f"{n} as ({VIEWS[n][1].format(src=VIEWS[n][0])})" for n in names if n != "ev"]
    return "with " + ",\n".join(parts)
