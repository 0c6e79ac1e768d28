"""Feed-shaped views of the driver's tables, so that every operator meets real rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ASOF = "1996-06-15 09:30:00"  # UTC; the London clock is an hour ahead
#: UTC moments around clock changes, days' ends and closing minutes, with London's date and minutes of the day.
MOMENTS = {"1992-02-29 00:00:00": ("1992-02-29", 0), "1994-03-27 01:00:00": ("1994-03-27", 120), "1995-10-22 10:30:00": ("1995-10-22", 630), "1996-06-15 09:29:59": ("1996-06-15", 629), ASOF: ("1996-06-15", 630), "1997-06-30 23:30:00": ("1997-07-01", 30), "2005-01-01 12:00:00": ("2005-01-01", 720)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as adverts: the customer advertises, the order date is the closing date, customers share links."""
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    rows = orders.join(customer, orders.o_custkey == customer.c_custkey).join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey)
    k = F.col("o_orderkey")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return rows.select(
        k.alias("rec_no"), text("c_name").alias("organization"), F.lit("Company").alias("employer_type"), text("o_orderpriority").alias("job_title"), text("c_mktsegment").alias("job_area"),
        F.when(k % 3 == 0, "").otherwise(text("n_name")).alias("location"), text("n_name").alias("location_area"),
        F.when(k % 17 == 0, "").when(k % 19 == 0, "1996-02-30").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("closing_date"),
        F.when(k % 5 == 0, "").when(k % 7 == 0, "25:00").otherwise("10:30").alias("closing_time"),
        F.lit("Permanent").alias("contract_type"), text("o_orderstatus").alias("work_pattern"), F.when(k % 4 == 0, "").otherwise(F.lit("£25,000")).alias("salary"),
        F.when(k % 23 == 0, "").when(k % 29 == 0, "javascript:void(0)").otherwise(F.concat(F.lit("https://example.org/jobs/"), F.col("o_custkey").cast("string"))).alias("apply_url"),
        k.cast("string").alias("job_reference"), F.lit("1996-06-15").alias("date_checked"), F.lit("https://example.org/jobs").alias("source_url"), F.lit("").alias("job_summary"),
    )


FEED_ORDERS = """feed as (select o_orderkey as rec_no, c_name as organization, 'Company' as employer_type, o_orderpriority as job_title, c_mktsegment as job_area,
  case when o_orderkey % 3 = 0 then '' else n_name end as location, n_name as location_area,
  case when o_orderkey % 17 = 0 then '' when o_orderkey % 19 = 0 then '1996-02-30' else strftime(o_orderdate, '%Y-%m-%d') end as closing_date,
  case when o_orderkey % 5 = 0 then '' when o_orderkey % 7 = 0 then '25:00' else '10:30' end as closing_time,
  'Permanent' as contract_type, o_orderstatus as work_pattern, case when o_orderkey % 4 = 0 then '' else '£25,000' end as salary,
  case when o_orderkey % 23 = 0 then '' when o_orderkey % 29 = 0 then 'javascript:void(0)' else 'https://example.org/jobs/' || o_custkey end as apply_url,
  o_orderkey::varchar as job_reference, '1996-06-15' as date_checked, 'https://example.org/jobs' as source_url, '' as job_summary
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)"""


def feed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as adverts with summaries: the source is the employer, the id the reference."""
    docs = table(spark, sf_dir, "documents")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select((F.col("doc_id") + 2).alias("rec_no"), text("source").alias("organization"), text("lang").alias("job_title"), text("doc_id").alias("job_reference"), F.lit("").alias("salary"), text("text").alias("job_summary"))
