"""Company master and register events, from Parquet or JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadspark.schema import SOURCE_FIELDS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    **options: str,
) -> DataFrame:
    """Range-partitioned JDBC read; filters and columns are pushed to the database."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn=partition_column,
            lowerBound=lower,
            upperBound=upper,
            numPartitions=partitions,
            **options,
        )
        .load()
    )


def rename_master(df: DataFrame, key: str, name: str) -> DataFrame:
    """Bring a company master with the source's field names to the names used here.

    A postal code read as a number becomes text; text fields are trimmed and
    empty text becomes null, so one null stands for every absent value.
    """
    fields = {key: "company_id", name: "company_name", **SOURCE_FIELDS}
    picked = df.select(*[F.col(f"`{c}`").alias(fields[c]) for c in df.columns if c in fields])
    text = [f for f, t in picked.dtypes if t == "string"]
    out = picked.withColumns({c: F.nullif(F.trim(F.col(c)), F.lit("")) for c in text})
    if "postal_code" in out.columns:
        out = out.withColumn("postal_code", F.col("postal_code").cast("string"))
    return out


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company master derived from customer, nation and orders.

    The join date is the first urgent large order. Orders shrink to one row per
    customer in a map-side aggregate, and the left join reuses its partitioning.
    """
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    orders = read_table(spark, sf_dir, "orders")
    joined = (
        orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 400000))
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min("o_orderdate").alias("joined_at"))
    )
    k = F.col("c_custkey")
    bal = F.col("c_acctbal")
    revenue = F.when(bal >= 0, bal)
    headcount = F.when(k % 7 != 0, (k % 250).cast("double"))
    code6 = F.when(k % 31 == 0, None).when(k % 37 == 0, "A").otherwise(((k * 7919) % 900000 + 100000).cast("string"))
    return (
        customer.join(nation.select("n_nationkey", "n_name", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(joined, "c_custkey", "left")
        .select(
            k.alias("company_id"),
            F.col("c_name").alias("company_name"),
            F.when(k % 17 != 0, (F.lit(1985) + k % 14).cast("int")).alias("founding_year"),
            F.when(k % 19 == 0, None)
            .when(k % 41 == 0, "CH-1")
            .otherwise((F.lit(1000) + k % 9000).cast("string"))
            .alias("postal_code"),
            F.col("n_name").alias("canton"),
            F.concat(F.lit("Ort "), (k % 100).cast("string")).alias("city"),
            F.col("c_mktsegment").alias("legal_form"),
            F.substring("c_mktsegment", 1, 2).alias("legal_code"),
            F.substring(code6, 1, 2).alias("industry_code_02"),
            F.substring(code6, 1, 4).alias("industry_code_04"),
            code6.alias("industry_code_06"),
            F.concat(F.lit("Industry "), F.substring(code6, 1, 2)).alias("industry_text_02"),
            F.concat(F.lit("Industry "), F.substring(code6, 1, 4)).alias("industry_text_04"),
            F.concat(F.lit("Industry "), code6).alias("industry_text_06"),
            headcount.alias("headcount"),
            F.concat(F.lit("H"), F.floor(headcount / 50).cast("string")).alias("headcount_band"),
            (F.floor(headcount / 50) + 1).cast("int").alias("headcount_band_order"),
            revenue.alias("revenue"),
            F.concat(F.lit("U"), F.floor(revenue / 1500).cast("string")).alias("revenue_band"),
            (F.floor(revenue / 1500) + 1).cast("int").alias("revenue_band_order"),
            (k % 5 + 1).cast("int").alias("risk_class"),
            F.when(bal < 0, "UNBEK")
            .when(bal < 2500, "MICRO")
            .when(bal < 5000, "KLEIN")
            .when(bal < 7500, "MITTEL")
            .when(bal < 9000, "GROSS")
            .otherwise("SEHR GROSS")
            .alias("size_class"),
            F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("stock_category"),
            F.col("joined_at"),
            F.when(k % 5 == 0, F.col("joined_at") + F.expr("INTERVAL 24 MONTH")).alias("left_at"),
            F.when(k % 23 == 0, F.lit("1888-12-31").cast("date"))
            .when(k % 29 == 0, F.lit("1997-01-15").cast("date"))
            .alias("deleted_at"),
        )
    )


COMPANIES_SQL = """
joins AS (
  SELECT o_custkey, min(o_orderdate) AS joined_at FROM orders
  WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000 GROUP BY o_custkey
),
companies AS (
  SELECT t.*,
    substr(industry_code_06, 1, 2) AS industry_code_02,
    substr(industry_code_06, 1, 4) AS industry_code_04,
    'Industry ' || substr(industry_code_06, 1, 2) AS industry_text_02,
    'Industry ' || substr(industry_code_06, 1, 4) AS industry_text_04,
    'Industry ' || industry_code_06 AS industry_text_06,
    'H' || CAST(CAST(floor(headcount / 50) AS BIGINT) AS VARCHAR) AS headcount_band,
    CAST(floor(headcount / 50) AS BIGINT) + 1 AS headcount_band_order,
    'U' || CAST(CAST(floor(revenue / 1500) AS BIGINT) AS VARCHAR) AS revenue_band,
    CAST(floor(revenue / 1500) AS BIGINT) + 1 AS revenue_band_order
  FROM (
    SELECT c.c_custkey AS company_id, c.c_name AS company_name,
      CASE WHEN c.c_custkey % 17 <> 0 THEN 1985 + c.c_custkey % 14 END AS founding_year,
      CASE WHEN c.c_custkey % 19 = 0 THEN NULL WHEN c.c_custkey % 41 = 0 THEN 'CH-1'
           ELSE CAST(1000 + c.c_custkey % 9000 AS VARCHAR) END AS postal_code,
      n.n_name AS canton,
      'Ort ' || CAST(c.c_custkey % 100 AS VARCHAR) AS city,
      c.c_mktsegment AS legal_form, substr(c.c_mktsegment, 1, 2) AS legal_code,
      CASE WHEN c.c_custkey % 31 = 0 THEN NULL WHEN c.c_custkey % 37 = 0 THEN 'A'
           ELSE CAST((c.c_custkey * 7919) % 900000 + 100000 AS VARCHAR) END AS industry_code_06,
      CASE WHEN c.c_custkey % 7 <> 0 THEN CAST(c.c_custkey % 250 AS DOUBLE) END AS headcount,
      CASE WHEN c.c_acctbal >= 0 THEN c.c_acctbal END AS revenue,
      c.c_custkey % 5 + 1 AS risk_class,
      CASE WHEN c.c_acctbal < 0 THEN 'UNBEK' WHEN c.c_acctbal < 2500 THEN 'MICRO'
           WHEN c.c_acctbal < 5000 THEN 'KLEIN' WHEN c.c_acctbal < 7500 THEN 'MITTEL'
           WHEN c.c_acctbal < 9000 THEN 'GROSS' ELSE 'SEHR GROSS' END AS size_class,
      'R' || CAST(n.n_regionkey AS VARCHAR) AS stock_category,
      j.joined_at,
      CASE WHEN c.c_custkey % 5 = 0 THEN j.joined_at + INTERVAL 24 MONTH END AS left_at,
      CASE WHEN c.c_custkey % 23 = 0 THEN DATE '1888-12-31'
           WHEN c.c_custkey % 29 = 0 THEN DATE '1997-01-15' END AS deleted_at
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN joins j ON c.c_custkey = j.o_custkey
  ) t
)
"""


def register_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commercial-register publications by month: (publication_date, kanton, shab_id, publications).

    Orders stand in for publications: an open order is an entry, a filled one a
    deletion, others are no event. They are counted per customer, month and type
    before the join, so a customer with very many orders is a few rows by then.
    """
    orders = read_table(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin("O", "F"))
    counted = orders.groupBy(
        F.col("o_custkey").alias("c_custkey"), F.date_trunc("month", "o_orderdate").alias("publication_date"), "o_orderstatus"
    ).agg(F.count(F.lit(1)).alias("publications"))
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        counted.join(customer, "c_custkey")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "publication_date",
            F.lower(F.concat(F.lit(" "), F.col("n_name"))).alias("kanton"),
            F.when(F.col("o_orderstatus") == "O", "hr01").otherwise("hr03").alias("shab_id"),
            "publications",
        )
    )


REGISTER_SQL = """
shab_raw AS (
  SELECT o.o_orderdate AS publication_date, lower(' ' || n.n_name) AS kanton,
    CASE WHEN o.o_orderstatus = 'O' THEN 'hr01' ELSE 'hr03' END AS shab_id
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE o.o_orderstatus IN ('O', 'F')
),
shab AS (
  SELECT publication_date, upper(trim(kanton)) AS kanton, upper(shab_id) AS shab_id FROM shab_raw
)
"""
