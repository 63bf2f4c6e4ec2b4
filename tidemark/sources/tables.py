"""Load the driver's tables and map them onto the library's roles.

Library operators never read paths; only this module knows where the tables
are and how a TPC-H-style order line plays the part of a claim snapshot, an
``events`` row the part of a log record, and so on. Every role is a lazy
projection over the parquet scan, so column pruning and filter pushdown reach
the files.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ship_package

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Money is carried as an exact decimal: every source amount has two decimals,
# so products of two amounts fit four decimals and sums are order-independent.
MONEY = "decimal(18,4)"
AMOUNT = "decimal(12,2)"


class Tables:
    """Lazy handle on the driver tables under ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        # the tables hold UTC wall clocks (TIMESTAMP_NTZ); event-time work
        # (watermarks, windows) casts them to TIMESTAMP through the session
        # zone, so the roles pin it to UTC whatever the caller's default
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ship_package(spark)   # UDFs and state functions import tidemark in the workers

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.read(name)
        raise AttributeError(name)

    def register_views(self, names=TABLES) -> None:
        for n in names:
            self.read(n).createOrReplaceTempView(n)

    # ----- snapshot roles -------------------------------------------------

    def snapshots(self) -> DataFrame:
        """Monthly claim snapshot rows: one per order line and ship month.

        MATTER_SK = order, AS_OF_DATE = month end of the ship date, LOB from
        the customer, AOP = line number, cause = part size, category from the
        part key, status Open iff the order is open. ``SRC_*`` columns give
        every row a total order for deterministic de-duplication.
        """
        li = self.lineitem.select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
        o = self.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
        p = self.part.select("p_partkey", "p_size")
        ext = F.col("l_extendedprice").cast(AMOUNT)
        disc = F.col("l_discount").cast(AMOUNT)
        tax = F.col("l_tax").cast(AMOUNT)
        # part first, orders last: at scale both are shuffle joins, and ending
        # on the order key leaves the fact side hash-partitioned by MATTER_SK,
        # which the matter join and the (MATTER_SK, MONTH_END) de-duplication
        # downstream reuse without another exchange of the big side
        return (
            li.join(p, li.l_partkey == p.p_partkey)
            .join(o, li.l_orderkey == o.o_orderkey)
            .select(
                F.col("l_orderkey").cast("bigint").alias("MATTER_SK"),
                F.last_day(F.to_date("l_shipdate")).alias("AS_OF_DATE"),
                (F.col("o_custkey") % 4 + 1).cast("bigint").alias("LOB_SK"),
                F.col("l_linenumber").cast("bigint").alias("AOP_SK"),
                F.col("p_size").cast("bigint").alias("PRIMARY_CAUSE_OF_LOSS_SK"),
                (F.col("l_partkey") % 11 + 1).cast("bigint").alias("MATTER_CATEGORY_SK"),
                F.when(F.col("o_orderstatus") == "O", "Open").otherwise("Closed")
                .alias("MATTER_STATUS_CODE"),
                (ext * disc).cast(MONEY).alias("FIRM_PAID"),
                (ext * (F.lit(1) - disc)).cast(MONEY).alias("ALAS_PAID"),
                (ext * (F.lit(1) + tax)).cast(MONEY).alias("TOTAL_INCURRED"),
                ext.cast(MONEY).alias("GROUND_UP_PAID"),
                (ext * tax).cast(MONEY).alias("COINS_PAID"),
                F.col("l_quantity").cast(AMOUNT).cast(MONEY).alias("COINS_RESERVE"),
                F.col("l_linenumber").cast("bigint").alias("SRC_LINE"),
                F.col("l_partkey").alias("SRC_PART"),
                F.col("l_suppkey").alias("SRC_SUPP"),
                F.col("l_shipdate").alias("SRC_SHIPDATE"),
            )
        )

    def raw_matters(self) -> DataFrame:
        return self.orders.select(
            F.col("o_orderkey").cast("bigint").alias("MATTER_SK"),
            F.to_date("o_orderdate").alias("DATE_REPORTED"),
            (F.col("o_custkey") % 5).cast("bigint").alias("CLAIMANT_TYPE_SK"),
        )

    def aop_lookup(self) -> DataFrame:
        """AOP code -> group (code mod 3). Codes are the distinct line numbers."""
        return (self.lineitem.select(F.col("l_linenumber").cast("bigint").alias("AOP_SK"))
                .distinct()
                .withColumn("AOP_GROUP_2", F.concat(F.lit("G"), (F.col("AOP_SK") % 3).cast("string"))))

    def cause_lookup(self) -> DataFrame:
        """Cause code -> cause type (code mod 10). Codes are the distinct part sizes."""
        return (self.part.select(F.col("p_size").cast("bigint").alias("PRIMARY_CAUSE_OF_LOSS_SK"))
                .distinct()
                .withColumn("CAUSE_TYPE",
                            F.concat(F.lit("C"), (F.col("PRIMARY_CAUSE_OF_LOSS_SK") % 10).cast("string"))))

    # ----- event / log roles ---------------------------------------------

    def event_log(self) -> DataFrame:
        """Events with the day and a numeric props field extracted."""
        return self.events.select(
            "event_id", "ts", "user_id", "event_type", "value", "props")

    def lineage_edges(self) -> DataFrame:
        """Edge ``floor(c/2) -> c`` for every customer key >= 2 (a binary tree)."""
        return (self.customer.where(F.col("c_custkey") >= 2)
                .select(F.floor(F.col("c_custkey") / 2).cast("bigint").alias("src"),
                        F.col("c_custkey").cast("bigint").alias("dst")))


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)
