"""Customer tables derived from the given ones, and the same tables as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.spec import SplitSpec, TableSpec

SPLIT = SplitSpec()

CUSTOMERS = TableSpec(
    keys=("CustomerId",),
    label="Churn",
    positive_value="Yes",
    numeric=("SeniorCitizen", "Tenure", "MonthlyCharges", "TotalCharges"),
    categorical=("Segment", "Contract"),
    flags=("SeniorCitizen",),
    renames={"customerID": "CustomerId", "segment": "Segment", "tenure": "Tenure"},
    blank_fill={"TotalCharges": "0.00"},
)
CUSTOMERS_SCHEMA = (
    "customerID string, segment string, SeniorCitizen int, tenure int, Contract string, "
    "MonthlyCharges double, TotalCharges string, Churn string"
)
QUALITY = TableSpec(
    keys=("doc_id",),
    label="quality",
    positive_value="0",
    numeric=("n_chars", "toxic"),
    categorical=("lang", "source"),
    flags=("toxic",),
)
RETURNS = TableSpec(
    keys=("l_orderkey",),
    label="l_returnflag",
    positive_value="R",
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    categorical=("l_linestatus",),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def churn_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw row per customer with orders: blanks for some totals, Churn by the date of the last order.

    Prices are summed as whole cents, so the mean does not depend on the order in which tasks add up. The priority
    of the latest order is joined back by its key: with numbers only, Spark aggregates by hash, while ``max_by`` of
    a text makes it sort all orders first.
    """
    orders = table(spark, sf_dir, "orders")
    latest = orders.agg(F.max("o_orderdate")).scalar()
    per_customer = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("first"),
        F.max("o_orderdate").alias("last"),
        F.max("o_orderkey").alias("o_orderkey"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).cast("double").alias("cents"),
        F.count(F.lit(1)).cast("double").alias("n"),
    )
    per_customer = per_customer.join(orders.select("o_orderkey", "o_orderpriority"), "o_orderkey")
    balance = F.col("c_acctbal")
    return (
        table(spark, sf_dir, "customer")
        .join(per_customer, "c_custkey")
        .select(
            F.col("c_custkey").cast("string").alias("customerID"),
            F.col("c_mktsegment").alias("segment"),
            (balance >= 5000).cast("int").alias("SeniorCitizen"),
            F.floor(F.datediff("last", "first") / 30).cast("int").alias("tenure"),
            F.col("o_orderpriority").alias("Contract"),
            (F.round(F.col("cents") / (F.col("n") * 10000.0)) / 10.0).alias("MonthlyCharges"),
            F.when(balance < 0, " ").otherwise(F.round(balance, 2).cast("string")).alias("TotalCharges"),
            F.when(F.col("last") < latest - F.expr("interval 270 days"), "Yes").otherwise("No").alias("Churn"),
        )
    )


CHURN_CUSTOMERS_SQL = """raw as (
  select cast(c_custkey as varchar) as customerID, c_mktsegment as segment,
         cast(c_acctbal >= 5000 as int) as SeniorCitizen,
         cast(floor(date_diff('day', a.lo, a.hi) / 30.0) as int) as tenure, a.contract as Contract,
         round(a.cents / (a.n * 10000.0)) / 10.0 as MonthlyCharges,
         case when c_acctbal < 0 then ' ' else cast(round(c_acctbal, 2) as varchar) end as TotalCharges,
         case when a.hi < (select max(o_orderdate) from orders) - interval 270 day then 'Yes' else 'No' end as Churn
  from customer
  join (select o_custkey, min(o_orderdate) lo, max(o_orderdate) hi,
               max_by(o_orderpriority, o_orderkey) contract,
               cast(sum(cast(round(o_totalprice * 100) as bigint)) as double) cents, cast(count(*) as double) n
        from orders group by o_custkey) a on c_custkey = a.o_custkey
), cleaned as (
  select customerID as CustomerId, segment as Segment, SeniorCitizen, tenure as Tenure, Contract, MonthlyCharges,
         cast(case when TotalCharges = ' ' then '0.00' else TotalCharges end as double) as TotalCharges, Churn,
         case when Churn = 'Yes' then 1.0::double else 0.0::double end as label
  from raw
)"""


def clear_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customers whose label has a wide gap in one input: any sound classifier gives it back row by row.

    All customers are there; totals inside the gap are moved to the nearer side of it.
    """
    raw = churn_customers(spark, sf_dir)
    balance = F.coalesce(F.col("TotalCharges").try_cast("double"), F.lit(0.0))
    moved = F.when((balance >= 4000) & (balance < 5000), F.round(balance - 4000, 2).cast("string"))
    moved = moved.when((balance >= 5000) & (balance < 6000), F.round(balance + 2000, 2).cast("string"))
    label = F.when(balance >= 5000, "Yes").otherwise("No")
    return raw.withColumns({"Churn": label, "TotalCharges": moved.otherwise(F.col("TotalCharges"))})


CLEAR_SQL = f"""{CHURN_CUSTOMERS_SQL}, clear as (
  select * replace (case when TotalCharges >= 5000 then 'Yes' else 'No' end as Churn,
                    case when TotalCharges >= 5000 then 1.0::double else 0.0::double end as label,
                    case when TotalCharges >= 4000 and TotalCharges < 5000 then round(TotalCharges - 4000, 2)
                         when TotalCharges >= 5000 and TotalCharges < 6000 then round(TotalCharges + 2000, 2)
                         else TotalCharges end as TotalCharges)
  from cleaned
)"""

NOISY = TableSpec(keys=("o_orderkey",), label="is_late", positive_value="Yes", numeric=("is_urgent",), categorical=())


def noisy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders with one 0/1 input and a label that follows it, but for every seventh order key."""
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    late = F.when(urgent != (F.col("o_orderkey") % 7 == 0), "Yes").otherwise("No")
    return table(spark, sf_dir, "orders").select("o_orderkey", urgent.cast("int").alias("is_urgent"), late.alias("is_late"))


NOISY_SQL = """noisy as (
  select o_orderkey, o_orderpriority in ('1-URGENT', '2-HIGH') as x,
         (o_orderpriority in ('1-URGENT', '2-HIGH')) <> (o_orderkey % 7 = 0) as y
  from orders
)"""

LINES = TableSpec(
    keys=("l_orderkey", "l_linenumber"), label="l_returnflag", positive_value="R", numeric=(), categorical=("order_name",)
)


def ordered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All order lines with their order as a category: about as many values as there are orders."""
    name = F.col("l_orderkey").cast("string").alias("order_name")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", name)


def labelled_documents(spark: SparkSession, sf_dir: str, how: str = "inner") -> DataFrame:
    """Documents with their labels; ``how="left"`` keeps those without any."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", how)


QUALITY_SQL = """docs as (
  select d.doc_id, lang, source, n_chars, quality, toxic,
         case when quality = 0 then 1.0::double else 0.0::double end as label
  from documents d join labels l on d.doc_id = l.doc_id
)"""


def line_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines labelled by return; all lines of an order share its key."""
    columns = [*RETURNS.keys, RETURNS.label, *RETURNS.features]
    return table(spark, sf_dir, "lineitem").select(*columns)


RETURNS_SQL = """lines as (
  select l_orderkey, l_returnflag, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus,
         case when l_returnflag = 'R' then 1.0::double else 0.0::double end as label
  from lineitem
)"""


def position_sql(key: str, part: int) -> str:
    """The part-th 20 bits (0 split, 1 sample, 2 fold) of the key's digest as a number in [0, 1)."""
    bits = f"(('0x' || substr(md5(concat_ws(':', '{SPLIT.seed}', cast({key} as varchar))), 1, 15))::bigint)"
    return f"((({bits} >> {20 * part}) & 1048575)::double / 1048576.0::double)"
