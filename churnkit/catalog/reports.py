"""Scans, cleaning, profiles and exploration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit import sources
from churnkit.catalog.fixtures import (
    CHURN_CUSTOMERS_SQL,
    CUSTOMERS,
    CUSTOMERS_SCHEMA,
    QUALITY,
    QUALITY_SQL,
    RETURNS,
    RETURNS_SQL,
    churn_customers,
    labelled_documents,
    line_returns,
)
from churnkit.catalog.registry import query
from churnkit.functions import label_value
from churnkit.operators import clean as cleaning
from churnkit.operators import explore, profile
from churnkit.plans import jobs
from churnkit.sources import Workspace
from churnkit.spec import TableSpec

_CUSTOMERS = (CHURN_CUSTOMERS_SQL,)
_DOCS = (QUALITY_SQL,)
_LINES = (RETURNS_SQL,)


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(churn_customers(spark, sf_dir), CUSTOMERS)


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def _csv_copy(spark: SparkSession, sf_dir: str) -> str:
    path = Workspace(spark).folder()
    sources.write_csv(churn_customers(spark, sf_dir), path)
    return path


# ---- scans and schema ------------------------------------------------------------------------------------------


@query("select * from raw", _CUSTOMERS)
def csv_scan(spark, sf_dir):
    """Written as CSV, read with a given schema."""
    return sources.read_csv(spark, _csv_copy(spark, sf_dir), CUSTOMERS_SCHEMA)


@query(
    """select unnest(['customerID', 'segment', 'SeniorCitizen', 'tenure', 'Contract', 'MonthlyCharges',
                      'TotalCharges', 'Churn']) as "column",
              unnest(['int', 'string', 'int', 'int', 'string', 'double', 'string', 'string']) as type,
              unnest([count(customerID), count(segment), count(SeniorCitizen), count(tenure), count(Contract),
                      count(MonthlyCharges), count(TotalCharges), count(Churn)]) as n_filled
       from raw""",
    _CUSTOMERS,
)
def csv_inferred_types(spark, sf_dir):
    """Written as CSV, read with inferred types: blanks keep the totals a text column."""
    read = sources.read_csv(spark, _csv_copy(spark, sf_dir))
    return sources.schema_report(read).drop("position")


@query(
    """select doc_id, case when doc_id % 7 = 0 then '' when doc_id % 7 <> 1 then text end as text,
              case when doc_id % 5 = 0 then '"' || lang || '\\' else lang end as lang,
              case when doc_id % 3 = 0 then ' ' || source || chr(13) || chr(10) else ',' end as source
       from documents"""
)
def documents_csv_roundtrip(spark, sf_dir):
    """Whole texts with line breaks, quotes, empty and null cells, written as CSV and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path, number = Workspace(spark).folder(), F.col("doc_id")
    cells = docs.select(
        "doc_id",
        F.when(number % 7 == 0, "").when(number % 7 != 1, F.col("text")).alias("text"),
        F.when(number % 5 == 0, F.concat(F.lit('"'), "lang", F.lit("\\"))).otherwise(F.col("lang")).alias("lang"),
        F.when(number % 3 == 0, F.concat(F.lit(" "), "source", F.lit("\r\n"))).otherwise(",").alias("source"),
    )
    sources.write_csv(cells, path, line_breaks=True)
    return sources.read_csv(spark, path, cells.schema, line_breaks=True)


@query("select * from cleaned order by CustomerId limit 20".replace("*", "* exclude (label)"), _CUSTOMERS)
def preview(spark, sf_dir):
    return sources.preview(_cleaned(spark, sf_dir), 20, ["CustomerId"])


@query(
    """select unnest([1, 2, 3, 4, 5, 6, 7, 8])::int as position,
              unnest(['customerID', 'segment', 'SeniorCitizen', 'tenure', 'Contract', 'MonthlyCharges',
                      'TotalCharges', 'Churn']) as "column",
              unnest(['string', 'string', 'int', 'int', 'string', 'double', 'string', 'string']) as type,
              unnest([count(customerID), count(segment), count(SeniorCitizen), count(tenure), count(Contract),
                      count(MonthlyCharges), count(TotalCharges), count(Churn)]) as n_filled
       from raw""",
    _CUSTOMERS,
)
def schema_report(spark, sf_dir):
    return sources.schema_report(churn_customers(spark, sf_dir))


@query("select count(*) as n_rows from raw", _CUSTOMERS)
def row_count(spark, sf_dir):
    return profile.row_count(churn_customers(spark, sf_dir))


# ---- cleaning --------------------------------------------------------------------------------------------------


@query("select customerID as CustomerId, segment as Segment, tenure as Tenure from raw", _CUSTOMERS)
def rename_columns(spark, sf_dir):
    return cleaning.rename(churn_customers(spark, sf_dir), CUSTOMERS.renames).select("CustomerId", "Segment", "Tenure")


@query("select CustomerId, TotalCharges from cleaned", _CUSTOMERS)
def clean_blanks(spark, sf_dir):
    filled = cleaning.fill_blanks(churn_customers(spark, sf_dir), CUSTOMERS)
    return filled.select(F.col("customerID").alias("CustomerId"), "TotalCharges")


@query("select * exclude (label) from cleaned", _CUSTOMERS)
def clean_customers(spark, sf_dir):
    return _cleaned(spark, sf_dir)


@query("select 'segment' as \"column\", count(*) as n_rows from raw", _CUSTOMERS)
def rejected_cells(spark, sf_dir):
    """Texts that are no number, here a column of names: every cell of it."""
    as_number = TableSpec(("customerID",), "Churn", "Yes", blank_fill={"TotalCharges": "0.00", "segment": "0.00"})
    return cleaning.rejected_cells(churn_customers(spark, sf_dir), as_number)


# ---- quality ---------------------------------------------------------------------------------------------------


@query(
    """select * from (select unnest(['quality', 'toxic']) as "column",
                             unnest([count(*) - count(quality), count(*) - count(toxic)]) as n_rows
                      from documents d left join labels l on d.doc_id = l.doc_id) where n_rows > 0"""
)
def null_profile(spark, sf_dir):
    return profile.null_profile(labelled_documents(spark, sf_dir, "left"))


@query(
    """select * from (select 'TotalCharges' as "column", count(*) filter (TotalCharges in ('', ' ')) as n_rows
                      from raw) where n_rows > 0""",
    _CUSTOMERS,
)
def blank_profile(spark, sf_dir):
    return profile.blank_profile(churn_customers(spark, sf_dir))


@query("select * from raw where TotalCharges in ('', ' ')", _CUSTOMERS)
def blank_rows(spark, sf_dir):
    return profile.blank_rows(churn_customers(spark, sf_dir), "TotalCharges")


@query("select Churn, count(*) as n_rows from raw group by Churn", _CUSTOMERS)
def class_balance(spark, sf_dir):
    return profile.class_balance(churn_customers(spark, sf_dir), "Churn")


# Means of hundredths over round row counts often end in a 5 at the seventh digit, so profiles are compared at five.
def _profile_sql(source: str, numbers: list[str], texts: list[str]) -> str:
    number = """select '{c}' as "column", count(*) as n_rows, count(*) - count({c}) as n_null,
       count(distinct {c}) as n_distinct, round(avg({c}), 5) as mean, round(stddev_samp({c}), 5) as stddev,
       round(min({c})::double, 5) as min, round(quantile_cont({c}::double, 0.25), 5) as p25,
       round(quantile_cont({c}::double, 0.5), 5) as p50, round(quantile_cont({c}::double, 0.75), 5) as p75,
       round(max({c})::double, 5) as max from {source}"""
    text = """select '{c}', count(*), count(*) - count({c}), count(distinct {c}),
       null, null, null, null, null, null, null from {source}"""
    return " union all ".join(
        [number.format(c=c, source=source) for c in numbers] + [text.format(c=c, source=source) for c in texts]
    )


_FIGURES = ("mean", "stddev", "min", "p25", "p50", "p75", "max")


@query(
    _profile_sql(
        "cleaned",
        ["SeniorCitizen", "Tenure", "MonthlyCharges", "TotalCharges"],
        ["CustomerId", "Segment", "Contract", "Churn"],
    ),
    _CUSTOMERS,
)
def column_profile(spark, sf_dir):
    df = _cleaned(spark, sf_dir)
    return _rounded(profile.column_profile(df, df.columns, Workspace(spark)), *_FIGURES, digits=5)


@query(_profile_sql("lines", list(RETURNS.numeric), ["l_returnflag", "l_linestatus"]), _LINES)
def returns_profile(spark, sf_dir):
    df = line_returns(spark, sf_dir).drop("l_orderkey")
    return _rounded(profile.column_profile(df, df.columns, Workspace(spark)), *_FIGURES, digits=5)


@query(
    """select 'price' as "column", count(*) as n_rows, 0::bigint as n_null, count(distinct (o_totalprice, o_orderkey % 100)) as n_distinct,
              round(quantile_cont(o_totalprice::double, 0.5), 2) as p50,
              round(quantile_cont(o_totalprice::double, 0.999), 2) as p99_9
       from orders"""
)
def decimal_profile(spark, sf_dir):
    """Prices a hair apart, as decimals that no double tells from each other: each is a value of its own."""
    hair = (F.col("o_orderkey") % 100).cast("decimal(3,0)") * F.lit("0.00000000000001").cast("decimal(15,14)")
    price = F.col("o_totalprice").cast("decimal(12,2)") + hair
    df = spark.read.parquet(f"{sf_dir}/orders.parquet").select(price.alias("price"))
    found = profile.column_profile(df, ["price"], Workspace(spark), (0.5, 0.999))
    return _rounded(found.select("column", "n_rows", "n_null", "n_distinct", "p50", "p99_9"), "p50", "p99_9", digits=2)


_WIDTH = 500
_CELLS = 10_000_000


@query(
    f"""select 'c' || i as "column", count(*) as n_rows, 0::bigint as n_null, count(distinct v) as n_distinct,
              round(avg(v), 5) as mean, round(stddev_samp(v), 5) as stddev, round(min(v)::double, 5) as min,
              round(quantile_cont(v::double, 0.25), 5) as p25, round(quantile_cont(v::double, 0.5), 5) as p50,
              round(quantile_cont(v::double, 0.75), 5) as p75, round(max(v)::double, 5) as max
       from (select i, (o_orderkey * (i + 3) + o_custkey) % (2 * i + 5) as v
             from orders cross join (select unnest(range({_WIDTH})) as i)) group by i"""
)
def wide_profile(spark, sf_dir):
    """500 number columns, counted in batches of columns.

    The two columns that they are made of are written in files of about ``_CELLS`` cells each, since a small file is read
    by one task however much is made of it.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    orders = Workspace(spark).write(orders.repartition(max(1, -(-orders.count() * _WIDTH // _CELLS))))
    wide = orders.selectExpr(*[f"(o_orderkey * {i + 3} + o_custkey) % {2 * i + 5} as c{i}" for i in range(_WIDTH)])
    return _rounded(profile.column_profile(wide, wide.columns, Workspace(spark)), *_FIGURES, digits=5)


def _values_sql(source: str, columns: list[str]) -> str:
    return " union all ".join(
        f"select '{c}' as feature, cast({c} as varchar) as value, label from {source}" for c in columns
    )


@query(
    f"""select feature, value, n_rows, rank::int as rank from (
          select feature, value, count(*) as n_rows,
                 row_number() over (partition by feature order by count(*) desc, value) as rank
          from ({_values_sql("cleaned", ["Segment", "Contract", "SeniorCitizen"])})
          where value is not null group by feature, value) where rank <= 3""",
    _CUSTOMERS,
)
def top_values(spark, sf_dir):
    return profile.top_values(profile.value_table(_cleaned(spark, sf_dir), CUSTOMERS.groups), 3)


# ---- exploration -----------------------------------------------------------------------------------------------


def _customer_counts(spark: SparkSession, sf_dir: str, columns) -> DataFrame:
    return profile.value_table(_cleaned(spark, sf_dir), columns, label_value(CUSTOMERS))


@query("select Churn, Tenure, count(*) as n_rows from cleaned where Tenure is not null group by all", _CUSTOMERS)
def tenure_histogram(spark, sf_dir):
    return explore.histogram(_cleaned(spark, sf_dir), "Tenure", "Churn")


@query(
    """select Churn, round_even(MonthlyCharges, 0) as MonthlyCharges, count(*) as n_rows
       from cleaned where MonthlyCharges is not null group by all""",
    _CUSTOMERS,
)
def charges_histogram(spark, sf_dir):
    return explore.histogram(_cleaned(spark, sf_dir), "MonthlyCharges", "Churn", rounded=True)


@query(
    """select l_returnflag, round_even(l_extendedprice, 0) as l_extendedprice, count(*) as n_rows
       from lines where l_extendedprice is not null group by all""",
    _LINES,
)
def returns_price_histogram(spark, sf_dir):
    return explore.histogram(line_returns(spark, sf_dir), "l_extendedprice", "l_returnflag", rounded=True)


def _rate_sql(source: str, columns: list[str]) -> str:
    return f"""select feature, value, count(*) as n_rows, count(*) filter (label = 1) as n_positive,
       round(avg(label), 6) as target_rate from ({_values_sql(source, columns)}) group by feature, value"""


@query(_rate_sql("cleaned", ["Segment", "Contract", "SeniorCitizen"]), _CUSTOMERS)
def target_rate_by_category(spark, sf_dir):
    return _rounded(explore.target_rate(_customer_counts(spark, sf_dir, CUSTOMERS.groups)), "target_rate")


@query(_rate_sql("docs", ["lang", "source", "toxic"]), _DOCS)
def quality_target_rate(spark, sf_dir):
    counts = profile.value_table(labelled_documents(spark, sf_dir), QUALITY.groups, label_value(QUALITY))
    return _rounded(explore.target_rate(counts), "target_rate")


@query(_rate_sql("lines", ["l_linestatus"]), _LINES)
def returns_target_rate(spark, sf_dir):
    counts = profile.value_table(line_returns(spark, sf_dir), RETURNS.groups, label_value(RETURNS))
    return _rounded(explore.target_rate(counts), "target_rate")


def _bins_sql(source: str, column: str, positive: str, bins: int) -> str:
    return f"""select '{column}' as feature, bin::int as bin, min(v)::double as low, max(v)::double as high,
       sum(n)::bigint as n_rows, sum(p)::bigint as n_positive, round(sum(p) / sum(n), 6)::double as target_rate
       from (select *, (sum(n) over (order by v rows unbounded preceding) - n) * {bins} // sum(n) over () as bin
             from (select {column} as v, count(*) as n, count(*) filter ({positive}) as p from {source} group by {column}))
       group by bin"""


@query(_bins_sql("cleaned", "TotalCharges", "label = 1", 10), _CUSTOMERS)
def rate_by_charges(spark, sf_dir):
    """Churn rate in tenths of the customers by what they paid in all; a quarter or so paid nothing and stay together."""
    counts = profile.value_table(_cleaned(spark, sf_dir), ["TotalCharges"], label_value(CUSTOMERS))
    return _rounded(explore.rate_by_bins(counts, 10, Workspace(spark)), "target_rate")


@query(_bins_sql("lines", "l_extendedprice", "label = 1", 20), _LINES)
def returns_rate_by_price(spark, sf_dir):
    """Return rate in twentieths of the order lines by price, a column of nearly as many values as rows."""
    counts = profile.value_table(line_returns(spark, sf_dir), ["l_extendedprice"], label_value(RETURNS))
    return _rounded(explore.rate_by_bins(counts, 20, Workspace(spark)), "target_rate")


def _share_sql(source: str, columns: list[str]) -> str:
    return f"""select feature, value, count(*) filter (label = 1) as n_positive,
       round(count(*) filter (label = 1) / (select sum(label) from {source}), 6) as share_of_positives,
       round(count(*) filter (label = 0) / (select sum(1 - label) from {source}), 6) as share_of_negatives
       from ({_values_sql(source, columns)}) group by feature, value"""


@query(_share_sql("cleaned", ["Segment", "Contract", "SeniorCitizen"]), _CUSTOMERS)
def class_share_by_category(spark, sf_dir):
    shares = explore.class_share(_customer_counts(spark, sf_dir, CUSTOMERS.groups))
    return _rounded(shares, "share_of_positives", "share_of_negatives")


@query(_share_sql("docs", ["lang", "source", "toxic"]), _DOCS)
def quality_class_share(spark, sf_dir):
    counts = profile.value_table(labelled_documents(spark, sf_dir), QUALITY.groups, label_value(QUALITY))
    return _rounded(explore.class_share(counts), "share_of_positives", "share_of_negatives")


def _association_sql(source: str, numbers: list[str], categories: list[str]) -> str:
    corr = [
        f"select '{c}' as feature, 'correlation' as measure, round(corr({c}, label), 6) as strength from {source}"
        for c in numbers
    ]
    # Textbook chi-squared: observed against expected counts over all value-label cells.
    cramer = [
        f"""select '{c}', 'cramers_v', round(sqrt(sum((o - e) * (o - e) / e) / max(n)), 6) from (
              select v.x, y.label, count(t.label)::double as o, max(v.nx) * max(y.ny) / max(g.n) as e, max(g.n) as n
              from (select {c} as x, count(*)::double as nx from {source} group by 1) v
              cross join (select label, count(*)::double as ny from {source} group by 1) y
              cross join (select count(*)::double as n from {source}) g
              left join {source} t on t.{c} = v.x and t.label = y.label group by v.x, y.label)"""
        for c in categories
    ]
    return " union all ".join(corr + cramer)


@query(
    _association_sql(
        "cleaned", ["SeniorCitizen", "Tenure", "MonthlyCharges", "TotalCharges"], ["Segment", "Contract"]
    ),
    _CUSTOMERS,
)
def target_association(spark, sf_dir):
    df = _cleaned(spark, sf_dir)
    found = explore.target_association(df, CUSTOMERS.numeric, CUSTOMERS.categorical, label_value(CUSTOMERS))
    return _rounded(found, "strength")


def _associations_sql(source: str, numbers: list[str], categories: list[str]) -> str:
    parts = [
        f"select '{a}' as feature, '{b}' as other, 'correlation' as measure, round(corr({a}, {b}), 6) as strength from {source}"
        for i, a in enumerate(numbers)
        for b in numbers[i + 1 :]
    ]
    parts += [
        f"""select '{x}', '{g}', 'correlation_ratio', round(sqrt(sum(n * (m - a) * (m - a)) / sum(s)), 6)
            from (select count({x}) as n, avg({x}) as m, sum(({x} - a) * ({x} - a)) as s, any_value(a) as a
                  from {source}, (select avg({x}) as a from {source}) group by {g})"""
        for x in numbers
        for g in categories
    ]
    parts += [
        f"""select '{a}', '{b}', 'cramers_v', round(sqrt((sum(n * n / (n_a * n_b)) - 1)
              / (least(count(distinct a), count(distinct b)) - 1)), 6)
            from (select a, b, n, sum(n) over (partition by a) as n_a, sum(n) over (partition by b) as n_b
                  from (select {a} as a, {b} as b, count(*)::double as n from {source} group by all))"""
        for i, a in enumerate(categories)
        for b in categories[i + 1 :]
    ]
    return " union all ".join(parts)


@query(
    _associations_sql("cleaned", ["SeniorCitizen", "Tenure", "MonthlyCharges", "TotalCharges"], ["Segment", "Contract", "Churn"]),
    _CUSTOMERS,
)
def feature_associations(spark, sf_dir):
    """How strongly any two columns of the customers go together."""
    found = explore.associations(_cleaned(spark, sf_dir), CUSTOMERS.numeric, [*CUSTOMERS.categorical, CUSTOMERS.label])
    return _rounded(found, "strength")


@query(_association_sql("lines", list(RETURNS.numeric), list(RETURNS.categorical)), _LINES)
def returns_association(spark, sf_dir):
    df = line_returns(spark, sf_dir)
    return _rounded(
        explore.target_association(df, RETURNS.numeric, RETURNS.categorical, label_value(RETURNS)), "strength"
    )


# ---- the analysis job ------------------------------------------------------------------------------------------


@query(
    " union all ".join(
        f"""select '{c}' as feature, round_even({c}::double, 0) as value, count(*) filter (label = 1) as n_positive,
                   count(*) filter (label = 0) as n_negative from cleaned group by all"""
        for c in CUSTOMERS.numeric
    ),
    _CUSTOMERS,
)
def analysis_histograms(spark, sf_dir):
    return jobs.analyse(churn_customers(spark, sf_dir), CUSTOMERS)["histograms"]


@query(_association_sql("docs", ["n_chars", "toxic"], ["lang", "source"]), _DOCS)
def analysis_association(spark, sf_dir):
    return _rounded(jobs.analyse(labelled_documents(spark, sf_dir), QUALITY)["association"], "strength")


def _analysed(name: str, sql: str, using: tuple[str, ...], *rounded: str, digits: int = 6) -> None:
    """Registers one more report of the job, as the job gives it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = churn_customers(spark, sf_dir) if using is _CUSTOMERS else labelled_documents(spark, sf_dir)
        report = jobs.analyse(df, CUSTOMERS if using is _CUSTOMERS else QUALITY)[name]
        return _rounded(report, *rounded, digits=digits)

    run.__name__ = f"analysis_{name}"
    run.__doc__ = f"The {name} report of the analysis job."
    query(sql, using)(run)


_analysed("row_count", "select count(*) as n_rows from raw", _CUSTOMERS)
_analysed("class_balance", "select Churn, count(*) as n_rows from raw group by Churn", _CUSTOMERS)
_analysed(
    "schema",
    """select unnest([1, 2, 3, 4, 5, 6])::int as position,
              unnest(['doc_id', 'lang', 'source', 'n_chars', 'quality', 'toxic']) as "column",
              unnest(['bigint', 'string', 'string', 'bigint', 'int', 'int']) as type""",
    _DOCS,
)
_analysed(
    "blanks",
    """select * from (select 'TotalCharges' as "column", count(*) filter (TotalCharges in ('', ' ')) as n_blank
                      from raw) where n_blank > 0""",
    _CUSTOMERS,
)
_analysed(
    "column_profile",
    _profile_sql(
        "cleaned", ["SeniorCitizen", "Tenure", "MonthlyCharges", "TotalCharges"], ["Segment", "Contract", "Churn"]
    ),
    _CUSTOMERS,
    *_FIGURES,
    digits=5,
)
_analysed("target_rate", _rate_sql("docs", ["lang", "source", "toxic"]), _DOCS, "target_rate")
_analysed(
    "class_share", _share_sql("docs", ["lang", "source", "toxic"]), _DOCS, "share_of_positives", "share_of_negatives"
)
_analysed(
    "top_values",
    f"""select feature, value, n_rows, rank::int as rank from (
          select feature, value, count(*) as n_rows,
                 row_number() over (partition by feature order by count(*) desc, value) as rank
          from ({_values_sql("cleaned", ["Segment", "Contract", "SeniorCitizen"])})
          where value is not null group by feature, value) where rank <= 5""",
    _CUSTOMERS,
)
