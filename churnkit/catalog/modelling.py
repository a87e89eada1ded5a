"""Splits, features, training, evaluation and the jobs around them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit import sources
from churnkit.catalog.fixtures import (
    CHURN_CUSTOMERS_SQL,
    CLEAR_SQL,
    CUSTOMERS,
    LINES,
    NOISY,
    NOISY_SQL,
    QUALITY,
    QUALITY_SQL,
    RETURNS,
    RETURNS_SQL,
    SPLIT,
    churn_customers,
    clear_customers,
    labelled_documents,
    line_returns,
    noisy_orders,
    ordered_lines,
    position_sql,
    table,
)
from churnkit.catalog.registry import query
from churnkit.functions import label_value
from churnkit.operators import evaluate, features, profile, split
from churnkit.operators.clean import clean
from churnkit.operators.train import Search, search
from churnkit.plans import jobs
from churnkit.sources import Workspace
from churnkit.spec import BENCHMARK, CHOSEN, MIN_RECALL, SplitSpec, TableSpec, TrainSpec

_SPLIT_AT, _SAMPLE_AT, _FOLD_AT = (position_sql("CustomerId", part) for part in range(3))
_ORDER_SPLIT_AT, _ORDER_SAMPLE_AT = (position_sql("l_orderkey", part) for part in range(2))
_DOC_SPLIT_AT = position_sql("doc_id", 0)

_CUSTOMERS = (CHURN_CUSTOMERS_SQL,)
_MARKED = (
    CHURN_CUSTOMERS_SQL,
    f"marked as (select *, case when {_SPLIT_AT} <= {SPLIT.train_ratio} then 'train' else 'test' end as side "
    "from cleaned)",
)
_LINES = (RETURNS_SQL,)


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(churn_customers(spark, sf_dir), CUSTOMERS)


# ---- split, sample, folds --------------------------------------------------------------------------------------


@query("select CustomerId, side from marked", _MARKED)
def train_test_split(spark, sf_dir):
    return split.with_side(_cleaned(spark, sf_dir), CUSTOMERS, SPLIT).select("CustomerId", "side")


@query("select side, count(*) as n_rows from marked group by side", _MARKED)
def split_sizes(spark, sf_dir):
    return split.split_sizes(_cleaned(spark, sf_dir), CUSTOMERS, SPLIT)


@query(
    f"""select case when {_ORDER_SPLIT_AT} <= {SPLIT.train_ratio} then 'train' else 'test' end as side,
               count(*) as n_rows from lines group by 1""",
    _LINES,
)
def returns_split_sizes(spark, sf_dir):
    return split.split_sizes(line_returns(spark, sf_dir), RETURNS, SPLIT)


@query(f"select CustomerId, Churn from cleaned where label = 1 or {_SAMPLE_AT} < 0.4", _CUSTOMERS)
def undersample(spark, sf_dir):
    kept = split.undersample(_cleaned(spark, sf_dir), label_value(CUSTOMERS), CUSTOMERS, SPLIT, 0.4)
    return kept.select("CustomerId", "Churn")


@query(
    f"""select l_returnflag, count(*) as n_rows from lines where label = 1 or {_ORDER_SAMPLE_AT} < 0.4
        group by l_returnflag""",
    _LINES,
)
def returns_undersampled_balance(spark, sf_dir):
    kept = split.undersample(line_returns(spark, sf_dir), label_value(RETURNS), RETURNS, SPLIT, 0.4)
    return kept.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"))


@query(f"select CustomerId, cast(floor({_FOLD_AT} * {SPLIT.folds}) as int) as fold from cleaned", _CUSTOMERS)
def cv_folds(spark, sf_dir):
    return split.with_folds(_cleaned(spark, sf_dir), CUSTOMERS, SPLIT).select("CustomerId", "fold")


# ---- features --------------------------------------------------------------------------------------------------


def _labels_sql(source: str, columns: list[str], where: str = "true") -> str:
    values = " union all ".join(
        f"select '{c}' as feature, cast({c} as varchar) as value from {source} where {where}" for c in columns
    )
    return f"""select feature, value, count(*) as n_rows,
       (row_number() over (partition by feature order by count(*) desc, value) - 1)::double as index
       from ({values}) where value is not null group by feature, value"""


@query(_labels_sql("cleaned", ["Segment", "Contract"]), _CUSTOMERS)
def string_index_labels(spark, sf_dir):
    return features.index_labels(_cleaned(spark, sf_dir), CUSTOMERS.categorical, Workspace(spark))


@query(_labels_sql("docs", ["lang", "source"]), (QUALITY_SQL,))
def quality_index_labels(spark, sf_dir):
    return features.index_labels(labelled_documents(spark, sf_dir), QUALITY.categorical, Workspace(spark))


@query(
    """select 'o_custkey' as feature, cast(o_custkey as varchar) as value, count(*) as n_rows,
              (row_number() over (order by count(*) desc, cast(o_custkey as varchar)) - 1)::double as index
       from orders where o_custkey is not null group by o_custkey"""
)
def wide_index_labels(spark, sf_dir):
    """Codes of a column with as many values as there are customers with orders."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("o_custkey"))
    return features.index_labels(orders, ["o_custkey"], Workspace(spark))


@query(
    """with codes as (select cast(o_custkey as varchar) as v,
                             (row_number() over (order by count(*) desc, cast(o_custkey as varchar)) - 1)::double as code
                      from orders group by o_custkey)
       select o_orderkey, code as o_custkey from orders join codes on v = cast(o_custkey as varchar)"""
)
def wide_index_values(spark, sf_dir):
    """The same codes put into the rows, joined as a table since no list of them is held."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"))
    coded = features.fit_index(orders, ["o_custkey"], Workspace(spark), handle_invalid="error", listed=100)
    return features.swap_indexed(coded.transform(orders), ["o_custkey"])


@query(
    """select feature, value, n_rows, rank::int as rank from (
         select 'l_suppkey' as feature, cast(l_suppkey as varchar) as value, count(*) as n_rows,
                row_number() over (order by count(*) desc, cast(l_suppkey as varchar)) as rank
         from lineitem group by l_suppkey) where rank <= 5000"""
)
def top_values_many(spark, sf_dir):
    """More top values than Spark's group limit takes."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("l_suppkey"))
    return profile.top_values(profile.value_table(lines, ["l_suppkey"]), 5000, Workspace(spark))


@query(
    """select c.CustomerId, s.index as Segment, k.index as Contract from cleaned c
       join codes s on s.feature = 'Segment' and s.value = c.Segment
       join codes k on k.feature = 'Contract' and k.value = c.Contract""",
    (CHURN_CUSTOMERS_SQL, f"codes as ({_labels_sql('cleaned', ['Segment', 'Contract'])})"),
)
def string_index_values(spark, sf_dir):
    df = _cleaned(spark, sf_dir)
    coded = features.fit_index(df, CUSTOMERS.categorical, Workspace(spark), handle_invalid="error").transform(df)
    return features.swap_indexed(coded, CUSTOMERS.categorical).select("CustomerId", *CUSTOMERS.categorical)


@query(
    f"""select f.feature as "column", f.position::int as position, count(c.value) as n_codes from (
          select unnest(['SeniorCitizen', 'Tenure', 'MonthlyCharges', 'TotalCharges', 'Segment', 'Contract']) as feature,
                 unnest([1, 2, 3, 4, 5, 6]) as position) f
        left join ({_labels_sql("marked", ["Segment", "Contract"], "side = 'train'")}) c on c.feature = f.feature
        group by all""",
    _MARKED,
)
def feature_columns(spark, sf_dir):
    """Model inputs in order, text ones with the number of codes learnt from the training rows."""
    train, _ = split.train_test_split(_cleaned(spark, sf_dir), CUSTOMERS, SPLIT)
    codes = features.index_labels(train, CUSTOMERS.categorical, Workspace(spark))
    names = replace(CUSTOMERS, numeric=None, categorical=None).resolve(train).features
    listed = sources.rows_table(
        spark, [{"column": c, "position": i + 1} for i, c in enumerate(names)], "column string, position int"
    )
    n_codes = codes.groupBy(F.col("feature").alias("column")).agg(F.count(F.lit(1)).alias("n_codes"))
    return listed.join(n_codes, "column", "left").fillna(0, ["n_codes"])


def _unpacked(vectors: DataFrame, spec: TableSpec = CUSTOMERS) -> DataFrame:
    """One column per vector slot, for engines that know no vectors."""
    slots = vector_to_array(features.FEATURES)
    return vectors.select(*spec.keys, "label", *[slots[i].alias(c) for i, c in enumerate(spec.features)])


@query(
    """select doc_id, label, n_chars::double as n_chars, toxic::double as toxic,
              coalesce(g.index, (select count(*) from codes where feature = 'lang'))::double as lang,
              coalesce(s.index, (select count(*) from codes where feature = 'source'))::double as source
       from docs d
       left join codes g on g.feature = 'lang' and g.value = d.lang
       left join codes s on s.feature = 'source' and s.value = d.source""",
    (QUALITY_SQL, f"codes as ({_labels_sql('docs', ['lang', 'source'], f'{_DOC_SPLIT_AT} <= {SPLIT.train_ratio}')})"),
)
def quality_feature_matrix(spark, sf_dir):
    """Categories of 4 and 20 values; on small tables some occur in the held-out rows only."""
    return _unpacked(jobs.prepare(labelled_documents(spark, sf_dir), QUALITY, SPLIT).table, QUALITY)


_ORDERS = TableSpec(("o_orderkey",), "o_orderstatus", "F")


@query(
    """select o_orderkey, case when o_orderstatus = 'F' then 1.0 else 0.0 end::double as label,
              cast(o_totalprice >= 150000 as int)::double as is_large, o_totalprice::double as o_totalprice
       from orders"""
)
def boolean_feature_matrix(spark, sf_dir):
    """A boolean is an input like any number, found by its type."""
    is_large = (F.col("o_totalprice") >= 150000).alias("is_large")
    raw = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", is_large, "o_totalprice")
    prepared = jobs.prepare(raw, _ORDERS, SPLIT)
    return _unpacked(prepared.table, prepared.spec)


# ---- categories of any width as bins ---------------------------------------------------------------------------

_LINE_KEY = "concat_ws(':', l_orderkey, l_linenumber)"
_BINS = features.MAX_BINS - 1
# Each line's fold is where its bin is looked up: its own when it is trained on, one behind the last for all others.
_BINNED_LINES = (
    f"""lines as (
  select l_orderkey, l_linenumber, cast(l_orderkey as varchar) as value, (l_returnflag = 'R')::int as y,
         {position_sql(_LINE_KEY, 0)} <= {SPLIT.train_ratio} as is_train,
         cast(floor({position_sql(_LINE_KEY, 2)} * {SPLIT.folds}) as int) as own
  from lineitem
)""",
    f"""learnt as (
  select k as fold, value, count(*) as n, sum(y) as p
  from lines join (select unnest(range({SPLIT.folds + 1})) as k) on is_train and own <> k group by k, value
)""",
    f"""bins as (
  select fold, value, n, p, (sum(n) over (partition by fold order by share, value rows unbounded preceding) - n) * {_BINS} // n_all as bin
  from (select *, (p * n_all + 10 * p_all)::double / (n_all * (n + 10))::double as share
        from learnt join (select fold, sum(n) as n_all, sum(p) as p_all from learnt group by fold) using (fold))
)""",
    f"""binned as (
  select l_orderkey, l_linenumber, y, is_train, coalesce(bin, {_BINS})::int as bin
  from lines left join bins on bins.value = lines.value and bins.fold = case when is_train then own else {SPLIT.folds} end
)""",
)


@query(
    """select 'order_name' as feature, fold::int as fold, value, n::bigint as n_rows, p::bigint as n_positive, bin::int as bin
       from bins""",
    _BINNED_LINES,
)
def wide_category_bins(spark, sf_dir):
    """Bins of a column with about as many values as there are orders, learnt out of fold."""
    prepared = jobs.prepare(ordered_lines(spark, sf_dir), LINES, SPLIT)
    return prepared.model.bins.table


@query("select l_orderkey, l_linenumber, bin from binned", _BINNED_LINES)
def wide_category_values(spark, sf_dir):
    """The bin of every line; orders that no training row knows have the last one."""
    prepared = jobs.prepare(ordered_lines(spark, sf_dir), LINES, SPLIT)
    found = prepared.model.bins.transform(prepared.rows)
    return found.select("l_orderkey", "l_linenumber", F.col("order_name_bin").cast("int").alias("bin"))


_STUMP = {"numTrees": 1, "maxDepth": 1, "bootstrap": False, "featureSubsetStrategy": "all", "subsamplingRate": 1.0}


@query(
    """select h.bin, case when 2 * side_p > side_n then 1.0 else 0.0 end::double as prediction, count(*) as n_rows
       from binned h join sides on sides.bin = h.bin where not h.is_train group by all""",
    (
        *_BINNED_LINES,
        f"""places as (
  select bin, coalesce(n, 0) as n, coalesce(p, 0) as p,
         row_number() over (order by coalesce(n, 0) = 0, coalesce(p, 0), bin) as place
  from (select unnest(range({_BINS + 1})) as bin)
  left join (select bin, count(*) as n, sum(y) as p from binned where is_train group by bin) using (bin)
)""",
        """cuts as (
  select place, l_n, l_p, a_n - l_n as r_n, a_p - l_p as r_p, a_n
  from (select place, sum(n) over (order by place) as l_n, sum(p) over (order by place) as l_p,
               sum(n) over () as a_n, sum(p) over () as a_p from places)
  where l_n > 0 and a_n > l_n
)""",
        """best as (
  select place from cuts
  order by l_n / a_n * 2 * (l_p / l_n) * (1 - l_p / l_n) + r_n / a_n * 2 * (r_p / r_n) * (1 - r_p / r_n), place limit 1
)""",
        """sides as (
  select bin, sum(p) over (partition by is_left) as side_p, sum(n) over (partition by is_left) as side_n
  from (select *, place <= (select place from best) as is_left from places)
)""",
    ),
)
def wide_category_forest(spark, sf_dir):
    """A tree with one split on the bins of a column too wide for it: the best cut of bins ordered by positives."""
    prepared = jobs.prepare(ordered_lines(spark, sf_dir), LINES, SPLIT)
    model = search(prepared.train, TrainSpec("RandomForest", fixed=_STUMP), SPLIT, validate=False).model
    slot = vector_to_array(features.BINNED)[0].cast("int").alias("bin")
    said = jobs.predict(model, prepared.test).select(slot, "prediction")
    return said.groupBy("bin", "prediction").agg(F.count(F.lit(1)).alias("n_rows"))


_MATRIX_SQL = """select CustomerId, label, SeniorCitizen::double as SeniorCitizen, Tenure::double as Tenure,
       MonthlyCharges, TotalCharges,
       coalesce(s.index, (select count(*) from codes where feature = 'Segment'))::double as Segment,
       coalesce(k.index, (select count(*) from codes where feature = 'Contract'))::double as Contract
       from marked m
       left join codes s on s.feature = 'Segment' and s.value = m.Segment
       left join codes k on k.feature = 'Contract' and k.value = m.Contract"""
_MATRIX_USING = (*_MARKED, f"codes as ({_labels_sql('marked', ['Segment', 'Contract'], "side = 'train'")})")


@query(_MATRIX_SQL, _MATRIX_USING)
def feature_matrix(spark, sf_dir):
    return _unpacked(jobs.prepare(churn_customers(spark, sf_dir), CUSTOMERS, SPLIT).table)


@query(_MATRIX_SQL, _MATRIX_USING)
def features_parquet_roundtrip(spark, sf_dir):
    path = Workspace(spark).folder()
    sources.write_parquet(jobs.prepare(churn_customers(spark, sf_dir), CUSTOMERS, SPLIT).table, path)
    return _unpacked(spark.read.parquet(path))


# ---- evaluation by fixed rules ---------------------------------------------------------------------------------

# The same text is Spark SQL and the oracle's SQL.
_RULES = {
    "short_tenure": "Tenure < 60",
    "high_charges": "MonthlyCharges >= 150",
    "one_segment": "Segment = 'BUILDING'",
    "everyone": "Tenure >= 0",
}


def _rule_counts(df: DataFrame) -> DataFrame:
    said = {name: F.expr(rule).cast("double") for name, rule in _RULES.items()}
    return evaluate.confusion_counts(df, label_value(CUSTOMERS), said)


def _rule_rows_sql(source: str) -> str:
    return " union all ".join(
        f"select '{name}' as model, label, case when {rule} then 1.0 else 0.0 end::double as said from {source}"
        for name, rule in _RULES.items()
    )


_COUNTS = f"""counts as (
  select model, count(*) filter (label = 1 and said = 1) as tp, count(*) filter (label = 0 and said = 1) as fp,
         count(*) filter (label = 1 and said = 0) as fn, count(*) filter (label = 0 and said = 0) as tn
  from ({_rule_rows_sql("marked where side = 'test'")}) group by model
)"""
_METRICS = """metrics as (
  select model, tp, fp, fn, tn, (tp + tn) / (tp + fp + fn + tn) as accuracy,
         case when tp + fp > 0 then tp / (tp + fp) end as precision,
         case when tp + fn > 0 then tp / (tp + fn) end as recall,
         coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) as f1_positive,
         ((tp + fn) * coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)
          + (fp + tn) * coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0)) / (tp + fp + fn + tn) as f1_weighted
  from counts
)"""
_ROUNDED_SQL = ", ".join(
    f"round({m}::double, 6) as {m}" for m in ("accuracy", "precision", "recall", "f1_positive", "f1_weighted")
)
_EVALUATED = (*_MARKED, _COUNTS, _METRICS)


def _holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.train_test_split(_cleaned(spark, sf_dir), CUSTOMERS, SPLIT)[1]


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.with_metrics(_rule_counts(_holdout(spark, sf_dir)))


def _rounded_metrics(df: DataFrame) -> DataFrame:
    names = ("accuracy", "precision", "recall", "f1_positive", "f1_weighted")
    return df.withColumns({m: F.round(F.col(m), 6) for m in names})


@query(
    """select model, 1.0::double as Churn, 1.0::double as prediction, tp as count from counts
       union all select model, 0.0::double, 1.0::double, fp from counts
       union all select model, 1.0::double, 0.0::double, fn from counts
       union all select model, 0.0::double, 0.0::double, tn from counts""",
    (*_MARKED, _COUNTS),
)
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(_rule_counts(_holdout(spark, sf_dir)))


@query(f"select model, tp, fp, fn, tn, {_ROUNDED_SQL} from metrics", _EVALUATED)
def eval_metrics(spark, sf_dir):
    return _rounded_metrics(_metrics(spark, sf_dir))


@query(
    f"""select model, tp, fp, fn, tn, {_ROUNDED_SQL} from metrics where recall >= {MIN_RECALL}
        order by metrics.recall desc, metrics.f1_weighted desc, model limit 1""",
    _EVALUATED,
)
def select_model(spark, sf_dir):
    return _rounded_metrics(evaluate.select_model(_metrics(spark, sf_dir), MIN_RECALL))


# The same text is Spark SQL and the oracle's SQL.
_SCORES = {"tenure": "1.0 / (1 + Tenure)", "charges": "least(MonthlyCharges / 500.0, 1.0)"}


@query(
    f"""select model, threshold, tp::bigint as tp, fp::bigint as fp, round(tp / positives, 6)::double as recall,
               round(tp / (tp + fp), 6)::double as precision
        from (select *, row_number() over (partition by model order by threshold desc) as place
              from curve where tp / positives >= {MIN_RECALL}) where place = 1""",
    (
        *_MARKED,
        "cells as (select model, least(floor(score * 1000), 999) as cell, sum(label) as p, sum(1 - label) as n from ("
        + " union all ".join(
            f"select '{name}' as model, label, ({score})::double as score from marked where side = 'test'"
            for name, score in _SCORES.items()
        )
        + ") group by all)",
        """curve as (
  select model, cell / 1000.0::double as threshold, sum(p) over (partition by model order by cell desc) as tp,
         sum(n) over (partition by model order by cell desc) as fp, sum(p) over (partition by model) as positives from cells
)""",
    ),
)
def recall_thresholds(spark, sf_dir):
    """The highest score that reaches the required recall, from a histogram of scores."""
    scores = {name: F.expr(score).cast("double") for name, score in _SCORES.items()}
    histogram = evaluate.score_histogram(_holdout(spark, sf_dir), label_value(CUSTOMERS), scores)
    found = evaluate.reaching(evaluate.threshold_curve(histogram), MIN_RECALL)
    return found.withColumns({m: F.round(m, 6) for m in ("recall", "precision")})


@query(
    """select 'lines' as model, count(*) filter (label = 1 and l_quantity > 25) as tp,
              count(*) filter (label = 0 and l_quantity > 25) as fp,
              count(*) filter (label = 1 and l_quantity <= 25) as fn,
              count(*) filter (label = 0 and l_quantity <= 25) as tn from lines""",
    _LINES,
)
def returns_confusion(spark, sf_dir):
    said = {"lines": (F.col("l_quantity") > 25).cast("double")}
    return evaluate.confusion_counts(line_returns(spark, sf_dir), label_value(RETURNS), said)


# ---- sinks -----------------------------------------------------------------------------------------------------


@query(
    """select model, round(accuracy::double, 6) as accuracy, cell.*  from metrics, (
         select m2, unnest([{'Churn': 1.0::double, 'prediction': 1.0::double, 'count': tp},
                            {'Churn': 0.0::double, 'prediction': 1.0::double, 'count': fp},
                            {'Churn': 1.0::double, 'prediction': 0.0::double, 'count': fn},
                            {'Churn': 0.0::double, 'prediction': 0.0::double, 'count': tn}]) as cell
         from (select model as m2, tp, fp, fn, tn from counts)) where m2 = model""",
    _EVALUATED,
)
def json_roundtrip(spark, sf_dir):
    """Metrics with the nested matrix, written as one JSON file and read back."""
    path = Workspace(spark).folder()
    board = _metrics(spark, sf_dir).select(
        "model", "accuracy", evaluate.matrix_column().alias("confusion_matrix")
    )
    sources.write_json(board, path, files=1)
    back = spark.read.schema(board.schema).json(path)
    return back.select("model", F.round("accuracy", 6).alias("accuracy"), F.inline("confusion_matrix"))


@query(
    """select CustomerId, Segment, Contract, SeniorCitizen, Tenure, MonthlyCharges, TotalCharges, Churn,
              case when Tenure < 60 then 1.0 else 0.0 end::double as prediction
       from marked where side = 'test'""",
    _MARKED,
)
def scored_csv_roundtrip(spark, sf_dir):
    """Held-out rows scored by a rule, written as CSV and read back."""
    path = Workspace(spark).folder()
    said = F.expr(_RULES["short_tenure"]).cast("double").alias("prediction")
    scored = _holdout(spark, sf_dir).select("*", said)
    sources.write_csv(scored, path)
    return sources.read_csv(spark, path, scored.schema)


# ---- fitted models ---------------------------------------------------------------------------------------------

# The cells that the published comparison chose among, one of each algorithm, and a small grid for the search.
_LOGISTIC = TrainSpec("LogisticRegression", {"maxIter": (75, 100), "regParam": (0.1, 0.001)})
_LOGISTIC_ONE = TrainSpec("LogisticRegression", {"maxIter": (250,), "regParam": (0.001,)})
_FOREST_ONE = TrainSpec("RandomForest", {"featureSubsetStrategy": ("2",), "numTrees": (100,)}, undersample=0.4)
_BOARD = (_LOGISTIC_ONE, replace(_LOGISTIC_ONE, undersample=0.4), CHOSEN, _FOREST_ONE)

# On customers whose label is clear, every classifier has to give each held-out row its own label.
_CLEAR = (CLEAR_SQL, f"held as (select * from clear where {_SPLIT_AT} > {SPLIT.train_ratio})")
_CLEAR_ROWS = "select CustomerId, label as prediction from held"


def _clear_predictions(spark: SparkSession, sf_dir: str, spec: TrainSpec) -> DataFrame:
    scored = jobs.train_and_score(clear_customers(spark, sf_dir), CUSTOMERS, spec, SPLIT)
    return scored.rows.select("CustomerId", "prediction")


@query(_CLEAR_ROWS, _CLEAR)
def train_logistic(spark, sf_dir):
    return _clear_predictions(spark, sf_dir, _LOGISTIC_ONE)


@query(_CLEAR_ROWS, _CLEAR)
def train_svm(spark, sf_dir):
    return _clear_predictions(spark, sf_dir, CHOSEN)


@query(_CLEAR_ROWS, _CLEAR)
def train_forest(spark, sf_dir):
    return _clear_predictions(spark, sf_dir, _FOREST_ONE)


@query("select CustomerId from cleaned where false", (CHURN_CUSTOMERS_SQL,))
def svm_signs(spark, sf_dir):
    """Held-out real customers whose SVM prediction is not the sign of the stored plane: none."""
    prepared = jobs.prepare(churn_customers(spark, sf_dir), CUSTOMERS, SPLIT)
    model = search(prepared.train, CHOSEN, SPLIT, validate=False).model
    slots = vector_to_array(features.FEATURES)
    margin = F.lit(float(model.intercept))
    for i, weight in enumerate(model.coefficients.toArray().tolist()):
        margin = margin + slots[i] * F.lit(weight)
    scored = jobs.predict(model, prepared.test)
    return scored.where(F.col("prediction") != (margin > 0).cast("double")).select("CustomerId")


@query(
    """select Senior::double as SeniorCitizen, case when 2 * sum(label) > count(*) then 1.0 else 0.0 end::double as prediction
       from (select SeniorCitizen as Senior, label from marked where side = 'train') group by Senior""",
    _MARKED,
)
def stump_majorities(spark, sf_dir):
    """A forest of one tree with one split on a 0/1 column, without bootstrap: each side gets its majority."""
    raw = churn_customers(spark, sf_dir).select("customerID", "segment", "tenure", "SeniorCitizen", "TotalCharges", "Churn")
    spec = replace(CUSTOMERS, numeric=("SeniorCitizen",), categorical=())
    prepared = jobs.prepare(raw, spec, SPLIT)
    model = search(prepared.train, TrainSpec("RandomForest", fixed=_STUMP), SPLIT, validate=False).model
    said = jobs.predict(model, prepared.table)
    return said.select(F.col("SeniorCitizen").cast("double").alias("SeniorCitizen"), "prediction").distinct()


@query(
    """select unnest(['label', 'SeniorCitizen', 'Tenure', 'MonthlyCharges', 'TotalCharges']) as feature,
              unnest([round(avg(label), 4), round(avg(label * SeniorCitizen) / avg(SeniorCitizen), 4),
                      round(avg(label * Tenure) / avg(Tenure), 4),
                      round(avg(label * MonthlyCharges) / avg(MonthlyCharges), 4),
                      round(avg(label * TotalCharges) / avg(TotalCharges), 4)]) as churner_share
       from marked where side = 'train'""",
    _MARKED,
)
def logistic_score_equations(spark, sf_dir):
    """An unpenalised logistic fit is right exactly when its probabilities reproduce the label's weighted means.

    The probabilities come from the model, the means that they must match come from SQL.
    """
    prepared = jobs.prepare(churn_customers(spark, sf_dir), CUSTOMERS, SPLIT)
    exact = TrainSpec("LogisticRegression", {}, fixed={"maxIter": 500, "regParam": 0.0, "tol": 1e-12})
    scored = search(prepared.train, exact, SPLIT, validate=False).model.transform(prepared.train)
    chance, slots = vector_to_array("probability")[1], vector_to_array(features.FEATURES)
    shares = scored.agg(
        F.avg(chance).alias("label"),
        *[(F.avg(chance * slots[i]) / F.avg(slots[i])).alias(c) for i, c in enumerate(CUSTOMERS.numeric)],
    )
    cells = [
        F.struct(F.lit(c).alias("feature"), F.round(c, 4).alias("churner_share"))
        for c in ("label", *CUSTOMERS.numeric)
    ]
    return shares.select(F.inline(F.array(*cells)))


# What cross-validation has to find on noisy orders, in SQL. ``x`` is the one input, ``y`` the label. A logistic fit with
# penalty r on the standardised input has margins u at x = 1 and v at x = 0, at the least of
#   n1 (loss(u) - p1 u) + n0 (loss(v) - p0 v) + N r s2 (u - v)^2 / 2,  s2 the variance of x.
# It is convex, so u > 0 exactly if the least over v falls with u at u = 0, which its gradient in v at -t decides, and v
# likewise. With p1 > 1/2 > p0 that gives the two conditions below, without iterating.
_FOLDS = (
    NOISY_SQL,
    f"""marked as (
  select x, y, cast(floor({position_sql("o_orderkey", 2)} * {SPLIT.folds}) as int) as own
  from noisy where {position_sql("o_orderkey", 0)} <= {SPLIT.train_ratio}
)""",
    f"""fitted as (
  select k as fold, count(*) as n, count(*) filter (x) as n1, count(*) filter (not x) as n0,
         avg(y::int) filter (x) as p1, avg(y::int) filter (not x) as p0, avg(y::int) as p, var_samp(x::int) as s2
  from marked join (select unnest(range({SPLIT.folds})) as k) on own <> k group by k
)""",
    """held as (
  select own as fold, count(*) filter (x and y) as y1, count(*) filter (x and not y) as z1,
         count(*) filter (not x and y) as y0, count(*) filter (not x and not y) as z0 from marked group by own
)""",
)
_FOLD_F1 = """scored as (
  select *, ((tp + fn) * coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)
             + (fp + tn) * coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0)) / (tp + fp + fn + tn) as f1
  from (select said.*, s1 * y1 + s0 * y0 as tp, s1 * z1 + s0 * z0 as fp,
               (1 - s1) * y1 + (1 - s0) * y0 as fn, (1 - s1) * z1 + (1 - s0) * z0 as tn from said join held using (fold))
)"""
_LINEAR_CELLS = ", ".join(
    f"({i}, {m}, {r})"
    for i, (m, r) in enumerate((m, r) for m in BENCHMARK[0].grid["maxIter"] for r in BENCHMARK[0].grid["regParam"])
)
_LOGISTIC_FOLDS = (
    *_FOLDS,
    f"cells as (select * from (values {_LINEAR_CELLS}) as c(cell, m, r))",
    """said as (
  select fold, cell, m, r, (n0 * (1 / (1 + exp(t)) - p0) < n1 * (p1 - 0.5))::int as s1,
         (n1 * (1 / (1 + exp(-w)) - p1) + n0 * (0.5 - p0) <= 0)::int as s0
  from (select *, n1 * (p1 - 0.5) / (n * r * s2) as t, n0 * (0.5 - p0) / (n * r * s2) as w from fitted cross join cells)
)""",
    _FOLD_F1,
)


def _noisy_search(spark: SparkSession, sf_dir: str, spec: TrainSpec) -> Search:
    prepared = jobs.prepare(noisy_orders(spark, sf_dir), NOISY, SPLIT)
    train = prepared.workspace.write(prepared.train.hint("rebalance", F.col("fold")), ["fold"])
    return search(train, spec, SPLIT, parallelism=8)


@query(
    """select cell::int as cell, m::int as maxIter, r::double as regParam, mean_f1,
              cell = first_value(cell) over (order by mean_f1 desc, cell) as is_best
       from (select cell, m, r, round(avg(f1), 9)::double as mean_f1 from scored group by cell, m, r)""",
    _LOGISTIC_FOLDS,
)
def cv_search(spark, sf_dir):
    """The whole published grid of the linear models, its mean scores over three folds, and the cell that wins."""
    found = _noisy_search(spark, sf_dir, BENCHMARK[0])
    rows = [
        {"cell": i, **cell, "mean_f1": round(found.scores[i], 9), "is_best": i == found.best}
        for i, cell in enumerate(found.cells)
    ]
    return sources.rows_table(
        spark, rows, "cell int, maxIter int, regParam double, mean_f1 double, is_best boolean"
    )


def _fold_rows(found: Search) -> list[dict]:
    return [
        {"fold": k, "cell": i, "f1": round(f1, 9)} for k, scores in enumerate(found.folds) for i, f1 in enumerate(scores)
    ]


@query("select fold::int as fold, cell::int as cell, round(f1, 9)::double as f1 from scored", _LOGISTIC_FOLDS)
def cv_fold_scores(spark, sf_dir):
    """The scores behind the means, fold by fold."""
    found = _noisy_search(spark, sf_dir, BENCHMARK[0])
    return sources.rows_table(spark, _fold_rows(found), "fold int, cell int, f1 double")


@query(
    "select fold::int as fold, cell::int as cell, round(f1, 9)::double as f1 from scored",
    (
        *_FOLDS,
        """said as (
  select fold, 0 as cell, (p > 0.5)::int as s1, (p > 0.5)::int as s0 from fitted
  union all select fold, 1, (p1 > 0.5)::int, (p0 > 0.5)::int from fitted
)""",
        _FOLD_F1,
    ),
)
def forest_fold_scores(spark, sf_dir):
    """Trees without a split say what most rows are, trees with one say what most rows on each side are."""
    fixed = {k: v for k, v in _STUMP.items() if k != "maxDepth"}
    found = _noisy_search(spark, sf_dir, TrainSpec("RandomForest", {"maxDepth": (0, 1)}, fixed=fixed))
    return sources.rows_table(spark, _fold_rows(found), "fold int, cell int, f1 double")


def _board(raw: DataFrame, specs: tuple[TrainSpec, ...] = _BOARD) -> DataFrame:
    return jobs.benchmark(raw, CUSTOMERS, specs, SPLIT, parallelism=8)


_SPECS_SQL = """select unnest([0, 1, 2, 3])::int as position,
       unnest(['LogisticRegression', 'LogisticRegression', 'SVM', 'RandomForest']) as algorithm"""


@query(
    f"""select s.position, s.algorithm, 1.0::double as cv_f1, tp, 0::bigint as fp, 0::bigint as fn, tn, 1.0::double as recall,
               1.0::double as accuracy, 1.0::double as f1_weighted
        from ({_SPECS_SQL}) s cross join (select count(*) filter (label = 1) as tp, count(*) filter (label = 0) as tn from held)""",
    _CLEAR,
)
def clear_leaderboard(spark, sf_dir):
    """The benchmark job on the clear label: every model of the published cells is perfect, in the folds and held out."""
    board = _board(clear_customers(spark, sf_dir))
    cells = {n: F.col("confusion_matrix")[i]["count"].alias(n) for i, n in enumerate(("tp", "fp", "fn", "tn"))}
    metrics = ("cv_f1", "recall", "accuracy", "f1_weighted")
    return board.select("position", "algorithm", *[F.round(m, 9).alias(m) for m in metrics], *cells.values())


@query(
    f"""select s.position, s.algorithm, n_positive, n_negative
        from ({_SPECS_SQL}) s cross join (select count(*) filter (label = 1) as n_positive,
          count(*) filter (label = 0) as n_negative from marked where side = 'test')""",
    _MARKED,
)
def model_leaderboard(spark, sf_dir):
    """The whole published comparison on the real customers, 105 cells: how many held-out rows of either class each
    chosen model was measured on."""
    board = _board(churn_customers(spark, sf_dir), BENCHMARK)
    count = [F.col("confusion_matrix")[i]["count"] for i in range(4)]
    return board.select(
        "position",
        "algorithm",
        (count[0] + count[2]).alias("n_positive"),
        (count[1] + count[3]).alias("n_negative"),
    )


_SCORED_COLUMNS = "CustomerId, Segment, SeniorCitizen, Tenure, Contract, MonthlyCharges, TotalCharges, Churn"


@query(f"select {_SCORED_COLUMNS}, label as prediction from held", _CLEAR)
def score_holdout(spark, sf_dir):
    """The train-and-score job: all held-out rows with their original columns and the prediction."""
    return jobs.train_and_score(clear_customers(spark, sf_dir), CUSTOMERS, CHOSEN, SPLIT).rows


@query(f"select {_SCORED_COLUMNS}, label as prediction from clear", (CLEAR_SQL,))
def score_all(spark, sf_dir):
    """The same for every row."""
    return jobs.train_and_score(clear_customers(spark, sf_dir), CUSTOMERS, CHOSEN, SPLIT, score_on="all").rows


@query(_CLEAR_ROWS, _CLEAR)
def choose_and_train(spark, sf_dir):
    """From a written leaderboard to scored rows: the best model's cell is read back and trained."""
    path, clear = Workspace(spark).folder(), clear_customers(spark, sf_dir)
    specs = (_LOGISTIC,)
    jobs.write_leaderboard(jobs.benchmark(clear, CUSTOMERS, specs, SPLIT), path)
    chosen = jobs.choose(jobs.read_leaderboard(spark, path, CUSTOMERS.label), specs, MIN_RECALL)
    return jobs.train_and_score(clear, CUSTOMERS, chosen, SPLIT).rows.select("CustomerId", "prediction")
