"""Run the registered queries against their SQL: python tests/run_oracles.py [sf] [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession

from __spark_entry__ import oracle_sql, queries
from tests.oracle import DATA, compare, connect

sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
names = sys.argv[2:] or list(queries())
spark = (
    SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
    .config("spark.sql.session.timeZone", "UTC").getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
sf_dir = f"{DATA}/sf{sf}"
db = connect(sf_dir)
for name in names:
    start = time.time()
    try:
        df = queries()[name](spark, sf_dir)
        if name in oracle_sql():
            outcome = compare(df, db, oracle_sql()[name]) or f"ok {df.count()}"
        else:
            outcome = f"rows only: {df.count()}"
    except Exception as problem:
        outcome = f"{type(problem).__name__} {str(problem)[:600]}"
    print(f"{name:32s} {time.time() - start:6.2f}s  {outcome}", flush=True)
spark.stop()
