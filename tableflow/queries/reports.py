"""CSV reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableflow.operators.report import report_lines
from tableflow.plans.report import report_job
from tableflow.queries.registry import load, query, view
from tableflow.scratch import scratch_dir

_LINE = """concat_ws(',', cast(c_custkey as varchar), c_name, cast(c_acctbal as varchar),
                     coalesce(nullif(c_mktsegment, 'BUILDING'), 'null'))"""


@query(f"select {_LINE} as line from customer")
def q_report_csv_lines(spark, sf_dir):
    rows = load(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_acctbal",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"))
    return report_lines(rows)


@query("""select cast(o_orderkey as varchar) || ',' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.0')
                 as line from orders""")
def q_report_timestamp_lines(spark, sf_dir):
    return report_lines(load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"))


@query(f"""select {_LINE} as line from customer
           union all select 'c_custkey,c_name,c_acctbal,segment'""")
def q_report_text_job(spark, sf_dir):
    path, customer = scratch_dir(spark, "report"), view(spark, sf_dir, "customer")
    report_job(spark, f"""select c_custkey, c_name, c_acctbal,
                                 nullif(c_mktsegment, 'BUILDING') as segment
                          from {customer} order by c_custkey""", path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("""select cast(doc_id as varchar) as doc_id, text, nullif(lang, 'en') as lang
          from documents""")
def q_report_csv_file(spark, sf_dir):
    path, documents = scratch_dir(spark, "report"), view(spark, sf_dir, "documents")
    report_job(spark, f"select doc_id, text, nullif(lang, 'en') as lang from {documents}", path,
               plain=False)
    return (spark.read.option("header", True).option("nullValue", "null")
            .option("multiLine", True).option("escape", '"').csv(path))
