"""Weather-shaped ``obs`` view derived from the driver's TPC-H-like tables.

``lineitem ⋈ supplier ⋈ nation`` is mapped to the 23 observation columns with
deterministic gaps, invalid tokens and duplicated rows, so every audit,
imputation and model operator runs on data whose size grows with the scale
factor. The same expressions exist as DuckDB SQL so the
oracle reads identical input (:func:`obs_sql`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DIRECTIONS
from ..session import compilable

# Row hash of a lineitem row (shared by Spark and SQL text).
H_EXPR = "l_orderkey*31 + l_partkey*17 + l_linenumber*7 + cast(l_quantity as bigint)"


def _direction(e: str, text_type: str, item) -> str:
    # item(i) renders the 1-based i-th compass point in the target dialect.
    return (f"case when ({e})%17=0 then 'NA' when ({e})%19=0 then cast(null as {text_type}) "
            f"when ({e})%997=1 then 'XX' else {item(f'({e})%16+1')} end")


def _columns(text_type: str, item) -> list[tuple[str, str]]:
    return [
        ("Date", f"case when h%997=0 then '2024-13-01' else cast(cast(l_shipdate as date) as {text_type}) end"),
        ("Location", "n_name"),
        ("MinTemp", "case when h%11=0 then null else cast(h%250 as double)/10-5 end"),
        ("MaxTemp", "case when h%12=0 then null else cast(h%300 as double)/10+5 end"),
        ("Rainfall", "case when h%13=0 then null when h%1009=0 then cast(5000.0 as double) "
                     "else cast(l_linenumber*l_partkey%40 as double)/2 end"),
        ("Evaporation", "case when h%3=0 then null else cast(h%130 as double)/10 end"),
        ("Sunshine", "case when h%2=0 then null else cast(h%140 as double)/10 end"),
        ("WindGustDir", _direction("h", text_type, item)),
        ("WindGustSpeed", "case when h%10=0 then null when h%503=0 then cast(250.0 as double) "
                          "else cast(20+h%60 as double) end"),
        ("WindDir9am", _direction("h+5", text_type, item)),
        ("WindDir3pm", _direction("h+11", text_type, item)),
        ("WindSpeed9am", "case when h%21=0 then null else cast(h%40 as double) end"),
        ("WindSpeed3pm", "case when h%22=0 then null else cast(5+h%45 as double) end"),
        ("Humidity9am", "case when h%16=0 then null else cast(100-h%70 as double) end"),
        ("Humidity3pm", "case when h%7=0 then null else l_quantity*2-2 end"),
        ("Pressure9am", "case when h%9=0 then null else cast(990+h%40 as double) end"),
        ("Pressure3pm", "case when h%8=0 then null else cast(985+h%45 as double) end"),
        ("Cloud9am", "case when h%4=0 then null else cast(h%10 as int) end"),
        ("Cloud3pm", "case when h%5=0 then null else cast(h%9 as int) end"),
        ("Temp9am", "case when h%14=0 then null else cast(h%270 as double)/10 end"),
        ("Temp3pm", "case when h%15=0 then null else cast(h%310 as double)/10+2 end"),
        ("RainToday", "case when h%23=0 then 'NA' when l_partkey%3=0 then 'Yes' else 'No' end"),
        ("RainTomorrow", "case when h%101=0 then null when l_quantity*2+h%40>90 then 'Yes' else 'No' end"),
    ]


def obs(spark: SparkSession, sf_dir: str, spread: bool = True) -> DataFrame:
    """The observation table for a driver data folder (23 columns + row key ``h``).

    ``spread`` deals the six source columns out by the order key: the driver's
    tables are one row group each, which one task would read and derive all
    columns of. Turn it off for files of many row groups; rows are the same.
    """
    compilable(spark)
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    if spread:
        li = li.repartition("l_orderkey")
    su = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_nationkey")
    na = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    # nation is the fixed 25-row TPC-H dimension: a proven broadcast bound.
    # supplier grows with the scale factor, so its join strategy is left to
    # Catalyst/AQE size checks.
    joined = (li.join(su, li.l_suppkey == su.s_suppkey)
                .join(F.broadcast(na), su.s_nationkey == na.n_nationkey))
    array_literal = "array(" + ", ".join(f"'{d}'" for d in DIRECTIONS) + ")"
    item = lambda i: f"element_at({array_literal}, cast({i} as int))"
    cols = [F.expr(e).alias(n) for n, e in _columns("string", item)]
    # Rows with h%100=0 appear twice (exact duplicates). The generator emits
    # the copy in the same scan, and because it also emits ``h`` itself, the
    # optimizer cannot inline the hash expression into every derived column
    # (or into filters pushed down by consumers).
    h = F.expr(H_EXPR)
    copies = F.array_repeat(h, F.when(h % 100 == 0, 2).otherwise(1))
    keep = ["l_partkey", "l_linenumber", "l_quantity", "l_shipdate", "n_name"]
    return joined.select(*keep, F.explode(copies).alias("h")).select(*cols, "h")


def obs_sql() -> str:
    """DuckDB text of the same view, to be used as ``WITH obs AS (...)``."""
    array_literal = "[" + ", ".join(f"'{d}'" for d in DIRECTIONS) + "]"
    item = lambda i: f"{array_literal}[{i}]"
    cols = ",\n    ".join(f"{e} AS {n}" for n, e in _columns("varchar", item))
    base = (
        "SELECT\n    " + cols + ",\n    h\n  FROM (SELECT *, " + H_EXPR + " AS h FROM lineitem\n"
        "        JOIN supplier ON l_suppkey = s_suppkey\n"
        "        JOIN nation ON s_nationkey = n_nationkey) j"
    )
    return f"SELECT * FROM ({base}) b UNION ALL SELECT * FROM ({base}) b2 WHERE h % 100 = 0"
