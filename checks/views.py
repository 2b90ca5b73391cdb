"""The mart's input tables, derived from the sample tables ``orders`` and ``lineitem``."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tallyloom.operators.skew import skew_join


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shifts(orders: DataFrame) -> DataFrame:
    start = "o_orderdate + interval 1 hour * (o_orderkey % 24)"
    return orders.selectExpr(
        "o_orderkey as id",
        "'W' || cast(o_custkey % 25 as string) as warehouse_id",
        "1 + cast(o_orderkey % 2 as int) as role_id",
        f"{start} as start_date",
        f"{start} + interval 1 hour * (4 + o_custkey % 9) + interval 1 minute * (30 * (o_orderkey % 3)) as end_date",
        "1 + o_custkey % 5 as max_count",
        "o_orderdate - interval 1 hour * (24 * (o_orderkey % 7)) + interval 1 hour * (o_custkey % 4) as created_at",
    )


def history(lineitem: DataFrame, orders: DataFrame, heavy: Sequence[Any] = ()) -> DataFrame:
    changes = lineitem.selectExpr(
        "l_orderkey as shift_id", "l_suppkey as employee_id", "l_linenumber", "l_partkey", "l_returnflag"
    )
    dates = orders.selectExpr("o_orderkey as shift_id", "o_orderdate")
    return skew_join(changes, dates, "shift_id", heavy).selectExpr(
        "shift_id",
        "employee_id",
        "o_orderdate - interval 1 hour * (24 * l_linenumber) + interval 1 hour * (l_partkey % 24) as created_at",
        "case l_returnflag when 'A' then 10 when 'R' then 0 else 5 end as type",
    )


def couriers(lineitem: DataFrame, orders: DataFrame, heavy: Sequence[Any] = ()) -> DataFrame:
    worked = lineitem.selectExpr(
        "l_orderkey as shift_id",
        "l_suppkey as employee_id",
        "l_partkey",
        "l_quantity",
        "l_returnflag",
        "l_linestatus",
    )
    planned = shifts(orders).selectExpr("id as shift_id", "warehouse_id", "role_id", "start_date", "end_date")
    return skew_join(worked, planned, "shift_id", heavy).selectExpr(
        "shift_id",
        "employee_id",
        "case when l_returnflag = 'R' then 0.0D else l_quantity / 10 end as paid_sh",
        """case when l_returnflag = 'N' and l_linestatus = 'F' then null
                else start_date + interval 1 minute * (l_partkey % 121 - 60) end as fact_shift_start""",
        """case when l_returnflag = 'R' and l_linestatus = 'O' then null
                else end_date + interval 1 minute * (employee_id % 91 - 45) end as fact_shift_end""",
        "case when l_returnflag = 'R' then start_date end as removed_dttm",
        "warehouse_id",
        "role_id",
        "start_date as plan_shift_start",
    )
