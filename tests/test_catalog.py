import uuid

from pyspark.sql import types as T

from quarry.config import Namespaces
from quarry.plans.materialize import Warehouse
from quarry.schemas import RAW_QUAKES, schema_from_dtypes
from quarry.sinks.writers import ensure_table


def test_namespace_routing():
    assert Namespaces.route(None, "analytics") == "analytics"
    assert Namespaces.route("  silver ", "analytics") == "silver"
    ns = Namespaces.routed(default="analytics", silver=" clean ")
    assert (ns.raw, ns.bronze, ns.silver, ns.gold) == ("analytics", "analytics", "clean", "analytics")
    assert Namespaces.routed().gold == "gold"


def test_dtype_rules(spark):
    quakes = schema_from_dtypes({
        "time": "datetime64[ns]", "id": "object", "magnitude": "float64", "sig": "int64", "tsunami": "bool", "depth": "float32",
        "data_period_start": "object", "seen": "datetime64[ns]",
    }, RAW_QUAKES)
    assert {f.name: f.dataType for f in quakes.fields} == {
        "time": T.TimestampNTZType(), "id": T.StringType(), "magnitude": T.DoubleType(), "sig": T.LongType(),
        "tsunami": T.BooleanType(), "depth": T.DoubleType(), "data_period_start": T.DateType(), "seen": T.StringType(),
    }
    name = f"t_{uuid.uuid4().hex[:8]}"
    assert ensure_table(spark, name, RAW_QUAKES, dtypes={"id": "object", "extra": "int32"})
    assert dict(spark.table(name).dtypes) == {"id": "string", "extra": "bigint"}


def test_partitioned_table_prunes(spark):
    tag = uuid.uuid4().hex[:8]
    wh = Warehouse(spark, Namespaces(raw=f"r_{tag}", bronze=f"b_{tag}", silver=f"s_{tag}", gold=f"g_{tag}"))
    wh.create_namespaces()
    df = spark.createDataFrame([(2023, 1), (2024, 2), (2024, 3)], "year int, v int")
    wh.table("silver", "t", df, tags=("silver",), partition_by=("year",))
    q = wh.ref("silver", "t").where("year = 2024")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert q.count() == 2
