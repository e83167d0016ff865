"""What the plans must look like to hold at scale."""

import pytest
from pyspark.sql import functions as F

from casemart.plans import clean, marts
from casemart.plans.fixture import raw_cases
from casemart.plans.queries import Workspace, all_queries
from casemart.plans.star import fact_cases
from casemart.schema import Flavour

C, A = Flavour.CONFIRMED, Flavour.ALLCASES


@pytest.fixture(scope="module")
def workspace(spark, sf_dir):
    return Workspace.of(spark, sf_dir)


def test_no_query_uses_a_cross_join_or_python(spark, sf_dir, plan):
    bad = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython",
           "ArrowEvalPython", "Scan ExistingRDD"]
    for name, query in all_queries().items():
        text = plan(query(spark, sf_dir))
        handed_back = {"Scan ExistingRDD"} if name == "exported_mart" else set()  # a client's rows
        assert not [b for b in bad if b in text and b not in handed_back], name


def test_cleaning_is_one_projection(workspace, plan):
    text = plan(clean.clean_cases(workspace.raw, C))
    assert "Exchange" not in text and text.count("Project") == 1


def test_dedup_prunes_before_its_only_shuffle(workspace, plan):
    text = plan(clean.silver_cases(workspace.raw, A))
    assert text.count("Exchange") == 1 and text.count("WindowGroupLimit") == 2


def test_confirmed_filter_stays_above_the_dedup(workspace, plan):
    cases = clean.silver_cases(workspace.raw, C).filter("clasificacion = 'Confirmado'")
    text = plan(cases)
    assert text.index("Confirmado") < text.index("Window [row_number()")
    assert "EqualTo" not in text


def test_marts_push_the_filter_and_read_few_columns(workspace, plan):
    text = plan(marts.mortalidad_por_sexo(workspace.layers[C]))
    assert "EqualTo(clasificacion,Confirmado)" in text
    schema = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "sexo", "clasificacion", "fallecido", "requirio_uti", "requirio_arm",
    }
    assert "partial_count" in text and text.count("Exchange") == 1


def test_kpis_scan_the_fact_once(workspace, plan):
    for flavour in Flavour:
        assert plan(marts.kpis_generales(workspace.layers[flavour])).count("FileScan") == 1


def test_provinces_are_joined_after_folding(workspace, plan):
    text = plan(marts.resumen_provincia(workspace.layers[C]))
    assert text.index("Join") < text.index("partial_sum(cast(fallecido")


def test_dimensions_are_broadcast_by_size_and_shuffled_beyond_it(spark, workspace, plan):
    x = workspace.layers[C]
    args = (x.silver, x.dim_departamento, x.dim_provincia, C)
    assert "BroadcastHashJoin" in plan(fact_cases(*args))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "SortMergeJoin" in plan(fact_cases(*args))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_hot_department_is_split_when_dimensions_outgrow_the_broadcast(
    spark, workspace, plan, shuffled_joins
):
    """A third of all cases in one department: the shuffled join splits it and loses no case."""
    x = workspace.layers[C]
    ids = spark.range(30_000).repartition(16).withColumn("hot", F.col("id") % 3 == 0)
    one = x.silver.filter("departamento is not null and residencia_provincia_id is not null")
    like = one.limit(1).drop("id_caso", "departamento")
    names = [r.departamento_nombre for r in x.dim_departamento.limit(5).collect()]
    other = F.get(F.array(*(F.lit(n) for n in names)), (F.col("id") % len(names)).cast("int"))
    silver = (
        ids.withColumn("departamento", F.when(F.col("hot"), F.lit(names[0])).otherwise(other))
        .withColumn("id_caso", F.col("id").cast("string"))
        .crossJoin(F.broadcast(like))
        .drop("hot", "id")
    )
    fact = fact_cases(silver, x.dim_departamento, x.dim_provincia, C)
    assert len({r.id_caso for r in fact.collect()}) == fact.count() == 30_000
    fact.collect()
    assert "skew=true" in plan(fact).split("== Initial Plan ==")[0]


def test_line_items_are_folded_before_the_join(spark, sf_dir, plan):
    text = plan(all_queries()["delay_orders_ship"](spark, sf_dir))
    assert text.index("Join") < text.index("partial_sum(datediff(cast(l_shipdate")


def test_one_row_group_becomes_the_work_of_many_tasks(spark, sf_dir, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        raw_cases(spark, sf_dir).write.parquet(str(tmp_path / "raw"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    sizes = spark.read.parquet(str(tmp_path / "raw")).groupBy("_metadata.file_path").count()
    counts = [r["count"] for r in sizes.collect()]
    assert len(counts) > 1 and max(counts) < 2 * sum(counts) / len(counts)
