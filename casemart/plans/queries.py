"""Every query by name: (spark, folder of the input tables) -> DataFrame."""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemart.operators import (
    Check,
    check_not_null,
    check_unique,
    duplicate_audit,
    null_audit,
    profile,
    run_checks,
    step_counts,
    top_n,
    value_counts,
)
from casemart.plans import checks, clean, cube, feeds, marts, native
from casemart.plans.deliveries import Deliveries
from casemart.plans.fixture import RAW_INPUTS, raw_cases, table, torn_cases
from casemart.plans.layers import (
    Layers,
    WrittenCounts,
    keep_as_view,
    keep_bucketed,
    keep_clustered,
    keep_under,
)
from casemart.plans.star import ONSET
from casemart.schema import CATEGORY_COLUMNS, RAW_COLUMNS, Flavour
from casemart.sources import (
    copy_file,
    create_raw_table,
    delete_folder,
    export_mart,
    file_version,
    matching,
    read_raw_lines,
    read_raw_records,
    save_mart,
    shared_dir,
)
from casemart.sources.layout import save_bucketed
from casemart.sources.publish import AuditFailed, publish
from casemart.sources.raw import fitting, rejected
from casemart.sources.sketches import ProfileStore
from casemart.streaming import ContentTable, ingest_new_files

Query = Callable[[SparkSession, str], DataFrame]

# The marts kept by signed changes that are also registered over deliveries.
DELTA_MARTS = ["casos_por_dia", "resumen_provincia", "letalidad_mensual", "casos_provincia_mes"]


class Workspace:
    """The written layers of one input folder in one session.

    Raw, silver, dimensions and fact are written once below the shared folder; each mart is then
    a pruned, filtered scan of the fact instead of another run of the whole pipeline. Input
    files that changed, wherever they are stored, open a new workspace.
    """

    _open: dict[tuple, Workspace] = {}
    _lock = threading.Lock()

    def __init__(self, spark: SparkSession, sf_dir: str, version: tuple):
        digest = hashlib.sha256(repr((sf_dir, version)).encode()).hexdigest()[:16]
        self.spark = spark
        self.root = f"{workspace_root(spark)}/{digest}"
        self.counts = WrittenCounts(keep_under(self.root))
        raw = self.counts.store("bronze_casos", raw_cases(spark, sf_dir))
        survivors = None

        def survivors_of(lines: DataFrame) -> DataFrame:
            nonlocal survivors
            if survivors is None:
                survivors = self.counts.store("reports", clean.best_reports(lines))
            return survivors

        self.layer_counts = {f: WrittenCounts(keep_under(f"{self.root}/{f.value}")) for f in Flavour}
        self.layers = {f: Layers(raw, f, self.layer_counts[f].store, survivors_of) for f in Flavour}
        self.raw = raw
        self._survivors_of = survivors_of
        self._deliveries: Deliveries | None = None
        self._laid_out: dict[str, Layers] = {}

    def deliveries(self, sf_dir: str) -> Deliveries:
        """Three deliveries in a row: first reports, the second ones, the first ones once more."""
        with self._lock:
            if self._deliveries is None:
                made = Deliveries(self.spark, f"{self.root}/deliveries", buckets=16)
                for n, reports in enumerate(("first", "second", "first")):
                    made.load(raw_cases(self.spark, sf_dir, reports), f"d{n}")
                self._deliveries = made
            return self._deliveries

    def laid_out(self, layout: str) -> Layers:
        """The confirmed layers once more, `bucketed` by the case or `clustered` by two columns."""
        with self._lock:
            if layout not in self._laid_out:
                root, files = f"{self.root}/{layout}", partitions(self.spark)
                store = keep_under(root)
                if layout == "bucketed":
                    database = f"bucketed_{uuid.uuid4().hex}"
                    self.spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/database'")
                    store = keep_bucketed(store, root, database, "id_caso", files)
                else:
                    columns = ("clasificacion", ONSET)
                    store = keep_clustered(store, {"fact_casos": columns}, files)
                self._laid_out[layout] = Layers(
                    self.raw, Flavour.CONFIRMED, store, self._survivors_of
                )
            return self._laid_out[layout]

    def bucketed_raw(self) -> DataFrame:
        name = f"raw_bucketed_{uuid.uuid4().hex}"
        root = f"{self.root}/{name}"
        return save_bucketed(self.raw, name, "id_evento_caso", partitions(self.spark), root)

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Workspace:
        sf_dir = sf_dir.rstrip("/")
        version = file_version(spark, [f"{sf_dir}/{name}.parquet" for name in RAW_INPUTS])
        key = (spark.sparkContext.applicationId, sf_dir, version)
        with cls._lock:
            if key not in cls._open:
                cls._open[key] = cls(spark, sf_dir, version)
            return cls._open[key]

    def drop(self) -> None:
        """Delete the written layers; the next query writes them again."""
        with self._lock:
            for key in [k for k, w in self._open.items() if w is self]:
                del self._open[key]
        delete_folder(self.spark, self.root)


def workspace_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/casemart/{spark.sparkContext.applicationId}"


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def on_raw(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(Workspace.of(spark, sf_dir).raw)


def on_layers(plan: Callable[[Layers], DataFrame], flavour: Flavour) -> Query:
    return lambda spark, sf_dir: plan(Workspace.of(spark, sf_dir).layers[flavour])


def on_cells(plan: Callable[[cube.CellLayers], DataFrame], flavour: Flavour) -> Query:
    return on_layers(lambda layers: plan(cube.from_cells(layers)), flavour)


def on_deliveries(plan: Callable[[Deliveries], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(Workspace.of(spark, sf_dir).deliveries(sf_dir))


def on_layout(plan: Callable[[Layers], DataFrame], layout: str) -> Query:
    return lambda spark, sf_dir: plan(Workspace.of(spark, sf_dir).laid_out(layout))


def on_bucketed_raw(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(Workspace.of(spark, sf_dir).bucketed_raw())


def written_null_audit(layer: str, flavour: Flavour) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        workspace = Workspace.of(spark, sf_dir)
        workspace.layers[flavour].tables()
        return workspace.layer_counts[flavour].null_audit(layer)

    return run


def written_step_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before and after the deduplication, as the writes of the two layers counted them."""
    workspace = Workspace.of(spark, sf_dir)
    workspace.layers[Flavour.CONFIRMED].tables()
    before, after = (workspace.counts.rows(name) for name in ("bronze_casos", "reports"))
    return spark.range(1).select(
        F.lit(before).cast("long").alias("rows_before"), F.lit(after).cast("long").alias("rows_after")
    )


def sketched_loads(spark: SparkSession, sf_dir: str) -> ProfileStore:
    """Sketches of two loads, the second one made twice under its name."""
    path = f"{workspace_root(spark)}/sketches-{uuid.uuid4().hex}"
    store = ProfileStore(spark, path, RAW_COLUMNS, CATEGORY_COLUMNS)
    for name in ("first", "second", "second"):
        store.add(raw_cases(spark, sf_dir, name), name)
    return store


def profile_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The united sketches held against the exact profile: distinct counts within a twentieth."""
    raw = Workspace.of(spark, sf_dir).raw
    exact = profile(raw).select("column", F.col("n_distinct").alias("_exact"))
    near = F.abs(F.col("n_distinct") - F.col("_exact")) <= F.ceil(F.col("_exact") * 0.05)
    found = sketched_loads(spark, sf_dir).profile()
    return found.join(exact, "column").select(
        "column", "n_missing", "pct_missing", near.alias("within_bound")
    )


def on_tables(plan: Callable[..., DataFrame], *names: str) -> Query:
    return lambda spark, sf_dir: plan(*(table(spark, sf_dir, n) for n in names))


def ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load delivered CSV files, load again without news, then load a later delivery.

    The first delivery holds each case once, the later one the repeated reports; the second,
    idle load must add nothing, so the table ends as exactly the raw cases.
    """
    run = f"{workspace_root(spark)}/ingest-{uuid.uuid4().hex}"

    def deliver(reports: str) -> None:
        cases = raw_cases(spark, sf_dir, reports)
        cases.write.mode("append").option("header", True).csv(f"{run}/landing")

    def load() -> DataFrame:
        return ingest_new_files(spark, f"{run}/landing", f"{run}/table", f"{run}/checkpoint")

    torn_cases(spark, sf_dir).write.option("header", True).csv(f"{run}/landing")
    deliver("first")
    load()
    load()
    deliver("second")
    return load()


def raw_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw cases as CSV, among lines that do not fit, read back line by line."""
    folder = f"{workspace_root(spark)}/csv-{uuid.uuid4().hex}"
    for frame in (torn_cases(spark, sf_dir), raw_cases(spark, sf_dir)):
        frame.write.mode("append").option("header", True).csv(folder)
    return read_raw_lines(spark, folder)


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same delivery read as records: a line break inside quotes belongs to its case."""
    folder = f"{workspace_root(spark)}/csv-{uuid.uuid4().hex}"
    for frame in (torn_cases(spark, sf_dir), raw_cases(spark, sf_dir)):
        frame.write.mode("append").option("header", True).csv(folder)
    return read_raw_records(spark, folder)


def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table, created twice and filled once."""
    name = f"raw_{uuid.uuid4().hex}"
    folder = f"{workspace_root(spark)}/{name}"
    create_raw_table(spark, name, folder)
    raw_cases(spark, sf_dir).write.insertInto(name)
    return create_raw_table(spark, name, folder)


def dim_provincia_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layer chain kept as views instead of tables."""
    return Layers(raw_cases(spark, sf_dir), Flavour.ALLCASES, keep_as_view).dim_provincia


def refreshed_mart(layers: Layers) -> DataFrame:
    """A mart saved, then fully refreshed from a frame with another schema."""
    spark = layers.raw.sparkSession
    name = f"mart_{uuid.uuid4().hex}"
    folder = f"{workspace_root(spark)}/{name}"
    mart = marts.stored(layers, "resumen_provincia")
    save_mart(mart.select(mart.columns[0]), name, folder)
    return save_mart(mart, name, folder)


def published_mart(layers: Layers) -> DataFrame:
    """Versions published one after the other; one that fails its checks never shows."""
    spark = layers.raw.sparkSession
    name = f"published_{uuid.uuid4().hex}"
    folder = f"{workspace_root(spark)}/{name}"
    mart = marts.stored(layers, "mortalidad_por_sexo")
    checks_of = [Check("unique", name, "sexo"), Check("not_null", name, "total_casos")]

    def audit(staged: DataFrame) -> DataFrame:
        return run_checks({name: staged}, checks_of)

    publish(mart.select("sexo", "total_casos"), name, audit, folder)
    publish(mart, name, audit, folder)
    try:
        publish(mart.unionByName(mart), name, audit, folder)
    except AuditFailed:
        return spark.table(name)
    raise AssertionError("repeated keys were published")


def ingest_by_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files delivered again under other names, and one changed in place, load each case once."""
    run = f"{workspace_root(spark)}/content-{uuid.uuid4().hex}"
    landing = ContentTable(spark, f"{run}/landing", f"{run}/table")

    def make(cases: DataFrame, name: str) -> list[str]:
        cases.write.option("header", True).csv(f"{run}/made/{name}")
        return matching(spark, f"{run}/made/{name}/part-*.csv")

    first = make(raw_cases(spark, sf_dir, "first"), "first")
    second = make(raw_cases(spark, sf_dir, "second").coalesce(1), "second")  # one file to change
    torn = make(torn_cases(spark, sf_dir).coalesce(1), "torn")
    for n, path in enumerate(first):
        copy_file(spark, path, f"{run}/landing/a{n}.csv")
    copy_file(spark, torn[0], f"{run}/landing/late.csv")
    landing.load()
    for n, path in enumerate(first):
        copy_file(spark, path, f"{run}/landing/again{n}.csv")
    copy_file(spark, second[0], f"{run}/landing/late.csv")
    landing.load()
    return landing.load()


def exported_mart(layers: Layers) -> DataFrame:
    """A mart handed to the client and back."""
    mart = marts.stored(layers, "mortalidad_por_sexo")
    return layers.raw.sparkSession.createDataFrame(export_mart(mart), mart.schema)


def profile_approx(df: DataFrame) -> DataFrame:
    """The sketched profile held against the exact one: distinct counts within a tenth."""
    exact = profile(df).select("column", F.col("n_distinct").alias("_exact"))
    near = F.abs(F.col("n_distinct") - F.col("_exact")) <= F.ceil(F.col("_exact") * 0.1)
    return profile(df, approx=True).join(exact, "column").select(
        "column", "n_missing", near.alias("within_bound")
    )


def all_queries() -> dict[str, Query]:
    c, a = Flavour.CONFIRMED, Flavour.ALLCASES
    out: dict[str, Query] = {
        "clean_ages": on_raw(clean.clean_ages),
        "clean_cases_confirmed": on_raw(lambda raw: clean.clean_cases(raw, c)),
        "clean_cases_allcases": on_raw(lambda raw: clean.clean_cases(raw, a)),
        "dedup_cases": on_raw(lambda raw: clean.dedup_cases(clean.clean_cases(raw, c), c)),
        "silver_confirmed": on_layers(lambda x: x.silver, c),
        "silver_allcases": on_layers(lambda x: x.silver, a),
        "dim_provincia": on_layers(lambda x: x.dim_provincia, a),
        "dim_provincia_confirmed": on_layers(lambda x: x.dim_provincia, c),
        "dim_provincia_view": dim_provincia_view,
        "raw_table": raw_table,
        "read_raw_csv": lambda spark, sf_dir: fitting(raw_csv(spark, sf_dir)),
        "read_raw_records": lambda spark, sf_dir: fitting(raw_records(spark, sf_dir)),
        "rejected_raw_lines": lambda spark, sf_dir: rejected(raw_csv(spark, sf_dir)),
        "refreshed_mart": on_layers(refreshed_mart, c),
        "published_mart": on_layers(published_mart, c),
        "ingest_by_content": ingest_by_content,
        "exported_mart": on_layers(exported_mart, c),
        "dim_departamento_confirmed": on_layers(lambda x: x.dim_departamento, c),
        "dim_departamento_allcases": on_layers(lambda x: x.dim_departamento, a),
        "fact_confirmed": on_layers(lambda x: x.fact, c),
        "fact_allcases": on_layers(lambda x: x.fact, a),
    }
    for name, mart in marts.MARTS.items():
        for flavour in mart.flavours:
            out[f"{name}_{flavour.value[0]}"] = on_layers(mart.build, flavour)
            out[f"cube_{name}_{flavour.value[0]}"] = on_cells(mart.build, flavour)
    out |= {
        f"delta_{name}_c": on_deliveries(lambda d, m=marts.MARTS[name]: m.build(d.layers()))
        for name in DELTA_MARTS
    }
    out["delta_silver_confirmed"] = on_deliveries(lambda d: d.silver())
    by_month = marts.MARTS["casos_provincia_mes"].build
    out |= {
        "bucketed_silver_confirmed": on_bucketed_raw(lambda raw: clean.silver_cases(raw, c)),
        "bucketed_duplicate_audit": on_bucketed_raw(
            lambda raw: duplicate_audit(raw, "id_evento_caso", colocated=True)
        ),
        "bucketed_check_unique_silver": on_layout(
            lambda x: check_unique(x.silver, "id_caso"), "bucketed"
        ),
        "bucketed_fact_confirmed": on_layout(lambda x: x.fact, "bucketed"),
        "clustered_fact_confirmed": on_layout(lambda x: x.fact, "clustered"),
        "clustered_casos_provincia_mes_c": on_layout(by_month, "clustered"),
        "written_step_counts": written_step_counts,
        "written_null_audit_silver_c": written_null_audit("silver_casos", c),
        "written_null_audit_fact_c": written_null_audit("fact_casos", c),
        "written_null_audit_fact_a": written_null_audit("fact_casos", a),
        "loads_profile_raw": profile_loads,
        "loads_value_counts_raw": lambda spark, sf_dir: sketched_loads(spark, sf_dir).value_counts(),
    }
    out |= {
        "preview_provinces": on_layers(
            lambda x: top_n(
                marts.stored(x, "resumen_provincia"), "total_casos", 10, ["provincia_nombre"]
            ),
            c,
        ),
        "profile_raw": on_raw(profile),
        "value_counts_raw": on_raw(lambda raw: value_counts(raw, CATEGORY_COLUMNS)),
        "null_audit_fact_c": on_layers(lambda x: null_audit(x.fact), c),
        "null_audit_fact_a": on_layers(lambda x: null_audit(x.fact), a),
        "check_unique_raw": on_raw(lambda raw: check_unique(raw, "id_evento_caso")),
        "check_unique_silver": on_layers(lambda x: check_unique(x.silver, "id_caso"), c),
        "check_not_null_fallecido_a": on_layers(lambda x: check_not_null(x.fact, "fallecido"), a),
        "check_not_null_uti_c": on_layers(lambda x: check_not_null(x.fact, "requirio_uti"), c),
        "dim_key_check": on_layers(checks.dim_key_check, c),
        "quality_report_c": on_layers(checks.quality_report, c),
        "quality_report_a": on_layers(checks.quality_report, a),
        "duplicate_audit": on_raw(lambda raw: duplicate_audit(raw, "id_evento_caso")),
        "code_collisions": on_layers(checks.department_code_collisions, c),
        "dedup_step_counts": on_raw(lambda raw: step_counts(raw, "id_evento_caso")),
        "feed_daily_curve": on_layers(feeds.daily_curve, c),
        "feed_age_rate": on_layers(feeds.age_rate, c),
        "feed_deaths_age": on_layers(feeds.deaths_age, a),
        "feed_province_rate": on_layers(feeds.province_rate, c),
        "feed_province_delay": on_layers(feeds.province_delay, c),
        "feed_province_volume": on_layers(feeds.province_volume, c),
        "feed_funding_long": on_layers(feeds.funding_long, c),
        "feed_uti_arm": on_layers(feeds.uti_arm, c),
        "feed_died_survived": on_layers(feeds.died_survived, c),
        "feed_deaths_sex": on_layers(feeds.deaths_sex, c),
        "feed_monthly_rate": on_layers(feeds.monthly_rate, c),
        "feed_province_month_matrix": on_layers(feeds.province_month_cells, c),
        "feed_matrix_bounds": on_layers(feeds.matrix_bounds, c),
        "feed_pyramid": on_layers(feeds.pyramid, c),
        "feed_delay_vs_rate": on_layers(feeds.delay_vs_rate, c),
        "ingest_incremental": ingest_incremental,
        "rate_lineitem_returnflag": on_tables(native.rate_lineitem_returnflag, "lineitem"),
        "delay_orders_ship": on_tables(native.delay_orders_ship, "orders", "lineitem"),
        "delay_items_by_flag": on_tables(native.delay_items_by_flag, "lineitem"),
        "events_per_day": on_tables(native.events_per_day, "events"),
        "dedup_lineitem_latest": on_tables(native.dedup_lineitem_latest, "lineitem"),
        "duplicate_lineitems": on_tables(native.duplicate_lineitems, "lineitem"),
        "profile_lineitem": on_tables(native.profile_lineitem, "lineitem"),
        "profile_lineitem_approx": on_tables(profile_approx, "lineitem"),
        "value_counts_lineitem": on_tables(native.value_counts_lineitem, "lineitem"),
        "share_orders_priority": on_tables(native.share_orders_priority, "orders"),
        "orders_per_customer": on_tables(native.orders_per_customer, "orders"),
    }
    return out
