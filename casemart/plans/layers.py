"""The layers of one flavour, raw to fact, each built once and kept the way the caller wants."""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, functions as F

from casemart.functions import percent
from casemart.operators import Check, run_checks
from casemart.plans import clean, star
from casemart.schema import Flavour
from casemart.sources import save_mart, write_and_read
from casemart.sources.layout import cluster_by, save_bucketed
from casemart.sources.publish import KEEP_SECONDS, publish

Store = Callable[[str, DataFrame, Sequence[str]], DataFrame]


def keep_lazy(name: str, df: DataFrame, sort_by: Sequence[str] = ()) -> DataFrame:
    """No materialisation: every consumer re-runs the plan from its source."""
    return df


def keep_as_view(name: str, df: DataFrame, sort_by: Sequence[str] = ()) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def keep_as_table(database: str) -> Store:
    def store(name: str, df: DataFrame, sort_by: Sequence[str] = ()) -> DataFrame:
        out = df.sortWithinPartitions(*sort_by) if sort_by else df
        return save_mart(out, f"{database}.{name}")

    return store


def keep_as_published(
    database: str, checks: Sequence[Check] = (), keep_seconds: float = KEEP_SECONDS
) -> Store:
    """Each table becomes visible only after its checks have passed; replaced versions stay."""

    def store(name: str, df: DataFrame, sort_by: Sequence[str] = ()) -> DataFrame:
        out = df.sortWithinPartitions(*sort_by) if sort_by else df
        mine = [c for c in checks if c.table == name]
        names = {"departamento_nombre": "departamento"}  # as the checks call it

        def audit(staged: DataFrame) -> DataFrame:
            return run_checks({name: staged.withColumnsRenamed(names)}, mine)

        return publish(out, f"{database}.{name}", audit if mine else None, None, keep_seconds)

    return store


def keep_under(root: str) -> Store:
    """Parquet folders below `root`, no catalog needed."""

    def store(name: str, df: DataFrame, sort_by: Sequence[str] = ()) -> DataFrame:
        return write_and_read(df, f"{root}/{name}", sort_by)

    return store


def keep_bucketed(store: Store, root: str, database: str, key: str, buckets: int) -> Store:
    """Layers that have the column `key` as tables in buckets of it; the others as `store` does."""

    def bucketed(name: str, df: DataFrame, sort_by: Sequence[str] = ()) -> DataFrame:
        if key not in df.columns:
            return store(name, df, sort_by)
        return save_bucketed(df, f"{database}.{name}", key, buckets, f"{root}/{name}")

    return bucketed


def keep_clustered(store: Store, clusters: Mapping[str, Sequence[str]], files: int) -> Store:
    """`store`, with the rows of the named layers clustered by these columns."""

    def clustered(name: str, df: DataFrame, sort_by: Sequence[str] = ()) -> DataFrame:
        if name not in clusters:
            return store(name, df, sort_by)
        return store(name, cluster_by(df, clusters[name], files), ())

    return clustered


class WrittenCounts:
    """Rows and NULLs of every layer a store writes, counted by the write itself.

    The counts are taken in the tasks that write the files, where Spark counts each partition once,
    also if a task is repeated after a lost executor. `store` has to write what it is given.
    """

    def __init__(self, store: Store):
        self._store = store
        self._seen: dict[str, tuple[Observation, list[str], DataFrame]] = {}

    def store(self, name: str, df: DataFrame, sort_by: Sequence[str] = ()) -> DataFrame:
        seen = Observation()
        nulls = (F.count_if(F.col(c).isNull()).alias(f"_null{i}") for i, c in enumerate(df.columns))
        out = self._store(name, df.observe(seen, F.count(F.lit(1)).alias("_rows"), *nulls), sort_by)
        self._seen[name] = seen, df.columns, out
        return out

    def rows(self, name: str) -> int:
        return self._seen[name][0].get["_rows"]

    def null_audit(self, name: str) -> DataFrame:
        """`operators.null_audit` of a written layer, without reading it."""
        seen, columns, out = self._seen[name]
        found = seen.get
        counts = [
            F.struct(F.lit(c).alias("column"), F.lit(found[f"_null{i}"]).cast("long").alias("n_null"))
            for i, c in enumerate(columns)
        ]
        listed = out.sparkSession.range(1).select(F.inline(F.array(*counts)))
        return listed.filter("n_null > 0").select(
            "column", "n_null", percent("n_null", F.lit(found["_rows"]), 1).alias("pct_null")
        )


class Layers:
    """raw -> silver -> dimensions -> fact. A layer is built when first asked for.

    Marts on these layers read the fact, as there are no folded `cells`.

    `reports` gives the one raw report per case; both flavours of a run may share its result.
    """

    cells = None

    def __init__(
        self,
        raw: DataFrame,
        flavour: Flavour,
        store: Store = keep_lazy,
        reports: Callable[[DataFrame], DataFrame] = clean.best_reports,
    ):
        self.raw = raw
        self.flavour = flavour
        self._reports = reports
        self._store = store
        self._built: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def keep(
        self, name: str, make: Callable[[], DataFrame], sort_by: Sequence[str] = ()
    ) -> DataFrame:
        """The stored frame `name`, made by `make` when first asked for."""
        with self._lock:
            if name not in self._built:
                self._built[name] = self._store(name, make(), sort_by)
            return self._built[name]

    @property
    def silver(self) -> DataFrame:
        return self.keep(
            "silver_casos", lambda: clean.typed_cases(self._reports(self.raw), self.flavour)
        )

    @property
    def dim_provincia(self) -> DataFrame:
        return self.keep(
            "dim_provincia", lambda: star.dim_provincia(self.silver, self.flavour)
        )

    @property
    def dim_departamento(self) -> DataFrame:
        return self.keep(
            "dim_departamento", lambda: star.dim_departamento(self._departments, self.flavour)
        )

    @property
    def _departments(self) -> DataFrame:
        """Kept on its own because numbering reads it twice."""
        return self.keep(
            "departamentos", lambda: star.departments(self.silver, self.flavour)
        )

    @property
    def fact(self) -> DataFrame:
        """Sorted by classification inside each file: most marts read one class only."""
        return self.keep(
            "fact_casos",
            lambda: star.fact_cases(
                self.silver, self.dim_departamento, self.dim_provincia, self.flavour
            ),
            sort_by=("clasificacion",),
        )

    def tables(self) -> dict[str, DataFrame]:
        return {
            "silver_casos": self.silver,
            "dim_provincia": self.dim_provincia,
            "dim_departamento": self.dim_departamento,
            "fact_casos": self.fact,
        }
