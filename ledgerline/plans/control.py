"""Run-history control table (SRC-05, FLT-03, FLT-04, FLT-06, LIM-01, CTL-01..03).

The reference keeps one row per run in a SQLite table and changes it with an
UPDATE and an INSERT on two separate connections; a crash between them leaves
no active row.  Parquet has no UPDATE, so here the table is a series of
immutable snapshots.  A run writes the close and the open together to a folder
of its own, then creates the marker file ``<path>/v=<n>`` that names the
folder, with n one more than the version it started from.  The marker is
created exclusively, so of two runs that started from one version the second
fails with ``FileExistsError`` and changes nothing.  A crash before the marker
leaves the previous version current.

A closed row names the attempt whose folders hold the run's rows, and the fetches it
has read.  So data is published by the same marker: what another attempt of the run
wrote is never read.

A run owns its row through a lease, taken before its first write: a numbered file,
created exclusively, with the owner and a time.  A second run of the same row stops at
once while the lease holds, and takes it over when its time is past.  The lease only
saves work; what keeps data right is the marker.

The table holds one row per run, so each snapshot is a single small file.
Its transitions are plain DataFrame expressions (``when``, ``unionByName``,
a global ``max``), so they can be checked like any other query.
"""

from __future__ import annotations

import json
import time
import uuid
from contextlib import suppress
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions import run_timestamp
from ledgerline.session import create_exclusive, list_children, read_small

# Fixed values of the control table.
ETL_NAME = "invoice-data"
FILTER_COLUMN = "invoice_id"
FETCH_COLUMN = "fetch"          # our own use of the second filter
YES, NO = "Y", "N"

ACTION_SKIP, ACTION_FULL, ACTION_DELTA, ACTION_NOOP = "skip", "full", "delta", "noop"


# ----------------------------------------------------------------- transforms

def seed_rows(spark: SparkSession, etl_name: str = ETL_NAME, run_ts: int | None = None) -> DataFrame:
    """The first row: an active full load with no mark (CTL-03)."""
    one = spark.range(1).select(
        F.lit(1).cast("bigint").alias("id"),
        F.lit(etl_name).alias("etl_name"),
        F.lit(NO).alias("skip_execution"),
        F.lit(YES).alias("is_active"),
        F.lit(YES).alias("full_load"),
        run_timestamp(run_ts).alias("run_date"),
        F.lit(FILTER_COLUMN).alias("filter_col1_name"),
        F.lit(None).cast("string").alias("filter_col1_value"),
        F.lit(None).cast("string").alias("filter_col2_name"),
        F.lit(None).cast("string").alias("filter_col2_value"),
    )
    return one


def active_runs(history: DataFrame, etl_name: str = ETL_NAME) -> DataFrame:
    """Rows with ``is_active='Y'`` for this pipeline (FLT-03)."""
    return history.where((F.col("is_active") == YES) & (F.col("etl_name") == etl_name))


def newest(df: DataFrame) -> DataFrame:
    """The row with the highest id (LIM-01: when several are active, newest wins)."""
    return df.orderBy(F.col("id").desc()).limit(1)


def with_action(history: DataFrame) -> DataFrame:
    """Run gating as a column (FLT-06): skip, full, delta or noop."""
    return history.withColumn(
        "action",
        # Only an explicit 'N' lets a run go ahead; NULL skips, as any other value.
        F.when(~F.col("skip_execution").eqNullSafe(F.lit(NO)), F.lit(ACTION_SKIP))
        .when(F.col("full_load") == YES, F.lit(ACTION_FULL))
        .when(F.col("full_load") == NO, F.lit(ACTION_DELTA))
        .otherwise(F.lit(ACTION_NOOP)),
    )


def close_run(history: DataFrame, run_id: int, attempt: str | None = None,
              fetches: list[str] | None = None) -> DataFrame:
    """Set ``is_active='N'`` on the run's row (CTL-01), and name the attempt that holds
    its rows and the fetches it has read."""
    own = F.col("id") == F.lit(run_id)
    closed = history.withColumn("is_active", F.when(own, F.lit(NO)).otherwise(F.col("is_active")))
    if attempt is not None:
        read = F.lit(None).cast("array<string>") if fetches is None else F.array(*map(F.lit, fetches)).cast("array<string>")
        closed = (closed.withColumn("attempt", F.when(own, F.lit(attempt)).otherwise(F.col("attempt")))
                  .withColumn("fetches", F.when(own, read).otherwise(F.col("fetches"))))
    return closed


def open_run(history: DataFrame, mark, etl_name: str = ETL_NAME, run_ts: int | None = None,
             fetch: str | None = None) -> DataFrame:
    """Append the next run's row: active incremental load from ``mark`` (CTL-02),
    and from the fetches after ``fetch`` when the runs follow fetch folders.

    The new id is ``max(id) + 1``, computed by a global aggregate over the
    table, so the new row is itself a one-row DataFrame (no driver round trip).
    """
    new_row = history.agg((F.max("id") + 1).alias("id")).select(
        F.col("id").cast("bigint").alias("id"),
        F.lit(etl_name).alias("etl_name"),
        F.lit(NO).alias("skip_execution"),
        F.lit(YES).alias("is_active"),
        F.lit(NO).alias("full_load"),
        run_timestamp(run_ts).alias("run_date"),
        F.lit(FILTER_COLUMN).alias("filter_col1_name"),
        F.lit(None if mark is None else str(mark)).cast("string").alias("filter_col1_value"),
        F.lit(None if fetch is None else FETCH_COLUMN).cast("string").alias("filter_col2_name"),
        F.lit(fetch).cast("string").alias("filter_col2_value"),
    )
    return history.unionByName(new_row, allowMissingColumns=True)


def closed_runs(history: DataFrame, etl_name: str = ETL_NAME) -> DataFrame:
    """The runs that are part of the table: the newest closed full load and the closed
    runs after it."""
    closed = history.where((F.col("etl_name") == etl_name) & (F.col("is_active") != YES))
    start = closed.agg(F.max(F.when(F.col("full_load") == YES, F.col("id")))).first()[0]
    return closed if start is None else closed.where(F.col("id") >= start)


# --------------------------------------------------------------------- lease

class RunInProgress(RuntimeError):
    """Another run holds the lease of this control row."""


class Lease:
    """Ownership of one control row: ``<folder>/<n>``, the highest n counts."""

    def __init__(self, spark: SparkSession, folder: str, owner: str, seconds: float, clock=time.time):
        self.spark, self.folder, self.owner, self.seconds, self.clock = spark, folder, owner, seconds, clock

    def _latest(self) -> tuple[int, dict | None]:
        n = max((int(x) for x in list_children(self.spark, self.folder) if x.isdigit()), default=0)
        return n, json.loads(read_small(self.spark, f"{self.folder}/{n:08d}")) if n else None

    def _write(self, n: int, until: float) -> None:
        create_exclusive(self.spark, f"{self.folder}/{n:08d}", json.dumps({"owner": self.owner, "until": until}))

    def take(self) -> None:
        """Take or renew the lease; raises RunInProgress when another run holds it."""
        n, last = self._latest()
        if last and last["owner"] != self.owner and last["until"] > self.clock():
            raise RunInProgress(f"{self.folder}: held by {last['owner']} for {last['until'] - self.clock():.0f} s more")
        try:
            self._write(n + 1, self.clock() + self.seconds)
        except FileExistsError:
            raise RunInProgress(f"{self.folder}: another run has just taken it") from None

    def renew(self) -> None:
        """Before each further step: raises RunInProgress when the lease was taken over."""
        _, last = self._latest()
        if last is None or last["owner"] != self.owner:
            raise RunInProgress(f"{self.folder}: taken over by {last and last['owner']}")
        self.take()

    def release(self) -> None:
        n, last = self._latest()
        if last and last["owner"] == self.owner:
            with suppress(FileExistsError):
                self._write(n + 1, 0)


# ------------------------------------------------------------------- storage

class RunHistory:
    """Versioned control table at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _marker(self, n: int) -> str:
        return f"{self.path}/v={n:08d}"

    def current_version(self) -> int | None:
        """The highest published version."""
        found = [int(n[2:]) for n in list_children(self.spark, self.path)
                 if n.startswith("v=") and n[2:].isdigit()]
        return max(found, default=None)

    def table(self, version: int | None = None) -> DataFrame:
        """The current (or given) version; empty and typed when there is none."""
        v = self.current_version() if version is None else version
        if not v:
            return self.spark.createDataFrame([], schemas.HISTORY_TABLE)
        folder = read_small(self.spark, self._marker(v)).strip()
        return self.spark.read.schema(schemas.HISTORY_TABLE).parquet(f"{self.path}/snapshots/{folder}")

    def publish(self, df: DataFrame, based_on: int | None = None) -> int:
        """Publish ``df``, derived from version ``based_on`` (the current one when
        not given, 0 for none), as the next version.

        Raises FileExistsError when another run has published in between.
        """
        n = ((self.current_version() or 0) if based_on is None else based_on) + 1
        out = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                          for f in schemas.HISTORY_TABLE.fields])
        folder = uuid.uuid4().hex
        # One small file per snapshot: one row per run, bounded by the run count.
        out.coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/snapshots/{folder}")
        create_exclusive(self.spark, self._marker(n), folder)
        return n

    def seed(self, etl_name: str = ETL_NAME, run_ts: int | None = None) -> bool:
        """Create the table with its seed row unless it exists (CTL-03)."""
        if self.current_version() is not None:
            return False
        self.publish(seed_rows(self.spark, etl_name, run_ts), 0)
        return True

    def active_run(self, etl_name: str = ETL_NAME, version: int | None = None) -> DataFrame:
        """SRC-05 + FLT-03 + LIM-01: the newest active row of this pipeline."""
        return newest(active_runs(self.table(version), etl_name))

    def lease(self, run_id: int, owner: str, seconds: float, etl_name: str = ETL_NAME) -> Lease:
        """The lease of a run's row, not taken yet."""
        return Lease(self.spark, f"{self.path}/leases/{quote(etl_name, safe='')}-{run_id}", owner, seconds)

    def close_and_open(self, run_id: int, mark, etl_name: str = ETL_NAME,
                       run_ts: int | None = None, based_on: int | None = None,
                       fetch: str | None = None, attempt: str | None = None,
                       fetches: list[str] | None = None) -> int:
        """CTL-01 + CTL-02 as one published snapshot.

        ``based_on``: the version the run started from.  When another pipeline has
        published meanwhile, the change is made to its version; a run whose own row
        was closed meanwhile fails with FileExistsError."""
        version = self.current_version() if based_on is None else based_on
        while True:
            table = close_run(self.table(version), run_id, attempt, fetches)
            try:
                return self.publish(open_run(table, mark, etl_name, run_ts, fetch), version or 0)
            except FileExistsError:
                version = self.current_version()
                own = active_runs(self.table(version), etl_name).where(F.col("id") == run_id)
                if own.isEmpty():
                    raise
