"""Report sources (SRC-01, SRC-02).

SRC-02, landing.  The reference fetches the report with one HTTP GET and
writes it to a driver-local file.  Here a fetch lands as an immutable folder
of gzipped, line-delimited JSON page files on shared storage; every later step reads
that folder with Spark.  ``land_driver_report`` lands pages derived from the
driver tables (``sources.fixtures``) once per input fingerprint and reuses
the folder afterwards.

SRC-01, scan.  Always with an explicit schema.  Line-delimited JSON is the
scalable default: a plain file splits into many partitions, and landed files,
which are gzipped, hold a bounded number of pages.  ``multiline=True``
reads one-document-per-file reports like the reference's; each such file is
a single partition, which is why it is not the default.
"""

from __future__ import annotations

import hashlib
import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline import schemas
from ledgerline.operators.flatten import explode_invoices
from ledgerline.operators.join import ids_are_unique
from ledgerline.session import create_exclusive, file_fingerprint, keyed_dir, path_exists, read_small
from ledgerline.sinks.parquet import COMPRESSION
from ledgerline.sources import fixtures

# The landing key includes the source text of the derivation and the schemas,
# so a changed derivation never reuses an older landing.
LANDING_VERSION = "v4"

PAGES_PER_FILE = 1000              # about 115 MB of JSON, 22 MB gzipped
PAGES_PER_DOCUMENT = 16            # about 2 MB of JSON; grouping holds 128 documents a task in memory at most
# The fastest level: a fifth of the JSON's size; the default's seventh costs three times the CPU.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}

PROFILE = "_profile.json"          # beside a flat set; Spark's readers skip the name

# One lock per landing folder: queries called from several threads of one
# driver wait for a landing in progress instead of writing it twice.
_LANDING_LOCKS: dict[str, threading.Lock] = {}
_LOCKS_GUARD = threading.Lock()


def _code_fingerprint() -> str:
    h = hashlib.sha1()
    for mod in (fixtures, schemas):
        with open(mod.__file__, "rb") as fh:
            h.update(fh.read())
    return h.hexdigest()[:12]


def read_report(spark: SparkSession, path: str | list[str], schema: StructType | None = schemas.PAGE,
                multiline: bool = False, mode: str = "FAILFAST",
                with_source: bool = False) -> DataFrame:
    """Scan report pages.

    ``mode="FAILFAST"`` makes a malformed page fail the job instead of
    turning into an all-NULL row that the explode would silently drop;
    ``"PERMISSIVE"`` gives Spark's default.  ``schema=None`` infers the
    schema like the reference did: an extra pass over the input, and a field
    absent from every page (or an empty ``list``) then fails analysis.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = (
        reader
        .option("multiLine", "true" if multiline else "false")
        .option("mode", mode)
        .json(path)
    )
    if with_source:
        df = df.withColumn("source_file", F.input_file_name())
    return df


def land_pages(pages: DataFrame, path: str) -> str:
    """Write report pages as line-delimited JSON (one page per line), gzipped.

    A gzipped file does not split, so a file holds ``PAGES_PER_FILE`` pages at most.
    """
    (pages.write.mode("overwrite").option("ignoreNullFields", "true").options(**GZIP)
        .option("maxRecordsPerFile", str(PAGES_PER_FILE)).json(path))
    return path


def land_documents(pages: DataFrame, path: str, pages_per_document: int = 1) -> str:
    """Write the report as JSON documents, one per file, read with ``multiline=True``.

    This is the reference's report shape: one document per file, all in one folder
    (``maxRecordsPerFile=1``; a folder per page would cost a listing each).  A file cannot
    be split further, which is why line-delimited pages are the landing format and this
    layout is kept for reports that arrive that way.

    A document is one page, or, gzipped, an array of up to ``pages_per_document`` pages with
    neighbouring numbers: a file costs its creation, listing and opening, whatever it holds.
    """
    if pages_per_document == 1:
        (pages.write.mode("overwrite").option("ignoreNullFields", "true")
            .option("maxRecordsPerFile", "1").json(path))
        return path
    page = F.to_json(F.struct(*pages.columns)).alias("page")
    documents = (pages.select(F.expr(f"page_no div {pages_per_document}").alias("document"), page)
                 .repartition("document").groupBy("document").agg(F.collect_list("page").alias("pages")))
    (documents.select(F.concat(F.lit("["), F.array_join("pages", ",\n"), F.lit("]")).alias("value"))
        .write.mode("overwrite").options(**GZIP).option("maxRecordsPerFile", "1").text(path))
    return path


def _landing_key(spark: SparkSession, sf_dir: str, *options: str) -> str:
    parts = [LANDING_VERSION, _code_fingerprint(), *options]
    parts += [file_fingerprint(spark, f"{sf_dir}/{name}.parquet") for name in ("orders", "lineitem")]
    return hashlib.sha1("#".join(parts).encode()).hexdigest()[:16]


def _once(spark: SparkSession, path: str, marker: str, build) -> None:
    """Build a folder unless its marker is there, also when several threads ask for it."""
    with _LOCKS_GUARD:
        lock = _LANDING_LOCKS.setdefault(path, threading.Lock())
    with lock:
        if not path_exists(spark, f"{path}/{marker}"):
            build()


def land_driver_report(spark: SparkSession, sf_dir: str, max_order_key: int | None = None,
                       min_order_key: int | None = None, layout: str = "lines") -> str:
    """Land the report derived from the tables in ``sf_dir``; reuse an earlier landing.

    ``layout="lines"`` writes line-delimited pages, ``"documents"`` one
    document of ``PAGES_PER_DOCUMENT`` pages per file (``land_documents``).  The folder name carries the
    derivation version, the layout and a fingerprint of the input files, so a
    changed input never reuses a stale landing.  A landing counts only once
    Spark's ``_SUCCESS`` marker is present.
    """
    writers = {"lines": land_pages, "documents": lambda pages, to: land_documents(pages, to, PAGES_PER_DOCUMENT)}
    if layout not in writers:
        raise ValueError(f"unknown landing layout: {layout}")
    key = _landing_key(spark, sf_dir, str(min_order_key), str(max_order_key), layout)
    path = keyed_dir(spark, "landing", key)
    _once(spark, path, "_SUCCESS",
          lambda: writers[layout](fixtures.report_pages(spark, sf_dir, max_order_key, min_order_key), path))
    return path


def land_driver_fetches(spark: SparkSession, sf_dir: str, ranges: list[tuple[int | None, int | None]]) -> str:
    """Land one fetch (``fetch-1``, ``fetch-2`` ...) for each (smallest, largest) order
    key under one report folder; reuse an earlier landing."""
    root = keyed_dir(spark, "fetches", _landing_key(spark, sf_dir, *map(str, ranges)))
    for n, (low, high) in enumerate(ranges, 1):
        path = f"{root}/fetch-{n}"
        _once(spark, path, "_SUCCESS",
              lambda p=path, lo=low, hi=high: land_pages(fixtures.report_pages(spark, sf_dir, hi, lo), p))
    return root


def flat_driver_report(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, bool]:
    """(the landed report as a flat set in Parquet, whether its invoice ids are unique).

    Flattened and profiled once per landing, as a load does it; both are kept beside
    each other, so later queries start no job to choose their join."""
    report = land_driver_report(spark, sf_dir)
    path = keyed_dir(spark, "flat", report.rstrip("/").rsplit("/", 1)[-1])

    def build():
        flat = explode_invoices(read_report(spark, report))
        flat.select(*[f.name for f in schemas.FLAT.fields]).write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
        unique = ids_are_unique(spark.read.schema(schemas.FLAT).parquet(path))
        create_exclusive(spark, f"{path}/{PROFILE}", json.dumps({"unique": unique}))

    _once(spark, path, PROFILE, build)
    return spark.read.schema(schemas.FLAT).parquet(path), json.loads(read_small(spark, f"{path}/{PROFILE}"))["unique"]
