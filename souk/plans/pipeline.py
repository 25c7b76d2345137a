"""End-to-end pipeline (M17) and layer sinks.

``build_all`` follows the reference's run order: bronze -> silver
(``jobs_unified`` materialised once) -> dimensions -> fact -> bridge.  Every
table of a build is written as Parquet under ``<out>/<layer>/<table>/<version>``;
when all are there, each table's pointer moves to the new version, so a build
that fails leaves every table as it was and can be taken up again.  The silver
table is read back before the gold builds, which cuts the lineage there: a lost
executor recomputes from the written table, not from bronze, and each dimension
scans only the columns it needs.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from souk.plans import gold, silver
from souk.session import checkpoint_dir

LAYERS = ("bronze", "silver", "gold")
POINTER = "_current"  # names a table's version; Spark's readers pass files with an underscore by
TOGETHER = 4  # tables of one build that are written at the same time


def schema_name(custom: str | None, target: str = "public") -> str:
    """A model's own layer name is used verbatim; without one, the target's."""
    return target if custom is None or not custom.strip() else custom.strip()


def layer_path(out_dir: str, layer: str | None, table: str, target: str = "public") -> str:
    """Where a layer's table is: the layer's name is its folder."""
    return f"{out_dir.rstrip('/')}/{schema_name(layer, target)}/{table}"


def create_layers(spark: SparkSession, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` for the three layers."""
    for layer in LAYERS:
        where = f" LOCATION '{location.rstrip('/')}/{layer}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}{where}")


def register_table(spark: SparkSession, layer: str, table: str, path: str) -> None:
    """``<layer>.<table>`` names the files under path: an external table,
    moved to the path where it is there with the same columns."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    name = f"{layer}.{table}"
    if spark.catalog.tableExists(name):
        if spark.table(name).schema.simpleString() == spark.read.parquet(path).schema.simpleString():
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=path, source="parquet")


def _storage(spark: SparkSession, path: str):
    """(file system, path) of any storage that Spark writes."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _storage(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove files that this library wrote, on whatever storage they are."""
    fs, p = _storage(spark, path)
    fs.delete(p, True)


def _has_partitions(spark: SparkSession, path: str) -> bool:
    fs, p = _storage(spark, path)
    return any(f.isDirectory() for f in fs.listStatus(p))


# ---------------------------------------------------------------- versions
def new_version() -> str:
    return f"v{_dt.datetime.now(_dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def current_version(spark: SparkSession, out_dir: str, layer: str, table: str) -> str | None:
    """The version that a table's pointer names; None without one."""
    fs, p = _storage(spark, f"{layer_path(out_dir, layer, table)}/{POINTER}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def publish(spark: SparkSession, out_dir: str, layer: str, table: str, version: str) -> None:
    """Readers get this version from now on: the pointer is written beside
    and renamed over the old one.  The version before it stays for readers that
    have begun; older ones and those of failed builds go."""
    folder = layer_path(out_dir, layer, table)
    before = current_version(spark, out_dir, layer, table)
    fs, beside = _storage(spark, f"{folder}/{POINTER}-{version}")
    stream = fs.create(beside, True)
    stream.write(bytearray(version.encode()))
    stream.close()
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    overwrite = sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    overwrite[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    files = hadoop.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    files.rename(fs.makeQualified(beside), fs.makeQualified(hadoop.Path(f"{folder}/{POINTER}")), overwrite)
    for f in fs.listStatus(hadoop.Path(folder)):
        if f.isDirectory() and f.getPath().getName() not in (version, before):
            fs.delete(f.getPath(), True)


def table_path(spark: SparkSession, out_dir: str, layer: str, table: str) -> str:
    """Where the published version of a table is."""
    version = current_version(spark, out_dir, layer, table)
    if version is None:
        raise FileNotFoundError(f"no published version of {layer}.{table} under {out_dir}")
    return f"{layer_path(out_dir, layer, table)}/{version}"


def read_table(spark: SparkSession, out_dir: str, layer: str, table: str) -> DataFrame:
    return spark.read.parquet(table_path(spark, out_dir, layer, table))


def append_bronze(df: DataFrame, out_dir: str, platform: str, batch_id: str | int | None = None, table: str | None = None) -> bool:
    """S6 + X26: append extracted rows to a raw table; an empty batch leaves
    nothing.  Returns whether rows were written.

    Each load is its own ``batch_id=<id>`` directory (partitioned inside by
    capture day) written in overwrite mode, so re-running a batch — a retried
    task set or a replayed micro-batch — replaces its rows instead of
    appending them twice.  Without an id, a unique run id is used.  The rows
    are extracted once: whether there were any shows in what was written.

    Files are sized by what was measured: REBALANCE puts small days together in
    one task and splits a day beyond
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` over as many as it needs.
    """
    batch = batch_id if batch_id is not None else f"{_dt.datetime.now(_dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    path = f"{layer_path(out_dir, 'bronze', table or f'{platform}_raw')}/batch_id={batch}"
    time = "scraped_at" if "scraped_at" in df.columns else "captured_at"
    day = df.withColumn("capture_date", F.to_date(time))
    day.hint("rebalance", "capture_date").write.mode("overwrite").partitionBy("capture_date").parquet(path)
    if not _has_partitions(df.sparkSession, path):
        delete_path(df.sparkSession, path)
        return False
    return True


def load_pages(pages: DataFrame, out_dir: str, platform: str, batch_id: str | int | None = None, max_chars: int | None = None) -> bool:
    """Captured pages -> the platform's raw table, and what could not be read
    -> ``bronze/<platform>_errors`` (X24).  Pages are walked once: both are
    made from a copy of the walk's rows, which goes when they are written."""
    from souk.operators.pages import RECORD_BUILDERS, page_errors, walked
    raw, copies = {}, []
    for kind, rows in walked(pages, platform).items():
        raw[kind], path = written_copy(rows, f"walk-{platform}-{kind}")
        copies.append(path)
    try:
        append_bronze(page_errors(raw), out_dir, platform, batch_id, table=f"{platform}_errors")
        return append_bronze(RECORD_BUILDERS[platform](None, raw, max_chars=max_chars), out_dir, platform, batch_id)
    finally:
        for path in copies:
            delete_path(pages.sparkSession, path)


def read_bronze(spark: SparkSession, out_dir: str, platform: str, since=None, until=None) -> DataFrame:
    """Scan one raw table with its explicit schema (no inference); with
    ``since`` / ``until`` (days, the second not included) only their folders."""
    from souk.sources.schemas import bronze_schema
    schema = bronze_schema(platform).add("batch_id", "string").add("capture_date", "date")
    raw = spark.read.schema(schema).parquet(layer_path(out_dir, "bronze", f"{platform}_raw"))
    if since is not None:
        raw = raw.where(F.col("capture_date") >= F.lit(since).cast("date"))
    return raw if until is None else raw.where(F.col("capture_date") < F.lit(until).cast("date"))


def captured_on(raw: DataFrame, days: DataFrame) -> DataFrame:
    """S1 through the calendar: raw rows captured on the days of a ``dim_date``
    selection, with its columns.  Days are unique, so it is a filter: Spark
    runs the selection first and scans only its days' folders (dynamic pruning)."""
    return raw.join(F.broadcast(days), raw["capture_date"] == days["full_date"]).drop("full_date")


MERGE_PARTS = 64  # folders of the merged table: a load rewrites those that its urls fall into


def merge_unified(spark: SparkSession, staged: DataFrame, out_dir: str, table: str = "jobs_merged", parts: int = MERGE_PARTS) -> DataFrame:
    """M5 over loads: the latest capture of each url, kept up to date load by load.

    Rows live in ``url_part=<hash of url>`` folders.  A load is de-duplicated
    with what its own folders hold and only those are written again (dynamic
    partition overwrite); the files of all others stay as they are.  The merged
    rows are written beside first, so a failure before the swap changes nothing.
    """
    path = layer_path(out_dir, "silver", table)
    part = F.pmod(F.xxhash64("url"), F.lit(parts)).cast("int")
    batch, beside = written_copy(staged.withColumn("url_part", part), "merge-batch")
    both = batch
    touched = [r[0] for r in batch.select("url_part").distinct().collect()]  # at most ``parts``
    if path_exists(spark, path):
        there = spark.read.parquet(path).where(F.col("url_part").isin(touched)).select(*batch.columns)
        both = batch.unionByName(there)
    merged, copy = written_copy(silver.jobs_unified(both.drop("url_part")).withColumn("url_part", part), "merge-rows")
    (merged.hint("rebalance", "url_part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("url_part").parquet(path))
    for done in (beside, copy):
        delete_path(spark, done)
    return spark.read.parquet(path).drop("url_part")


def register_staging_views(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Staging models are views — lazy frames registered by name."""
    views = {}
    for platform, raw in bronze.items():
        views[f"stg_{platform}"] = silver.stage(raw, platform)
        views[f"stg_{platform}"].createOrReplaceTempView(f"stg_{platform}")
    return views


def write_table(df: DataFrame, out_dir: str, layer: str, table: str, sort_by: list[str] | None = None, version: str | None = None) -> str:
    """Full-refresh table sink: a version of its own, published at once
    unless the caller names the version (and publishes when all is there).
    ``sort_by`` orders all rows (the reference's ``ORDER BY``, O1): files hold
    ranges of it, in the order of their names."""
    path = f"{layer_path(out_dir, layer, table)}/{version or (own := new_version())}"
    if sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    df.write.mode("overwrite").parquet(path)
    if version is None:
        publish(df.sparkSession, out_dir, layer, table, own)
    return path


def order_violations(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """O1 read back: (n_rows, n_violations), files taken in the order of their
    names.  Compared are neighbouring rows of a block that Spark reads, and its
    first row with the last of the block before."""
    from pyspark.sql import Window
    rows = spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.struct(*keys).alias("key"), F.monotonically_increasing_id().alias("row"))
    within = Window.partitionBy("file", "block").orderBy("row")
    blocks = rows.withColumn("before", F.lag("key").over(within)).groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("before") > F.col("key")).cast("long")).alias("inside"),
        F.min_by("key", "row").alias("first"), F.max_by("key", "row").alias("last"))
    # a row for each block of a file: few
    edges = blocks.withColumn("cut", (F.lag("last").over(Window.orderBy("file", "block")) > F.col("first")).cast("long"))
    wrong = F.coalesce(F.sum("inside"), F.lit(0)) + F.coalesce(F.sum("cut"), F.lit(0))
    return edges.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), wrong.cast("long").alias("n_violations"))


BUCKETS = 16  # of both sides of a bucketed join; set it with their size


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """A table whose files are dealt and sorted by key, one file a bucket."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    (df.repartition(buckets, key).sortWithinPartitions(key).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return spark.table(name)


def join_bucketed(rows: DataFrame, dim: DataFrame, key: str, names: tuple[str, str], out_dir: str, buckets: int = BUCKETS) -> DataFrame:
    """J3 for tables that are joined again and again: rows ⟕ dim on key, both
    written in buckets of the key, so a join shuffles nothing.

    A bucket can't be split, so a key with more than one ``HOT_PARTS``-th of
    all rows isn't put in one: its rows stay as they are and meet their row of
    the dimension by broadcast (there are fewer than ``HOT_PARTS`` such keys).
    Rows without a key need no meeting.
    """
    total = rows.count()
    hot = [r[0] for r in rows.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") * gold.HOT_PARTS > total).collect()]
    apart = F.col(key).isNull() | F.col(key).isin(hot) if hot else F.col(key).isNull()
    left = write_bucketed(rows.where(~apart), names[0], f"{out_dir.rstrip('/')}/{names[0]}", key, buckets)
    right = write_bucketed(dim, names[1], f"{out_dir.rstrip('/')}/{names[1]}", key, buckets)
    few = F.broadcast(dim.where(F.col(key).isin(hot) if hot else F.lit(False)))
    return left.join(right.hint("merge"), key, "left").unionByName(rows.where(apart).join(few, key, "left"))


def written_copy(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """A Parquet copy of df under the session's shared checkpoint folder, and
    where it is: the caller deletes it when it is done."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame) -> DataFrame:
    """df computed once and kept in the shared checkpoint folder; Spark
    removes the files when nothing refers to them any more."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _together(spark: SparkSession, jobs: dict[str, Callable[[], str]]) -> dict[str, str]:
    """Tables that don't need one another, some at a time; the first error is raised when those begun have ended."""
    with ThreadPoolExecutor(TOGETHER) as pool:
        begun = {name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()}
    return {name: future.result() for name, future in begun.items()}


def build_all(spark: SparkSession, bronze: dict[str, DataFrame] | DataFrame, out_dir: str, asof=None, grain_safe: bool = False,
              register: bool = False, version: str | None = None, prefix: str = "") -> dict[str, str]:
    """Build silver and gold from bronze; returns table -> path.

    ``bronze`` is either ``{platform: raw table}`` or one combined raw frame
    with a ``source`` column.  Dimension files come out in id order (the
    numbering range-partitions on the order key); the bridge is sorted by
    (job_id, skill_id).  Dimensions are written side by side, then the fact,
    then the bridge.  Nothing is published before all tables are written; a
    build that failed is taken up by its ``version``: tables that it has
    finished (Spark's ``_SUCCESS`` is there) are not built again.
    ``register`` also names the tables ``silver.…`` and ``gold.…`` (S9), with
    ``prefix`` before the layer.
    """
    version = version or new_version()
    layer = lambda table: "silver" if table == "jobs_unified" else "gold"
    paths: dict[str, str] = {}

    def job(table: str, make: Callable[[], DataFrame], sort_by: list[str] | None = None) -> Callable[[], str]:
        path = f"{layer_path(out_dir, layer(table), table)}/{version}"
        done = path_exists(spark, f"{path}/_SUCCESS")
        return lambda: path if done else write_table(make(), out_dir, layer(table), table, sort_by, version)

    def unified() -> DataFrame:
        if isinstance(bronze, DataFrame):
            staged = silver.stage_all(bronze)
        else:
            staged = silver.union_staged(list(register_staging_views(bronze).values()))
        return silver.jobs_unified(staged)

    paths["jobs_unified"] = job("jobs_unified", unified)()
    jobs = spark.read.parquet(paths["jobs_unified"])
    narrow = gold.without_texts(jobs)
    makers = gold.dimension_makers(spark, narrow, asof, grain_safe)
    small = ("dim_source", "dim_skill", "dim_date")
    paths |= _together(spark, {n: job(n, (lambda m=m: m().coalesce(1)) if n in small else m) for n, m in makers.items()})
    dims = {name: spark.read.parquet(path) for name, path in paths.items() if name.startswith("dim_")}
    last = {f"{n}_variants": job(f"{n}_variants", lambda n=n: gold.variants(narrow, n, None if grain_safe else dims[f"dim_{n}"])) for n in gold.VARIANTS}
    last["fct_jobs"] = job("fct_jobs", lambda: gold.fct_jobs(spark, jobs, dims, grain_safe=grain_safe))
    paths |= _together(spark, last)
    fct = spark.read.parquet(paths["fct_jobs"]).select("url")
    paths["bridge_job_skill"] = job("bridge_job_skill", lambda: gold.bridge_job_skill(jobs, fct), ["job_id", "skill_id"])()
    for table in paths:
        publish(spark, out_dir, layer(table), table, version)
    if register:
        for table, path in paths.items():
            register_table(spark, f"{prefix}{layer(table)}", table, path)
    return paths
