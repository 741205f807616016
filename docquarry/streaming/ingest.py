"""Incremental ingestion: new files become chunks and are merged into the keyed table, batch by batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docquarry.operators import headings
from docquarry.operators.vector_table import upsert

BUCKETS = 64  # of a table; a batch rewrites those that it touches
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def stream_documents(spark: SparkSession, path: str, schema: str = DOCUMENTS) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def versions(spark: SparkSession, root: str) -> list[int]:
    """The finished versions of a table under ``root``, in order."""
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(place):
        return []
    names = [f.getPath().getName() for f in store.listStatus(place)]
    done = lambda n: store.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{n}/_SUCCESS"))
    return sorted(int(n.removeprefix("manifest=")) for n in names if n.startswith("manifest=") and done(n))


def manifest(spark: SparkSession, root: str, version: int) -> dict[int, int]:
    """Which version holds each bucket of a version of the table; at most as many entries as there are buckets."""
    return {r.bucket: r.version for r in spark.read.schema("bucket int, version int").json(f"{root}/manifest={version}").collect()}


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def held(spark: SparkSession, root: str, places: dict[int, int]) -> DataFrame | None:
    """The rows of the buckets in ``places``."""
    paths = [f"{root}/version={v}/_bucket={b}" for b, v in sorted(places.items())]
    return spark.read.parquet(*paths) if paths else None


def current(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of a version, by default the last finished one."""
    done = versions(spark, root)
    if not done or version is not None and version not in done:
        raise FileNotFoundError(f"no version {'' if version is None else version} of {root}")
    return held(spark, root, manifest(spark, root, done[-1] if version is None else version))


def merge_batch(spark: SparkSession, root: str, batch: DataFrame, batch_id: int, key: str = "id", order: str = "ord", buckets: int = BUCKETS) -> int:
    """The table after one batch, as a new version; a batch that runs again writes the same version again.

    Keys are dealt to buckets by a hash. A version's files are the buckets that its
    batch touches, and its manifest, written last, says which version holds each
    bucket; the others stay where they are. The first batch makes the table. Any
    other needs the version of the batch before: if that is gone the batch fails,
    as its rows alone are not the table.
    """
    if batch_id and batch_id - 1 not in versions(spark, root):
        raise FileNotFoundError(f"version {batch_id - 1} of {root} is missing")
    places = manifest(spark, root, batch_id - 1) if batch_id else {}
    new = batch.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "").withColumns({"_order": F.col(order), "_bucket": bucket_of(key, buckets)})
    touched = {r[0] for r in new.select("_bucket").distinct().collect()}  # at most as many rows as there are buckets
    old = held(spark, root, {b: v for b, v in places.items() if b in touched})
    merged = upsert(batch.limit(0) if old is None else old, new.drop("_bucket"), key, "_order").withColumn("_bucket", bucket_of(key, buckets))
    merged.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{root}/version={batch_id}")
    now = sorted((places | dict.fromkeys(touched, batch_id)).items())
    spark.createDataFrame(now, "bucket int, version int").coalesce(1).write.mode("overwrite").json(f"{root}/manifest={batch_id}")
    return batch_id


def ingest(spark: SparkSession, path: str, root: str, checkpoint: str) -> StreamingQuery:
    """Chunks of the documents under ``path`` merged into versions under ``root``, each file once.

    All files that are there are taken and the query ends; run again for those
    that came since.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = headings.chunks(headings.synthetic_markdown(batch))
        merge_batch(batch.sparkSession, root, rows, batch_id)

    return stream_documents(spark, path).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tokens_by_window(events: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Counts and sums by event type and window, for events at most ``late`` late."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))
