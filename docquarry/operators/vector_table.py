"""The keyed chunk table: embedding merge, upserts, provenance, deletion and nearest chunks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import StructType

from docquarry.functions import vectors as V
from docquarry.functions.text import short_hash
from docquarry.operators import nearest

QUERY_BLOCK = 8_000_000  # components of queries that one scan holds, 64 MB
VECTORS = ("embedding", "embedding_summary_chunk", "embedding_summary_page")


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row of each key: the last by ``order``. An aggregation, so a hot key is combined before the shuffle."""
    others = [c for c in rows.columns if c not in (key, order)]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*others, order), F.struct(order, *(F.col(c) for c in others if not rows.schema[c].dataType.typeName() == "map"))).alias("_r"))
    return best.select(key, "_r.*").select(*rows.columns)


def upsert(existing: DataFrame, incoming: DataFrame, key: str, order: str) -> DataFrame:
    """The table after incoming rows replace those of their key; of several for a key the last by ``order`` wins, rows without a key are dropped."""
    new = latest(incoming.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != ""), key, order).drop(order)
    kept = existing.join(new.select(key), key, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def delete_ids(table: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    return table.join(ids.select(key).distinct(), key, "left_anti")


def with_missing_vectors(sidecar: DataFrame) -> DataFrame:
    """A sidecar with all vector columns; those that it lacks are null."""
    return sidecar.withColumns({c: F.lit(None).cast("array<float>") for c in VECTORS if c not in sidecar.columns})


def merge_embeddings(chunks: DataFrame, sidecar: DataFrame, order: str = "pos") -> DataFrame:
    """Chunks with the sidecar's vectors: the last row of an id wins, an empty vector is null, unmatched chunks keep what they had."""
    side = latest(with_missing_vectors(sidecar).select("id", *VECTORS, order), "id", order).drop(order)
    side = side.select("id", F.lit(True).alias("_hit"), *(V.usable(F.col(c)).alias(f"_{c}") for c in VECTORS))
    joined = chunks.join(side, "id", "left")
    for c in VECTORS:
        had = F.col(c) if c in chunks.columns else F.lit(None).cast("array<float>")
        joined = joined.withColumn(c, F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(had))
    return joined.drop("_hit", *(f"_{c}" for c in VECTORS))


def vector_counts(chunks: DataFrame) -> DataFrame:
    return chunks.agg(*(F.count(c).alias(f"n_{c}") for c in VECTORS))


def vector_dimension(chunks: DataFrame, column: str = "embedding") -> DataFrame:
    """The one dimension of a column's vectors (null if they differ), with the extremes."""
    size = F.when(F.col(column).isNotNull(), F.size(column))
    out = chunks.agg(F.min(size).alias("least_dim"), F.max(size).alias("most_dim"), F.count(size).alias("n_vectors"))
    return out.withColumn("dim", F.when(F.col("least_dim") == F.col("most_dim"), F.col("least_dim")))


def distinct_encoded(chunks: DataFrame, text: str, encode, vector: str) -> DataFrame:
    """A vector for each chunk's text, each distinct text being encoded once. ``encode``: DataFrame (text) -> (text, vector)."""
    made = encode(chunks.where(F.coalesce(F.col(text), F.lit("")) != "").select(F.col(text).alias("text")).distinct()).select(F.col("text").alias("_encoded"), F.col("vector").alias(vector))
    return chunks.join(made, F.col(text) == F.col("_encoded"), "left").drop("_encoded")


def provenance_id(fields: list[Column]) -> Column:
    """A name from the content of the settings, so equal settings share it."""
    return F.concat(F.lit("prov_"), short_hash(F.concat_ws("|", *(F.coalesce(f.cast("string"), F.lit("")) for f in fields)), "sha1", 12))


def flat_provenance(prov: DataFrame) -> DataFrame:
    """Nested provenance as the columns of its table."""
    return prov.select(
        "prov_id", F.col("timestamp").alias("created_at"), F.col("chunk.model").alias("chunk_model"), F.col("chunk.chunk_size_range").alias("chunk_size_range"), F.col("chunk.keyword_density").alias("keyword_density"),
        F.col("summary.model").alias("summary_model"), F.col("summary.prompt").alias("summary_prompt"), F.col("summary.size").alias("summary_size"), F.col("summary.temperature").alias("summary_temperature"),
        F.col("embed.model").alias("embed_model"), F.col("embed.vectorsize").alias("embed_vectorsize"),
    )


def stamped(chunks: DataFrame, prov: DataFrame) -> DataFrame:
    """All chunks under the one provenance of the run (one row)."""
    return chunks.drop("prov_id").join(F.broadcast(prov.select("prov_id").limit(1)))


def three_way_preview(chunks: DataFrame, provenance: DataFrame, vectors: DataFrame, n: int = 3) -> DataFrame:
    """The first n chunks with their provenance and the first five components of their vectors."""
    joined = chunks.join(provenance, "prov_id").join(vectors, "id")
    return joined.select("id", "prov_id", F.slice("embedding", 1, 5).alias("head")).orderBy("id").limit(n)


def cosine_top_k(queries: DataFrame, rows: DataFrame, k: int = 10, key: str = "vec_id", column: str = "embedding", block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, key, similarity): exact search for a stated set of queries, in blocks of about ``block`` components.

    The sizes of both sides are read first. Each block of queries goes to all tasks
    of a scan of its own, so no broadcast grows with the set; rows are dealt evenly,
    as a small file would else be one task. A task keeps k rows for each query, and
    the window ranks those of all tasks.
    """
    spark = rows.sparkSession
    q = nearest.numbered(queries.select(F.col(key).alias("query_id"), F.col(column).alias("_q")), "_q").where(F.col("query_id").isNotNull())
    v = nearest.numbered(rows.select(F.col(key), F.col(column).alias("_v")), "_v").where(F.col(key).isNotNull())
    held = q.agg(F.coalesce(F.sum(F.size("_q")), F.lit(0)).alias("n")).first().n
    blocks = max(1, -(-held // block))
    parts = nearest.tasks(spark, held / blocks * v.count())
    dealt = F.pmod(F.xxhash64("query_id", F.lit(5)), F.lit(blocks))
    local = union_all([nearest.scanned(v.repartition(parts), q if blocks == 1 else q.where(dealt == i), k) for i in range(blocks)])
    place = W.partitionBy("query_id").orderBy(F.desc("similarity"), F.asc(key))
    return local.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", key, "similarity")


def valid_embeddings(rows: DataFrame, dim: int) -> DataFrame:
    """Rows fit for the sidecar: an id, and a vector of ``dim`` numbers."""
    v = F.col("embedding")
    return rows.where(F.col("id").isNotNull() & (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def checked_dimension(rows: DataFrame, wanted: int, fail: bool = True, column: str = "embedding") -> int | None:
    """The one dimension of a column's vectors. If it is not ``wanted``, or there are several, that is an error, or with ``fail`` off None."""
    found = vector_dimension(rows, column).first()
    if found.dim == wanted:
        return wanted
    if fail:
        raise ValueError(f"vectors of {found.least_dim} to {found.most_dim} numbers where {wanted} are configured")
    return None


def require_vectors(chunks: DataFrame, column: str = "embedding") -> DataFrame:
    """The chunks, if any has a vector: a table without one would only lose what is there."""
    if chunks.where(F.col(column).isNotNull()).isEmpty():
        raise ValueError(f"no chunk has {column}; nothing is written")
    return chunks


def evolved(table: DataFrame, wanted: StructType) -> DataFrame:
    """An existing table with the columns that it lacks, as nulls; its own stay, and a column of another type is an error."""
    for f in wanted.fields:
        if f.name not in table.columns:
            table = table.withColumn(f.name, F.lit(None).cast(f.dataType))
        elif table.schema[f.name].dataType != f.dataType:
            raise TypeError(f"{f.name} is {table.schema[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}")
    return table


def reconciled(table: DataFrame, dim: int) -> DataFrame:
    """A table fit for vectors of ``dim`` numbers: an empty one is made anew with null vectors, one that holds another dimension is an error."""
    held = vector_dimension(table).first()
    if held.n_vectors and not (held.least_dim == held.most_dim == dim):
        raise ValueError(f"the table holds vectors of {held.least_dim} to {held.most_dim} numbers; {dim} would need it rebuilt")
    return with_missing_vectors(table)
