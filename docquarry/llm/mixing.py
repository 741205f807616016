"""Mixing sources to target weights by Poisson replication.

A group (a source with a target weight, or all others together) of n rows that
is to hold a share w of a corpus of N rows has a mean repetition rate of w N / n.
Each document's count is the inverse of that Poisson distribution at a number
in [0, 1) that its doc_id and the seed hash to; the row is exploded by its count
and dealt, with all others, to places given by another hash. A row without a
doc_id goes by its source and text instead.

The number of groups is the number of given weights plus one, so the table of
rates is of a known size and can be broadcast; the rows of a hot source never
meet in one task. The distribution's table is built outward from its mode, so
no rate underflows it.

Cases: a null source belongs to the others; rows of one doc_id have one count
and are repeated each, and lie apart if their texts differ; rows without a
doc_id are told apart by source and text; a group without rows
is not made up for; a weight of zero drops its source; an empty table gives an
empty result; null and long texts are carried as they are. All columns are
kept; one called copy_number is replaced by the copy's number, from 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Shares of the mix; what is left goes to all other sources together.
WEIGHTS = {"src0": 0.15, "src1": 0.10, "src2": 0.10, "src3": 0.05, "src4": 0.02}
SEED = 17
MOST_WEIGHTS = 10_000


def name_of(doc_id: Column, source: Column, text: Column) -> Column:
    """What a row's draw goes by."""
    return F.coalesce(doc_id.cast("string"), F.concat(F.md5(F.coalesce(text, F.lit(""))), F.lit(":"), F.coalesce(source, F.lit(""))))


def uniform(name: Column, seed: int) -> Column:
    """A number in [0, 1) of 52 bits from a hash of the name."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), name))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(2.0**52)


def rest_of(values: Column) -> Column:
    return F.slice(values, F.lit(2), F.size(values))


def distribution(rate: Column) -> Column:
    """Cumulative chances (k, c) of a Poisson distribution: from below its mode to above it, as far as doubles can tell."""
    reach = F.ceil(12 * F.sqrt(rate) + 40).cast("long")
    mode = F.floor(rate).cast("long")
    low, high = F.greatest(F.lit(0).cast("long"), mode - reach), mode + reach
    grown = lambda steps, factor: F.aggregate(steps, F.array(F.lit(1.0)), lambda acc, k: F.concat(acc, F.array(F.element_at(acc, -1) * factor(k))))
    none = F.array().cast("array<bigint>")
    down = F.when(mode > low, F.sequence(mode, low + 1, F.lit(-1).cast("long"))).otherwise(none)
    below = F.reverse(grown(down, lambda k: k.cast("double") / rate))
    above = rest_of(grown(F.sequence(mode + 1, high), lambda k: rate / k.cast("double")))
    weights = F.concat(below, above)
    sums = F.aggregate(weights, F.array(F.lit(0.0)), lambda acc, w: F.concat(acc, F.array(F.element_at(acc, -1) + w)))
    return F.struct(low.alias("low"), F.transform(rest_of(sums), lambda c: c / F.element_at(sums, -1)).alias("cumulated"))


def group_of(source: Column, weights: dict[str, float]) -> Column:
    return F.coalesce(F.when(source.isin(*weights), source), F.lit("")) if weights else F.lit("")


def rates(docs: DataFrame, weights: dict[str, float], scale: float = 1.0) -> DataFrame:
    """(group, rate, table of the distribution): at most one row more than there are weights. The group of all others is ''."""
    if len(weights) > MOST_WEIGHTS or "" in weights or min([0.0, *weights.values()]) < 0 or sum(weights.values()) > 1 + 1e-9:
        raise ValueError("weights are shares of named sources, at most 10,000")
    rest = max(0.0, 1.0 - sum(weights.values()))
    sizes = docs.groupBy(group_of(F.col("source"), weights).alias("__group")).agg(F.count("*").alias("__n"))
    total = sizes.agg(F.sum("__n").alias("__total"))
    share = F.lit(float(rest))
    for name, w in weights.items():
        share = F.when(F.col("__group") == name, F.lit(float(w))).otherwise(share)
    # one row of one number beside at most 10,001 rows
    out = sizes.join(F.broadcast(total)).withColumn("__rate", share * F.lit(float(scale)) * F.col("__total") / F.col("__n"))
    return out.select("__group", "__rate", distribution(F.col("__rate")).alias("__dist"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, seed: int = SEED, scale: float = 1.0) -> DataFrame:
    """The mixed and globally shuffled corpus: the columns of ``docs`` and copy_number.

    ``scale`` is the size of the mix as a multiple of the rows given.
    """
    weights = WEIGHTS if weights is None else weights
    names = [c for c in docs.columns if c != "copy_number"]
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("__row"), name_of(F.col("doc_id"), F.col("source"), F.col("text")).alias("__id"), F.xxhash64("source", "text").alias("__text"), group_of(F.col("source"), weights).alias("__key"))
    packed = packed.withColumn("__u", uniform(F.col("__id"), seed))
    table = F.broadcast(rates(docs, weights, scale))  # at most 10,001 rows
    rated = packed.join(table, packed["__key"] == table["__group"])
    # the least k whose cumulated chance is over u
    count = F.when(F.col("__rate") <= 0, F.lit(0).cast("long")).otherwise(F.col("__dist.low") + F.size(F.filter("__dist.cumulated", lambda c: c <= F.col("__u"))))
    copies = rated.withColumn("__n", count).where("__n > 0").select("__row", "__id", "__text", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n"))).alias("copy_number")).withColumn("copy_number", F.col("copy_number").cast("int"))
    place = F.xxhash64(F.lit(seed + 1), "__id", "__text", "copy_number")
    dealt = copies.withColumn("__place", place).repartition(F.col("__place")).sortWithinPartitions("__place", "__id", "copy_number")
    return dealt.select("__row.*", "copy_number")


def oracle(weights: dict[str, float] | None = None, seed: int = SEED) -> str:
    """The same rows in DuckDB SQL, with the chances summed from zero; for rates that doubles can hold there (below about 700)."""
    weights = WEIGHTS if weights is None else weights
    rest = max(0.0, 1.0 - sum(weights.values()))
    listed = ", ".join(f"'{s}'" for s in weights)
    cases = " ".join(f"WHEN '{s}' THEN {w!r}::DOUBLE" for s, w in weights.items())
    return f"""
WITH RECURSIVE keyed AS (
  SELECT *, CASE WHEN source IN ({listed}) THEN source ELSE '' END AS g,
         ('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')) || ':' || coalesce(source, ''))), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM documents),
sizes AS (SELECT g, count(*) AS n FROM keyed GROUP BY g),
rated AS (SELECT g, CASE g {cases} ELSE {rest!r}::DOUBLE END * (SELECT sum(n) FROM sizes)::DOUBLE / n AS rate FROM sizes),
dist AS (
  SELECT g, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM rated WHERE rate > 0
  UNION ALL
  SELECT g, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM dist WHERE k < rate + 12 * sqrt(rate) + 40),
tables AS (SELECT g, list(c ORDER BY k) AS cs FROM dist GROUP BY g),
counted AS (SELECT keyed.*, len(list_filter(cs, lambda c: c <= u)) AS n FROM keyed JOIN tables USING (g))
SELECT * EXCLUDE (g, u, n, copy_number), CAST(copy_number AS INTEGER) AS copy_number
FROM (SELECT *, unnest(range(1, n + 1)) AS copy_number FROM counted WHERE n > 0)"""
