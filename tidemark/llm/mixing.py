"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Every source gets a weight; the mix has ``share`` times the words of all
documents. A source's target stops at ``most`` times its size and the excess goes
to the others by weight (water filling, solved exactly on the source table).
The targets become integer numbers of blocks of ``block`` words by the highest
quotients target / (2k - 1); a source's blocks are dealt to its shards in
the same way by shard size. A shard is a seeded hash order of some
``docs_per_shard`` documents, read as one run of words cut into blocks: its
quota is a number of whole passes and, for the rest, a seeded run of
consecutive blocks, so that only documents at the run's two ends are cut.

The tables of sources and shards have one row each per source and per
``docs_per_shard`` documents; no group holds more than a shard, however large
its source is.

Defined cases: null text has size 0 and is never taken; a null source is a source
of its own, the last; a null doc_id counts as an empty one in the hash order;
repeated rows are documents of their own (the result is the same bag of rows on
every run); an empty table or one without words takes nothing. Only the
named columns are read; other columns and their names do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved, table

WORD = r"[^\x20\x09-\x0D]+"


def _hash32(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def water_fill(sources: DataFrame, weights: list[int], share: float, most: int) -> DataFrame:
    """Add rn (code point order, null last), weight and target to (source, source_size, n_docs)."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    s = sources.withColumn("rn", F.row_number().over(order)).withColumn("weight", F.element_at(cycle, (F.col("rn") - 1) % len(weights) + 1).cast("long"))
    every = Window.partitionBy(F.lit(1))
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), "rn")
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    left = F.lit(float(share)) * F.sum("source_size").over(every) - F.lit(float(most)) * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    # the level is right when all sources before a row are full and it is not: the highest of these
    s = s.withColumn("level", left / F.sum("weight").over(after))
    s = s.withColumn("level", F.max("level").over(every))
    return s.withColumn("target", F.least(F.lit(float(most)) * F.col("source_size"), F.col("level") * F.col("weight"))).drop("level")


def apportion(parties: DataFrame, group: list[str], votes: str, seats: str, order: str) -> DataFrame:
    """Add ``quota``: of each group's ``seats``, one for each of the highest quotients votes / (2k - 1).

    A party's number of seats is within half the number of parties, times its share, of its exact part, so
    only the quotients in that range are ranked: about three for each party.
    """
    w = Window.partitionBy(*[F.col(g) for g in group])
    p = parties.withColumn("_p", F.coalesce(F.try_divide(F.col(votes).cast("double"), F.sum(votes).over(w)), F.lit(0.0))).withColumn("_n", F.count(F.lit(1)).over(w) / 2)
    p = p.withColumn("_lo", F.greatest(F.lit(0), F.floor(F.col("_p") * (F.col(seats) - F.col("_n")) - 0.5)).cast("long"))
    p = p.withColumn("_hi", F.when(F.col(votes) > 0, F.ceil(F.col("_p") * (F.col(seats) + F.col("_n")) + 0.5) + 1).otherwise(0).cast("long"))
    p = p.withColumn("_left", F.col(seats) - F.sum("_lo").over(w))
    k = p.withColumn("_k", F.explode_outer(F.when(F.col("_hi") > F.col("_lo"), F.sequence(F.col("_lo") + 1, F.col("_hi")))))
    by_quotient = w.orderBy((F.col(votes) / (2 * F.col("_k") - 1)).desc_nulls_last(), F.col(order), F.col("_k"))
    k = k.withColumn("_won", (F.col("_k").isNotNull() & (F.row_number().over(by_quotient) <= F.col("_left"))).cast("long"))
    keep = [c for c in parties.columns]
    return k.groupBy(*keep, "_lo").agg((F.col("_lo") + F.sum("_won")).alias("quota")).drop("_lo")


def mix(docs: DataFrame, weights: list[int] = [3, 1, 2], share: float = 1.5, most: int = 2, block: int = 16, docs_per_shard: int = 1000, seed: str = "mix", carry: tuple[str, ...] = ()) -> DataFrame:  # noqa: B006
    """One row per row of ``docs`` (doc_id, source, size): its source's size and target, ``taken`` words, and the columns of ``carry``.

    Also: ``passes``, how many times the whole document is taken, and ``start``, ``run_from``,
    ``run_len``, ``blocks``: where it begins in its shard and the run of blocks taken once more.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    sources = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    s = water_fill(sources, weights, share, most)
    s = s.withColumn("one", F.lit(1)).withColumn("seats", F.floor(F.sum("target").over(Window.partitionBy("one")) / block + 0.5).cast("long"))
    s = apportion(s, ["one"], "target", "seats", "rn").select("rn", "source", "source_size", "target", F.col("quota").alias("source_quota"), F.ceil(F.col("n_docs") / docs_per_shard).cast("long").alias("n_shards"))
    s = saved(s, "mix-sources")  # one row per source
    d = docs.alias("d").join(s.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select("d.doc_id", "d.size", *(f"d.{c}" for c in carry), "s.rn", "s.source_size", "s.target", "s.n_shards")
    d = d.withColumn("shard", _hash32(F.concat(F.lit(f"{seed}:s:"), key)) % F.col("n_shards")).drop("n_shards")
    shards = d.groupBy("rn", "shard").agg(F.sum("size").alias("shard_size")).join(s.select("rn", "source_quota"), "rn")
    shards = apportion(shards, ["rn"], "shard_size", "source_quota", "shard")
    n = F.ceil(F.col("shard_size") / block).cast("long")
    shards = shards.where("shard_size > 0").select("rn", "shard", n.alias("blocks"), F.least("quota", most * n).alias("quota"))
    shards = shards.withColumn("run_len", F.col("quota") % F.col("blocks")).withColumn("passes", F.floor(F.col("quota") / F.col("blocks")).cast("long"))
    shards = shards.withColumn("run_from", _hash32(F.concat(F.lit(f"{seed}:r:"), F.col("rn").cast("string"), F.lit(":"), F.col("shard").cast("string"))) % F.col("blocks")).drop("quota")
    # a running sum within each shard; then its quota
    order = Window.partitionBy("rn", "shard").orderBy(_hash32(F.concat(F.lit(f"{seed}:o:"), key)), "doc_id", "size")
    d = d.withColumn("start", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    d = d.join(shards, ["rn", "shard"], "left")
    begin, end, words = F.col("run_from") * block, (F.col("run_from") + F.col("run_len")) * block, F.col("blocks") * block

    def inside(lo: Column, hi: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("start") + F.col("size"), hi) - F.greatest(F.col("start"), lo))

    run = inside(begin, F.least(end, words)) + inside(F.lit(0), end - words)  # a run past the last block goes on at the first
    taken = F.coalesce(F.col("passes") * F.col("size") + run, F.lit(0))
    return d.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "passes", "start", "run_from", "run_len", "blocks", *carry)


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size) of every row: size is the number of words of the whole text."""
    return docs.select("doc_id", "source", F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("size"))


def mixed(docs: DataFrame, block: int = 16) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, the columns of ``docs``.

    Whole passes repeat the row. Where the run of blocks cuts a document, a further row has the words
    of the run, joined by spaces; documents of which nothing is taken are left out. ``n_chars``, if there, is counted anew.
    """
    rows = docs.select("doc_id", "source", F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("size"), F.struct(*docs.columns).alias("row"))
    m = mix(rows, block=block, carry=("row",))
    text, extra = F.col("row")["text"], F.col("taken") - F.coalesce(F.col("passes"), F.lit(0)) * F.col("size")
    at = lambda i: F.floor((F.col("start") + i) / block)
    cut = F.filter(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda _, i: F.pmod(at(i) - F.col("run_from"), F.col("blocks")) < F.col("run_len"))
    none = F.array().cast("array<string>")
    more = F.when(extra == F.col("size"), F.array(text)).when(extra > 0, F.array(F.array_join(cut, " "))).otherwise(none)
    m = m.where("taken > 0").withColumn("text", F.explode(F.concat(F.array_repeat(text, F.col("passes").cast("int")), more)))
    new = {"text": F.col("text"), **({"n_chars": F.char_length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})}
    return m.select(*[new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns])


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents: weights 3, 1, 2 repeating, 150 % of all words, at most twice each source."""
    docs = saved(measured(table(spark, sf_dir, "documents")), "mix-sizes")  # read by three steps: counted once
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


OP5_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), s0 AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_docs FROM docs GROUP BY source
), s1 AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rn FROM s0
), s2 AS (
  SELECT *, [3, 1, 2][(rn - 1) % 3 + 1] AS weight FROM s1
), s3 AS (
  SELECT *, (CAST(1.5 AS DOUBLE) * CAST(sum(source_size) OVER () AS DOUBLE) - CAST(2.0 AS DOUBLE) * CAST(coalesce(sum(source_size) OVER (ORDER BY source_size::DOUBLE / weight::DOUBLE, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
    / CAST(sum(weight) OVER (ORDER BY source_size::DOUBLE / weight::DOUBLE, rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level FROM s2
), s4 AS (
  SELECT *, least(2.0::DOUBLE * source_size::DOUBLE, (max(level) OVER ()) * weight::DOUBLE) AS target FROM s3
), s5 AS (
  SELECT *, CAST(floor(sum(target) OVER () / 16 + 0.5) AS BIGINT) AS seats FROM s4
), q AS (
  SELECT rn, target / (2 * k - 1) AS quotient, k FROM s5, unnest(generate_series(1, CAST(ceil(target / 16) AS BIGINT) + 2)) AS t(k) WHERE target > 0
), won AS (
  SELECT rn, row_number() OVER (ORDER BY quotient DESC, rn, k) AS place FROM q
), s AS (
  SELECT s5.*, CAST(ceil(n_docs / 1000) AS BIGINT) AS n_shards, (SELECT count(*) FROM won WHERE won.rn = s5.rn AND place <= s5.seats) AS source_quota FROM s5
), d AS (
  SELECT docs.doc_id, docs.size, s.rn, s.source_size, s.target, ('0x' || substr(md5('mix:s:' || coalesce(CAST(docs.doc_id AS VARCHAR), '')), 1, 8))::BIGINT % s.n_shards AS shard,
    ('0x' || substr(md5('mix:o:' || coalesce(CAST(docs.doc_id AS VARCHAR), '')), 1, 8))::BIGINT AS h
  FROM docs JOIN s ON docs.source IS NOT DISTINCT FROM s.source
), h0 AS (
  SELECT d.rn, d.shard, CAST(sum(d.size) AS BIGINT) AS shard_size, any_value(s.source_quota) AS source_quota FROM d JOIN s ON d.rn = s.rn GROUP BY d.rn, d.shard
), hq AS (
  SELECT rn, shard, source_quota, row_number() OVER (PARTITION BY rn ORDER BY shard_size::DOUBLE / (2 * k - 1) DESC, shard, k) AS place
  FROM h0, unnest(generate_series(1, CAST(ceil(shard_size / 8) AS BIGINT) + 4)) AS t(k) WHERE shard_size > 0
), hw AS (
  SELECT rn, shard, count(*) AS quota FROM hq WHERE place <= source_quota GROUP BY rn, shard
), h1 AS (
  SELECT h0.rn, h0.shard, CAST(ceil(shard_size / 16) AS BIGINT) AS blocks, coalesce(hw.quota, 0) AS quota FROM h0 LEFT JOIN hw ON h0.rn = hw.rn AND h0.shard = hw.shard WHERE shard_size > 0
), h AS (
  SELECT rn, shard, blocks, least(quota, 2 * blocks) % blocks AS run_len, least(quota, 2 * blocks) // blocks AS passes,
    ('0x' || substr(md5('mix:r:' || CAST(rn AS VARCHAR) || ':' || CAST(shard AS VARCHAR)), 1, 8))::BIGINT % blocks AS run_from FROM h1
), p AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY rn, shard ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start FROM d
)
SELECT p.doc_id, p.size, p.source_size, p.target, CAST(coalesce(passes * size
    + greatest(0, least(start + size, least((run_from + run_len) * 16, blocks * 16)) - greatest(start, run_from * 16))
    + greatest(0, least(start + size, (run_from + run_len - blocks) * 16) - greatest(start, 0)), 0) AS BIGINT) AS taken
FROM p LEFT JOIN h ON p.rn = h.rn AND p.shard = h.shard
"""
