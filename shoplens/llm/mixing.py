"""Mixing sources to target weights by weighted fair queueing.

Every source's documents stand in a shuffled queue, which is gone through up to
``rounds`` times. A document's virtual time, in each round, is the source's words
up to its middle, divided by the source's weight; its finish time is the same up
to its end. All turns of all documents are range-sorted by that time over the
cluster, and the order is cut once, for all sources, at the virtual time at which
the words due reach the total budget. A queue that has ended is due no more
words, so the others' share of the budget grows by weight; a source's target is
what it is due at the cut, and it misses that by half a document at most.

The budget is counted in words due, not in words of whole documents taken:
otherwise a huge document that is left out would hand its words to the other
sources, and push those over their targets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import WORD, free_names, number_rows, save

WEIGHTS, SHARE, ROUNDS = (3, 1, 2), 1.5, 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: str, out: str, name: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` up to each row, within ``keys``, in ``order``.

    Rows are range-partitioned and stored; sums run within a partition and are
    shifted by the totals of earlier partitions, so no key meets in one task.
    ``order`` must be total (ties would be summed in any order).
    """
    part = f"__{out}_part"
    ranged = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    stored = save(ranged.withColumn(part, F.spark_partition_id()), name)
    within = Window.partitionBy(part, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = stored.withColumn(out, F.sum(value).over(within))
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = (stored.groupBy(part, *keys).agg(F.sum(value).alias("__total"))
              .select(F.col(part).alias("__part"), *[F.col(k).alias(f"__{k}") for k in keys],
                      F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__before")))
    same = local[part] == totals["__part"]
    for k in keys:
        same = same & local[k].eqNullSafe(totals[f"__{k}"])
    return (local.join(totals, same).withColumn(out, F.col(out) + F.col("__before"))
            .drop(part, "__part", "__before", *[f"__{k}" for k in keys]))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, rounds: int = ROUNDS) -> DataFrame:
    """(source, rank, weight, source_size, target, cut) from (source, source_size).

    Sources in code point order, null last, take the weights in turn; the
    budget is ``share`` of all sizes. ``cut`` is the virtual time (words by
    weight) at which the words due reach the budget, null if there are none; a
    source is due its weight times that, but no more than ``rounds`` times its
    size, its target. The loop only collects one row of sums per turn; each
    turn ends a queue. Sources are numbered over all partitions, as there may
    be as many as there are hosts.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    named = sizes.select("source", "source_size", F.lit(0).alias("all"), F.col("source").isNull().alias("last"), F.col("source").cast("binary").alias("code"))
    ranked = save(number_rows(named, "all", ["last", "code"], "rank", "mix-ranks").drop("all", "last", "code")
                  .withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int"))), "mix-sources")
    most = F.col("source_size") * float(rounds)
    budget = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, held = 0.0, -1
    while True:
        full = F.lit(False) if held < 0 else F.col("weight") * level >= most
        r = ranked.agg(F.count_if(full).alias("n"), F.sum(F.when(full, most).otherwise(0.0)).alias("fixed"),
                       F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weight")).first()
        if r["n"] == held or not r["weight"]:
            break
        held, level = r["n"], (budget - r["fixed"]) / r["weight"]
    return ranked.withColumn("target", F.least(most, F.col("weight") * level)).withColumn("cut", F.lit(level if level > 0 else None).cast("double"))


def schedule(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, rounds: int = ROUNDS, seed: int = 8) -> tuple[DataFrame, DataFrame]:
    """(queue, taken): all rows of ``docs`` in their queues, and the turns before the cut in order of virtual time.

    ``taken`` has ``row`` of the queue, ``turn`` (from 0) and ``at``, the virtual
    time of the document's middle in that turn over the time of the cut: all
    turns of all sources are sorted by it and cut at 1. See ``mix`` for nulls, ties and empty tables.
    """
    rows = save(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                            F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("draw"))
                .withColumn("row", F.monotonically_increasing_id()), "mix-rows")
    sources = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, rounds)
    joined = (rows.join(sources.withColumnRenamed("source", "__source"), rows.source.eqNullSafe(F.col("__source")))
              .select("doc_id", "source", "row", "draw", "rank", "size", "source_size", "weight", "target", "cut"))
    queue = save(running_sum(joined, ["rank"], ["draw", "doc_id", "row"], "size", "served", "mix-queue"), "mix-served")
    turns = queue.where("size > 0").withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    middle = F.col("served") + F.col("turn") * F.col("source_size") - F.col("size") / 2
    order = turns.select("row", "doc_id", "source", "draw", "turn", (middle / (F.col("weight") * F.col("cut"))).alias("at"))
    ranged = order.repartitionByRange("at", "draw", "row").sortWithinPartitions("at", "draw", "row")
    return queue, ranged.where("at <= 1")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, rounds: int = ROUNDS, seed: int = 8) -> DataFrame:
    """``times`` each row of ``docs`` is taken (0 to ``rounds``), in order of its first ``finish`` time.

    Needs doc_id, text, source; other columns are ignored. A null text has size
    0 and is never taken; a null source is a source of its own. Rows that are
    alike in doc_id and text are told apart by their position and queue one
    after the other. The order is a hash of seed, doc_id and text, so reruns
    agree. ``finish`` is in units of the cut's time (null if nothing is due).
    An empty table gives no rows.
    """
    queue, taken = schedule(docs, weights, share, rounds, seed)
    times = taken.groupBy(F.col("row").alias("__row")).agg(F.count("*").alias("times"))
    finish = F.col("served") / (F.col("weight") * F.col("cut"))
    return (queue.join(times, F.col("row") == F.col("__row"), "left")
            .select("row", "doc_id", "source", "size", "source_size", "target", finish.alias("finish"), F.coalesce("times", F.lit(0)).cast("int").alias("times"), "draw")
            .repartitionByRange("finish", "draw", "row").sortWithinPartitions("finish", "draw", "row"))


def draw_mix(docs: DataFrame, seed: int = 8, **settings) -> DataFrame:
    """The mixed rows of ``docs``, with all their columns, in order of virtual time.

    A document taken twice comes twice, at its two places. Rows alike in
    doc_id, text and source are one row, taken as often as all of them, at
    their places. A null text is never taken, a null source is a source of its
    own, all other columns stay, whatever their names. An empty table gives no rows.
    """
    doc, source, draw, at, key = free_names(docs, "doc", "source", "draw", "at", "key")
    queue, order = schedule(docs, seed=seed, **settings)
    same = ["doc_id", "source", "draw"]
    order = save(order, "mix-taken")
    repeated = save(queue.groupBy(*same).agg(F.count("*").alias("n")).where("n > 1"), "mix-repeated")
    rows = docs.withColumn(key, F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")))
    if not repeated.isEmpty():
        rows = rows.dropDuplicates(["doc_id", "source", key])
    taken = order.select(F.col("doc_id").alias(doc), F.col("source").alias(source), F.col("draw").alias(draw), F.col("at").alias(at))
    joined = rows.join(taken, rows["doc_id"].eqNullSafe(taken[doc]) & rows["source"].eqNullSafe(taken[source]) & (rows[key] == taken[draw]))
    return joined.repartitionByRange(at, key).sortWithinPartitions(at, key).select(*docs.columns)
