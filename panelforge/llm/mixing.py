"""Mixing sources to target weights: hash-random keys, distributed prefix sums, exact budget cuts.

Each document gets a uniform 60-bit key from its id. Within a source, documents are ordered by key in
equal ranges of the key space, so a hot source spreads over as many sorted ranges as any other; prefix
sums are a window inside a range plus the total of the ranges before it. The document on which a
source's budget ends contributes exactly the words that are still missing.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from panelforge.llm.common import free_name, scratch_table

WORD = r"[^\x20\x09-\x0D]+"
KEY_BITS = 60


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_key(doc_id: Column, seed: str) -> Column:
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share_percent: int = 150,
                   max_repeats: int = 2) -> DataFrame:
    """Targets per source from ``source, source_size`` (one row each): water-filling by weight.

    Sources by code point, null last, take the weights in turn. A source stops at ``max_repeats`` times
    its size and the rest is shared by weight among the others: sorted by size over weight, those that
    stop are a prefix, found with running sums. All arithmetic up to the last division is in integers.
    """
    everything = W.partitionBy(F.lit(1))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    ranked = (sizes.withColumn("w", F.element_at(F.array(*[F.lit(w) for w in weights]), turn.cast("int"))
                               .cast("long"))
              .withColumn("ratio", F.col("source_size").cast("double") / F.col("w")))
    fill = everything.orderBy("ratio", F.col("source").asc_nulls_last())
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    onward = fill.rowsBetween(0, W.unboundedFollowing)
    scaled = (ranked.withColumn("left100", F.lit(share_percent) * F.sum("source_size").over(everything)
                                - 100 * max_repeats * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
              .withColumn("w_left", F.sum("w").over(onward))
              .withColumn("stops", 100 * max_repeats * F.col("source_size") * F.col("w_left")
                          <= F.col("w") * F.col("left100")))
    # the level is set by the first source that does not stop
    level = scaled.withColumns({
        "left100": F.first(F.when(~F.col("stops"), F.col("left100")), True).over(
            fill.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)),
        "w_left": F.first(F.when(~F.col("stops"), F.col("w_left")), True).over(
            fill.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))})
    target = F.when(F.col("stops"), (max_repeats * F.col("source_size")).cast("double")).otherwise(
        (F.col("w") * F.col("left100")).cast("double") / (100 * F.col("w_left")).cast("double"))
    return level.select("source", "source_size", "w", target.alias("target"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share_percent: int = 150,
                max_repeats: int = 2, seed: str = "mix", range_bits: int = 12, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, size, source_size, target, taken, source, epochs, extra`` per row of ``docs``.

    ``taken`` = ``epochs`` * size + ``extra``: whole passes over the source plus the words of a last,
    partial pass (0, the size, or in between for the one document where the budget ends).

    Null or empty texts have size 0 and take 0; null sources form one source, last in order; null ids
    share one key; rows with equal id, source and size are interchangeable. Sources without words have
    target 0. An empty table gives an empty result. Other columns are not read.
    """
    base = scratch_table(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"), hash_key(F.col(id_col), seed).alias("key")),
        "mix").withColumn("part", F.shiftright("key", KEY_BITS - range_bits))
    parts = base.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    sizes = parts.groupBy("source").agg(F.sum("part_size").alias("source_size"))
    targets = source_targets(sizes, weights, share_percent, max_repeats)
    ahead = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (parts.withColumn("offset", F.coalesce(F.sum("part_size").over(ahead), F.lit(0)))
               .withColumnsRenamed({"source": "o_source", "part": "o_part"}))
    targets = targets.withColumnRenamed("source", "t_source")
    # one small table of ranges with their source's budget, then one join on the range
    ranges = (offsets.join(targets, F.col("o_source").eqNullSafe(F.col("t_source")))
              .withColumn("budget", F.floor(F.col("target") + 0.5).cast("long"))
              .select("o_source", "o_part", "offset", "source_size", "target", "budget"))
    inside = (W.partitionBy("source", "part").orderBy("key", F.col("doc_id").asc_nulls_last(), "size")
              .rowsBetween(W.unboundedPreceding, -1))
    rows = base.withColumn("seen", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = rows.join(ranges, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("part") == F.col("o_part")))
    passes = F.when(F.col("source_size") > 0,
                    F.expr("budget div greatest(source_size, 1)")).otherwise(F.lit(0)).cast("long")
    return (joined.withColumn("epochs", passes)
            .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
            .withColumn("extra", F.greatest(F.lit(0), F.least(
                F.col("size"), F.col("rest") - F.col("offset") - F.col("seen"))).cast("long"))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("epochs") * F.col("size") + F.col("extra")).alias("taken"), "source", "epochs", "extra"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    count_col: str = "n_chars", **options) -> DataFrame:
    """The mix as documents with the columns of ``docs``: each taken pass of a document is a row.

    A partial pass holds the document's first ``extra`` words with their spacing and its own
    ``count_col``. Documents of which the mix takes nothing are absent. Rows that agree in id, source
    and number of words are ranked and take one plan each, so the mix has the words of its budget.
    """
    size, words, rank, nth = (free_name(docs, n) for n in ("size", "words", "rank", "nth"))
    m_id, m_source, m_size, m_epochs, m_extra = (free_name(docs, n) for n in ("m_id", "m_source", "m_size", "m_epochs", "m_extra"))
    plan = (mix_sources(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
            .select(F.col("doc_id").alias(m_id), F.col("source").alias(m_source), F.col("size").alias(m_size),
                    F.col("epochs").alias(m_epochs), F.col("extra").alias(m_extra)))
    keys = [m_id, m_source, m_size]
    sized = docs.withColumn(size, word_count(F.col(text_col)))
    same = (F.col(id_col).eqNullSafe(F.col(m_id)) & F.col(source_col).eqNullSafe(F.col(m_source)) & (F.col(size) == F.col(m_size)))
    if plan.groupBy(*keys).count().filter("count > 1").limit(1).count():
        # of equal rows the first ranks take the larger passes
        plan = plan.withColumn(nth, F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(m_extra))))
        sized = sized.withColumn(rank, F.row_number().over(W.partitionBy(id_col, source_col, size).orderBy(text_col)))
        same = same & (F.col(rank) == F.col(nth))
    rows = sized.join(plan.filter((F.col(m_epochs) > 0) | (F.col(m_extra) > 0)), same)
    epochs, extra, taken = F.col(m_epochs), F.col(m_extra), F.col(words)
    whole = F.when(extra == F.col(m_size), epochs + 1).otherwise(epochs)
    part = (extra > 0) & (extra < F.col(m_size))
    copies = F.concat(F.when(whole > 0, F.array_repeat(F.lit(-1).cast("long"), whole.cast("int"))).otherwise(
        F.array().cast("array<long>")), F.when(part, F.array(extra)).otherwise(F.array().cast("array<long>")))
    rows = rows.withColumn(words, F.explode(copies))
    cut = F.regexp_extract(F.col(text_col), r"^[\x20\x09-\x0D]*", 0)
    pieces = F.slice(F.regexp_extract_all(F.col(text_col), F.lit(rf"(?:{WORD})[\x20\x09-\x0D]*"), F.lit(0)),
                     F.lit(1), F.greatest(taken, F.lit(0)).cast("int"))
    text = F.when(taken >= 0, F.concat(cut, F.array_join(pieces, ""))).otherwise(F.col(text_col))
    out = rows.withColumn(text_col, text)
    if count_col in docs.columns:
        out = out.withColumn(count_col, F.when(taken >= 0, F.length(text_col).cast("long"))
                             .otherwise(F.col(count_col)).cast(docs.schema[count_col].dataType))
    return out.select(*[out[c] for c in docs.columns])
