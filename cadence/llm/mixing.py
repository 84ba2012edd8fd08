"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sources take turns in the weights of ``weights`` and share ``share`` times the
corpus's words, none more than ``most`` times its own. The words to take are
divided into equal blocks; sources get blocks by the highest quotients
target / (2 k + 1). A source's documents are dealt over shards of bounded
size by a seeded hash, and its blocks go to its shards the same way, by the
highest quotients of the shards' words. Within a shard documents stand in a
seeded order; whole turns through the shard and then its first blocks are
taken until its quota is met.

Only DataFrame functions are used. No step sees a whole source in one task:
sources and shards are ranked by ``common.with_prefix``, and running sums of
documents stay within a shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import col, compact, fresh, with_prefix, word_count, written


def apportion(parts: DataFrame) -> DataFrame:
    """Seats per part by Sainte-Laguë: rows (``grp``, ``key``, ``weight`` > 0,
    ``seats``, the same number throughout a group) -> (``grp``, ``key``,
    ``quota``), quotas of a group summing to its seats.

    Rounding weight * seats / total gives all seats but a few; the quotients
    near the border (their number is linear in the parts) are ranked and the
    highest taken, ties to the smaller key."""
    groups = parts.groupBy("grp").agg(F.sum("weight").alias("all_"), F.count(F.lit(1)).alias("n_"))
    ideal = (
        parts.join(groups, "grp")
        .withColumn("near_", F.floor(F.col("seats") * F.col("weight") / F.col("all_") + 0.5))
        .withColumn("span_", F.ceil(F.col("weight") / F.col("all_") * (F.col("n_") / 2 + 2)) + 1)
        .select(
            "grp",
            "key",
            "weight",
            "seats",
            F.greatest(F.lit(0).cast("long"), F.col("near_") - F.col("span_")).alias("base"),
            (F.col("near_") + F.col("span_")).alias("top"),
        )
    )
    ideal = written(ideal, "ideal")
    quotients = ideal.select(
        "grp", "key", "weight", F.explode(F.sequence("base", F.col("top") - 1)).alias("k")
    ).select("grp", "key", "k", (F.col("weight") / (2 * F.col("k") + 1)).alias("quotient"))
    ranked = written(
        with_prefix(
            quotients, [F.col("grp"), F.col("quotient").desc(), F.col("key"), F.col("k")], {}, row="rank_"
        ),
        "ranked",
    )
    first = ranked.groupBy("grp").agg(F.min("rank_").alias("first_"))
    rest = ideal.groupBy("grp").agg((F.max("seats") - F.sum("base")).alias("rest_"))
    won = (
        ranked.join(first, "grp")
        .join(rest, "grp")
        .where(F.col("rank_") - F.col("first_") < F.col("rest_"))
        .groupBy("grp", "key")
        .agg(F.count(F.lit(1)).alias("won_"))
    )
    return ideal.join(won, ["grp", "key"], "left").select(
        "grp", "key", (F.col("base") + F.coalesce("won_", F.lit(0))).alias("quota")
    )


def source_targets(sized: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Per source of ``sized`` (``source``, ``size``): ``source_size``, ``n_docs``,
    ``source_no`` (rank by code point from 0, null last), ``target``.

    Targets are min(most * size, weight * level); the one level at which they
    sum to the whole is the largest of the levels that remain after capping
    sources in the order of size / weight, so prefix sums find it without
    a search."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    numbered = with_prefix(sources, [F.col("source").asc_nulls_last()], {}, row="source_no")
    turns = F.array(*[F.lit(float(w)) for w in weights])
    weighted = numbered.withColumn(
        "weight", F.element_at(turns, (F.col("source_no") % len(weights) + 1).cast("int"))
    ).withColumn("cap", F.col("source_size") * float(most))
    weighted = written(weighted, "sources")
    full = weighted.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight_")).select(
        (F.col("words") * float(share)).alias("whole"), "weight_"
    )
    filling = with_prefix(
        weighted.select("source_no", "cap", "weight"),
        [F.col("cap") / F.col("weight"), F.col("source_no")],
        {"caps": "cap", "gone": "weight"},
    )
    # Joined by a constant: `full` is one row.
    level = (
        filling.withColumn("one", F.lit(1))
        .join(full.withColumn("one", F.lit(1)), "one")
        .agg(F.max((F.col("whole") - F.col("caps")) / (F.col("weight_") - F.col("gone"))).alias("level"))
    )
    return written(
        weighted.withColumn("one", F.lit(1))
        .join(level.withColumn("one", F.lit(1)), "one")
        .select(
            "source",
            "source_no",
            "source_size",
            "n_docs",
            F.least("cap", F.col("weight") * F.greatest("level", F.lit(0.0))).alias("target"),
        ),
        "targets",
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    block: int = 8,
    shard_words: int = 1 << 15,
    seed: int = 42,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Every row of ``docs`` with ``size`` (words; null text: 0),
    ``source_size``, ``target`` (its source's words to take), ``taken`` (words
    of it taken, repeats counted), ``copies`` (how often it is taken whole)
    and ``extra`` (words of its beginning taken once more).

    Rows with a null source form a source of their own, last. Rows without
    words are never taken. Repeated rows are documents of their own. A corpus
    without words has targets 0; an empty table gives an empty result.
    Columns of ``docs`` named like a new one are replaced. ``block`` is the
    block's words, ``shard_words`` a shard's words and documents at most,
    about; reruns over the same rows agree."""
    new = ["size", "source_size", "target", "taken", "copies", "extra"]
    keep = [c for c in docs.columns if c.lower() not in new]
    base = docs.select(*[col(c) for c in keep])
    src, no, shard, turn, start, n_shards, words, quota, s_no, s_shard = fresh(
        base.select("*", *[F.lit(0).alias(c) for c in new]),
        "src_", "source_no", "shard_", "turn_", "start_", "shards_", "words_", "quota_", "of_", "at_",
    )
    sized = base.select("*", word_count(col(text)).alias("size"))
    targets = source_targets(
        sized.select(col(source).alias("source"), "size"), weights, share, most
    ).withColumn(
        n_shards,
        F.greatest(F.lit(1), F.ceil((F.col("source_size") + F.col("n_docs")) / F.lit(shard_words))).cast("long"),
    )
    mine = targets.select(
        F.col("source").alias(src), F.col("source_no").alias(no), "source_size", "target", n_shards
    )
    dealt = (
        sized.join(mine, sized[source].eqNullSafe(mine[src]))
        .drop(src)
        .withColumn(turn, F.xxhash64(F.lit(seed), col(doc_id), col(source)))
        .withColumn(shard, F.pmod(F.xxhash64(F.lit(seed + 1), F.col(turn)), F.col(n_shards)))
    )
    shards = compact(
        dealt.groupBy(no, shard).agg(F.sum("size").alias("weight")).where("weight > 0"), "shards"
    ).select(F.col(no).alias("grp"), F.col(shard).alias("key"), "weight")
    all_words = targets.agg(F.sum("target").alias("t")).first()["t"] or 0.0
    per_source = apportion(
        targets.where("target > 0").select(
            F.lit(0).alias("grp"),
            F.col("source_no").alias("key"),
            F.col("target").alias("weight"),
            F.lit(int(all_words // block)).alias("seats"),
        )
    ).select(F.col("key").alias("grp"), F.col("quota").alias("seats"))
    quotas = (
        apportion(shards.join(per_source, "grp").select("grp", "key", F.col("weight").cast("double"), "seats"))
        .join(shards, ["grp", "key"])
        .select(
            F.col("grp").alias(s_no),
            F.col("key").alias(s_shard),
            F.col("weight").alias(words),
            F.least(F.col("quota") * block, (F.col("weight") * float(most)).cast("long")).alias(quota),
        )
    )
    quotas = written(quotas, "quotas")
    before = (
        Window.partitionBy(no, shard)
        .orderBy(F.col(turn), col(doc_id), F.col("size"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = dealt.withColumn(start, F.coalesce(F.sum("size").over(before), F.lit(0)))
    counted = placed.join(quotas, (placed[no] == quotas[s_no]) & (placed[shard] == quotas[s_shard]), "left")
    whole = F.when(F.col("size") > 0, F.coalesce(F.expr(f"{quota} div {words}"), F.lit(0))).otherwise(F.lit(0))
    left = F.coalesce(F.col(quota) % F.col(words), F.lit(0))
    extra = F.greatest(F.lit(0).cast("long"), F.least(F.col(start) + F.col("size"), left) - F.col(start))
    return counted.select(
        *[col(c) for c in keep],
        "size",
        "source_size",
        "target",
        (whole * F.col("size") + extra).alias("taken"),
        whole.cast("long").alias("copies"),
        extra.alias("extra"),
    )


def materialize(mixed: DataFrame, columns: Sequence[str], text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """Documents of a mix: each row ``copies`` times, and once more cut after
    ``extra`` words (single spaces between them) unless that is all of it.
    ``n_chars``, where the documents have it, follows the text."""
    copy, piece = fresh(mixed, "copy_", "piece_")
    cut = (F.col("extra") > 0) & (F.col("extra") < F.col("size"))
    times = F.col("copies") + F.when(F.col("extra") > 0, 1).otherwise(0)
    rows = mixed.where(times > 0).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), times)))
    shortened = F.array_join(
        F.slice(F.regexp_extract_all(col(text), F.lit("([^\\x20\\x09-\\x0D]+)"), 1), 1, F.col("extra").cast("int")), " "
    )
    rows = rows.withColumn(piece, F.when(cut & (F.col(copy) > F.col("copies")), shortened).otherwise(col(text)))
    out = []
    for c in columns:
        if c == text:
            out.append(F.col(piece).alias(c))
        elif c == n_chars:
            out.append(
                F.when(F.col(piece).isNull() | (F.col(piece) == col(text)), col(c))
                .otherwise(F.length(F.col(piece)).cast(mixed.schema[c].dataType))
                .alias(c)
            )
        else:
            out.append(col(c).alias(c))
    return rows.select(*out)
