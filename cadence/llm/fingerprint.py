"""Document fingerprints: bottom-k sketches of shingle hashes.

A text's sketch is the ascending array of the ``k`` smallest distinct 48-bit
hashes of its word shingles. Sketches of parts merge into the sketch of the
whole; two sketches estimate resemblance, containment and numbers of distinct
shingles. Only DataFrame functions are used.

Words are maximal runs other than ASCII white space, as written; a text with
fewer words than a shingle has its word sequence as the one shingle; one
without words has an empty sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD_PATTERN, col, fresh, written

BITS = 48
SPACE = float(1 << BITS)


def add_sketch(df: DataFrame, text: str, out: str, k: int, width: int = 5) -> DataFrame:
    """Add the sketch of column ``text`` (null: as empty) as ``out``."""
    (words,) = fresh(df, "words_")
    split = F.regexp_extract_all(F.coalesce(col(text), F.lit("")), F.lit(f"({WORD_PATTERN})"), 1)
    w, n = col(words), F.size(col(words))
    hashes = F.transform(
        F.sequence(F.lit(0), n - width),
        lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(w, i + F.lit(j)) for j in range(width)]), 64 - BITS),
    )
    one = F.array(F.shiftrightunsigned(F.xxhash64(w), 64 - BITS))
    found = (
        F.when(n >= width, F.slice(F.sort_array(F.array_distinct(hashes)), 1, k))
        .when(n > 0, one)
        .otherwise(F.array().cast("array<bigint>"))
    )
    # Two steps: the words are computed once, not for every shingle.
    return df.withColumn(words, split).select(*[col(c) for c in df.columns], found.alias(out))


def merged(a: Column, b: Column, k: int) -> Column:
    """Sketch of the union of the texts of two sketches."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int) -> Column:
    """Estimated Jaccard index: the share of the union's sketch that both
    have; 1 for two empty sketches."""
    union = merged(a, b, k)
    shared = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(shared / F.size(union))


def distinct(a: Column, k: int) -> Column:
    """Estimated number of distinct shingles, exact below ``k``."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * SPACE / (F.element_at(a, k) + 1))


def containment(a: Column, b: Column, k: int) -> Column:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    both = resemblance(a, b, k) * distinct(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct(a, k)))


def as_text(a: Column) -> Column:
    """Fingerprint string: the hashes as hexadecimal digits, 12 each."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), BITS // 4, "0")), "")


def merge_sketches(parts: DataFrame, by: list[str], sketch_column: str, k: int, salts: int = 64) -> DataFrame:
    """One sketch per group of ``by`` from sketches of its parts. A group's
    hashes are first cut to the ``k`` smallest per salt, so a hot group
    reaches its last task as ``salts`` * ``k`` hashes at most."""
    salt, h = fresh(parts, "salt_", "hash_")
    keys = [col(c) for c in by]
    some = (
        parts.withColumn(h, F.explode(col(sketch_column)))
        .select(*keys, h)
        .distinct()
        .withColumn(salt, F.pmod(F.col(h), F.lit(salts)))
    )
    first = Window.partitionBy(*keys, salt).orderBy(h)
    cut = some.withColumn("rank_", F.row_number().over(first)).where(F.col("rank_") <= k)
    return cut.groupBy(*keys).agg(F.slice(F.sort_array(F.collect_list(h)), 1, k).alias(sketch_column))


def with_next(docs: DataFrame, doc_id: str, carried: list[str], rows_per_range: int = 2_000) -> DataFrame:
    """Add ``next_<c>`` for each ``carried`` column: that of the next row by
    the numeric ``doc_id`` (null ids last, equal ids by the carried columns);
    the last row gets the first one's, so a single row is its own next.

    Ids are cut into ranges at approximate quantiles. Each range is one window
    partition; its last row takes the first row of the next range."""
    bucket, last, of, first = fresh(docs, "bucket_", "last_", "of_", "first_")
    leads = fresh(docs, *[f"lead_{c}" for c in carried])
    place = col(doc_id).cast("double")
    many = max(1, -(-docs.count() // rows_per_range))
    cuts: list[float] = []
    if many > 1:
        shares = [i / many for i in range(1, many)]
        cuts = sorted(set(docs.agg(F.percentile_approx(place, shares, 10 * many).alias("q")).first()["q"] or []))
    placed = docs.withColumn(bucket, range_number(place, cuts))
    row = F.struct(col(doc_id).isNull().alias("n"), col(doc_id).alias("i"), *[col(c) for c in carried])
    firsts = written(placed.groupBy(bucket).agg(F.min(row).alias(first)), "firsts")
    turn = Window.orderBy(bucket)  # one row per range
    following = firsts.select(
        F.col(bucket).alias(of), F.coalesce(F.lead(first).over(turn), F.first(first).over(turn)).alias(first)
    )
    within = Window.partitionBy(bucket).orderBy(col(doc_id).asc_nulls_last(), *[col(c) for c in carried])
    led = placed.select(
        "*",
        F.lead(F.lit(True)).over(within).isNull().alias(last),
        *[F.lead(col(c)).over(within).alias(name) for c, name in zip(carried, leads)],
    )
    joined = led.join(following, F.col(last) & (F.col(bucket) == F.col(of)), "left")
    return joined.select(
        *[col(c) for c in docs.columns],
        *[
            F.when(F.col(last), F.col(first)[c]).otherwise(F.col(name)).alias(f"next_{c}")
            for c, name in zip(carried, leads)
        ],
    )


def range_number(value: Column, cuts: list[float]) -> Column:
    """Number of ``cuts`` (ascending) up to ``value``, all for null: looked up
    first among every s-th cut, then among the s cuts from there."""
    if not cuts:
        return F.lit(0).cast("long")
    step = max(1, int(len(cuts) ** 0.5))
    coarse = F.array(*[F.lit(c) for c in cuts[::step]])
    fine = F.array(*[F.lit(c) for c in cuts])
    upto = lambda cuts: F.size(F.filter(cuts, lambda c: c <= value))
    start = F.greatest(upto(coarse) - 1, F.lit(0)) * step
    return F.when(value.isNull(), F.lit(len(cuts))).otherwise(start + upto(F.slice(fine, start + 1, step))).cast("long")


def fingerprints(docs: DataFrame, k: int = 128, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Sketch of every row's text: ``doc_id``, ``n_chars`` (code points),
    ``sketch``, ``fingerprint``, ``n_shingles`` (estimate). Null texts count
    as empty; equal texts have equal fingerprints; repeated rows give repeated
    results, an empty table an empty one; other columns are ignored."""
    rows = docs.select(col(doc_id).alias("doc_id"), F.coalesce(col(text), F.lit("")).alias("text"))
    return add_sketch(rows, "text", "sketch", k).select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        "sketch",
        as_text(F.col("sketch")).alias("fingerprint"),
        distinct(F.col("sketch"), k).alias("n_shingles"),
    )


def edit_check(docs: DataFrame, k: int = 128, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every row's text and of its edited text, whose last
    quarter (rounded down, in code points) is replaced by as many code points
    (or all) of the beginning of the next row's text by ``doc_id``; and the
    resemblance of the text's fingerprint to both the edited text's and the
    next text's. Nulls, ties, repeats as in ``fingerprints`` and
    ``with_next``."""
    rows = docs.select(col(doc_id).alias("doc_id"), F.coalesce(col(text), F.lit("")).alias("text"))
    own = with_next(add_sketch(rows, "text", "sketch", k), "doc_id", ["text", "sketch"])
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - cut), F.substr("next_text", F.lit(1), cut))
    both = add_sketch(
        own.select("doc_id", n.cast("long").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited")),
        "edited",
        "edited_sketch",
        k,
    )
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
    )
