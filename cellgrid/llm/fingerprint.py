"""Document fingerprints: bottom-k sketches of word shingles, in DataFrame functions alone.

A sketch is the sorted array of the k smallest 63-bit hashes of a text's distinct shingles. Sketches of parts merge into
the sketch of the whole, and two sketches estimate resemblance, containment and the number of distinct shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellgrid.llm._shared import LONG_MIN, Ranges, bigints, words

K = 128
WIDTH = 5


def with_sketch(df: DataFrame, text: str, out: str, k: int = K, width: int = WIDTH) -> DataFrame:
    """``df`` with the sketch of ``text`` in ``out``.

    A text of fewer than ``width`` words is one shingle, one without words has an empty sketch; null counts as empty.
    """
    w, h, s, low = (f"__{x}_{out}" for x in "whsl")
    df = df.withColumn(w, words(F.coalesce(F.col(text), F.lit(""))))
    df = df.withColumn(h, F.transform(w, lambda x: F.xxhash64(x)))
    n, rolled = F.size(h), F.col(h)
    for j in range(1, width):
        count = F.greatest(n - j, F.lit(0))
        rolled = F.zip_with(F.slice(rolled, 1, count), F.slice(F.col(h), j + 1, count), lambda a, b: F.xxhash64(a, b))
    whole = F.when(n > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(F.array().cast("array<bigint>"))
    shingles = F.when(n >= width, rolled).otherwise(whole)
    df = df.withColumn(s, F.transform(shingles, lambda x: F.shiftrightunsigned(x, 1)))
    # of many hashes only the smallest part needs sorting; if too few of them differ, all are sorted
    limit = F.when(F.size(s) > 8 * k, (float(1 << 63) * 4 * k / F.size(s)).cast("bigint")).otherwise(F.lit((1 << 63) - 1))
    df = df.withColumn(low, F.struct(F.array_distinct(F.filter(s, lambda x: x <= limit)).alias("a")))
    some = F.slice(F.sort_array(F.col(low)["a"]), 1, k)
    full = F.slice(F.sort_array(F.array_distinct(s)), 1, k)
    return df.withColumn(out, F.when((F.size(F.col(low)["a"]) >= k) | (F.size(s) <= 8 * k), some).otherwise(full)).drop(w, h, s, low)


def to_hex(sketch: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits for each hash."""
    return F.lower(F.array_join(F.transform(sketch, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of two shingle sets: the share of the union's k smallest hashes that both have."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    both = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, 1.0).otherwise(both / F.size(union)).cast("double")


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) * float(1 << 63) / F.element_at(sketch, -1))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too; 1 for an empty a."""
    j, na, nb = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(na == 0, 1.0).otherwise(F.least(F.lit(1.0), j * (na + nb) / ((1 + j) * na)))


def merge(df: DataFrame, keys: list[str], sketch: str, k: int = K) -> DataFrame:
    """One sketch for each group: that of all its texts together. No group is gathered; each task keeps k hashes."""
    hashes = df.select(*keys, F.explode_outer(sketch).alias("__hash")).distinct()
    ranked = hashes.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("__hash").asc_nulls_last())))
    return ranked.where(F.col("__n") <= k).groupBy(*keys).agg(F.sort_array(F.collect_list("__hash")).alias(sketch))


def with_next(df: DataFrame, order: str, columns: list[str], rows: int = 2000) -> DataFrame:
    """``df`` with ``next_<column>`` of the following row in descending ``order``; the last row is followed by the first.

    The rows are dealt out once, by ranges of ``order``; a copy of the greatest row of each range goes to the range
    above, whose last row it follows. Nulls come last, rows of equal order by their columns.
    """
    at = F.coalesce(F.col(order).cast("bigint"), F.lit(LONG_MIN))
    ranges = Ranges(df.select(at.alias("at")), rows)
    n = len(ranges)
    df = df.withColumn("__at", at).withColumn("__range", ranges.of(F.col("__at")))
    place = lambda r, copy: F.struct(r.alias("range"), F.lit(copy).alias("copy"))
    own = place(F.col("__range"), False)
    highs = bigints(ranges.highs)
    both = F.array(own, place(F.pmod(F.col("__range") + 1, F.lit(n)), True))
    df = df.withColumn("__place", F.explode(F.when(F.col("__at") == F.get(highs, F.col("__range")), both).otherwise(F.array(own))))
    w = Window.partitionBy("__place.range").orderBy(F.when(~F.col("__place.copy"), F.col("__at")).desc_nulls_last(), *columns)
    df = df.withColumns({f"next_{c}": F.lead(c).over(w) for c in columns})
    return df.where(~F.col("__place.copy")).drop("__at", "__range", "__place")


def fingerprint_edits(docs: DataFrame, k: int = K, width: int = WIDTH) -> DataFrame:
    """Each document's sketch beside those of an edited text and of the next document.

    Returns ``doc_id, n_chars, edited_text, sketch, edited_sketch, near_edited, near_next``. The edited text is the
    document with its last third (rounded down) replaced by as many first code points of the next document, in
    descending order of id. A null text counts as empty, equal texts have equal sketches, two texts without words are
    alike (1.0). A single row is followed by itself; an empty table gives no rows.
    """
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    base = with_next(with_sketch(base, "text", "sketch", k, width), "doc_id", ["text", "sketch"])
    base = base.withColumn("n_chars", F.char_length("text")).withColumn("__cut", F.floor(F.col("n_chars") / 3).cast("int"))
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - F.col("__cut")), F.substring("next_text", F.lit(1), F.col("__cut")))
    base = with_sketch(base.withColumn("edited_text", edited), "edited_text", "edited_sketch", k, width)
    return base.select(
        "doc_id", F.col("n_chars").cast("bigint").alias("n_chars"), "edited_text", "sketch", "edited_sketch",
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
    )
