"""Benchmark decontamination with SimHash of item-sized windows, in DataFrame functions only.

Words are runs of letters and digits, lower-cased (all ASCII characters that are neither separate words); shingles are
five consecutive words. For an item of n words:

1. *Placement.* Of two multisets of w and m shingles with similarity t, t (w + m) / (1 + t) shingles are shared. So an item-sized
   window can match only if so many of its places hold shingles of the item, in whatever order. Places of documents
   whose shingle occurs in an item come from an equi-join on shingle hashes; a sliding count over the sorted places of a
   (document, item) pair gives all windows that hold enough. Of these it suffices to look at windows that begin at a
   shared place, or at the end of the text (moving a window off an unshared first place loses nothing), and among
   neighbours of those not at ones whose last place is unshared (moving back onto the shared place before loses nothing).
2. *Fingerprints.* Each such window gets a SimHash: a bit is set where more than half of the shingle hashes have it. So
   do the items.
3. *Multi-index.* The 64 bits are cut into ``radius + 1`` blocks. Two fingerprints within ``radius`` bits agree in at
   least one block, so an equi-join on (item, block, value) guarantees all windows within the radius of an item they were
   placed by; no other window can be similar to it. The distance is then computed. Where the window or the item
   repeats a shingle, the two are a pair at any distance.
4. *Verification.* The similarity of the shingle multisets, as strings: sum of the smaller counts over sum of the
   larger ones, at least ``threshold``.

The default radius of 20 bits holds practically all pairs of similarity 0.8 without repeated shingles (their distance
is about 10 bits, standard deviation 3; measured recall in the README). The item side is as large as the benchmark; Spark broadcasts it where its stored size is below
the broadcast threshold and shuffles otherwise. A common shingle is skew on the document side only.

Defined results: items and documents of fewer than five words never match; null texts count as empty; repeated rows
give their matches once; a null doc_id is kept as null; an empty table on either side gives no matches; a document
shorter than an item is compared as a whole; of windows of equal similarity the nearest fingerprint counts, then the first
start among those looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm._common import ABSENT_ID, public_id, stored

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 20
# Fixed value: all ASCII characters but letters and digits separate words.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def shingle_hashes(words: Column) -> Column:
    """The hash of the shingle at each place (none if there are fewer words than a shingle has)."""
    hashed = F.transform(words, lambda w, i: F.xxhash64(w, *(F.get(words, i + j) for j in range(1, SHINGLE))))
    return F.slice(hashed, F.lit(1), F.greatest(F.lit(0), F.size(words) - (SHINGLE - 1)))


def simhash(hashes: Column) -> Column:
    """A bit is set where more than half of the hashes have it."""
    def with_bit(acc, bit):
        votes = F.size(F.filter(hashes, lambda h: F.getbit(h, bit) == 1))
        return acc.bitwiseOR(F.when(2 * votes > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("long"), bit))
                             .otherwise(F.lit(0).cast("long")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), with_bit)


def repeats(hashes: Column) -> Column:
    """Does a shingle occur more than once?"""
    return F.size(F.array_distinct(hashes)) < F.size(hashes)


def blocks(fp: Column, radius: int) -> Column:
    """(block, value) of ``radius + 1`` blocks that together hold all 64 bits."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    return F.array(*(F.struct(F.lit(i).alias("block"),
                              F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long")).alias("value"))
                     for i, (a, b) in enumerate(zip(edges, edges[1:]))))


def shingles(words: Column) -> Column:
    """The shingles at each place, as strings."""
    joined = F.transform(words, lambda w, i: F.concat_ws(" ", F.slice(words, i + 1, SHINGLE)))
    return F.slice(joined, F.lit(1), F.greatest(F.lit(0), F.size(words) - (SHINGLE - 1)))


def weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of the smaller counts over the sum of the larger counts of two arrays' elements."""
    def count(xs, x):
        return F.size(F.filter(xs, lambda y: y == x))

    shared = F.array_intersect(a, b)  # only these can count, and once each unless an array repeats them
    counted = F.aggregate(shared, F.lit(0), lambda n, x: n + F.least(count(a, x), count(b, x)))
    both = F.when(repeats(a) & repeats(b), counted).otherwise(F.size(shared))
    return both / (F.size(a) + F.size(b) - both)


def needed(m: Column, places: Column, threshold: float) -> Column:
    """How many shared places a window needs: the shingles that two multisets of this similarity share."""
    share = F.lit(threshold / (1.0 + threshold))
    return F.greatest(F.lit(1), F.ceil(share * (F.least(m, places) + m) - 1e-6)).cast("int")


def window_starts(shared: Column, m: Column, places: Column, need: Column) -> Column:
    """The starts of the windows of ``m`` places to look at, from the sorted shared places of a document of ``places``."""
    last = F.greatest(F.lit(0), places - m)

    def worth(s: Column, i: Column) -> Column:
        enough = F.coalesce(F.get(shared, i + need - 1) <= s + m - 1, F.lit(False))
        after_shared = F.coalesce(F.get(shared, i - 1) == s - 1, F.lit(False))
        ends_shared = F.array_contains(F.slice(shared, i + 1, m), s + m - 1)
        return (s < last) & enough & (~after_shared | ends_shared)

    at_end = F.when(F.coalesce(F.get(shared, F.size(shared) - need) >= last, F.lit(False)), F.array(last)).otherwise(
        F.array().cast("array<int>"))
    return F.concat(F.filter(shared, worth), at_end)


def find_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS,
               id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
               item_text: str = "text") -> DataFrame:
    """(``id_col``, text_hash, ``item_id``, start, distance, similarity): the best window of each document and item
    whose similarity reaches the threshold."""
    if not 0 <= radius < 64:
        raise ValueError("the radius must leave at least one bit to each block")
    item = items.select(F.col(item_id).cast("long").alias("item"), words_of(F.col(item_text)).alias("item_words")).distinct()
    item = item.where(F.size("item_words") >= SHINGLE).withColumn("hashes", shingle_hashes(F.col("item_words")))
    item = stored(item.withColumn("item_fp", simhash(F.col("hashes"))).withColumn("item_repeats", repeats(F.col("hashes"))),
                  "benchmark-items")
    places = stored(item.select("item", F.size("hashes").alias("m"), F.posexplode("hashes").alias("q", "h")), "benchmark-shingles")

    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(ABSENT_ID)).alias("id"), F.col(text_col).alias("text"))
    base = base.withColumn("th", F.xxhash64("text"))
    hashed = base.select("id", "th", words_of(F.col("text")).alias("words")).where(F.size("words") >= SHINGLE)
    hits = (hashed.select("id", "th", (F.size("words") - (SHINGLE - 1)).alias("places"), F.posexplode(shingle_hashes(F.col("words"))).alias("p", "h"))
            .join(places, "h"))
    placed = hits.groupBy("id", "th", "item", "m", "places").agg(F.sort_array(F.collect_set("p")).alias("shared"))
    placed = placed.withColumn("need", needed(F.col("m"), F.col("places"), threshold)).where(F.size("shared") >= F.col("need"))
    placed = stored(placed.withColumn("start", F.explode(window_starts(F.col("shared"), F.col("m"), F.col("places"), F.col("need"))))
                    .select("id", "th", "item", (F.col("m") + (SHINGLE - 1)).alias("n"), "start"), "benchmark-places")

    # the texts of the few documents placed; a broadcast of their ids where it is small
    aligned = placed.groupBy("id", "th", "n", "start").agg(F.collect_set("item").alias("items"))  # items of one length
    texts = base.join(aligned, ["id", "th"]).dropDuplicates(["id", "th", "n", "start"]).select(
        "id", "th", "items", "n", words_of(F.col("text")).alias("words"), "start")
    windows = texts.select("id", "th", "items", "start", F.expr("slice(words, start + 1, n)").alias("words"))
    windows = windows.withColumn("hashes", shingle_hashes(F.col("words"))).select(
        "id", "th", F.explode("items").alias("item"), "start", "words", simhash(F.col("hashes")).alias("fp"), repeats(F.col("hashes")).alias("repeats"))
    windows = stored(windows, "benchmark-windows")

    keyed = windows.select("id", "th", "start", "words", "fp", "item", F.explode(blocks(F.col("fp"), radius)).alias("key"))
    index = item.select("item", "item_words", "item_fp", F.explode(blocks(F.col("item_fp"), radius)).alias("key"))
    near = keyed.join(index, ["item", "key"]).withColumn("distance", F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))))
    near = near.where(F.col("distance") <= radius).select("id", "th", "start", "words", "fp", "item", "item_words", "distance")
    # where shingles repeat, one difference counts many times in the vote: such pairs are verified at any distance
    direct = windows.join(item, "item").where(F.col("repeats") | F.col("item_repeats")).select(
        "id", "th", "start", "words", "fp", "item", "item_words",
        F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))).alias("distance"))
    near = near.union(direct).dropDuplicates(["id", "th", "start", "item", "item_words"])
    strings = near.withColumns({"a": shingles(F.col("words")), "b": shingles(F.col("item_words"))})
    verified = strings.withColumn("similarity", weighted_similarity(F.col("a"), F.col("b")))
    best = verified.where(F.col("similarity") >= threshold).groupBy("id", "th", "item").agg(
        F.max(F.struct("similarity", -F.col("distance"), -F.col("start"))).alias("b"))
    return best.select(public_id().alias(id_col), F.col("th").alias("text_hash"), F.col("item").alias(item_id),
                       (-F.col("b.col3")).alias("start"), (-F.col("b.col2")).alias("distance"), F.col("b.similarity").alias("similarity"))


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` (columns unchanged) that hold no benchmark item."""
    found = stored(find_items(docs, items, threshold, radius).select(
        F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct(), "contaminated")
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.xxhash64("text") == F.col("gone_hash"))
    return docs.join(found, same, "left_anti")
