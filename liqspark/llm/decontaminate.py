"""Benchmark decontamination as a prefix-filtered set join.

An item's windows are sets of word shingles with their places. All shingles of
a window have to occur (containment 1), so its prefix is one shingle: the
rarest by its count in the documents. Only documents with that shingle are
candidates; the place of the shingle and the document's length bound where the
window can lie, and the shingles that cover the window verify it word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, stored, text_or_empty

WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # fixed value
WINDOW_WORDS = 10
SHINGLE_WORDS = 3
# Benchmark shingles that may be broadcast; beyond, the join shuffles.
BROADCAST_SHINGLES = 1_000_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), WORD_BREAK), "")


def _shingles(words: str, count: str, k: int, first: int = 0) -> Column:
    """(place, shingle) of every ``k`` neighbouring words of an array column."""
    at = F.sequence(F.lit(first), F.col(count) - k)
    one = lambda i: F.struct(
        i.alias("pos"), F.concat_ws(" ", *[F.get(F.col(words), i + j) for j in range(k)]).alias("shingle"))
    return F.when(F.col(count) >= k, F.transform(at, one))


def item_windows(items: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """``item_id``, ``win`` (its words joined) and ``len`` of every window."""
    w = items.select("item_id", words_of(text_or_empty()).alias("w")).withColumn("n", F.size("w")).where("n > 0")
    w = w.withColumn("len", F.least("n", F.lit(window)))
    return w.select("item_id", "len", "w", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("len") + 1)).alias("s")) \
        .select("item_id", F.array_join(F.slice("w", F.col("s"), F.col("len")), " ").alias("win"), "len").distinct()


def window_hits(docs: DataFrame, windows: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """Every occurrence: ``doc_id``, ``h`` (hash of the text), ``start``
    (word), ``len`` and ``win``. ``windows`` holds distinct ``win``, ``len``."""
    # shingle length of a window, and the places whose shingles cover it
    w = windows.withColumn("k", F.least("len", F.lit(shingle))).withColumn("words", F.split("win", " "))
    every = w.select("win", "len", "k", "words", F.explode(F.expr("sequence(0, len - k)")).alias("off")) \
        .select("win", "len", "k", "off", F.array_join(F.slice("words", F.col("off") + 1, F.col("k")), " ").alias("shingle"))
    sizes = sorted(r["k"] for r in windows.select(F.least("len", F.lit(shingle)).alias("k")).distinct().collect())
    wanted = every.select("shingle").distinct()
    if wanted.count() <= BROADCAST_SHINGLES:
        wanted = F.broadcast(wanted)
    d = docs.select("doc_id", text_or_empty().alias("text")).select(
        "doc_id", F.xxhash64("text").alias("h"), words_of(F.col("text")).alias("w")).withColumn("n", F.size("w"))
    found = None
    for k in sizes:  # at most ``shingle`` lengths
        part = d.select("doc_id", "h", "n", F.inline(_shingles("w", "n", k)))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return d.select("doc_id", "h", F.lit(0).alias("start"), F.lit(0).alias("len"), F.lit("").alias("win")).limit(0)
    seen = stored(found.join(wanted, "shingle").distinct(), "benchmark-shingles")

    rarity = seen.groupBy("shingle").agg(F.count(F.lit(1)).alias("times"))
    prefix = every.join(rarity, "shingle").groupBy("win", "len").agg(
        F.count(F.lit(1)).alias("there"), F.min(F.struct("times", "shingle", "off")).alias("p"))
    # a window of which a shingle occurs nowhere can't occur
    prefix = prefix.where(F.col("there") == F.col("len") - F.least("len", F.lit(shingle)) + 1).select(
        "win", "len", F.col("p.shingle").alias("shingle"), F.col("p.off").alias("off"))
    cand = seen.join(prefix, "shingle").withColumn("start", F.col("pos") - F.col("off")).where(
        (F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n"))).select("doc_id", "h", "start", "len", "win")

    cover = every.where((F.col("off") % F.col("k") == 0) | (F.col("off") == F.col("len") - F.col("k"))).select(
        "win", "off", "shingle")
    need = cover.groupBy("win").agg(F.count(F.lit(1)).alias("need"))
    asked = cand.join(cover, "win").select("doc_id", "h", "start", "len", "win", (F.col("start") + F.col("off")).alias("pos"),
                                           "shingle")
    s = seen.select(F.col("doc_id").alias("d2"), F.col("h").alias("h2"), F.col("pos").alias("pos2"),
                    F.col("shingle").alias("shingle2"))
    same = F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("h") == F.col("h2")) & (
        F.col("pos") == F.col("pos2")) & (F.col("shingle") == F.col("shingle2"))
    got = asked.join(s, same, "left_semi").groupBy("doc_id", "h", "start", "len", "win").agg(
        F.count(F.lit(1)).alias("got"))
    return got.join(need, "win").where("got = need").select("doc_id", "h", "start", "len", "win")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``h`` (hash of the text), ``n_words``,
    ``n_hit`` (words inside any occurrence of an item's window),
    ``item_ids`` (sorted as strings) and ``contaminated``.

    Null and empty texts have no words. Repeated rows give a row each; rows
    that share a doc_id are judged by their own texts, null doc_ids too. Items
    without words are ignored; an item without an id marks words, but isn't
    listed. Empty tables give no rows or no hits. Other columns are ignored.
    """
    per_item = stored(item_windows(items, window), "item-windows")
    hits = stored(window_hits(docs, per_item.select("win", "len").distinct()), "window-hits")
    before = Window.partitionBy("doc_id", "h").orderBy("start", "len").rowsBetween(Window.unboundedPreceding, -1)
    spans = hits.select("doc_id", "h", "start", "len").distinct()
    end = F.col("start") + F.col("len")
    new = F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(F.max(end).over(before), F.col("start"))))
    n_hit = spans.withColumn("new", new).groupBy("doc_id", "h").agg(F.sum("new").alias("n_hit"))
    ids = hits.join(per_item.select("win", "item_id"), "win").groupBy("doc_id", "h").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    marked = n_hit.join(ids, n_hit["doc_id"].eqNullSafe(ids["doc_id"]) & (n_hit["h"] == ids["h"])).select(
        n_hit["doc_id"].alias("d2"), n_hit["h"].alias("h2"), "n_hit", "item_ids")
    rows = docs.select("doc_id", text_or_empty().alias("text")).select(
        "doc_id", F.xxhash64("text").alias("h"), F.size(words_of(F.col("text"))).cast("bigint").alias("n_words"))
    return rows.join(marked, rows["doc_id"].eqNullSafe(F.col("d2")) & (rows["h"] == F.col("h2")), "left").select(
        "doc_id", "h", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """The rows of ``docs`` whose text holds no window of an item, unchanged."""
    windows = stored(item_windows(items, window), "item-windows").select("win", "len").distinct()
    hit = stored(window_hits(docs, windows).select(F.col("doc_id").alias("__id"), F.col("h").alias("__of")).distinct(),
                 "contaminated")
    rows = docs.withColumn("__h", F.xxhash64(text_or_empty()))
    same = rows["doc_id"].eqNullSafe(hit["__id"]) & (rows["__h"] == hit["__of"])
    return rows.join(hit, same, "left_anti").drop("__h")
