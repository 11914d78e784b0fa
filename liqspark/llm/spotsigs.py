"""Spot signatures: chains of content words that follow common words.

A text's signatures are a set: for every content word right after a common
word (an anchor, the text's start included), the anchor, that word and the
content word after it, common words between being skipped. Likeness is the
Jaccard index of two sets, and sets of very different length need no
comparison: the shorter over the longer length bounds it from above.

The corpus-wide join compares distinct signature sets that share one of their
rarest signatures and lie in the same partition of set lengths or the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound, stored, text_or_empty
from .components import components

# Common words of the four languages of the corpus.
ANCHORS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the",
    "this", "to", "was", "were", "which", "with",
    "auf", "das", "dem", "den", "der", "des", "die", "ein", "eine", "einer", "im", "ist", "mit", "nicht", "sich", "und",
    "von", "zu",
    "au", "aux", "ce", "dans", "de", "du", "elle", "en", "est", "et", "il", "la", "le", "les", "par", "pas", "pour",
    "que", "qui", "sur", "un", "une",
    "al", "como", "con", "del", "el", "es", "las", "los", "no", "para", "por", "se", "su", "una", "y")
START = "^"
CELL = 1024  # consecutive doc_ids in one group when neighbours are sought
FEW_CELLS = 10_000  # group heads that one task may put in order
MIN_LIKENESS = 0.5
FEW_MEMBERS = 32  # sets under one signature that are all compared with each other
LEADER_ROUNDS = 3


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def with_signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the sorted distinct signatures of column ``text`` as ``out``."""
    w, at = f"{out}_words", f"{out}_at"
    df = bound(df, w, words_of(F.col(text)))
    places = F.when(F.size(w) > 0, F.sequence(F.lit(0), F.size(w) - 1)).otherwise(F.array().cast("array<int>"))
    df = bound(df, at, F.filter(places, lambda i: ~F.get(F.col(w), i).isin(*ANCHORS)))
    word = lambda k: F.get(F.col(w), F.get(F.col(at), k))
    before = lambda k: F.get(F.col(w), F.get(F.col(at), k) - 1)
    gap = lambda k: F.get(F.col(at), k) - F.coalesce(F.get(F.col(at), k - 1), F.lit(-1)) > 1
    chain = lambda k: F.when((k == 0) | gap(k), F.concat_ws(
        " ", F.when(gap(k), before(k)).otherwise(F.lit(START)), word(k), word(k + 1)))
    many = F.array_compact(F.transform(F.sequence(F.lit(0), F.size(at) - 2), chain))
    one = F.array(F.concat_ws(" ", F.lit(START), F.array_join(F.col(w), " ")))
    sigs = F.when(F.size(at) >= 2, many).when(F.size(w) > 0, one).otherwise(F.array().cast("array<string>"))
    return bound(df, out, F.array_sort(F.array_distinct(sigs))).drop(w, at)


def likeness(a: Column | str, b: Column | str, least: float = 0.0) -> Column:
    """Jaccard index of two signature sets; two empty sets are alike, and an
    empty one is unlike any other without a comparison. With ``least``, 0 and
    no comparison where the lengths alone keep the index below it."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    both = F.size(F.array_intersect(a, b))
    short, long = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    return F.when(long == 0, F.lit(1.0)).when((short == 0) | (short < least * long), F.lit(0.0)).otherwise(
        both / (F.size(a) + F.size(b) - both))


def hashes(sigs: str) -> Column:
    """A signature set as 64-bit hashes."""
    return F.transform(F.col(sigs), lambda s: F.xxhash64(s))


def digest(sigs: str) -> Column:
    """A signature set as a short string; equal sets have equal digests."""
    return F.md5(F.array_join(F.col(sigs), ","))


def _next_head(heads: DataFrame) -> DataFrame:
    """``heads`` (``cell``, ``head``) with ``following``: the head of the next
    cell in order, null after the last. Cells are grouped again until few are
    left, so no task orders more than a bounded number."""
    if heads.count() <= FEW_CELLS:
        return heads.withColumn("following", F.lead("head").over(Window.orderBy("cell")))
    heads = heads.withColumn("up", F.floor(F.col("cell") / CELL))
    inner = heads.withColumn("following", F.lead("head").over(Window.partitionBy("up").orderBy("cell")))
    above = _next_head(stored(heads.groupBy(F.col("up").alias("cell")).agg(F.min("head").alias("head")), "heads"))
    above = above.select(F.col("cell").alias("up"), F.col("following").alias("later"))
    return inner.join(above, "up").select("cell", "head", F.coalesce("following", "later").alias("following"))


def successors(keys: DataFrame) -> DataFrame:
    """Distinct keys (``doc_id``, ``h``) with ``next`` (struct of the same) in
    ascending order, nulls first; the first follows the last."""
    key = F.struct("doc_id", "h")
    keys = keys.withColumn("cell", F.coalesce(F.floor(F.col("doc_id") / CELL), F.lit(-(1 << 62))))
    inner = keys.withColumn("following", F.lead(key).over(Window.partitionBy("cell").orderBy("doc_id", "h")))
    heads = stored(keys.groupBy("cell").agg(F.min(key).alias("head")), "heads")
    first = heads.agg(F.min("head").alias("first")).first()["first"]
    after = _next_head(heads).select("cell", F.col("following").alias("later"))
    if first is None:
        return inner.select(*[c for c in keys.columns if c != "cell"], F.col("following").alias("next"))
    start = F.struct(F.lit(first["doc_id"]).cast("bigint").alias("doc_id"), F.lit(first["h"]).cast("bigint").alias("h"))
    return inner.join(after, "cell").select(*[c for c in keys.columns if c != "cell"], F.coalesce(
        "following", "later", start).alias("next"))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Signatures of every text and of its edited text (the last half, rounded
    down, replaced by as many code points from the next document's start).

    Per row: ``doc_id``, ``n_chars``, ``edited``, ``sigs``, ``edited_sigs`` and
    ``next_sigs`` (64-bit hashes of the next document's, which travel). Documents follow by doc_id (nulls first), then hash of the
    text; equal rows count as one document and give a row each. A null text is
    empty; a lone document is its own next. An empty table gives no rows, and
    other columns are ignored.
    """
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    d = d.withColumn("h", F.xxhash64("text"))
    # an id for the joins that equals itself when null
    d = d.withColumn("id", F.coalesce("doc_id", F.xxhash64(F.lit("no id"), "h")))
    rows = stored(d.select("doc_id", "h", "id", F.char_length("text").alias("n")), "keys")
    order = stored(successors(rows.distinct()), "successors")
    # for each document, who it follows and how much of it goes there
    before = order.select(F.coalesce("next.doc_id", F.xxhash64(F.lit("no id"), "next.h")).alias("id"),
                          F.col("next.h").alias("h"), F.col("id").alias("to_id"), F.col("h").alias("to_h"),
                          F.col("doc_id").alias("to_doc"), F.floor(F.col("n") / 2).cast("int").alias("half"))
    # both joins take the texts by the same key and columns, so they are exchanged once
    texts = d.select("id", "h", "text")
    each = texts
    if rows.count() > order.count():  # equal rows send their text once
        each = texts.dropDuplicates(["id", "h"])
    sent = with_signatures(each.join(before, ["id", "h"]), "text", "sigs").select(
        F.col("to_id").alias("id"), F.col("to_h").alias("h"), F.col("to_doc").alias("doc_id"),
        F.substring("text", F.lit(1), F.col("half")).alias("tail"), hashes("sigs").alias("next_sigs"))
    n = F.char_length("text")
    rows = texts.join(sent, ["id", "h"]).withColumn("n_chars", n.cast("bigint")).withColumn("edited", F.concat(
        F.substring("text", F.lit(1), n - F.floor(n / 2).cast("int")), F.col("tail")))
    rows = with_signatures(with_signatures(rows, "text", "sigs"), "edited", "edited_sigs")
    return rows.select("doc_id", "n_chars", "edited", "sigs", "edited_sigs", "next_sigs")


def _rare_signatures(classes: DataFrame, least: float) -> DataFrame:
    """The inverted index: ``sig``, ``part`` (partition of set lengths),
    ``class``, ``n`` and ``at`` (rank of the signature in its set, rarest
    first). Two sets that are alike share one of the first n - least n + 1 of
    each. Signatures of one set only are ranked first, but find nothing."""
    each = classes.select("class", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    shared = each.groupBy("sig").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    ranked = each.join(shared, "sig").groupBy("class", "n").agg(F.array_sort(F.collect_list(F.struct("f", "sig"))).alias("s"))
    alone = F.col("n") - F.size("s")
    first = F.col("n") - F.ceil(F.lit(least) * F.col("n") - 1e-9).cast("int") + 1
    kept = ranked.select("class", "n", alone.alias("alone"), F.slice("s", 1, F.greatest(first - alone, F.lit(0))).alias("s"))
    # a pair's lengths lie in one partition or two that follow; the shorter set is in both
    part = F.floor(F.log("n") / F.log(F.lit(1 / least)) + 1e-9)
    return kept.select("class", "n", "alone", F.posexplode("s").alias("i", "s"), part.alias("part")).select(
        F.col("s.sig").alias("sig"), F.explode(F.array("part", F.col("part") + 1)).alias("part"), "class", "n",
        (F.col("alone") + F.col("i")).alias("at"))


def _may_be_alike(least: float) -> Column:
    """By the lengths of two sets, and by what is left of each after a shared signature."""
    na, nb = F.col("a.n"), F.col("b.n")
    left = 1 + F.least(na - 1 - F.col("a.at"), nb - 1 - F.col("b.at"))
    return (F.least(na, nb) >= least * F.greatest(na, nb) - 1e-9) & (left >= least / (1 + least) * (na + nb) - 1e-9)


def _links(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """The pairs (``a``, ``b``) whose sets are alike."""
    of = lambda c: classes.select(F.col("class").alias(c), F.col("sigs").alias(f"sigs_{c}"))
    both = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return both.join(of("a"), "a").join(of("b"), "b").where(likeness("sigs_a", "sigs_b", least) >= least).select("a", "b")


def near_copies(docs: DataFrame, least: float = MIN_LIKENESS) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``class`` (64-bit hash of the signature
    set; equal sets are one class) and ``group``, the smallest class reachable
    over pairs of classes whose likeness is ``least`` (over 0, under 1) or more.

    The groups are those of a comparison of all pairs. Under a signature of
    more than ``FEW_MEMBERS`` classes, members are compared with leaders first,
    and then only with members of other groups: pairs inside a group add
    nothing, so many near copies aren't all paired. A null text is empty;
    repeated rows and null doc_ids keep a row each; an empty table gives no
    rows, and other columns are ignored.
    """
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    d = with_signatures(d, "text", "words").select("doc_id", F.array_sort(F.array_distinct(hashes("words"))).alias("sigs"))
    d = stored(d.withColumn("class", F.xxhash64("sigs")), "sets")
    classes = stored(d.groupBy("class").agg(F.first("sigs").alias("sigs")), "classes")
    index = _rare_signatures(classes, least)
    index = stored(index, "index")
    key = ["sig", "part"]
    count = index.groupBy(*key).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    few = index.join(count.where(F.col("members") <= FEW_MEMBERS), key)
    pairs = few.alias("a").join(few.alias("b"), key).where("a.class < b.class").where(_may_be_alike(least))
    links = stored(_links(pairs.select(F.col("a.class").alias("a"), F.col("b.class").alias("b")), classes, least), "links")
    many = stored(index.join(count.where(F.col("members") > FEW_MEMBERS).select(*key), key), "many")
    found = components(links)

    def grouped() -> DataFrame:
        return many.join(found.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))

    if many.limit(1).count():
        for i in range(LEADER_ROUNDS):
            now = grouped()
            lead = now.groupBy(*key).agg(F.min(F.struct(F.xxhash64("class", F.lit(i)).alias("x"), "class", "root")).alias("l"))
            pairs = now.join(lead, key).where("root <> l.root").select(F.col("class").alias("a"), F.col("l.class").alias("b"))
            links = stored(links.unionByName(_links(pairs, classes, least)), "links")
            found = components(links)
        now = stored(grouped(), "many")
        roots = now.select(*key, "root").distinct()
        other = roots.alias("x").join(roots.alias("y"), key).where("x.root < y.root").select(
            *key, F.col("x.root").alias("ra"), F.col("y.root").alias("rb"))
        a, b = (now.select(*key, F.col("root").alias(r), F.struct("class", "n", "at").alias(c)) for r, c in (("ra", "a"), ("rb", "b")))
        pairs = other.join(a, [*key, "ra"]).join(b, [*key, "rb"]).where(_may_be_alike(least))
        links = stored(links.unionByName(_links(pairs.select(
            F.col("a.class").alias("a"), F.col("b.class").alias("b")), classes, least)), "links")
        found = components(links)
    return d.select("doc_id", "class").join(found.withColumnRenamed("node", "class"), "class", "left").select(
        "doc_id", "class", F.coalesce("root", "class").alias("group"))
