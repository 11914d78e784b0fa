"""URL filter: fixed rules, and a path-template tree for all other URLs.

Each host has a tree of path segments. Numbers and codes in a segment become
placeholders at once. Level by level, branches without any labelled URL become
``*``, those whose labelled share of unwanted URLs doesn't differ from their
siblings' merge into ``~``, and all others keep their name. A branch's share of
unwanted URLs is smoothed towards what its parent's other labels say, so one
with few labels stays near it and one without has the parent's. A template is rejected if its share is
high. URLs a rule decides have a tree of their own: a verdict on a path says
nothing about what lies beside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored

# Fixed values: (verdict, host, path), the rules of the contract.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
# Words of a host name that label its URLs as unwanted where no rule speaks.
UNWANTED = ("adult", "ads", "bets", "casino", "pills", "porn", "spam", "xxx")
# What a page says of itself: its rating, or else the words of its text.
RATED_BAD, RATED_GOOD = ("adult", "mature", "restricted", "rta-5042-1996-1400-rta"), ("general", "safe for kids")
BAD_WORDS = 3  # different unwanted words that label a page as unwanted
GOOD_LENGTH = 50  # words of a text that label its page as wanted if none is an unwanted one
MAX_DEPTH = 8  # segments of a template; the rest of a longer path is one more
MIN_LABELLED = 5
PRIOR_URLS = 2  # weight of the parent's share; a host's own is smoothed towards a half
NEUTRAL = 0.5
MAX_Z = 2.58
MIN_PURITY = 0.8


def host_and_path() -> list[Column]:
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    parts = r"://([^/?#]*)([^?#]*)"
    return [ascii_lower(F.regexp_extract(url, parts, 1)).alias("host"), F.regexp_extract(url, parts, 2).alias("path")]


def rule_for(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """The longest rule that fits, as a struct of ``name`` and ``verdict``; a
    given, short list, so each rule is one branch of an expression."""
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("name"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def shape(path: Column) -> Column:
    """Path segments with their variable parts replaced: long hexadecimal
    codes, then runs of digits."""
    one = lambda s: F.regexp_replace(F.regexp_replace(
        s, r"(?i)\b(?=[0-9a-f-]*[0-9])[0-9a-f]{8,}(?:-[0-9a-f]{4,})*\b", "{x}"), r"[0-9]+", "{n}")
    parts = F.array_remove(F.split(path, "/"), "")
    short = F.when(F.size(parts) <= MAX_DEPTH, parts).otherwise(F.concat(
        F.slice(parts, 1, MAX_DEPTH), F.array(F.array_join(F.slice(parts, F.lit(MAX_DEPTH + 1), F.size(parts)), "/"))))
    return F.transform(short, one)


def page_label(html: Column, unwanted: tuple = UNWANTED) -> Column:
    """1, 0 or null by a page itself: its rating tag, else how many of the
    unwanted words are in its text."""
    tag = F.regexp_extract(html, r"(?i)<meta\s[^>]*name=[\"']?rating\b[^>]*>", 0)
    rating = ascii_lower(F.trim(F.regexp_extract(tag, r"(?i)content=[\"']?([^\"'>]*)", 1)))
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)|<!--.*?(?:-->|\z)|<[^>]*>", " ")
    words = F.array_remove(F.split(ascii_lower(text), r"[^\p{L}\p{N}]+"), "")
    n = F.size(F.array_intersect(words, F.array(*map(F.lit, unwanted)))) if unwanted else F.lit(0)
    return F.when(rating.isin(*RATED_BAD), 1).when(rating.isin(*RATED_GOOD), 0).when(n >= BAD_WORDS, 1).when(
        (n == 0) & (F.size(words) >= GOOD_LENGTH), 0)


def templates(shapes: DataFrame) -> DataFrame:
    """``host``, ``tree``, ``shape``, ``template`` and its ``purity``, from
    counts (``good``, ``bad``) of every shape. Every step is a grouped sum
    joined back, so a host with very many URLs is no group of its own in a task.

    A branch's prior is its parent's share without the branch's own labels, so
    each label counts once in a purity: a branch that holds all labels of its
    parent has the parent's purity, however deep it lies. A branch whose labels
    differ from its parent's share isn't like its siblings, so these say
    nothing about it: its prior is neutral.
    """
    sums = [F.sum("bad").alias("b"), F.sum("good").alias("g")]
    share = lambda b, g, prior: (b + PRIOR_URLS * prior) / (b + g + PRIOR_URLS)
    purity = share(F.col("nb"), F.col("ng"), F.col("prior"))
    top = shapes.groupBy("host", "tree").agg(F.sum("bad").alias("nb"), F.sum("good").alias("ng")).select(
        "host", "tree", "nb", "ng", F.lit("").alias("template"), F.lit(NEUTRAL).alias("prior"))
    t = stored(shapes.join(top, ["host", "tree"]), "shapes")
    depth = t.agg(F.max(F.size("shape")).alias("d")).first()["d"] or 0
    node, held = ["host", "tree", "template"], ["nb", "ng", "prior"]  # a node's labels and prior
    for level in range(min(depth, MAX_DEPTH + 1)):
        at = t.withColumn("seg", F.get("shape", F.lit(level)))
        kids = at.where("seg is not null").groupBy(*node, "seg").agg(*sums, *[F.max(c).alias(c) for c in held])
        n, p = F.col("b") + F.col("g"), F.least(F.greatest(purity, F.lit(1e-6)), F.lit(1 - 1e-6))
        z = F.abs(F.col("b") / n - p) / F.sqrt(p * (1 - p) / n)
        differs = (n >= MIN_LABELLED) & (z > MAX_Z)
        name = F.when(n == 0, "*").when((n >= MIN_LABELLED) & (z <= MAX_Z), "~").otherwise(F.col("seg"))
        named = kids.withColumns({"name": name, "differs": F.coalesce(differs, F.lit(False))})
        group = named.groupBy(*node, "name").agg(
            F.sum("b").alias("b"), F.sum("g").alias("g"), F.max("differs").alias("differs"), *[F.max(c).alias(c) for c in held]).select(
            *node, "name", F.col("b").alias("_nb"), F.col("g").alias("_ng"),
            F.when(F.col("differs"), NEUTRAL).otherwise(
                share(F.col("nb") - F.col("b"), F.col("ng") - F.col("g"), F.col("prior"))).alias("_prior"))
        named = named.select(*node, "seg", "name").join(group, [*node, "name"])
        t = stored(at.join(named, [*node, "seg"], "left").withColumns(
            {c: F.coalesce(f"_{c}", c) for c in held}).withColumn(
            "template", F.when(F.col("seg").isNull(), F.col("template")).otherwise(
                F.concat("template", F.lit("/"), "name"))).drop("seg", "name", *[f"_{c}" for c in held]), "templates")
    return t.select("host", "tree", "shape", "template", purity.alias("purity"))


def filter_urls(pages: DataFrame, labels: DataFrame | None = None, rules: tuple = RULES,
                unwanted: tuple = UNWANTED, min_purity: float = MIN_PURITY) -> DataFrame:
    """Per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule`` (or
    null), ``template``, ``purity`` (smoothed share of unwanted URLs) and
    ``verdict``.

    Labels are the rules' verdicts (for the URLs of the same rule only), then
    host words in ``unwanted``, then ``labels`` (``page_id``, ``bad`` 0 or 1; a
    page with several is bad if one says so), then what ``html``, if it is a
    column of ``pages``, says. A null url or one without ``://`` has an empty host and path and
    is judged like any other. Repeated rows and null page_ids keep a row each;
    an empty table gives no rows; other columns are ignored.
    """
    said = page_label(F.col("html").cast("string"), unwanted) if "html" in pages.columns else F.lit(None).cast("int")
    p = pages.select("page_id", *host_and_path(), said.alias("said")).withColumn("found", rule_for(F.col("host"), F.col("path"), rules))
    known = F.when(F.col("found").isNotNull(), (F.col("found.verdict") == "block").cast("int"))
    if unwanted:
        words = F.split("host", r"[^a-z]+")
        known = F.coalesce(known, F.when(F.arrays_overlap(words, F.array(*map(F.lit, unwanted))), 1))
    if labels is not None:
        given = labels.where("page_id is not null and bad is not null").groupBy("page_id").agg(
            F.max("bad").cast("int").alias("given"))
        p = p.join(given, "page_id", "left")
        known = F.coalesce(known, F.col("given"))
    p = p.withColumn("shape", shape(F.col("path"))).withColumn("bad", F.coalesce(known, F.col("said"))).withColumn(
        "tree", F.coalesce("found.name", F.lit("")))
    shapes = p.groupBy("host", "tree", "shape").agg(
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.count("bad").alias("labelled")).select(
        "host", "tree", "shape", "bad", (F.col("labelled") - F.col("bad")).alias("good"))
    judged = p.join(templates(shapes), ["host", "tree", "shape"])
    return judged.select(
        "page_id", "host", "path", F.col("found.name").alias("rule"), "template", "purity",
        F.coalesce("found.verdict", F.when(F.col("purity") >= min_purity, "block").otherwise("allow")).alias("verdict"))
