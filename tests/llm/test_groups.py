"""Sharding, decontamination, SimHash and spot signatures."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from liqspark.llm import components, decontaminate, sharding, simhash, spotsigs
from liqspark.llm.common import read_table
from liqspark.llm.queries import QUERIES

from llm_helpers import (docs_of, groups_within, hits, no_docs, odd_docs, odd_rows, prose, simhash as plain_simhash,
                         within_bits)

SF = "/root/testdata/sf0.001"


# --- sharding --------------------------------------------------------------------

def check_shards(rows, shards=8):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    for s, part in by.items():
        assert 0 <= s < shards and sorted(r["slot"] for r in part) == list(range(len(part)))
    return {s: sum(r["size"] for r in p) for s, p in by.items()}


def test_shards_are_even_and_keep_copies_together(spark):
    texts = [prose(i, 5 + i % 40) for i in range(1500)] + [prose(1, 30)] * 700 + [prose(2, 8)] * 40
    rows = sharding.shard_documents(docs_of(spark, texts)).collect()
    assert len(rows) == len(texts)
    sizes = check_shards(rows)
    mean, largest = sum(sizes.values()) / 8, max(len(t) for t in texts) + 1
    assert len(sizes) == 8 and all(abs(x - mean) <= largest + 0.002 * mean for x in sizes.values())
    split = {}
    for r in rows:
        split.setdefault(r["text"], set()).add(r["shard"])
    # a splitter cuts at most one group, and only the group that fills several shards has to be
    assert sum(len(s) > 1 for s in split.values()) <= 7
    assert len(split[prose(2, 8)]) <= 2


def test_hot_group_is_numbered_in_many_parts(spark, monkeypatch):
    monkeypatch.setattr(sharding, "MIN_CELL_BITS", 2)
    monkeypatch.setattr(sharding, "ROWS_PER_CELL", 50)
    texts = ["same text"] * 600 + [prose(i, 9) for i in range(600)]
    rows = sharding.shard_documents(docs_of(spark, texts), shards=3).collect()
    sizes = check_shards(rows, 3)
    assert len(rows) == 1200 and max(sizes.values()) - min(sizes.values()) < 0.05 * sum(sizes.values())


def test_sharding_odd_rows(spark):
    rows = sharding.shard_documents(odd_docs(spark)).collect()
    check_shards(rows)
    assert sorted(r["size"] for r in rows) == sorted(len((t or "").encode()) + 1 for _, t, *_ in odd_rows())
    assert sharding.shard_documents(no_docs(spark)).count() == 0
    same = docs_of(spark, ["a"] * 3).union(docs_of(spark, ["a"] * 3))
    check_shards(sharding.shard_documents(same).collect())


def test_sharding_query(spark):
    docs = {d["doc_id"]: d["text"] for d in read_table(spark, SF, "documents").collect()}
    rows = QUERIES["op3_sharding"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
    check_shards(rows)


# --- decontamination ----------------------------------------------------------------

ITEMS = [(1, prose(100, 25)), (2, prose(101, 12)), (3, "W0x single"), (4, "lonely"), (5, None), (6, " .. "), (None, prose(102, 11)),
         (7, prose(100, 25)), (8, "aa " * 14), (9, "one two three four five six")]


def test_decontamination_against_plain_version(spark):
    texts = [prose(i, 40) for i in range(60)]
    texts += [prose(1, 9) + " " + prose(100, 25) + " " + prose(3, 5), prose(100, 25).upper().replace(" ", ", "), prose(102, 11),
              "a LONELY w0x, single. w0x-single lonely", "aa " * 30, "aa " * 9, prose(101, 12)[:-3], "lonely", ""]
    docs = docs_of(spark, texts).unionByName(odd_docs(spark).select("doc_id", "text"))
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = sorted(map(repr, ((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) for r in
                            decontaminate.decontaminate(docs, items).collect())))
    want = []
    for d in docs.collect():
        n, hit, ids = hits(d["text"], ITEMS)
        want.append(repr((d["doc_id"], n, hit, [i for i in ids if i != "None"], hit > 0)))
    assert got == sorted(want)
    left = decontaminate.drop_contaminated(docs, items).collect()
    assert sorted(map(repr, ((d["doc_id"], d["text"]) for d in left))) == sorted(
        repr((d["doc_id"], d["text"])) for d in docs.collect() if not hits(d["text"], ITEMS)[1])


def test_decontamination_empty_and_clashing(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert decontaminate.decontaminate(no_docs(spark), items).count() == 0
    rows = decontaminate.decontaminate(odd_docs(spark), none).collect()
    assert len(rows) == len(odd_rows()) and not any(r["contaminated"] for r in rows)
    kept = decontaminate.drop_contaminated(odd_docs(spark), none)
    assert kept.columns == odd_docs(spark).columns and kept.count() == len(odd_rows())


def test_decontamination_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_SHINGLES", 0)
    docs = docs_of(spark, [prose(100, 25), prose(7, 30)])
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert [r["contaminated"] for r in decontaminate.decontaminate(docs, items).orderBy("doc_id").collect()] == [True, False]


# --- SimHash ----------------------------------------------------------------------

def close_texts():
    base = prose(5, 120, 400).split()
    out = [" ".join(base)] * 3
    r = random.Random(8)
    for i in range(60):
        w = base[:]
        for _ in range(1 + i % 3):
            w[r.randrange(len(w))] = f"edit{i}"
        out.append(" ".join(w))
    return out + [prose(i, 30 + i, 400) for i in range(60)] + ["", "two words", "two  WORDS", None, "\x0b\x0c"]


def check_simhash(docs, rows):
    want = [plain_simhash(d["text"]) for d in docs]
    root = groups_within(want, within_bits(2))
    ids = {}
    for d, g in zip(docs, root):
        ids.setdefault(g, []).append(d["doc_id"])
    least = {g: min((i for i in v if i is not None), default=None) for g, v in ids.items()}
    assert sorted(map(repr, ((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in rows))) == sorted(
        repr((d["doc_id"], f, least[g])) for d, f, g in zip(docs, want, root))
    return len(least)


@pytest.mark.parametrize("bucket", [256, 2])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)  # 2: nearly all go the way of full buckets
    docs = docs_of(spark, close_texts())
    groups = check_simhash(docs.collect(), simhash.near_duplicates(docs).collect())
    kept = simhash.keep_first(docs).collect()
    assert len(kept) == groups < len(close_texts())


def test_simhash_odd_rows(spark):
    groups = check_simhash(odd_docs(spark).collect(), simhash.near_duplicates(odd_docs(spark)).collect())
    kept = simhash.keep_first(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns and kept.count() == groups
    assert simhash.near_duplicates(no_docs(spark)).count() == 0 and simhash.keep_first(no_docs(spark)).count() == 0
    none = spark.createDataFrame([(None, "a b c")] * 3, "doc_id bigint, text string")
    assert [r["component_id"] for r in simhash.near_duplicates(none).collect()] == [None] * 3
    assert simhash.keep_first(none).count() == 1


def test_block_masks_cover_every_close_pair():
    for blocks in (3, 4, 5, 16):
        masks = simhash.block_masks(blocks, 2)
        for i in range(0, 64, 5):
            for j in range(i, 64, 7):
                diff = (1 << i) | (1 << j)
                assert any(diff & m & (1 << 64) - 1 == 0 for m in masks)
    assert [simhash._blocks_for(n, 2) for n in (10, 1 << 22, 1 << 30, 1 << 40)] == [3, 3, 4, 5]


def test_components_of_chains_stars_and_loops(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(200)] + [(5000, 5000)]
    edges += [(r.randrange(2000, 2100), r.randrange(2000, 2100)) for _ in range(60)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {n: root(n) for a, b in edges if a != b for n in (a, b)}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_simhash_query(spark):
    docs = read_table(spark, SF, "documents").collect()
    fps = [plain_simhash(d["text"]) for d in docs]
    root = groups_within(fps, within_bits(2))
    first = {}
    for d, g in zip(docs, root):
        first[g] = min(first.get(g, d["doc_id"]), d["doc_id"])
    want = {d["doc_id"]: (f"{f:016x}", first[g]) for d, f, g in zip(docs, fps, root)}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op7_simhash"](spark, SF).collect()}
    assert got == want


# --- spot signatures ------------------------------------------------------------------

def plain_sigs(text):
    import regex

    w = [x for x in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if x]
    at = [i for i, x in enumerate(w) if x not in spotsigs.ANCHORS]
    if len(at) < 2:
        return {"^ " + " ".join(w)} if w else set()
    out = set()
    for k in range(len(at) - 1):
        i = at[k]
        if k == 0 or i - at[k - 1] > 1:
            out.add(f"{w[i - 1] if i > 0 and i - (at[k - 1] if k else -1) > 1 else '^'} {w[i]} {w[at[k + 1]]}")
    return out


def plain_likeness(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def spots(docs):
    found = spotsigs.fingerprint_documents(docs)
    return found.withColumn("near_next", spotsigs.likeness(spotsigs.hashes("sigs"), "next_sigs")).collect()


def check_spots(docs, rows, key=lambda d: (d[0] is not None, d[0] or 0)):
    """By doc_id; only for documents whose order the ids alone decide."""
    docs = sorted(docs, key=key)
    got = {r["doc_id"]: r for r in rows}
    for i, (doc_id, text) in enumerate(docs):
        text, nxt, r = text or "", docs[(i + 1) % len(docs)][1] or "", got[doc_id]
        half = len(text) // 2
        assert r["n_chars"] == len(text) and r["edited"] == text[:len(text) - half] + nxt[:half]
        assert set(r["sigs"]) == plain_sigs(text) and set(r["edited_sigs"]) == plain_sigs(r["edited"])
        assert len(r["next_sigs"]) == len(plain_sigs(nxt))
        assert r["near_next"] == plain_likeness(plain_sigs(text), plain_sigs(nxt))


def test_spot_signatures_against_plain_version(spark):
    docs = [(i * 7, prose(i, 3 * i)) for i in range(40)] + [(3, None), (4, "the"), (5, "solo"), (1 << 50, "é ü the ß of x"), (-9, "")]
    rows = spots(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert len(rows) == len(docs)
    check_spots(docs, rows)


def test_next_document_over_many_cells(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "CELL", 4)
    monkeypatch.setattr(spotsigs, "FEW_CELLS", 3)
    r = random.Random(2)
    docs = [(i, f"text {i}") for i in r.sample(range(-500, 5000), 120)]
    check_spots(docs, spots(spark.createDataFrame(docs, "doc_id bigint, text string")))


def test_spots_odd_rows(spark):
    rows = spotsigs.fingerprint_documents(odd_docs(spark)).collect()
    assert len(rows) == len(odd_rows())
    same = [r for r in rows if r["doc_id"] == 9 and r["n_chars"] == 27]
    assert len(same) == 2 and same[0] == same[1]
    assert spotsigs.fingerprint_documents(no_docs(spark)).count() == 0
    one = spotsigs.fingerprint_documents(docs_of(spark, ["abcdef"])).first()
    assert one["edited"] == "abcabc"


def test_likeness_of_sets(spark):
    d = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], []), ([], ["a"]), (["a"], ["a"])], "a array<string>, b array<string>")
    assert [r[0] for r in d.select(spotsigs.likeness("a", "b")).collect()] == [pytest.approx(1 / 3), 1.0, 0.0, 1.0]


@pytest.mark.parametrize("name", ["op2_fingerprints", "op6_decontamination"])
def test_native_queries_equal_their_sql(spark, name):
    import duckdb

    from liqspark.llm.oracle import ORACLE_SQL

    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = c.execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    cols = sorted(names)
    want = sorted(tuple(row[names.index(c)] for c in cols) for row in found.fetchall())
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == cols
    assert sorted(map(tuple, got.select(*cols).collect())) == want
    plan = got._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_signature_column_types(spark):
    d = QUERIES["op2_fingerprints"](spark, SF)
    assert dict(d.dtypes)["near_edited"] == "double" and dict(d.dtypes)["n_chars"] == "bigint"
    assert d.where(F.col("near_edited").isNull() | F.col("near_next").isNull()).count() == 0


@pytest.mark.parametrize("name", ["near_edited", "near_next", "fingerprint", "edited_fingerprint", "edited_sha256", "n_chars"])
def test_predicates_do_not_copy_the_signatures(spark, name):
    d = QUERIES["op2_fingerprints"](spark, SF)
    plain, filtered = (x._jdf.queryExecution().optimizedPlan().toString().count("split(")
                       for x in (d, d.where(F.col(name) > F.lit(0.5).cast(d.schema[name].dataType))))
    assert filtered <= plain + 1


@pytest.mark.parametrize("few", [2, 32])
def test_near_copies_equal_a_comparison_of_all_pairs(spark, monkeypatch, few):
    monkeypatch.setattr(spotsigs, "FEW_MEMBERS", few)
    r = random.Random(8)
    texts = [prose(i, 12 + i % 50) for i in range(120)]
    for i in range(160):  # edits of edits, so that groups are chains too
        w = r.choice(texts).split()
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = r.choice(["the", f"n{i}"])
        texts.append(" ".join(w[:r.randint(8, len(w) + 20)]))
    docs = docs_of(spark, texts + ["", "", texts[0]])
    sets = [set(x["s"]) for x in spotsigs.with_signatures(docs, "text", "s").orderBy("doc_id").collect()]
    for least in (0.5, 0.8):
        alike = lambda a, b: (len(a & b) / len(a | b) if a | b else 1.0) >= least  # noqa: E731,B023
        want = groups_within(sets, alike)
        rows = sorted(spotsigs.near_copies(docs, least).collect())
        assert len(rows) == len(sets) and 1 < len(set(want)) < len(sets)
        by = {}
        for root, x in zip(want, rows):
            by.setdefault(root, set()).add(x["group"])
        assert all(len(x) == 1 for x in by.values()) and len(set().union(*by.values())) == len(by)


def test_near_copies_odd_rows_and_length_bound(spark):
    rows = spotsigs.near_copies(odd_docs(spark)).collect()
    assert len(rows) == len(odd_rows()) and spotsigs.near_copies(no_docs(spark)).count() == 0
    d = spark.createDataFrame([(["a"], ["a", "b", "c"])], "a array<string>, b array<string>")
    assert [d.select(spotsigs.likeness("a", "b", x)).first()[0] for x in (0.0, 0.3, 0.5)] == [pytest.approx(1 / 3)] * 2 + [0.0]
