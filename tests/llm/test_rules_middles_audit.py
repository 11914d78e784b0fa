"""Tokeniser fertility, fill-in-middle and the filter audit."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from liqspark.llm import audit, fertility, fim
from liqspark.llm.common import read_table, vocabulary
from liqspark.llm.queries import QUERIES

from llm_helpers import docs_of, no_docs, odd_docs, odd_rows, prose

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def words():
    return fertility.Vocabularies(vocabulary("piece_bpe_32k.model"), vocabulary("byte_bpe_multi_50k.tiktoken"), 200)


# --- quality rules ----------------------------------------------------------------

def plain_counts(text):
    text = text or ""
    w = re.findall("[^\x20\x09-\x0D]+", text)
    wins = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    often = Counter(wins)
    hit = {i + k for i, x in enumerate(wins) if often[x] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def plain_verdict(text, lang, words, bands):
    n, chars, _, _, repeated = plain_counts(text)
    if n < 10 or 100 * repeated > 20 * n:
        return False
    ids = [i for w in re.findall("[^\x20\x09-\x0D]+", text) for i in words.pieces.encode(w)]
    multi = sum(len(words.multi.encode_ordinary(w)) for w in re.findall("[^\x20\x09-\x0D]+", text))
    share = [c / len(ids) for c in Counter(ids).values()]
    fallback = sum(words.pieces.is_byte(i) for i in ids) / len(ids)
    band, root = bands[fertility.band_of(lang, text, bands)], len(ids) ** 0.5
    return bool(band.min_chars - 2 / root <= chars / len(ids) <= band.max_chars + 2 / root
                and chars / multi >= band.min_multi - 2 / root and fallback <= band.max_bytes + 0.5 / root
                and -sum(p * np.log2(p) for p in share) >= (band.min_entropy - 0.6 / root) * min(6.7, np.log2(len(ids))))


@pytest.mark.parametrize("text", [
    "", " \n\t\x0b\x0c\r ", "a b c d e a b c d e", "x x x x x x", "x x x x x", "a\nb\na\na \n\n\n \n", "ünï # *$%&|<> ñ\x1c\x85 b",
    "a b c d e f a b c d e g a b c d e", prose(1, 400, 6), prose(2, 300, 3), "\n".join([prose(3, 8)] * 4)])
def test_counts_against_plain_version(text):
    w, *rest = fertility.counts(text.encode())
    assert (len(w), *rest) == plain_counts(text)


def test_word_tokens_equal_single_calls(words):
    some = ["the", "▁a", "a▁b", "a　b", "\x00x", "ﬁ", "漢字", "İ̇", "▁", "\U0001f600", "don't", "aaaa" * 50, "x=1;"]
    one = [np.array(words.pieces.encode(w), "<u4").tobytes() for w in some]
    assert words._piece_ids(some) == one and words._piece_ids(some[:1]) == one[:1] and words._piece_ids([]) == []
    plain = [w for w in some if "▁" not in w]
    assert words._piece_ids(plain) == [x for w, x in zip(some, one) if "▁" not in w]


def test_measures_do_not_depend_on_what_was_met_before(words):
    texts = [prose(i, 120, 90).encode().split() for i in range(30)]  # more words than the cache keeps
    first = [words.measure(t, 100) for t in texts]
    assert [words.measure(t, 100) for t in reversed(texts)] == first[::-1]
    assert words.measure([], 0) == (0.0, 0.0, 0.0, 0.0, 0)


def test_verdicts_of_the_query_equal_a_plain_version(spark, words):
    docs = read_table(spark, SF, "documents")
    texts = {r["doc_id"]: (r["text"], r["lang"]) for r in docs.collect()}
    rows = QUERIES["op11_fertility"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        text, lang = texts[r["doc_id"]]
        base = plain_counts(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == base
        assert r["base_failed"] == (base[0] < 10 or 100 * base[4] > 20 * base[0])
        assert r["kept"] == plain_verdict(text, lang, words, fertility.BANDS)
    assert 0 < sum(r["kept"] for r in rows) < len(rows)


def test_good_texts_are_kept_and_covered_badly_ones_are_not(spark):
    docs, labels = read_table(spark, "/root/testdata/sf0.01", "documents"), read_table(spark, "/root/testdata/sf0.01", "labels")
    judged = fertility.judge_documents(docs).join(labels, "doc_id").where("not base_failed")
    share = {r["quality"]: r["kept"] for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] >= 0.995 and share[0] < 0.6
    text = prose(5, 300, 300)
    odd = " ".join(chr(0x1F600 + i) * 3 for i in range(80))  # all byte fallback
    verdicts = {r["doc_id"]: r["kept"] for r in fertility.judge_documents(spark.createDataFrame(
        [(1, text, None), (2, odd, "en"), (3, odd, None)], "doc_id int, text string, lang string"),
        {**fertility.BANDS, "latin": fertility.Band(0.5, 8.0, 0.5, 0.2, 0.1)}).collect()}
    assert verdicts == {1: True, 2: False, 3: True}


def test_bands_and_scripts():
    bands = fertility.BANDS
    assert [fertility.band_of(x, "plain text", bands) for x in ("en", "EN-us", "de_AT", "xx", "", None)] == [
        "en", "en", "de", "latin", "latin", "latin"]
    assert [fertility.script_of(t) for t in ("привет мир ok", "漢字かな交じり文章", "123 !?", "שלום", "")] == [
        "cyrillic", "han", "other", "hebrew", "other"]


def test_fitted_bands_keep_what_they_were_fitted_on(spark):
    judged = fertility.judge_documents(read_table(spark, "/root/testdata/sf0.01", "documents"))
    bands = fertility.fit_bands(judged, ["en", "xx"], 0.01)
    assert set(bands) == {"en"}
    again = fertility.judge_documents(read_table(spark, "/root/testdata/sf0.01", "documents"), bands)
    share = again.where("band = 'en' and not base_failed").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert 0.93 < share < 1.0


def test_fertility_odd_rows(spark):
    rows = fertility.judge_documents(odd_docs(spark)).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(((r["doc_id"], r["n_words"], r["n_repeat_words"]) for r in rows), key=key) == sorted(
        ((i, plain_counts(t)[0], plain_counts(t)[4]) for i, t, *_ in odd_rows()), key=key)
    assert not any(r["kept"] for r in rows if r["n_words"] < 10)
    assert fertility.judge_documents(no_docs(spark)).count() == 0
    assert fertility.judge_documents(docs_of(spark, ["a b"])).first()["band"] == "latin"


# --- fill-in-middle -----------------------------------------------------------------

def plain_middle(doc_id, text):
    text = text or ""
    t = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    p, m, s = "".join(t[:a]), "".join(t[a:b]), "".join(t[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(t), "plain", None, None, text
    if h4 % 100 < 20:
        return len(t), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(t), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


MIDDLES = ["", "a", " ", "abc", "a1b2", "ünïcödé ñ", "<", "<<<P", "P>S>M>", "<P", "<P>", "x<M>y", "İ\x00\U0001f600", "<S<S<M<P>>".replace("<P>", "<P "),
           prose(3, 40), "é" * 30, "<M<S<P" * 5]


@pytest.mark.parametrize("text", MIDDLES)
def test_middles_against_plain_version(text):
    for doc_id in [*range(-3, 40), None, 1 << 62]:
        n, form, prefix, middle, out = fim.fill_in_middle(text.encode(), doc_id)
        assert (n, form, prefix, middle, out.decode()) == plain_middle(doc_id, text)
        assert fim.invert(out, form).decode() == text


@pytest.mark.parametrize("form", ["psm", "spm"])
def test_every_cut_is_restored(form):
    raw = "a <P b> é<S x".encode()
    for a, b in itertools.combinations_with_replacement(range(len(raw) + 1), 2):
        assert fim.invert(fim.transform(raw, form, a, b), form) == raw


def test_rotation_exchanges_blocks():
    for a, b, c in itertools.combinations_with_replacement(range(7), 3):
        buf = bytearray(b"abcdef")
        fim.rotate(buf, a, b, c)
        assert bytes(buf) == b"abcdef"[:a] + b"abcdef"[b:c] + b"abcdef"[a:b] + b"abcdef"[c:]


def test_middles_of_the_query(spark):
    docs = {r["doc_id"]: r["text"] for r in read_table(spark, SF, "documents").collect()}
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    rows = QUERIES["op12_fill_in_middle"](spark, SF).collect()
    assert len(rows) == len(docs) and {r["form"] for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        *want, out = plain_middle(r["doc_id"], docs[r["doc_id"]])
        assert [r["n"], r["form"], r["prefix_chars"], r["middle_chars"]] == want
        assert (r["output_sha256"], r["restored_sha256"]) == (sha(out), sha(docs[r["doc_id"]]))


def test_middles_odd_rows(spark):
    moved = fim.transform_documents(odd_docs(spark))
    rows = fim.restore_documents(moved.withColumn("restored", F.lit(1))).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(((r["doc_id"], r["restored"], r["output"]) for r in rows), key=key) == sorted(
        ((i, t or "", plain_middle(i, t)[-1]) for i, t, *_ in odd_rows()), key=key)
    assert fim.restore_documents(fim.transform_documents(no_docs(spark))).count() == 0
    none = spark.createDataFrame([(1, None, None)], "doc_id int, output string, form string")
    assert fim.restore_documents(none).first()["restored"] == ""


# --- filter audit -----------------------------------------------------------------------

def plain_audit(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic). Every order, document by document."""
    good, toxic = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, t in labels if t == 1} - {None}
    kinds = []
    for i, text, source in docs:
        t = text or ""
        w = re.findall("[^\x20\x09-\x0D]+", t)
        copy = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": re.search(r"[#$%&*|]", t) is not None, "E": copy}
        kinds.append((source or "", fails, i in good, i in toxic))
    out, shapley = {}, Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {k[0] for k in kinds}:
            rest = [k for k in kinds if k[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                hit = [k for k in rest if k[1][f]]
                rest = [k for k in rest if not k[1][f]]
                shapley[part, f] += len(hit)
                alone = sum(k[1][f] and sum(k[1].values()) == 1 for k in kinds if k[0] == part)
                out[part, order, step] = (len(rest), len(hit), sum(k[1][f] for k in gone), alone,
                                          sum(k[2] for k in hit), sum(k[3] for k in hit))
                gone += hit
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def rows_of(d):
    return {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"],
                                                        r["toxic_lost"], r["shapley"]) for r in d.collect()}


def audit_rows(seed, n=120):
    r = random.Random(seed)
    texts = [prose(i, r.choice([3, 49, 50, 51, 80]), r.choice([5, 40, 400])) for i in range(n // 2)]
    texts += [t.upper() for t in texts[:6]] + [t + " #1 |" for t in texts[6:12]] + ["", " ", None, "A", "ÀÉ É"]
    docs = [(i if r.random() < 0.9 else None, r.choice(texts), r.choice(["a", "b", "", None])) for i in range(n)]
    docs += [docs[0], docs[1], (docs[2][0], "another text", "a")]
    labels = [(r.randrange(-2, n), r.choice([0, 1, None]), r.choice([0, 1, None])) for _ in range(n)] + [(None, 1, 1)]
    return docs, labels


@pytest.mark.parametrize("seed, words, docs_each", [(1, 1 << 21, 1 << 16), (2, 100, 1 << 16), (3, 1 << 21, 7)])
def test_audit_against_plain_version(spark, monkeypatch, seed, words, docs_each):
    monkeypatch.setattr(audit, "BUCKET_WORDS", 50)
    build = audit.build_shards
    monkeypatch.setattr(audit, "build_shards", lambda d, *_: build(d, words, docs_each))
    docs, labels = audit_rows(seed)
    d = spark.createDataFrame([(*x, 1, "x") for x in docs], "doc_id bigint, text string, source string, mask int, part string").repartition(3)
    got = rows_of(audit.audit_filters(d, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")))
    assert got == plain_audit(docs, labels)


def test_document_terms_are_the_documents_words(spark, monkeypatch):
    monkeypatch.setattr(audit, "BUCKET_WORDS", 16)
    texts = [prose(i, 30 + i, 50) for i in range(40)] + ["", "one one two"]
    matrix = audit.document_terms(docs_of(spark, texts).repartition(4), shard_words=300).collect()
    assert len(matrix) > 6
    found, ids = {}, {}
    for s in matrix:
        ptr, col, val = (np.frombuffer(s[c], t) for c, t in (("indptr", "<i8"), ("indices", "<i8"), ("data", "<u4")))
        for k, i in enumerate(s["doc_id"]):
            found[i] = dict(zip(col[ptr[k]:ptr[k + 1]].tolist(), val[ptr[k]:ptr[k + 1]].tolist()))
    # one number a word over all shards: the multisets agree, and so do any two documents' common words
    for i, t in enumerate(texts):
        assert Counter(found[i].values()) == Counter(Counter(t.split()).values())
        for w, n in Counter(t.split()).items():
            ids.setdefault(w, set(found[i]))
            ids[w] &= {c for c, k in found[i].items() if k == n}
    assert all(ids.values()) and len(set().union(*[set(f) for f in found.values()])) == len({w for t in texts for w in t.split()})
    a, b = texts[3].split(), texts[9].split()
    assert len(set(found[3]) & set(found[9])) == len(set(a) & set(b))


def test_audit_odd_rows(spark):
    labels = spark.createDataFrame([(5, 1, 1), (None, 1, 1), (9, None, None)], "doc_id bigint, quality int, toxic int")
    docs = odd_docs(spark)
    want = plain_audit([(i, t, s) for i, t, _, s, *_ in odd_rows()], [(5, 1, 1), (None, 1, 1), (9, None, None)])
    assert rows_of(audit.audit_filters(docs, labels)) == want
    assert audit.audit_filters(no_docs(spark), labels).count() == 0
    assert len(rows_of(audit.audit_filters(docs_of(spark, ["a", "a"]), labels.limit(0)))) == 600


def test_audit_of_copies_in_many_sources(spark):
    docs = [(i, "the same text", f"s{i % 40}") for i in range(400)]
    got = rows_of(audit.audit_filters(spark.createDataFrame(docs, "doc_id bigint, text string, source string"),
                                      spark.createDataFrame([], "doc_id bigint, quality int, toxic int")))
    assert got == plain_audit(docs, [])
