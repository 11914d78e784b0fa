import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from liqspark.llm import packing, secrets, tokenfiles
from liqspark.llm.common import new_folder, read_table, vocabulary
from liqspark.llm.queries import QUERIES
from liqspark.llm.tokens import Encoder

from llm_helpers import base_secrets, docs_of, no_docs, odd_docs, odd_rows

SF = "/root/testdata/sf0.001"
ENC = secrets._encoding(vocabulary("byte_bpe_50k.tiktoken"))


# --- secrets -------------------------------------------------------------------

@pytest.mark.parametrize("text", [
    'x token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" y', "PassWord:abc", "api_key='abcd1234'", "API-key=abcd12345678",
    "AKIAABCDEFGHIJKL AKIASHORT AKIAAKIAABCDEFGHIJK", "deadbeef" * 4, "deadbeef" * 4 + "g" + "0" * 31,
    "secret=secret=12345678", "paſsword=abcdefgh1", "toKen=abcdefgh1", "passwd  =  \"aaaaaaa b", "tokentoken==longenough=="])
def test_base_patterns(text):
    assert sorted(secrets.base_spans(text), key=lambda s: (s[1], secrets.KINDS.index(s[0]))) == base_secrets(text)


def test_random_strings_and_what_is_left_out():
    found = lambda t: [t[s:e] for k, s, e in secrets.secret_spans(t, ENC) if k == "random"]
    key = "9fQ2xV7LkT0zR4bWm8YcJ1uH"
    assert found(f"use {key} here") == [key]
    assert found("an email a.b@mail5.example.com and getUserNameFromTable2 or some_long_name_2024") == []
    assert found("550e8400-e29b-41d4-a716-446655440000 d41d8cd98f00b204e9800998ecf8427e") == []
    assert found("heerheeninontiblethththononouinwhat 12345678901234567890") == []
    # a base span isn't reported again
    assert [k for k, *_ in secrets.secret_spans(f"token={key}", ENC)] == ["assign"]


def test_credentials_with_dots_and_in_urls():
    found = lambda t: [t[s:e] for k, s, e in secrets.secret_spans(t, ENC) if k == "random"]
    head, body, sign = ("eyJhbGciOiJIUzI1NiIsInR5cCI6IkpXVCJ9", "eyJzdWIiOiIxMjM0NTY3ODkwIiwibmFtZSI6IkpvaG4gRG9lIn0",
                        "dozjgNryP4J3jVmNHl0w5N_XgL0n3I9PlFUP0THsR8U")
    assert found(f"Bearer {head}.{body}.{sign} end") == [head, body, sign]
    a, b = "ngeVfQ1TLaU2Zb9xK0m3Qw", "8dYv5sJtN0zq7RbXc2LmP4wHg6FkTe1UoAi9BnSy3Vx"
    assert found(f"key SG.{a}.{b}") == [a, b]
    for url in (f"https://{b}@git.example.com/x", f"https://bob:{b}@git.example.com/x", f"https://git.example.com/{b}",
                f"https://a.b.{b}@git.example.com", f"mail x@{b} y", f"https://api.example.com/v1?key={b}&x=1"):
        assert "".join(found(url)).strip("/").removeprefix("key=") == b
    # hosts, mail domains and file names are no secrets
    assert found("https://d3k9x2m4q8r7t5w3z1vb.cloudfront.net/index.html ops@mx4k9q2z7w1t8r5c3v6b.example.com") == []
    assert found("https://www.example.com/getting-started/install_guide_2024.html see main.configuration_file.yaml") == []


def test_random_letters_and_parts_of_runs():
    import string

    found = lambda t: [t[s:e] for k, s, e in secrets.secret_spans(t, ENC) if k == "random"]
    r = random.Random(11)
    for alphabet, n in ((string.ascii_letters, 20), (string.ascii_letters + string.digits, 16), (string.ascii_lowercase, 20)):
        keys = ["".join(r.choice(alphabet) for _ in range(n)) for _ in range(200)]
        assert sum(found(f"use {k} here") == [k] for k in keys) >= 196
    for k in ("9fQ2xV7LkT0zR4bW", "qhXwVbZtKcPjRmNg"):
        for text in (f"customer-session-identifier={k}", f"files/download/archive/{k}", f"files/{k}/download/archive"):
            assert len(found(text)) == 1 and k in found(text)[0]
    # what lies between words is tested whole, also when each part of it is short
    assert "aB3dE5gH/7jK9lMx+Y2qW8" in found("customer-session-identifier=aB3dE5gH/7jK9lMx+Y2qW8")[0]
    assert found("pass 9fQ2xV7LkT0z") == ["9fQ2xV7LkT0z"]
    assert found("session/550e8400-e29b-41d4-a716-446655440000/d41d8cd98f00b204e9800998ecf8427e") == []
    assert found("internationalization of responsibilities/characteristics and InternationalOrganization") == []


def test_scan_and_redact_odd_rows(spark):
    got = secrets.scan_secrets(odd_docs(spark)).collect()
    assert len(got) == len(odd_rows()) and all(r["spans"] == [] for r in got)
    assert secrets.scan_secrets(no_docs(spark)).count() == 0
    same = secrets.redact(odd_docs(spark))
    assert sorted(map(str, same.collect())) == sorted(map(str, odd_docs(spark).collect()))
    d = spark.createDataFrame([(1, "a token=abcdefgh1 and " + "0" * 40 + " é", 0)], "doc_id int, text string, n_chars int")
    r = secrets.redact(d).first()
    assert r["text"] == "a [SECRET] and [SECRET] é" and r["n_chars"] == len(r["text"])


def test_secret_query_against_plain_version(spark):
    import hashlib

    got = {r["doc_id"]: r for r in QUERIES["op10_secrets"](spark, SF).collect()}
    docs = read_table(spark, SF, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        base, r = base_secrets(d["text"]), got[d["doc_id"]]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == x for x, *_ in base) for k in secrets.KINDS[:3]]
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(r["spans"].split(","))


# --- tokens ----------------------------------------------------------------------

@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_library(spark, name):
    enc, lib, r = Encoder(P.path(name), cache_pieces=40), Tokenizer.from_file(P.path(name)), random.Random(5)
    parts = ["a", "B", "é", "Ñ", " ", "  ", "\n", "\t", "'s", "'", "İ", "²", "5", "_", "-", "—", "漢", "́", "Σ", "ß", "\xa0", "\x1c",
             ".", ",", "<", "|", "ǅ", "ſ", "K", "😀", "‍", "he", " the", "<|endoftext|>", "don't", "WE'LL"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(3000)]
    texts += [d["text"] for d in read_table(spark, SF, "documents").collect()]
    for t in texts:
        assert enc.encode(t) == lib.encode(t, add_special_tokens=False).ids
    assert enc.encode(None) == []


def test_token_files_round_trip(spark):
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    for docs in (odd_docs(spark), read_table(spark, SF, "documents")):
        manifest = tokenfiles.write_token_files(docs, new_folder(spark, "t"), seq_len=64, rows=4)
        got = sorted(tokenfiles.read_token_files(manifest).collect(), key=lambda r: r["start"])
        want = sorted(((d["doc_id"], d["text"] or "") for d in docs.collect()),
                      key=lambda d: (d[0] is not None, d[0] or 0, d[1].encode()))
        assert [r["doc_id"] for r in got] == [d for d, _ in want]
        at = 0
        for r, (_, text) in zip(got, want):
            ids = lib.encode(text, add_special_tokens=False).ids + [1]
            assert (r["start"], r["n_tokens"]) == (at, len(ids))
            assert bytes(r["ids"]) == np.array(ids, "<u4").tobytes()
            at += len(ids)
    empty = tokenfiles.write_token_files(no_docs(spark), new_folder(spark, "t"))
    assert empty.count() == 0 and tokenfiles.read_token_files(empty).count() == 0


def test_random_access_to_sequences(spark):
    manifest = tokenfiles.write_token_files(read_table(spark, SF, "documents"), new_folder(spark, "t"), seq_len=128, rows=8)
    row = manifest.orderBy("part").first()
    f = tokenfiles.TokenFile(row["path"])
    stream = np.concatenate([ids for ids, _, _ in f.batches()])
    assert len(stream) == row["n_tokens"]
    for i in (0, row["n_sequences"] // 2, row["n_sequences"] - 1):
        ids, mask = f.sequence(i)
        part = stream[i * 128:(i + 1) * 128]
        assert len(ids) == 128 and mask.true_count == len(part) and (ids[:len(part)] == part).all()
    with pytest.raises(IndexError):
        f.sequence(row["n_sequences"])


def test_manifest_bases_are_running_sums(spark):
    rows = tokenfiles.write_token_files(read_table(spark, SF, "documents"), new_folder(spark, "t")).orderBy("part").collect()
    assert [r["base"] for r in rows] == list(np.cumsum([0, *(r["n_tokens"] for r in rows)])[:-1])


# --- packing -----------------------------------------------------------------------

def test_each_placement_minimises_the_sum_of_squares():
    r, window = random.Random(1), 16
    sizes = np.array([r.randint(1, window - 1) for _ in range(400)])
    where, offset, fill = packing.place(sizes, window)
    level, counts = {}, [0] * (window + 1)
    squares = lambda c: sum(x * x for x in c[1:window])
    for s, w, o in zip(sizes, where, offset):
        best = []
        for h in range(window - s + 1):
            if h == 0 or counts[h]:
                c = counts[:]
                c[h] -= h > 0
                c[h + s] += 1
                best.append(squares(c))
        assert level.get(w, 0) == o
        counts[o] -= o > 0
        counts[o + s] += 1
        level[w] = o + s
        assert squares(counts) == min(best)
    assert [level[w] for w in range(len(fill))] == fill.tolist()


def check_packed(rows, docs, window=1024):
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    left = {}
    for d in docs:
        ids = lib.encode(d["text"] or "", add_special_tokens=False).ids + [0]
        left.setdefault((d["doc_id"], len(ids)), []).append(np.array(ids, "<u4").tobytes())
    seqs, pieces = {}, {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"], bytes(r["ids"])))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at and length > 0
            at += length
        assert at <= window
    assert set(pieces) == set(left)
    for key, wholes in left.items():
        got = sorted(pieces[key])
        assert sum(n for _, n, _ in got) == key[1] * len(wholes)
        for start, n, ids in got:
            assert any(w[4 * start:4 * (start + n)] == ids for w in wholes)
    return seqs


def test_packed_documents_hold_every_id_once(spark):
    docs = read_table(spark, SF, "documents")
    rows = packing.pack_documents(docs, group_docs=64).collect()
    seqs = check_packed(rows, docs.collect())
    full = sum(n for s in seqs.values() for _, n in s)
    assert full >= 0.95 * 1024 * len(seqs)


def test_packing_odd_rows(spark):
    check_packed(packing.pack_documents(odd_docs(spark)).collect(), odd_docs(spark).collect())
    assert packing.pack_documents(no_docs(spark)).count() == 0
    one = docs_of(spark, [" a" * 1023, " a" * 1024, ""])  # with the end id: a window, a window and one id, one id
    assert sorted(r["length"] for r in packing.pack_documents(one).collect()) == [1, 1, 1024, 1024]


def test_token_queries_give_digests_of_the_ids(spark):
    docs = {d["doc_id"]: d["text"] for d in read_table(spark, SF, "documents").collect()}
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = QUERIES["op4_token_files"](spark, SF).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == sorted(docs)
    for r in rows:
        ids = lib.encode(docs[r["doc_id"]], add_special_tokens=False).ids + [1]
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for r in QUERIES["op5_packing"](spark, SF).collect():
        ids = np.array(lib.encode(docs[r["doc_id"]], add_special_tokens=False).ids + [0], "<u4")
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
