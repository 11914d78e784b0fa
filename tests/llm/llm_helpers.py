"""Plain versions and awkward inputs for the training-data operators."""

import random
import re

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, score string, h string, shard string, "
          "size string, pos string, fp string, start string, spans string, n string, w string, id string")


def odd_rows():
    """Null ids and texts, empty, blank and very long texts, ties, repeated rows."""
    long = " ".join(f"word{i % 977} the" for i in range(30_000))
    texts = [(5, None), (6, ""), (7, " \n\t "), (8, long), (9, "one two three four five six"),
             (9, "one two three four five six"), (9, "another text under the same id"), (None, "one two three four five six"),
             (None, None), (None, "a text without an id"), (10, "one two three four five six"), (11, "İ ſ K \x00 \x1c ünïcödé ﬁ"),
             (-3, "x"), (1 << 40, "the the the")]
    return [(i, t, None, "s" if t else None, None if t is None else len(t), *["x"] * 11) for i, t in texts]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def prose(seed, words, vocab=60):
    r = random.Random(seed)
    names = ["the", "of", "a", "and", *(f"w{chr(97 + i % 26)}{i}" for i in range(vocab))]
    return " ".join(r.choice(names) for _ in range(words))


def docs_of(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# --- decontamination -------------------------------------------------------

def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def hits(text, items, window=10):
    """(n_words, n_hit, sorted item ids) of one text."""
    w, hit, ids = item_words(text), set(), set()
    for item_id, item in items:
        i = item_words(item)
        n = min(window, len(i))
        wins = {tuple(i[s:s + n]) for s in range(len(i) - n + 1)} if n else set()
        for s in range(len(w) - n + 1):
            if n and tuple(w[s:s + n]) in wins:
                hit.update(range(s, s + n))
                ids.add(item_id)
    return len(w), len(hit), sorted(str(x) for x in ids)


# --- SimHash ----------------------------------------------------------------

def simhash(text, k=3):
    import xxhash

    w = re.findall("[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    parts = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_within(values, linked):
    """Smallest index reachable from each index."""
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def within_bits(limit):
    return lambda a, b: bin(a ^ b).count("1") <= limit


# --- secrets -------------------------------------------------------------------

def base_secrets(text):
    """The contract's patterns, read plainly: match, then drop short ones."""
    text, found = text or "", []
    assign = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    found += [("assign", m.start(), m.end()) for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 8]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda x: (x[1], ("assign", "access", "hex").index(x[0])))
