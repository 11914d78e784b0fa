"""Toxicity, URL filter, license scan and the pipeline."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from liqspark.llm import licenses, secrets, toxicity, urls
from liqspark.llm.common import read_table, vocabulary
from liqspark.llm.queries import QUERIES

from llm_helpers import groups_within, hits, no_docs, odd_docs, odd_rows, prose, simhash, within_bits
from test_secrets_tokens import check_packed

SF = "/root/testdata/sf0.001"


# --- toxicity ----------------------------------------------------------------------

def plain_segments(scores, first=0):
    """The definition: the best segment (shortest, then leftmost of equals), then each side of it."""
    best = None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            s = round(sum(scores[i:j]), 9)
            if s > 0 and (best is None or s > best[2] or s == best[2] and j - i < best[1] - best[0]):
                best = (i, j, s)
    if best is None:
        return []
    i, j, s = best
    return plain_segments(scores[:i], first) + [(first + i, first + j, s)] + plain_segments(scores[j:], first + j)


def test_segments_are_the_maximal_ones():
    r = random.Random(3)
    for _ in range(300):
        scores = np.array([r.choice([-1.37, -0.71, -0.13, 0.53, 1.19, 2.03]) + r.random() / 7 for _ in range(r.randint(0, 14))])
        got = [(a, b, round(s, 6)) for a, b, s in toxicity.segments(scores)]
        assert got == [(a, b, round(s, 6)) for a, b, s in plain_segments(scores.tolist())]


def test_log_odds_shrink_rare_words():
    toxic, clean, corpus = np.array([50.0, 1, 500, 0]), np.array([0.0, 0, 500, 900]), np.array([60.0, 2, 9000, 9000])
    w = toxicity.log_odds(toxic, clean, corpus)
    assert w[0] > 1 and w[1] == 0 and w[3] < 0


def test_extreme_value_fit_finds_its_parameters():
    r = np.random.default_rng(1)
    n = r.integers(20, 2000, 20_000)
    x = (np.log(0.3 * n) - np.log(-np.log(r.random(20_000)))) / 1.7
    rate, scale = toxicity.fit_extreme_value(x, n)
    assert abs(rate - 1.7) < 0.15 and 0.15 < scale < 0.6


def test_joint_surprise_never_falls_for_a_better_or_further_segment():
    r, model = random.Random(5), toxicity.Model(np.zeros(0, np.float32), 1.3, 0.2)
    for _ in range(3000):
        best = sorted((r.choice([0.1, 1, 4, 9]) * r.random() for _ in range(r.randint(0, 40))), reverse=True)
        words = r.choice([1, 5, 80, 3000])
        before = toxicity.joint_surprise(best, words, model)
        better = list(best)
        if better:
            better[r.randrange(len(better))] += r.choice([1e-6, 0.01, 0.5, 5])
            assert toxicity.joint_surprise(sorted(better, reverse=True), words, model) >= before
        further = sorted([*best, 5 * r.random()], reverse=True)
        assert toxicity.joint_surprise(further, words, model) >= before


def test_joint_surprise_is_calibrated_on_drawn_text():
    g, model = np.random.default_rng(7), toxicity.Model(np.zeros(0, np.float32), 1.0, 1.0)
    drawn = 40_000
    # normalised scores of clean text: -log of the arrivals of a Poisson process
    scores = -np.log(np.cumsum(g.exponential(size=(drawn, 40)), axis=1))
    t = np.array([toxicity.joint_surprise([x for x in row.tolist() if x > 0], 1, model) for row in scores])
    for level in (1.0, 2.0, 3.0):
        assert (t >= level).mean() <= 10 ** -level * (1 + 4 / math.sqrt(drawn * 10 ** -level))
    # the tabled law of the sums against the draws
    sums = np.cumsum(scores, axis=1)
    for r in (2, 3, 5):
        for at in (0.0, 1.0, 3.0):
            seen, known = (sums[:, r - 1] >= at).mean(), 10 ** -toxicity.sum_surprise()[r - 2][int(at / toxicity.SUM_STEP)]
            assert abs(seen - known) < 4 * math.sqrt(known / drawn) + 0.01 * known


def test_segments_beyond_the_tabled_ones_change_nothing():
    last = toxicity.sum_surprise()[-1]
    assert last[0] - math.log10(toxicity.BEST_SEGMENTS * (toxicity.BEST_SEGMENTS + 1)) >= toxicity.SATURATION
    assert (np.diff(toxicity.sum_surprise(), axis=1) > 0).all()


def test_training_takes_one_text_of_a_repeated_id(spark):
    docs = spark.createDataFrame([(i % 5, prose(i, 40) + (" vile rotten vile" if i % 5 == 3 else "")) for i in range(600)],
                                 "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i == 3)) for i in range(5)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels, train_docs=5)
    assert 0 <= toxicity.judge("a thing", model)[0] <= toxicity.judge("vile rotten vile", model)[0] <= 1


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op1_toxicity"](spark, sf).drop("passages")
    labels = read_table(spark, sf, "labels")
    got = rows.join(labels, "doc_id").where("held_out").toPandas()
    a, y = got["score"].rank(), got["toxic"] == 1
    auc = (a[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())
    hit = got["predicted"] == 1
    assert auc > 0.9 and (hit & y).sum() > 0.7 * y.sum() and (hit & y).sum() > 0.8 * hit.sum()
    import zlib

    assert all(h == (zlib.crc32(str(d).encode()) % 4 == 2) for d, h in rows.select("doc_id", "held_out").limit(500).collect())


def toxic_model(spark):
    docs = spark.createDataFrame([(i, prose(i, 40) + (" vile rotten vile" if i % 3 == 0 else "")) for i in range(600)],
                                 "doc_id bigint, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    odd = spark.createDataFrame([(None, 1), (1, None), (99_999, 1)], "doc_id bigint, toxic int")
    return toxicity.train(docs, labels.unionByName(odd))


def test_toxicity_odd_rows(spark):
    model = toxic_model(spark)
    assert toxicity.judge("a vile rotten vile thing", model)[0] > 0.9 and toxicity.judge("a thing", model)[0] < 0.1
    assert toxicity.judge("VILE rotten vile w1 the", model)[1][0][:2] == (0, 3)
    rows = toxicity.score(odd_docs(spark), model).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(no_docs(spark), model).count() == 0
    kept = toxicity.keep_clean(odd_docs(spark), model)
    assert kept.columns == odd_docs(spark).columns and kept.count() == len(odd_rows())
    nothing = toxicity.train(no_docs(spark), spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert 0 <= toxicity.judge("any text", nothing)[0] < 0.3


def test_words_are_counted_by_themselves(spark):
    import zlib

    model = toxic_model(spark)
    # an unseen word that would share one of 2^18 hash buckets with a toxic one
    want = zlib.crc32(b"vile") & (1 << 18) - 1
    twin = next(w for i in range(10**7) if zlib.crc32((w := "q" + "".join(chr(97 + int(c)) for c in str(i))).encode()) & (1 << 18) - 1 == want)
    assert model.weigh("vile") > 1 and model.weigh(twin) == 0 == model.weigh("unseen")
    counted = [w for w in model.features if not w.endswith("-")]
    assert set(counted) <= {"vile", "rotten", *prose(0, 5000).split()} | {w for i in range(600) for w in toxicity.words_of(prose(i, 40))}
    toxic, clean, n = np.array([50.0, 1, 0]), np.array([0.0, 30, 0]), np.array([60.0, 90, 900])
    part = toxicity.log_odds(toxic[:2], clean[:2], n[:2], sums=(toxic.sum(), clean.sum(), (n + 0.01).sum()))
    assert np.allclose(part, toxicity.log_odds(toxic, clean, n)[:2])


def test_held_out_labels_change_nothing(spark):
    docs = read_table(spark, SF, "documents")
    labels = read_table(spark, SF, "labels")
    other = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, other)
    assert (a.weights == b.weights).all() and (a.slope, a.intercept, a.rate) == (b.slope, b.intercept, b.rate)


# --- URLs ---------------------------------------------------------------------------

PAGES = [(1, "https://WWW.Example.COM/en/12?x=/es/"), (2, "http://example.com/en/1"), (3, "http://a.example.com/en/#x"),
         (4, "https://shop.net/es/a"), (5, "https://shop.net/en/a"), (6, "https://net/fr/"), (7, "http://com"), (8, "http://com/"),
         (9, None), (10, "no scheme/en/"), (11, "x://y://z/en"), (12, "http://notexample.com/en/"), (13, "http://spam-farm.org/en/5"),
         (13, "http://spam-farm.org/en/5"), (None, "http://h.org/a?b#c"), (14, ""), (15, "http://h.org" + "/s" * 40)]


def plain_rule(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = tail[:min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
    fit = [(h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fit, key=lambda x: len(x[0]), default=None)


def test_url_rules_against_plain_version(spark):
    pages = spark.createDataFrame([(*p, "x", "y", "z") for p in PAGES],
                                  "page_id bigint, url string, host string, rule string, shape string")
    rows = urls.filter_urls(pages).collect()
    got = sorted(repr((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"] if r["rule"] else "")) for r in rows)
    want = []
    for page_id, url in PAGES:
        host, path, rule = plain_rule(url)
        want.append(repr((page_id, host, path, rule and rule[0], rule[1] if rule else "")))
    assert got == sorted(want) and {r["verdict"] for r in rows} == {"allow", "block"}
    assert urls.filter_urls(pages.limit(0)).count() == 0


def test_templates_follow_labels(spark):
    rows = [(i, f"http://h.org/news/{i}/story-{i}.html") for i in range(40)]
    rows += [(100 + i, f"http://h.org/bad/{i}") for i in range(40)] + [(200 + i, f"http://h.org/new/{i}") for i in range(9)]
    rows += [(300 + i, f"http://spam.org/{i}") for i in range(9)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    labels = spark.createDataFrame([(i, int(i >= 100)) for i in [*range(30), *range(100, 130)]], "page_id bigint, bad int")
    got = {r["page_id"]: r for r in urls.filter_urls(pages, labels).collect()}
    assert {got[i]["verdict"] for i in range(40)} == {"allow"} == {got[i]["verdict"] for i in range(200, 209)}
    assert {got[i]["verdict"] for i in range(100, 140)} == {"block"} == {got[i]["verdict"] for i in range(300, 309)}
    assert got[0]["template"].startswith("/news/") and got[200]["template"].startswith("/*/")


def test_rule_verdicts_stay_in_their_path_whatever_the_size(spark):
    for k in (1, 2, 3, 4, 5, 12, 40):
        parts = [part for part in ("es", "fr", "en", "de") for _ in range(k)]
        pages = spark.createDataFrame([(i, f"http://h.example.net/{part}/{i}") for i, part in enumerate(parts)],
                                      "page_id bigint, url string")
        got = {r["page_id"]: r["verdict"] for r in urls.filter_urls(pages).collect()}
        assert [got[i] for i in range(4 * k)] == ["block"] * 2 * k + ["allow"] * 2 * k


def test_few_labels_of_one_branch_leave_the_others(spark):
    for k in (1, 4, 5, 40):  # labelled pages of the bad branch
        rows = [(i, f"http://h.org/good/{i}") for i in range(40)] + [(100 + i, f"http://h.org/bad/{i}") for i in range(k)]
        rows += [(200 + i, f"http://h.org/few/{i}") for i in range(2)] + [(300 + i, f"http://h.org/new/{i}") for i in range(k)]
        pages = spark.createDataFrame(rows, "page_id bigint, url string")
        labels = spark.createDataFrame([(i, int(100 <= i < 200)) for i, _ in rows if i < 300], "page_id bigint, bad int")
        got = {r["page_id"]: r for r in urls.filter_urls(pages, labels).collect()}
        assert {r["verdict"] for i, r in got.items() if not 100 <= i < 200} == {"allow"}
        assert k < 5 or {got[100 + i]["verdict"] for i in range(k)} == {"block"}
        assert got[200]["template"].startswith("/few/") and got[300]["template"] == "/*/*"


def test_pages_label_themselves(spark):
    text = "<html><head>%s</head><body><!-- casino --><script>casino bets porn</script>" + "<p>word </p>" * 60 + "%s</body></html>"
    pages = [text % ("<meta name='rating' content='RTA-5042-1996-1400-RTA'>", ""), text % ('<meta name="rating" content="general">', "porn xxx casino"),
             text % ("", "Porn, XXX and casino"), text % ("", "<i>"), text % ("", "a casino"), "<p>short</p>", None]
    got = spark.createDataFrame(list(enumerate(pages)), "i int, html string").select("i", urls.page_label(F.col("html")).alias("x"))
    assert [r["x"] for r in got.orderBy("i").collect()] == [1, 0, 1, 0, None, None, None]
    html = [(i, f"http://h.org/{'a' if i < 20 else 'b'}/{i}", pages[2] if i < 20 else pages[3]) for i in range(40)]
    rows = urls.filter_urls(spark.createDataFrame(html, "page_id bigint, url string, html string")).collect()
    assert {(r["page_id"] < 20, r["verdict"]) for r in rows} == {(True, "block"), (False, "allow")}


def plain_templates(shapes):
    """(segments, bad, good) of one host's tree -> template and purity, by walking the tree."""
    out, k = {}, urls.PRIOR_URLS

    def walk(rows, level, name, b, g, prior):
        purity = (b + k * prior) / (b + g + k)
        ends = [r for r in rows if len(r[0]) == level]
        out.update({tuple(r[0]): (name, purity) for r in ends})
        groups = {}
        for seg in {r[0][level] for r in rows if len(r[0]) > level}:
            under = [r for r in rows if len(r[0]) > level and r[0][level] == seg]
            sb, sg = sum(r[1] for r in under), sum(r[2] for r in under)
            n, p = sb + sg, min(max(purity, 1e-6), 1 - 1e-6)
            alike = n >= urls.MIN_LABELLED and abs(sb / n - p) / (p * (1 - p) / n) ** 0.5 <= urls.MAX_Z
            differs = n >= urls.MIN_LABELLED and not alike
            groups.setdefault(("*" if not n else "~" if alike else seg, differs), []).extend(under)
        for (seg, differs), under in groups.items():
            sb, sg = sum(r[1] for r in under), sum(r[2] for r in under)
            rest = (b - sb + k * prior) / (b + g - sb - sg + k)  # the parent without this branch
            walk(under, level + 1, f"{name}/{seg}", sb, sg, urls.NEUTRAL if differs else rest)

    b, g = sum(r[1] for r in shapes), sum(r[2] for r in shapes)
    walk(shapes, 0, "", b, g, 0.5)
    return out


def test_url_templates_against_plain_version(spark):
    rng, hosts = random.Random(8), {}
    for h in range(6):
        paths = {tuple(rng.choice("abcd") for _ in range(rng.randint(0, 4))) for _ in range(30)}
        bad_first = rng.choice("abcd")
        hosts[f"h{h}"] = [(list(p), *((x, rng.randint(0, 1)) if p[:1] == (bad_first,) else (0, x)))
                          for p in sorted(paths) for x in [rng.choice((0, 0, 1, 7))]]
    rows = [(h, "", *r) for h, shapes in hosts.items() for r in shapes]
    got = urls.templates(spark.createDataFrame(
        rows, "host string, tree string, shape array<string>, bad bigint, good bigint")).collect()
    assert len(got) == len(rows)
    want = {h: plain_templates(shapes) for h, shapes in hosts.items()}
    for r in got:
        name, purity = want[r["host"]][tuple(r["shape"])]
        assert r["template"] == name and abs(r["purity"] - purity) < 1e-9
    # the tree, not the host alone, decides
    assert any(len({p >= urls.MIN_PURITY for _, p in w.values()}) == 2 for w in want.values())


def test_url_label_counts_once_at_every_depth(spark):
    rows = [(d, f"http://h{d}.test/" + "/".join("abcdefgh"[:d])) for d in range(8)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    labels = spark.createDataFrame([(d, 1) for d in range(8)], "page_id bigint, bad int")
    got = urls.filter_urls(pages, labels).collect()
    assert len({round(r["purity"], 9) for r in got}) == 1 and {r["verdict"] for r in got} == {"allow"}


def test_url_query(spark):
    pages = read_table(spark, SF, "pages").collect()
    rows = {r["page_id"]: r for r in QUERIES["op8_url_filter"](spark, SF).collect()}
    assert len(rows) == len(pages)
    for p in pages:
        host, path, rule = plain_rule(p["url"])
        r = rows[p["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[0])
        assert rule is None or r["verdict"] == rule[1]


# --- licenses -------------------------------------------------------------------------

def plain_matches(text):
    """Names of the templates of which some stretch of their length holds enough shingles."""
    words, found = licenses.words_of(text or ""), set()
    parts = licenses.shingles(words)
    for name, template in licenses.TEMPLATES:
        t = licenses.shingles(licenses.words_of(template))
        for s in range(max(len(parts) - len(t), 0) + 1):
            if len(set(t) & set(parts[s:s + len(t)])) >= licenses.MIN_CONTAINMENT * len(set(t)):
                found.add(name)
    return found


def test_license_matches_against_all_windows():
    r, tree = random.Random(6), licenses.groups()
    for i in range(150):
        name, template = r.choice(licenses.TEMPLATES)
        words = template.split()
        if i % 3 == 0 and len(words) > 20:
            words[r.randrange(len(words))] = "changed"
        text = prose(i, r.randint(0, 90)) + " " + " ".join(words).upper() + " " + prose(i + 1, r.randint(0, 90))
        got = licenses.matches(text, tree)
        assert {n for n, *_ in got} == plain_matches(text) and (i % 3 == 0 or name in {n for n, *_ in got})
    first = licenses.matches("x y Released under the MIT License. z", tree)
    assert first == [("MIT", 2, 7, 1.0)]


def test_license_scan_odd_rows_and_query(spark):
    rows = licenses.scan_licenses(odd_docs(spark)).collect()
    assert len(rows) == len(odd_rows()) and all(r["matches"] == [] for r in rows)
    assert licenses.scan_licenses(no_docs(spark)).count() == 0
    docs = {d["doc_id"]: d["text"] for d in read_table(spark, SF, "documents").collect()}
    got = {r["doc_id"]: r["licenses"] for r in QUERIES["op9_licenses"](spark, SF).collect()}
    assert got == {i: ",".join(sorted(plain_matches(t))) for i, t in docs.items()}


# --- pipeline --------------------------------------------------------------------------

@pytest.fixture(scope="module")
def stages(spark):
    from liqspark.llm.common import stored

    docs, out = read_table(spark, SF, "documents"), []
    for _, f in corpus_pipeline.STAGES:
        out.append((docs, docs := stored(f(spark, docs, SF), "stage")))
    return out


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_stage_names_and_columns(spark, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    columns = read_table(spark, SF, "documents").columns
    assert all(after.columns == columns for _, after in stages[:-1])


def test_toxicity_stage(spark, stages):
    before, after = stages[0]
    model = toxicity.train(before, read_table(spark, SF, "labels"))
    assert rows_of(after) == sorted(tuple(d) for d in before.collect() if toxicity.judge(d["text"], model)[0] < 0.3)


def test_near_duplicate_stage(stages):
    before, after = stages[1]
    docs = sorted(before.collect(), key=lambda d: d["doc_id"])
    root = groups_within([simhash(d["text"]) for d in docs], within_bits(2))
    assert rows_of(after) == sorted(tuple(d) for i, d in enumerate(docs) if root[i] == i)


def test_decontamination_stage(spark, stages):
    before, after = stages[2]
    items = [(r["item_id"], r["text"]) for r in read_table(spark, SF, "benchmark").collect()]
    assert rows_of(after) == sorted(tuple(d) for d in before.collect() if not hits(d["text"], items)[1])


def test_secret_stage(stages):
    before, after = stages[3]
    enc, was = secrets._encoding(vocabulary("byte_bpe_50k.tiktoken")), {d["doc_id"]: d for d in before.collect()}
    for d in after.collect():
        old = was.pop(d["doc_id"])
        spans = secrets.secret_spans(old["text"], enc)
        keep = [c for i, c in enumerate(old["text"]) if not any(s <= i < e for _, s, e in spans)]
        assert d["text"].replace("[SECRET]", "") == "".join(keep) if spans else d["text"] == old["text"]
        assert d["n_chars"] == (len(d["text"]) if spans else old["n_chars"])
    assert not was


def test_packing_stage(stages):
    before, after = stages[4]
    check_packed(after.collect(), before.collect())
