import collections
import hashlib
import itertools
import math
import random
import re
import time
import tracemalloc
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinspark.llm import chat, decontaminate, html, langid, mixing, quality, rules, toxicity, urls

DOCS = "doc_id long, text string, lang string, source string, score string"
ODD = [(1, None, None, None, "x"), (2, "", "en", "a", "x"), (2, "", "en", "a", "x"), (3, "w " * 30000, None, "a", "x"), (None, "\t\n", "en", "b", "x"), (5, "one two", "fr", None, "x")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS).repartition(2)


@pytest.fixture(scope="module")
def tables(spark, sf):
    return {t: spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels", "pages", "benchmark", "conversations")}


# ------------------------------------------------------------------ op2, op6, op7
def test_models_learn_and_take_odd_rows(spark, tables, odd):
    docs, labels = tables["documents"], tables["labels"]
    for got in (quality.op2_quality(docs, labels), toxicity.op7_toxicity(docs, labels)):
        rows = got.collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    q = quality.classify(odd, quality.fit(docs, labels)).collect()
    t = toxicity.classify(odd, toxicity.fit(docs, labels)).collect()
    assert len(q) == len(t) == len(ODD) and all(r.predicted in (0, 1) for r in q + t)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.op2_quality(odd, none).collect()} == {0.5}
    assert max(r.score for r in toxicity.op7_toxicity(odd, none).collect()) < 0.01
    assert quality.op2_quality(docs.limit(0), labels).count() == 0


def test_quality_table_scores_as_the_mean_of_vectors():
    rows = [("good words here", 1), ("b@d $$$ junk", 0)] * 20
    m = quality.train(rows)
    good, bad, empty = m.scores(["good words here", "b@d $$$ junk", ""])
    assert good > 0.5 > bad and empty == pytest.approx(1 / (1 + math.exp(-m.bias)))
    assert m.scores(["x" * 5, "good words here"])[1] == pytest.approx(good)


def test_toxicity_trains_holding_little():
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(5000)]
    parts = toxicity._Sentences([[rng.sample(words, 30)] for _ in range(3000)])
    landmarks = toxicity.Landmarks(words[:8])
    half = np.random.default_rng(2).normal(size=(8, 200)).astype(np.float32)
    pick = np.arange(len(parts.owner))[::-1]
    tracemalloc.start()
    x = parts.features(pick, landmarks, half)
    # the features of the words and of the sentences, 4 and 2.4 MB, and a part of what they are made of, which is 72 MB
    assert tracemalloc.get_traced_memory()[1] < 30e6
    tracemalloc.reset_peak()
    held = tracemalloc.get_traced_memory()[0]
    y = np.where(x[:, 0] > np.median(x[:, 0]), 1.0, -1.0)
    weights, bias = toxicity.svm(np.tile(x, (8, 1)), np.tile(y, 8), np.ones(8 * len(y)), rounds=3)
    # 8 times the features, 19 MB, and less than another copy of them
    assert tracemalloc.get_traced_memory()[1] - held < 19.2e6 + 15e6
    tracemalloc.stop()
    by_word = landmarks.kernel(parts.names) @ half
    for row, i in list(zip(x, pick))[::500]:
        ids = parts.flat[parts.bounds[i] : parts.bounds[i + 1]]
        assert np.allclose(row, by_word[ids].sum(axis=0), rtol=1e-3, atol=1e-4)
    assert np.mean(np.sign(x @ weights + bias) == y) > 0.9


def test_toxicity_runs_as_its_plain_margin_and_bears_gaps():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(2, 8)))
    clean = [(" ".join(word() for _ in range(30)) + ".", 0) for _ in range(120)]
    toxic = [(" ".join([*(word() for _ in range(12)), rng.choice(["grobnik", "vashtuk"]), *(word() for _ in range(6))]) + ".", 1) for _ in range(120)]
    m = toxicity.train(clean + toxic)
    texts = ["a b c d e", "you grobnik!\nfine day", "g r o b n i k", "", "tha thb " * 100, *[t for t, _ in clean[:20]]]
    texts += ["idle idle, IDLE. a", "x y z " * 30 + "word " * 60, "one。two！ three", "aб я в г " * 20]
    for text, got in zip(texts, m.describe(texts), strict=True):
        sums = sorted(m.plain_sums(text), reverse=True)
        want = [m.bias + x for x in [*sums, 0.0, 0.0, 0.0][: toxicity.TOP]]
        assert got.tolist() == pytest.approx([*want, math.log1p(len(sums))], abs=1e-4)
    score = dict(zip(["grobnik", "g.r.o.b.n.i.k", "grobxnik", "vashtuuk", "plain words"], m.scores(["you grobnik", "you g.r.o.b.n.i.k", "you grobxnik", "you vashtuuk", "plain words"]), strict=True))
    assert min(score["grobnik"], score["g.r.o.b.n.i.k"]) > 0.5 > score["plain words"] and score["grobxnik"] > score["plain words"] and score["vashtuuk"] > score["plain words"]


def test_language_mixtures(spark, odd):
    words = {"aa": "kalo mira teno savu rilo".split(), "bb": "dreth wusk plim gorth snaff".split()}
    rng = random.Random(1)
    say = lambda k, n: " ".join(rng.choice(words[k]) for _ in range(n))
    m = langid.train([(say(k, 40), k) for k in words for _ in range(30)])
    one, both, und = m.infer([say("aa", 50), say("aa", 40) + " " + say("bb", 60), "12 ... 3"])
    assert one[0] == "aa" and one[2] == [{"lang": "aa", "share": 1.0}]
    assert both[0] == "bb" and both[1] == pytest.approx(0.6, abs=0.03) and len(both[2]) == 2
    assert und == ("und", 0.0, [])
    got = {(r.doc_id, r.lang_pred) for r in langid.op6_langid(odd).collect()}
    assert (1, "und") in got and (2, "und") in got and (None, "und") in got
    assert langid.op6_langid(odd.limit(0)).count() == 0


def test_a_token_is_described_by_all_its_subsequences():
    def plain(token):
        sym = [toxicity.EDGE, *(toxicity._symbols([c])[0][1] for c in token), toxicity.EDGE]
        found, norm = collections.defaultdict(float), 0.0
        for size, into in ((len(sym), True), (min(len(sym), toxicity.NORMED), False)):
            for pick in itertools.combinations(range(size), toxicity.LENGTH) if size < 40 else ():
                if pick[-1] - pick[0] < toxicity.SPAN:
                    w = toxicity.DECAY ** (pick[-1] - pick[0] - toxicity.LENGTH + 1)
                    if into:
                        found[tuple(sym[p] for p in pick)] += w
                    else:
                        norm += w * w
        return {k: v / norm**0.5 for k, v in found.items()}

    tokens = ["a", "ab", "idiot", "idxiot", "дурак", "дудак", "abc" * 10, "naïve7"]
    marks = toxicity.Landmarks(tokens)
    described = [plain(t) for t in tokens]
    want = [[sum(v * b.get(k, 0) for k, v in a.items()) for b in described] for a in described]
    assert marks.kernel(tokens) == pytest.approx(np.array(want), abs=1e-4)
    assert want[2][3] > 0.2 and abs(want[4][4] - want[4][5]) > 0.2  # gaps are borne, words of other scripts differ
    model = toxicity.Model(np.ones(toxicity.SYMBOLS**toxicity.LENGTH, np.float32), 0.0, np.zeros(4), 0.0)
    assert model.token_scores(["x" * 200_000, "字" * 50_000]).shape == (2,)


def test_quality_scores_as_plain_python():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    texts = [" ".join(word() for _ in range(rng.randint(1, 30))) for _ in range(40)] + ["", " ", "A\tb\n\nC", "one"]
    m = quality.train([(t, i % 2) for i, t in enumerate(texts[:40])])
    one = lambda x, kind: int(quality.bucket(np.array([x], np.uint64), quality.BITS, kind)[0])
    big = 2**64

    def gram(codes):  # the polynomial of Layout.grams
        h = codes[0]
        for c in codes[1:]:
            h = (h * 0x9E3779B97F4A7C15 + c) % big
        return h

    def whole(codes):  # that of Layout.word_hashes
        return sum((c + 1) * pow(0x9E3779B97F4A7C15, k, big) for k, c in enumerate(codes)) % big

    for text, got in zip(texts, m.scores(texts), strict=True):
        codes = [ord(c) for c in text.lower()]
        found = [one(gram(codes[i : i + n]), n) for n in quality.CHAR_NGRAMS for i in range(len(codes) - n + 1)]
        words = [whole([ord(c) for c in w]) for w in re.findall(r"[^\x20\x09-\x0D]+", text.lower())]
        found += [one(w, 101) for w in words] + [one((a * 0xA0761D6478BD642F + b) % big, 102) for a, b in itertools.pairwise(words)]
        z = m.bias + (sum(float(m.table[f]) for f in found) / len(found) if found else 0.0)
        assert got == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-4)


def plain_mixture(logs):
    """Shares by expectation maximisation, and the set of best penalised likelihood, one document in plain Python."""
    langs, n = len(logs[0]), len(logs)

    def fit(allowed):
        share = [1 / len(allowed) if k in allowed else 0.0 for k in range(langs)]
        for _ in range(langid.MOST_ROUNDS):
            new = [0.0] * langs
            for row in logs:
                part = [s * math.exp(x - max(row)) for s, x in zip(share, row, strict=True)]
                for k in range(langs):
                    new[k] += part[k] / sum(part) / n
            moved, share = max(abs(a - b) for a, b in zip(new, share, strict=True)), new
            if moved <= langid.TOLERANCE:
                break
        return share, sum(math.log(sum(s * math.exp(x - max(row)) for s, x in zip(share, row, strict=True))) for row in logs)

    alone = [sum(row[k] - max(row) for row in logs) for k in range(langs)]
    best = max(range(langs), key=lambda k: (alone[k], -k))
    found = alone[best], {best}, [float(k == best) for k in range(langs)]
    full, _ = fit(set(range(langs)))
    order = sorted(range(langs), key=lambda k: (-full[k], k))
    for size in range(2, langs + 1):
        share, likelihood = fit(set(order[:size]))
        value = likelihood - (size - 1) * 0.5 * math.log(max(2, n))
        if value <= found[0] + 1e-9:
            break
        found = value, set(order[:size]), share
    return found[1], found[2]


def test_language_shares_are_those_of_plain_em():
    rng = np.random.default_rng(7)
    docs = []
    for mix in ([1, 0, 0, 0], [0.5, 0.5, 0, 0], [0.3, 0.3, 0.4, 0], [0.25] * 4, [0.9, 0.1, 0, 0], [0, 0, 1, 0]):
        for n in (1, 5, 60):
            true = rng.choice(4, n, p=mix)
            docs.append(rng.normal(-6, 1, (n, 4)) + 4 * np.eye(4)[true])
    docs.append(np.zeros((0, 4)))
    bounds = np.r_[0, np.cumsum([len(d) for d in docs])]
    share, own = langid.mixtures(np.concatenate(docs).astype(np.float32), bounds)
    for d, s, o in zip(docs, share, own, strict=True):
        if len(d):
            chosen, want = plain_mixture(d.astype(np.float32).astype(float).tolist())
            assert set(np.flatnonzero(o).tolist()) == chosen and s.tolist() == pytest.approx(want, abs=1e-4)


# ---------------------------------------------------------------------------- op3
def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    places = collections.defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i : i + 8])].append(i)
    covered = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_rules_measure_as_plain_python(spark, tables, odd):
    extra = [(100, "a b c d e f g h i " * 3, "en"), (101, "x\n\nx\n y\ny\x0b\n", "en"), (102, "q " * 9, "fr"), (103, " a b c", None)]
    docs = tables["documents"].select("doc_id", "text", "lang").unionByName(spark.createDataFrame(extra, "doc_id long, text string, lang string")).unionByName(odd.select("doc_id", "text", "lang"))
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rules.op3_rules(docs, tables["labels"]).collect())
    want = sorted((str(d), *(m := plain_measures(t)), m[0] < 20 or 100 * m[4] > 30 * m[0]) for d, t in texts)
    assert got == want


def test_binomial_tail_and_certified_cutoffs(spark):
    exact = lambda k, n, p: sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    for k, n in [(0, 300), (2, 400), (3, 1000)]:
        row = spark.range(1).select(rules.binomial_cdf(F.lit(k).cast("long"), F.lit(n).cast("long"), 0.02).alias("x")).first()
        assert row.x == pytest.approx(exact(k, n, 0.02), rel=1e-9)
    rows = [(i, "good plain words follow one another here " * 1 + " ".join(f"w{i}x{k}" for k in range(30)), "en") for i in range(3000)]
    junk = [(5000 + i, " ".join(f"w{i}x{k}$$$" for k in range(30)), "en") for i in range(50)]
    docs = spark.createDataFrame(rows + junk, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(3000)] + [(5000 + i, 0) for i in range(50)], "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in rules.op3_rules(docs, labels).collect()}
    assert all(kept[i] for i in range(3000)) and not any(kept[5000 + i] for i in range(50))
    assert all(r.kept for r in rules.op3_rules(docs, labels.limit(0)).collect())  # nothing certified, nothing lost


def plain_cutoffs(rows):
    """(stratum, severity, label) of documents beyond the base rules -> stratum -> cutoff."""
    cdf = lambda k, n: sum(math.comb(n, i) * rules.ALPHA**i * (1 - rules.ALPHA) ** (n - i) for i in range(k + 1))
    strata = collections.defaultdict(list)
    for s, x, y in rows:
        strata[s].append((x, y))
    out = {}
    for s, own in strata.items():
        good, bad = [x for x, y in own if y == 1], [x for x, y in own if y != 1]
        best = None
        for f in rules.FACTORS:
            k, b = sum(x > f for x in good), sum(x > f for x in bad)
            if k > rules.ALPHA * len(good) or cdf(k, len(good)) > rules.DELTA / len(strata):
                break
            parted = b / max(1, len(bad)) - k / max(1, len(good))
            if best is None or parted > best[0]:
                best = parted, f
        out[s] = best and best[1]
    return out


def plain_severity(text):
    n, chars, symbols, dup, repeat = plain_measures(text)
    text, lines = text or "", [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    upper = sum(unicodedata.category(c) == "Lu" for c in text)
    u = rules.UNITS
    return max(symbols / max(1, n) / u["symbols_per_word"], dup / max(1, len(lines)) / u["dup_line_share"], repeat / max(1, n) / u["repeat_share"], upper / max(1, chars) / u["upper_share"], chars / max(1, n) / u["mean_word"])


def test_rules_keep_as_plain_python(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: (r.text, r.lang) for r in docs.collect()}
    label = collections.defaultdict(int)
    for r in labels.collect():
        if r.quality is not None and zlib.crc32(str(r.doc_id).encode()) % 5:
            label[r.doc_id] = max(label[r.doc_id], r.quality)
    measured = {d: (plain_measures(t), plain_severity(t), x) for d, (t, x) in texts.items()}
    base = {d: m[0] < 20 or 100 * m[4] > 30 * m[0] for d, (m, _, _) in measured.items()}
    cuts = plain_cutoffs([(measured[d][2], measured[d][1], y) for d, y in label.items() if d in texts and not base[d]])
    want = {d: not base[d] and not (cuts.get(x) is not None and sev > cuts[x]) for d, (_, sev, x) in measured.items()}
    got = {r.doc_id: (r.base_failed, r.kept) for r in rules.op3_rules(docs, labels).collect()}
    assert got == {d: (base[d], want[d]) for d in texts}
    assert sum(want.values()) < sum(not x for x in base.values())  # the method rejects some beyond the base rules


# ---------------------------------------------------------------------------- op4
def test_url_trie_is_the_longest_rule(spark):
    rng = random.Random(2)
    hosts = ["com", "example.com", "a.example.com", "example.net", "net", "org", "badexample.com", ""]
    rs = [urls.Rule(rng.choice(["allow", "block"]), rng.choice(hosts[:6]), p) for p in ["/en/", "/en/7", "/de/8", "/", "/en/7/x", ""] for _ in range(3)]
    rs = list({(r.host, r.path): r for r in rs}.values())
    pages = [(f"http://{h.upper()}{p}{q}",) for h in hosts for p in ["", "/en/", "/en/71", "/en/7/xy/z", "/de/8?a", "/de/"] for q in ["", "?x=/en/7", "#t"]] + [(None,), ("no scheme/en/",), ("http://",)]
    got = urls.filter_urls(spark.createDataFrame(pages, "url string"), rs, most=40).collect()
    for r in got:
        rest = r.url.split("://", 1)[1] if r.url and "://" in r.url else ""
        host = re.match(r"[^/?#]*", rest)[0].lower()
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        fits = [x for x in rs if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fits, key=lambda x: (x.host.count("."), len(x.path)), default=None)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best and str(best), best.action if best else "allow")


# ---------------------------------------------------------------------------- op5
def test_main_text():
    page = """<html><head><title>No</title><script>x='</p>'</script></head><body><header>Site</header><nav><a href=x>Menu</a></nav><div class="cookie-notice">We use</div>
    <article><header><h1>Head &amp; line</h1></header><p><b>One  two<br>three<p>Four<ul><li>five<li>six</ul><div class="ad">Buy</div><aside>side</aside><form>f<input></form></article>
    <div class="comments"><article class="comment">Nice</article></div><footer>&copy; me</footer></body></html>"""
    assert html.main_text(page, set(), None) == "Head & line\nOne two three\nFour\nfive\nsix"
    assert html.main_text(None, set(), None) == html.main_text("", set(), None) == ""


def test_template_of_a_host_without_articles(spark):
    body = lambda i: f"<body><div id=top><p>Welcome to our site</p></div><div id=text><p>Story {i} begins here and it is long enough</p><p>It ends as number {i}.</p></div><div id=low><p>All rights kept</p></div></body>"
    rows = [(i, f"http://h.example/{i}", body(i)) for i in range(12)] + [(50, None, None), (50, None, None), (51, "http://o.example", "<p>a</p>")]
    got = {r.page_id: r for r in html.op5_html(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3].text == "Story 3 begins here and it is long enough\nIt ends as number 3." and got[3].n_chars == len(got[3].text)
    assert got[50].text == "" and got[51].text == "a" and len(got) == 14


def test_a_page_without_marks_is_read_by_its_template(spark):
    say = lambda i, k: f"Part {k} of story {i} goes on for a while"
    body = lambda i: f"<body><div class=bar><p>Menu {i % 4} {i}</p></div><div class=body><h2>Title {i}</h2><p>{say(i, 1)}</p><div class=box><p>Offer {i}</p></div><p>{say(i, 2)}</p><p>Send us your views</p></div><div class=low><p>Visitor {i}</p></div></body>"
    rows = [(i, f"http://h.example/{i}", body(i)) for i in range(20)]
    got = {r.page_id: r.text for r in html.op5_html(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    # what is around the slot of most text, without fixed texts; the bars beside it vary as well and are left out
    assert got[3] == f"Title 3\n{say(3, 1)}\nOffer 3\n{say(3, 2)}"
    # repeated rows count once and are read alike
    twice = html.op5_html(spark.createDataFrame(rows + rows, "page_id long, url string, html string")).collect()
    assert len(twice) == 40 and {(r.page_id, r.text) for r in twice} == set(got.items())


def test_classes_are_those_of_plain_counting(spark):
    rng = random.Random(9)
    part = lambda: rng.choice(["<p>fixed a</p>", "<p>fixed b</p>", "<div class=q><p>x{}</p></div>", "<ul><li>one<li>two</ul>", ""])
    rows = [(i, f"http://h{i % 2}.example/", "<body><header>h</header>" + "".join(part() for _ in range(4)).replace("{}", str(i)) + "<p>same end</p></body>") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = html.templates(pages.select(html.parts_of(F.col("url"))[0].alias("host"), F.xxhash64("html").alias("page"), "html")).collect()
    for host in ("h0.example", "h1.example"):
        own = sorted({r[2] for r in rows if html.re.sub(r".*//|/", "", r[1]) == host})
        counts = [html.tokens_of(html.read_page(x)) for x in own]
        vectors = collections.defaultdict(list)
        for t in set().union(*counts):
            v = tuple(c[t] for c in counts)
            if sum(x > 0 for x in v) >= max(html.SUPPORT * len(own), 3):
                vectors[v].append(t)
        classes = [{"class": k, "pages": sum(x > 0 for x in v), "size": len(ts), "tokens": ts} for k, (v, ts) in enumerate(sorted(vectors.items())) if len(ts) > 1]
        of = {t: c["class"] for c in classes for t in c["tokens"]}
        how = collections.defaultdict(set)
        for x in own:
            for a, b, y in html.relations(html.read_page(x), of):
                how[a, b].add(y)
        fits = {(a, b) for (a, b), y in how.items() if len(y) == 1 and (min(y) != 0 if a == b else min(y) >= 0)}
        taken = html.nested(classes, fits)
        want = sorted(t for c in classes if c["class"] in taken for t in c["tokens"])
        first = max((c for c in classes if c["class"] in taken), key=lambda c: (c["pages"], c["size"]))
        assert first["pages"] == len(own) and html.token("text", 0, "") not in want
        assert [sorted(r.boilerplate) for r in found if r.host == host] == [want]


def test_any_page_is_read_in_time_by_its_length():
    began = time.perf_counter()
    for page in ("<a " * 60_000, '<a "' * 40_000, "<a '" * 40_001, "<!" * 60_000, "<div>" * 20_000 + "x" + "</p>" * 20_000, "<p>" * 30_000, "<li><td>" * 20_000, "<div><p>a" * 20_000, "a<b " * 40_000 + ">"):
        html.main_text(page, set(), None)
    assert time.perf_counter() - began < 20


def test_template_holds_for_articles(spark):
    body = lambda i: f"<body><article><p>Read on our site</p><p>Story {i} begins.</p><p>It ends as {i}.</p><p>Send us your views</p></article></body>"
    rows = [(i, f"http://h.example/{i}", body(i)) for i in range(12)] + [(i, f"http://o.example/{i}", body(7)) for i in range(12)]
    got = {r.url: r.text for r in html.op5_html(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got["http://h.example/3"] == "Story 3 begins.\nIt ends as 3."
    assert got["http://o.example/3"].startswith("Read on our site\nStory 7")  # one page in copies shows no template


def test_template_is_in_order_and_nested(spark):
    texts = lambda i: ["x", "y"] if i % 2 else ["y", "x"]
    body = lambda i: "<body>" + "".join(f"<p>{t}</p>" for t in [*texts(i), f"a{i}"]) + "</body>"
    rows = [(i, f"http://h.example/{i}", body(i)) for i in range(12)]
    got = {r.page_id: r.text for r in html.op5_html(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "x\ny\na3" and got[4] == "y\nx\na4"  # tokens without one order are no template
    of = {html.token("p", t): k for k, ts in ((1, "ad"), (2, "bc")) for t in ts}
    how = lambda s: {(a, b): x for a, b, x in html.relations([html.Event(html.token("p", t), 0) for t in s], of)}
    assert how("abxcd")[1, 2] == 1 and how("abxcd")[2, 1] == -1 and how("abdc")[1, 2] == -1 and how("adbcad")[1, 2] == 0 and how("abcadd")[1, 1] == 0
    c = [{"class": 1, "pages": 9, "size": 2}, {"class": 2, "pages": 8, "size": 2}]
    assert html.nested(c, {(1, 1), (2, 2), (1, 2)}) == [1, 2] and html.nested(c, {(1, 1), (2, 2)}) == [1]


# ---------------------------------------------------------------------------- op8
def test_chat_round_trip(spark, tables):
    got = {r.conv_id: r for r in chat.op8_chat(tables["conversations"]).collect()}
    by = collections.defaultdict(list)
    for r in tables["conversations"].collect():
        by[r.conv_id].append((r.turn, r.role, r.text or ""))
    by[-1] = chat.ADDED and [(t, r, x) for _, t, r, x in chat.ADDED]
    assert got.keys() == by.keys()
    for k, turns in by.items():
        turns.sort()
        said = "".join(x for _, r, x in turns if r == "assistant")
        assert got[k].n_turns == len(turns) and got[k].loss_chars == len(said) and got[k].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert got[k].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
    odd = spark.createDataFrame([(None, 0, None, None), (None, 0, "user", "a"), (7, None, "assistant", chat.ESC + "0<|end|>\n")], "conv_id long, turn long, role string, text string")
    assert {r.conv_id: r.n_turns for r in chat.op8_chat(odd).collect()} == {None: 2, 7: 1, -1: 2}


def test_typed_parts():
    f = chat.format_turns([("user", '[{"type": "text", "text": "<|image:0|>"}, {"type": "image", "ref": "a.png", "width": 28, "height": 28}, {"type": "document", "ref": "d.pdf", "pages": 2}]')], typed=True)
    assert f.attachments == [("<|image:0|>", "image", "a.png", 4), ("<|document:1|>", "document", "d.pdf", 1600)] and f.text.count("<|image:0|>") == 1


@pytest.mark.parametrize(
    "content, text, attached",
    [
        ("{not json", "{not json", []), ("[" * 5000, "[" * 5000, []), ('{"type": "text"}', '{"type": "text"}', []), ("null", "null", []), (None, "", []), ("", "", []),
        ('["a", 3, null, {"type": "video", "x": 1}, {"type": ["image"]}]', 'a3null{"type": "video", "x": 1}{"type": ["image"]}', []),
        ('[{"type": "image"}, {"type": "audio", "ref": 5, "seconds": "x"}, {"type": "document", "ref": null, "pages": -3}, {"type": "text"}]', None, [("image", "", 1), ("audio", "5", 1), ("document", "", 1)]),
        ('[{"type": "image", "ref": "r", "width": 1e400, "height": 2}, {"type": "audio", "ref": "s", "seconds": 1.5}]', None, [("image", "r", 1), ("audio", "s", 38)]),
    ],
)
def test_odd_parts_are_text(content, text, attached):
    f = chat.format_turns([("user", content)], typed=True)
    assert [a[1:] for a in f.attachments] == attached
    if text is not None:
        assert chat.read_back(f.text) == [("user", text)]


# ---------------------------------------------------------------------------- op9
def plain_tiles(doc, item, least):
    """Greedy string tiling by trying every pair of places."""
    a, b, covered = [False] * len(doc), [False] * len(item), 0
    while True:
        best = (least - 1, 0, 0)
        for j in range(len(item)):
            for i in range(len(doc)):
                k = 0
                while i + k < len(doc) and j + k < len(item) and not a[i + k] and not b[j + k] and doc[i + k] == item[j + k]:
                    k += 1
                if (k, -j, -i) > (best[0], -best[1], -best[2]) and k > best[0]:
                    best = (k, j, i)
        if best[0] < least:
            return covered
        k, j, i = best
        a[i : i + k], b[j : j + k], covered = [True] * k, [True] * k, covered + k


def test_tiling_is_the_plain_one(spark, odd):
    rng = random.Random(4)
    items = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(3, 30)))) for i in range(25)] + [(90, ""), (91, None), (92, "solo pair")]
    docs = []
    for _ in range(30):
        cut = items[rng.randrange(25)][1].split()
        k = rng.randrange(len(cut) + 1)
        docs.append(" ".join([rng.choice("abcdxyz") for _ in range(20)] + cut[k:] + ["zz"] + cut[:k]) + " Solo, PAIR!")
    bench = decontaminate.Benchmark(items)
    for text, found in zip(docs, bench.find(docs), strict=True):
        w = decontaminate.words_of(text)
        want = {}
        for i, t in items:
            own = decontaminate.words_of(t)
            if own and (c := plain_tiles(w, own, min(5, len(own))) / len(own)) >= 0.5:
                want[i] = pytest.approx(c)
        assert {f["item_id"]: f["coverage"] for f in found} == want
    # texts that repeat themselves: as many tokens marked, and no work by the product of their lengths
    for text, item in (("a b " * 40, "a b " * 9 + "a"), ("a " * 60, "a " * 25), ("a a b " * 20, "a b a " * 10)):
        w, own = decontaminate.words_of(text), decontaminate.words_of(item)
        number = {x: n + 1 for n, x in enumerate("ab")}
        got = decontaminate.tile(*(np.array([number[x] for x in t], np.uint64) for t in (w, own)), 5)
        assert sum(t.length for t in got) == plain_tiles(w, own, 5)
    long = decontaminate.Benchmark([(1, "w " * 3000), (2, "w v " * 1500)]).find(["w " * 30000, "v w " * 30000])
    assert [[f["item_id"] for f in x] for x in long] == [[1], [2]]
    b = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.op9_decontamination(odd, b).count() == 0
    assert decontaminate.contaminated(odd, b.limit(0)).where(F.size("contamination") > 0).count() == 0
    d = spark.createDataFrame(enumerate(docs), "doc_id long, text string")
    many = decontaminate.contaminated(d, b, most=60)  # several blocks
    assert {r.doc_id: sorted(c.item_id for c in r.contamination) for r in many.collect()} == {k: sorted(f["item_id"] for f in x) for k, x in enumerate(bench.find(docs))}


# --------------------------------------------------------------------------- op10
def plain_targets(sizes):
    weight = {s: (i % 3) + 1 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    capped, total = {}, sum(sizes.values())
    while True:
        free = [s for s in sizes if s not in capped]
        level = (total - sum(capped.values())) / max(1, sum(weight[s] for s in free))
        over = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not over:
            return capped | {s: level * weight[s] for s in free}
        capped |= {s: 3 * sizes[s] for s in over}


def test_mixture(spark, odd):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randint(0, 40), "en", rng.choice(["a"] * 6 + ["b", "c", None]), "x") for i in range(3000)] + [(9000, "w w", "en", "d", "x"), (9001, "", "en", "e", "x")]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.op10_mixing(docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.op10_mixing(docs.repartition(5)).collect()))
    source = {r[0]: r[3] for r in rows}
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in got:
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.size * r.copies
    assert target == pytest.approx(plain_targets(sizes)) and len(got) == len(rows)
    assert all(abs(taken[s] - target[s]) <= 40 for s in target)
    mixed = mixing.mixture(docs).collect()
    assert len(mixed) == sum(r.copies for r in got)
    again = {(r.doc_id, r.copy): (r.shard, r.position) for r in mixing.mixture(docs.repartition(3)).collect()}
    assert again == {(r.doc_id, r.copy): (r.shard, r.position) for r in mixed}
    # the rows of a shard come together, in the order of their position
    order = [(r.shard, r.position) for r in mixed]
    runs = [list(g) for _, g in itertools.groupby(order, key=lambda x: x[0])]
    assert len(runs) == len({s for s, _ in order}) and all(g == sorted(g) for g in runs)
    clashing = docs.limit(200).withColumns({c: F.lit(7) for c in ("shard", "copy", "__sid", "size", "__h", "target", "__block")})
    out = mixing.mixture(clashing)
    assert out.columns == [*docs.columns, "__sid", "size", "__h", "target", "__block", "shard", "copy", "position"] and {r["__sid"] for r in out.collect()} == {7}
    deep = mixing.mixture(docs, depth=8).collect()
    assert len(deep) == len(mixed) and max(r.shard for r in deep) >= 64
    assert mixing.op10_mixing(odd).count() == len(ODD) and mixing.op10_mixing(odd.limit(0)).count() == 0


def test_hypergeometric_draws(spark):
    n, k, m = 60, 22, 30
    u = [(i + 0.5) / 4000 for i in range(4000)]
    df = spark.createDataFrame([(x,) for x in u], "u double").select(mixing.hypergeometric(*(F.lit(x).cast("long") for x in (n, k, m)), F.col("u")).alias("x"))
    got = collections.Counter(r.x for r in df.collect())
    for x in range(5, 18):
        exact = math.comb(k, x) * math.comb(n - k, m - x) / math.comb(n, m)
        assert got[x] / 4000 == pytest.approx(exact, abs=1 / 1000)


def test_split_meets_every_quota(spark):
    quotas = [0, 1, 7, 500, 12_345]
    leaves = mixing.split(spark.createDataFrame([(quotas,)], "counts array<bigint>"), depth=4).collect()
    assert len(leaves) == 16 and [sum(x) for x in zip(*(r.counts for r in leaves), strict=True)] == quotas
    totals = [sum(r.counts) for r in leaves]
    assert max(totals) - min(totals) <= 4 and all(c >= 0 for r in leaves for c in r.counts)
    assert np.std([r.counts[4] for r in leaves]) < 20
