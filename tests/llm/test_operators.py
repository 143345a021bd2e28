"""Training-data operators: edge cases, and results against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tsengine.llm import (decontaminate, html_text, kneser_ney, language_id, near_dup, piece_sampling,
                          private_spans, queries, token_counts, topk, url_filter)

SF = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, lang string, source string, n_chars long, key string, n long, spans string"


def words(text):
    return [re.sub("[A-Z]+", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, long and repeated texts, a repeated row, clashing columns."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [(0, None, None, None), (1, "", "en", "a"), (2, "One", "en", "a"), (3, long, "en", None),
            (4, long + " tail", None, "a"), (None, "null id text", "en", "a"), (None, None, None, None),
            (5, "same text here again and again", "en", "a"), (6, "SAME text  here\nagain and again", "xx", "b"),
            (5, "same text here again and again", "en", "a"), (7, "\n \t", "en", "a"), (8, "ünïcode ▁ 日本 😀 x", "de", "c")]
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), "k", 1, "z") for i, t, lang, s in rows], ODD)


def shingles(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute_components(docs, k, percent=80):
    sets = {i: shingles(t, k) for i, t in docs}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if b < a and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(n=60, seed=3):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(400)}" for _ in range(120)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rnd.randrange(0, 14)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
        out.append((i, " ".join(w)))
    return out + [(n + i, " ".join(f"u{rnd.randrange(10**6)}" for _ in range(30))) for i in range(20)]


@pytest.mark.parametrize("chunk", [2_000, 7])
def test_near_duplicates_match_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(near_dup, "CHUNK_NODES", chunk)
    docs = near_copies()
    got = near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(docs, 2)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_edges(spark, odd):
    got = near_dup.near_duplicates(odd, k=2).collect()
    assert len(got) == odd.count()
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append((r.n_shingles, r.component_id, r.kept))
    assert by[0] == [(0, 0, True)] and by[1] == [(0, 1, True)] and by[7] == [(0, 7, True)]
    assert by[4][0][1] == 3 and by[6] == [(5, 5, False)] and by[5] == [(5, 5, True)] * 2
    assert sorted(by[None]) == [(0, None, True), (2, None, True)]
    assert near_dup.near_duplicates(odd.limit(0)).count() == 0


def test_posterior_bounds_grow_and_keep_true_pairs():
    steps = near_dup.least_matches(192, 0.8, 1e-6)
    assert steps[-1][0] == 192 and all(a[1] < b[1] for a, b in zip(steps, steps[1:]))
    assert all(m / n < 0.8 for n, m in steps)


def test_decontamination_matches_brute_force(spark):
    rnd = random.Random(5)
    word = lambda: f"w{rnd.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([3, 5, 16, 24, 24, 59])] + [(90, None), (91, "")]
    docs = []
    for i in range(60):
        w = [word() for _ in range(rnd.randrange(0, 120))]
        if i % 2:
            leak = items[rnd.randrange(6)][1].split()
            if i % 3 == 0 and len(leak) > 20:
                leak[1 if i % 4 else len(leak) // 2] = "changed"
            at = rnd.randrange(len(w) + 1)
            w[at:at] = leak
        docs.append((i, " ".join(w)))
    docs += [(100, None), (None, items[3][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    truth = set()
    for i, t in docs:
        w = words(t)
        for item, text in items:
            m = words(text)
            k = min(5, len(m))
            bag = collections.Counter(tuple(m[j:j + k]) for j in range(len(m) - k + 1)) if m else {}
            for s in range(len(w) - len(m) + 1 if m else 0):
                own = collections.Counter(tuple(w[s + j:s + j + k]) for j in range(len(m) - k + 1))
                both = sum((own & bag).values())
                if both / (2 * sum(bag.values()) - both) >= 0.8:
                    truth.add((i, item))
    got = decontaminate.find_leaks(d, b).collect()
    assert {(r.doc_id, r.item_id) for r in got} == truth and len(truth) > 20
    kept = decontaminate.drop_leaks(d, b).collect()
    leaky = {i for i, _ in truth}
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [i for i, _ in docs if i is not None and i not in leaky]
    assert decontaminate.find_leaks(d, b.limit(0)).count() == 0 and decontaminate.find_leaks(d.limit(0), b).count() == 0


def test_decontamination_of_documents_shorter_than_the_item(spark):
    rnd = random.Random(12)
    item = [f"w{rnd.randrange(10**6)}" for _ in range(59)]
    bench = spark.createDataFrame([(7, " ".join(item)), (8, "only three words")], "item_id long, text string")
    cuts = [(1, 0, 59), (2, 0, 58), (3, 1, 59), (4, 5, 54), (5, 0, 47), (6, 0, 4), (9, 0, 0)]
    docs = spark.createDataFrame([(i, " ".join(item[a:b])) for i, a, b in cuts], "doc_id long, text string")
    want = {i: (0, b - a, (b - a - 4) / 55) for i, a, b in cuts if (b - a - 4) / 55 >= 0.8}
    got = {r.doc_id: (r.start_word, r.end_word, r.similarity) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert got == want and sorted(got) == [1, 2, 3, 4]
    assert sorted(r.doc_id for r in decontaminate.drop_leaks(docs, bench).collect()) == [5, 6, 9]


def test_simhash_index_finds_all_within_radius():
    rnd = np.random.default_rng(2)
    items = decontaminate.Items([(i, " ".join(f"a{i}b{j}" for j in range(20))) for i in range(50)], 5, 19, 0.8)
    prints = items.prints.copy()
    for p in range(len(prints)):
        for bit in rnd.choice(64, rnd.integers(0, 20), replace=False):
            prints[p] ^= np.uint64(1) << np.uint64(bit)
    row, item, distance = items.within(prints, 20)
    all_ = np.bitwise_count(prints[:, None] ^ items.prints[None])
    assert set(zip(row.tolist(), item.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(all_ <= 19))))


def brute_spans(t):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
                  if 8 <= sum(c.isdigit() for c in m[0]) <= 15]


def test_base_spans_match_the_patterns():
    rnd = random.Random(2)
    for n, chars in ((60, "0123456789..@ab+ -()x\n"), (200, "0012345.  @a+-")):
        for _ in range(3000):
            t = "".join(rnd.choice(chars) for _ in range(n))
            assert private_spans.base_spans(t) == brute_spans(t)


def test_private_query_and_model(spark, odd):
    got = queries.op2_pii(spark, SF).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in got:
        base = sorted(brute_spans(texts[r.doc_id]), key=lambda s: (private_spans.KINDS.index(s[0]), s[1]))
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, _, _ in base) for k in private_spans.KINDS]
    rnd = random.Random(1)
    phone = lambda: f"+1 ({rnd.randrange(200, 999)}) {rnd.randrange(200, 999)}-{rnd.randrange(1000, 9999)}"
    w = private_spans.train([(phone(), " ", " ") for _ in range(80)] + [(str(rnd.randrange(99)), " ", " ") for _ in range(40)])
    glued = "call +1 (212) 555-0101 4111111111111112"       # the pattern's greedy match fails here
    assert private_spans.base_spans(glued) == []
    assert [s[:3] for s in private_spans.find_spans(glued, w)] == [("phone", 5, 22)]
    p, s = private_spans.Lattice("+1 (212) 555-0101").marginals(w)
    assert max(p) <= 1 + 1e-9 and private_spans.find_spans("no digits", w) == []
    assert private_spans.mask("a 10.0.0.1 b", [("ip", 2, 10, True, 1.0)]) == "a [IP] b"
    assert private_spans.redact(odd, {}).count() == odd.count()
    assert private_spans.fit(odd.limit(0)) == {}


def test_marginals_sum_over_all_covers():
    rnd = random.Random(4)
    lat = private_spans.Lattice("+1234 5@6")
    w = {f: rnd.uniform(-1, 1) for e in lat.edges for f in e[3]}
    score = lat.scores(w)

    def covers(at):
        if at == lat.size:
            yield []
        for e, (i, j, _, _) in enumerate(lat.edges):
            if i == at:
                for rest in covers(j):
                    yield [e, *rest]
    every = list(covers(0))
    z = sum(math.exp(sum(score[e] for e in c)) for c in every)
    for e, p in enumerate(lat.marginals(w)[0]):
        assert p == pytest.approx(sum(math.exp(sum(score[x] for x in c)) for c in every if e in c) / z)
    assert len(lat.decode(w)) == sum(bool(lat.edges[e][2]) for e in max(every, key=lambda c: sum(score[x] for x in c)))


def test_long_stretches_are_decoded_in_blocks(monkeypatch):
    rnd = random.Random(6)
    phone = lambda: f"+1 ({rnd.randrange(200, 999)}) {rnd.randrange(200, 999)}-{rnd.randrange(1000, 9999)}"
    w = private_spans.train([(phone(), " ", " ") for _ in range(40)] + [(str(rnd.randrange(99)), " ", " ") for _ in range(20)])
    table = private_spans.by_kind(w)
    monkeypatch.setattr(private_spans, "BLOCK_ATOMS", 5)
    found = 0
    for _ in range(15):
        t = " ".join(phone() if rnd.random() < 0.4 else str(rnd.randrange(10**6)) for _ in range(12))
        got = private_spans.decode(t, "", "x", table)
        assert got == private_spans.Lattice(t, "", "x").decode(w)
        found += len(got)
    assert found
    monkeypatch.undo()
    row = ",".join(str(rnd.randrange(10**6)) for _ in range(2_000)) + ", " + phone()
    assert len(list(private_spans.stretches(row))) == 1
    tracemalloc.start()
    try:
        private_spans.find_spans(row, w)
        assert tracemalloc.get_traced_memory()[1] < 15e6          # as a whole lattice: over 50 MB
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_allotment_matches_brute_force(spark, odd, rule):
    texts = [t for t, in odd.select("text").collect()] + ["a\nb\n\n c  \nd" * 20]
    encoding, size = token_counts.encoder(token_counts.VOCABULARY)
    df = spark.createDataFrame([(i, t, [(1, 3), (3, 4)] if i % 2 else None) for i, t in enumerate(texts)],
                               "doc_id long, text string, s array<struct<start:long,end:long>>")
    for column in (None, "s"):
        for r in token_counts.count_tokens(df, sections=column, rule=rule).collect():
            raw = (texts[r.doc_id] or "").encode()
            ids = encoding.encode_ordinary(raw.decode())
            assert b"".join(encoding.decode_single_token_bytes(i) for i in ids) == raw and r.n_tokens == len(ids)
            if column is None:
                cut = [0, *[i + 1 for i, c in enumerate(raw) if c == 10]]
                cut += [len(raw)] if cut[-1] != len(raw) else []
                spans = list(zip(cut[:-1], cut[1:]))
            else:
                spans = [(1, 3), (3, 4)] if r.doc_id % 2 else []
            want, at = collections.defaultdict(float), 0
            for i in ids:
                share = [(max(0, min(b, at + size[i]) - max(a, at)), -k) for k, (a, b) in enumerate(spans)]
                out = size[i] - sum(x for x, _ in share)
                if rule == "split":
                    for x, k in share:
                        want[-k] += x / size[i]
                    want[-1 - len(spans)] += out / size[i]
                elif rule == "start":
                    want[next((k for k, (a, b) in enumerate(spans) if a <= at < b), -1 - len(spans))] += 1
                else:
                    best = max(share, default=(0, 0))
                    want[-best[1] if best[0] and best[0] >= out else -1 - len(spans)] += 1
                at += size[i]
            got = {k: s.tokens for k, s in enumerate(r.sections) if s.start >= 0}
            assert all(got.get(k, 0) == pytest.approx(want[k]) for k in range(len(spans)))
            assert sum(s.tokens for s in r.sections) == pytest.approx(len(ids))


def brute_kneser_ney(train):
    c = collections.Counter(w for t in train for w in t)
    pairs = collections.Counter(p for t in train for p in zip(["<s>", *t], t))
    total, followers, cont = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0]), collections.Counter()
    for (a, b), n in pairs.items():
        total[a] += n
        followers[a][min(n, 3) - 1] += 1
        cont[b] += 1
    dh = kneser_ney.discounts(*[sum(v == i for v in pairs.values()) for i in (1, 2, 3, 4)])
    dl = kneser_ney.discounts(*[sum(v == i for v in cont.values()) for i in (1, 2, 3, 4)])
    cls = [sum(v == 1 for v in cont.values()), sum(v == 2 for v in cont.values()), sum(v > 2 for v in cont.values())]
    off = lambda n, d: d[min(n, 3) - 1] if n else 0

    def p1(w):
        if not pairs:
            return 1 / (len(c) + 1)
        return max(cont[w] - off(cont[w], dl), 0) / len(pairs) + sum(map(float.__mul__, dl, map(float, cls))) / len(pairs) / (len(c) + 1)

    def p2(a, w):
        if not total[a]:
            return p1(w)
        n = pairs[a, w]
        return (max(n - off(n, dh), 0) + sum(x * y for x, y in zip(dh, followers[a])) * p1(w)) / total[a]
    return c, p2


def test_kneser_ney_matches_brute_force(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(
        odd.select((F.col("doc_id") + 10**6).alias("doc_id"), "text"))
    learn = ~queries.held_out(docs["doc_id"])
    model = kneser_ney.fit(docs, "text", learn)
    rows = docs.collect()
    toks = [[*words(r.text), None] for r in rows]
    fold = [zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 1 for r in rows]
    c, p2 = brute_kneser_ney([t for t, out in zip(toks, fold) if not out])
    n, v = sum(c.values()), len(c)
    assert (model.total, model.size) == (n, v)
    want = sorted((len(t), sum(c[w] > 0 for w in t), round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 5),
                   round(sum(math.log10(p2(a, w)) for a, w in zip(["<s>", *t], t)), 5)) for t in toks)
    got = sorted((r.n_tokens, r.n_known, round(r.base_score, 5), round(r.score, 5)) for r in kneser_ney.score(docs, model).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2:] for g in got], [w[2:] for w in want], rtol=1e-6, atol=2e-5)
    vocab = [*c, "never-seen-word"]
    assert sum(p2("the", w) for w in vocab) == pytest.approx(1)


def test_kneser_ney_without_training_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = kneser_ney.fit(docs, "text", F.lit(False))
    got = {r.key: r for r in kneser_ney.score(docs, model).collect()}
    assert got[1].n_tokens == 3 and got[2].n_tokens == 1 and got[1].train_tokens == 0 and got[1].score == 0.0
    assert kneser_ney.score(docs.limit(0), model).count() == 0


def test_urls_match_every_rule_on_every_address(spark):
    urls = ["https://WWW.Example.com/en/1?x=/es/", "http://a.example.com/en/", "http://x.net/es/q#f", "http://x.net",
            "x.net/es/", None, "", "ftp://u://casino.org/en/", "http://notexample.com/en/1", "http://net/fr/1",
            "http://free-bets.example.net/de/", "http://a.b.net/ES/", "http://Kads.org/", "http://x.org/Casino\n/y"]
    pages = spark.createDataFrame([(i % 11, u, "h", "p", "r") for i, u in enumerate(urls * 2)],
                                  "page_id long, url string, host string, path string, rule string")
    got = sorted(map(str, url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict").collect()))
    con = duckdb.connect()
    con.register("pages", pages.select("page_id", "url").toPandas())
    want = con.execute(url_filter.oracle_sql()).fetchall()
    assert got == sorted(f"Row(page_id={a!r}, host={b!r}, path={c!r}, rule={d!r}, verdict={e!r})" for a, b, c, d, e in want)
    assert url_filter.judge(pages.limit(0)).count() == 0
    bare = [("any", "block", "q", [], False)]
    assert {r.verdict for r in url_filter.judge(pages.where("url like '%q%'"), rules=bare).collect()} == {"block"}


def test_language_evidence(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    split = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = language_id.fit_text(docs.where(split))
    held = docs.where(~split)
    got = language_id.classify(held, model, "text").collect()          # by the text alone
    right = sum(r.language == r.lang for r in got if r.accepted)
    assert right >= 0.97 * len(got)
    out = language_id.classify(odd, model, "text", odd["lang"], None, odd["source"])
    rows = out.collect()
    assert len(rows) == odd.count() and out.columns[:-3] == odd.columns
    assert not any(r.accepted for r in rows if not re.search("[A-Za-z\x80-\U0010ffff]", r.text or ""))
    assert language_id.classify(odd.limit(0), model, "text").count() == 0
    blank = language_id.fit_text(odd.limit(0))
    assert not any(r.accepted for r in language_id.classify(odd, blank, "text").collect())


def test_pieces_are_lossless_and_reproducible(spark, odd):
    out = piece_sampling.encode(odd, decoded="back").collect()
    assert all(r.back == r.text for r in out) and len(out) == odd.count()
    assert all((r.pieces is None) == (r.text is None) for r in out)
    again = piece_sampling.decode(piece_sampling.encode(odd.repartition(3))).collect()
    assert sorted(map(str, ((r.doc_id, r.text, r.pieces) for r in out))) == sorted(map(str, ((r.doc_id, r.text, r.pieces) for r in again)))
    assert all(r.decoded == r.text for r in again)
    assert piece_sampling.encode(odd.limit(0)).count() == 0


def test_piece_sampling_follows_the_lattice():
    v = piece_sampling.vocabulary(piece_sampling.MODEL, encoding=True)

    def paths(s):
        if not s:
            return [((), 0.0)]
        out, node = [], 0
        for j, c in enumerate(s):
            node = int(v.follow(np.array([node]), np.array([0x2581 if c == " " else ord(c)]))[0])
            if node < 0:
                break
            if v.piece[node] >= 0:
                out += [((int(v.piece[node]), *a), w + v.weight[node]) for a, w in paths(s[j + 1:])]
        return out
    n = 20_000
    for alpha in (1.0, 0.2):
        flat, at = piece_sampling.sample(piece_sampling.Tables(v, alpha), ["thing"] * n, np.arange(n), 3)
        seen = collections.Counter(tuple(flat[a:b].tolist()) for a, b in zip(at[:-1], at[1:]))
        every = {p: math.exp(alpha * w) for p, w in paths(" thing")}
        z = sum(every.values())
        assert set(seen) <= set(every) and max(abs(seen[p] / n - w / z) for p, w in every.items()) < 0.015


PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a>menu</a></li></ul></nav><div class="cookie-notice"><p>We use cookies on this page for everything.</p></div>
<article><header>by line</header><h1>Head &amp; line</h1><p><b>First  para<br>goes on</p><p>x</p>
<div class="ad">Buy this now</div><p>Second &lt;b&gt; para that is rather longer than the first one.</p>
<form><input>name</form><section id="comments"><p>Reader says a lot of things about this.</p></section></article>
<aside>side</aside><footer>&copy; foot</footer></body></html>"""


def test_html_main_text(spark):
    want = "Head & line\nFirst para goes on\nx\nSecond <b> para that is rather longer than the first one."
    cases = [(1, PAGE, want), (2, None, ""), (3, "", ""), (4, "<nav>only</nav>", ""), (5, "plain & text", "plain & text"),
             (6, "<article><p>cut off here</p><p>and in a ta", "cut off here\nand in a ta"),
             (7, "<article><p>cut in a tag</p><p clas", "cut in a tag"), (8, "<article><p>a &am", "a &am"),
             (9, "<article><p>a</p><!-- x > y", "a"), (10, "<p>a<br>b</p><p>c</p>", "a b\nc"), (11, "<![bad]]><p>ok", "ok")]
    pages = spark.createDataFrame([(i, "u", h, "t") for i, h, _ in cases], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert got == {i: t for i, _, t in cases}
    assert html_text.extract(pages.limit(0)).count() == 0


def test_top_k_matches_brute_force(spark):
    rnd = np.random.default_rng(8)
    vecs = [(int(i), rnd.normal(size=12).round(1).tolist()) for i in range(400)]
    vecs += [(500, None), (550, [float("nan")] * 12), (600, [1.0, None] + [0.0] * 10), (650, [1e9] * 12), (700, []),
             (750, [0.5] * 3), (None, [9.0] * 12), (50, vecs[50][1])] + [(800 + i, [0.25] * 12) for i in range(150)]
    df = spark.createDataFrame([(*v, "q", 1) for v in vecs], "vec_id long, embedding array<float>, score string, rank int")
    ok = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v in vecs
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in sorted(i for i in ok if i % 50 == 0):
        s = sorted((-sum(a * b for a, b in zip(ok[q], v)), i) for i, v in ok.items() if i != q)[:5]
        want += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    got = sorted(map(tuple, topk.top_k(df, lambda c: c % 50 == 0).collect()))
    assert got == want
    assert topk.top_k(df.limit(0), lambda c: c % 50 == 0).count() == 0
    assert len(topk.top_k(df.where("vec_id in (0, 1)"), lambda c: c % 50 == 0).collect()) == 1


def test_top_k_whatever_order_the_files_are_read_in(spark):
    """Many files in one read task, the largest file (Spark reads it first) of the shortest vectors."""
    rnd = np.random.default_rng(9)
    short = rnd.uniform(-1, 1, (3_000, 8)).round(4)
    long = rnd.choice([-64.0, 64.0], (1_000, 8))
    vecs = [(i, v.tolist()) for i, v in enumerate([*short, *long])]
    ints = np.floor(256 * np.array([v for _, v in vecs])).astype(np.int64)
    want = []
    for q in range(0, len(vecs), 500):
        s = ints @ ints[q]
        best = sorted((-int(x), i) for i, x in enumerate(s) if i != q)[:5]
        want += [(q, r + 1, i, -x) for r, (x, i) in enumerate(best)]
    conf = {"spark.sql.files.minPartitionNum": "1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {n: spark.conf.get(n, None) for n in conf}
    try:
        for n, x in conf.items():
            spark.conf.set(n, x)
        df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>")
        got = sorted(map(tuple, topk.top_k(df, lambda c: c % 500 == 0).collect()))
    finally:
        for n, x in old.items():
            spark.conf.unset(n) if x is None else spark.conf.set(n, x)
    assert got == want


def test_registered_oracles_match(spark):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, sql in queries.ORACLE_SQL.items():
        asked = con.execute(sql)
        cols = [c[0] for c in asked.description]
        got = queries.QUERIES[name](spark, SF)
        assert sorted(got.columns) == sorted(cols), name
        # as Python values: pandas would turn whole numbers beside nulls into floats
        assert sorted(map(repr, map(tuple, got.select(*cols).collect()))) == sorted(map(repr, asked.fetchall())), name
