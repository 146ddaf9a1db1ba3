"""Prefix tries, periodic runs and url filters against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from exonlake.llm import hotjoin, periodic_runs, prefix_trie, url_filters


def brute_trie(rows, family=20):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in turns.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(turns.get(c - c % family, [])[:h] + own[h:])
    members, last = defaultdict(list), {}
    for c, t in whole.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        own = (len(m) - 1) * len(p[-1][1].encode().split()) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += own
            leaves[p[:d]] += kids[p] == 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie_rows(df, **options):
    out = prefix_trie.trie(df, **options)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=str)


CONV = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("height,block", [(2, 3), (16, 1024)])
def test_trie_of_long_and_hot_conversations(spark, height, block):
    rnd = random.Random(5)
    rows = [(7, k, "user", f"w{k % 3} x") for k in range(70)]
    rows += [(c, k, "user" if k % 2 == 0 else "bot", rnd.choice(["a", "a b", "a b c"])) for c in range(60) for k in range(rnd.choice([0, 1, 2, 5, 9]))]
    rows += [(100 + c, k, "user", "hello there" if k == 0 else f"t{c % 7}") for c in range(200) for k in range(2)]
    assert trie_rows(spark.createDataFrame(rows, CONV).repartition(5), height=height, block=block) == brute_trie(rows)


def test_trie_cases(spark):
    rows = [(None, 0, "user", "lost"), (1, None, None, None), (1, 0, "user", "a\x0bb c"), (1, 0, "user", "a\x0bb c"), (2, 3, "", ""), (20, 1, "user", " \n"), (21, 1, "user", "x"), (21, 2, "user", "long " * 20000), (-3, 0, "user", "y"), (40, 0, "a", "b"), (60, 0, "ab", "")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], CONV + ", node string, depth int")
    rows = [r for r in rows if r[0] != -3]
    assert trie_rows(df.where("conv_id is null or conv_id >= 0")) == brute_trie(rows)
    assert trie_rows(df.where("conv_id = 21")) == brute_trie([r for r in rows if r[0] == 21])
    assert trie_rows(df.limit(0)) == []
    # all turns of a conversation borrowed from a family head that is absent: the root alone
    bare = next(c for c in range(100, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4 >= 1)
    assert trie_rows(spark.createDataFrame([(bare, 0, "user", "gone")], CONV)) == [(bare, 0, None, 1, 0, 1, 0, hashlib.sha256(str(bare).encode()).hexdigest())]


def test_trie_digest_pieces(spark, monkeypatch):
    ends = spark.createDataFrame([("n", c) for c in range(9, 1200)] + [("m", 5)], "node string, conv_id long").repartition(6)
    found = {r["node"]: r["ends_sha256"] for r in prefix_trie.end_digests(ends).collect()}
    assert found == {"n": hashlib.sha256(",".join(map(str, range(9, 1200))).encode()).hexdigest(), "m": hashlib.sha256(b"5").hexdigest()}
    import pyarrow as pa

    monkeypatch.setattr(prefix_trie, "PIECE", 10)
    batch = pa.RecordBatch.from_pydict({"node": ["a"] * 25 + ["b"], "conv_id": list(range(26))})
    pieces = list(prefix_trie._pieces(iter([batch])))
    assert [p.column(1)[0].as_py() for p in pieces] == [0, 10, 20, 25]
    assert {r["node"]: r["ends_sha256"] for b in prefix_trie._digests(iter(pieces)) for r in b.to_pylist()}["a"] == hashlib.sha256(",".join(map(str, range(25))).encode()).hexdigest()


def brute_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found[i, j + q - i] = min(q, found.get((i, j + q - i), n))
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_document(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    from fractions import Fraction

    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), best[0], best[2], best[1], 1000 * best[1] // best[2] if runs else None, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_of_random_words():
    rnd = random.Random(11)
    for _ in range(60):
        docs = []
        for _ in range(rnd.randint(1, 6)):
            k, words = rnd.choice([1, 2, 3, 30]), []
            for _ in range(rnd.randint(0, 6)):
                unit = [rnd.randint(0, k) for _ in range(rnd.randint(1, 25))]
                words += unit * rnd.randint(1, 7) + unit[: rnd.randint(0, len(unit))]
            docs.append(words)
        letters = [np.array([1000])]
        for i, w in enumerate(docs):
            letters += [np.array(w, np.int64), np.array([1001 + i])]
        sizes = np.array([len(w) for w in docs])
        starts = np.cumsum(sizes + 1) - sizes
        start, end, q = periodic_runs.runs_of(np.concatenate(letters), starts, sizes)
        of = np.searchsorted(starts, start, "right") - 1
        for d, w in enumerate(docs):
            mine = of == d
            assert sorted(zip((start - starts[d])[mine].tolist(), (end - start)[mine].tolist(), q[mine].tolist(), strict=True)) == brute_runs(w)


def test_extensions_of_a_grammar():
    rnd = np.random.default_rng(2)
    for size, kinds in ((40, 1), (400, 2), (3000, 3)):
        core = rnd.integers(0, kinds, size)
        letters = np.concatenate(([kinds], core, [kinds + 1]))
        grammar = periodic_runs.Grammar(letters)
        i, j = np.sort(rnd.integers(1, size + 1, (2, 300)), axis=0)
        i, j = i[i < j], j[i < j]
        ahead, behind = grammar.extension(i, j), grammar.extension(i, j, back=True)
        for a, b, f, g in zip(i, j, ahead, behind, strict=True):
            assert (letters[a : a + f] == letters[b : b + f]).all() and letters[a + f] != letters[b + f]
            assert (letters[a - g : a] == letters[b - g : b]).all() and letters[a - g - 1] != letters[b - g - 1]


def test_runs_of_documents(spark, sf_dir):
    cases = [(0, None), (1, ""), (2, " \n\t "), (3, "a " * 24), (4, "a " * 23), (5, "x y z " * 8 + "x"), (None, "a b " * 12), (7, "a b " * 12 + "c " + "a b " * 30), (7, "a b " * 12 + "c " + "a b " * 30), (8, "é ü\x0b" * 30), (9, "tail " + "q r s t " * 2000), (40, "one two three four five six seven eight nine ten " * 3)]
    some = spark.createDataFrame([(*c, 1, "z") for c in cases], "doc_id long, text string, n_runs int, start string")
    got = sorted(map(tuple, periodic_runs.periodic_runs(some).collect()), key=str)
    assert got == sorted((brute_document(*c) for c in cases), key=str)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    short = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect() if len((r["text"] or "").split()) <= 1500]
    got = {r["doc_id"]: tuple(r) for r in periodic_runs.periodic_runs(docs).collect()}
    assert len(got) == docs.count() and len(short) > 150
    assert [got[i] for i, _ in short] == [brute_document(i, t) for i, t in short]
    assert periodic_runs.periodic_runs(docs.limit(0)).collect() == []


def test_url_parts(spark):
    urls = [None, "", "nothing", "http://", "HTTP://User@WWW.Example.COM:80/En/x?y#z", "https://a.b.co.uk?q=/x", "http://10.0.0.1/é/x", "ftp://x#frag", "http://ÄB.de/p"]
    host, path = url_filters.host_and_path(url_filters.F.col("url"))
    df = spark.createDataFrame([(u,) for u in urls], "url string").select(host.alias("h"), path.alias("p"), url_filters.registered_domain(host).alias("d"), url_filters.suffix(url_filters.registered_domain(host)).alias("s"))
    assert [tuple(r) for r in df.collect()] == [("", "", "", ""), ("", "", "", ""), ("", "", "", ""), ("", "", "", ""), ("user@www.example.com:80", "/En/x", "example.com", "com"), ("a.b.co.uk", "", "b.co.uk", "co.uk"), ("10.0.0.1", "/é/x", "10.0.0.1", ""), ("x", "", "x", "x"), ("Äb.de", "/p", "Äb.de", "de")]


def test_url_rules(spark):
    cases = {"http://a.com/en/": ("com/", "allow"), "http://a.com": (None, "allow"), "http://EXAMPLE.com/en/x": ("example.com/en/", "block"), "http://m.example.com/en/": ("example.com/en/", "block"), "http://www.example.com/en/1": ("www.example.com/en/", "allow"), "http://a.www.example.com/en/1": ("www.example.com/en/", "allow"), "http://notexample.com/en/": ("com/", "allow"), "http://x.net/es/": ("net/es/", "block"), "http://x.net/es": (None, "allow"), "http://net/fr/?a": ("net/fr/", "block"), "http://x.org/en/": (None, "allow")}
    pages = spark.createDataFrame([(i, u, "verdict") for i, u in enumerate(cases)], "page_id long, url string, verdict string")
    found = url_filters.judge(pages, pages.selectExpr("url", "0 as bad"))
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in found.collect()}
    assert got == {i: v for i, v in enumerate(cases.values())}
    with pytest.raises(ValueError):
        url_filters.fitting_rule(url_filters.F.lit("a"), url_filters.F.lit("b"), [("allow", "a", "/")] * 1001)


def brute_reputation(outcomes):
    from collections import Counter

    n, k, up = Counter(), Counter(), {}
    for url, bad in outcomes:
        if bad is not None:
            host = url.split("://")[1].split("/")[0]
            dom = ".".join(host.split(".")[-2:])
            up[("h", host)], up[("d", dom)], up[("s", dom.split(".")[-1])] = ("d", dom), ("s", dom.split(".")[-1]), "all"
            for key in (("h", host), ("d", dom), ("s", dom.split(".")[-1]), "all"):
                n[key] += 1
                k[key] += bad
    mean = {s: (k["all"] - k[s] + 0.5) / (n["all"] - n[s] + 1) for s in up if s[0] == "s"}

    def strength(level):
        spare = sum((k[x] - n[x] * mean[x]) ** 2 - n[x] * mean[x] * (1 - mean[x]) for x in up if x[0] == level)
        room = sum(n[x] * mean[x] * (1 - mean[x]) * (n[x] - 1) for x in up if x[0] == level)
        return 1000.0 if room == 0 or spare <= 0 else min(max(room / spare - 1, 2.0), 1000.0)

    for level, above in (("d", "s"), ("h", "d")):
        z = strength(above)
        for x in up:
            if x[0] == level:
                p = up[x]
                mean[x] = (k[p] - k[x] + z * mean[p]) / (n[p] - n[x] + z)
    z, out = strength("h"), {}
    for x in up:
        if x[0] == "h":
            a, b = k[x] + z * mean[x], n[x] - k[x] + z * (1 - mean[x])
            m = a / (a + b)
            out[x[1]] = (n[x], k[x], m, m - 1.645 * (m * (1 - m) / (a + b + 1)) ** 0.5)
    return out


def test_url_reputation(spark):
    rnd = random.Random(4)
    outcomes = []
    for d, rate in enumerate((0.02, 0.05, 0.1, 0.9, 0.95)):
        for h in range(6):
            outcomes += [(f"http://h{h}.site{d}.{'org' if d % 2 else 'net'}/{i}", int(rnd.random() < rate)) for i in range(rnd.choice([1, 3, 40]))]
    outcomes += [("http://big.site0.net/", int(i % 50 == 0)) for i in range(900)] + [("http://fresh.site4.net/", 1), ("http://fresh.site1.org/", 1), ("http://h0.site0.net/", None)]
    want = brute_reputation(outcomes)
    df = spark.createDataFrame([(*o, "x", 1) for o in outcomes], "url string, bad int, host string, n int")
    got = {r["host"]: (r["n"], r["bad"], r["mean"], r["bound"]) for r in url_filters.host_reputation(df).collect()}
    assert got.keys() == want.keys()
    for h in want:
        assert got[h] == pytest.approx(want[h], abs=1e-6)
    # one bad outcome blocks a new host of a bad domain only
    pages = spark.createDataFrame([(1, "http://fresh.site4.net/a"), (2, "http://fresh.site1.org/a"), (3, "http://big.site0.net/"), (3, "http://big.site0.net/"), (None, None), (4, "http://unseen.org/")], "page_id long, url string")
    verdict = [(r["page_id"], r["verdict"]) for r in url_filters.judge(pages, df).collect()]
    assert sorted(verdict, key=str) == sorted([(1, "block"), (2, "allow"), (3, "allow"), (3, "allow"), (None, "allow"), (4, "allow")], key=str)
    assert url_filters.judge(pages.limit(0), df).collect() == [] and url_filters.host_reputation(df.limit(0)).collect() == []


def test_join_counted(spark):
    left = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else concat('k', id % 50) end as key")
    right = left.where("key is not null").groupBy("key").count().withColumn("v", url_filters.F.upper("key")).where("key <> 'k4'")
    rows = hotjoin.join_counted(left, right, "key", "count", 3000, "id").collect()
    assert len(rows) == 3000 and all(r["v"] == (r["key"].upper() if r["key"] and r["key"] != "k4" else None) for r in rows)
