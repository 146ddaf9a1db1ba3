"""The ten operators against brute force on small tables, and on empty, null and repeated rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from exonlake.llm import best_fit_packing, decontamination, html_extraction, jaccard_join, kneser_ney, pii, quality_rules, suffix_dedup, textops, token_rollups, warc_revisits
from exonlake.llm.queries import TOKENIZER
from exonlake.llm.store import fresh_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, label string"


def _texts():
    rng = np.random.default_rng(3)
    vocab = ["".join(rng.choice(list("abcdeéß"), rng.integers(2, 8))) for _ in range(300)]
    base = [" ".join(rng.choice(vocab, rng.integers(5, 160))) for _ in range(30)]
    near = [t.replace(t.split()[3], "other", 1) for t in base[:8]]
    hot = " ".join(rng.choice(vocab, 50))
    shared = [f"{base[k][:40]} {hot} {base[-k - 1][:60]}\n\n{hot}" for k in range(12)]
    return [*base, *near, *base[:4], *shared, hot * 9, "", " \n\t ", "one", "two words", "the  " * 700, "1 2 3\n1 2 3\n1 2 3", None, "é" * 900]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en" if k % 3 else None, "s", 0, "x", "y") for k, t in enumerate(_texts())]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, 0) for k in range(20)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.mark.parametrize("hot", [1500, 2])
def test_suffix_dedup(docs, empty, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    got = by_id(suffix_dedup.remove_repeats(docs))
    raw = [(t or "").encode() for t in _texts()]
    seen = Counter(t[k : k + 200] for t in raw for k in range(len(t) - 199))
    for k, t in enumerate(raw):
        cover = np.zeros(len(t), bool)
        for at in range(len(t) - 199):
            if seen[t[at : at + 200]] > 1:
                cover[at : at + 200] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~cover])
        runs = sum(1 for c, _ in itertools.groupby(cover) if c)
        assert (got[k]["n_bytes"], got[k]["n_removed"], got[k]["n_spans"], got[k]["kept_sha256"]) == (len(t), int(cover.sum()), runs, hashlib.sha256(kept).hexdigest())
    assert suffix_dedup.remove_repeats(empty).count() == 0


def _expected_stats(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    times, hit = Counter(grams), set()
    for k, g in enumerate(grams):
        if times[g] > 1:
            hit |= {k, k + 1, k + 2}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


def test_quality_stats(docs, empty, labels):
    got = by_id(quality_rules.quality_rules(docs, labels))
    for k, t in enumerate(_texts()):
        want = _expected_stats(t)
        assert tuple(got[k][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert got[k]["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (got[k]["base_failed"] and got[k]["kept"])
    assert quality_rules.quality_rules(empty, labels).count() == 0
    assert all(r["kept"] != r["base_failed"] for r in quality_rules.quality_rules(docs, labels.where("quality = 1")).collect())


def test_tree_constraints():
    rng = np.random.default_rng(1)
    x = rng.random((600, 3))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 1])) > 0.6).astype(float)
    trees = quality_rules.fit_trees(x, y, np.array([1, 0, -1]), trees=30)
    assert ((trees.score(x) > 0) == y).mean() > 0.95
    for f, sign in ((0, 1), (2, -1)):
        line = np.tile(rng.random(3), (50, 1))
        line[:, f] = np.linspace(0, 1, 50)
        assert (sign * np.diff(trees.score(line)) >= -1e-9).all()


def test_trees_of_many_labels_take_them_all(spark, monkeypatch):
    """Labels beyond local_rows are not thinned out: the spread fit is that of all rows at hand, however they are dealt."""
    monkeypatch.setattr(quality_rules, "CHUNK_ROWS", 37)
    rng = random.Random(2)
    word = lambda good: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 9))) + ("" if good or rng.random() < 0.8 else " #!|")
    rows = [(k, " ".join(word(k % 3 > 0) for _ in range(rng.randrange(50, 90))), k % 3 > 0) for k in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(good)) for k, _, good in rows], "doc_id long, quality int")
    stats = quality_rules.document_stats(docs.join(labels, "doc_id"), keep_columns=["doc_id", "quality"]).withColumnRenamed("quality", "_quality")
    monotone = np.array([quality_rules.MONOTONE.get(f, 0) for f in quality_rules.FEATURES])
    table = stats.toPandas()
    x, y = table[list(quality_rules.FEATURES)].to_numpy(float), table["_quality"].to_numpy(float)
    whole = quality_rules.fit_trees(x, y, monotone, quality_rules.quantile_edges(stats), trees=4)
    for parts in (1, 3):
        spread = quality_rules.fit_spread_trees(stats.repartition(parts), y.mean(), monotone, trees=4)
        assert all(np.array_equal(getattr(spread, f), getattr(whole, f)) for f in ("feature", "threshold", "left", "right", "value", "roots"))
    monkeypatch.setattr(quality_rules, "fit_spread_trees", lambda rows, *_: rows.count())
    assert quality_rules.fit_rules(docs, labels, 50) == 300


def _sets(words):
    out = []
    for t in _texts():
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    return out


@pytest.mark.parametrize(("rounds", "group", "broadcast"), [(2, 256, 1000), (0, 3, 0), (1, 2, 5)])
def test_jaccard_classes(docs, empty, monkeypatch, rounds, group, broadcast):
    monkeypatch.setattr(jaccard_join, "ROUNDS", rounds)
    monkeypatch.setattr(jaccard_join, "GROUP", group)
    monkeypatch.setattr(jaccard_join, "MAX_BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(jaccard_join, "TOLD", 2)
    sets = _sets(4)
    label = list(range(len(sets)))
    for _ in sets:
        for a, b in itertools.combinations(range(len(sets)), 2):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                label[a] = label[b] = min(label[a], label[b])
    got = by_id(jaccard_join.jaccard_classes(docs))
    assert [(got[k]["n_shingles"], got[k]["component_id"]) for k in range(len(sets))] == [(len(s), c) for s, c in zip(sets, label, strict=True)]
    assert jaccard_join.jaccard_classes(empty).count() == 0


def test_jaccard_classes_of_clashing_ids(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(5, a), (5, b), (5, b), (7, b + " more"), (2, a), (9, c), (None, c), (11, a + " end"), (12, None), (12, c)]
    got = jaccard_join.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == [(0, 0), (2, 2), (5, 2), (5, 2), (5, 2), (7, 2), (9, 9), (11, 2), (12, 9), (12, 12)]


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    rows = [r.asDict() for r in best_fit_packing.pack(docs, TOKENIZER, capacity=256).collect()]
    for k, t in enumerate(_texts()):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        own = sorted((r for r in rows if r["doc_id"] == k), key=lambda r: r["piece"])
        assert [(r["start"], r["length"], r["ids_crc32"]) for r in own] == [(s, len(ids[s : s + 256]), zlib.crc32(ids[s : s + 256].tobytes())) for s in range(0, len(ids), 256)]
    ends = Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 256
    assert len(ends) <= 1.1 * sum(r["length"] for r in rows) / 256 + 1
    assert best_fit_packing.pack(empty, TOKENIZER).count() == 0


@pytest.mark.parametrize("text", ["A.b, C's d're x1y2 é» «q» o'n <|endoftext|> <|ENDOFTEXT|> ##a $b$ Ümlaut İx K", "tab\tand space wide\x1c end", "áb é."])
def test_word_encoder(text):
    enc = best_fit_packing.WordEncoder(TOKENIZER)
    assert np.frombuffer(enc.ids(text.encode()), "<u4").tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


PII = "Write to a.b+c@mail.example.com, or x@y; 10.0.0.255 not 1.2.3.999, card 4111 1111 1111 1111 or 4111111111111112, call +1 (555) 123-4567."


def test_pii(spark, docs, empty):
    frame = spark.createDataFrame([(0, PII), (1, None), (2, ""), (3, "é " + PII)], "doc_id long, text string")
    kinds = [(PII[s:e], pii.KINDS[k]) for s, k, e in pii.base_spans(PII)]
    assert kinds == [("a.b+c@mail.example.com", "email"), ("10.0.0.255", "ip"), ("4111 1111 1111 1111", "card"), ("+1 (555) 123-4567", "phone")]
    got = by_id(pii.find_pii(frame, pii.fit_field(frame), redact=True))
    assert [got[0][f"n_{k}"] for k in pii.BASE_KINDS] == [1, 1, 1, 1]
    assert got[0]["base_sha256"] == hashlib.sha256(pii.as_string(pii.base_spans(PII)).encode()).hexdigest()
    assert got[1]["spans"] == got[2]["spans"] == "" and "[EMAIL]" in got[3]["redacted"]
    assert pii.find_pii(empty, pii.fit_field(empty)).count() == 0


def test_pii_field_finds_what_no_pattern_has(spark, sf_dir):
    """Precision and recall of spans on forms drawn anew, in texts that the field was not trained on."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text is not null")
    field = pii.fit_field(docs.where("doc_id % 2 = 0"))
    rng, rows, gold = np.random.Generator(np.random.PCG64(77)), [], {}
    for r in docs.where("doc_id % 2 = 1").orderBy("doc_id").collect():
        words = re.sub(r"[0-9@+()\[\]]", "", r["text"]).split()[:40]
        text = " ".join(words[: len(words) // 2])
        for form, kind in pii.written_forms(rng):
            text += " "
            if kind is not None:
                lead = len(form) - len(form.lstrip("\"'"))
                gold[r["doc_id"], pii.KINDS[kind], len(text) + lead, len(text) + lead + len(form.strip("\"'"))] = None
            text += form
        rows.append((r["doc_id"], " ".join([text, *words[len(words) // 2 :]]), 1, "x"))
    frame = spark.createDataFrame(rows * 2, "doc_id long, text string, n_email int, spans string")
    got, base = set(), set()
    for r in pii.find_pii(frame, field).collect():
        own = [x.split(":") for x in filter(None, r["spans"].split(","))]
        got |= {(r["doc_id"], k, int(s), int(e)) for k, s, e in own}
        assert r["n_spans"] == len(own)
    for doc_id, text, *_ in rows:
        base |= {(doc_id, pii.KINDS[k], s, e) for s, k, e in pii.base_spans(text)}
    assert len(gold) > 60 and len(gold.keys() & got) >= 0.8 * len(gold) > len(gold.keys() & base) + 0.3 * len(gold)
    added = got - base
    assert len(added & gold.keys()) >= 0.9 * len(added)


def test_redaction_of_overlapping_spans():
    assert pii._redacted("ab 12 cd 34", [(0, 3, 5), (3, 2, 8), (9, 1, 11)]) == "[PHONE] [IP]"


@pytest.mark.parametrize("text", [PII, "a@b@c.de x@y.z@q.r", "1.2.3.4.5.6.7.8 0001.2.3.4", "+12 345 678 90 12+1", "1" * 60, "@@a@b.c-d.e_f@g.hh"])
def test_base_patterns(text):
    plain = ((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 0), (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", 1), (r"[0-9]([\x20-]?[0-9])+", 2), (r"\+[0-9][\x20().0-9-]+[0-9]", 3))
    digits = lambda m: re.sub("[^0-9]", "", m)
    ok = (lambda m: True, lambda m: all(int(p) <= 255 for p in m.split(".")), lambda m: 14 <= len(digits(m)) <= 19 and pii._luhn(digits(m)), lambda m: 10 <= len(digits(m)) <= 15)
    assert pii.base_spans(text) == sorted((m.start(), k, m.end()) for p, k in plain for m in re.finditer(p, text) if ok[k](m[0]))


def test_viterbi_is_best():
    rng = np.random.default_rng(2)
    k = len(pii.LABELS)
    field = pii.Field(rng.standard_normal((pii.N_FEATURES + 1, k)), rng.standard_normal((k, k)), rng.standard_normal((2, k)))
    features, real = rng.integers(0, pii.N_FEATURES, (2, 3, 6)), np.array([[1, 1, 1], [1, 1, 0]], bool)
    best, e = field.viterbi(features, real), field.scores(features)
    for i, n in ((0, 3), (1, 2)):
        score = lambda p, i=i, n=n: field.edge[0, p[0]] + field.edge[1, p[-1]] + sum(e[i, t, p[t]] for t in range(n)) + sum(field.step[p[t], p[t + 1]] for t in range(n - 1))
        assert score(tuple(best[i, :n])) == pytest.approx(max(map(score, itertools.product(range(k), repeat=n))))


def test_decontamination(spark, docs, empty):
    items = spark.createDataFrame([(0, _texts()[2]), (1, _texts()[5]), (2, "unrelated words of nothing at all in here"), (3, None), (4, "")], "item_id long, text string")
    want = {(2, 0), (5, 1), (32, 0), (35, 1), (40, 0)} & {(k, i) for k in range(60) for i in range(2)}
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, items).where("leaked").collect()}
    assert {p for p in want if p[0] < 42} <= got
    assert {p[1] for p in got} <= {0, 1} and all(k in {2, 5, 32, 35, 40, 43} or p in got for p in want for k in [p[0]])
    assert decontamination.leaks(empty, items).count() == 0 and decontamination.leaks(docs, items.where("item_id > 9")).count() == 0


def _planted(spark, sf_dir, n_items):
    """(documents, items): items cut from texts of sf_dir; documents are those texts, and items with 0, 15 and 30 % of the words before the answer replaced."""
    rng = np.random.default_rng(n_items)
    texts = [r["text"].split() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").where("text is not null").orderBy("doc_id").collect()]
    texts = [t for t in texts if 60 <= len(t) <= 500]
    corpus, items = np.concatenate(texts), []
    for k in range(n_items):
        t, n = texts[k % len(texts)], int(rng.integers(15, 60))
        at = int(rng.integers(0, len(t) - n + 1))
        items.append(t[at : at + n])
    docs = [" ".join(t) for t in texts]
    for k, j in enumerate(rng.choice(n_items, 150, replace=False)):
        own = list(items[j])
        free = len(own) - max(3, len(own) // 5)
        for place in rng.choice(free, int((0, 0.15, 0.3)[k % 3] * free), replace=False):
            own[place] = rng.choice(corpus)
        docs.append(" ".join([*rng.choice(corpus, 30), *own, *rng.choice(corpus, 30)]))
    return docs, [" ".join(x) for x in items]


def _leaks_by_brute_force(docs, items):
    """(document, item) by the word check over whole documents; skipped are only items of which too few words are in the document."""
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    code, found = {}, set()
    coded = [[[code.setdefault(w, len(code)) for w in words(t)] for t in x] for x in (docs, items)]
    for d, own in enumerate(coded[0]):
        known = np.zeros(len(code), bool)
        known[own] = True
        for j, needle in enumerate(coded[1]):
            if 5 * known[needle].sum() < 3 * len(needle):
                continue
            answer = decontamination._answer(needle)
            n, answer = decontamination._best(decontamination.word_masks(needle), decontamination.word_masks(answer), len(needle), len(answer), own, 0, len(own))
            if 5 * n >= 4 * len(needle) or (5 * n >= 3 * len(needle) and 5 * answer >= 4 * max(3, len(needle) // 5)):
                found.add((d, j))
    return found


@pytest.mark.parametrize("n_items", [200, 1000, 4000])
def test_decontamination_finds_all_leaks_of_brute_force(spark, sf_dir, n_items):
    docs, items = _planted(spark, sf_dir, n_items)
    want = _leaks_by_brute_force(docs, items)
    sent = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(*sent).where("leaked").collect()}
    print(n_items, "items:", len(want), "leaks,", len(want & got), "found,", len(got - want), "more; planted", len({p for p in want if p[0] >= len(docs) - 150}))
    for k in range(3):
        own = {p for p in want if p[0] >= len(docs) - 150 and (p[0] - len(docs) + 150) % 3 == k}
        print("   replaced", (0, 15, 30)[k], "%:", len(own & got), "of", len(own))
    assert len(want) > n_items / 2 and not want - got


def test_decontamination_loses_no_paraphrase_to_the_directions(spark, sf_dir):
    rng = np.random.default_rng(5)
    items = {r["item_id"]: r["text"].split() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    corpus = np.concatenate([r["text"].split() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").where("text is not null").limit(50).collect()])
    docs = []
    for own in map(list, items.values()):
        free = len(own) - max(3, len(own) // 5)
        for place in rng.choice(free, int(0.3 * free), replace=False):
            own[place] = rng.choice(corpus)
        docs.append(" ".join([*rng.choice(corpus, 40), *own, *rng.choice(corpus, 40)]))
    want = {(d, list(items)[j]) for d, j in _leaks_by_brute_force(docs, [" ".join(x) for x in items.values()])}
    sent = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    for least in (decontamination.MIN_COSINE, 2.0):  # with 2.0 the directions find nothing
        assert {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(*sent, min_cosine=least).where("leaked").collect()} == want
    assert len(want) > 0.9 * len(items)


@pytest.mark.parametrize("pair", [("abcd", "acbd"), ("", "ab"), ("aaab", "aba"), ("xyz", "abc")])
def test_common_subsequence(pair):
    a, b = ([ord(c) for c in s] for s in pair)
    best = max(len(c) for n in range(len(a) + 1) for c in itertools.combinations(a, n) if all(x in it for it in [iter(b)] for x in c))
    masks = decontamination.word_masks(a)
    assert decontamination.common_subsequence(len(a), [masks[x] for x in b if x in masks]) == best


PAGE = "<html><head><title>T</title><script>var a='</p>';</script></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article><h1>Big &amp; title</h1><p>First  <b>bold</b> text,<br>next line of it.</p><p>Second one here.</article><footer>&copy; us</footer></body></html>"


def test_html(spark, sf_dir):
    assert [b.text for b in html_extraction.blocks_of(PAGE)] == ["T", "Home", "Big & title", "First bold text, next line of it.", "Second one here.", "© us"]
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    net = html_extraction.fit_labeller(pages, 40)
    more = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (3, "u", "")], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in html_extraction.main_text(more, net).collect()}
    assert got[1]["text"] == "Big & title\n\nFirst bold text, next line of it.\n\nSecond one here." and got[2]["text"] == got[3]["text"] == ""
    held, labels = html_extraction.training_set([r["html"] for r in pages.orderBy("page_id").limit(20).collect()], seed=77)
    wrong = sum(((net.run(*html_extraction._padded([x]))[0] > 0) != y).sum() for x, y in zip(held, labels, strict=True))
    assert wrong < 0.05 * sum(map(len, held))
    assert html_extraction.main_text(more.where("page_id > 9"), None).count() == 0


def test_kneser_ney(spark, docs, empty, labels):
    sent = by_id(kneser_ney.classify(docs, labels))
    joined = by_id(kneser_ney.classify(docs, labels, max_broadcast_rows=0))
    for k, t in enumerate(_texts()):
        a, b = sent[k]["perplexity"], joined[k]["perplexity"]
        assert (a is None) == (not t) and (a is None or a == pytest.approx(b, rel=1e-4))
    assert not sent[_texts().index(None)]["kept"] and kneser_ney.classify(empty, labels).count() == 0
    model = kneser_ney.fit_model(docs.where("doc_id < 20"))
    seen = model.where("kind = 'p' and level = 2").select(F.shiftright("gram", 12).alias("c"), F.exp("value").alias("p"))
    lower = {r["gram"]: r["value"] for r in model.where("kind = 'p' and level = 1").select("gram", F.exp("value").alias("value")).collect()}
    weight = {r["gram"]: r["value"] for r in model.where("kind = 'g' and level = 2").select("gram", F.exp("value").alias("value")).collect()}
    grams = {(r["gram"] >> 12, r["gram"] & 4095) for r in model.where("kind = 'p' and level = 2").collect()}
    rest = 1 - sum(lower.values())
    for r in seen.groupBy("c").agg(F.sum("p").alias("p")).limit(5).collect():
        unseen = sum(v for g, v in lower.items() if (r["c"], g) not in grams) + rest
        assert r["p"] + weight[r["c"]] * unseen == pytest.approx(1, abs=2e-2)


def test_rollups(spark, docs):
    roll = token_rollups.Rollup(spark, fresh_path(spark, "roll"))
    assert roll.totals().count() == 0
    counts = token_rollups.counted(docs)
    assert roll.commit("a", token_rollups.signed(counts, 1)) and not roll.commit("a", token_rollups.signed(counts, 1))
    words = sum(len(WORD.findall(t or "")) for t in _texts())
    total = lambda: {r["version"]: (r["d"], r["t"]) for r in roll.totals().groupBy("version").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t")).collect()}
    assert total()["words-1"] == (len(_texts()), words)
    before = total()
    roll.compact()
    assert total() == before and not roll.commit("a", token_rollups.signed(counts, 1))
    roll.commit("b", token_rollups.signed(counts, -1))
    assert roll.totals().count() == 0


def test_rollups_survive_a_lost_driver(spark):
    """compact stopped at any of its steps changes no total, forgets no batch and can be run again."""
    one = spark.createDataFrame([("s", None, "v", 5), (None, "l", "v", None)], "source string, lang string, version string, tokens long")
    for broken in range(6):
        store = token_rollups.Rollup(spark, fresh_path(spark, "rollup"))
        store.commit("1", token_rollups.signed(one, 1))
        store.compact()
        for k in "234":
            assert store.commit(k, token_rollups.signed(one.limit(0) if k == "4" else one, 1))
        steps, real = iter(range(100)), {"_moved": store._moved, "_dropped": store._dropped}

        def step(name, *args, steps=steps, real=real, broken=broken):
            if next(steps) == broken:
                raise OSError("driver lost")
            return real[name](*args)

        store._moved, store._dropped = (lambda *a, n=n: step(n, *a) for n in ("_moved", "_dropped"))
        try:
            store.compact()
        except OSError:
            pass
        again = token_rollups.Rollup(spark, store.path)
        for _ in range(2):
            rows = {(r["source"], r["lang"], r["docs"], r["tokens"]) for r in again.totals().collect()}
            assert rows == {("s", None, 3, 15), (None, "l", 3, 0)} and again.batches() == list("1234")
            assert not again.commit("3", token_rollups.signed(one, 1))
            again.compact()
    with pytest.raises(ValueError, match="batch id"):
        again.commit("a/b", one)


def test_quality_rules_with_clashing_columns(spark, docs, labels):
    more = docs.withColumn("_quality", docs["doc_id"]).withColumn("score", docs["text"])
    assert by_id(quality_rules.quality_rules(more.unionByName(more), labels)).keys() == by_id(docs).keys()


def test_revisits(spark):
    head = lambda e: {"ETag": e, "X": "1"}
    rows = [(1, "http://www.A.com/x/?utm_a=1#f", 10, "response", "d1", "e1", head("e1")), (2, "https://a.com/x", 4000, "revisit", "d1", "e1", {"etag": "e1", "expires": "z", "X": "9"}), (3, "http://a.com/x", 5, "revisit", "d1", "e1", None),
            (4, "http://a.com/x", 9000, "response", "d2", None, None), (5, "http://a.com/x", 9001, "revisit", "d1", "e1", None), (6, "http://a.com/x", 9002, "revisit", None, "e9", None), (7, None, 1, "revisit", "d", "e", None), (8, "http://a.com:80/x", None, "revisit", "d", "e", None)]
    log = spark.createDataFrame(rows, "capture_id long, url string, ts long, kind string, digest string, etag string, headers map<string,string>")
    got = {r["capture_id"]: r for r in warc_revisits.resolve_revisits(log).collect()}
    assert {k: r["reason"] for k, r in got.items()} == {2: "resolved", 3: "no-response", 5: "mismatch", 6: "unverified", 7: "no-url", 8: "no-response"}
    assert got[2]["response_id"] == 1 and {k.lower(): v for k, v in got[2]["headers"].items()} == {"etag": "e1", "expires": "z", "x": "1"}
    assert warc_revisits.resolve_revisits(log.limit(0)).count() == 0


def _twins():
    """Two texts of 1024 letters that sums of letters times powers modulo 2**64 can't tell apart."""
    one = "a"
    for _ in range(10):
        one += one.translate(str.maketrans("ab", "ba"))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_texts_that_weak_hashes_confuse(spark):
    one, two = _twins()
    texts = [one, two, f"{one}\n{two}", " ".join(("x", one, "y", "x", two, "y")), f"{one} b c d", f"{two} b c d", f"{one} b c d"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    stats = by_id(quality_rules.document_stats(df))
    assert [stats[k]["n_dup_lines"] for k in range(7)] == [0] * 7 and [stats[k]["n_repeat_words"] for k in range(7)] == [0] * 7
    classes = by_id(jaccard_join.jaccard_classes(df))
    assert [classes[k]["component_id"] for k in range(7)] == [0, 1, 2, 3, 4, 5, 4]
    seen = Counter(t[k : k + 200] for t in texts for k in range(len(t) - 199))
    got = by_id(suffix_dedup.remove_repeats(df))
    for k, t in enumerate(texts):
        gone = {i for at in range(len(t) - 199) if seen[t[at : at + 200]] > 1 for i in range(at, at + 200)}
        assert got[k]["n_removed"] == len(gone)


def test_span_hashes():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 256, 5000).astype(np.uint8)
    data = np.concatenate([base, base[:777], base])
    start = rng.integers(0, 4000, 500)
    end = start + rng.integers(0, 400, 500)
    for seed in (0, 1):
        assert (textops.span_hash(data, start, end, seed) == textops.span_hash(data, start + 5777, end + 5777, seed)).all()
    windows, long = textops.window_hash(data), end - start >= textops.WINDOW
    assert (textops.windows_span(windows, start[long], end[long]) == textops.windows_span(windows, start[long] + 5777, end[long] + 5777)).all()
    tails = np.array([textops.span_hash(np.frombuffer(b, np.uint8), np.array([0]), np.array([len(b)]))[0] for b in (b"", b"\0", b"\0\0", b"a", b"a\0", b"a" * 8, b"a" * 9, b"a" * 127, b"a" * 128)])
    assert len(set(tails.tolist())) == len(tails)


def test_pii_secrets_and_forms_that_no_generator_wrote(spark, sf_dir):
    """Secrets of the documents themselves, and lines written by hand: what is found and what is left alone."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    field = pii.fit_field(docs)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    spans = {r["doc_id"]: set(r["spans"].split(",")) for r in pii.find_pii(docs, field).collect()}
    want = [(i, f"secret:{m.start(1)}:{m.end(1)}") for i, t in texts.items() for m in re.finditer(r'token = "([0-9a-f]{40})"', t)]
    assert sum(s in spans[i] for i, s in want) >= 0.9 * len(want)
    hexes = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    free = [f"see commit {hexes} for more", "md5 9e107d9d372bb6826bd81d3542a419d6 of it", "id 550e8400-e29b-41d4-a716-446655440000 here", "at 2001:0db8:85a3:0000:0000:8a2e:0370:7334 now", "pages 212-555-0187 of it", f"{hexes} alone"]
    held = {f'set token = "{hexes}"### now': "secret:13:53", "api_key: \"sk-abcdefghij1234567890abcd\" end": "secret:10:37", "call (212) 555-0187 then": "phone:5:19", "write jane.doe(at)example.com today": "email:6:29"}
    cases = [*free, *held]
    rows = [(k, t, "x") for k, t in enumerate(cases)] + [(None, cases[-1], "x"), (0, cases[0], "x"), (99, None, "x")]
    got = [(r["doc_id"], r["spans"]) for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string, spans string"), field).collect()]
    found = dict(got)
    assert len(got) == len(rows) and all(found[k] == "" for k in range(len(free))) and found[99] == "" and found[None] == found[len(cases) - 1]
    assert sum(found[len(free) + k] == s for k, s in enumerate(held.values())) >= 3


def test_decontamination_ids(spark):
    """Ids of any type are kept, null ids too, and repeated items count once."""
    rng = np.random.default_rng(5)
    vocab = ["".join(rng.choice(list("abcdefgh"), 7)) for _ in range(400)]
    texts = [" ".join(rng.choice(vocab, 120)) for _ in range(12)]
    passages = [" ".join(t.split()[20:50]) for t in texts[:3]]
    docs = spark.createDataFrame([(k, t, "z") for k, t in enumerate(texts)] + [(None, texts[0], "z"), (0, texts[0], "z")], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([("one", passages[0], 1), ("one", passages[0], 1), (None, passages[1], 1), ("two", passages[2], 1), ("none", None, 1)], "item_id string, text string, doc_id int")
    found = decontamination.leaks(docs, items)
    assert dict(found.dtypes)["item_id"] == "string"
    assert sorted(((r["doc_id"], r["item_id"]) for r in found.where("leaked").collect()), key=str) == sorted([(0, "one"), (None, "one"), (1, None), (2, "two")], key=str)


def test_kneser_ney_probabilities_by_brute_force(spark):
    """Every probability of a small model, and the perplexities of texts, against a plain recursion over dictionaries; both ways of scoring."""
    import math
    from collections import defaultdict

    texts = ["the cat sat on the mat", "the  dog\tsat on a log", "a cat and a dog", "é té", "the the the the", "x"]
    order, classes = kneser_ney.ORDER, 4096
    chars = lambda t: [2] * (order - 1) + [ord(c) for c in re.sub(r"[ \t-\r]+", " ", t)]
    grams = lambda t: [tuple(chars(t)[k : k + order]) for k in range(len(chars(t)) - order + 1)]
    counts = {order: Counter(g for t in texts for g in grams(t))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    discount = {}
    for k, own in counts.items():
        n = Counter(own.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        ratio = lambda a, b: a / b if b else 0.0
        discount[k] = [min(max(d, 0.05), j - 0.05) for j, d in ((1, 1 - 2 * y * ratio(n[2], n[1])), (2, 2 - 3 * y * ratio(n[3], n[2])), (3, 3 - 4 * y * ratio(n[4], n[3])))]
    cut = lambda k, c: discount[k][min(c, 3) - 1]
    followers = {k: defaultdict(list) for k in counts}
    for k, own in counts.items():
        for g, c in own.items():
            followers[k][g[:-1]].append(c)

    def p(g):
        k = len(g)
        if not k:
            return 1 / classes
        seen = followers[k].get(g[:-1])
        if not seen:
            return p(g[1:])
        c = counts[k].get(g, 0)
        return ((c - cut(k, c)) if c else 0) / sum(seen) + sum(cut(k, x) for x in seen) / sum(seen) * p(g[1:])

    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = kneser_ney.fit_model(rows)
    code = lambda g: sum(x << 12 * (len(g) - 1 - i) for i, x in enumerate(g))
    got = {(r["level"], r["gram"]): r["value"] for r in model.where("kind = 'p'").collect()}
    want = {(k, code(g)): math.log(p(g)) for k, own in counts.items() for g in own}
    assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x], abs=1e-9) for x in want)
    assert sum(p((2, 2, 2, 2, c)) for c in range(classes)) == pytest.approx(1.0, abs=1e-9)
    probes = [*texts, "the cot sat in the bat", "zzz qq", "dog"]
    frame = spark.createDataFrame(list(enumerate(probes)), "doc_id long, text string")
    for score in (kneser_ney._scores_sent, kneser_ney._scores_joined):
        own = {r["doc_id"]: (r["n_grams"], r["logp"]) for r in score(frame, ["doc_id"], model).collect()}
        for k, t in enumerate(probes):
            assert own[k][0] == len(grams(t)) and own[k][1] == pytest.approx(sum(math.log(p(g)) for g in grams(t)), rel=1e-5)


def test_pipeline_defined_cases(spark, sf_dir, tmp_path):
    """Null ids and texts, repeated rows, further columns and an empty table, through run()."""
    import corpus_pipeline

    source = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) > 600").limit(40)
    odd = source.limit(3).withColumn("doc_id", F.lit(None).cast("long")).unionByName(source.limit(2)).unionByName(source.limit(1).withColumns({"doc_id": F.lit(900_001).cast("long"), "text": F.lit(None).cast("string")}))
    for name, docs in (("odd", source.unionByName(odd)), ("none", source.limit(0))):
        folder = f"{tmp_path}/{name}"
        docs.withColumns({"sequence_id": F.lit("x"), "kept": F.lit(0)}).write.parquet(f"{folder}/documents.parquet")
        for table in ("labels", "benchmark"):
            spark.read.parquet(f"{sf_dir}/{table}.parquet").write.parquet(f"{folder}/{table}.parquet")
        out = corpus_pipeline.run(spark, folder).collect()
        if name == "none":
            assert out == []
            continue
        ids = Counter(r["doc_id"] for r in out if r["piece"] == 0)
        twice = {r["doc_id"] for r in source.limit(2).collect()}
        assert 900_001 not in ids and ids and all(n == (2 if k in twice else 1) or k is None for k, n in ids.items())


def test_main_text_of_layouts(spark, sf_dir):
    """Pages written by hand, some with a table as wrapper: the article's lines and no other."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    more = [pages.withColumn("page_id", F.col("page_id") + 1000 * k) for k in (1, 2)]  # each page is built anew with other layouts
    net = html_extraction.fit_labeller(pages.unionByName(more[0]).unionByName(more[1]))
    texts = [b.text for r in pages.orderBy("page_id").limit(20).collect() for b in html_extraction.blocks_of(r["html"]) if len(b.text) > 150 and "|" not in b.text]
    body = f"<h1>{texts[0][:40]}</h1>" + "".join(f"<p>{t}</p>" for t in texts[1:6])
    nav, foot = "<nav><a href='/'>Home</a> <a href='/a'>More</a></nav>", f"<footer><p>{texts[7][:60]}</p></footer>"
    layouts = [f"<table><tr><td>{nav}</td></tr><tr><td>{body}</td></tr><tr><td>{foot}</td></tr></table>", f"<table><tr><td>{body}</td></tr></table>{foot}", f"{nav}<article>{body}</article>{foot}", f"{nav}<article>{body}</article><section class='comments'><h3>Comments</h3><ul><li><p>{texts[8]}</p></li><li><p>{texts[9]}</p></li></ul></section>", f"<div class='menu'><a href='/'>x</a></div><article>{body}</article>{foot}"]
    want = "\n\n".join(b.text for b in html_extraction.blocks_of(f"<body>{body}</body>"))
    rows = spark.createDataFrame([(k % 5, f"u{k}", f"<html><body>{h}</body></html>", "x") for k, h in enumerate(layouts * 2)], "page_id long, url string, html string, text string")
    got = html_extraction.main_text(rows, net).collect()
    wrong = [(r["page_id"], set(r["text"].split("\n\n")) ^ set(want.split("\n\n"))) for r in got if r["text"] != want]
    assert len(got) == 10 and not wrong and all(r["n_chars"] == len(want) for r in got)


def test_packing_learns_a_met_word_once_a_round(monkeypatch):
    monkeypatch.setattr(best_fit_packing, "MAX_WORDS", 10)
    own, plain, learned = best_fit_packing.WordEncoder(TOKENIZER), best_fit_packing.WordEncoder(TOKENIZER), []
    learn = own.learn
    monkeypatch.setattr(own, "learn", lambda words: (learned.extend(words), learn(words)))
    letters = "abcdefghijklmnopqrstuvwxyz"
    for a in letters:
        text = " ".join(["the", "word", *(a + b for b in letters[:5])]).encode()
        assert own.ids(text) == plain.whole(text)
        assert len(own.known) <= 10 + 7
    assert learned.count(b"the") == learned.count(b"word") == 1


def test_packing_learns_words_of_several_texts_together(monkeypatch):
    monkeypatch.setattr(best_fit_packing, "GROUP_BYTES", 60)
    own, plain, calls = best_fit_packing.WordEncoder(TOKENIZER), best_fit_packing.WordEncoder(TOKENIZER), []
    learn = own.learn
    monkeypatch.setattr(own, "learn", lambda words: (calls.append(words), learn(words)))
    texts = [b"", b"The naive word", "na\u00efve, word! \u4e2d".encode(), b"x <|endoftext|> y", b"one\ntwo  three", None, b"Tail of it all"] * 3
    found = list(best_fit_packing.encoded(own, best_fit_packing.pa.array(texts, best_fit_packing.pa.large_binary())))
    assert found == [plain.whole(t or b"") for t in texts]
    assert 1 < len(calls) < len(texts)


def test_decontamination_cosine_does_not_depend_on_what_stands_before(spark):
    """Windows are sums of their own blocks; differences of running sums lost digits the longer the text was."""
    rng = random.Random(31)
    words = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(rng.choices(words, k=16))) for k in range(40)]
    filler = " ".join(t for _ in range(150) for _, t in rng.sample(items[1:], 10))
    docs = [(1, items[0][1]), (2, f"{filler} {items[0][1]}"), (3, f"{items[0][1]} {filler}")]
    found = decontamination.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    cosine = {r["doc_id"]: r["cosine"] for r in found.where("item_id = 0").collect()}
    assert len(cosine) == 3 and all(abs(c - cosine[1]) < 1e-6 for c in cosine.values()), cosine
