"""Corpus operators on tables: brute force on small ones, odd rows, empty tables, clashing columns."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from frameloom.llm import ann, bloom, decontam, line_dedup, mixing, near_dedup, queries, secrets, substring_dedup, token_output, toxicity, warc

SF = "/root/testdata/sf0.001"
EXTRA = ["nk", "h", "root", "keep", "tokens", "position", "epoch", "label_id", "words", "score", "f_nk", "f_small", "block", "dim", "url_key", "part", "value", "low", "offset", "times", "within", "pieces", "s", "e", "y", "ss", "sp", "keep_0", "Text2", "a.b", "c0", "row", "hits", "nk2", "of`f"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{k}" for k in range(40_000))
ROWS = [(1, "one two three\nfour", "en", "a", 3), (1, "one two three\nfour", "en", "a", 3), (None, "one two three\nfour", "en", None, None), (2, None, None, None, None), (3, "", "", "", 0), (4, LONG, "en", "a", 1), (5, LONG, "en", "b", 1), (6, 'token = "k3J9xQ0zLm2VtR8s"', "en", "b", 1), (7, " \n\t", "en", "b", 1), (None, None, None, None, None)]


def with_extra(df):
    return df.select("*", *(F.lit(1).alias(c) for c in EXTRA if c not in df.columns))


@pytest.fixture(scope="module")
def odd(spark):
    return with_extra(spark.createDataFrame(ROWS, DOCS))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, 1), (4, 1, 0), (None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(100, 130))), (2, None), (None, "x"), (3, "too short")], "item_id long, text string")


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (None, [1.0, 1.0]), (3, None), (4, []), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [1.0, 2.0, 3.0]), (8, [1.0, 0.0])]
    return with_extra(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "http://www.a.com/x/", "p"), (2, "https://A.com/x?utm_source=q", "p"), (2, "https://A.com/x?utm_source=q", "p"), (3, None, None), (None, "http://b.org:8080/?b=1&a=2#t", "q"), (4, "no url", ""), (5, "http://a.com/x", "z" * 300_000)]
    return with_extra(spark.createDataFrame(rows, "page_id long, url string, html string"))


def operators(odd, labels, benchmark, vectors, pages):
    return {
        1: lambda e: secrets.scan(e(odd)),
        2: lambda e: line_dedup.dedup_lines(e(odd)),
        3: lambda e: mixing.training_positions(e(odd)),
        4: lambda e: warc.capture_histories(e(pages)),
        5: lambda e: near_dedup.near_duplicate_groups(e(odd)),
        6: lambda e: token_output.packed_tokens(e(odd)),
        7: lambda e: ann.neighbours(e(vectors)),
        8: lambda e: substring_dedup.exact_repeats(e(odd)),
        9: lambda e: toxicity.score_documents(e(odd), labels),
        10: lambda e: decontam.contamination(e(odd), benchmark),
    }


@pytest.mark.parametrize("n", range(1, 11))
def test_empty_tables(odd, labels, benchmark, vectors, pages, n):
    assert operators(odd, labels, benchmark, vectors, pages)[n](lambda df: df.where("false")).count() == 0


@pytest.mark.parametrize("n", range(1, 11))
def test_odd_rows(odd, labels, benchmark, vectors, pages, n):
    rows = operators(odd, labels, benchmark, vectors, pages)[n](lambda df: df).collect()
    got = sorted(tuple(map(str, r)) for r in rows)
    if n == 1:
        assert [(r["doc_id"], r["value"], r["secret"], r["start"]) for r in rows] == [(6, "k3J9xQ0zLm2VtR8s", True, 9)]
    if n == 2:
        text = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in rows if r["doc_id"]}
        assert text[1] == ("one two three\nfour", 2, 0) and text[2] == (None, 0, 0) and text[3] == ("", 1, 0) and text[5] == ("", 1, 1) and text[7] == (" \n\t", 2, 0)
        assert len(rows) == 10 and ("None", "", "2", "2") in got
    if n == 3:
        assert {r["doc_id"] for r in rows} == {1, 2, 3, 4, 5, 6, 7, None} and len([r for r in rows if r["epoch"] == 0]) == 10
    if n == 4:
        keys = [r["url_key"] for r in rows]
        assert keys == sorted(keys) and keys.count("com,a)/x") == 4 and "org,b:8080)/?a=2&b=1" in keys and keys[0] == ""
        assert [(r["capture_no"], r["revisit"]) for r in rows if r["url_key"] == "com,a)/x"] == [(1, False), (2, True), (3, True), (4, False)]
    if n == 5:
        assert {(r["doc_id"], r["group_id"], r["group_size"], r["keep"]) for r in rows} >= {(1, 1, 3, True), (None, 1, 3, False), (4, 4, 2, True), (5, 4, 2, False)}
        assert {r["doc_id"] for r in rows} == {1, None, 4, 5}
    if n == 6:
        assert len(rows) == 10 and all((r["n_tokens"] is None) == (r["doc_id"] in (2, None) and not r["words"]) for r in rows)
    if n == 7:
        assert [(r["neighbour_id"], r["distance"]) for r in sorted(rows, key=lambda r: r["rank"]) if r["vec_id"] == 1] == [(8, 0.0), (None, 1.0), (2, 2**0.5)]
        assert len(rows) == 12
    if n == 8:
        assert {(r["doc_id"], r["ref_doc_id"], r["n_words"]) for r in rows} == {(5, 4, 40_000)}
    if n == 9:
        assert len(rows) == 10 and not any(r["toxic"] for r in rows)
    if n == 10:
        assert sorted((r["doc_id"], r["item_id"], r["n_words"]) for r in rows) == [(4, 1, 30), (5, 1, 30)]


def test_line_dedup_brute_force_and_shuffle(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen, want = set(), {}
    for r in docs.orderBy("doc_id").collect():
        kept = []
        for line in r["text"].split("\n"):
            if not line.strip(" \t\r\f\v") or line not in seen:
                kept.append(line)
            seen.add(line)
        want[r["doc_id"]] = "\n".join(kept)
    assert {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs).collect()} == want
    for how in ({"limit": 0}, {"drops_limit": 0}, {"limit": 0, "drops_limit": 0}):
        assert {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs, **how).collect()} == want


def passages(texts, least):
    """(doc, first word, last word + 1, ref doc, ref word) by definition, from lists of words in the order of their documents."""
    first, out = {}, []
    for d, t in enumerate(texts):
        before, last = None, {}
        for p in range(len(t) - least + 1):
            run = tuple(t[p : p + least])
            again = p - last.get(run, -(10**9)) <= least
            last[run] = p
            ref = first.setdefault(run, (d, p))
            if ref == (d, p):
                before = None
                continue
            if before and (again or ref == (before[0], before[1] + 1)):
                out[-1][2] = p + least
            else:
                out.append([d, p, p + least, *ref])
            before = ref
    return {tuple(x) for x in out}


@pytest.mark.parametrize("limit", [substring_dedup.FILTER_BYTES, 0])
def test_repeats_brute_force(spark, limit):
    """Common phrases inside of longer passages, passages that end differently, words and phrases that go on for long."""
    r = np.random.default_rng(31)
    q = [f"q{k}" for k in range(25)]
    passage = [f"a{k}" for k in range(13)] + q + [f"b{k}" for k in range(22)]
    texts = [q + ["x"] * 90, [f"y{k}" for k in range(12)] + passage, ["z"] * 7 + passage, ["x"] * 300, ["u", "v", "w"] * 60, ["v", "w", "u"] * 50 + passage]
    shared, small = [f"s{k}" for k in range(60)], [f"s{k}" for k in range(6)]
    for d in range(40):
        own = [f"o{d}_{k}" for k in range(int(r.integers(0, 30)))]
        a, b = sorted(r.integers(0, 61, 2).tolist())
        texts.append(own + shared[a:b] + own[:3] + shared[:a] + [f"l{r.integers(3)}_{k}" for k in range(int(r.integers(0, 8)))][::-1] + small + [f"m{r.integers(3)}_{k}" for k in range(3)] + small[: int(r.integers(0, 6))])
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    start = {k: {m.start(): i for i, m in enumerate(re.finditer(r"\S+", " ".join(t)))} for k, t in enumerate(texts)}
    end = {k: {m.end(): i + 1 for i, m in enumerate(re.finditer(r"\S+", " ".join(t)))} for k, t in enumerate(texts)}
    for least in (50, 8):
        rows = substring_dedup.exact_repeats(docs, least, limit).collect()
        got = [(x["doc_id"], start[x["doc_id"]][x["start"]], end[x["doc_id"]][x["end"]], x["ref_doc_id"], start[x["ref_doc_id"]][x["ref_start"]]) for x in rows]
        assert len(got) == len(set(got)) and set(got) == passages(texts, least)
        assert all(x["n_words"] == g[2] - g[1] for x, g in zip(rows, got))


def test_repeats_in_segments_brute_force(spark):
    """Rare, crowded and frequent runs in batches of few segments; words and gaps that are longer than a segment's steps."""
    r = np.random.default_rng(8)
    texts = [[f"o{d}_{k}" for k in range(int(r.integers(0, 20)))] for d in range(240)]
    put = lambda d, words: texts[d].extend([*words, f"e{d}_{len(texts[d])}"])
    for p in range(400):
        words = [f"p{p}_{k}" * (60 if r.random() < 0.02 else 1) for k in range(150)]
        a, b = r.choice(240, 2, replace=False)
        put(a, words), put(b, words[int(r.integers(0, 40)) :])
    shared, often = [f"s{k}" for k in range(30)], [f"f{k}" for k in range(70)]
    for p in range(12):
        left, right = ([f"{x}{p}_{k}" for k in range(40)] for x in "lr")
        for d in r.choice(240, 2, replace=False):
            put(d, left + shared + right)
    for d in r.choice(240, 100, replace=False):
        put(d, often)
    joined = [" ".join(w + " " * (300 * int(r.random() < 0.01)) for w in t) for t in texts]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(joined)], "doc_id long, text string")
    start = [{m.start(): i for i, m in enumerate(re.finditer(r"\S+", t))} for t in joined]
    end = [{m.end(): i + 1 for i, m in enumerate(re.finditer(r"\S+", t))} for t in joined]
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, 3)
    try:
        rows = substring_dedup.exact_repeats(docs).collect()
    finally:
        spark.conf.set(size, before)
    got = {(x["doc_id"], start[x["doc_id"]][x["start"]], end[x["doc_id"]][x["end"]], x["ref_doc_id"], start[x["ref_doc_id"]][x["ref_start"]]) for x in rows}
    assert len(rows) == len(got) and got == passages(texts, 50)


def test_repeats_shuffle_little(spark):
    """Near copies: less is shuffled than three times their text, which one row for each run would exceed."""
    r = np.random.default_rng(12)
    rows = []
    for d in range(300):
        words = [f"{x:x}" for x in r.integers(1 << 16, 1 << 22, 2000).tolist()]
        rows.append((2 * d, " ".join(words)))
        words[1000] = "other"
        rows.append((2 * d + 1, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    context = spark.sparkContext._jsc.sc()

    def written():
        context.listenerBus().waitUntilEmpty()
        found = context.statusStore().executorList(False)
        return sum(found.apply(k).totalShuffleWrite() for k in range(found.size()))

    before = written()
    got = substring_dedup.exact_repeats(docs).collect()
    assert len(got) == 600 and (written() - before) < 3 * sum(len(t) for _, t in rows)


def test_frequent_runs_are_looked_up(spark):
    passage = " ".join(f"p{k}" for k in range(55))
    rows = [(k, f"{passage} {' '.join(f'o{k}_{j}' for j in range(30))}" if k % 3 == 0 else " ".join(f"o{k}_{j}" for j in range(85))) for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, often = substring_dedup.repeated_runs(docs.withColumn("nk", F.col("doc_id")), 50, substring_dedup.FILTER_BYTES)
    assert often.count() == 6
    got = {(r["doc_id"], r["n_words"], r["ref_doc_id"]) for r in substring_dedup.exact_repeats(docs).collect()}
    assert got == {(k, 55, 0) for k in range(3, 900, 3)}


def test_one_word_that_goes_on_is_one_passage(spark):
    docs = spark.createDataFrame([(1, "go " * 20_000), (2, "go " * 20_000)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["n_words"], r["ref_doc_id"], r["ref_start"]) for r in substring_dedup.exact_repeats(docs).collect()) == [(1, 19_999, 1, 0), (2, 20_000, 1, 0)]


def test_sharded_filters_lose_nothing(spark):
    """A hash that a third of all rows have, many shards, and hashes that only a probe shares with a block."""
    r = np.random.default_rng(9)
    rows = [(int(h), int(k), bool(i)) for k, (h, i) in enumerate(zip(r.integers(-(2**40), 2**40, 4000), r.random(4000) < 0.3))] + [(77, 5000 + k, k % 2 == 0) for k in range(2000)] + [(k, 8000 + k, True) for k in range(20)] + [(k, 9000 + k, False) for k in range(20)] + [(-5, 9900 + k, True) for k in range(2)]
    df = spark.createDataFrame(rows, "h long, row long, index boolean")
    got = {x["row"] for x in bloom.sharded(df, 2400, per_shard=100).collect()}
    assert set(range(5000, 7000)) | set(range(8000, 8020)) | set(range(9000, 9020)) | {9900, 9901} <= got and len(got) < 2300


def test_decontamination_brute_force(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    simple = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    runs = [(i["item_id"], w[k : k + decontam.WINDOW]) for i in items.collect() for w in [simple(i["text"]).split()] if len(w) >= decontam.MIN_WORDS for k in range(max(1, len(w) - decontam.WINDOW + 1))]
    want = {(d["doc_id"], i) for d in docs.collect() for t in [simple(d["text"])] for i, w in runs if f" {' '.join(w)} " in t}
    rows = decontam.contamination(docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == want
    text = {d["doc_id"]: d["text"] for d in docs.collect()}
    assert all(text[r["doc_id"]][r["start"] : r["end"]] == r["text"] for r in rows)


def test_benchmarks_in_one_session_are_kept_apart(spark):
    a, z, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "azc")
    b = " ".join(f"b{k}" for k in range(30))
    docs = spark.createDataFrame([(1, f"so {a} end"), (2, f"{z}"), (3, f"{b} {z}")], "doc_id long, text string")
    for items, want in (([(1, a), (2, b), (3, c)], {(1, 1), (3, 2)}), ([(7, a), (8, z), (9, c)], {(1, 7), (2, 8), (3, 8)}), ([(7, a), (7, b), (8, z)], {(1, 7), (2, 8), (3, 7), (3, 8)})):
        table = spark.createDataFrame(items, "item_id long, text string")
        for limit in (decontam.AUTOMATON_BYTES, 20_000):
            rows = decontam.contamination(docs, table, limit=limit).collect()
            assert {(r["doc_id"], r["item_id"]) for r in rows} == want and all(r["n_words"] == 30 for r in rows)
            assert {r["doc_id"] for r in decontam.without_benchmark(docs, table, limit=limit).collect()} == {1, 2, 3} - {x for x, _ in want}


def test_secret_scan_brute_force(spark):
    """Candidates, word costs and guesses by plain Python; values in repeated rows, long values, long words and no values at all."""
    import math

    from tests.llm.test_methods import cheapest

    long = "abcdefghijklmnopqrstuvwxyzxyz"
    rows = [(1, 'password = "zebra77"\nzebra zebra horse'), (1, 'password = "zebra77"\nzebra zebra horse'), (2, "horse horse tiger zebra"), (3, f"token: {long}9 and {long} {long}"), (4, "Secret='K7#horse'"), (None, "pwd:aaaaaaaa"), (5, None), (6, ""), (7, "nothing here"), (8, f"api_key={'9f' * 3000}")]
    docs = with_extra(spark.createDataFrame(rows, "doc_id long, text string"))
    got = secrets.scan(docs).collect()
    assert sorted((str(r["doc_id"]), r["keyword"], r["value"]) for r in got) == sorted([("1", "password", "zebra77"), ("1", "password", "zebra77"), ("3", "token", f"{long}9"), ("4", "secret", "K7#horse"), ("None", "pwd", "aaaaaaaa"), ("8", "api_key", "9f" * 3000)])
    # words outside of values: zebra 2+2+1, horse 1+1+2, tiger, and, the long word twice, nothing here
    outside = ["zebra"] * 5 + ["horse"] * 4 + ["tiger", "and", long, long, "nothing", "here"]
    cost = {w: math.log2(len(outside) / outside.count(w)) for w in set(outside)} | {w: math.log2(k + 2) for k, w in enumerate(secrets.USUAL)}
    import tests.llm.test_methods as methods

    old, methods.WORDS = methods.WORDS, cost
    try:
        bits = {r["value"]: r["bits"] for r in got}
        assert math.isclose(bits["zebra77"], cheapest("zebra77"), abs_tol=1e-9) and math.isclose(bits["K7#horse"], cheapest("K7#horse"), abs_tol=1e-9) and math.isclose(bits["aaaaaaaa"], cheapest("aaaaaaaa"), abs_tol=1e-9)
    finally:
        methods.WORDS = old
    assert math.isclose(bits[f"{long}9"], cost[long] + secrets.SEGMENT_BITS + secrets.char_bits("9")) and [r["secret"] for r in got if r["doc_id"] == 8] == [False]
    assert sorted(map(str, secrets.scan(docs, limit=0).collect())) == sorted(map(str, got))
    assert secrets.scan(docs.where("doc_id = 7")).count() == 0


def brute_lexicon(texts, bad, good):
    """Polarities by word from counts, pointwise information and a dense walk, in plain Python."""
    import math

    seeds = bad + good
    docs = [re.findall(r"[a-z0-9]+", t.lower()) for t in texts]
    around = lambda d, i: tuple(d[j] if 0 <= j < len(d) else None for j in range(i - toxicity.BESIDE, i + toxicity.BESIDE + 1))
    times = {}
    for d in docs:
        for i, w in enumerate(d):
            if w in seeds:
                times[around(d, i)] = times.get(around(d, i), 0) + 1
    n, own, pair, total = {}, {}, {}, 0
    for d in docs:
        for a in range(0, len(d), toxicity.CHUNK):
            chunk, total = set(d[a : a + toxicity.CHUNK]), total + 1
            for w in chunk:
                n[w] = n.get(w, 0) + 1
            for s in chunk & set(seeds):
                weight = max(1 / times[around(d, i)] for i in range(a, min(len(d), a + toxicity.CHUNK)) if d[i] == s)
                own[s] = own.get(s, 0) + weight
                for w in chunk - {s}:
                    pair[w, s] = pair.get((w, s), 0) + weight
    expected = {(w, s): own[s] * n[w] / total for w, s in pair}
    usual = {s: sum(x * math.log(x / expected[k]) for k, x in pair.items() if k[1] == s) / sum(x for k, x in pair.items() if k[1] == s) for s in seeds if any(k[1] == s for k in pair)}
    edge = {}
    for (w, s), x in pair.items():
        e = expected[w, s] * math.exp(usual[s])
        if x >= toxicity.MIN_SUPPORT - 1e-9 and x >= e + toxicity.CHANCE * math.sqrt(e + 1):
            edge[w, s] = math.log(x / e)
    words = sorted({w for w, _ in edge})
    a = np.array([[edge.get((w, s), 0.0) for s in seeds] for w in words]).reshape(len(words), len(seeds))
    rows, degree = a.sum(0), a.sum(1)
    visits = []
    for part, start in ((bad, 0), (good, len(bad))):
        begin = np.zeros(len(seeds))
        begin[start : start + len(part)] = 1 / len(part)
        p = begin.copy()
        for _ in range(500):
            word = a @ np.divide(p, rows, out=np.zeros_like(p), where=rows > 0)
            p = (1 - toxicity.RESTART) * (a.T @ (word / degree)) + toxicity.RESTART * begin
            p /= p.sum()
        visits.append(a @ np.divide(p, rows, out=np.zeros_like(p), where=rows > 0))
    both = visits[0] + visits[1]
    some = np.sort(both[both > 0])
    base = some[-(-len(some) // 2) - 1]
    weight = {w: (x - y) / (x + y + base) for w, x, y in zip(words, *visits) if x + y > 0}
    return {w: v for w, v in weight.items() if v >= toxicity.POLARITY and w not in bad} | {w: 1.0 for w in bad}


@pytest.mark.parametrize("how", [{}, {"gram_seeds": 0, "copies_limit": 0}])
def test_lexicon_brute_force(spark, how):
    r = np.random.default_rng(17)
    common, slurs, hints = [f"c{k}" for k in range(60)], ["vile", "foul", "nasty"], ["grim", "dire"]
    rows, marks = [], []
    for d in range(400):
        toxic = d % 4 == 0
        words = r.choice(common, 30).tolist()
        if toxic:
            words[5:5] = [str(r.choice(slurs)), str(r.choice(hints)), str(r.choice(slurs))]
        rows.append((d, " ".join(words)))
        marks.append((d, int(toxic)))
    rows += [(1000 + k, rows[3][1] + " vile thing") for k in range(50)]  # one clean text in many copies
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    text = {t: int(toxicity.words(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[1][0]) for t in {w for _, x in rows for w in x.split()}}
    name = {h: t for t, h in text.items()}
    bad, good = toxicity.seed_terms(toxicity.labelled(docs, labels))
    lexicon = toxicity.induce(docs, labels, **how)
    want = brute_lexicon([t for _, t in rows], [name[h] for h in bad.tolist()], [name[h] for h in good.tolist()])
    got = dict(zip((name[h] for h in lexicon.terms.tolist()), lexicon.weights.tolist()))
    assert set(slurs) <= set(want) and got.keys() == want.keys() and all(abs(got[w] - want[w]) < 1e-6 for w in want)
    joined = {x["doc_id"]: x["toxic"] for x in toxicity.score_documents(docs, labels, limit=0).collect()}
    assert joined == {x["doc_id"]: x["toxic"] for x in toxicity.score_documents(docs, labels).collect()}


def near_roots(texts):
    """The least number of each text's component, from all pairs of the whole signatures."""
    n = len(texts)
    offs = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    rows, elements = near_dedup.shingles(np.frombuffer("".join(texts).lower().encode(), np.uint8), offs)
    some = np.unique(rows)
    sig = np.zeros((n, near_dedup.SLOTS), np.uint16)
    sig[some] = near_dedup.tv.mix(near_dedup.superminhash(np.searchsorted(some, rows), elements, len(some)).astype(np.uint64)).astype(np.uint16)
    root = list(range(n))
    for x, i in enumerate(some.tolist()):
        rest = some[x + 1 :]
        equal = sig[i] == sig[rest]
        banded = equal.reshape(len(rest), near_dedup.SLOTS // near_dedup.ROWS, near_dedup.ROWS).all(2).any(1)
        for j in rest[banded & (near_dedup.similarity(sig[i], sig[rest]) >= near_dedup.THRESHOLD)].tolist():
            if root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = [a if y == b else y for y in root]
    return root


def test_near_duplicates_of_a_whole_table_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()
    root = near_roots([d["text"] for d in docs])
    want = {(docs[k]["doc_id"], docs[x]["doc_id"]) for k, x in enumerate(root) if root.count(x) > 1}
    rows = near_dedup.near_duplicate_groups(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    assert {(x["doc_id"], x["group_id"]) for x in rows} == want and len(want) > 50


def test_a_large_bucket_with_nulls_and_repeated_rows(spark):
    base = " ".join(f"b{k}" for k in range(80))
    rows = [(k, f"{base} end{k}", f"s{k}") for k in range(300)] + [(None, base, "x"), (None, base, None), (7, f"{base} end7", "other"), (8, None, None), (8, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = near_dedup.near_duplicate_groups(docs, block=64).collect()
    assert {x["group_id"] for x in got if x["doc_id"] != 8} == {0} and {x["group_size"] for x in got if x["doc_id"] != 8} == {303} and [x["copies"] for x in got if x["doc_id"] == 7] == [2]
    kept = near_dedup.keep_one_of_each(docs).collect()
    assert sorted((x["doc_id"], x["source"]) for x in kept) == [(0, "s0"), (8, None)]
    assert sorted(map(str, near_dedup.keep_one_of_each(docs.repartition(3), limit=0).collect())) == sorted(map(str, kept))


def test_near_duplicates_are_found_and_others_left(spark):
    r = np.random.default_rng(7)
    rows = []
    for k in range(40):
        words = [f"x{v}" for v in r.integers(0, 5000, 120)]
        near = list(words)
        near[60] = "changed"
        rows += [(3 * k, " ".join(words)), (3 * k + 1, " ".join(near)), (3 * k + 2, " ".join(f"y{v}" for v in r.integers(0, 5000, 120)))]
    got = near_dedup.near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(x["doc_id"], x["group_id"]) for x in got} == {(3 * k + j, 3 * k) for k in range(40) for j in (0, 1)}


def test_near_duplicates_of_divergent_copies_against_all_pairs(spark):
    """Large groups whose copies differ from their base by other edits each, all from one template."""
    r = np.random.default_rng(23)
    template, texts = [f"t{v}" for v in range(120)], []
    for g in range(20):
        base = list(template)
        for p in r.choice(120, 9, False):
            base[p] = f"g{g}_{p}"
        for k in range(20):
            copy = list(base)
            for p in r.choice(120, 9 if k else 0, False):
                copy[p] = f"c{g}_{k}_{p}"
            texts.append(" ".join(copy))
    root = near_roots(texts)
    want = {(k, x) for k, x in enumerate(root) if root.count(x) > 1}
    for block in (near_dedup.BLOCK, 16):
        got = near_dedup.near_duplicate_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), block=block).collect()
        assert {(x["doc_id"], x["group_id"]) for x in got} == want


def test_tokens_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    enc = token_output.encoder()
    text = {d["doc_id"]: d["text"] for d in docs.collect()}
    for r in token_output.packed_tokens(docs).collect():
        ids = token_output.decode(np.frombuffer(r["words"], "<u8"), r["n_tokens"], np.array(r["block_offsets"]))
        assert enc.decode(ids.astype(np.int64).tolist()) == text[r["doc_id"]]


def test_toxicity_of_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    fitted = labels.where("doc_id % 2 = 0")
    scored = toxicity.score_documents(docs, fitted).join(labels.where("doc_id % 2 = 1").select("doc_id", F.col("toxic").alias("truth")), "doc_id")
    c = {(r["toxic"], r["truth"]): r["count"] for r in scored.groupBy("toxic", "truth").count().collect()}
    hit = c.get((True, 1), 0)
    assert hit / max(1, hit + c.get((False, 1), 0)) > 0.8 and hit / max(1, hit + c.get((True, 0), 0)) > 0.8


def test_neighbours_of_a_table_in_many_blocks(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    x = np.array([r["embedding"] for r in df.orderBy("vec_id").collect()], np.float32).astype(float)
    far = np.round(((x[:, None] - x[None]) ** 2).sum(-1), ann.DECIMALS)
    np.fill_diagonal(far, np.inf)
    want = {(i, r + 1): j for i in range(len(x)) for r, j in enumerate(np.lexsort((np.arange(len(x)), far[i]))[:10].tolist())}
    got = ann.neighbours(df, block_bytes=20_000, query_bytes=30_000, blocks_per_task=2).collect()
    assert {(r["vec_id"], r["rank"]): r["neighbour_id"] for r in got} == want
    some = ann.neighbours(df, queries=F.col("vec_id") % 100 == 0, block_bytes=20_000, blocks_per_task=3).collect()
    assert {(r["vec_id"], r["rank"]): r["neighbour_id"] for r in some} == {k: v for k, v in want.items() if k[0] % 100 == 0}


def test_histories_across_partitions(spark):
    rows = [(k, f"http://a.com/{k % 2}", str(k // 6)) for k in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = warc.capture_histories(df, run_bytes=1, merge_rows=7).collect()
    assert [(r["url_key"], r["capture_no"], r["page_id"]) for r in got] == [(f"com,a)/{j}", n + 1, 2 * n + j) for j in (0, 1) for n in range(30)]
    assert all(r["seconds_since"] == (2 if r["capture_no"] > 1 else None) and r["revisit"] == (r["capture_no"] % 3 != 1) for r in got)


def test_mixing_meets_the_weights(spark):
    docs = spark.createDataFrame([(k, "a" if k % 2 else "b", "x" * 400) for k in range(400)], "doc_id long, source string, text string")
    got = mixing.training_positions(docs, {"a": [(0, 1.0), (1, 0.0)], "b": [(0, 0.0), (1, 1.0)]}, budget=20_000).collect()
    early = [r["source"] for r in got if r["position"] < 5000]
    assert abs(early.count("a") / len(early) - 0.875) < 0.05


def test_pipeline_stages(spark, odd, labels, benchmark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity" and len(corpus_pipeline.STAGES) == 5
    out = corpus_pipeline.run(spark, SF)
    kept = {r["doc_id"] for r in out.collect()}
    leaked = {r["doc_id"] for r in decontam.contamination(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert kept and not kept & leaked and kept <= {r["doc_id"] for r in docs.collect()}
    for stage in (lambda d: toxicity.without_toxic(d, labels), near_dedup.keep_one_of_each, lambda d: decontam.without_benchmark(d, benchmark), mixing.curriculum):
        got = stage(odd)
        assert got.columns == odd.columns and got.where("doc_id = 6").count() >= 1
        assert stage(odd.where("false")).count() == 0


def test_pipeline_against_brute_force(spark, tmp_path):
    """Every stage by plain means: lexicon, all pairs, all windows, SQL positions, the tokenizer itself."""
    import duckdb

    import corpus_pipeline

    sf = "/root/testdata/sf0.01"
    docs = {d["doc_id"]: d for d in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    table, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    lexicon = toxicity.induce(table, labels)
    weight = dict(zip(lexicon.terms.tolist(), lexicon.weights.tolist()))
    left = []
    for i in sorted(docs):
        raw = np.frombuffer(docs[i]["text"].lower().encode(), np.uint8)
        if sum(weight.get(h, 0.0) for h in set(toxicity.words(raw, np.array([0, len(raw)]))[1].tolist())) < lexicon.threshold:
            left.append(i)
    root = near_roots([docs[i]["text"] for i in left])
    left = [i for k, i in enumerate(left) if root[k] == k]
    simple = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    runs = [" " + " ".join(w[k : k + 13]) + " " for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() for w in [simple(r["text"]).split()] for k in range(max(1, len(w) - 12))]
    left = [i for i in left if not any(x in t for t in [simple(docs[i]["text"])] for x in runs)]
    spark.createDataFrame([docs[i] for i in left], DOCS).coalesce(1).write.parquet(f"{tmp_path}/left")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/left/*.parquet'")
    placed = con.execute(f"SELECT doc_id FROM ({mixing.POSITIONS_SQL}) ORDER BY position, source, doc_id, epoch").fetchall()
    enc, got = token_output.encoder(), corpus_pipeline.run(spark, sf).orderBy("place").collect()
    assert [r["doc_id"] for r in got] == [x for x, in placed] and [r["place"] for r in got] == list(range(len(placed)))
    for r in got[::10]:
        ids = token_output.decode(np.frombuffer(r["words"], "<u8"), r["n_tokens"], np.array(r["block_offsets"]))
        assert ids.tolist() == enc.encode_ordinary(docs[r["doc_id"]]["text"])


def test_pipeline_of_empty_tables(spark, tmp_path):
    import corpus_pipeline

    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/none/{name}.parquet")
        for other in ("unlabelled", "unasked"):
            part = spark.read.parquet(f"{SF}/{name}.parquet")
            (part.where("false") if {"unlabelled": "labels", "unasked": "benchmark"}[other] == name else part).write.parquet(f"{tmp_path}/{other}/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    assert toxicity.score_documents(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{tmp_path}/unlabelled/labels.parquet")).where("toxic OR score <> 0").count() == 0
    assert corpus_pipeline.run(spark, f"{tmp_path}/unlabelled").count() > 0 and corpus_pipeline.run(spark, f"{tmp_path}/unasked").count() > 0


def test_training_order_reaches_the_packed_output(spark, tmp_path):
    """Later files are larger, so Spark reads them first; part 100000 follows part 99999."""
    import corpus_pipeline

    sizes = {"part-00000-x": 3, "part-00002-x": 40, "part-99999-x": 90, "part-100000-x": 200}
    ids = iter(range(1000, 0, -1))
    want = []
    for name, n in sizes.items():
        rows = [(next(ids), "some words " * 30) for _ in range(n)]
        want += [r[0] for r in rows]
        spark.createDataFrame(rows, DOCS.split(", lang")[0]).coalesce(1).write.parquet(f"{tmp_path}/one")
        (found,) = (tmp_path / "one").glob("part-*.parquet")
        found.rename(tmp_path / f"{name}.parquet")
        for left in (tmp_path / "one").iterdir():
            left.unlink()
        (tmp_path / "one").rmdir()
    docs = spark.read.parquet(*(f"{tmp_path}/{name}.parquet" for name in sizes))
    out = corpus_pipeline.pack_tokens(spark, docs, SF)
    assert [(r["place"], r["doc_id"]) for r in out.collect()] == list(enumerate(want))
    out.write.parquet(f"{tmp_path}/out")
    assert [r["doc_id"] for r in spark.read.parquet(f"{tmp_path}/out").orderBy("place").collect()] == want
    assert corpus_pipeline.pack_tokens(spark, docs.where("false"), SF).count() == 0


def test_registry():
    assert set(queries.QUERIES) <= set(entry.queries()) and set(queries.ORACLE_SQL) <= set(entry.oracle_sql()) and "pipeline" in entry.queries()
