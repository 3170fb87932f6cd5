"""The quality classifier against a plain numpy model, on labels and on edge cases."""

import numpy as np
import pytest
from corpus_cases import benchmark, documents, edge, empty, text_rows  # noqa: F401  (fixtures)

from contestry.llm import quality_lm as q

ORDER = 3


def codes(text, order):
    data = np.frombuffer(text.encode(), np.uint8)
    symbols = [q._START] * (order - 1) + q._FOLD[data].tolist()
    return [symbols[i : i + order] for i in range(len(data))]


def plain_model(texts, order):
    """Interpolated modified Kneser-Ney probabilities, by recursion over dictionaries."""
    from collections import Counter, defaultdict

    tables = {order: Counter(tuple(g) for t in texts for g in codes(t, order))}
    for k in range(order - 1, 0, -1):
        before = defaultdict(set)
        for g in tables[k + 1]:
            before[g[1:]].add(g[0])
        tables[k] = Counter({g: len(b) for g, b in before.items()})

    def discount(k):
        n = [0] + [sum(c == i for c in tables[k].values()) for i in (1, 2, 3, 4)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0
        return [0] + [max(q.LEAST_DISCOUNT, i - (i + 1) * y * n[i + 1] / max(n[i], 1)) for i in (1, 2, 3)]

    ds = {k: discount(k) for k in tables}
    contexts = {k: defaultdict(list) for k in tables}
    for k, table in tables.items():
        for g, c in table.items():
            contexts[k][g[:-1]].append(c)

    def p(g):
        k = len(g)
        if k == 0:
            return 1 / q.SYMBOLS
        counts = contexts[k].get(g[:-1])
        if not counts:
            return p(g[1:])
        c = tables[k][g]
        d = lambda c: min(ds[k][min(c, 3)], c)
        return (c - d(c) if c else 0) / sum(counts) + sum(map(d, counts)) / sum(counts) * p(g[1:])

    return p


def test_model_matches_plain_recursion(spark):
    texts = ["the cat sat. on the mat", "a cat, the hat!", "", "Ünder 12 mats"]
    trusted = spark.createDataFrame(
        [(i, t, "en") for i, t in enumerate(texts * 2)] + [(99, None, "en")], "doc_id bigint, text string, lang string"
    )
    halves = {r.doc_id: r.h for r in trusted.select("doc_id", q._half().alias("h")).collect()}
    models = {r.lang: q._Models({"": bytes(r.bits)}).get("") for r in q.tables(q.fit(trusted, ORDER), ORDER).collect()}
    for half in (0, 1):
        own = [t for i, t in enumerate(texts * 2) if halves[i] != half]
        p = plain_model(own, ORDER)
        for g in ((0, 1, 2), (19, 7, 4), (28, 19, 7), (31, 31, 13), (2, 0, 19), (30, 30, 30)):
            code = (g[0] * 32 + g[1]) * 32 + g[2]
            assert models[f"{half} en"][code] == pytest.approx(-np.log2(p(g)), rel=1e-4)
        assert np.exp2(-models[f"{half} en"].reshape(-1, 32).astype(float)).sum(1) == pytest.approx(1, rel=1e-3)


def test_mean_bits_of_a_text(spark):
    docs = spark.createDataFrame([(1, "abc. Abc", "en"), (2, "x", "en"), (3, "", "en")], "doc_id bigint, text string, lang string")
    table = np.random.default_rng(0).random(32**ORDER).astype(np.float32)
    models = spark.createDataFrame([(f"{h} en", bytearray(q.packed(table))) for h in (0, 1)], "lang string, bits binary")
    found = {r.doc_id: (r.n, r.bits) for r in q.scores_by_table(docs, models, ORDER).collect()}
    for i, t in ((1, "abc. Abc"), (2, "x")):
        own = [table[(g[0] * 32 + g[1]) * 32 + g[2]] for g in codes(t, ORDER)]
        assert found[i] == (len(t), pytest.approx(float(np.mean(own))))
    assert found[3] == (0, None)


def test_joins_and_tables_give_the_same_scores(edge, spark, monkeypatch):
    trusted = edge.filter("lang = 'en' OR lang IS NULL").limit(9)
    model = q.fit(trusted, ORDER)
    key = lambda r: (str(r.doc_id), r.lang, r.n, r.bits is None, r.bits or 0)
    by_table = sorted(q.score(edge, model, ORDER).collect(), key=key)
    monkeypatch.setattr(q, "CELLS", 10)
    by_join = sorted(q.score(edge, model, ORDER).collect(), key=key)
    assert len(by_table) == len(by_join) == edge.count()
    for a, b in zip(by_table, by_join):
        assert (a.doc_id, a.lang, a.n) == (b.doc_id, b.lang, b.n)
        assert (a.bits is None and b.bits is None) or a.bits == pytest.approx(b.bits, rel=1e-4)
    assert any(r.bits is not None for r in by_join) and any(r.bits is None and r.n for r in by_join)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_clean_documents_stay_and_junk_goes(spark):
    folder = "/root/testdata/sf0.01"
    docs, given = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = q.classify(docs, given).join(given, "doc_id")
    shares = {r["quality"]: r.kept for r in found.selectExpr("quality", "kept").groupBy("quality").agg({"kept": "count"}).withColumnRenamed("count(kept)", "kept").collect()}
    kept = {r["quality"]: r["count"] for r in found.filter("kept").groupBy("quality").count().collect()}
    assert kept[1] >= 0.98 * shares[1]
    assert kept.get(0, 0) <= 0.2 * shares[0]


def test_thresholds_and_decisions_match_plain_quantiles(spark):
    random = np.random.default_rng(3)
    words = "the cat sat on a mat and then it ran home with its hat".split()
    rows = []
    for i in range(400):
        text = " ".join(random.choice(words, 1 + int(random.pareto(1.0) * 8)))
        rows.append((i, text if i % 8 else text.upper() + "$%" * (i % 5), ("en", "de", None)[i % 3]))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    given = labels(spark, [(i, 1, 0) for i in range(400) if i % 8 and i % 7])
    found = q.classify(docs, given, ORDER, 0.02, 0.97).collect()
    trusted = {r.doc_id for r in given.collect()}
    outside = 0
    for lang in ("", "en", "de"):
        own = [r for r in found if r.lang == lang]
        bits = {r.doc_id: np.log2(r.perplexity) for r in own}
        quantile = lambda v, share: np.floor(np.sort(v)[int(np.ceil(share * len(v))) - 1] * q.BINS)
        middle = quantile(np.array([bits[r.doc_id] for r in own if r.doc_id in trusted]), 0.5) / q.BINS
        deviation = {r.doc_id: (bits[r.doc_id] - middle) * np.sqrt(r.n_bytes) for r in own}
        known = np.array([deviation[r.doc_id] for r in own if r.doc_id in trusted])
        low, high = quantile(known, 0.02) / q.BINS, (quantile(known, 0.97) + 1) / q.BINS
        for r in own:
            assert r.kept == (low <= deviation[r.doc_id] <= high)
            assert np.log2(r.least) == pytest.approx(middle + low / np.sqrt(r.n_bytes))
            assert np.log2(r.most) == pytest.approx(middle + high / np.sqrt(r.n_bytes))
            outside += not r.kept
    assert 20 < outside < 120


def test_large_models_reject_the_same_rows(edge, spark, monkeypatch):
    given = labels(spark, [(i, 1, None) for i in (1, 2, 6, 8, 9, 10)])
    by_table = sorted(map(repr, q.drop_low_quality(edge, given, ORDER, 0.3, 0.7).collect()))
    monkeypatch.setattr(q, "CELLS", 10)
    by_join = q.drop_low_quality(edge, given, ORDER, 0.3, 0.7)
    assert by_join.columns == edge.columns and sorted(map(repr, by_join.collect())) == by_table
    assert len(by_table) < edge.count()


def test_edge_cases(edge, spark):
    given = labels(spark, [(i, 1, None) for i in (1, 2, 6, 8, 9, 10, 999)] + [(1, 1, 0), (None, 1, 0), (7, 0, 0), (17, None, 1)])
    found = q.quality_report(edge, given)
    assert found.count() == edge.count()
    assert found.filter("perplexity IS NULL AND NOT kept").isEmpty()
    assert found.filter("n_bytes = 0 AND perplexity IS NOT NULL").isEmpty()
    kept = q.drop_low_quality(edge, given)
    assert kept.columns == edge.columns
    key = lambda df: sorted(str(r[0]) for r in df.select("doc_id").collect())
    assert key(kept) == key(found.filter("kept"))


def test_without_labels_or_documents(edge, empty, spark):
    none = labels(spark, [])
    assert q.quality_report(edge, none).filter("NOT kept").isEmpty()
    assert q.drop_low_quality(edge, none).count() == edge.count()
    assert q.quality_report(empty, none).isEmpty()
    assert q.drop_low_quality(empty, none).columns == empty.columns


def test_many_languages_go_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(q, "LANGUAGES", 1)
    rows = [(i, "some words here and there " * 3, f"l{i % 5}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    given = labels(spark, [(i, 1, 0) for i in range(40)])
    found = q.quality_report(docs, given)
    assert found.count() == 40 and found.filter("perplexity IS NULL").isEmpty()
    assert q.drop_low_quality(docs, given).count() == found.filter("kept").count()


def test_labels_are_joined_alike_at_any_size(edge, spark):
    given = labels(spark, [(i, 1, None) for i in (1, 2, 2, 6)] + [(7, 0, 0), (8, 1, 1), (None, 1, 0)])
    found = q.trusted_rows(edge, given)
    assert sorted(r.doc_id for r in found.collect()) == sorted(r.doc_id for r in edge.collect() if r.doc_id in (1, 2, 6))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Broadcast" not in plan


def test_texts_without_bytes_have_no_thresholds(spark):
    rows = [(i, "some words here and there " * (1 + i % 3), "en") for i in range(40)] + [(50, "", "en"), (51, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = {r.doc_id: r for r in q.classify(docs, labels(spark, [(i, 1, 0) for i in (*range(40), 50, 51)]), ORDER).collect()}
    assert len(found) == 42 and found[0].least is not None and found[0].most is not None
    for i in (50, 51):
        assert found[i].kept and (found[i].n_bytes, found[i].perplexity, found[i].least, found[i].most) == (0, None, None, None)


def plain_bits(trusted, texts, order):
    """Bits for each byte of texts under a plain byte model of the trusted ones."""
    from collections import Counter

    def own(text):
        symbols = [32] * (order - 1) + list(text.encode())
        return [tuple(symbols[i : i + order]) for i in range(len(text.encode()))]

    tables = {order: Counter(g for t in trusted for g in own(t))}
    for k in range(order - 1, 0, -1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])

    def discount(k):
        n = [0] + [sum(c == i for c in tables[k].values()) for i in (1, 2, 3, 4)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0
        return [0] + [max(q.LEAST_DISCOUNT, i - (i + 1) * y * n[i + 1] / max(n[i], 1)) for i in (1, 2, 3)]

    ds = {k: discount(k) for k in tables}
    contexts = {}
    for table in tables.values():
        for g, c in table.items():
            contexts.setdefault(g[:-1], []).append(c)

    def p(g):
        if not g:
            return 1 / 256
        counts, d = contexts.get(g[:-1]), ds[len(g)]
        if not counts:
            return p(g[1:])
        c = tables[len(g)][g]
        return ((c - d[min(c, 3)]) if c else 0) / sum(counts) + sum(d[min(x, 3)] for x in counts) / sum(counts) * p(g[1:])

    return [-np.mean([np.log2(p(g)) for g in own(t)]) for t in texts]


@pytest.mark.parametrize("chunk", [1 << 25, 64])
def test_registered_model_is_of_whole_bytes(spark, monkeypatch, chunk):
    monkeypatch.setattr(q, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(q, "WAITING", 50)
    monkeypatch.setattr(q, "HELD", 20)
    good = ["the cat sat on 12 mats", "A cat, the Hat! 345", "ünder the Äpfel", "no more than that", "the mat sat on Tom 7"] * 3
    odd = ["THE CAT SAT ON 98 MATS", "a cat, the hat? 777", "ènder the òpfel", "日本 the mat", "x"]
    texts = good + odd
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)] + [(90, "lonely", "xx")], "doc_id bigint, text string, lang string")
    halves = {r.doc_id: r.h for r in docs.select("doc_id", q._half().alias("h")).collect()}
    found = {r.doc_id: r for r in q.classify(docs, labels(spark, [(i, 1, 0) for i in range(len(good))])).collect()}
    assert len(found) == len(texts) + 1 and found[90].perplexity is None
    for half in (0, 1):
        rows = [i for i in range(len(texts)) if halves[i] == half]
        want = plain_bits([t for i, t in enumerate(good) if halves[i] != half], [texts[i] for i in rows], q.ORDER)
        for i, bits in zip(rows, want):
            assert np.log2(found[i].perplexity) == pytest.approx(bits, rel=1e-5)
