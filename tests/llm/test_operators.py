"""Every operator against brute force on edge cases and on the smallest table."""

import hashlib

import brute
import numpy as np
import public_tokenizers
import pytest
from corpus_cases import benchmark, documents, edge, empty, text_rows  # noqa: F401  (fixtures)
from tokenizers import Tokenizer

from contestry.llm import (
    decontaminate,
    exact_names,
    licenses,
    mixture,
    near_dups,
    private_crf,
    suffix_spans,
    text,
    token_counts,
)

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def key(row):
    return tuple((x is not None, str(x)) for x in row)


def same(df, expected):
    assert sorted((tuple(r) for r in df.collect()), key=key) == sorted(expected, key=key)


@pytest.fixture(params=["edge", "documents", "empty"])
def docs(request):
    return request.getfixturevalue(request.param)


def test_exact_dedup(docs, text_rows):
    same(exact_names.duplicate_classes(docs, block_chars=64), brute.exact(text_rows(docs)))


def test_exact_dedup_of_texts_of_ten_million_characters(spark):
    rows = spark.range(3).selectExpr("id AS doc_id", "concat(repeat('é ab\\ncDefg', 1000000), id < 2) AS text")
    found = {r.doc_id: r for r in exact_names.duplicate_classes(rows).collect()}
    assert [(found[i].keep_id, found[i].group_size, found[i].kept) for i in range(3)] == [(1, 2, False), (1, 2, True), (2, 1, True)]
    text = "é ab\ncDefg" * 1_000_000 + "true"
    assert found[0].text_sha256 == hashlib.sha256(text.lower().encode()).hexdigest()


def test_exact_dedup_takes_another_seed_when_hashes_meet(documents, text_rows, monkeypatch):
    tried = []

    def told_apart(blocks, seed):
        tried.append(seed)
        return seed == 2

    monkeypatch.setattr(exact_names, "_told_apart", told_apart)
    same(exact_names.duplicate_classes(documents), brute.exact(text_rows(documents)))
    assert tried == [0, 1, 2]


def test_blocks_that_share_a_hash_are_noticed(spark, monkeypatch):
    blocks = spark.createDataFrame([("a",), ("b",), ("a",)], "block string")
    assert exact_names._told_apart(blocks, 0)
    monkeypatch.setattr(exact_names.F, "xxhash64", lambda *columns: exact_names.F.lit(1))
    assert not exact_names._told_apart(blocks, 0)


def test_exact_dedup_keeps_one_row_of_each_class(docs, text_rows):
    kept = exact_names.drop_duplicates(docs, block_chars=64)
    assert kept.columns == docs.columns
    same(kept.select("doc_id"), [(r[0],) for r in brute.exact(text_rows(docs)) if r[3]])


def expected_near(rows):
    """With a null id as the largest; rows that repeat an id are merged for brute force."""
    big = 10**9
    place, distinct = {}, []
    for n, (i, t) in enumerate(rows):
        place[n] = big + n if i is None else i * 1000 + n
        distinct.append((place[n], t))
    found = brute.near(distinct)
    out = []
    for n, (i, _) in enumerate(rows):
        size, root = found[place[n]]
        smallest = None if root >= big else root // 1000
        out.append((i, size, smallest, i == smallest))
    return out


def test_near_duplicates(docs, text_rows):
    same(near_dups.near_duplicate_report(docs), expected_near(text_rows(docs)))


@pytest.mark.parametrize("sketched", [2, 16384])
def test_near_duplicates_in_large_nodes(documents, text_rows, monkeypatch, sketched):
    """Nodes of two are large here, so they branch and are compared by blocks, with and without sketches."""
    monkeypatch.setattr(near_dups, "BLOCK", 1)
    monkeypatch.setattr(near_dups, "SKETCHED", sketched)
    monkeypatch.setattr(near_dups, "LARGEST", (2, 4))
    same(near_dups.near_duplicate_report(documents), expected_near(text_rows(documents)))


def test_a_chain_of_near_copies_in_one_large_node(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK_SHINGLES", 400)
    monkeypatch.setattr(near_dups, "LARGEST", (8, 16))
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[i * 3 : i * 3 + 100])) for i in range(34)] + [(99, " ".join(words[:100]) + " x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    same(near_dups.near_duplicate_report(docs), expected_near(rows))


def test_pairs_that_only_meet_at_the_last_depth_are_found(spark, monkeypatch):
    """Every node branches down to the last depth, and 3,000 pairs of similarity 0.8 still meet."""
    monkeypatch.setattr(near_dups, "LARGEST", (1,) * 5)
    say = lambda name, n: " ".join(f"{name}w{i}" for i in range(n))
    rows = [(i, f"{say(f'p{i // 2}', 83)} {say(f'own{i}', 10)}") for i in range(6000)]
    found = near_dups.near_duplicate_report(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert found.filter("kept").count() == 3000
    assert all(near_dups.miss_bound(depth) < 1e-6 for depth in range(1, len(near_dups.LARGEST) + 2))


def test_texts_of_near_duplicates_are_joined_alike_at_any_size(edge, spark):
    columns = "v bigint, doc_id bigint, text_hash bigint"
    hashed = edge.filter("doc_id IN (1, 2, 6)").selectExpr("doc_id AS v", "doc_id", "xxhash64(text) AS text_hash").distinct()
    sets = spark.createDataFrame(hashed.collect(), columns)
    texts = near_dups._texts(edge, sets, sets.filter("v < 6").select("v"))
    assert {tuple(r) for r in texts.collect()} == {(r.doc_id, r.text) for r in edge.collect() if r.doc_id in (1, 2)}
    parts = spark.createDataFrame([(7, v, v) for v in (1, 2)], "part bigint, v bigint, component bigint")
    links = near_dups._links(parts, texts.dropDuplicates(["v"]), near_dups.WORDS, near_dups.PERCENT)
    assert [set(r) for r in links.collect()] == [{1, 2}]
    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan(texts) and "SortMergeJoin" in plan(links)


def test_tokens_travel_and_not_texts(edge, spark):
    """Tokens of deeper nodes are made where texts are read; one row for each wanted set."""
    wanted = [r.doc_id for r in edge.select("doc_id").distinct().collect() if r.doc_id in (1, 6, 8, 10)]
    hashed = edge.selectExpr("doc_id AS v", "doc_id", "xxhash64(text) AS text_hash").distinct().filter("v IS NOT NULL")
    sets = spark.createDataFrame(hashed.collect(), hashed.schema)
    found = near_dups._tokens(edge, sets, sets.filter("v IN (1, 6, 8, 10)").select("v"), 2, 5, near_dups.WORDS)
    tokens = {r.v: r.tokens for r in found.collect()}
    assert sorted(tokens) == sorted(wanted) and found.count() == 4 and all(len(t) == 5 for t in tokens.values())
    alone = edge.filter("doc_id = 8")
    assert near_dups._tokens(alone, sets, sets.select("v"), 2, 5, near_dups.WORDS).head().tokens == tokens[8]
    below = found._jdf.queryExecution().sparkPlan().toString().split("MapInArrow")
    assert len(below) == 2 and "ShuffledHashJoin" in below[0] and "ShuffledHashJoin" not in below[1]


def test_near_dedup_keeps_one_of_each_class(docs, text_rows):
    kept = near_dups.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    expected = expected_near(text_rows(docs))
    found = {r.doc_id for r in kept.select("doc_id").collect()}
    assert {r[0] for r in expected if r[3] and r[0] is not None} == found - {None}
    assert kept.select("doc_id", "text").distinct().count() == kept.count()


def test_decontamination(docs, benchmark, spark, text_rows):
    extra = spark.createDataFrame(
        [(None, "two three"), (900, ""), (901, None), (902, "Three!"), (903, "mit license mit"), (903, "x")],
        "item_id bigint, text string",
    )
    items = benchmark.unionByName(extra)
    bench = [(r.item_id, r.text) for r in items.collect()]
    expected = []
    for i, t in text_rows(docs):
        n, hit, ids = brute.contaminated(t, bench)
        expected.append((i, n, len(hit), len(ids), brute.sha(",".join(sorted(ids))), bool(hit)))
    same(decontaminate.contamination_report(docs, items), expected)
    blocks = decontaminate.find_hits(docs, items, block_bytes=2000)
    same(blocks.selectExpr("doc_id", "n_words", "size(items)"), [e[:2] + (e[3],) for e in expected])
    kept = decontaminate.drop_contaminated(docs, items, block_bytes=2000)
    assert kept.columns == docs.columns
    same(kept.select("doc_id"), [e[:1] for e in expected if not e[5]])


def test_cut_removes_the_hit_words_only(spark):
    docs = spark.createDataFrame([(1, "Keep, one TWO three! four"), (2, "other")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "one two, three")], "item_id bigint, text string")
    same(decontaminate.cut_contaminated(docs, items), [(1, "Keep, ! four"), (2, "other")])


def test_empty_benchmark_hits_nothing(edge, spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.contamination_report(edge, none).filter("contaminated").isEmpty()


def test_a_benchmark_block_takes_a_stated_multiple_of_its_text():
    random = np.random.default_rng(5)
    words = ["".join(random.choice(list("abcdefghij"), n)) for n in random.integers(4, 9, 5000).tolist()]
    items = [(str(i), " ".join(random.choice(words, n))) for i, n in enumerate(random.integers(1, 60, 4000).tolist())]
    size = sum(len(t) for _, t in items)
    block = decontaminate._Windows(items * 2, decontaminate.WINDOW)
    assert block.nbytes() < decontaminate.MULTIPLE * 2 * size + 10 * (4 << 20)
    again = decontaminate._Windows([(str(i), items[0][1]) for i in range(300)] + items, decontaminate.WINDOW)
    data = np.frombuffer(items[0][1].upper().encode(), np.uint8)
    n_words, hits = again.scan(data, np.array([0, len(data)]))
    whole = [found for first, last, found in hits[0] if last - first == decontaminate.WINDOW - 1]
    assert len(whole) == n_words[0] - decontaminate.WINDOW + 1 and all(len(found) == 300 for found in whole)



def test_repeated_spans(docs, text_rows):
    rows = [(i, t) for i, t in text_rows(docs)]
    same(suffix_spans.repeat_report(docs), brute.repeats(rows))


def test_repeated_spans_with_hot_samples(documents, text_rows, monkeypatch, spark):
    monkeypatch.setattr(suffix_spans, "HOT", 3)
    part = documents.filter("doc_id < 90")
    same(suffix_spans.repeat_report(part), brute.repeats(text_rows(part)))


def test_long_text_is_cut_into_segments(monkeypatch):
    data = np.random.default_rng(0).integers(97, 99, 30_000).astype(np.uint8)
    whole = suffix_spans.Samples(data, np.array([0, 7000, len(data)]), 50)
    monkeypatch.setattr(suffix_spans, "_SEGMENT", 700)
    for name in ("row", "first", "last", "at", "hash"):
        own = getattr(suffix_spans.Samples(data, np.array([0, 7000, len(data)]), 50), name)
        assert (own == getattr(whole, name)).all()
    s = suffix_spans.Samples(data, np.array([0, len(data)]), 50)
    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(s.first, s.last)])
    assert (starts == np.arange(len(data) - 49)).all()
    assert ((s.at >= s.first) & (s.at + suffix_spans.SAMPLE <= s.first + 50)).all()


def test_repeated_spans_do_not_depend_on_runs(documents, text_rows, monkeypatch):
    """Runs of one task are cut elsewhere than those of another."""
    monkeypatch.setattr(suffix_spans, "_SEGMENT", 1500)
    part = documents.filter("doc_id < 90")
    same(suffix_spans.repeat_report(part), brute.repeats(text_rows(part)))


def test_equal_strings_have_equal_samples():
    rng = np.random.default_rng(1)
    string = rng.integers(97, 101, 50).astype(np.uint8)
    seen = set()
    for n in (0, 1, 37, 500):
        data = np.concatenate((rng.integers(97, 101, n).astype(np.uint8), string, rng.integers(97, 101, 70).astype(np.uint8)))
        s = suffix_spans.Samples(data, np.array([0, len(data)]), 50)
        at = int(np.flatnonzero((s.first <= n) & (n <= s.last))[0])
        seen.add((int(s.hash[at]), int(s.at[at]) - n))
    assert len(seen) == 1


def test_token_counts(docs, text_rows):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    expected = []
    for i, t in text_rows(docs):
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        expected.append((i, len((t or "").encode()), n, n > 512))
    same(token_counts.token_report(docs, TOKENIZER), expected)


def test_pre_tokens_match_the_tokenizer_on_all_assigned_characters():
    with open(TOKENIZER) as file:
        counter = token_counts.TokenCounter(file.read())
    own = counter.tokenizer.pre_tokenizer
    for c in range(0x110000):
        ch = chr(c)
        if 0xD800 <= c < 0xE000 or counter.unsure.match(ch):
            continue
        t = f"a{ch}b {ch}{ch}1 !{ch}  {ch} x"
        assert [m.span() for m in counter.pattern.finditer(t)] == [at for _, at in own.pre_tokenize_str(t)], hex(c)


def test_forgetful_counter_counts_alike(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 1)
    with open(TOKENIZER) as file:
        counter = token_counts.TokenCounter(file.read())
    texts = ["thetionreaou xqzv", "xqzv thetionreaou!!", ""]
    assert counter.counts(texts) == counter.counts(texts) == [len(counter.tokenizer.encode(t).ids) for t in texts]


def test_private_data(docs, text_rows):
    found = private_crf.private_report(docs).collect()
    expected = []
    for i, t in text_rows(docs):
        spans = brute.private(t)
        counts = tuple(sum(s.startswith(k) for s in spans) for k in brute.PATTERNS)
        expected.append((i, *counts, brute.sha(",".join(spans)), tuple(spans)))
    assert sorted((tuple(r)[:6] for r in found), key=key) == sorted((e[:6] for e in expected), key=key)
    by_hash = {e[5]: set(e[6]) for e in expected}
    assert all(by_hash[r.base_sha256] <= set(filter(None, r.spans.split(","))) for r in found)


HELD_OUT = (
    ("ask for it on (212) 555-0175 before ten", [("phone", 14, 28)]),
    ("fax 040 555 0123 is new", [("phone", 4, 16)]),
    ("mobile 0170 1234 5678 was lost", [("phone", 7, 21)]),
    ("in 2021 about 40 of 3,500 people left", []),
    ("version 5.1 needs 16 gb and 2.4 ghz", []),
    ("see page 12, line 7", []),
    ("it was 11-3 after 20 minutes", []),
    ("key = 9f86d081884c7d659a2feaa0c55ad015", []),
)


def test_field_finds_what_the_patterns_miss():
    field = private_crf.train()
    base = [private_crf.base_spans(t) for t, _ in HELD_OUT]
    found = private_crf.added_spans([t for t, _ in HELD_OUT], base, field)
    right = sum(f == want for f, (_, want) in zip(found, HELD_OUT))
    assert right >= 7
    assert not any(f for f, (_, want) in zip(found, HELD_OUT) if not want)


def test_no_number_of_a_long_list_is_lost():
    text = "numbers: " + "mobile 0170 1234 5678 or " * 300
    (found,) = private_crf.added_spans([text], [private_crf.base_spans(text)], private_crf.train())
    assert [text[a:b] for kind, a, b in found if kind == "phone"] == ["0170 1234 5678"] * 300 and len(found) == 300


def test_a_long_sequence_is_decoded_as_one():
    field = private_crf.train()
    words = [w for text, _ in HELD_OUT for w in text.split()] * 5
    assert len(words) > 3 * private_crf.SEQUENCE
    assert field.decode_long(words).tolist() == field.decode([private_crf.features(words)])[0].tolist()


def test_viterbi_is_the_best_of_all_paths():
    import itertools

    field = private_crf.train()
    names = private_crf.features(["call", "+1", "(555)", "010-9999"])
    scores, _ = field._scores([names])
    worth = lambda p: sum(scores[0, t, x] for t, x in enumerate(p)) + sum(field.step[a, b] for a, b in zip(p, p[1:]))
    best = max(itertools.product(range(len(private_crf.LABELS)), repeat=4), key=worth)
    assert tuple(field.decode([names, names[:2]])[0]) == best


def test_mixture(docs):
    rows = [(r.doc_id, r.source, r.text) for r in docs.select("doc_id", "source", "text").collect()]
    want = brute.targets([(s, t) for _, s, t in rows]) if rows else {}
    found = mixture.mix_report(docs).collect()
    assert len(found) == len(rows)
    sizes = sorted((len(brute.SPACED.findall(t or "")), want[s][0]) for _, s, t in rows)
    assert sorted((r["size"], r.source_size) for r in found) == sizes
    assert sorted(round(r.target, 6) for r in found) == sorted(round(want[s][1], 6) for _, s, _ in rows)
    assert all(0 <= r.taken <= 3 * r["size"] for r in found)
    assert sorted(map(tuple, mixture.mix_report(docs.repartition(3)).collect()), key=key) == sorted(map(tuple, found), key=key)
    copies = mixture.mix(docs)
    assert copies.columns == docs.columns
    assert sum(len(brute.SPACED.findall(r.text or "")) for r in copies.collect()) == sum(r.taken for r in found)


def test_mixture_comes_near_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    taken = {}
    rows = mixture.mix_report(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    for r in rows:
        t = taken.setdefault(r.source, [0, r.target])
        t[0] += r.taken
    assert all(abs(a - b) <= 0.05 * b for a, b in taken.values())


def test_licenses(docs, text_rows):
    found = licenses.license_report(docs).collect()
    expected = []
    for i, t in text_rows(docs):
        n, starts, labels = brute.phrases(t)
        expected.append((i, n, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))))
    assert sorted((tuple(r)[:6] for r in found), key=key) == sorted(expected, key=key)
    for r in found:
        own = [x for x in r.labels.split(",") if x]
        assert own == sorted(set(own)) and set(filter(None, r.base_labels.split(","))) <= set(own)
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(own)


def test_license_rules_suppress_what_lies_inside(spark):
    docs = spark.createDataFrame(
        [(1, "Licensed under the Apache License, Version 2.0; see the MIT license."), (2, "GNU Lesser General Public License")],
        "doc_id bigint, text string",
    )
    rows, found, stay = licenses.scan_licenses(docs)
    named = stay.join(rows, "_row").selectExpr("doc_id", "label", "first", "last").collect()
    assert sorted(tuple(r) for r in named) == [(1, "apache", 0, 7), (1, "mit", 10, 11), (2, "lgpl", 0, 4)]
    assert found.count() > stay.count()


LICENSED = (
    ("licensed under GPLv3", {"gpl"}),
    ("It is licensed under LGPLv2.1 or later.", {"lgpl"}),
    ("the BSD 3-Clause License", {"bsd"}),
    ("Copyright © 2020 by them", {"copyright"}),
    ("©2019 by them", {"copyright"}),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", {"mit"}),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", {"bsd"}),
    ("Neither the name of the Foo Bar nor the names of its contributors may be used to endorse or promote products", {"bsd-3-clause"}),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", {"gpl"}),
    ("it was free of charge and used in source and binary forms", set()),
)


def test_license_bodies_joined_versions_and_signs(spark):
    rows = [(i, t) for i, (t, _) in enumerate(LICENSED)] + [(99, " ".join(phrase for _, phrase in licenses.BODIES))]
    found = licenses.license_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    labels = {r.doc_id: set(filter(None, r.labels.split(","))) for r in found}
    assert [labels[i] for i in range(len(LICENSED))] == [want for _, want in LICENSED]
    assert {label for label, _ in licenses.BODIES} <= labels[99]


def test_every_rule_passes_the_gate():
    import re

    gate = re.compile("|".join(licenses.GATE))
    for rule in licenses.default_rules():
        name = re.sub(r"\(\?:[^()]*\)\?", "", rule.pattern.replace("[sc]", "s"))
        assert gate.search(f" {' '.join(rule.keywords)} ") or gate.search(f" {name} "), rule


def test_keywords_stand_in_what_a_rule_matches():
    import re

    for rule in licenses.default_rules():
        matched = re.sub(r"\(\?:[^()]*(?:\([^()]*\)[^()]*)*\)\?", "", rule.pattern)
        matched = re.sub(r"\(\?:([^|()]*)\|[^()]*\)", r"\1", matched).replace("[sc]", "s")
        assert all(f" {k}" in f" {matched}" for k in rule.keywords), (rule, matched)


def test_words_and_hashes_do_not_depend_on_place():
    data = np.frombuffer("Ab cd\néf Ab".encode(), np.uint8)
    starts, ends, hashes = text.words(data, np.array([0, len(data)]), text.SPACED)
    assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends)] == ["Ab", "cd", "éf", "Ab"]
    assert hashes[0] == hashes[3] and len(set(hashes.tolist())) == 3
    cut = text.words(data, np.array([0, 1, len(data)]), text.SPACED)
    assert len(cut[0]) == 5


def test_texts_of_repeated_spans_are_packed_and_shuffled_once(documents, text_rows, spark):
    import pyarrow as pa

    from contestry.llm import text as tx

    texts = ["one two three " * 200, "", None, "ünï"]
    packed = tx.packed_texts(pa.array(texts))
    data, offsets = tx.unpacked_texts(packed)
    assert [data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:])] == [t or "" for t in texts]
    assert packed[2].as_py() is None and len(packed[0].as_py()) < 200
    values = np.arange(7, dtype=np.uint64) << np.uint64(33)
    assert (tx.values(tx.by_byte(values), np.uint64) == values).all()
    assert len(tx.values(None, np.uint64)) == 0
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, -1)
    try:
        found = suffix_spans.repeated_spans(documents)
        assert found.count() == documents.count()
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    plan = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan
