"""Line dedup, ranked search and conversation repair against brute force and SQL."""

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import pytest
from corpus_cases import benchmark, documents, edge, empty, text_rows  # noqa: F401  (fixtures)

from contestry.llm import block_search, line_dedup, turn_repair

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WHITE = " \t\n\x0b\x0c\r"
TURNS = "conv_id bigint, turn bigint, role string, text string"


def same(df, expected):
    key = lambda row: tuple((x is not None, str(x)) for x in row)
    assert sorted(map(tuple, df.collect()), key=key) == sorted(map(tuple, expected), key=key)


@pytest.fixture(params=["edge", "documents", "empty"])
def docs(request):
    return request.getfixturevalue(request.param)


# ---- lines -------------------------------------------------------------------------------


def brute_lines(rows):
    big = 10**18
    key = lambda line: line.strip(WHITE).translate(LOWER)
    holders = {}
    for n, (i, t) in enumerate(rows):
        for k in {key(line) for line in (t or "").split("\n")}:
            holders.setdefault(k, []).append(big if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        own = big if i is None else i
        gone = [len(key(x)) >= 10 and len(holders[key(x)]) > 1 and min(holders[key(x)]) != own for x in lines]
        kept = "\n".join(x for x, g in zip(lines, gone) if not g)
        out.append((i, len(lines), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_line_report(docs, text_rows):  # noqa: F811
    same(line_dedup.line_report(docs), brute_lines(text_rows(docs)))


LINES = [
    (1, "A repeated line\nown of one\r\n  a REPEATED line \nshort\n"),
    (2, "\nshort\na repeated line\n\nthe end of two, ÜBER"),
    (3, "a repeated line"),
    (4, "The end of two, über\nthe end of two, Über\tx\nA repeated line "),
    (2, "a repeated line\nown of one"),
    (None, "a repeated line\nonly without an id"),
    (None, "only without an id"),
    (5, "the end of two, Über"),
    (6, None),
]


def test_lines_that_repeat_with_ties_and_nulls(spark, text_rows):  # noqa: F811
    df = spark.createDataFrame(LINES, "doc_id bigint, text string").repartition(4)
    same(line_dedup.line_report(df), brute_lines(LINES))


def test_kept_lines_come_in_order_and_other_columns_pass(spark):
    rows = [(1, "first shared line\nb", 7), (2, "one\nfirst shared line\ntwo\nfirst shared line\n", 8), (3, "FIRST shared line", 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, pos int")
    kept = line_dedup.drop_repeated_lines(df)
    assert kept.columns == ["doc_id", "text", "pos", "n_lines", "n_dropped"]
    same(kept, [(1, "first shared line\nb", 7, 2, 0), (2, "one\ntwo\n", 8, 5, 2), (3, "", 9, 1, 1)])
    same(line_dedup.drop_repeated_lines(df, max_docs=2).select("doc_id", "n_dropped"), [(1, 0), (2, 2), (3, 1)])
    assert sum(r.n_dropped for r in line_dedup.drop_repeated_lines(df, max_docs=3).collect()) == 0


def test_a_text_of_many_lines(spark):
    """200,000 lines, half of them repeated: cutting takes time linear in the text."""
    lines = [f"line number {i}" for i in range(200_000)]
    rows = [(1, "\n".join(lines[::2])), (2, "\n".join(lines))]
    same(line_dedup.line_report(spark.createDataFrame(rows, "doc_id bigint, text string")), brute_lines(rows))


def test_lines_in_sql(spark, edge):  # noqa: F811
    con = duckdb.connect()
    rows = [(1, "a shared line\nx"), (2, "x\nA shared line \ny"), (3, None), (4, ""), (5, "\tA SHARED LINE\n\n")]
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    found = line_dedup.line_report(spark.createDataFrame(rows, "doc_id bigint, text string"))
    expected = con.sql(line_dedup.LINE_SQL)
    same(found.select(*expected.columns), expected.fetchall())


# ---- search ------------------------------------------------------------------------------


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_search(docs, items, k=50):
    counts = [(i, Counter(terms_of(t))) for i, t in docs]
    counts = [(i, c, c.total()) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    weight = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
    out = []
    for item, text in items:
        found = []
        for i, c, n in counts:
            m = 50 + 50 * n * n_docs // n_terms
            score = sum(weight(t) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms_of(text)) if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return out


ITEMS = [("a", "one two THREE x"), ("b", None), ("c", ""), ("d", "?! \n"), (None, "mit license"), ("a", "gnu ünïcode"), ("e", "nowhere-at-all"), ("f", "x x x")]


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id string, text string").selectExpr("*", "'own' AS doc_id", "'own' AS terms", "1 AS query")


def test_search_equals_brute_force(docs, benchmark, text_rows):  # noqa: F811
    items = [tuple(r) for r in benchmark.select("item_id", "text").collect()]
    same(block_search.search(docs, benchmark), brute_search(text_rows(docs), items))


def test_search_on_edge_cases(spark, edge, text_rows):  # noqa: F811
    same(block_search.search(edge, items_of(spark, ITEMS)), brute_search(text_rows(edge), ITEMS))
    assert block_search.search(edge, items_of(spark, ITEMS).limit(0)).isEmpty()
    assert block_search.search(edge.limit(0), items_of(spark, ITEMS)).isEmpty()


def test_search_in_small_shards_blocks_and_passes(spark, documents, benchmark, text_rows, monkeypatch):  # noqa: F811
    """Blocks of three documents, shards of a few, several passes: the same ranks."""
    for name, value in (("BLOCK", 3), ("CELLS", 2000), ("GROUP_TERMS", 60), ("PASS_TERMS", 300), ("FIRST_PART", 2)):
        monkeypatch.setattr(block_search, name, value)
    items = [tuple(r) for r in benchmark.select("item_id", "text").collect()]
    same(block_search.search(documents.repartition(3), benchmark, k=5), brute_search(text_rows(documents), items, 5))


def test_blocks_are_skipped_only_below_the_bound():
    """A third of the documents fit the query; whole blocks of others are never scored."""
    import numpy as np

    rng = np.random.default_rng(1)
    impacts = np.zeros((600, 8), np.int64)
    impacts[:200, :4] = rng.integers(50, 100, (200, 4))
    impacts[200:, 4:] = rng.integers(50, 100, (400, 4))
    impacts[200:, 0] = 1
    exact = impacts[:, :4].sum(1)
    ((_, rows, scores),) = block_search._search_group(impacts, [np.arange(4)], np.zeros(1, np.int64), 20, 16)
    assert (scores == exact[rows]).all()
    best = np.sort(exact)[-20:]
    assert (np.sort(scores)[-20:] == best).all() and scores.min() >= best[0]
    docs, ends, summaries = block_search._blocked(impacts, impacts.astype(np.float32), 0, 16)
    assert len(ends) >= 3 and sorted(docs) == list(range(600))
    for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        assert (summaries[i] == impacts[docs[a:b]].max(0)).all()


# ---- conversations -----------------------------------------------------------------------


def every_repair(letters):
    """All audits with their costs, of at most three insertions in a row."""
    found = []

    def go(i, state, cost, audit, added):
        if i == len(letters) and state in "0a":
            found.append((cost, audit))
        if added < 3:
            for r in "ua":
                if (state, r) in turn_repair._NEXT:
                    go(i, turn_repair._NEXT[state, r], cost + 2, audit + "I", added + 1)
        if i == len(letters):
            return
        go(i + 1, state, cost + 3, audit + "D", 0)
        own, extra = letters[i].lower(), letters[i].isupper()
        for r in "sua" if own != "x" else "":
            if (state, r) in turn_repair._NEXT and (r == own or r != "s"):
                go(i + 1, turn_repair._NEXT[state, r], cost + (0 if r == own else 2) + extra, audit + ("K" if r == own else "R"), 0)

    go(0, "0", 0, "", 0)
    return min(found)


def test_the_lightest_derivation_is_the_least_of_all():
    rng = random.Random(3)
    cases = ["", "x", "s", "o", "O", "uuuuu", "aaaaa", "susu", "SUA", "xxxx"] + ["".join(rng.choices("suaoxSUAO", k=rng.randint(1, 5))) for _ in range(60)]
    for letters in cases:
        assert turn_repair.lightest(letters, "0", True)["goal"] == every_repair(letters), letters


@pytest.mark.parametrize("chunk", [1, 2, 3, 7])
def test_chunks_give_the_same_repair(chunk):
    rng = random.Random(chunk)
    cases = ["u" * 30, "a" * 31, "x" * 12, "us" * 9] + ["".join(rng.choices("suauaoxUA", k=rng.randint(8, 40))) for _ in range(40)]
    whole = [turn_repair.lightest(c, "0", True)["goal"] for c in cases]
    for letters, expected in zip(cases, whole):
        derivation = turn_repair._Derivation(chunk)
        for x in letters:
            derivation.add(x)
        assert derivation.goal() == expected, letters


def edge_turns():
    rng = random.Random(11)
    rows = [
        (1, 0, "user", "a?"), (1, 1, "assistant", "b."), (1, 1, "assistant", "b."), (1, 5, "assistant", None),
        (2, None, None, None), (2, None, "user", "x."), (2, 3, "", "no role."), (2, 4, "Üser", "odd."),
        (None, 0, "user", "lost"), (None, None, "assistant", "lost!"), (None, 0, "user", "lost"),
        (3, 7, "system", "s.\n"), (3, 7, "user", "tie."), (3, 7, "assistant", "tie."), (3, None, "tool", " \t"),
        (4, 0, "user", "word " * 30_000 + "end."), (4, 1, "assistant", "word " * 30_000),
    ]
    for conv in range(5, 60):
        for turn in range(rng.randint(1, 12)):
            rows.append((conv, turn * rng.choice([1, 1, 1, 2]), rng.choice(["user", "assistant", "assistant", "system", "tool"]), rng.choice(["yes.", "no!", "why", "", "so?", "fine.", "and"])))
    rows += [(60, t, "user", "same again.") for t in range(700)] + [(61, 0, "user", "one row.")] * 500
    return rows


def in_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return con.sql(turn_repair.REPAIR_SQL)


def test_repair_on_edge_cases_equals_sql(spark):
    rows = edge_turns()
    expected = in_sql(rows)
    columns, body = expected.columns, expected.fetchall()
    df = spark.createDataFrame(rows, TURNS).repartition(5).selectExpr("*", "'own' AS n", "'own' AS fault", "'own' AS kind", "'own' AS audit")
    same(turn_repair.repair_report(df).select(*columns), body)
    assert {r[0] for r in body} == {r[0] for r in rows}


def test_repair_in_short_chunks_equals_sql(spark):
    rows = edge_turns()
    expected = in_sql(rows)
    found = turn_repair.repair_report(spark.createDataFrame(rows, TURNS), chunk=4)
    same(found.select(*expected.columns), expected.fetchall())


def test_repaired_rows_are_legal_and_hash_alike(spark):
    df = spark.createDataFrame(edge_turns(), TURNS)
    turns = turn_repair.damaged(df)
    report = {r.conv_id: r for r in turn_repair.repair_report(df).collect()}
    rows = {}
    for r in turn_repair.repaired(turns).collect():
        rows.setdefault(r.conv_id, []).append((r.place, r.role, r.text))
    for conv, row in report.items():
        own = sorted(rows.get(conv, []))
        assert [p for p, _, _ in own] == list(range(len(own)))
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for _, role, _ in own))
        assert row.repaired_sha256 == hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in own).encode()).hexdigest()


def test_legal_conversations_stay_as_they_are(spark):
    rows = [(1, 0, "system", "be kind."), (1, 1, "user", "hi!"), (1, 2, "assistant", "hello."), (2, 0, "user", "a?"), (2, 1, "assistant", "b.")]
    turns = spark.createDataFrame(rows, TURNS).selectExpr("*", "1L AS n")
    same(turn_repair.audits(turns).select("conv_id", "cost", "audit"), [(1, 0, "KKK"), (2, 0, "KK")])
    same(turn_repair.repaired(turns), [(c, t, r, x) for c, t, r, x in rows])


def test_repair_of_an_empty_table(spark):
    assert turn_repair.repair_report(spark.createDataFrame([], TURNS)).isEmpty()


def test_a_common_ancestor_is_not_read_again():
    """Audits of many pieces are compared from where they part."""
    chain = None
    for _ in range(5000):
        chain = turn_repair._Chain(chain, "K" * 256)
    a, b = turn_repair._Chain(chain, "DK"), turn_repair._Chain(chain, "KD")
    assert turn_repair._lighter((1, a), (1, b)) and not turn_repair._lighter((1, b), (1, a))
    assert turn_repair._lighter((0, b), (1, a)) and len(a.text()) == 5000 * 256 + 2
