"""Preference pairs: prefixes, masks and edge cases."""

import pytest

from contestry.llm import preferences as p

TURNS = "conv_id bigint, turn bigint, role string, text string"


def pairs(spark, chosen, rejected):
    c = p.conversations(spark.createDataFrame([(1, i, *t) for i, t in enumerate(chosen)], TURNS))
    r = p.conversations(spark.createDataFrame([(1, i, *t) for i, t in enumerate(rejected)], TURNS))
    joined = c.selectExpr("key AS pair_id", "turns AS chosen").join(r.selectExpr("key AS pair_id", "turns AS rejected"), "pair_id")
    return p.format_pairs(joined).first()


def test_longest_common_prefix_is_the_prompt(spark):
    shared = [("system", "be kind"), ("user", "hi"), ("assistant", "hello")]
    row = pairs(spark, [*shared, ("user", "a?"), ("assistant", "yes")], [*shared, ("user", "b?"), ("assistant", "no"), ("assistant", "well")])
    assert row.n_common == 3
    assert row.prompt == "<|system|>\nbe kind<|end|>\n<|user|>\nhi<|end|>\n<|assistant|>\nhello<|end|>\n"
    assert [row.chosen[s.start : s.end] for s in row.chosen_mask] == ["yes<|end|>"]
    assert [row.rejected[s.start : s.end] for s in row.rejected_mask] == ["no<|end|>", "well<|end|>"]


def test_nothing_in_common_and_one_inside_the_other(spark):
    row = pairs(spark, [("user", "a")], [("user", "b")])
    assert (row.n_common, row.prompt, row.chosen_mask) == (0, "", [])
    row = pairs(spark, [("user", "a")], [("user", "a"), ("assistant", "ü")])
    assert (row.n_common, row.chosen, row.rejected) == (1, "", "<|assistant|>\nü<|end|>\n")


def test_equal_conversations_have_empty_completions(spark):
    row = pairs(spark, [("user", "a"), ("assistant", "b")], [("user", "a"), ("assistant", "b")])
    assert (row.n_common, row.chosen, row.rejected, row.chosen_mask, row.rejected_mask) == (2, "", "", [], [])


def test_edge_cases_of_turns(spark):
    rows = [
        (0, 0, "user", "q"), (0, 1, "assistant", "one"), (0, 1, "assistant", "one"), (0, 2, "user", "thanks"),
        (1, None, None, None), (1, 1, "assistant", None),
        (2, 0, "user", "alone"), (3, 0, "assistant", "x"),
        (None, 0, "user", "lost"), (None, 1, "assistant", "lost"),
        (4, 0, "assistant", "b"), (4, 0, "assistant", "a"), (5, 0, "assistant", "long " * 20_000),
    ]
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "'own' AS key", "'own' AS turns", "'own' AS pair_id", "1 AS n_common")
    found = {r.conv_id: r for r in p.preference_report(df).collect()}
    assert set(found) == {0, 1, 2, 3, 4, 5}
    assert (found[0].prompt, found[0].chosen, found[0].rejected) == (
        "<|user|>\nq<|end|>\n", "<|assistant|>\none<|end|>\n<|user|>\nthanks<|end|>\n", "<|assistant|>\n<|end|>\n")
    assert found[1].prompt == "<|" + "|>\n<|end|>\n" and found[1].chosen_mask == "14-21"
    assert found[2].prompt == "<|user|>\nalone<|end|>\n" and found[2].n_common == 1
    assert (found[2].chosen, found[2].rejected, found[2].chosen_mask, found[2].rejected_mask) == (None,) * 4
    assert found[3].n_common == 0 and found[3].rejected_mask == "14-22,37-45"
    assert found[4].n_common == 1 and found[4].chosen == "<|assistant|>\nb<|end|>\n"
    assert found[4].rejected_mask == "14-100021"
    assert found[5].rejected == "<|assistant|>\none<|end|>\n<|user|>\nthanks<|end|>\n"


def test_a_branch_that_begins_alike_lengthens_the_prompt(spark):
    rows = [(10, 0, "user", "a"), (10, 1, "assistant", "yes"), (10, 2, "user", "b"), (10, 3, "assistant", "no"),
            (30, 0, "user", "c"), (30, 1, "assistant", "yes"), (30, 2, "user", "b"), (30, 3, "assistant", "maybe")]
    found = {r.conv_id: r for r in p.preference_report(spark.createDataFrame(rows, TURNS)).collect()}
    assert found[10].n_common == 3 and found[10].rejected == "<|assistant|>\nmaybe<|end|>\n"
    assert found[30].n_common == 3 and found[30].chosen == "<|assistant|>\nmaybe<|end|>\n"


def test_ids_of_any_kind_and_all_without_reply(spark):
    rows = [("x", 0, "user", "hi"), ("x", 1, "assistant", "ho"), ("b", 0, "assistant", "hm")]
    df = spark.createDataFrame(rows, TURNS.replace("conv_id bigint", "conv_id string"))
    found = {r.conv_id: r for r in p.preference_report(df).collect()}
    assert found["b"].rejected == "<|assistant|>\nho<|end|>\n" and found["x"].rejected == "<|assistant|>\nhm<|end|>\n"
    silent = p.preference_report(df.filter("role = 'user'")).collect()
    assert [(r.conv_id, r.n_common, r.rejected) for r in silent] == [("x", 1, None)]


def test_empty_table(spark):
    assert p.preference_report(spark.createDataFrame([], TURNS)).isEmpty()


@pytest.mark.parametrize("rows", ["TRUE", "conv_id % 2 = 0"])
def test_twin_in_sql(spark, rows):
    import duckdb

    folder = "/root/testdata/sf0.001"
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet' WHERE {rows}")
    expected = duckdb.sql(p.PREFERENCE_SQL)
    turns = spark.read.parquet(f"{folder}/conversations.parquet").filter(rows)
    found = p.preference_report(turns).select(*expected.columns).collect()
    assert len(found) == turns.select("conv_id").distinct().count()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected.fetchall()))
