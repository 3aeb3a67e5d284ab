"""Token rules against tables of expected values that were written down by hand."""

import pytest
from pyspark.sql import functions as F

from chronolex.functions import tokens as t

RULES = t.TokenRules(stop_words=("the",))


def one(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_rules(spark):
    cases = {
        "The_DET quick_ADJ Fox_NOUN": "<UNK> quick fox",
        "of_ADP a_DET": None,
        "中_NOUN cat_NOUN": "中 cat",
        "ß_X cat_NOUN": "<UNK> cat",
        "Élan_NOUN": "Élan",
        "ABCé_X": "abcé",
        "_NOUN run_VERB": "<UNK> run",
        "don't_VERB go_VERB now_ADV": "<UNK> <UNK> now",
        "1984_NUM": None,
        "a_b_VERB  cat": "<UNK> cat",
        "": None,
    }
    assert one(spark, list(cases), lambda c: t.normalise(c, RULES)) == list(cases.values())


def test_literal_unk_without_rules(spark):
    off = t.TokenRules(lower=False, alpha=False, short=False, stop=False)
    assert one(spark, ["<UNK>"], lambda c: t.normalise(c, off)) == ["<UNK>"]


def tables(spark, ngrams, rules, whitelist=None, lemmas=None):
    df = spark.createDataFrame([(n,) for n in ngrams], "ngram string")
    white = None if whitelist is None else spark.createDataFrame([(w,) for w in whitelist], "token string")
    lemma = None if lemmas is None else spark.createDataFrame(lemmas, "token string, pos string, lemma string")
    return dict(t.normalise_with_tables(df, rules, white, lemma).collect())


def test_whitelist_replaces_other_rules(spark):
    assert tables(spark, ["1984_NUM cat_NOUN"], RULES, ["1984"]) == {"1984_NUM cat_NOUN": "1984 <UNK>"}
    assert tables(spark, ["cat_NOUN"], RULES, []) == {}


def test_stop_words_see_lemmas(spark):
    rules = t.TokenRules(short=False, stop_words=("was",))
    assert tables(spark, ["was_VERB"], rules, lemmas=[("was", "VERB", "be")]) == {"was_VERB": "be"}
    assert tables(spark, ["was_NOUN x"], rules, lemmas=[("was", "VERB", "be"), ("was", None, "were")]) == {"was_NOUN x": "were x"}


def test_look_up_without_broadcast(spark, monkeypatch):
    side = t.look_up_side
    monkeypatch.setattr(t, "look_up_side", lambda table: side(table, 0))
    rules = t.TokenRules(short=False, stop_words=("was",))
    assert tables(spark, ["was_NOUN x"], rules, lemmas=[("was", "VERB", "be"), ("was", None, "were")]) == {"was_NOUN x": "were x"}
    assert tables(spark, ["1984_NUM cat_NOUN"], RULES, ["1984"]) == {"1984_NUM cat_NOUN": "1984 <UNK>"}


def test_ngram_types(spark):
    cases = ["cat_VERB", "__NOUN", "_NOUN", "a_NOUN b_VERB", "_NOUN_", "cat", "a b", "cat_VERB dog", "cat_VERB  dog_NOUN"]
    assert one(spark, cases, lambda c: t.ngram_type(c, "tagged")) == [True] * 4 + [False] * 5
    assert one(spark, cases, lambda c: t.ngram_type(c, "untagged")) == [False] * 4 + [True] * 3 + [False] * 2
    with pytest.raises(ValueError):
        t.ngram_type(F.col("v"), "other")


def test_log_weight(spark):
    f = [0, 9, 99, 999, 9999, 99999, 999999]
    df = spark.createDataFrame([(x,) for x in f], "f long")
    assert [r[0] for r in df.orderBy("f").select(t.log_weight(F.col("f"))).collect()] == [1, 1, 2, 2, 4, 5, 5]


def test_unk_policies(spark):
    df = spark.createDataFrame([("<UNK> a <UNK> b",), ("<UNK> a",), ("x<UNK>y z",), ("a b",)], "s string")
    get = lambda p: sorted(r[0] for r in t.unk_policy(df, "s", p).collect())
    assert get("strip") == ["a b", "a b", "x<UNK>y z"]
    assert get("reject") == ["a b"]
    assert len(get("retain")) == 4
