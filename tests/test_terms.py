import random

import pytest
from pyspark.sql import functions as F

from emberlink.functions import grams
from emberlink.functions.text import match_any
from emberlink.operators.terms import match_terms, term_keys


def corpus(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, body string")


def lexicon(spark, terms):
    return spark.createDataFrame([(t,) for t in terms], "term string")


def by_hand(texts, terms):
    wanted = {t.lower() for t in terms if t}
    return {(i, t) for i, x in enumerate(texts) for t in wanted if t in (x or "").lower()}


def pairs(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_five_thousand_terms(spark, limit):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdeöß", k=rng.randint(2, 9)))
    texts = [" ".join(word() for _ in range(60)) for _ in range(150)] + [None, "", "a", "Abc", "ABC def"]
    terms = [word() for _ in range(4900)] + [f"{word()} {word()}" for _ in range(95)] + [None, "", "a", "ABC", "c d", texts[3][:200]]
    got = pairs(match_terms(corpus(spark, texts), "id", "body", lexicon(spark, terms), max_broadcast_bytes=limit))
    assert got == by_hand(texts, terms) and len(got) > 1000


def test_equal_to_match_any(spark):
    texts = ["Wildfire near the ridge", "LÖSCHFLUGZEUG im Einsatz", "a flood", "nothing", "fire fire fire"]
    terms = ["fire", "löschflugzeug", "flood", "ridge", "no"]
    df = corpus(spark, texts)
    found = {r.id for r in match_terms(df, "id", "body", lexicon(spark, terms)).collect()}
    assert found == {r.id for r in df.where(match_any("body", terms)).collect()}


def test_terms_across_pieces(spark):
    size = grams.PIECE
    long = "x" * (size - 5) + "needle in the hay" + "y" * size + "short"
    texts = [long, "needle", "y" * 3 * size]
    terms = ["needle in the hay", "needle", "xneedle", "hayy", "short", "yshort", "yyyyyyyy", "zzzz"]
    assert pairs(match_terms(corpus(spark, texts), "id", "body", lexicon(spark, terms))) == by_hand(texts, terms)


def test_rarest_gram_and_terms_that_occur_nowhere(spark):
    df = corpus(spark, ["common words", "common ground", "common rare"])
    keys = {r.term: r.seen for r in term_keys(df, "body", lexicon(spark, ["common rare", "common", "unknown", "ground", "ground"])).collect()}
    assert keys == {"common rare": 1, "common": 3, "ground": 1}


def test_cost_follows_hits_not_terms(spark):
    """Ten times the terms that texts do not hold leave as many keys."""
    rng = random.Random(1)
    df = corpus(spark, ["".join(rng.choices("abcd ", k=400)) for _ in range(50)])
    sure = ["".join(rng.choices("abcd", k=5)) for _ in range(50)]
    counts = [
        term_keys(df, "body", lexicon(spark, sure + [f"{i:06d}wxyz" for i in range(n)])).count() for n in (300, 3000)
    ]
    assert counts[0] == counts[1] <= 50


def test_nothing_to_match(spark):
    df = corpus(spark, ["text"])
    assert match_terms(df, "id", "body", lexicon(spark, [])).collect() == []
    assert match_terms(df, "id", "body", lexicon(spark, [None, ""])).collect() == []
    assert match_terms(df.where("false"), "id", "body", lexicon(spark, ["text"])).collect() == []
    assert match_terms(df.withColumn("term", F.lit(1)), "id", "body", lexicon(spark, ["TEXT"])).columns == ["id", "term"]


def test_small_lexicons_need_no_join(spark):
    df = corpus(spark, ["one text", "another text"])
    plan = match_terms(df, "id", "body", lexicon(spark, ["text", "one"]))._jdf.queryExecution().executedPlan().toString()
    # The names of terms alone are joined, to pairs that are already found.
    assert plan.count("ArrowEvalPython") == 1 and plan.count("Join") == 1 and "lambda x" not in plan.split("ArrowEvalPython")[0]
