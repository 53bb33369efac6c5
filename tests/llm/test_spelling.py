"""Spelling groups against all pairs, SQL on awkward tables, and chains of forms."""

import itertools
import random

import pytest
from cases import documents, frame, table, wide
from hypothesis import given, settings
from hypothesis import strategies as st

import oracle
from strataflow.llm import queries, spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def word_sets():
    rng = random.Random(4)
    few = {"".join(rng.choices("ab", k=rng.randrange(5, 10))) for _ in range(250)}
    some = {"".join(rng.choices("abcé", k=rng.randrange(5, 9))) for _ in range(300)}
    near = set()
    for _ in range(40):
        w = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzÿß", k=rng.randrange(5, 15)))
        near |= {w, w[:3] + w[4:] + "z", w + "q", "q" + w, w[:2] + "x" + w[2:], w[:-1] + "k", w[1:]}
    return {"few": few, "some": some, "near": {w for w in near if len(w) >= 5}, "same": {"a" * k for k in range(5, 30)}, "long": {"xy" * 4000, "xy" * 4000 + "z", "z" + "xy" * 4000}}


@pytest.mark.parametrize("kind", ["few", "some", "near", "same", "long"])
def test_near_words(spark, kind):
    words = {w: k + 3 for k, w in enumerate(sorted(word_sets()[kind]))}
    want = sorted((a, b, words[a], words[b]) for a, b in itertools.combinations(sorted(words), 2) if one_edit(a, b))
    got = spelling.near_words(spark.createDataFrame(list(words.items()), "word string, n long"))
    assert sorted(tuple(r) for r in got.select("a", "b", "n_a", "n_b").collect()) == want and want


def compare(spark, tmp_path, rows, name):
    df = frame(spark, rows)
    path = str(tmp_path / f"{name}.parquet")
    df.coalesce(1).write.parquet(path)
    con = oracle.duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    got = spelling.spelling_groups(df, slips=97)
    problem = oracle.compare(name, got, con, queries.SPELLING_SQL)
    assert problem is None or problem.endswith("both empty")
    return got


def test_awkward_documents(spark, tmp_path):
    rng = random.Random(6)
    base = ["".join(rng.choices("abdeÉé", k=rng.randrange(4, 9))) for _ in range(60)]
    texts = [" ".join(rng.choices(base, weights=range(1, 61), k=rng.randrange(1, 200))).upper() for _ in range(60)]
    rows = [(k, t, "en", "s", 1) for k, t in enumerate(texts)] + documents(8)
    got = compare(spark, tmp_path, rows, "awkward")
    assert got.filter("form IS NOT NULL").count() > 3
    assert table(spelling.spelling_groups(wide(spark, rows), slips=97)) == table(got)


def test_hot_word_and_empty(spark, tmp_path):
    rows = [(k, "Common common WORDS " * (1 + 300 * (k % 3 == 0)), "en", "s", 1) for k in range(60)] + [(None, "wordz wordz wordz", "en", "s", 1)]
    compare(spark, tmp_path, rows, "hot")
    assert spelling.spelling_groups(frame(spark, [])).count() == 0
    assert spelling.spelling_groups(frame(spark, [(1, None, None, None, None), (2, "", "", "", 0)])).count() == 0


def test_chain_of_forms(spark):
    """Every form is near the next and at least twice as common; the last is the root of all."""
    chain = ["aaaaa" + "b" * k for k in range(20)]
    words = [(w, 3 * 2**k) for k, w in enumerate(chain)] + [("zzzzz", 10)]
    got = {r.word: r for r in spelling.spelling_forms(spark.createDataFrame(words, "word string, n long")).collect()}
    assert all(got[w].root == chain[-1] and got[w].form == n and got[w].form_n == got[n].n for w, n in zip(chain, chain[1:]))
    assert got[chain[-1]].form is None and got[chain[-1]].root == chain[-1]
    assert (got["zzzzz"].form, got["zzzzz"].root, got["zzzzz"].n_near, got["zzzzz"].form_n) == (None, "zzzzz", 0, None)


def test_ties_and_short_words(spark):
    words = [("abcde", 3), ("abcdz", 6), ("abcdf", 6), ("abcdy", 5)]
    got = {r.word: r.form for r in spelling.spelling_forms(spark.createDataFrame(words, "word string, n long")).collect()}
    assert got == {"abcde": "abcdf", "abcdz": None, "abcdf": None, "abcdy": None}
    with pytest.raises(Exception, match="code points"):
        spelling.near_words(spark.createDataFrame([("abc", 3)], "word string, n long")).count()


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 30), min_size=3, max_size=9), st.data())
def test_pivots_are_the_cheapest(places, data):
    places = sorted(places)
    costs = data.draw(st.lists(st.integers(1, 50), min_size=len(places), max_size=len(places)))
    cost = dict(zip(places, costs))
    got = spelling.pivots(places, costs)
    apart = [c for c in itertools.combinations(places, 2) if c[1] - c[0] >= 2]
    assert tuple(got) in apart and sum(cost[p] for p in got) == min(sum(cost[p] for p in c) for c in apart)
