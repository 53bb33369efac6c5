"""Shards: equal counts, mixture, gapless slots, the same rows as SQL on awkward tables, whole files."""

import collections
import zlib

import pytest
from cases import SCHEMA, documents, frame, table, wide

import oracle
from strataflow.llm import queries, sharding


def rows(n, sources, seed=1):
    """`n` rows, a third of them in the first source."""
    return [(k, f"text {k} é" * (k % 5), "en", sources[0] if k % 3 == 0 else sources[k % len(sources)], 1) for k in range(n)]


CASES = {
    "awkward": documents(3),
    "hot": rows(1000, ["a", "b", "c", "d", None]),
    "few": rows(7, ["a"]),
    "one": rows(1, ["a"]),
    "singles": [(k, "t", "en", f"s{k}", 1) for k in range(300)],
    "repeated": [(5, "same", "en", "a", 1)] * 400 + rows(200, ["a", "b"]),
    "ids": [(k % 10, f"text {k % 4}", "en", "a" if k % 2 else "", 1) for k in range(200)] + [(None, None, None, None, None)] * 3,
}


@pytest.mark.parametrize("case", CASES)
def test_shards(spark, tmp_path, case):
    given = CASES[case]
    df = frame(spark, given)
    out = sharding.shard_table(df).collect()
    assert collections.Counter((r.doc_id, r.source, r.text_crc32) for r in out) == collections.Counter((i, s, zlib.crc32((t or "").encode())) for i, t, _, s, _ in given)
    slots = collections.defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        assert 0 <= r.shard < 40 and r.law == "rows" and r.grown_shard is None
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    counts = [len(slots[s]) for s in range(40)]
    assert max(counts) - min(counts) <= 1
    total = collections.Counter(r.source for r in out)
    held = collections.Counter((r.source, r.shard) for r in out)
    for s in total:
        for k in range(40):
            assert abs(held[s, k] - total[s] * counts[k] / len(out)) <= 2 + len(total) / len(out) * total[s]
    path = str(tmp_path / "documents.parquet")
    df.coalesce(1).write.parquet(path)
    con = oracle.duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    assert oracle.compare(case, sharding.shard_table(df), con, queries.SHARDS_SQL) is None


def test_empty_and_wide(spark):
    assert sharding.shard_table(frame(spark, [])).count() == 0
    given = documents(4)
    assert table(sharding.shard_table(wide(spark, given))) == table(sharding.shard_table(frame(spark, given)))


def test_other_shard_counts_and_seeds(spark):
    df = frame(spark, rows(101, ["a", "b"]))
    one = sharding.interleave(df, shards=3, seed=1)
    assert sorted(r["count"] for r in one.groupBy("shard").count().collect()) == [33, 34, 34]
    assert table(one) == table(sharding.interleave(df.repartition(7), shards=3, seed=1)) != table(sharding.interleave(df, shards=3, seed=2))


def test_files(spark, tmp_path):
    given = CASES["awkward"] + CASES["repeated"]
    df = frame(spark, given)
    sharding.write_shards(df, str(tmp_path / "out"), shards=5, files=2)
    back = spark.read.schema(SCHEMA + ", slot long, shard int").parquet(str(tmp_path / "out"))
    assert table(back, "slot", "shard") == sorted(given, key=repr)
    places = sharding.interleave(df, shards=5)
    assert table(back.select("doc_id", "shard", "slot")) == table(places.select("doc_id", "shard", "slot"))


def test_native_and_hot_source_is_cut(spark):
    plan = sharding.shard_table(frame(spark, CASES["hot"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
