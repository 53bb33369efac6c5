"""Exact and near duplicates, contamination and repeated passages against brute force."""

import collections
import glob
import hashlib
import random
import re
import tempfile
import time

import numpy as np
import pytest
from cases import documents, frame, table, wide, words

from strataflow.llm import near
from strataflow.llm.common import shared_table
from strataflow.llm.contamination import contamination_report, drop_contaminated
from strataflow.llm.exact import drop_exact, exact_groups
from strataflow.llm.near import drop_near, near_groups, probability_jaccard
from strataflow.llm.repeats import radix_groups, remove_repeats

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def cut(text):
    return WORD.findall((text or "").translate(UPPER))


def test_exact_against_brute_force(spark):
    rows = documents()
    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[re.sub("[ \t-\r]", "", t or "")].append((-len(t or ""), i is None, i))
    got = exact_groups(frame(spark, rows))
    want = collections.Counter()
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1], m[2] or 0))[2]
        for _, _, i in members:
            want[(i, keep, len(members), hashlib.sha256(norm.encode()).hexdigest())] += 1
    assert collections.Counter((r[0], r[1], r[2], r[4]) for r in got.collect()) == want
    assert got.filter("kept").count() == len(groups)
    assert table(exact_groups(wide(spark, rows))) == table(got)
    kept = drop_exact(wide(spark, rows))
    assert kept.columns == wide(spark, rows).columns and kept.count() == len(groups)
    assert exact_groups(frame(spark, [])).count() == 0 and drop_exact(frame(spark, [])).count() == 0


def test_exact_splits_a_hot_group(spark):
    rows = [(k, "same text here", "en", "s", 1) for k in range(500)] + [(k, f"other {k}", "en", "s", 1) for k in range(500, 1000)]
    got = exact_groups(frame(spark, rows))
    assert got.filter("group_size = 500 AND keep_id = 0").count() == 500 and got.filter("kept").count() == 501


def test_contamination_against_brute_force(spark, monkeypatch):
    rows = documents(2)
    rng = random.Random(5)
    texts = [t for _, t, *_ in rows if t]
    items = [(1, words(rng, 30)), (2, " ".join(cut(texts[0])[:14])), (3, "one"), (10, "one"), (4, None), (5, "  "), (None, "ünïcödé"), (2, "w1 w2"), (6, " ".join(cut(texts[4])[2:9]).upper())]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = cut(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(i)
    want = []
    for i, t, *_ in rows:
        w, hit, found = cut(t), set(), set()
        for win, owners in windows.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    found |= {str(o) for o in owners if o is not None}
        want.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    got = contamination_report(frame(spark, rows), bench)
    assert table(got, "spans") == sorted(want, key=repr)
    assert table(contamination_report(wide(spark, rows), bench)) == table(got)
    monkeypatch.setattr("strataflow.llm.contamination.BLOCK_WINDOWS", 3)
    assert table(contamination_report(frame(spark, rows), bench)) == table(got)
    clean = drop_contaminated(wide(spark, rows), bench)
    assert clean.columns == wide(spark, rows).columns and clean.count() == sum(not r[5] for r in want)
    assert contamination_report(frame(spark, rows), bench.limit(0)).filter("contaminated").count() == 0
    assert contamination_report(frame(spark, []), bench).count() == 0


def brute_groups(rows):
    sets = []
    for i, t, *_ in rows:
        w = cut(t)
        sets.append(collections.Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w and i is not None else None)
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            a, b = sets[x], sets[y]
            if not a or not b or min(sum(a.values()), sum(b.values())) < 0.5 * max(sum(a.values()), sum(b.values())):
                continue
            similar = sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in a | b) for i in a.keys() & b.keys())
            if similar >= 0.8 - 1e-9:
                up[top(x)] = top(y)
    members = collections.defaultdict(list)
    for x in range(len(rows)):
        members[top(x)].append(rows[x][0])
    return sorted(((i, min(m) if i is not None else None, len(m)) for m in members.values() for i in m), key=repr)


def test_near_against_brute_force(spark):
    rows = documents(3)
    got = near_groups(frame(spark, rows))
    assert table(got, "kept") == brute_groups(rows)
    assert table(near_groups(wide(spark, rows))) == table(got)
    kept = drop_near(wide(spark, rows))
    assert kept.columns == wide(spark, rows).columns
    assert kept.count() == got.filter("kept").count()
    assert near_groups(frame(spark, [])).count() == 0 and drop_near(frame(spark, [])).count() == 0


def test_near_links_members_that_miss_their_hub(spark, monkeypatch):
    """A chain of versions, each close to the next only, and blocks of three."""
    monkeypatch.setattr(near, "BLOCK", 3)
    rng = random.Random(4)
    w = words(rng, 150, 100_000).split()
    rows = []
    for k in range(20):
        rows.append((k, " ".join(w), "en", "s", 1))
        for p in (7 * k + 1, 7 * k + 3):
            w[p % len(w)] = f"new{k}x{p}"
    want = brute_groups(rows)
    assert max(r[2] for r in want) > 10
    assert table(near_groups(frame(spark, rows)), "kept") == want


def test_probability_jaccard():
    a, b = np.array([1, 2, 3], np.uint64), np.array([2, 3, 4], np.uint64)
    assert probability_jaccard(a, np.ones(3), b, np.ones(3)) == pytest.approx(0.5)
    u, v = {1: 2, 2: 1, 3: 4}, {1: 1, 2: 1, 3: 4, 9: 3}
    want = sum(1 / sum(max(u.get(j, 0) / u[i], v.get(j, 0) / v[i]) for j in u | v) for i in u.keys() & v.keys())
    got = probability_jaccard(np.array(list(u), np.uint64), np.array(list(u.values())), np.array(list(v), np.uint64), np.array(list(v.values())))
    assert got == pytest.approx(want)


def test_sketches_estimate_the_similarity():
    rng = np.random.default_rng(1)
    got = []
    for trial in range(40):
        h = near.mix(np.arange(1, 1201, dtype=np.uint64) + np.uint64(trial * 10_000))
        weight = rng.integers(1, 4, 1200)
        a, b = np.arange(0, 1000), np.arange(100, 1100)
        sig = near.prob_minhash(np.repeat([0, 1], 1000), np.concatenate([h[a], h[b]]), np.concatenate([weight[a], weight[b]]).astype(float), 2)
        oa, ob = np.argsort(h[a]), np.argsort(h[b])
        got.append((sig[0] == sig[1]).mean() - probability_jaccard(h[a][oa], weight[a][oa], h[b][ob], weight[b][ob]))
    assert abs(np.mean(got)) < 0.02 and np.abs(got).max() < 0.15


def brute_repeats(rows):
    first = {}
    for i, t, *_ in rows:
        b = (t or "").encode()
        i = float("inf") if i is None else i
        for s in range(len(b) - 49):
            w = b[s : s + 50]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t, *_ in rows:
        b = (t or "").encode()
        own, gone, end = float("inf") if i is None else i, bytearray(len(b)), 0
        for s in range(len(b) - 49):
            if first[b[s : s + 50]] < own:
                for j in range(max(s, end), s + 50):
                    gone[j] = 1
                end = s + 50
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(gone[j] and not (j and gone[j - 1]) for j in range(len(b)))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [False, True])
def test_repeats_against_brute_force(spark, monkeypatch, hot):
    if hot:  # every anchor that the sample shows twice is dealt out by stretch, and its windows one by one
        monkeypatch.setattr("strataflow.llm.repeats.SAMPLE", 1)
        monkeypatch.setattr("strataflow.llm.repeats.HOT_LEAST", 2)
    rows = documents(6)
    rng = random.Random(8)
    line = "Licensed to everybody under these fifty and a few more terms."
    rows += [(100 + k, f"{words(rng, 20)} {line}{'!' * (k % 3)} {words(rng, 20)}", "en", "s", 1) for k in range(12)]
    rows += [(200 + k, "ha " * (30 + k) + words(rng, 3), "en", "s", 1) for k in range(6)]
    got = remove_repeats(frame(spark, rows), keep_text=False)
    assert table(got) == brute_repeats(rows)
    assert table(remove_repeats(wide(spark, rows), keep_text=False)) == table(got)
    assert remove_repeats(frame(spark, [])).count() == 0


def test_radix_groups():
    raw = np.frombuffer(b"a" * 49 + b"b" + b"a" * 49 + b"c" + b"a" * 49 + b"b", np.uint8)
    assert radix_groups(raw, np.array([0, 50, 100]), np.array([3, 1, 9])).tolist() == [False, False, True]


def test_equal_hot_windows_are_settled_before_they_meet():
    import random

    import pyarrow as pa

    from strataflow.llm import repeats

    r = random.Random(4)
    passage = "".join(r.choice("abcdefgh") for _ in range(52))  # three windows
    ids = r.sample(range(5000), 600)
    texts = ["".join(r.choice("uvwxyz") for _ in range(20)) + passage + "".join(r.choice("uvwxyz") for _ in range(20)) for _ in ids]
    found = [[{"code": 0 << 8 | 43 << 1 | 1, "name": 1}]] * 600  # every window of a text
    batch = pa.RecordBatch.from_pydict({"id": ids, "key": [7] * 600, "text": texts, "found": found})
    sent = [x for b in repeats._stretches([batch]) for x in b.to_pylist()]
    assert sum(x["bytes"] == passage[:50].encode() for x in sent) == 1
    sent_batches = [pa.RecordBatch.from_pylist(sent[k : k + 1000], schema=repeats._STRETCH) for k in range(0, len(sent), 1000)]
    got = {(x["id"], (x["code"] >> 8) + i) for b in repeats._compare(sent_batches) for x in b.to_pylist() for i in range(x["code"] >> 1 & 127)}
    least = {}
    for i, t in sorted(zip(ids, texts, strict=True), reverse=True):
        least |= {t[at : at + 50]: i for at in range(43)}
    want = {(i, at) for i, t in zip(ids, texts, strict=True) for at in range(43) if least[t[at : at + 50]] < i}
    assert got == want and len(want) >= 3 * 599


def test_repeats_of_one_row_stay_linear(spark):
    """Copies of a row share their spans: each has what one alone has, and lists do not grow with the copies."""
    text = words(random.Random(31), 900)
    alone = {r.doc_id: tuple(r)[1:] for r in remove_repeats(frame(spark, [(1, text, "en", "s", 1), (2, "a " + text, "en", "s", 1)])).collect()}
    many = remove_repeats(frame(spark, [(1, text, "en", "s", 1)] + [(2, "a " + text, "en", "s", 1)] * 150)).collect()
    assert len(many) == 151 and all(tuple(r)[1:] == alone[r.doc_id] for r in many) and alone[2][1] > 4000


def test_repeats_leave_no_exchange_and_read_small_batches(spark):
    """A table's own exchange goes when it is written, and texts reach Python in bounded batches."""
    files = lambda: set(glob.glob(f"{spark.conf.get('spark.local.dir', tempfile.gettempdir())}/blockmgr-*/*/shuffle_*.data"))
    before = files()
    shared_table(spark.range(10_000).repartition(5, "id"), "freed")
    for _ in range(20):
        if not (left := files() - before):
            break
        time.sleep(0.5)
    assert not left
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, 10_000)
    try:
        remove_repeats(frame(spark, [(1, "a", "en", "s", 1)]))
        assert int(spark.conf.get(key)) <= 1000
    finally:
        spark.conf.unset(key)
