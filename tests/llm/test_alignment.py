"""Alignment of two vocabularies against brute force with the vocabularies' own libraries."""

import collections
import hashlib
import random

import numpy as np
import pytest
from cases import documents, frame, table, wide
from hypothesis import given, settings
from hypothesis import strategies as st

from strataflow.llm import alignment

SPECIAL = [
    "<|endoftext|> <s> </s> <unk> <0x41>",
    "sign ▁ inside",
    "  two  spaces \n\n\t tabs \r\n",
    "漢字かな交じり文 👩‍👩‍👧 ẞ ﬁ é é",
    "don't we'll I'M 12345678 ١٢٣ x²",
    "\x00\x01\x7f\x85 ﻿�",
    "the the the the the",
    "aaaaaaaaaaaaaaaaaaaaaaaa" * 40,
]


def brute(texts):
    """Rows by position, from the libraries' own encoders and all pairs of byte ranges."""
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(alignment.BYTES)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECES)
    signs = alignment.byte_signs()
    rows = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        a = one.encode(" " + (text or ""), add_special_tokens=False).ids
        b = two.encode(text or "")
        a_bytes = [bytes(signs[c] for c in one.id_to_token(k)) for k in a]
        b_bytes = [bytes([int(p[3:-1], 16)]) if two.is_byte(k) else p.replace("▁", " ").encode() for k in b for p in [two.id_to_piece(k)]]
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            rows.append(None)
            continue
        ranges = []
        for tokens in (a_bytes, b_bytes):
            ends = np.cumsum([len(t) for t in tokens]).tolist()
            ranges.append(list(zip([0, *ends], ends)))
        cuts = sorted({e for _, e in ranges[0]} & {e for _, e in ranges[1]})
        text_groups, lo = [], 0
        for cut in cuts:
            sides = [",".join(str(k) for k, (s, e) in zip(ids, r) if lo <= s and e <= cut) for ids, r in zip((a, b), ranges)]
            text_groups.append("|".join(sides))
            lo = cut
        links = [(x, y) for x, (s, e) in zip(a, ranges[0]) for y, (s2, e2) in zip(b, ranges[1]) if s < e2 and s2 < e]
        rows.append((len(a), len(b), ";".join(text_groups), links))
    held = collections.Counter(p for r in rows if r for p in set(r[3]))
    most = collections.defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for r in rows:
        if r is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = r
        sha = hashlib.sha256(groups.encode()).hexdigest()
        out.append((a, b, groups.count(";") + 1, len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), sha))
    return out, held, most, [r and r[2] for r in rows]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def cases():
    rows = [(k + 500, t, "en", "s", 1) for k, t in enumerate(SPECIAL)] + [r for r in documents(5) if r[1] is None or len(r[1]) < 6000]
    rng = random.Random(3)
    return rows + [(k + 900, " ".join(rng.choices(["the", "of", "Unbelievable", "tion", "naïve"], k=k % 30)), "en", "s", 1) for k in range(60)]


def test_report(spark):
    rows = cases()
    want, *_ = brute([r[1] for r in rows])
    got = alignment.alignment_report(frame(spark, rows).repartition(3))
    expected = sorted(((r[0], *w) for r, w in zip(rows, want)), key=repr)
    assert sorted((tuple(r) for r in got.select("doc_id", *COLUMNS).collect()), key=repr) == expected
    assert table(alignment.alignment_report(wide(spark, rows))) == table(got)
    assert sum(w[0] == 0 for w in want) > 3


def test_outputs(spark):
    rows = cases()
    _, held, most, groups = brute([r[1] for r in rows])
    got = alignment.align_tokens(frame(spark, rows)).collect()
    assert sorted((repr(r.doc_id), r.groups) for r in got) == sorted((repr(r[0]), g or "") for r, g in zip(rows, groups))
    links = alignment.token_links(frame(spark, rows)).collect()
    assert {(r.id_a, r.id_b): r.documents for r in links} == dict(held)
    assert all(r.best == (r.documents == most[r.id_a]) for r in links)


def test_empty(spark):
    empty = frame(spark, [])
    assert alignment.alignment_report(empty).count() == alignment.align_tokens(empty).count() == alignment.token_links(empty).count() == 0


def test_long_text(spark):
    text = "Überlänge words, " * 150_000
    one, short = alignment.alignment_report(frame(spark, [(1, text, "en", "s", 1), (2, "Überlänge", "en", "s", 1)])).orderBy("doc_id").collect()
    assert one.n_links == one.n_a + one.n_b - one.n_groups > 10**6 and short.n_a


@settings(max_examples=200, deadline=None)
@given(st.lists(st.booleans(), min_size=1, max_size=200), st.lists(st.booleans(), min_size=1, max_size=200))
def test_runs(left, right):
    """Runs and groups cover both rows in order, and no end inside a group is common."""
    n = min(len(left), len(right))
    a, b = ([k for k in range(n) if x[k]] + [n] for x in (left, right))
    ones, others = alignment.runs(np.array(a), np.array(b))
    parts = sorted([(i + k, i + k + 1, j + k, j + k + 1) for i, j, length in ones for k in range(length)] + others)
    assert [x for i, i1, *_ in parts for x in range(i, i1)] == list(range(len(a)))
    assert [x for *_, j, j1 in parts for x in range(j, j1)] == list(range(len(b)))
    assert [a[i1 - 1] for _, i1, *_ in parts] == [b[j1 - 1] for *_, j1 in parts] == sorted(set(a) & set(b))
    assert all((i1 - i, j1 - j) != (1, 1) for i, i1, j, j1 in others)


@pytest.mark.parametrize("bad", [b'{"pre_tokenizer": {"type": "Whitespace"}, "normalizer": null}'])
def test_other_kinds_are_refused(bad):
    with pytest.raises(ValueError):
        alignment.Vocabularies(bad, b"")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.booleans(), min_size=1, max_size=200), st.lists(st.booleans(), min_size=1, max_size=200))
def test_staircase(left, right):
    """Tokens of groups that are not one-to-one are linked where their bytes overlap, from rows of ends as arrays."""
    n = min(len(left), len(right))
    a, b = ([k for k in range(n) if x[k]] + [n] for x in (left, right))
    _, others = alignment.runs(np.array(a), np.array(b))
    if others:
        begin_a, begin_b = [-1, *a], [-1, *b]
        want = [(i, j) for i0, i1, j0, j1 in others for i in range(i0, i1) for j in range(j0, j1) if begin_a[i] < b[j] and begin_b[j] < a[i]]
        got = alignment.staircase(others, np.array(a), np.array(b))
        assert all(isinstance(x, np.ndarray) for x in got) and sorted(zip(*(x.tolist() for x in got), strict=True)) == sorted(want)
