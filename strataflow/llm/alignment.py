"""Tokens of two vocabularies aligned by the bytes they cover: diagonal run skipping.

Both token rows of a text are given by the byte offsets at which their tokens end. Where token i of A and token i + shift
of B end together, so do many of their successors: runs of such one-to-one tokens are found by doubling the stretch that is
compared and halving it at the end. Between runs, tokens are taken one by one until both ends meet again; that group fixes
the next shift.
"""

from __future__ import annotations

import hashlib
import json
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, select_texts, shared_table

BYTES = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: How the byte-level vocabulary cuts a text before it merges (a fixed value of its kind).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Ends that are compared first; the stretch doubles from there.
PROBE = 16


def byte_signs() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable Latin-1 signs for themselves, the other
    bytes in order for the signs from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabularies:
    """Both tokenizers, and the bytes of each of their tokens, from the contents of their files."""

    def __init__(self, a_json: bytes, b_model: bytes):
        import sentencepiece
        import tiktoken

        file = json.loads(a_json)
        if file["pre_tokenizer"]["type"] != "ByteLevel" or file["normalizer"]:
            raise ValueError("A must be a byte-level vocabulary without normaliser")
        signs = byte_signs()
        own = {bytes(signs[c] for c in entry): k for entry, k in file["model"]["vocab"].items()}
        order = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
        merged = [file["model"]["vocab"]["".join(m)] for m in order]
        if merged != sorted(merged) or len({bytes([b]) for b in range(256)} & own.keys()) < 256:
            raise ValueError("A's ids must follow its merges and hold every byte")
        # The same vocabulary and merge order in a faster engine; special tokens are not given to it, so they are text.
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=own, special_tokens={})
        self.a_bytes = [b""] * (max(own.values()) + 1)
        for token, k in own.items():
            self.a_bytes[k] = token
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.b_bytes = []
        for k in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(k)
            self.b_bytes.append(bytes([int(piece[3:-1], 16)]) if self.b.is_byte(k) else piece.replace("▁", " ").encode())
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.a_name = [f"{k}|" for k in range(len(self.a_bytes))]
        self.b_name = [f"{k};" for k in range(len(self.b_bytes))]

    @classmethod
    def of(cls, shared) -> Vocabularies:
        """Built once for each Python worker: its copy of the broadcast keeps them for the next tasks."""
        if "built" not in shared.value:
            shared.value["built"] = cls(*shared.value["files"])
        return shared.value["built"]

    def tokens(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of A and B for each text; none where a text is empty or the ids do not give it back."""
        out = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            raw = f" {text}".encode()
            # A has every byte and no normaliser, so its tokens always give the text back; B's may not.
            same = text and b"".join(map(self.b_bytes.__getitem__, b)) == raw
            out.append((self.a.encode_ordinary(f" {text}"), b) if same else ([], []))
        return out


def runs(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[list, list]:
    """One-to-one runs (first token of A, first of B, length) and the other groups (A from, to, B from, to), in order,
    of two rows of ends with the same last end."""
    wide = len(a_ends) and int(a_ends[-1]) >> 32
    kind, step = (np.uint64, 8) if wide else (np.uint32, 4)
    a_raw, b_raw, a, b = a_ends.astype(kind).tobytes(), b_ends.astype(kind).tobytes(), a_ends.tolist(), b_ends.tolist()
    number = int.from_bytes
    i = j = 0
    ones, others = [], []
    n = len(a)
    while i < n:
        if a[i] == b[j]:
            # Compare a stretch of ends, as two numbers, and double it while they are equal; else the lowest bit that
            # differs is in the first end that does. Past the end of one row there are only zeros or the other's ends.
            p, q, size = i * step, j * step, PROBE * step
            while True:
                apart = number(a_raw[p : p + size], "little") ^ number(b_raw[q : q + size], "little")
                if apart or p + size >= len(a_raw):
                    break
                p, q, size = p + size, q + size, 2 * size
            length = n - i if not apart else p // step - i + ((apart & -apart).bit_length() - 1) // (8 * step)
            ones.append((i, j, length))
            i += length
            j += length
        else:
            i0, j0 = i, j
            x, y = a[i], b[j]
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            i += 1
            j += 1
            others.append((i0, i, j0, j))
    return ones, others


def spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each `begin` on, `size` of them."""
    return np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)


def staircase(others: list, a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token places of A and B whose byte ranges overlap, for groups that are not one-to-one: bytes between two ends that
    follow each other belong to one token of each."""
    i, i1, j, j1 = np.fromiter(chain.from_iterable(others), np.int64, 4 * len(others)).reshape(-1, 4).T
    left, right = spread(i, i1 - i), spread(j, j1 - j)
    a, b = a_ends[left], b_ends[right]
    ends = np.concatenate([a, b])
    ends.sort(kind="stable")
    ends = ends[np.append(ends[1:] != ends[:-1], True)]
    return left[np.searchsorted(a, ends)], right[np.searchsorted(b, ends)]


def group_text(ones: list, others: list, a: list, b: list) -> str:
    """`a1,a2|b1;a3|b2,b3`: the groups in order. `a` and `b` are the tokens' names, followed by `|` and by `;`."""
    out, at, n_others = [], 0, len(others)
    add = out.append
    for i, j, n in [*ones, (len(a), len(b), 0)]:
        while at < n_others and others[at][0] < i:
            i0, i1, j0, j1 = others[at]
            at += 1
            add(a[i0] if i1 - i0 == 1 else "".join(a[i0:i1]).replace("|", ",", i1 - i0 - 1))
            add(b[j0] if j1 - j0 == 1 else "".join(b[j0:j1]).replace(";", ",", j1 - j0 - 1))
        if n == 1:
            add(a[i])
            add(b[j])
        elif n:
            both = [""] * (2 * n)
            both[::2], both[1::2] = a[i : i + n], b[j : j + n]
            out += both
    return "".join(out)[:-1]


class Aligned:
    """One text's tokens and groups."""

    def __init__(self, v: Vocabularies, a: list[int], b: list[int]):
        self.v, self.a, self.b = v, a, b
        self.a_ids, self.b_ids = np.array(a, np.int32), np.array(b, np.int32)
        self.a_ends, self.b_ends = np.cumsum(v.a_size[self.a_ids]), np.cumsum(v.b_size[self.b_ids])
        self.ones, self.others = runs(self.a_ends, self.b_ends)
        self.n_groups = sum(n for *_, n in self.ones) + len(self.others)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A and of B, for each pair of tokens whose bytes overlap."""
        first_a, first_b, n = np.fromiter(chain.from_iterable(self.ones), np.int64, 3 * len(self.ones)).reshape(-1, 3).T
        i, j = spread(first_a, n), spread(first_b, n)
        if self.others:
            left, right = staircase(self.others, self.a_ends, self.b_ends)
            i, j = np.concatenate([i, left]), np.concatenate([j, right])
        return self.a_ids[i].astype(np.int64), self.b_ids[j].astype(np.int64)

    def groups(self) -> str:
        return group_text(self.ones, self.others, list(map(self.v.a_name.__getitem__, self.a)), list(map(self.v.b_name.__getitem__, self.b)))


def _files(df: DataFrame, a: str, b: str):
    """Contents of both vocabulary files, whose size does not depend on the data."""
    contents = []
    for path in (a, b):
        with open(path, "rb") as f:
            contents.append(f.read())
    return df.sparkSession.sparkContext.broadcast({"files": contents})


def _groups(shared):
    def run(batches):
        v = Vocabularies.of(shared)
        for batch in chunks(batches):
            rows = [Aligned(v, a, b) for a, b in v.tokens(batch["text"].to_pylist())]
            cols = [pa.array([x.a for x in rows], pa.list_(pa.int32())), pa.array([x.b for x in rows], pa.list_(pa.int32()))]
            cols.append(pa.array([x.groups() for x in rows], pa.string()))
            yield pa.RecordBatch.from_arrays([batch["id"], *cols], names=["id", "ids_a", "ids_b", "groups"])

    return run


def align_tokens(df: DataFrame, id_col="doc_id", text_col="text", a=BYTES, b=PIECES) -> DataFrame:
    """Tokens of every text in both vocabularies and their groups: id, ids_a, ids_b, groups (`a1,a2|b1;a3|b2,b3`).

    One row per input row, repeated rows and null ids included. A null or empty text, and one that either vocabulary does
    not give back byte by byte, has no tokens. Other columns are not read. A narrow pass over whole texts.
    """
    src = select_texts(df, id_col, text_col)
    kind = src.schema["id"].dataType.simpleString()
    out = src.mapInArrow(_groups(_files(df, a, b)), f"id {kind}, ids_a array<int>, ids_b array<int>, groups string")
    return out.withColumnRenamed("id", id_col)


def _counted(shared, width, schema):
    """For each text its figures and links; for each block of texts its different links, and in how many texts they are.
    A text names its links by their place in the block's list."""

    def run(batches):
        from pyspark import TaskContext

        v = Vocabularies.of(shared)
        block = TaskContext.get().partitionId() << 32
        for batch in chunks(batches):
            figures = {k: [] for k in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
            pairs, times, sizes = [], [], []
            for a, b in v.tokens(batch["text"].to_pylist()):
                x = Aligned(v, a, b)
                left, right = x.links()
                pair, count = np.unique(left * width + right, return_counts=True)
                pairs.append(pair)
                times.append(count.astype(np.int32))
                sizes.append(len(pair))
                sha = hashlib.sha256(x.groups().encode()).hexdigest() if a else ""
                for k, value in zip(figures, (len(a), len(b), x.n_groups, len(left), sha), strict=True):
                    figures[k].append(value)
            every = np.concatenate([np.zeros(0, np.int64), *pairs])
            own, place, docs = np.unique(every, return_inverse=True, return_counts=True)
            place = place.astype(np.int32)
            at = np.cumsum([0, *sizes])
            n = len(sizes)
            columns = {
                "block": [block] * n,
                "id": batch["id"],
                **figures,
                "place": [place[lo:hi].tobytes() for lo, hi in zip(at[:-1], at[1:], strict=True)],
                "times": [t.tobytes() for t in times],
                # Once for each block, in its first row.
                "pairs": [own.tolist() if k == 0 else None for k in range(n)],
                "docs": [docs.tolist() if k == 0 else None for k in range(n)],
            }
            yield pa.RecordBatch.from_pydict(columns, schema=schema(batch.schema.field("id").type))
            block += 1

    return run


def _summed(kept):
    def run(texts, answers):
        """Sums over a text's links; `answers` has one row for each different link of the block."""
        place = answers["place"].to_numpy()
        count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        count[place], best[place] = answers["count"].to_numpy(), answers["best"].to_numpy()
        n_best, count_sum = [], []
        for at, times in zip(texts["place"].to_pylist(), texts["times"].to_pylist(), strict=True):
            at, times = np.frombuffer(at, np.int32), np.frombuffer(times, np.int32).astype(np.int64)
            n_best.append(int(times @ best[at]))
            count_sum.append(int(times @ count[at]))
        return texts.select(kept).append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))

    return run


def _blocks(df: DataFrame, id_col: str, text_col: str, a: str, b: str) -> tuple[DataFrame, int]:
    """The written table of aligned texts, and the factor that joins an id of A and one of B to a pair."""
    shared = _files(df, a, b)
    width = len(Vocabularies(*shared.value["files"]).b_bytes)
    src = select_texts(df, id_col, text_col)
    from pyspark.sql.pandas.types import to_arrow_schema

    long = [T.StructField(k, T.LongType()) for k in ("n_a", "n_b", "n_groups", "n_links")]
    fields = T.StructType(
        [
            T.StructField("block", T.LongType()),
            src.schema["id"],
            *long,
            T.StructField("groups_sha256", T.StringType()),
            T.StructField("place", T.BinaryType()),
            T.StructField("times", T.BinaryType()),
            T.StructField("pairs", T.ArrayType(T.LongType())),
            T.StructField("docs", T.ArrayType(T.LongType())),
        ]
    )
    plain = to_arrow_schema(fields)
    schema = lambda kind: plain.set(1, pa.field("id", kind))
    return shared_table(src.mapInArrow(_counted(shared, width, schema), fields), "aligned"), width


def _requests(blocks: DataFrame) -> DataFrame:
    """(block, place, pair, docs): one row for each different link of a block."""
    listed = blocks.filter("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "x"))
    return listed.select("block", "place", F.col("x.pairs").alias("pair"), F.col("x.docs").alias("docs"))


def _pair_counts(requests: DataFrame, width: int) -> DataFrame:
    """(pair, count, best): documents that hold the pair linked, and whether no pair of its A id is in more."""
    counts = requests.groupBy("pair").agg(F.sum("docs").alias("count"))
    # An id of A has as many rows as B has ids at most.
    most = F.max("count").over(Window.partitionBy(F.expr(f"pair div {width}")))
    return counts.select("pair", "count", (F.col("count") == most).cast("long").alias("best"))


def token_links(df: DataFrame, id_col="doc_id", text_col="text", a=BYTES, b=PIECES) -> DataFrame:
    """The dictionary between the vocabularies: id_a, id_b, documents (that hold the two linked), best (no other id of B
    is linked to id_a in more documents). Texts as in `align_tokens`; an empty table gives no rows."""
    blocks, width = _blocks(df, id_col, text_col, a, b)
    counts = _pair_counts(_requests(blocks), width)
    return counts.select(
        F.expr(f"CAST(pair div {width} AS INT)").alias("id_a"),
        F.expr(f"CAST(pair % {width} AS INT)").alias("id_b"),
        F.col("count").alias("documents"),
        (F.col("best") == 1).alias("best"),
    )


def alignment_report(df: DataFrame, id_col="doc_id", text_col="text", a=BYTES, b=PIECES) -> DataFrame:
    """Figures of each text's alignment: id, n_a, n_b, n_groups, n_links (pairs of tokens that share bytes), n_best (links
    whose pair is in the most documents of all pairs of its A id), count_sum (documents of the pair, over links),
    groups_sha256.

    One row per input row; each row is a document, so repeated rows count once each. A null or empty text, and one that
    either vocabulary does not give back, has zeros and an empty hash. Null ids are kept. Other columns are not read; an
    empty table gives no rows. A long text is a block of its own.

    Texts are read once and not shuffled. Links are counted per block of about two megabytes of text first, so a pair that
    is in every document travels once per block; the counts come back to the blocks the same way.
    """
    blocks, width = _blocks(df, id_col, text_col, a, b)
    requests = _requests(blocks)
    answers = requests.join(_pair_counts(requests, width), "pair").select(F.col("block").alias("of"), "place", "count", "best")
    kept = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    texts = blocks.select("block", *kept, "place", "times")
    kind = texts.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    out = texts.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(_summed(kept), schema)
    return out.withColumnRenamed("id", id_col)
