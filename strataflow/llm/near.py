"""Near duplicates by ProbMinHash over counted five-word shingles, banding, and exact verification."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, chunks, mix, select_texts, shared_table
from .contamination import words_of

SHINGLE = 5
SIMILARITY = 0.8
#: 32 bands of 4 components: a pair at 0.8 shares no band with odds of 5e-8.
COMPONENTS, ROWS = 128, 4
#: Pairs whose sketches agree in fewer places than this part are not verified: at 0.8, six standard deviations below.
SKETCH_LEAST = 0.6
#: Members around a hub that one task compares with as many others; shingles that it compares them by at once.
BLOCK, COLUMNS = 512, 8192


def shingles(hashes: np.ndarray, first: np.ndarray):
    """Distinct shingles of all texts: text, hash, count, by text. Fewer than five words are one shingle."""
    n = np.diff(first)
    size = np.minimum(n, SHINGLE)
    many = np.where(n > 0, n - size + 1, 0)
    doc = np.repeat(np.arange(len(n)), many)
    at = np.repeat(first[:-1] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    h = np.zeros(len(at), np.uint64)
    for j in range(SHINGLE):
        inside = j < size[doc]
        h[inside] = mix(h[inside] * U64(0xD6E8FEB86659FD93) + hashes[at[inside] + j])
    o = np.argsort(h)
    o = o[np.argsort(doc[o], kind="stable")]
    h, doc = h[o], doc[o]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    where = np.flatnonzero(new)
    return doc[where], h[where], np.diff(np.append(where, len(h)))


def prob_minhash(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, docs: int) -> np.ndarray:
    """For each text and component, the shingle whose Poisson process (rate: its count) arrives there first.

    Every arrival picks one component by hash. A shingle stops as soon as its next arrival is later than the latest
    first arrival of its text. Two sketches agree in a component with the probability Jaccard of the texts.
    """
    m = COMPONENTS
    first = np.full(docs * m, np.inf)
    winner = np.zeros(docs * m, np.uint32)
    limit = np.full(docs, np.inf)
    time = np.zeros(len(h))
    turn = 0
    while len(h):
        draws = 1 if len(h) > 4096 else 16
        for _ in range(draws):
            turn += 1
            r = mix(h + U64(turn * 0x9E3779B97F4A7C15 & (2**64 - 1)))
            time = time - np.log(((r >> U64(11)).astype(np.float64) + 1) * 2.0**-53) / weight
            slot = doc * m + (mix(r) >> U64(57)).astype(np.int64)
            np.minimum.at(first, slot, time)
            won = first[slot] == time
            winner[slot[won]] = (h[won] >> U64(32)).astype(np.uint32)
        limit = first.reshape(docs, m).max(1)
        live = time < limit[doc]
        doc, h, weight, time = doc[live], h[live], weight[live], time[live]
    return winner.reshape(docs, m)


def _sketch(batches):
    for batch in chunks(batches):
        _, _, _, hashes, first = words_of(batch["text"])
        doc, h, count = shingles(hashes, first)
        sig = prob_minhash(doc, h, count.astype(np.float64), batch.num_rows)
        fp, sketch = [], []
        for k in range(batch.num_rows):
            some = first[k + 1] > first[k]
            fp.append(hashlib.blake2b(hashes[first[k] : first[k + 1]].tobytes(), digest_size=16).digest() if some else None)
            sketch.append(sig[k].tobytes() if some else None)
        yield pa.RecordBatch.from_arrays([batch["id"], pa.array(fp, pa.binary()), pa.array(sketch, pa.binary())], names=["id", "fp", "sketch"])


def _bands(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = np.frombuffer(b"".join(batch["sketch"].to_pylist()), np.uint32).reshape(-1, COMPONENTS // ROWS, ROWS)
        key = np.zeros(sig.shape[:2], np.uint64) + np.arange(sig.shape[1], dtype=np.uint64)
        for j in range(ROWS):
            key = mix(key * U64(0xD6E8FEB86659FD93) + sig[:, :, j].astype(np.uint64))
        fp = batch["fp"].take(pa.array(np.repeat(np.arange(batch.num_rows), sig.shape[1])))
        yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), fp], names=["band", "fp"])


def _agree(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint32).reshape(-1, COMPONENTS) for c in ("sketch_a", "sketch_b"))
        ok = pa.array((a == b).mean(1) >= SKETCH_LEAST)
        yield pa.RecordBatch.from_arrays([batch["a"].filter(ok), batch["b"].filter(ok)], names=["a", "b"])


def overlaps(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, left: np.ndarray, right: np.ndarray):
    """For texts left x right: common shingles, and the part of the left and of the right text's weight they make up."""
    _, col = np.unique(h, return_inverse=True)
    n = len(np.bincount(doc)) if len(doc) else 0
    total = np.bincount(doc, weight, n)
    order = np.argsort(col, kind="stable")
    doc, col, weight = doc[order], col[order], weight[order]
    common, part_l, part_r = (np.zeros((len(left), len(right)), np.float32) for _ in range(3))
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, COLUMNS):
        s = slice(*np.searchsorted(col, [lo, lo + COLUMNS]))
        has, part = np.zeros((n, COLUMNS), np.float32), np.zeros((n, COLUMNS), np.float32)
        has[doc[s], col[s] - lo] = 1
        part[doc[s], col[s] - lo] = weight[s] / total[doc[s]]
        common += has[left] @ has[right].T
        part_l += part[left] @ has[right].T
        part_r += has[left] @ part[right].T
    return common, part_l, part_r


def _in_block(table: pa.Table) -> pa.Table:
    """Links between members of two blocks that are not connected yet; as few as connect them."""
    fp, comp, own = table["fp"].to_pylist(), table["comp"].to_pylist(), table["own"].to_numpy()
    i, j = table["i"][0].as_py(), table["j"][0].as_py()
    _, _, _, hashes, first = words_of(table["text"].combine_chunks())
    doc, h, count = shingles(hashes, first)
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    common, part_l, part_r = overlaps(doc, h, count.astype(np.float64), left, right)
    size = np.bincount(doc, minlength=len(fp))
    plain = np.bincount(doc, count > 1, len(fp)) == 0
    _, group = np.unique(np.array([x.hex() for x in comp]), return_inverse=True)
    # The common part of either text's weight bounds the similarity from above.
    maybe = (np.minimum(part_l, part_r) >= SIMILARITY - 1e-4) & (group[left][:, None] != group[right][None, :])
    cut = np.searchsorted(doc, np.arange(len(fp) + 1))
    up = list(range(int(group.max()) + 1 if len(group) else 0))

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    a, b = [], []
    for p, q in zip(*np.nonzero(maybe), strict=True):
        x, y = left[p], right[q]
        gx, gy = top(group[x]), top(group[y])
        if gx == gy:
            continue
        if plain[x] and plain[y]:
            similar = common[p, q] / (size[x] + size[y] - common[p, q])
        else:
            sx, sy = slice(cut[x], cut[x + 1]), slice(cut[y], cut[y + 1])
            similar = probability_jaccard(h[sx], count[sx], h[sy], count[sy])
        if similar >= SIMILARITY - 1e-6:
            up[gx] = gy
            a.append(min(fp[x], fp[y]))
            b.append(max(fp[x], fp[y]))
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def _own_text(batches):
    """Texts that have the fingerprint they were fetched for; ids may repeat."""
    for batch in chunks(batches):
        _, _, _, hashes, first = words_of(batch["text"])
        fp = [hashlib.blake2b(hashes[first[k] : first[k + 1]].tobytes(), digest_size=16).digest() for k in range(batch.num_rows)]
        same = pa.array([x == y for x, y in zip(fp, batch["fp"].to_pylist(), strict=True)])
        yield pa.RecordBatch.from_arrays([batch["fp"].filter(same), batch["text"].filter(same)], names=["fp", "text"])


def _counted(batches):
    """Words to the counted shingles of each text."""
    for batch in chunks(batches):
        _, _, _, hashes, first = words_of(batch["text"])
        doc, h, count = shingles(hashes, first)
        cut = np.searchsorted(doc, np.arange(batch.num_rows + 1))
        own = [h[cut[k] : cut[k + 1]].tobytes() for k in range(batch.num_rows)]
        number = [count[cut[k] : cut[k + 1]].astype(np.uint32).tobytes() for k in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch["fp"], pa.array(own, pa.binary()), pa.array(number, pa.binary())], names=["fp", "shingles", "counts"])


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Sum over common elements i of 1 / sum over j of max(a_j / a_i, b_j / b_i); elements sorted."""
    every = np.union1d(a, b)
    u, v = np.zeros(len(every)), np.zeros(len(every))
    u[np.searchsorted(every, a)] = wa
    v[np.searchsorted(every, b)] = wb
    both = np.flatnonzero((u > 0) & (v > 0))
    ratio, back = np.unique(u[both] / v[both], return_inverse=True)
    whole = np.array([np.maximum(u, t * v).sum() for t in ratio])
    return float((u[both] / whole[back]).sum()) if len(both) else 0.0


def _verify(batches):
    for batch in batches:
        cols = [batch[c].to_pylist() for c in ("a", "b", "shingles_a", "counts_a", "shingles_b", "counts_b")]
        a, b = [], []
        for x, y, sa, ca, sb, cb in zip(*cols, strict=True):
            args = [np.frombuffer(sa, np.uint64), np.frombuffer(ca, np.uint32), np.frombuffer(sb, np.uint64), np.frombuffer(cb, np.uint32)]
            if probability_jaccard(*args) >= SIMILARITY - 1e-9:
                a.append(x)
                b.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of the undirected edges (a, b); comp is one node of the component.

    Each round hangs every node on its smallest neighbour's smallest neighbour and contracts the edges, so their number
    falls by a factor each round; rounds are written to the shared folder.
    """
    label = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("up"))
        near = shared_table(near, "near")
        above = near.select(F.col("node").alias("up"), F.col("up").alias("upper"))
        up = shared_table(near.join(above, "up").select("node", "upper"), "up")
        if label is None:
            label = up.select("node", F.col("upper").alias("comp"))
        else:
            label = label.join(up.select(F.col("node").alias("comp"), "upper"), "comp", "left").select("node", F.coalesce("upper", "comp").alias("comp"))
        x = up.select(F.col("node").alias("a"), F.col("upper").alias("x"))
        y = up.select(F.col("node").alias("b"), F.col("upper").alias("y"))
        moved = edges.join(x, "a").join(y, "b").filter("x <> y")
        edges = shared_table(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return label
        label = shared_table(label, "label")


def _verified(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """Pairs (a, b) of fingerprints whose texts are similar enough."""
    wanted = pairs.select(F.col("a").alias("fp")).union(pairs.select("b")).distinct()
    counted = shared_table(bodies.join(wanted, "fp").mapInArrow(_counted, "fp binary, shingles binary, counts binary"), "counted")
    side = lambda s: counted.select(F.col("fp").alias(s), F.col("shingles").alias(f"shingles_{s}"), F.col("counts").alias(f"counts_{s}"))
    return shared_table(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_verify, "a binary, b binary"), "links")


def near_groups(df: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Groups of documents connected by near copies: probability Jaccard of counted five-word shingles of 0.8 or more.

    Words are those of the decontamination. One row per input row: id, group_id (smallest id of the group), group_size,
    kept (the id is the group's smallest). A text of one to four words is one shingle; a text without words, a null
    text and a row with a null id are groups of their own. Repeated rows belong to one group and, as they share their
    id, are kept together. An empty table gives no rows. Other columns are not read.

    Equal word rows are one class first, so copies are never paired. Within a bucket every class is compared with the
    bucket's hub. When these links have been joined up, members around one hub that are still unconnected are compared
    in blocks of BLOCK, inside tasks that return no more links than connect them: no bucket is capped, no group's pairs
    are written out, and no link between different groups is left out. All tables stay distributed.
    """
    texts = select_texts(df, id_col, text_col)
    kind = texts.schema["id"].dataType.simpleString()
    sketch = shared_table(texts.mapInArrow(_sketch, f"id {kind}, fp binary, sketch binary"), "sketch")
    named = sketch.filter("fp IS NOT NULL AND id IS NOT NULL")
    classes = shared_table(named.groupBy("fp").agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.first("sketch").alias("sketch")), "classes")
    bands = classes.select("fp", "sketch").mapInArrow(_bands, "band long, fp binary")
    sizes = bands.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    shared = shared_table(bands.join(sizes, "band"), "shared")
    # The hub of a bucket is the member that meets most others over all its buckets: of copies, the text they vary.
    weight = shared.groupBy("fp").agg(F.sum("size").alias("weight"))
    hubs = shared.join(weight, "fp").groupBy("band").agg(F.max(F.struct("weight", "fp"))["fp"].alias("hub"))
    members = shared_table(shared.join(hubs, "band"), "members")
    sig = lambda s: classes.select(F.col("fp").alias(s), F.col("sketch").alias(f"sketch_{s}"))
    stars = members.filter("fp <> hub").select(F.least("hub", "fp").alias("a"), F.greatest("hub", "fp").alias("b")).distinct()
    close = shared_table(stars.join(sig("b"), "b").join(sig("a"), "a").select("a", "b", "sketch_a", "sketch_b").mapInArrow(_agree, "a binary, b binary"), "pairs")
    # The texts of one document for each class that shares a bucket; they are shuffled once.
    wanted = members.select("fp").distinct().join(classes.select("fp", F.col("rep").alias("id")), "fp")
    bodies = shared_table(texts.join(wanted, "id").mapInArrow(_own_text, "fp binary, text string").dropDuplicates(["fp"]), "bodies")
    links = _verified(close, bodies)
    label = shared_table(components(links), "comp")
    # Hubs whose members are still in several components. A hub's single companion has been compared with it already.
    around = members.select("hub", "fp").distinct().join(label.withColumnRenamed("node", "fp"), "fp", "left").select("hub", "fp", F.coalesce("comp", "fp").alias("comp"))
    mixed = around.groupBy("hub").agg(F.count("*").alias("size"), F.min("comp").alias("low"), F.max("comp").alias("high")).filter("size > 2 AND low <> high")
    mixed = shared_table(mixed, "mixed")  # so that a large hub can be split in the join below
    blocks = F.ceil(F.col("size") / BLOCK).cast("long")
    spread = (
        around.join(mixed.select("hub", "size"), "hub")
        .join(bodies, "fp")
        .select("hub", "fp", "comp", "text", F.pmod(F.xxhash64("fp"), blocks).alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"))
        .select("hub", "fp", "comp", "text", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )
    rest = shared_table(spread.groupBy("hub", "i", "j").applyInArrow(_in_block, "a binary, b binary").distinct(), "rest")
    if not rest.isEmpty():
        label = shared_table(components(links.union(rest)), "comp")
    joined = classes.join(label.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "rep", "n", F.coalesce("comp", "fp").alias("comp"))
    groups = joined.groupBy("comp").agg(F.min("rep").alias("group_id"), F.sum("n").alias("group_size"))
    answer = joined.join(groups, "comp").select("fp", "group_id", "group_size")
    alone = F.col("group_id").isNull() | F.col("id").isNull()
    return sketch.join(answer, "fp", "left").select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("group_id")).alias("group_id"),
        F.when(alone, F.lit(1).cast("long")).otherwise(F.col("group_size")).alias("group_size"),
        (alone | (F.col("id") == F.col("group_id"))).alias("kept"),
    )


def drop_near(df: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """One document of each group, with all its columns: the one with the smallest id; rows with a null id stay."""
    gone = near_groups(df, id_col, text_col).filter("NOT kept").select(F.col(id_col).alias("__gone")).distinct()
    return df.join(gone, F.col(id_col) == F.col("__gone"), "left_anti")
