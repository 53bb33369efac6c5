"""Repeated passages across documents: a sparse suffix order of windows, sorted by digits no deeper than a window.

Suffixes are ordered only through WINDOW bytes. To keep most of them out of the shuffle, a window is found through its
anchor, the run of GRAM bytes in it with the least hash: equal windows have equal anchors at equal places. An anchor
stands for all windows around it that it is the least of; their bytes together are its stretch. Anchors are dealt out by
hash, so all occurrences of an anchor meet. A stretch that also occurs in a smaller document settles all its windows; an
anchor that occurs with different stretches sends these on, and their windows are sorted by most significant digits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, Polynomial, chunks, covered, mix, runs, shared_table, small_batches, text_bytes

WINDOW, GRAM = 50, 16
#: Bytes beside the anchor, of which a window that holds it reaches over half on one side at least.
REACH = WINDOW - GRAM
HALF = -(-REACH // 2)
PLACE = U64((1 << 28) - 1)
#: Bytes of text whose anchors are found at once.
TEXT = 1 << 18
#: Anchors gathered by a task before they are sent.
GATHER = 300_000
#: Anchors in this part of a sample's documents are dealt out by stretch, not by anchor; at most HOT_MOST of them.
SAMPLE, HOT_PART, HOT_LEAST, HOT_MOST = 64, 0.01, 16, 4096
#: Windows of hot anchors among which a task settles the equal ones before they are sent.
SETTLE = 100_000
NO_ID = (1 << 63) - 1


def anchors(raw: np.ndarray, offsets: np.ndarray):
    """Anchors of all windows: hash, hash of the stretch, one byte of what is left and right of it, text, first window
    (from its text's begin), number of windows."""
    n = len(raw)
    if n < WINDOW:
        return None
    poly = Polynomial(raw, 7)
    at = np.arange(n - GRAM + 1)
    key = (poly(at, at + GRAM) & ~PLACE) | at.astype(np.uint64)
    least, size, reach = key, 1, REACH + 1
    while size * 2 <= reach:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < reach:
        least = np.minimum(least[: len(least) - (reach - size)], least[reach - size :])
    inside = np.ones(len(least), bool)
    lo = np.maximum(offsets[1:] - WINDOW + 1, offsets[:-1])
    inside[covered(np.minimum(lo, n), offsets[1:], n)[: len(least)]] = False
    begins, ends = runs(inside, np.unique(np.minimum(offsets, len(least))))
    change = np.zeros(len(least) + 1, bool)
    change[1:-1] = least[1:] != least[:-1]
    change[begins] = True
    first = np.flatnonzero(change[:-1] & inside)
    stop = np.append(first[1:], len(least))
    k = np.searchsorted(begins, first, "right") - 1
    stop = np.minimum(stop, ends[k]) if len(ends) else stop
    count = stop - first
    p = (least[first] & PLACE).astype(np.int64)
    doc = np.searchsorted(offsets, first, "right") - 1
    low, high = offsets[doc], offsets[doc + 1]
    name = mix(poly(p, p + GRAM))
    stretch = poly(first, first + count + WINDOW - 1)
    left = poly(np.maximum(p - HALF, low), p)
    right = poly(p + GRAM, np.minimum(p + GRAM + HALF, high))
    side = (left & U64(255)).astype(np.uint8), (right & U64(255)).astype(np.uint8)
    return name, stretch, *side, doc, first - low, count


FIELDS = "shard int, kind int, ids binary, keys binary, rows binary, name binary, stretch binary, left binary, right binary, at binary, count binary"


def _planes(values: np.ndarray, size: int) -> bytes:
    """The low `size` bytes of whole numbers, byte place by byte place, which packs well."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def _whole(raw: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(raw) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(raw, np.uint8).reshape(size, -1).T
    return out.view("<u8").ravel()


def _pack(kind, shard, ids, keys, doc, name, stretch, left, right, at, count):
    own, rows = np.unique(doc, return_counts=True)
    return (
        shard, kind, ids[own].tobytes(), keys[own].tobytes(), rows.astype(np.uint32).tobytes(), _planes(name, 6), _planes(stretch, 7),
        left.tobytes(), right.tobytes(), _planes(at, 4), count.astype(np.uint8).tobytes(),
    )


def smaller(order: np.ndarray, ids: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows in `order` (by keys, then id): begins of groups of equal keys, and whether a row's id is above the
    group's least."""
    new = np.ones(len(order), bool)
    new[1:] = False
    for key in keys:
        s = key[order]
        new[1:] |= s[1:] != s[:-1]
    begin = np.flatnonzero(new)
    return begin, ids[order] > np.repeat(ids[order][begin], np.diff(np.append(begin, len(order))))


def _deal(shards: int, hot_shared):
    """Anchors of each text to shards. A stretch that a smaller document of the same task has too is settled here, so a
    passage in many documents leaves a task once."""

    def run(batches):
        hot = hot_shared.value
        hold = []

        def send():
            name, stretch, left, right, doc, at, count = (np.concatenate(x) for x in zip(*[h[0] for h in hold], strict=True))
            ids, keys = np.concatenate([h[1] for h in hold]), np.concatenate([h[2] for h in hold])
            hold.clear()
            order = np.lexsort((ids[doc], stretch, name))
            _, above = smaller(order, ids[doc], name, stretch)
            route = name
            if len(hot):
                j = np.minimum(np.searchsorted(hot, name), len(hot) - 1)
                route = np.where(hot[j] == name, mix(name ^ stretch), name)
            shard = ((route >> U64(48)) % U64(shards)).astype(np.int64)
            rest = np.zeros(len(name), bool)
            rest[order] = above
            rows = []
            for kind, take in ((0, ~rest), (1, rest)):
                where = np.flatnonzero(take)
                where = where[np.argsort(shard[where] if kind == 0 else doc[where], kind="stable")]
                cut = np.flatnonzero(np.diff(shard[where])) + 1 if kind == 0 else np.zeros(0, int)
                for part in np.split(where, cut):
                    if len(part):
                        part = part[np.argsort(doc[part], kind="stable")]
                        # What is settled goes anywhere, by a document's id, as the first anchors of copies are alike.
                        by_id = mix(ids[doc[part[:1]]].astype(np.uint64))[0]
                        to = int(shard[part[0]]) if kind == 0 else int(by_id % U64(shards))
                        rows.append(_pack(kind, to, ids, keys, doc[part], name[part], stretch[part], left[part], right[part], at[part], count[part]))
            names = [f.split()[0] for f in FIELDS.split(", ")]
            types = [pa.int32(), pa.int32(), *[pa.binary()] * 9]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        held = seen = 0
        for batch in chunks(batches, TEXT):
            raw, offsets = text_bytes(batch["text"])
            got = anchors(raw, offsets)
            if got is None or not len(got[0]):
                continue
            ids, keys = batch["id"].to_numpy(), batch["key"].to_numpy()
            base = seen
            seen += len(ids)
            hold.append(((*got[:4], got[4] + base, *got[5:]), ids, keys))
            held += len(got[0])
            if held >= GATHER:
                yield send()
                held = seen = 0
        if hold:
            yield send()

    return run


def _settle(hot_shared):
    """All occurrences of some anchors: rows (id, key, code, name) of settled stretches (name null) and of stretches
    whose windows must be compared. code: first window, number of windows, whether the anchor is a hot one."""

    def run(batches):
        hot = hot_shared.value
        cols = {k: [] for k in ("ids", "keys", "name", "stretch", "left", "right", "at", "count", "shard")}
        done = []
        for batch in batches:
            for r in batch.to_pylist():
                rows = np.frombuffer(r["rows"], np.uint32)
                ids, keys = (np.repeat(np.frombuffer(r[c], np.int64), rows) for c in ("ids", "keys"))
                at, count = _whole(r["at"], 4).astype(np.int64), np.frombuffer(r["count"], np.uint8).astype(np.int64)
                if r["kind"] == 1:
                    done.append((ids, keys, at, count))
                    continue
                cols["ids"].append(ids)
                cols["keys"].append(keys)
                cols["name"].append(_whole(r["name"], 6))
                cols["stretch"].append(_whole(r["stretch"], 7))
                cols["left"].append(np.frombuffer(r["left"], np.uint8))
                cols["right"].append(np.frombuffer(r["right"], np.uint8))
                cols["at"].append(at)
                cols["count"].append(count)
                cols["shard"].append(np.full(len(at), r["shard"]))

        def out(ids, keys, at, count, hotness, name):
            code = (at << 8) | (count << 1) | hotness
            none = np.zeros(len(ids), bool) if name is not None else np.ones(len(ids), bool)
            names = pa.array(name.view(np.int64) if name is not None else np.zeros(len(ids), np.int64), mask=none)
            for lo in range(0, len(ids), 65536):
                s = slice(lo, lo + 65536)
                yield pa.RecordBatch.from_arrays([pa.array(ids[s]), pa.array(keys[s]), pa.array(code[s]), names[s]], names=["id", "key", "code", "name"])

        for ids, keys, at, count in done:
            yield from out(ids, keys, at, count, 0, None)
        if not cols["ids"]:
            return
        c = {k: np.concatenate(v) for k, v in cols.items()}
        order = np.lexsort((c["ids"], c["stretch"], c["name"]))
        begin, above = smaller(order, c["ids"], c["name"], c["stretch"])
        settled = order[above]
        yield from out(*(c[k][settled] for k in ("ids", "keys", "at", "count")), 0, None)
        # One stretch a row from here on; those of an anchor side by side.
        one = order[begin]
        name = c["name"][one]
        new = np.ones(len(one), bool)
        new[1:] = name[1:] != name[:-1]
        group = np.cumsum(new) - 1
        need = np.zeros(len(one), bool)
        for side in ("left", "right"):  # another stretch of the anchor that goes on alike on one side
            both = group * 256 + c[side][one]
            _, back, times = np.unique(both, return_inverse=True, return_counts=True)
            need |= times[back] > 1
        hotness = np.zeros(len(one), bool)
        if len(hot):
            low = hot & U64((1 << 48) - 1)
            hotness = np.isin(name, low)
        need |= hotness
        # Of the document with a stretch's least id every place counts.
        size = np.diff(np.append(begin, len(order)))
        pick = order[np.repeat(need, size) & ~above]
        yield from out(c["ids"][pick], c["keys"][pick], c["at"][pick], c["count"][pick], np.repeat(hotness, size)[np.repeat(need, size) & ~above].astype(np.int64), c["name"][pick])

    return run


def _settle_windows(windows: list[tuple[int, int, int, bytes]], out: dict[str, list]) -> None:
    """Windows (id, key, at, bytes) of hot anchors: those of each window's least id go on, to meet by window those of
    other tasks; the others lose here and go on as codes, without bytes, merged and dealt out by document."""
    least: dict[bytes, int] = {}
    for i, _, _, own in windows:
        if i < least.get(own, i + 1):
            least[own] = i
    lose = []
    for i, key, at, own in windows:
        if i > least[own]:
            lose.append((i, key, at))
            continue
        out["route"].append(int.from_bytes(hashlib.blake2b(own, digest_size=7).digest(), "big"))
        out["id"].append(i)
        out["key"].append(key)
        out["at"].append(at)
        out["bytes"].append(own)
    lose.sort()
    k = 0
    while k < len(lose):
        i, key, at = lose[k]
        n = 1
        while k + n < len(lose) and n < 127 and lose[k + n] == (i, key, at + n):
            n += 1
        out["route"].append((i ^ key) & ((1 << 56) - 1))
        out["id"].append(i)
        out["key"].append(key)
        out["at"].append(at << 8 | n << 1)
        out["bytes"].append(None)
        k += n


def _stretches(batches):
    """Bytes of the stretches whose windows must be compared; windows of hot anchors one by one, the equal ones among
    SETTLE settled."""
    out, windows = {k: [] for k in _STRETCH.names}, []
    for batch in batches:
        ids, keys, found = batch["id"].to_pylist(), batch["key"].to_pylist(), batch["found"].to_pylist()
        for k, text in enumerate(batch["text"].to_pylist()):
            raw = text.encode()
            for f in found[k]:
                at, count, hot = f["code"] >> 8, f["code"] >> 1 & 127, f["code"] & 1
                if hot:
                    windows += [(ids[k], keys[k], i, raw[i : i + WINDOW]) for i in range(at, at + count)]
                else:
                    out["route"].append(f["name"])
                    out["id"].append(ids[k])
                    out["key"].append(keys[k])
                    out["at"].append(at)
                    out["bytes"].append(raw[at : at + count + WINDOW - 1])
                if len(windows) >= SETTLE:
                    _settle_windows(windows, out)
                    windows = []
                if len(out["id"]) >= 20_000:
                    yield pa.RecordBatch.from_pydict(out, schema=_STRETCH)
                    out = {k: [] for k in out}
    _settle_windows(windows, out)
    yield pa.RecordBatch.from_pydict(out, schema=_STRETCH)


_STRETCH = pa.schema([("route", pa.int64()), ("id", pa.int64()), ("key", pa.int64()), ("at", pa.int64()), ("bytes", pa.binary())])


def radix_groups(raw: np.ndarray, begins: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which windows (WINDOW bytes at `begins`) also stand in a row with a smaller id. Most significant digits first,
    eight bytes each; a group of one document has nothing to lose and leaves the sort."""
    lose = np.zeros(len(begins), bool)
    live, group = np.arange(len(begins)), np.zeros(len(begins), np.int64)
    depth = 0
    while len(live):
        size = min(8, WINDOW - depth)
        digit = np.zeros(len(live), np.uint64)
        for i in range(size):
            digit = (digit << U64(8)) | raw[begins[live] + depth + i].astype(np.uint64)
        order = np.lexsort((digit, group))
        live, digit, group = live[order], digit[order], group[order]
        new = np.ones(len(live), bool)
        new[1:] = (digit[1:] != digit[:-1]) | (group[1:] != group[:-1])
        cut = np.flatnonzero(new)
        low, high = np.minimum.reduceat(ids[live], cut), np.maximum.reduceat(ids[live], cut)
        group = np.cumsum(new) - 1
        depth += size
        if depth == WINDOW:
            lose[live] = ids[live] > low[group]
            return lose
        keep = (low < high)[group]
        live, group = live[keep], group[keep]
    return lose


def _compare(batches):
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    table = pa.Table.from_batches(rows)
    settled = table["bytes"].is_null()
    for batch in table.filter(settled).select(["id", "key", "at"]).to_batches():
        yield batch.rename_columns(["id", "key", "code"])
    table = table.filter(pc.invert(settled)).combine_chunks()
    raw, offsets = text_bytes(table["bytes"])
    count = np.diff(offsets) - WINDOW + 1
    row = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    lose = np.flatnonzero(radix_groups(raw, offsets[row] + nth, table["id"].to_numpy()[row]))
    if not len(lose):
        return
    row, nth = row[lose], nth[lose]
    new = np.ones(len(lose), bool)
    new[1:] = (row[1:] != row[:-1]) | (nth[1:] != nth[:-1] + 1)
    cut = np.flatnonzero(new)
    n = np.diff(np.append(cut, len(lose)))
    at = table["at"].to_numpy()[row[cut]] + nth[cut]
    take = pa.array(row[cut])
    yield pa.RecordBatch.from_arrays(
        [table["id"].take(take).combine_chunks(), table["key"].take(take).combine_chunks(), pa.array((at << 8) | (np.minimum(n, 127) << 1))], names=["id", "key", "code"]
    )


def _removed(keep_text: bool):
    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            found = batch["found"].to_pylist()
            for k, text in enumerate(batch["text"].to_pylist()):
                raw = np.frombuffer(text.encode(), np.uint8)
                gone = np.zeros(len(raw), bool)
                if found[k]:
                    code = np.array(found[k], np.int64)
                    begin = code >> 8
                    gone = covered(begin, np.minimum(begin + (code >> 1 & 127) + WINDOW - 1, len(raw)), len(raw))
                left = raw[~gone].tobytes()
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(int(gone.sum()))
                out["n_spans"].append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
                out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
                out["kept"].append(left.decode(errors="replace") if keep_text else None)
            ids = batch["id"].to_numpy()
            cols = [pa.array(ids, mask=ids == NO_ID), *[pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")]]
            cols += [pa.array(out["kept_sha256"], pa.string()), pa.array(out["kept"], pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def _hot_names(docs: DataFrame) -> np.ndarray:
    """Anchors of passages that a large part of a sample's documents hold; a bounded list."""

    def names(batches):
        for batch in chunks(batches, TEXT):
            raw, offsets = text_bytes(batch["text"])
            got = anchors(raw, offsets)
            if got is not None and len(got[0]):
                pairs = np.unique(np.stack([got[0], got[4].astype(np.uint64)]), axis=1)[0]
                yield pa.RecordBatch.from_arrays([pa.array(pairs.view(np.int64))], names=["name"])

    sample = docs.filter(F.pmod("key", F.lit(SAMPLE)) == 0)
    n = sample.count()
    often = sample.mapInArrow(names, "name long").groupBy("name").count().filter(F.col("count") >= max(HOT_LEAST, int(n * HOT_PART)))
    got = [r["name"] for r in often.orderBy(F.desc("count"), "name").limit(HOT_MOST).collect()]
    return np.sort(np.array(got, np.int64).view(np.uint64))


def remove_repeats(df: DataFrame, id_col="doc_id", text_col="text", keep_text=True) -> DataFrame:
    """Removes every byte covered by a 50-byte string that also starts in a document with a smaller id.

    One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256 and, with `keep_text`, the remaining text (bytes
    cut inside a character are replaced in it). Strings are judged on the input and never cross documents. A null text
    is empty; a text of fewer than 50 bytes loses nothing. Rows that share an id take nothing from each other. A null
    id counts as the largest. Ids are whole numbers. An empty table gives no rows; other columns are not read.

    Each anchor's occurrences meet by hash; those of anchors that a sample shows in many documents are dealt out by
    stretch instead. Their windows are settled among SETTLE of a task at once; then only those of the least ids meet by
    window, so of a passage in a third of all documents one row (those that share the least id) for SETTLE windows does.
    Equal stretches are told by 110 bits of hashes, windows of different stretches by their bytes.
    """
    spark = df.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = spark.sparkContext.broadcast(_hot_names(docs))
    shards = 4 * parts  # a task holds the anchors of its shards at once
    dealt = docs.mapInArrow(_deal(shards, hot), FIELDS).repartition(shards, "shard")
    found = shared_table(dealt.mapInArrow(_settle(hot), "id long, key long, code long, name long"), "anchors")
    unclear = found.filter("name IS NOT NULL").groupBy("id", "key").agg(F.collect_set(F.struct("code", "name")).alias("found"))
    stretches = docs.join(unclear, ["id", "key"]).mapInArrow(_stretches, "route long, id long, key long, at long, bytes binary")
    more = stretches.repartition(parts, "route").mapInArrow(_compare, "id long, key long, code long")
    every = found.filter("name IS NULL").select("id", "key", "code").union(more).groupBy("id", "key").agg(F.collect_set("code").alias("found"))
    out = docs.join(every, ["id", "key"], "left").mapInArrow(
        _removed(keep_text), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"
    )
    out = out.withColumnRenamed("id", id_col)
    return out if keep_text else out.drop("kept")
