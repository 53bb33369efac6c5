"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

A text's log probability is a sum over its grams of orders 1 to 3, each of which adds a value of its own: what it gains as
an ending over the next lower order, and the backoff weight it brings as a context. So the model is a table of keys and
values, cut into shards by hash, and blocks of texts send the keys of their grams to the shards, which send each block the
sums of its texts. Counts are of all training texts; no table of grams passes through the driver. Rows between shards are
packed: a shard, a kind, whole numbers byte by byte.

Disk is what limits this, so every step works slice by slice: the shards, at the end the texts, are dealt into slices, the
exchange of one slice goes before the next begins, and a table goes when the next one is whole.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import broadcast_groups
from .common import U64, Polynomial, chunks, drop_path, exchanges_go, mix, own_path, runs, shared_table, small_batches, text_bytes, token_class
from .repeats import _planes, _whole

ORDER = 3
#: Of the trusted documents that the model was not fitted on, this part passes, language by language.
QUANTILE = 0.999
#: Accuracy of the sketch that says between which values a quantile lies.
SKETCH = 10_000
#: Tokens of average perplexity that each document is mixed with, so that a few words decide little.
PRIOR = 20
#: Fewer trusted documents than this of a language: the quantile over all languages holds.
LEAST = 50
BEGIN, END = U64(1), U64(2)
SLOTS = 22
LOW = U64((1 << 48) - 1)
#: Tokens that a task gathers before it sends.
GATHER = 1_000_000
#: Parts of the shards, and of the texts that are scored, that are worked on one after the other.
SLICES, TEXT_SLICES = 5, 3
#: Numbers of a row, and bytes of a batch, at most.
ROW, SENT = 1 << 15, 1 << 20
#: Grams of most weight, whose values are broadcast; bits of the filter that keeps back grams the model lacks. Both save
#: shuffling only: the other grams are found in the shards.
HOT, FILTER_BITS = 1_000_000, 1 << 28


def tokens_of(column: pa.Array):
    """Token hashes of all texts, each text's followed by END, and where each text's tokens begin."""
    raw, offsets = text_bytes(column)
    begins, ends = runs(token_class()[raw], offsets)
    first = np.searchsorted(begins, offsets)
    n = len(offsets) - 1
    out = np.full(len(begins) + n, END, np.uint64)
    place = np.arange(len(begins)) + np.repeat(np.arange(n), np.diff(first))
    out[place] = Polynomial(raw)(begins, ends) & LOW
    return out, first + np.arange(n + 1)


def previous(tokens: np.ndarray, first: np.ndarray, back: int) -> np.ndarray:
    """The token `back` places earlier in the same text, BEGIN before its first."""
    out = np.full(len(tokens), BEGIN, np.uint64)
    out[back:] = tokens[:-back] if back else tokens
    nth = np.arange(len(tokens)) - np.repeat(first[:-1], np.diff(first))
    out[nth < back] = BEGIN
    return out


def grams(tokens, first, order: int) -> list[np.ndarray]:
    """Keys of the grams of 1 to `order` tokens that end at each token: a gram's key is made of its first tokens' key
    and its last token."""
    before = [previous(tokens, first, k) for k in range(order)]
    keys = []
    for n in range(1, order + 1):
        key = np.zeros(len(tokens), np.uint64)
        for k in range(n - 1, -1, -1):
            key = mix(key * U64(0xD6E8FEB86659FD93) + before[k])
        keys.append(key)
    return keys


FIELDS = "shard int, kind int, data binary"
TRIGRAM, COUNTED, CONTEXT, TALLY, TOKEN, ANSWER, OWN, VALUE, OFTEN, ASK, DONE, PARTS, BITS = range(13)
#: Bytes of each number of a kind. Numbers n1, n2, n3 are how many grams that go on a context were seen once, twice, more.
WIDTHS = {
    TRIGRAM: (6, 6, 6, 4),  # three tokens, count
    COUNTED: (6, 6, 6, 4, 4, 4, 4),  # key, last two tokens, count, n1 to n3 of the first two
    CONTEXT: (6, 4, 4, 4, 4),  # key of two tokens, n1 to n3, count
    TALLY: (8,) * 6,  # grams counted once, twice, three, four times, their number, the sum of their counts
    TOKEN: (6, 4, 4, 4, 4, 4, 4),  # token, shard that asks, n1 to n3 and count as a context, different tokens before it
    ANSWER: (6, 4, 4, 4, 4, 4),
    OWN: (6, 4, 4, 4, 4, 4),
    VALUE: (6, 4),  # key, value
    OFTEN: (6, 4, 4),  # key, value, weight
}


def chain(*tokens: np.ndarray) -> np.ndarray:
    """The key that `grams` gives to these tokens."""
    key = np.zeros(len(tokens[0]), np.uint64)
    for t in tokens:
        key = mix(key * U64(0xD6E8FEB86659FD93) + t)
    return key


def shard_of(key: np.ndarray, shards: int) -> np.ndarray:
    return ((key >> U64(48)) % U64(shards)).astype(np.int64)


def packed(kind: int, shard: np.ndarray, *cols: np.ndarray) -> list[tuple]:
    """Rows for each shard, of ROW numbers at most."""
    order = np.argsort(shard, kind="stable")
    cut = np.flatnonzero(np.diff(shard[order])) + 1
    widths = WIDTHS[kind]
    parts = [o[k : k + ROW] for o in np.split(order, cut) for k in range(0, len(o), ROW)]
    return [(int(shard[o[0]]), kind, b"".join(_planes(c[o], w) for c, w in zip(cols, widths, strict=True))) for o in parts]


def as_batches(rows: list[tuple]):
    """Batches of about SENT bytes at most."""
    size = np.cumsum([len(r[2]) for r in rows]) // SENT
    for part in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(size)) + 1):
        if len(part):
            yield as_batch(rows[part[0] : part[-1] + 1])


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["shard", "kind", "data"])


def unpacked(rows: list[tuple], kind: int) -> list[np.ndarray]:
    """Shard and numbers of all rows of a kind."""
    widths, own = WIDTHS[kind], [(s, d) for s, k, d in rows if k == kind]
    parts = [[] for _ in range(len(widths) + 1)]
    for shard, data in own:
        n, at = len(data) // sum(widths), 0
        parts[0].append(np.full(n, shard, np.int64))
        for k, w in enumerate(widths):
            parts[k + 1].append(_whole(data[at : at + n * w], w))
            at += n * w
    return [np.concatenate(x) if x else np.zeros(0, np.int64 if k == 0 else np.uint64) for k, x in enumerate(parts)]


def block_of(text: np.ndarray, nth: int) -> bytes:
    """The name of a block of texts: they, their order and their task make it, so what is sent about a block that a
    repeated task cuts otherwise cannot be added to it."""
    task = TaskContext.get()
    return hashlib.blake2b(b"%d %d " % (task.partitionId() if task else 0, nth) + text.tobytes(), digest_size=8).digest()


def questions(shard: np.ndarray, key: np.ndarray, doc: np.ndarray, block: bytes) -> list[tuple]:
    """Rows of kind ASK, one for each shard: the block, the number of its texts that ask, these by place in the block, how
    many keys each asks, and the keys."""
    order = np.lexsort((doc, shard))
    shard, key, doc = shard[order], key[order], doc[order]
    out = []
    for part in np.split(np.arange(len(shard)), np.flatnonzero(np.diff(shard)) + 1):
        if len(part):
            own, count = np.unique(doc[part], return_counts=True)
            data = block + len(own).to_bytes(4, "little") + _planes(own, 4) + _planes(count, 4) + _planes(key[part], 6)
            out.append((int(shard[part[0]]), ASK, data))
    return out


def asked_in(data: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    n = int.from_bytes(data[8:12], "little")
    texts, count = (_whole(data[12 + k * n : 12 + (k + 4) * n], 4).astype(np.int64) for k in (0, 4))
    return int.from_bytes(data[:8], "little", signed=True), texts, count, _whole(data[12 + 8 * n :], 6)


def parts_of(texts: np.ndarray, count: np.ndarray, at: np.ndarray, value: np.ndarray) -> bytes:
    """Sums of what was found, by text: one value as it is, in single precision, more as their sum."""
    doc = np.repeat(np.arange(len(texts)), count)[at]
    hits, total = np.bincount(doc, minlength=len(texts)), np.bincount(doc, value, len(texts))
    one, more = hits == 1, hits > 1
    single, double = total[one].astype(np.float32).view(np.uint32), total[more].astype(np.float64).view(np.uint64)
    return int(one.sum()).to_bytes(4, "little") + _planes(texts[one], 4) + _planes(single, 4) + _planes(texts[more], 4) + _planes(double, 8)


def sums_in(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Texts and sums of a row of kind PARTS."""
    n = int.from_bytes(data[:4], "little")
    m = (len(data) - 4 - 8 * n) // 12
    single, more = data[4 : 4 + 8 * n], data[4 + 8 * n :]
    texts = np.concatenate([_whole(single[: 4 * n], 4), _whole(more[: 4 * m], 4)]).astype(np.int64)
    return texts, np.concatenate([_whole(single[4 * n :], 4).astype(np.uint32).view(np.float32), _whole(more[4 * m :], 8).view(np.float64)])


def by_shard(work):
    """A function of all rows of a shard, as one of batches."""

    def run(batches):
        for rows in shards_of(batches):
            yield from as_batches(work(rows))

    return run


def shards_of(batches):
    """The rows of each shard of a partition, shard by shard."""
    shards = {}
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            shards.setdefault(row[0], []).append(row)
    while shards:
        yield shards.popitem()[1]


def grouped(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by keys, and where groups of equal keys begin in it."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    new[1:] = False
    for key in keys:
        s = key[order]
        new[1:] |= s[1:] != s[:-1]
    return order, np.flatnonzero(new)


def sums(x: np.ndarray, begin: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, begin) if len(begin) else x[:0]


def tally(count: np.ndarray) -> list[tuple]:
    found = [(count == c).sum() for c in (1, 2, 3, 4)] + [len(count), count.sum()]
    return packed(TALLY, np.zeros(1, np.int64), *(np.array([x], np.uint64) for x in found))


def seen(count: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
    """n1, n2, n3 of the groups, and their counts."""
    return [sums(x.astype(np.uint64), begin) for x in (count == 1, count == 2, count > 2, count)]


class Sliced:
    """A table of rows between shards in the shared folder, cut by shard into SLICES that can be dropped one by one."""

    def __init__(self, spark, name: str):
        self.spark, self.path = spark, own_path(spark, name)

    def put(self, rows: DataFrame) -> None:
        with exchanges_go(self.spark):
            rows.withColumn("part", F.col("shard") % SLICES).write.mode("append").option("compression", "zstd").partitionBy("part").parquet(self.path)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(f"{FIELDS}, part int").parquet(self.path)

    def drop(self, part: int | None = None) -> None:
        drop_path(self.spark, self.path if part is None else f"{self.path}/part={part}")


def _trigrams(shards: int, part: int):
    """Counts of the trigrams whose shards are in a slice."""

    def run(batches):
        hold, held = [], 0

        def send():
            t = np.concatenate(hold, 1)
            hold.clear()
            order, begin = grouped(*t)
            t = t[:, order[begin]]
            count = np.diff(np.append(begin, len(order))).astype(np.uint64)
            return as_batches(packed(TRIGRAM, shard_of(chain(t[0], t[1]), shards), *t, count))

        for batch in chunks(batches):
            tokens, first = tokens_of(batch["text"])
            t = np.stack([previous(tokens, first, k) for k in range(ORDER - 1, -1, -1)])
            t = t[:, shard_of(chain(t[0], t[1]), shards) % SLICES == part]
            hold.append(t)
            held += t.shape[1]
            if held >= GATHER:
                yield from send()
                held = 0
        if held:
            yield from send()

    return run


def _count(shards: int):
    """Counts of trigrams, to the shards of their last two tokens, and what follows their first two."""

    def work(rows):
        _, *t, n = unpacked(rows, TRIGRAM)
        order, begin = grouped(*t)
        count = sums(n[order], begin)
        t = [x[order[begin]] for x in t]
        _, begin = grouped(t[0], t[1])  # in order already
        follow = seen(count, begin)
        size = np.diff(np.append(begin, len(count)))
        first = chain(t[0][begin], t[1][begin])
        counted = [chain(*t) & LOW, t[1], t[2], count, *(np.repeat(x, size) for x in follow[:3])]
        order = np.lexsort((t[2], t[1]))  # equal tokens side by side pack well
        out = packed(COUNTED, shard_of(chain(t[1], t[2]), shards)[order], *(x[order] for x in counted))
        return [*out, *packed(CONTEXT, shard_of(first, shards), first & LOW, *follow), *tally(count)]

    return by_shard(work)


def _follow(shards: int):
    """Of each shard's tokens: what follows them, and how many different tokens stand before them."""

    def work(rows):
        shard, _, t1, t2, *_ = unpacked(rows, COUNTED)
        order, begin = grouped(shard, t1, t2)
        count = np.diff(np.append(begin, len(order))).astype(np.uint64)
        own, t1, t2 = (x[order[begin]] for x in (shard, t1, t2))
        none, one = np.zeros(len(own), np.uint64), np.ones(len(own), np.uint64)
        numbers = [np.concatenate(x) for x in ((count == 1, none), (count == 2, none), (count > 2, none), (count, none), (none, one))]
        own, token = np.concatenate([own, own]), np.concatenate([t1, t2])
        order, begin = grouped(own, token)
        numbers = [sums(x[order].astype(np.uint64), begin) for x in numbers]
        own, token = own[order[begin]], token[order[begin]]
        return [*packed(TOKEN, shard_of(chain(token), shards), token, own.astype(np.uint64), *numbers), *tally(count)]

    return by_shard(work)


def _tokens(rows):
    """The numbers of all shards about a token, for itself and back to the shards that asked."""
    shard, token, asks, *numbers = unpacked(rows, TOKEN)
    order, begin = grouped(token)
    whole = [sums(x[order], begin) for x in numbers]
    back = np.empty(len(order), np.int64)
    back[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(order))))
    one = order[begin]
    out = packed(OWN, shard[one], token[one], *whole) + packed(ANSWER, asks.astype(np.int64), token, *(x[back] for x in whole))
    return out + tally(whole[-1][whole[-1] > 0])


def discounts(found: list[int]) -> np.ndarray:
    """By count (0, 1, 2, more), from how many grams were counted once, twice, three and four times."""
    n1, n2, n3, n4 = found
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    return np.array([0.0] + [max(0.1, min(c, c - (c + 1) * y * b / a)) if a else 0.5 for c, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))])


def _values(d: list[np.ndarray], floor: float, total: float, most: int):
    """Values of a shard's grams. Interpolated modified Kneser-Ney: raw counts at the highest order, numbers of
    different left neighbours below; `d` are the discounts by order, `floor` the log probability of an unknown token."""

    def spread(n, order):
        return sum(d[order][c] * x.astype(np.float64) for c, x in zip((1, 2, 3), n, strict=True))

    def own(count, order):
        return count.astype(np.float64) - d[order][np.minimum(count, 3).astype(np.int64)]

    def work(rows):
        shard, token, *n = (np.concatenate(x) for x in zip(unpacked(rows, ANSWER), unpacked(rows, OWN), strict=True))
        is_own = np.arange(len(token)) >= len(token) - sum(len(x) // sum(WIDTHS[OWN]) for _, k, x in rows if k == OWN)
        left = spread(n[:3], 2)
        gain = np.where(n[4] > 0, np.log1p(own(n[4], 1) / total / np.exp(floor)), 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            backoff = np.where(n[3] > 0, np.log(left / n[3]), 0.0)
        out = [(shard[is_own], chain(token[is_own]) & LOW, (gain + backoff)[is_own], n[3][is_own])]
        o = np.argsort(token, kind="stable")
        at = lambda t: o[np.searchsorted(token, t, sorter=o)]
        s, key, t1, t2, count, *follow = unpacked(rows, COUNTED)
        if len(s):
            order, begin = grouped(t1, t2)
            pair = np.empty(len(order), np.int64)
            pair[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(order))))
            one = order[begin]
            i, j = at(t1[one]), at(t2[one])
            more = own(np.diff(np.append(begin, len(order))), 2) / left[i]
            last = np.exp(gain[j] + floor)
            out.append((s[one], chain(t1[one], t2[one]) & LOW, np.log1p(more / last), np.zeros(len(one), np.uint64)))
            p = np.exp(backoff[i]) * (more + last)
            out.append((s, key, np.log1p(own(count, 3) / spread(follow, 3) / p[pair]), count))
        s, key, *n = unpacked(rows, CONTEXT)
        if len(s):
            out.append((s, key, np.log(spread(n[:3], 3) / n[3]), n[3]))
        s, key, value, weight = (np.concatenate(x) for x in zip(*out, strict=True))
        order, begin = grouped(s, key)
        s, key = s[order[begin]], key[order[begin]]
        value, weight = sums(value[order], begin).astype(np.float32).view(np.uint32).astype(np.uint64), sums(weight[order], begin)
        top = np.argsort(-weight.astype(np.int64), kind="stable")[:most]
        often = packed(OFTEN, s[top], key[top], value[top], weight[top])
        return packed(VALUE, s, key, value) + often

    return by_shard(work)


class Lookup:
    """Values by key, 0 for others."""

    def __init__(self, key: np.ndarray, value: np.ndarray):
        """`value` are the bits of single-precision numbers."""
        order = np.argsort(key, kind="stable")
        self.key, self.value = key[order], value[order].astype(np.uint32).view(np.float32).astype(np.float64)
        self.maybe = np.zeros(1 << SLOTS, bool)
        self.maybe[(self.key >> U64(48 - SLOTS)).astype(np.int64)] = True

    def join(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in `key` that have values, and the values."""
        at = np.flatnonzero(self.maybe[(key >> U64(48 - SLOTS)).astype(np.int64)])
        j = np.minimum(np.searchsorted(self.key, key[at]), len(self.key) - 1)
        hit = self.key[j] == key[at]
        return at[hit], self.value[j[hit]]


class Fitted:
    """The table of values, bucketed by shard so that it is not shuffled again, and the log probability of an unknown token."""

    def __init__(self, spark, shards: int):
        self.spark, self.shards = spark, shards
        self.name = f"llm_values_{uuid.uuid4().hex}"
        self.path = own_path(spark, "values")

    def put(self, rows: DataFrame) -> None:
        with exchanges_go(self.spark):
            out = rows.write.mode("append").format("parquet").option("path", self.path).option("compression", "zstd")
            out.bucketBy(self.shards, "shard").saveAsTable(self.name)

    @property
    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def rows(self, kind: int) -> list[tuple]:
        return [tuple(r) for r in self.table.filter(F.col("kind") == kind).collect()]

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE {self.name}")
        drop_path(self.spark, self.path)


def occurrences(tokens: np.ndarray, first: np.ndarray, shards: int):
    """Shard, key and text of all grams of the texts; the contexts of their first tokens are grams too."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    uni, pair, tri = grams(tokens, first, ORDER)
    begin = np.array([BEGIN])
    ends = [np.full(len(first) - 1, chain(*[begin] * k)[0]) for k in (1, 2)]
    route = np.concatenate([uni, pair, pair, *ends])
    return shard_of(route, shards), np.concatenate([uni, pair, tri, *ends]) & LOW, np.concatenate([doc] * 3 + [np.arange(len(first) - 1)] * 2)


class Model:
    """All values of a small model in one place."""

    def __init__(self, fitted: Fitted):
        self.floor = fitted.floor
        _, key, value = unpacked(fitted.rows(VALUE), VALUE)
        self.values = Lookup(key, value)

    def log_probability(self, tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Each token's part; the sum over a text is the log probability of the text."""
        out = np.full(len(tokens), self.floor)
        _, key, doc = occurrences(tokens, first, 1)
        at, value = self.values.join(key)
        np.add.at(out, first[doc[at]], value)
        return out


def tallies(table: Sliced) -> list[int]:
    _, *numbers = unpacked([tuple(r) for r in table.rows().filter(F.col("kind") == TALLY).select("shard", "kind", "data").collect()], TALLY)
    return [int(x.sum()) for x in numbers]


def fit(src: DataFrame, trusted: DataFrame) -> Fitted | None:
    """The model of all trusted texts: `src` has (id, text), `trusted` ids. Grams are counted in shards of their first two
    tokens, meet by their last two, and ask the shards of single tokens for these; figures only reach the driver."""
    spark = src.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def dealt(rows, work):
        """Each shard of a slice in a partition of its own."""
        own = F.expr(f"CAST(shard DIV {SLICES} AS INT)")
        return rows.select("shard", "kind", "data").repartitionById(-(-shards // SLICES), own).mapInArrow(work, FIELDS)

    def of(part, *kinds):
        return F.col("kind").isin(*kinds) & (F.col("part") == part)

    path = own_path(spark, "trusted")
    with exchanges_go(spark):
        src.select("id", "text").join(broadcast_groups(trusted), "id", "left_semi").select("text").write.option("compression", "zstd").parquet(path)
    texts = spark.read.schema("text string").parquet(path)
    counted, asked, told = (Sliced(spark, name) for name in ("grams", "asked", "tokens"))
    for part in range(SLICES):
        counted.put(dealt(texts.mapInArrow(_trigrams(shards, part), FIELDS), _count(shards)))
    drop_path(spark, path)
    three = tallies(counted)
    if not three[4]:
        counted.drop()
        return None
    for part in range(SLICES):
        asked.put(dealt(counted.rows().filter(of(part, COUNTED)), _follow(shards)))
    for part in range(SLICES):
        told.put(dealt(asked.rows().filter(of(part, TOKEN)), by_shard(_tokens)))
    two, one = tallies(asked), tallies(told)
    asked.drop()
    d = [np.zeros(4), *(discounts(x[:4]) for x in (one, two, three))]
    apart = d[1][1] * one[0] + d[1][2] * one[1] + d[1][3] * (one[4] - one[0] - one[1])
    fitted = Fitted(spark, shards)
    fitted.floor = float(np.log(apart / one[5] / (one[4] + 1)))
    work = _values(d, fitted.floor, float(one[5]), 2 * HOT // shards + 1)
    for part in range(SLICES):
        both = counted.rows().filter(of(part, COUNTED, CONTEXT)).unionByName(told.rows().filter(of(part, ANSWER, OWN)))
        fitted.put(dealt(both, work))
        counted.drop(part)
        told.drop(part)
    counted.drop()
    told.drop()
    return fitted


def _bits(width: int):
    """Each shard's part of the filter, a row of kind BITS: a bit for each key's remainder. Rows of kind OFTEN pass."""

    def run(batches):
        parts = {}
        for batch in batches:
            for shard, kind, data in zip(*(batch[c].to_pylist() for c in ("shard", "kind", "data")), strict=True):
                if kind == OFTEN:
                    yield as_batch([(shard, kind, data)])
                    continue
                bits = parts.setdefault(shard, np.zeros(width, np.uint8))
                bits[(unpacked([(shard, kind, data)], VALUE)[1] % U64(width)).astype(np.int64)] = 1
        for shard, bits in parts.items():
            yield as_batch([(shard, BITS, np.packbits(bits, bitorder="little").tobytes())])

    return run


def kept_by_all(fitted: Fitted) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """What is broadcast: keys and values of the HOT grams of most weight, bits of the keys that the shards have, side by
    side, and a shard's number of bits. It comes slice by slice, so the driver never holds all rows beside the result."""
    known = fitted.table.filter(F.col("kind") == VALUE)
    keys = known.agg(F.sum(F.length("data"))).first()[0] // sum(WIDTHS[VALUE])
    width = max(64, min(FILTER_BITS, 8 * keys) // fitted.shards // 8 * 8)
    table = Sliced(fitted.spark, "often")
    table.put(fitted.table.filter(F.col("kind").isin(VALUE, OFTEN)).mapInArrow(_bits(width), FIELDS))
    bits = np.zeros((fitted.shards, width // 8), np.uint8)
    key, value, weight = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    for part in range(SLICES):
        rows = table.rows().filter(F.col("part") == part).select("shard", "kind", "data").collect()
        for shard, kind, data in rows:
            if kind == BITS:
                bits[shard] |= np.frombuffer(data, np.uint8)
        _, *found = unpacked(rows, OFTEN)
        key, value, weight = (np.concatenate([x, y.astype(x.dtype)]) for x, y in zip((key, value, weight), found, strict=True))
        top = np.argsort(-weight.astype(np.int64), kind="stable")[:HOT]
        key, value, weight = key[top], value[top], weight[top]
    table.drop()
    return key, value, bits.ravel(), width


def _ask(shared, shards: int):
    """Sums of the broadcast values by text, a row of kind DONE for each block of texts, and the keys of the other grams to
    their shards."""

    def run(batches):
        key, value, bits, width = shared.value
        often = Lookup(key, value)
        hold, held, done = [], 0, []

        def send(nth):
            shard, key, doc = (np.concatenate(x) for x in zip(*hold, strict=True))
            text, n, total = (np.concatenate(x) for x in zip(*done, strict=True))
            hold.clear()
            done.clear()
            block = block_of(text, nth)
            asks = questions(shard, key, doc, block)
            data = block + len(asks).to_bytes(4, "little") + _planes(text, 8) + _planes(n, 4) + _planes(total.view(np.uint64), 8)
            return as_batches([(int.from_bytes(block, "little") % shards, DONE, data), *asks])

        texts = nth = 0
        for batch in chunks(batches):
            tokens, first = tokens_of(batch["text"])
            shard, key, doc = occurrences(tokens, first, shards)
            at, value = often.join(key)
            done.append((batch["key"].to_numpy().view(np.uint64), np.diff(first).astype(np.uint64), np.bincount(doc[at], value, len(first) - 1).astype(np.float64)))
            place = shard * width + (key % U64(width)).astype(np.int64)
            ask = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            ask[at] = False
            hold.append((shard[ask], key[ask], doc[ask] + texts))
            texts += len(first) - 1
            held += len(tokens)
            if held >= GATHER:
                yield from send(nth)
                held = texts = 0
                nth += 1
        if held:
            yield from send(nth)

    return run


def _answer(asks: pa.Table, known: pa.Table) -> pa.Table:
    """To each block, a row for each that it sent: the sums of what it asks of a shard, or what was known before."""
    rows, values = (list(zip(*(t[c].to_pylist() for c in ("shard", "kind", "data")), strict=True)) for t in (asks, known))
    _, key, value = unpacked(values, VALUE)
    values, out = Lookup(key, value) if len(key) else None, []
    for shard, kind, data in rows:
        if kind == DONE:
            out.append((int.from_bytes(data[:8], "little", signed=True), shard, kind, data[8:]))
            continue
        block, texts, count, ask = asked_in(data)
        found = values.join(ask) if values is not None else (np.zeros(0, np.int64), np.zeros(0))
        out.append((block, shard, PARTS, parts_of(texts, count, *found)))
    cols = zip(*out, strict=True) if out else ((),) * 4
    return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["block", "shard", "kind", "data"])


def _total(block: pa.Table) -> pa.Table:
    """The texts of a block and their sums. Shards are added in their order, so the sums are the same each time."""
    rows = sorted(zip(*(block[c].to_pylist() for c in ("kind", "shard", "data")), strict=True), key=lambda r: r[:2])
    data = rows[0][2] if rows[0][0] == DONE else bytes(4)
    if rows[0][0] != DONE or len(rows) - 1 != int.from_bytes(data[:4], "little"):
        raise ValueError("the rows of a block come from different attempts of a task; the texts' order must not change between them")
    n = (len(data) - 4) // 20
    total = _whole(data[4 + 12 * n :], 8).view(np.float64).copy()
    for _, _, part in rows[1:]:
        texts, value = sums_in(part)
        total[texts] += value  # each text once
    cols = _whole(data[4 : 4 + 8 * n], 8).view(np.int64), _whole(data[4 + 8 * n : 4 + 12 * n], 4).astype(np.int64), total
    return pa.table([pa.array(c) for c in cols], names=["key", "n", "value"])


def losses(texts: DataFrame, fitted: Fitted) -> DataFrame:
    """Of each different text (key, text): key, n_tokens, loss. Blocks of texts ask the shards, which answer in a row for
    each block, so what is sent does not grow by a row for each text and shard. Copies are alike but for the last digits."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(kept_by_all(fitted))
    known = fitted.table.filter(F.col("kind") == VALUE)
    path = own_path(spark, "loss")
    for part in range(TEXT_SLICES):
        asks = texts.filter(F.pmod("key", F.lit(TEXT_SLICES)) == part).mapInArrow(_ask(shared, fitted.shards), FIELDS)
        parts = asks.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(_answer, "block long, shard int, kind int, data binary")
        whole = parts.groupBy("block").applyInArrow(_total, "key long, n long, value double")
        whole = whole.groupBy("key").agg(F.min("n").alias("n_tokens"), F.min("value").alias("value"))
        loss = -F.lit(fitted.floor) * F.col("n_tokens") - F.col("value")
        with exchanges_go(spark):
            whole.select("key", "n_tokens", loss.alias("loss")).write.mode("append").parquet(path)
    shared.destroy()
    return spark.read.schema("key long, n_tokens long, loss double").parquet(path)


def quantiles(limits: DataFrame) -> DataFrame:
    """(lang, own, n): of each language the smallest p that at least QUANTILE of its n rows do not exceed. A sketch says
    between which values it lies, and only these are put in order; the others are counted."""
    edges = [QUANTILE - 2 / SKETCH, min(1.0, QUANTILE + 2 / SKETCH)]
    near = limits.groupBy("lang").agg(F.percentile_approx("p", edges, SKETCH).alias("edge"), F.count("*").alias("n"))
    inside = limits.join(broadcast_groups(near), "lang").filter(F.col("p") <= F.col("edge")[1])
    value = F.when(F.col("p") >= F.col("edge")[0], F.col("p"))  # null, which comes first, for what is below
    upto = F.sum("rows").over(Window.partitionBy("lang").orderBy(F.col("own").asc_nulls_first()))
    ranked = inside.groupBy("lang", "n", value.alias("own")).agg(F.count("*").alias("rows")).withColumn("upto", upto)
    return ranked.filter(F.col("upto") >= F.ceil(F.col("n") * QUANTILE)).groupBy("lang", "n").agg(F.min("own").alias("own"))


def quality(df: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", trust_col="quality", carry: tuple = (), keep_text=False) -> DataFrame:
    """Perplexity of every text under a model of trusted text, and whether it passes its language's threshold.

    Trusted are documents that `labels` marks 1. Half of them (by a hash of the id) gives the model, all of
    their texts whole. The whole other half gives the thresholds, the QUANTILE of mixed
    perplexity for each language. Tokens are what white space separates, and an end. One row per input row: id, lang,
    carry columns (with `keep_text` the text, '' for null, too), n_tokens, perplexity (mixed with PRIOR tokens of average loss), threshold, kept.

    A null text is empty: its perplexity is that of the end and the mixed tokens. A null language is a language of its
    own. Languages with few trusted documents take the threshold of all. Without trusted documents, or with an empty
    label table, every document is kept and the perplexity is null. A label that repeats counts once; a document marked
    both ways is not trusted. Rows with a null id can be scored, but have no label. Other columns are not read.
    """
    spark = df.sparkSession
    small_batches(spark)
    src = df.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), *[F.col(c) for c in carry]
    )
    marked = labels.groupBy(F.col(id_col).alias("id")).agg(F.min(trust_col).alias("least")).filter("least = 1 AND id IS NOT NULL").select("id")
    half = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("half")), F.lit(2))
    model = fit(src.filter(half == 0), marked.filter(half == 0))
    extra = [*([src.schema["text"]] if keep_text else []), *[src.schema[c] for c in carry]]
    schema = T.StructType([src.schema["id"], src.schema["lang"], *extra])
    if model is None:
        return src.select(
            *schema.fieldNames(), F.lit(None).cast("long").alias("n_tokens"), F.lit(None).cast("double").alias("perplexity"),
            F.lit(None).cast("double").alias("threshold"), F.lit(True).alias("kept"),
        )
    # Only hashes of texts and figures meet, so a text is shuffled only where it goes on to the result.
    keyed = src.withColumn("key", F.xxhash64("text"))
    found = losses(keyed.select("key", "text"), model)
    model.drop()
    figures = keyed.select("id", "lang", "key").join(found, "key")
    base = shared_table(figures.join(marked.filter(half == 1), "id", "left_semi").select("lang", "n_tokens", "loss"), "base")
    average = base.agg((F.sum("loss") / F.sum("n_tokens")).alias("m")).first()["m"] or 0.0
    mixed = F.exp((F.col("loss") + PRIOR * average) / (F.col("n_tokens") + PRIOR))
    limits = base.select("lang", mixed.alias("p"))
    by_lang = quantiles(limits).filter(F.col("n") >= LEAST)
    whole = next((r["own"] for r in quantiles(limits.withColumn("lang", F.lit(""))).collect()), None)
    whole_rows = keyed if keep_text else keyed.drop("text")
    # Counted before it is broadcast: joined by shuffle, the texts of a language would meet in one task.
    out = whole_rows.join(found, "key").join(broadcast_groups(by_lang.select("lang", "own")), "lang", "left")
    threshold = F.coalesce("own", F.lit(whole).cast("double"))
    return out.select(
        *schema.fieldNames(), "n_tokens", mixed.alias("perplexity"), threshold.alias("threshold"), F.coalesce(mixed <= threshold, F.lit(True)).alias("kept")
    )


def keep_quality(df: DataFrame, labels: DataFrame, id_col="doc_id") -> DataFrame:
    """Rows that pass, with their own columns. The text travels once, the other columns beside it."""
    rest = F.struct(F.col("text").isNull().alias("null"), F.struct(*[F.col(c) for c in df.columns if c != "text"]).alias("row")).alias("rest")
    whole = df.select(rest, F.col(id_col).alias("doc"), "text", "lang")
    names = labels.withColumnRenamed(id_col, "doc")
    kept = quality(whole, names, "doc", carry=("rest",), keep_text=True).filter("kept")
    text = F.when(~F.col("rest.null"), F.col("text")).alias("text")
    return kept.select(*[text if c == "text" else F.col("rest.row")[c].alias(c) for c in df.columns])
