"""Language-model scores: a bigram model of the corpus in Elias-Fano tries, sharded by context.

Documents are put into groups. A group sends each shard its different pairs (token, next token) with their counts in
training documents. A shard adds the counts up, builds a trie of quantised smoothed probabilities, looks up the pairs of
each group, and answers. A group that has all answers scores its documents. So a pair of tokens travels once for each
group, however often it stands there, and no table of the corpus is ever whole in one place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK, U64, Polynomial, chunks, lower_ascii, mix, runs, select_texts, text_bytes, token_class
from .trie import Trie, meaning

BEGIN, END = U64(1), U64(2)
#: Weight of the unigram distribution in each context: as if it had been seen so often.
PRIOR = 8.0
#: Bytes of text in a group of documents, about.
GROUP_BYTES = 8 << 20
#: Tokens that make up more than this part of a sample's tokens have their pairs dealt out one by one; at most so many.
SAMPLE, HEAVY_PART, HEAVY_MOST = 32, 1e-3, 1000

def token_hashes(column: pa.Array):
    """Hashes of the tokens of all texts, A-Z lower-cased, each text's followed by END; where each text's begin."""
    raw, offsets = text_bytes(column)
    raw = lower_ascii(raw)
    begins, ends = runs(token_class()[raw], offsets)
    first = np.searchsorted(begins, offsets)
    n = len(offsets) - 1
    out = np.full(len(begins) + n, END, np.uint64)
    out[np.arange(len(begins)) + np.repeat(np.arange(n), np.diff(first))] = Polynomial(raw, 11)(begins, ends)
    return out, first + np.arange(n + 1)


def planes(values: np.ndarray, size: int) -> bytes:
    """Low `size` bytes of whole numbers, byte place by byte place, which packs well."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def whole(raw: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(raw) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(raw, np.uint8).reshape(size, -1).T
    return out.view("<u8").ravel().astype(np.uint64)


class Group:
    """Tokens of a group of documents: different tokens, different pairs, and which one stands at each place."""

    def __init__(self, table: pa.Table, shards: int, heavy: np.ndarray):
        rows = table.select(["id", "text", "held_out"]).combine_chunks()
        order = sorted(range(rows.num_rows), key=lambda k: (rows["id"][k].as_py() is None, str(rows["id"][k])))
        self.rows = rows.take(pa.array(order, pa.int64())) if rows.num_rows else rows
        tokens, first, at = [], [np.zeros(1, np.int64)], 0
        for batch in chunks(self.rows.to_batches(), CHUNK // 4):
            t, f = token_hashes(batch["text"])
            tokens.append(t)
            first.append(f[1:] + at)
            at += len(t)
        self.tokens, self.first = np.concatenate(tokens), np.concatenate(first)
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.first[:-1]] = BEGIN
        self.words, index = np.unique(np.concatenate([self.tokens, before]), return_inverse=True)
        self.word, self.context = index[: len(self.tokens)], index[len(self.tokens) :]
        key = self.context.astype(np.int64) << 32 | self.word
        pair, self.pair = np.unique(key, return_inverse=True)
        learn = np.repeat(~self.rows["held_out"].to_numpy(zero_copy_only=False), np.diff(self.first))
        count = np.bincount(self.pair[learn], minlength=len(pair))
        c, w = pair >> 32, pair & 0xFFFFFFFF
        spread = np.isin(self.words, heavy)[c] | (self.words[c] == BEGIN)
        route = np.where(spread, mix(self.words[c] ^ mix(self.words[w])), mix(self.words[c]))
        self.shard = (route % U64(shards)).astype(np.int64)
        self.order = np.argsort(self.shard, kind="stable")
        self.cut = np.searchsorted(self.shard[self.order], np.arange(shards + 1))
        self.pair_context, self.pair_word, self.pair_count = c, w, count

    def message(self, s: int):
        """Contexts, number of pairs of each, next tokens and counts for one shard, and the contexts' words here."""
        part = self.order[self.cut[s] : self.cut[s + 1]]
        c = self.pair_context[part]
        new = np.ones(len(c), bool)
        new[1:] = c[1:] != c[:-1]
        begin = np.flatnonzero(new)
        return self.words[c[begin]], np.diff(np.append(begin, len(c))), self.words[self.pair_word[part]] >> U64(16), self.pair_count[part], c[begin], part


MESSAGE = "g long, shard int, contexts binary, pairs binary, words binary, counts binary"


def _send(shards: int, heavy: np.ndarray):
    def run(table: pa.Table) -> pa.Table:
        group = Group(table, shards, heavy)
        g, rows = table["g"][0].as_py(), []
        for s in range(shards):
            contexts, pairs, words, counts, _, _ = group.message(s)
            rows.append((g, s, planes(contexts, 8), planes(pairs, 4), planes(words, 6), planes(counts, 4)))
        types = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
        names = [f.split()[0] for f in MESSAGE.split(", ")]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return run


ANSWER = "g long, shard int, distinct long, totals binary, codes binary"


def _answer(heavy: np.ndarray, heavy_count: np.ndarray, documents: int):
    """Tries of the shards of a partition, one after the other, and the answers to their messages."""

    def total_of(contexts, own, own_total):
        """Training count of contexts: BEGIN and heavy ones are known before, the others are whole in this shard."""
        out = np.zeros(len(contexts), np.int64)
        if len(own):
            j = np.minimum(np.searchsorted(own, contexts), len(own) - 1)
            out = np.where(own[j] == contexts, own_total[j], 0)
        if len(heavy):
            j = np.minimum(np.searchsorted(heavy, contexts), len(heavy) - 1)
            out = np.where(heavy[j] == contexts, heavy_count[j], out)
        return np.where(contexts == BEGIN, documents, out)

    def run(batches):
        by_shard: dict[int, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                by_shard.setdefault(r["shard"], []).append(r)
        for shard, messages in sorted(by_shard.items()):
            contexts = [whole(r["contexts"], 8) for r in messages]
            pairs = [whole(r["pairs"], 4).astype(np.int64) for r in messages]
            words = [whole(r["words"], 6) for r in messages]
            counts = [whole(r["counts"], 4).astype(np.int64) for r in messages]
            c = np.concatenate([np.repeat(x, n) for x, n in zip(contexts, pairs, strict=True)])
            w, n = np.concatenate(words), np.concatenate(counts)
            seen = np.flatnonzero(n)
            seen = seen[np.lexsort((w[seen], c[seen]))]
            new = np.ones(len(seen), bool)
            new[1:] = (c[seen][1:] != c[seen][:-1]) | (w[seen][1:] != w[seen][:-1])
            begin = np.flatnonzero(new)
            number = np.add.reduceat(n[seen], begin) if len(seen) else np.zeros(0, np.int64)
            kc, kw = c[seen][begin], w[seen][begin]
            own = np.unique(kc)
            own_total = np.bincount(np.searchsorted(own, kc), number, len(own)).astype(np.int64)
            trie = Trie(kc, kw, number / (total_of(kc, own, own_total) + PRIOR), 48)
            distinct = int((~np.isin(own, heavy) & (own != BEGIN)).sum())
            for r, x, p, y in zip(messages, contexts, pairs, words, strict=True):
                totals = total_of(x, own, own_total)
                codes = trie.find(np.repeat(x, p), y)
                cols = [pa.array([v], t) for v, t in ((r["g"], pa.int64()), (shard, pa.int32()), (distinct, pa.int64()), (planes(totals, 5), pa.binary()), (codes.tobytes(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(cols, names=["g", "shard", "distinct", "totals", "codes"])

    return run


def _score(shards: int, heavy: np.ndarray, heavy_count: np.ndarray, tokens: int, documents: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        group = Group(table, shards, heavy)
        count = np.zeros(len(group.words), np.int64)
        code = np.zeros(len(group.pair_context), np.uint8)
        distinct = int((heavy_count > 0).sum()) + (documents > 0)
        for r in answers.to_pylist():
            _, _, _, _, context, part = group.message(r["shard"])
            count[context] = whole(r["totals"], 5).astype(np.int64)
            code[part] = np.frombuffer(r["codes"], np.uint8)
            distinct += r["distinct"]
        known = count.copy()
        known[group.words == END] = documents  # each training document has one end
        base = np.log10((known + 1) / (tokens + distinct + 1))
        single = 10 ** base
        p = meaning()[code] + PRIOR / (count[group.pair_context] + PRIOR) * single[group.pair_word]
        pair_score = np.log10(np.minimum(p, 1.0))
        cut = group.first[:-1]
        out = {
            "id": group.rows["id"],
            "held_out": group.rows["held_out"],
            "n_tokens": pa.array(np.diff(group.first), pa.int64()),
            "n_known": pa.array(np.add.reduceat((known > 0)[group.word].astype(np.int64), cut), pa.int64()),
            "train_tokens": pa.array(np.full(len(cut), tokens), pa.int64()),
            "base_score": pa.array(np.add.reduceat(base[group.word], cut)),
            "score": pa.array(np.add.reduceat(pair_score[group.pair], cut)),
        }
        return pa.table(out)

    return run


def _counted(batches):
    for batch in chunks(batches):
        tokens, first = token_hashes(batch["text"])
        words, n = np.unique(tokens, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n, pa.int64())], names=["word", "n"])


def _totals(heavy: np.ndarray):
    """Counts of the heavy tokens, and of all tokens and documents, in training documents."""

    def run(batches):
        count, tokens, documents = np.zeros(len(heavy), np.int64), 0, 0
        for batch in chunks(batches):
            t, first = token_hashes(batch["text"])
            tokens += len(t)
            documents += len(first) - 1
            if len(heavy):
                j = np.minimum(np.searchsorted(heavy, t), len(heavy) - 1)
                count += np.bincount(j[heavy[j] == t], minlength=len(heavy))
        yield pa.RecordBatch.from_arrays([pa.array([tokens]), pa.array([documents]), pa.array([count.tolist()], pa.list_(pa.int64()))], names=["tokens", "documents", "heavy"])

    return run


def score_texts(df: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Log10 probability of every text under a bigram model of the training documents: those whose crc32(id as text)
    mod 7 is not 2.

    Tokens are what white space separates, A-Z lower-cased, then one end. One row per input row: id, held_out, n_tokens,
    n_known, train_tokens, base_score (unigrams with one added), score. P(b | a) = (c(a b) + PRIOR * P1(b)) / (c(a) +
    PRIOR), with P1 the distribution of the base score; c(a b) / (c(a) + PRIOR) is kept in 8 bits. All training documents
    count. A null text is empty: it has its end alone. A row with a null id is a training document. Repeated rows are
    documents of their own. Without training documents all counts are 0. An empty table gives no rows; other columns are
    not read. Tokens are told by 64-bit hashes, next tokens within a context by 48 bits.

    Groups hold GROUP_BYTES of text; shards are twice as many as shuffle partitions. Pairs after a token that makes up a
    large part of a sample are dealt out one by one, so no shard takes all that follows it.
    """
    spark = df.sparkSession
    src = select_texts(df, id_col, text_col)
    text_id = F.col("id").cast("string")
    src = src.withColumn("held_out", F.coalesce(F.pmod(F.crc32(text_id.cast("binary")), F.lit(7)) == 2, F.lit(False)))
    learn = src.filter("NOT held_out").select("text")
    shards = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = learn.filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).mapInArrow(_counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    size = part.agg(F.sum("n")).first()[0] or 0
    top = part.filter(F.col("n") >= max(size * HEAVY_PART, 8)).orderBy(F.desc("n"), "word").limit(HEAVY_MOST).collect()
    heavy = np.sort(np.array([r["word"] for r in top], np.int64).view(np.uint64))
    heavy = heavy[heavy != END]
    sums = learn.mapInArrow(_totals(heavy), "tokens long, documents long, heavy array<long>").agg(
        F.sum("tokens").alias("tokens"), F.sum("documents").alias("documents"), *[F.sum(F.col("heavy")[k]).alias(f"h{k}") for k in range(len(heavy))]
    )
    got = sums.first()
    tokens, documents = got["tokens"] or 0, got["documents"] or 0
    heavy_count = np.array([got[f"h{k}"] or 0 for k in range(len(heavy))], np.int64)
    volume = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-volume // GROUP_BYTES))
    kind = src.schema["id"].dataType.simpleString()
    out = f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    grouped = src.withColumn("g", F.pmod(F.xxhash64("id", "text"), F.lit(groups)))
    messages = grouped.groupBy("g").applyInArrow(_send(shards, heavy), MESSAGE)
    answers = messages.repartition(shards, "shard").mapInArrow(_answer(heavy, heavy_count, documents), ANSWER)
    scored = grouped.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(_score(shards, heavy, heavy_count, tokens, documents), out)
    return scored.withColumnRenamed("id", id_col)
