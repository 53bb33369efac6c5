"""Toxicity: a bidirectional gated recurrent network with attention pooling over words and their characters, in numpy.

A text is cut into overlapping windows of words; every window is scored, and the highest counts. A word enters as its own
vector beside the mean vectors of its letter pairs and of its beginnings. All depend on the word alone, so they and their
products with the input weights are made once for each different word of a batch.
"""

from __future__ import annotations

import pickle
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK, Polynomial, chunks, select_texts, shared_table
from .contamination import words_of

WINDOW, STRIDE = 32, 16
WORD, LETTERS, HIDDEN, ATTEND = 8, 6, 12, 8
#: Buckets of letter pairs and of beginnings of 3 to 8 bytes; words with a vector of their own.
PAIRS, HEADS, VOCABULARY = 1024, 8192, 4096
HEAD_SIZES = range(3, 9)
#: The network is fitted on at most so many labelled rows of each class, of at most so many characters.
TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_CHARS = 1500, 2500, 8000
STEPS, BATCH, RATE, SEED = 450, 48, 0.01, 7


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def start(rng, vocabulary: int, kind=np.float32) -> dict[str, np.ndarray]:
    d, h = WORD + 2 * LETTERS, HIDDEN
    make = lambda *s, by=1.0: (rng.standard_normal(s) * by / np.sqrt(s[0])).astype(kind)
    p = {"word": (rng.standard_normal((vocabulary, WORD)) * 0.1).astype(kind)}
    for name, n in (("pair", PAIRS), ("head", HEADS)):
        p[name] = (rng.standard_normal((n, LETTERS)) * 0.1).astype(kind)
    for side in "fb":
        p |= {f"x{side}": make(d, 3 * h), f"u{side}": make(h, 3 * h), f"c{side}": np.zeros(3 * h, kind)}
    return p | {"a": make(2 * h, ATTEND), "v": make(ATTEND), "o": make(2 * h), "ob": np.zeros(1, kind)}


def inputs(p, ids, letters, words: int):
    """Vectors of different words, and how many letter features of each kind they have."""
    out, sizes = [p["word"][ids]], []
    for name, (bucket, word) in zip(("pair", "head"), letters, strict=True):
        n = np.maximum(np.bincount(word, minlength=words), 1)[:, None].astype(p[name].dtype)
        total = np.zeros((words, LETTERS), p[name].dtype)
        if len(word):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            total[word[starts]] = np.add.reduceat(p[name][bucket], starts)
        out.append(total / n)
        sizes.append(n)
    return np.concatenate(out, 1), sizes


def recur(u, proj, word, mask, keep=None):
    """Hidden states of one direction. proj: input products of different words; word: (time, window) of them."""
    time, windows = word.shape
    h = np.zeros((windows, HIDDEN), proj.dtype)
    out = np.empty((time, windows, HIDDEN), proj.dtype)
    for t in range(time):
        x = proj[word[t]]
        g = h @ u
        zr = sigmoid(x[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        n = np.tanh(x[:, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])
        m = mask[t][:, None]
        new = h + m * (1 - z) * (n - h)
        if keep is not None:
            keep.append((h, z, r, n, g[:, 2 * HIDDEN :], m))
        out[t] = h = new
    return out


def pool(p, h, mask):
    """Attention over the states of each window; its logit."""
    e = np.tanh(h @ p["a"])
    s = np.where(mask > 0, e @ p["v"], -1e9)
    s = np.exp(s - s.max(0))
    w = s * mask
    w = w / np.maximum(w.sum(0), 1e-9)
    context = np.einsum("tw,twh->wh", w, h)
    return context @ p["o"] + p["ob"][0], (e, w, context)


def forward(p, x, word, mask, keep=None):
    hf = recur(p["uf"], x @ p["xf"] + p["cf"], word, mask, None if keep is None else keep.setdefault("f", []))
    hb = recur(p["ub"], x @ p["xb"] + p["cb"], word[::-1], mask[::-1], None if keep is None else keep.setdefault("b", []))[::-1]
    h = np.concatenate([hf, hb], 2)
    logit, more = pool(p, h, mask)
    if keep is not None:
        keep["h"], keep["pool"] = h, more
    return logit


def backward(p, x, word, mask, keep, d_logit):
    """Gradients of all weights and of the word vectors x."""
    g = {k: np.zeros_like(v) for k, v in p.items()}
    h, (e, w, context) = keep["h"], keep["pool"]
    g["o"], g["ob"][0] = context.T @ d_logit, d_logit.sum()
    d_context = d_logit[:, None] * p["o"]
    d_h = w[:, :, None] * d_context
    d_w = np.einsum("twh,wh->tw", h, d_context)
    d_s = w * (d_w - (w * d_w).sum(0))
    g["v"] = np.einsum("tw,twa->a", d_s, e)
    d_e = d_s[:, :, None] * p["v"] * (1 - e * e)
    g["a"] = np.einsum("twh,twa->ha", h, d_e)
    d_h = d_h + d_e @ p["a"].T
    d_x = np.zeros_like(x)
    for side, part in (("f", d_h[:, :, :HIDDEN]), ("b", d_h[::-1, :, HIDDEN:])):
        order = word if side == "f" else word[::-1]
        d_proj = np.zeros((len(x), 3 * HIDDEN), x.dtype)
        carry = np.zeros_like(part[0])
        for t in range(len(order) - 1, -1, -1):
            before, z, r, n, gn, m = keep[side][t]
            dh = part[t] + carry
            dz = dh * m * (before - n) * z * (1 - z)
            dn = dh * m * (1 - z) * (1 - n * n)
            dr = dn * gn * r * (1 - r)
            d_gate = np.concatenate([dz, dr, dn * r], 1)
            carry = dh * (1 - m * (1 - z)) + d_gate @ p[f"u{side}"].T
            g[f"u{side}"] += before.T @ d_gate
            np.add.at(d_proj, order[t], np.concatenate([dz, dr, dn], 1))
        g[f"x{side}"], g[f"c{side}"] = x.T @ d_proj, d_proj.sum(0)
        d_x += d_proj @ p[f"x{side}"].T
    return g, d_x


def windows_of(first: np.ndarray):
    """Word places of all windows of all texts: (window, WINDOW) places, mask, text. The last window of a text ends with
    it; a text of fewer words is one padded window, one without words has none."""
    n = np.diff(first)
    many = np.where(n > 0, np.maximum(0, -(-(n - WINDOW) // STRIDE)) + 1, 0)
    doc = np.repeat(np.arange(len(n)), many)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    begin = np.minimum(nth * STRIDE, np.maximum(n[doc] - WINDOW, 0))
    place = begin[:, None] + np.arange(WINDOW)
    mask = place < n[doc][:, None]
    return first[:-1][doc][:, None] + np.where(mask, place, 0), mask, doc


def different(raw, begins, ends, hashes):
    """Different words of a batch: hashes, letter features (bucket, word) of both kinds; and which one each word is."""
    every, one, which = np.unique(hashes, return_index=True, return_inverse=True)
    b, e = begins[one], ends[one]
    n = e - b + 1  # a pair for each letter with the one before, and one for the end
    word = np.repeat(np.arange(len(every)), n)
    nth = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)
    left = np.where(nth > 0, raw[np.minimum(b[word] + nth - 1, len(raw) - 1)], 0).astype(np.int64)
    right = np.where(nth < n[word] - 1, raw[np.minimum(b[word] + nth, len(raw) - 1)], 0).astype(np.int64)
    pairs = ((left * 263 + right * 31) % PAIRS, word)
    n = np.clip(e - b - HEAD_SIZES[0] + 1, 0, len(HEAD_SIZES))
    word = np.repeat(np.arange(len(every)), n)
    size = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n) + HEAD_SIZES[0]
    heads = ((Polynomial(raw)(b[word], b[word] + size) % HEADS).astype(np.int64), word)
    return every, [pairs, heads], which


def log_odds(doc: np.ndarray, what: np.ndarray, n: int, toxic: np.ndarray) -> np.ndarray:
    """How much more often toxic texts hold each word or feature."""
    seen = np.unique(doc * n + what)
    hot = toxic[seen // n]
    a, b = np.bincount(seen[hot] % n, minlength=n), np.bincount(seen[~hot] % n, minlength=n)
    odds = np.log((a + 0.5) / (toxic.sum() + 1)) - np.log((b + 0.5) / ((~toxic).sum() + 1))
    return np.where(a + b >= 8, np.clip(odds, -4, 4), 0)


class Network:
    def __init__(self, vocabulary: np.ndarray, p: dict, scale=(1.0, 0.0)):
        self.vocabulary, self.p, self.scale = vocabulary, p, scale

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        j = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[j] == hashes, j + 1, 0)

    def logits(self, column: pa.Array) -> np.ndarray:
        """The highest window logit of every text; a text without words has that of an empty context."""
        raw, begins, ends, hashes, first = words_of(column)
        every, letters, which = different(raw, begins, ends, hashes)
        x, _ = inputs(self.p, self.ids(every), letters, len(every))
        out = np.full(len(column), -np.inf, np.float32)
        place, mask, doc = windows_of(first)
        for lo in range(0, len(doc), 8192):
            part = slice(lo, lo + 8192)
            logit = forward(self.p, x, which[place[part]].T, mask[part].T.astype(np.float32))
            np.maximum.at(out, doc[part], logit)
        return np.where(np.isneginf(out), self.p["ob"][0], out).astype(np.float64)

    def score(self, column: pa.Array) -> np.ndarray:
        return sigmoid(self.scale[0] * self.logits(column) + self.scale[1])


def train(texts: list[str], labels: np.ndarray, share: float, steps: int = STEPS) -> Network:
    """Fits the network: for each text of a batch the window that scores highest now is pushed towards its label.
    `share`: the part of toxic rows among all labelled ones, for the final scale."""
    rng = np.random.default_rng(SEED)
    raw, begins, ends, hashes, first = words_of(pa.array(texts, pa.string()))
    every, letters, which = different(raw, begins, ends, hashes)
    count = np.bincount(which, minlength=len(every))
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    toxic = labels > 0
    frequent = np.flatnonzero(count >= 4)
    frequent = np.sort(frequent[np.argsort(-count[frequent], kind="stable")[: VOCABULARY - 1]])
    p = start(rng, len(frequent) + 1)
    at = [np.searchsorted(word, np.arange(len(every) + 1)) for _, word in letters]
    if len(which):  # a first guess
        p["word"][1:, 0] = log_odds(doc, which, len(every), toxic)[frequent] / 2
        n = at[1][which + 1] - at[1][which]
        place = np.repeat(at[1][which] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        p["head"][:, 0] = log_odds(np.repeat(doc, n), letters[1][0][place], HEADS, toxic) / 2
    net = Network(every[frequent], p)
    ids = net.ids(every)
    place, mask, owner = windows_of(first)
    words, mask = which[place].T if len(owner) else np.zeros((WINDOW, 0), int), mask.T.astype(np.float32)
    begin_of = np.searchsorted(owner, np.arange(len(texts) + 1))
    have = np.flatnonzero(np.diff(begin_of) > 0)
    sides = [have[toxic[have]], have[~toxic[have]]]
    if not (len(sides[0]) and len(sides[1])):
        p["o"][:], p["ob"][0] = 0, np.log((share + 1e-6) / (1 - share + 1e-6))
        return net
    mean, square = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}

    def own(word_index):
        """Vectors of some words only, and what is needed to send gradients back to them."""
        some, back = np.unique(word_index, return_inverse=True)
        part = []
        for (bucket, _), cut in zip(letters, at, strict=True):
            n = cut[some + 1] - cut[some]
            place = np.repeat(cut[some] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            part.append((bucket[place], np.repeat(np.arange(len(some)), n)))
        x, sizes = inputs(p, ids[some], part, len(some))
        return some, back.reshape(word_index.shape), part, x, sizes

    for step in range(1, steps + 1):
        docs = np.concatenate([rng.choice(s, BATCH // 2) for s in sides])
        n = begin_of[docs + 1] - begin_of[docs]
        many = np.concatenate([np.arange(begin_of[d], begin_of[d + 1]) for d in docs])
        _, local, _, x, _ = own(words[:, many])
        logit = forward(p, x, local, mask[:, many])
        cut = np.concatenate([[0], np.cumsum(n)])
        best = np.array([many[a + np.argmax(logit[a:b])] for a, b in zip(cut[:-1], cut[1:], strict=True)])
        some, local, part, x, sizes = own(words[:, best])
        keep: dict = {}
        m = mask[:, best]
        logit = forward(p, x, local, m, keep)
        g, d_x = backward(p, x, local, m, keep, ((sigmoid(logit) - toxic[docs]) / len(docs)).astype(np.float32))
        np.add.at(g["word"], ids[some], d_x[:, :WORD])
        for k, (name, (bucket, word), size) in enumerate(zip(("pair", "head"), part, sizes, strict=True)):
            lo = WORD + k * LETTERS
            np.add.at(g[name], bucket, (d_x[:, lo : lo + LETTERS] / size)[word])
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, v in p.items():
            mean[k] = 0.9 * mean[k] + 0.1 * g[k]
            square[k] = 0.999 * square[k] + 0.001 * g[k] ** 2
            v -= (rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)).astype(v.dtype)
    net.scale = fit_scale(net.logits(pa.array(texts, pa.string())), toxic, share)
    return net


def fit_scale(logit: np.ndarray, toxic: np.ndarray, share: float) -> tuple[float, float]:
    """Logistic scale of the logits, each class weighted to its part among all labelled rows."""
    weight = np.where(toxic, share / toxic.mean(), (1 - share) / (~toxic).mean())
    a, b = 1.0, 0.0
    for _ in range(50):
        q = sigmoid(a * logit + b)
        d = weight * (q - toxic)
        w = weight * q * (1 - q) + 1e-9
        hess = np.array([[(w * logit**2).sum() + 1e-3, (w * logit).sum()], [(w * logit).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(hess, [(d * logit).sum() + 1e-3 * (a - 1), d.sum()])
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-6:
            break
    return (float(a), float(b)) if np.isfinite([a, b]).all() and a > 0 else (1.0, 0.0)


def packed(net: Network) -> bytes:
    """The network as plain arrays, a few hundred kilobytes."""
    return zlib.compress(pickle.dumps((net.vocabulary, net.p, net.scale)))


def _fit(share):
    def run(table: pa.Table) -> pa.Table:
        order = np.lexsort((table["text"].to_numpy(), table["key"].to_numpy()))
        texts = [table["text"][int(i)].as_py() for i in order]
        labels = table["toxic"].to_numpy()[order]
        return pa.table({"model": pa.array([packed(train(texts, labels, share))], pa.binary())})

    return run


def _score(shared):
    def run(batches):
        net = Network(*pickle.loads(zlib.decompress(shared.value)))
        for batch in chunks(batches, CHUNK):
            score = np.clip(net.score(batch["text"]), 0.0, 1.0)
            cols = [batch["id"], batch["held_out"], pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "held_out", "score", "predicted"])

    return run


def toxicity(df: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic") -> DataFrame:
    """Toxicity score of every text. Labels are learned only from rows whose crc32(id as text) mod 5 is not 0.

    One row per input row: id, held_out, score (0 to 1), predicted (score of 0.5 or more). All overlapping windows of a
    text are scored; a text without words, also a null one, has the score of an empty window. The network is fitted in
    one task on at most TRAIN_TOXIC toxic and TRAIN_CLEAN other rows of at most TRAIN_CHARS characters, taken by a hash
    of the id; inputs are texts alone. Without labels of both classes the score is the same for all texts. A label
    that repeats counts once, the highest value holds; null labels and rows with a null id teach nothing (held_out of
    a null id is false). Repeated rows give repeated rows; other columns are not read.
    """
    src = select_texts(df, id_col, text_col)
    text_id = F.col("id").cast("string")
    held = F.coalesce(F.pmod(F.crc32(text_id.cast("binary")), F.lit(5)) == 0, F.lit(False))
    marked = labels.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("toxic")).filter("id IS NOT NULL AND toxic IS NOT NULL").filter(~held)
    rows = marked.agg(F.count("*").alias("n"), F.sum((F.col("toxic") > 0).cast("long")).alias("t")).first()
    share = (rows["t"] or 0) / max(rows["n"], 1)
    # The rows of the sample are chosen by id and length; their texts then meet this bounded list where they are read.
    sized = src.filter(F.length("text") <= TRAIN_CHARS).select("id").join(marked, "id")
    key, toxic = F.xxhash64(text_id), (F.col("toxic") > 0).cast("int")
    listed = sized.select("id", key.alias("key"), toxic.alias("toxic")).distinct()
    picked = listed.filter("toxic = 1").orderBy("key", "id").limit(TRAIN_TOXIC).union(listed.filter("toxic = 0").orderBy("key", "id").limit(TRAIN_CLEAN))
    picked = shared_table(picked, "toxic")
    sample = src.filter(F.length("text") <= TRAIN_CHARS).join(F.broadcast(picked), "id").select("key", "text", "toxic")
    got = sample.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(_fit(share), "model binary").first()
    model = bytes(got["model"]) if got else packed(train([], np.zeros(0), share))
    kind = src.schema["id"].dataType.simpleString()
    out = src.withColumn("held_out", held).mapInArrow(_score(src.sparkSession.sparkContext.broadcast(model)), f"id {kind}, held_out boolean, score double, predicted int")
    return out.withColumnRenamed("id", id_col)
