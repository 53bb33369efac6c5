"""SentencePiece encoding and decoding with a BPE vocabulary by a streaming Viterbi search.

A path is a row of pieces. Two pieces may stand side by side if merging their joint text gives back just these two, and a
row in which all neighbours may stand side by side is the one that merging gives. So at each place exactly one piece can
end a surviving path, and each step looks back no further than the longest piece. No piece reaches from a letter over
a space, so all paths meet before a space: ids are committed there, and equal stretches between such places (words) are
solved once per batch, all words of a batch in step.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import U64, Polynomial, chunks, mix, select_texts, text_bytes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Sign for a space inside pieces.
SPACE = "▁"
#: Words with more characters are solved one by one, by the same search.
LONG = 64
SLOTS = 20
#: Bytes of different words that are searched at once.
LETTERS = 1 << 18
#: Solved words that a task keeps.
KNOWN = 500_000


def fresh_words() -> dict[str, np.ndarray]:
    """Solved words: key, and where their ids begin and how many they are."""
    return {"key": np.zeros(1, np.uint64), "begin": np.zeros(1, np.int64), "count": np.zeros(1, np.int64), "ids": np.zeros(0, np.int32)}


def learnt(known: dict, key: np.ndarray, ids: np.ndarray, start: np.ndarray) -> dict:
    every = np.concatenate([known["key"], key])
    order = np.argsort(every)
    begin = np.concatenate([known["begin"], start[:-1] + len(known["ids"])])
    count = np.concatenate([known["count"], np.diff(start)])
    return {"key": every[order], "begin": begin[order], "count": count[order], "ids": np.concatenate([known["ids"], ids])}


class Tables:
    """What the search needs of a vocabulary: pieces by hash, merge ranks, how each piece was last merged, which pairs
    merge. Its size is bounded by the vocabulary's."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.byte_id = {}
        pieces, score = {}, {}
        self.text = [b""] * n
        for i in range(n):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
                self.text[i] = bytes([int(p[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                pieces[p], score[p] = i, sp.get_score(i)
                self.text[i] = p.replace(SPACE, " ").encode()
        if any(SPACE in p.lstrip(SPACE) or (p.startswith(SPACE * 2) and p.strip(SPACE)) for p in pieces):
            raise ValueError("this vocabulary has pieces that reach over a space")
        # Spaces merge after everything else, so rows of spaces are kept apart from the words.
        self.spaces = {len(p): i for p, i in pieces.items() if not p.strip(SPACE)}
        words = {p: i for p, i in pieces.items() if p.strip(SPACE) or p == SPACE}
        order = sorted(words, key=lambda p: (len(p) > 1, -score[p], words[p]))
        self.rank = {p: k for k, p in enumerate(order)}
        self.ids = np.array([words[p] for p in order] + [-1], np.int32)
        self.length = np.array([len(p) for p in order] + [1], np.int32)
        self.unknown = len(order)
        self.longest = int(self.length.max())
        left, right = np.arange(len(order)), np.arange(len(order))
        own = np.ones(len(order), bool)
        for k, p in enumerate(order):
            if len(p) > 1:
                row, last = self.merged(p)
                own[k] = len(row) == 1
                if own[k]:
                    left[k], right[k] = self.rank[last[0]], self.rank[last[1]]
        self.left, self.right = left, right
        pairs = [
            (self.rank[p[:i]] * (self.unknown + 1) + self.rank[p[i:]], k)
            for k, p in enumerate(order)
            for i in range(1, len(p))
            if p[:i] in self.rank and p[i:] in self.rank
        ]
        pairs.sort()
        self.pair_key = np.array([a for a, _ in pairs], np.int64)
        self.pair_rank = np.array([b for _, b in pairs], np.int64)
        usable = [k for k in range(len(order)) if own[k]]
        raw = [order[k].replace(SPACE, " ").encode() for k in usable]
        ends = np.cumsum([len(x) for x in raw])
        h = Polynomial(np.frombuffer(b"".join(raw), np.uint8))(np.concatenate([[0], ends[:-1]]), ends)
        o = np.argsort(h)
        self.hash, self.hash_piece = h[o], np.array(usable, np.int64)[o]
        self.maybe = np.zeros(1 << SLOTS, bool)
        self.maybe[(h >> U64(64 - SLOTS)).astype(np.int64)] = True
        self.cache = {}
        self.known = fresh_words()

    @classmethod
    def over(cls, state: dict) -> "Tables":
        """Tables over a broadcast state; what a worker has solved stays in it for its next task."""
        out = cls.__new__(cls)
        out.__dict__ = state
        return out

    def merged(self, text: str):
        """Pieces of `text` by merging the best pair first, and the pair merged last."""
        row, last = list(text), None
        while True:
            best = min(((self.rank.get(row[i] + row[i + 1], 1 << 60), i) for i in range(len(row) - 1)), default=(1 << 60, 0))
            if best[0] == 1 << 60:
                return row, last
            i = best[1]
            last = (row[i], row[i + 1])
            row[i : i + 2] = [row[i] + row[i + 1]]

    def space_row(self, n: int) -> list[int]:
        """Ids of `n` spaces: all pairs rank alike, so the leftmost pair that forms a piece merges first."""
        row = [1] * n
        i = 0
        while i < len(row) - 1:
            if row[i] + row[i + 1] in self.spaces:
                row[i : i + 2] = [row[i] + row[i + 1]]
                i = 0 if i else i
            else:
                i += 1
        return [self.spaces[k] for k in row]

    def side_by_side(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the joint text of each pair gives the pair itself: undoes the merges next to the seam, the
        later one first, and looks for a pair across the seam that would have merged earlier."""
        ok = np.ones(len(a), bool)
        live = np.flatnonzero((a != self.unknown) & (b != self.unknown))
        a, b = a[live].copy(), b[live].copy()
        limit = np.full(len(a), 1 << 60)
        while len(live):
            key = a * (self.unknown + 1) + b
            at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
            bad = (self.pair_key[at] == key) & (self.pair_rank[at] < limit)
            ok[live[bad]] = False
            base_a, base_b = self.left[a] == a, self.left[b] == b
            go = ~bad & ~(base_a & base_b)
            first = np.where(base_a, False, np.where(base_b, True, a > b))
            limit = np.where(first, a, b + 1)[go]
            a, b = np.where(first, self.right[a], a)[go], np.where(first, b, self.left[b])[go]
            live = live[go]
        return ok

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """`side_by_side` behind a table of answers that lives as long as the worker."""
        if not self.cache:
            self.cache["key"] = np.full(1 << SLOTS, -1, np.int64)
            self.cache["ok"] = np.zeros(1 << SLOTS, bool)
        keys, oks = self.cache["key"], self.cache["ok"]
        key = a * (self.unknown + 1) + b
        slot = (mix(key.astype(np.uint64)) >> U64(64 - SLOTS)).astype(np.int64)
        out = oks[slot]
        miss = np.flatnonzero(keys[slot] != key)
        if len(miss):
            fresh, back = np.unique(key[miss], return_inverse=True)
            got = self.side_by_side(fresh // (self.unknown + 1), fresh % (self.unknown + 1))
            out[miss] = got[back]
            s = (mix(fresh.astype(np.uint64)) >> U64(64 - SLOTS)).astype(np.int64)
            keys[s], oks[s] = fresh, got
            keep = keys[s] == fresh  # of two that share a slot the last stays, with its own answer
            oks[s[keep]] = got[keep]
        return out

    def words(self, raw: np.ndarray, begins: np.ndarray, ends: np.ndarray):
        """Ids of words (UTF-8 with a leading space): flat ids and where each word's ids begin. One step per character
        place, for all words that reach it."""
        starts = np.flatnonzero((raw & 0xC0) != 0x80)  # of characters
        first = np.searchsorted(starts, begins)
        count = np.searchsorted(starts, ends) - first
        bounds = np.append(starts, len(raw))
        stop = np.repeat(first + count, count)  # where the word of each character ends
        poly, k = Polynomial(raw), np.arange(len(starts))
        match = []
        for size in range(1, self.longest + 1):
            piece = np.full(len(starts), -1, np.int32)
            at = k[k + size <= stop]
            h = poly(bounds[at], bounds[at + size])
            maybe = self.maybe[(h >> U64(64 - SLOTS)).astype(np.int64)]
            at, h = at[maybe], h[maybe]
            j = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
            hit = self.hash[j] == h
            piece[at[hit]] = self.hash_piece[j[hit]]
            if size == 1:
                piece[piece < 0] = self.unknown
            match.append(piece)
        last = np.full(len(starts), -1, np.int64)  # the piece that ends with each character
        order = np.argsort(-count, kind="stable")
        f, c = first[order], count[order]
        for i in range(1, (int(c[0]) if len(c) else 0) + 1):
            here = f[: np.searchsorted(-c, -i, "right")] + i - 1
            open_ = np.arange(len(here))
            for size in range(min(i, self.longest), 0, -1):
                if not len(open_):
                    break
                end = here[open_]
                cand = match[size - 1][end - size + 1].astype(np.int64)
                hit = np.flatnonzero(cand >= 0)
                if not len(hit):
                    continue
                cand, end = cand[hit], end[hit]
                if size < i:
                    ok = self.may_follow(last[end - size], cand)
                    hit, cand, end = hit[ok], cand[ok], end[ok]
                last[end] = cand
                open_ = np.delete(open_, hit)
        # Back from each word's end.
        sel, tail = np.arange(len(first)), first + count - 1
        found_word, found_at, found_piece = [], [], []
        while len(sel):
            p = last[tail]
            found_word.append(sel)
            found_at.append(tail)
            found_piece.append(p)
            tail = tail - self.length[p]
            go = tail >= first[sel]
            sel, tail = sel[go], tail[go]
        if not found_word:
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        at, word, piece = np.concatenate(found_at), np.concatenate(found_word), np.concatenate(found_piece)
        o = np.argsort(at, kind="stable")
        at, word, piece = at[o], word[o], piece[o]
        size = np.ones(len(at), np.int64)
        unknown = np.flatnonzero(piece == self.unknown)
        size[unknown] = bounds[at[unknown] + 1] - bounds[at[unknown]]
        out = np.repeat(self.ids[piece], size)
        offset = np.cumsum(size) - size
        code = np.array([self.byte_id.get(b, 0) for b in range(256)], np.int32)
        n = size[unknown]
        nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(offset[unknown], n) + nth] = code[raw[np.repeat(bounds[at[unknown]], n) + nth]]
        return out, np.concatenate([[0], np.cumsum(np.bincount(word, size, len(first)).astype(np.int64))])

    def long_word(self, text: str) -> list[int]:
        """The same search for one word: each place has one piece that can end there, and the ids are read back at the
        word's end."""
        last: list[int] = []
        for i in range(1, len(text) + 1):
            got = -1
            for size in range(min(i, self.longest), 0, -1):
                p = self.rank.get(text[i - size : i])
                if p is None or (size > 1 and self.left[p] == p):
                    continue
                if size == i or last[i - size - 1] == self.unknown or self.may_follow(np.array([last[i - size - 1]]), np.array([p]))[0]:
                    got = p
                    break
            last.append(self.unknown if got < 0 else got)
        out, i = [], len(text)
        while i:
            p = last[i - 1]
            if p == self.unknown:
                out.extend(self.byte_id[b] for b in reversed(text[i - 1].encode()))
            else:
                out.append(int(self.ids[p]))
            i -= int(self.length[p])
        return out[::-1]

    def odd_word(self, raw: bytes) -> list[int]:
        """A word behind several spaces, spaces alone, or a long word."""
        text = raw.decode()
        word = text.lstrip(" ")
        n = len(text) - len(word)
        if not word:
            return self.space_row(n)
        form = SPACE * (n > 0) + word
        if len(form) > LONG:
            ids = self.long_word(form)
        else:
            raw_form = np.frombuffer(form.replace(SPACE, " ").encode(), np.uint8)
            ids = self.words(raw_form, np.zeros(1, np.int64), np.array([len(raw_form)]))[0].tolist()
        if n <= 1:
            return ids
        if ids[0] == self.spaces[1]:  # the last space did not merge with the word
            return self.space_row(n) + ids[1:]
        return self.space_row(n - 1) + ids

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and where each text's ids begin."""
        column = pc.replace_substring(column, pattern=SPACE, replacement=" ")
        raw, offsets = text_bytes(column)
        size = np.diff(offsets)
        full = size > 0  # an empty text has no ids, not even for the leading space
        grow = np.concatenate([[0], np.cumsum(full)])
        buf = np.full(len(raw) + int(full.sum()), 32, np.uint8)
        at = offsets[:-1][full] + np.arange(full.sum())
        body = np.ones(len(buf), bool)
        body[at] = False
        buf[body] = raw
        offsets = offsets + grow
        blank = buf == 32
        begin = blank.copy()
        begin[1:] &= ~blank[:-1]
        begin[at] = True
        if "\n" not in self.rank:  # then it is bytes on its own, wherever it stands
            line = np.flatnonzero(buf == 10)
            begin[line] = True
            begin[line[line + 1 < len(buf)] + 1] = True
        begins = np.flatnonzero(begin)
        ends = np.append(begins[1:], len(buf))
        col = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(np.append(begins, len(buf)).astype(np.int32)), pa.py_buffer(buf)])
        coded = col.dictionary_encode()
        index, words = coded.indices.to_numpy(), coded.dictionary
        wraw, woff = text_bytes(words)
        chars = np.add.reduceat((wraw & 0xC0) != 0x80, woff[:-1], dtype=np.int64) if len(words) else np.zeros(0, np.int64)
        two = np.zeros(len(words), bool)
        many = np.flatnonzero(np.diff(woff) > 1)
        two[many] = wraw[woff[many] + 1] == 32
        odd = two | (chars > LONG)
        known = self.known
        if len(known["key"]) > KNOWN:
            known = self.known = fresh_words()
        key = Polynomial(wraw)(woff[:-1], woff[1:])
        j = np.minimum(np.searchsorted(known["key"], key), len(known["key"]) - 1)
        plain = np.flatnonzero(~odd & (known["key"][j] != key))
        keep = np.zeros(len(words), bool)
        keep[plain] = True
        praw, psize = wraw[np.repeat(keep, np.diff(woff))], np.diff(woff)[plain]
        pend = np.cumsum(psize)
        lo = 0
        while lo < len(plain):  # a bounded number of letters at once
            base = pend[lo] - psize[lo]
            hi = max(lo + 1, int(np.searchsorted(pend, base + LETTERS, "right")))
            got, start = self.words(praw[base : pend[hi - 1]], pend[lo:hi] - psize[lo:hi] - base, pend[lo:hi] - base)
            known = learnt(known, key[plain[lo:hi]], got, start)
            lo = hi
        self.known = known
        j = np.minimum(np.searchsorted(known["key"], key), len(known["key"]) - 1)
        begin_of, count = known["begin"][j], known["count"][j]
        extra, total = [known["ids"]], len(known["ids"])
        for w in np.flatnonzero(odd):
            got = self.odd_word(words[int(w)].as_py())
            begin_of[w], count[w] = total, len(got)
            total += len(got)
            extra.append(np.array(got, np.int32))
        flat = np.concatenate(extra) if len(extra) > 1 else extra[0]
        n = count[index]
        done = np.cumsum(n)
        pick = np.repeat(begin_of[index] - (done - n), n) + np.arange(int(done[-1]) if len(done) else 0)
        upto = np.concatenate([[0], done])
        return flat[pick].astype(np.int32), upto[np.searchsorted(begins, offsets)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Bytes of each row of ids, without the leading space."""
        size = np.array([len(x) for x in self.text] + [0], np.int64)
        start = np.cumsum(size) - size
        raw = np.frombuffer(b"".join(self.text), np.uint8)
        n = size[ids]
        done = np.cumsum(n)
        upto = np.concatenate([[0], done])
        pick = np.repeat(start[ids] - (done - n), n) + np.arange(int(done[-1]) if len(done) else 0)
        out = raw[pick]
        return [out[b + (e > b and out[b] == 32) : e].tobytes() for b, e in zip(upto[offsets[:-1]], upto[offsets[1:]], strict=True)]


def _encoder(shared):
    def run(batches):
        tables = Tables.over(shared.value)
        for batch in chunks(batches):
            ids, offsets = tables.encode(batch["text"])
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "ids"])

    return run


def _decoder(shared):
    def run(batches):
        tables = Tables.over(shared.value)
        for batch in batches:
            lists = pc.fill_null(batch["ids"], []) if batch["ids"].null_count else batch["ids"]
            offsets = lists.offsets.to_numpy().astype(np.int64)
            ids = pc.fill_null(lists.values, 0).to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
            text = [x.decode(errors="replace") for x in tables.decode(ids, offsets - offsets[0])]
            cols = [*batch.columns, pa.array(text, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names, "decoded"])

    return run


def _there_and_back(shared):
    """Encoder and decoder in one pass, so a task has one worker."""

    def run(batches):
        tables = Tables.over(shared.value)
        for batch in chunks(batches):
            ids, offsets = tables.encode(batch["text"])
            same = [a == b.encode() for a, b in zip(tables.decode(ids, offsets), batch["text"].to_pylist(), strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch["id"], lists, pa.array(np.diff(offsets), pa.int64()), pa.array(same)], names=["id", "ids", "n_tokens", "round_trip"])

    return run


def _tables(df: DataFrame, model: str):
    return df.sparkSession.sparkContext.broadcast(vars(Tables(model)))


def encode_pieces(df: DataFrame, id_col="doc_id", text_col="text", model=MODEL, tables=None) -> DataFrame:
    """Texts as ids of the model, the ids that the model's own merging gives, byte pieces for unknown characters.

    One row per input row: id, text, ids. A null or empty text has no ids. Repeated rows give repeated rows; other
    columns are not read. A narrow pass over whole texts; the tables, bounded by the vocabulary, are broadcast.
    """
    src = select_texts(df, id_col, text_col)
    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(_encoder(tables or _tables(df, model)), f"id {kind}, text string, ids array<int>")


def decode_pieces(df: DataFrame, model=MODEL, tables=None) -> DataFrame:
    """Adds `decoded`, the text of the column `ids`; null ids give an empty text, bytes that are no text are replaced."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(_decoder(tables or _tables(df, model)), f"{fields}, decoded string")


def round_trip(df: DataFrame, id_col="doc_id", text_col="text", model=MODEL) -> DataFrame:
    """Ids of every text and whether they decode to it. Only a text that holds the space sign U+2581 itself does not:
    the vocabulary cannot tell it from a space."""
    src = select_texts(df, id_col, text_col)
    kind = src.schema["id"].dataType.simpleString()
    out = src.mapInArrow(_there_and_back(_tables(df, model)), f"id {kind}, ids array<int>, n_tokens long, round_trip boolean")
    return out.withColumnRenamed("id", id_col)
