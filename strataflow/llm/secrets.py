"""Secret scans: stated patterns, and random strings exposed by few characters per token."""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import chunks, select_texts

# The stated patterns, with the least length of what must be long.
ASSIGN = r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Shortest string that is put to the token test, and the characters per token below which it counts as random.
LEAST, RATIO = 20, 1.9
CANDIDATE = r"[A-Za-z0-9+/_=-]{%d,}"
#: Hexadecimal digests of usual lengths and UUIDs; with numbers, dates and one repeated sign they are known strings.
DIGEST = (
    r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128}"
    r"|[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12})"
)
KNOWN = DIGEST + r"|[0-9_/=+-]+|(.)\1+"
#: Letters joined by signs: words if the letters alone have enough characters per token.
LETTERS = r"[A-Za-z]+(?:[_/=-]+[A-Za-z]+)*[_/=-]*"
#: Parts of a run: between the signs of paths and assignments, then between all signs.
PARTS = (r"[^/=]+", r"[A-Za-z0-9]+")


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class Finder:
    def __init__(self, vocabulary: bytes, least: int = LEAST, ratio: float = RATIO):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
        self.encoding = tiktoken.Encoding("secrets", pat_str=r"[\s\S]{1,256}", mergeable_ranks=ranks, special_tokens={})
        self.assign, self.access = re.compile(ASSIGN), re.compile(ACCESS)
        self.hex = re.compile(r"[0-9a-f]{16,}")  # the maximal runs that are long enough
        self.candidate, self.known, self.letters = re.compile(CANDIDATE % least), re.compile(KNOWN), re.compile(LETTERS)
        self.digest = re.compile(rf"(?<![A-Za-z0-9]){DIGEST}(?![A-Za-z0-9])")
        self.parts = [re.compile(p) for p in PARTS]
        self.least, self.ratio = least, ratio

    def base(self, text: str) -> list[tuple[str, int, int]]:
        out = []
        if ":" in text or "=" in text:
            out += [("assign", m.start(), m.end()) for m in self.assign.finditer(text) if m.end(2) - m.start(2) >= 12]
        if "AKIA" in text:
            out += [("access", m.start(), m.end()) for m in self.access.finditer(text) if m.end() - m.start() >= 18]
        out += [("hex", m.start(), m.end()) for m in self.hex.finditer(text)]
        return out

    def dense(self, *parts: str) -> bool:
        """Whether the parts need one token for fewer than `ratio` characters."""
        return sum(map(len, parts)) < self.ratio * sum(len(self.encoding.encode_ordinary(p)) for p in parts)

    def key(self, part: str) -> bool:
        if len(part) < self.least or self.known.fullmatch(part) or not self.dense(part):
            return False
        return not self.letters.fullmatch(part) or self.dense(*self.parts[1].findall(part))

    def stretches(self, run: str, lo: int, hi: int, parts: re.Pattern):
        """Maximal stretches of neighbouring parts that do not look like words."""
        begin = end = lo
        for m in parts.finditer(run, lo, hi):
            if not self.dense(m[0]):
                yield begin, end
                begin = end = m.end()
            else:
                begin, end = m.start() if begin == end else begin, m.end()
        yield begin, end

    def keys(self, run: str) -> list[tuple[int, int]]:
        """The whole run if it is a key; else what is one between its words, so that a path or a name before or behind
        a key does not hide it. Digests and UUIDs within a run are no part of a key."""
        if self.known.fullmatch(run):
            return []
        if self.key(run):
            return [(0, len(run))]
        out = []
        cuts = [0, *(x for m in self.digest.finditer(run) for x in m.span()), len(run)]
        for lo, hi in zip(cuts[::2], cuts[1::2], strict=True):
            at = len(out)
            for parts in self.parts:
                more = [(b, e) for b, e in self.stretches(run, lo, hi, parts) if self.key(run[b:e])]
                out += [s for s in more if all(s[1] <= b or e <= s[0] for b, e in out[at:])]
        return sorted(out)

    def random(self, text: str) -> list[tuple[str, int, int]]:
        return [("random", m.start() + b, m.start() + e) for m in self.candidate.finditer(text) for b, e in self.keys(m[0])]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]))))


def _scan(shared, least, ratio):
    def run(batches):
        finder = Finder(shared.value, least, ratio)
        for batch in chunks(batches):
            rows = {k: [] for k in ("n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans", "found")}
            for text in batch["text"].to_pylist():
                base = finder.base(text)
                more = finder.random(text)
                for kind in KINDS[:3]:
                    rows[f"n_{kind}"].append(sum(k == kind for k, _, _ in base))
                rows["n_random"].append(len(more))
                rows["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                rows["spans"].append(joined(base + more))
                rows["found"].append([text[s:e] for _, s, e in sorted(base + more, key=lambda x: (x[1], KINDS.index(x[0])))])
            kinds = {"base_sha256": pa.string(), "spans": pa.string(), "found": pa.list_(pa.string())}
            cols = [batch["id"], *[pa.array(v, kinds.get(k, pa.int64())) for k, v in rows.items()]]
            yield pa.RecordBatch.from_arrays(cols, names=["id", *rows])

    return run


def secrets(df: DataFrame, id_col="doc_id", text_col="text", vocabulary=VOCABULARY, least=LEAST, ratio=RATIO) -> DataFrame:
    """Secrets of every text: assignments, access keys, long hexadecimal runs, and random strings.

    The first three are the leftmost non-overlapping matches of the stated patterns, kept if long enough. `random` are
    strings of `least` or more key characters that need one token of the given vocabulary for fewer than `ratio`
    characters: a maximal run, or else a stretch of its parts between words of the run. Digests of usual lengths, UUIDs
    and numbers are left out of it, and letters joined by signs whose parts look like words by the same ratio. One row
    per input row: id, counts, base_sha256, spans (code points, by start), found (the texts). A null text is empty and
    gives no spans.
    Repeated rows give repeated rows. Other columns are not read. A narrow pass: no shuffle; the vocabulary (under
    1 MB, fixed) is read by the driver and broadcast.
    """
    src = select_texts(df, id_col, text_col)
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    kind = src.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string, found array<string>"
    return src.mapInArrow(_scan(shared, least, ratio), schema).withColumnRenamed("id", id_col)
