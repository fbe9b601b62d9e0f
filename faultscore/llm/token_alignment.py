"""Operator 11: alignment of the tokens of two tokenizers.

A is a byte-level BPE (``tokenizers``), B a BPE of pieces with byte fallback
(``sentencepiece``); A encodes blank+text, B adds the blank itself.  The spans
that both libraries report are the coarse cuts; where a span does not have the
length of its token's decoded bytes (parts of a multibyte character, byte
pieces) the decoded bytes refine it.  Places where tokens of both end cut the
tokens into groups, and all A and B tokens of a group are linked.

A text is cut where neither tokenizer's tokens can reach across (a single blank
or a line end behind a visible character, punctuation behind a letter); each different stretch is encoded
and aligned once and kept in a bounded table of the Python worker, and a document
adds up its stretches.  So only different stretches are encoded.

Counting over the corpus: a task numbers the id pairs of a block of documents
(at most ``BLOCK_DOCUMENTS``, or the one that goes beyond ``BLOCK_PAIRS``
pairs), so a pair goes through the shuffle once a block and not once a
document, which is also what spreads a pair that every document has.  Counts
are a groupBy over the blocks' pairs, each A id's highest a window over the B
ids it meets (no more than B's vocabulary), and a cogroup by block brings both
back to the block's documents.

Only the two tokenizer files are broadcast.

Defined results: texts that are null, empty, or whose joined token bytes differ
from blank+text have no tokens (zeros, empty digest) and count for no pair;
every row is a document of its own, also rows of one doc_id or of none; the
strings of special tokens are plain text; ties for the highest count are all
best; a very long text is worked through in slices of ``SLICE`` stretches (a
stretch without a cut is encoded whole); extra columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, written

TOKENIZERS = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
BLOCK_DOCUMENTS = 4096
BLOCK_PAIRS = 1 << 18
SLICE = 1 << 16
#: Stretches that are encoded as one text.
TOGETHER = 4096
#: Stretches a Python worker keeps aligned, from task to task.
KEPT_STRETCHES = 600_000
CUT = re.compile(r"(?<=[!-~\w])(?:(?= [!-~\w])|(?=\n))|(?<=[a-z])(?=[.,;:!?|])")
#: What no piece may hold if stretches are to be cut so.
REACHES = re.compile(r"[^▁]▁|\n|[a-z][.,;:!?|]")
#: A stretch that ends so can stand before any other.
JOINED = re.compile(r"[!-~\w]")
#: Pairs of a group beyond which its ids are counted first.
MOST_PAIRS = 4096
STATS = ("n_a", "n_b", "n_groups", "n_links")


def byte_level_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary:
    visible Latin-1 characters for themselves, the others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers from the bytes of their files, with each id's bytes."""

    def __init__(self, byte_bpe: bytes, piece_bpe: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_bpe.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_bpe)
        alphabet = byte_level_alphabet()
        self.a_bytes = {i: bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode() for token, i in self.a.get_vocab().items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes = np.array([len(self.a_bytes.get(i, b"")) for i in range(max(self.a_bytes) + 1)])
        self.b_sizes = np.array([len(p) for p in self.b_bytes])
        # stretches can be cut out only where no piece reaches over the cut
        self.cuts = not any(REACHES.search(p) for i, p in enumerate(pieces) if not self.b.is_byte(i) and not self.b.is_control(i) and not self.b.is_unknown(i))

    def stretches(self, text: str) -> list[str]:
        return CUT.split(" " + text) if self.cuts else [" " + text]

    def align(self, stretches: list[str]) -> Aligned:
        """All stretches as one text, for no token reaches over a cut; where the
        token bytes or ends say otherwise, each half anew and at last each alone."""
        text = " a" + "".join(stretches)
        raw = text.encode()
        encoding, proto = self.a.encode(text, add_special_tokens=False), self.b.encode(text[1:], return_type="proto")
        a, places = np.array(encoding.ids), table(encoding.offsets, 2)
        if len(raw) != len(text):
            code = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
            places = np.r_[0, np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))][places]
        pieces = table([(p.id, p.begin, p.end) for p in proto.pieces], 3)
        b, spans = pieces[:, 0], pieces[:, 1:] + 1
        spans[0, 0] = 0  # the added blank is the text's own
        bounds = np.cumsum([2, *(len(x.encode()) for x in stretches)])
        a_ends, b_ends = token_ends(places, self.a_sizes[a]), token_ends(spans, self.b_sizes[b])
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) == raw == b"".join(map(self.b_bytes.__getitem__, b.tolist())):
            cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
            if np.isin(bounds, cuts).all():
                return aligned_groups(a, a_ends, b, b_ends, cuts, bounds).without_first()
        if len(stretches) == 1:
            return self.align_alone(stretches[0])
        half = len(stretches) // 2
        return self.align(stretches[:half]).joined(self.align(stretches[half:]))

    def align_alone(self, stretch: str) -> Aligned:
        """One stretch by itself; the blank that B adds is its own, or none of it."""
        raw, blank, line = stretch.encode(), stretch.startswith(" "), stretch.startswith("\n")
        before = "" if blank or line else "a"  # punctuation stands behind a letter
        a = np.array(self.a.encode(before + stretch, add_special_tokens=False).ids)[len(before) :]
        b = np.array(self.b.encode(stretch[1:] if blank else before + stretch), dtype=np.int64)
        if not blank and len(b) and self.b_bytes[b[0]] == f" {before}".encode():
            b = b[1:]
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) == raw == b"".join(map(self.b_bytes.__getitem__, b.tolist())):
            a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
            return aligned_groups(a, a_ends, b, b_ends, np.intersect1d(a_ends, b_ends, assume_unique=True), np.array([len(raw)]))
        none = np.empty(0, dtype=np.int64)
        return Aligned([None], np.zeros((1, 4), dtype=np.int64), np.zeros(1, dtype=np.int64), none, none)


def table(rows: list[tuple[int, ...]], width: int) -> np.ndarray:
    return np.fromiter(chain.from_iterable(rows), dtype=np.int64, count=width * len(rows)).reshape(-1, width)


@dataclass
class Aligned:
    """Per stretch its groups as text (None: it has no tokens), statistics and
    number of links; the links of all, in order, as id pairs and how often."""

    groups: list[str | None]
    stats: np.ndarray
    sizes: np.ndarray
    keys: np.ndarray
    times: np.ndarray

    def joined(self, other: Aligned) -> Aligned:
        return Aligned(self.groups + other.groups, *(np.concatenate([getattr(self, f), getattr(other, f)]) for f in ("stats", "sizes", "keys", "times")))

    def without_first(self) -> Aligned:
        n = self.sizes[0]
        return Aligned(self.groups[1:], self.stats[1:], self.sizes[1:], self.keys[n:], self.times[n:])


def token_ends(spans: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """End of each token in bytes: its span's, unless the span is not where the
    last token ended or not as long as the token's bytes, which count then."""
    refined = np.cumsum(sizes)
    return np.where((spans[:, 0] == refined - sizes) & (spans[:, 1] - spans[:, 0] == sizes), spans[:, 1], refined)


def aligned_groups(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray, cuts: np.ndarray, bounds: np.ndarray) -> Aligned:
    """Tokens cut into groups at ``cuts``, and groups into stretches at ``bounds``."""
    n_a, n_b = (np.bincount(np.searchsorted(cuts, ends), minlength=len(cuts)) for ends in (a_ends, b_ends))
    lo_a, lo_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    a_text, b_text = list(map(str, a.tolist())), list(map(str, b.tolist()))
    texts = [
        f"{a_text[i]}|{b_text[j]}" if m == n == 1 else f"{','.join(a_text[i : i + m])}|{','.join(b_text[j : j + n])}"
        for i, m, j, n in zip(lo_a.tolist(), n_a.tolist(), lo_b.tolist(), n_b.tolist())
    ]
    stretch = np.searchsorted(bounds, cuts)
    count = np.bincount(stretch, minlength=len(bounds))
    upto = np.cumsum(count).tolist()
    products = n_a * n_b
    pairs = np.where(products > MOST_PAIRS, 0, products)
    group = np.repeat(np.arange(len(cuts)), pairs)
    k = np.arange(len(group)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
    keys = a[lo_a[group] + k // n_b[group]] << 32 | b[lo_b[group] + k % n_b[group]]
    times, of = np.ones(len(keys), dtype=np.int64), stretch[group]
    for g in np.flatnonzero(products > MOST_PAIRS):  # as different ids with their numbers
        x, m = np.unique(a[lo_a[g] : lo_a[g] + n_a[g]], return_counts=True)
        y, n = np.unique(b[lo_b[g] : lo_b[g] + n_b[g]], return_counts=True)
        keys = np.r_[keys, (x[:, None] << 32 | y[None, :]).ravel()]
        times = np.r_[times, (m[:, None] * n[None, :]).ravel()]
        of = np.r_[of, np.full(len(x) * len(y), stretch[g])]
    order = np.argsort(of, kind="stable")
    stats = np.zeros((len(bounds), 4), dtype=np.int64)
    for i, x in enumerate((n_a, n_b, np.ones_like(n_a), products)):
        np.add.at(stats[:, i], stretch, x)
    return Aligned([";".join(texts[u - c : u]) for u, c in zip(upto, count.tolist())], stats, np.bincount(of, minlength=len(bounds)), keys[order], times[order])


def distinct_sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, ascending, and the sum of each one's values."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, dtype=np.int64)
    return keys[starts], np.add.reduceat(values, starts) if len(keys) else values


class Stretches:
    """Aligned stretches by number; forgotten all at once when there are too many."""

    def __init__(self, tokenizers: Tokenizers, most: int):
        self.tokenizers, self.most = tokenizers, most
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str | None] = []
        self.stats = np.zeros((1024, 4), dtype=np.int64)
        self.starts = np.zeros(1024, dtype=np.int64)
        self.sizes = np.zeros(1024, dtype=np.int64)
        self.keys, self.times = np.zeros(4096, dtype=np.int64), np.zeros(4096, dtype=np.int64)
        self.used = 0

    def documents(self, texts):
        """What ``document`` finds of each text; the new stretches of several
        texts are aligned together."""
        held, size = [], 0
        for text in texts:
            held.append(self.tokenizers.stretches(text) if text else [])
            size += len(held[-1])
            if size >= SLICE:
                yield from self.found(held)
                held, size = [], 0
        yield from self.found(held)

    def found(self, texts: list[list[str]]):
        if len(texts) > 1:
            self.learn(set().union(*texts))
        for t in texts:
            yield self.document(t)

    def learn(self, stretches: set[str]) -> None:
        new = list(stretches.difference(self.number))
        if len(self.number) + len(new) > self.most and self.number:
            self.forget()
            return  # each document's own are aligned with it
        self.add(new)

    def numbers(self, stretches: list[str]) -> np.ndarray:
        get = self.number.get
        found = [get(s, -1) for s in stretches]
        if -1 in found:
            if len(self.number) > self.most:
                self.forget()
            self.add([s for s in dict.fromkeys(stretches) if s not in self.number])
            found = [self.number[s] for s in stretches]
        return np.array(found, dtype=np.int64)

    def add(self, new: list[str]) -> None:
        plain = [x for x in new if x[0] in " \n" and JOINED.match(x[-1])]
        parts = [(plain[lo : lo + TOGETHER], self.tokenizers.align) for lo in range(0, len(plain), TOGETHER)]
        parts += [([x], lambda y: self.tokenizers.align_alone(y[0])) for x in set(new).difference(plain)]
        for part, align in parts:
            got = align(part)
            n, m, links = len(self.groups), len(part), len(got.keys)
            while n + m > len(self.starts):
                self.stats, self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.stats, self.starts, self.sizes))
            while self.used + links > len(self.keys):
                self.keys, self.times = (np.concatenate([x, np.zeros_like(x)]) for x in (self.keys, self.times))
            self.number.update(zip(part, range(n, n + m)))
            self.groups += got.groups
            self.stats[n : n + m], self.sizes[n : n + m] = got.stats, got.sizes
            self.starts[n : n + m] = self.used + np.cumsum(got.sizes) - got.sizes
            self.keys[self.used : self.used + links], self.times[self.used : self.used + links] = got.keys, got.times
            self.used += links

    def document(self, stretches: list[str]):
        """(statistics, digest, id pairs, link counts), or None for no tokens."""
        if not stretches:
            return None
        digest, stats, parts = hashlib.sha256(), np.zeros(4, dtype=np.int64), []
        for lo in range(0, len(stretches), SLICE):
            numbers = self.numbers(stretches[lo : lo + SLICE])
            groups = [self.groups[i] for i in numbers]
            if None in groups:
                return None
            digest.update(((";" if lo else "") + ";".join(groups)).encode())
            stats += self.stats[numbers].sum(axis=0)
            different, often = np.unique(numbers, return_counts=True)
            sizes = self.sizes[different]
            at = np.repeat(self.starts[different] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            parts.append(distinct_sums(self.keys[at], self.times[at] * np.repeat(often, sizes)))
        keys, times = parts[0] if len(parts) == 1 else distinct_sums(*(np.concatenate(x) for x in zip(*parts)))
        return stats, digest.hexdigest(), keys, times


ALIGNED = "block long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, at array<int>, times array<long>, pairs array<long>, documents array<long>"


def block_rows(block: int, ids: list, found: list) -> pa.RecordBatch:
    """A row per document (its pairs by number), and one with the block's pairs."""
    got = [f for f in found if f]
    pairs, at = np.unique(np.concatenate([f[2] for f in got]) if got else np.empty(0, dtype=np.int64), return_inverse=True)
    places, lo = [], 0
    for f in found:
        size = len(f[2]) if f else 0
        places.append(at[lo : lo + size].astype(np.int32))
        lo += size
    n = len(found)
    columns = [pa.array([block] * (n + 1), pa.int64())]
    columns += [pa.array([int(f[0][k]) if f else 0 for f in found] + [None], pa.int64()) for k in range(4)]
    columns.append(pa.array([f[1] if f else "" for f in found] + [None], pa.string()))
    columns.append(pa.array([*places, None], pa.list_(pa.int32())))
    columns.append(pa.array([*(f[3] if f else np.empty(0, dtype=np.int64) for f in found), None], pa.list_(pa.int64())))
    columns.append(pa.array([None] * n + [pairs], pa.list_(pa.int64())))
    columns.append(pa.array([None] * n + [np.bincount(at, minlength=len(pairs)).astype(np.int64)], pa.list_(pa.int64())))
    names = [f.split()[0] for f in ALIGNED.split(", ")]
    ids = pa.concat_arrays([*ids, pa.nulls(1, ids[0].type)])
    return pa.RecordBatch.from_arrays([*columns, ids], names=[*names, "doc_id"])


#: Of this Python worker, which serves one task after another.
_KEPT: dict[tuple[str, int], Stretches] = {}


def kept_stretches(files: tuple[bytes, bytes], most: int) -> Stretches:
    key = (hashlib.sha256(b"".join(files)).hexdigest(), most)
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = Stretches(Tokenizers(*files), most)
    return _KEPT[key]


def aligned(docs: DataFrame, byte_bpe: str, piece_bpe: str, most: int) -> DataFrame:
    with open(byte_bpe, "rb") as one, open(piece_bpe, "rb") as other:
        files = docs.sparkSession.sparkContext.broadcast((one.read(), other.read()))

    def run(batches):
        kept, made = kept_stretches(files.value, most), 0
        for batch in batches:
            lo, found, pairs = 0, [], 0
            for i, document in enumerate(kept.documents(t.as_py() for t in batch.column(1))):
                found.append(document)
                pairs += len(found[-1][2]) if found[-1] else 0
                if len(found) == BLOCK_DOCUMENTS or pairs >= BLOCK_PAIRS or i + 1 == batch.num_rows:
                    yield block_rows(TaskContext.get().partitionId() << 32 | made, [batch.column(0).slice(lo, len(found))], found)
                    lo, found, pairs, made = i + 1, [], 0, made + 1

    return written(docs.mapInArrow(run, f"{ALIGNED}, doc_id {dict(docs.dtypes)['doc_id']}"), "aligned")


def align(docs: DataFrame, byte_bpe: str = f"{TOKENIZERS}/{BYTE_BPE}", piece_bpe: str = f"{TOKENIZERS}/{PIECE_BPE}", most: int = KEPT_STRETCHES) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum and groups_sha256."""
    rows = aligned(pick(docs, doc_id="doc_id", text="text"), byte_bpe, piece_bpe, most)
    asked = rows.where("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "documents")).alias("at", "p"))
    asked = asked.select("block", "at", F.col("p.pairs").alias("pair"), F.col("p.documents").alias("documents"))
    totals = asked.groupBy("pair").agg(F.sum("documents").alias("held"))
    highest = F.max("held").over(Window.partitionBy(F.shiftright("pair", 32)))
    totals = totals.withColumn("best", F.col("held") == highest)
    answers = asked.select("block", "at", "pair").join(totals, "pair").select("block", "at", "held", "best")
    documents = rows.where("pairs IS NULL").select(F.col("block").alias("own"), "doc_id", *STATS, "groups_sha256", "at", "times")

    def back(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        n = theirs.num_rows
        at = theirs.column("at").to_numpy()
        held, best = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        held[at], best[at] = theirs.column("held").to_numpy(), theirs.column("best").to_numpy()
        places, times = ours.column("at").combine_chunks(), ours.column("times").combine_chunks()
        size = places.value_lengths().to_numpy()
        ends = np.cumsum(size)
        place, time = places.flatten().to_numpy(), times.flatten().to_numpy()
        sums = []
        for value in (best, held):
            upto = np.r_[0, np.cumsum(time * value[place])]
            sums.append(pa.array(upto[ends] - upto[ends - size]))
        return pa.table([ours.column(c) for c in ("doc_id", *STATS)] + sums + [ours.column("groups_sha256")], names=["doc_id", *STATS, "n_best", "count_sum", "groups_sha256"])

    out = f"doc_id {dict(rows.dtypes)['doc_id']}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return documents.groupBy("own").cogroup(answers.groupBy("block")).applyInArrow(back, out)


def q_align(spark, sf_dir):
    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"))
