"""Anchored search for repeated windows of a fixed length in many texts.

A window is ``length`` consecutive tokens (words or bytes) of one text.  Its
anchor is the k-gram with the least hash in it (the leftmost of equal ones),
which hangs on the window's content alone: equal windows have equal anchors
at equal places.  So

1. every chunk tells each hash bucket its anchors, and the bucket answers
   which of them other chunks hold too; a window whose anchor is held once in
   all texts is unique, and is left at that.  An anchor with over
   ``MOST_STRETCHES`` different stretches (a common phrase, each time among
   other words) is hot: from here on each of its windows is a run of its own,
   and the hash of the whole window is its anchor, so that the windows spread
   over the buckets and equal ones still meet;
2. for the rest every chunk sends a hash of the stretch of text that the
   windows of one anchor cover, to the anchor's bucket.  If all stretches of an
   anchor are equal, all their windows are decided;
3. an anchor with different stretches is a fork: one holder of each different
   stretch is asked for its text, and the bucket decides window by window (the
   operator's structure works there);
4. the answers meet the texts again.

Equal stretches are sent once a chunk, and their text once in all.  No window
is dropped otherwise: the first step only sets aside windows that cannot
repeat.  Stretches are taken for equal when 64-bit hashes of their content are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import zstandard

from .chunks import INVERSE, Chunk, bucket_of, by_bucket, byte_values, from_six, mixed, powers, prefix_sums, range_hash, to_six, word_hashes, word_spans

#: Places hashed at once.
SPAN = 1 << 17
#: Different stretches of an anchor that one bucket takes, counted chunk by chunk.
MOST_STRETCHES = 4096


@dataclass
class Tokens:
    """Tokens of a chunk's texts: a 64-bit value each, and where texts begin."""

    values: np.ndarray
    first: np.ndarray  # first token of each text
    count: np.ndarray  # tokens of each text


def word_tokens(chunk: Chunk) -> tuple[Tokens, np.ndarray, np.ndarray]:
    start, end, text = word_spans(chunk)
    count = np.bincount(text, minlength=len(chunk.ids)).astype(np.int64)
    return Tokens(word_hashes(chunk.data, start, end), np.cumsum(count) - count, count), start, end


def byte_tokens(chunk: Chunk) -> Tokens:
    return Tokens(byte_values(chunk.data), chunk.starts, chunk.sizes)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive keys, by doubling."""
    size, out = 1, keys
    while 2 * size <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def grams(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive values, by doubling."""
    out, size = values, 1
    done, total = None, 0  # the gram of the bits of k below ``size``
    power = lambda n: powers(n + 1)[-1]
    while True:
        if k & size:
            done = out if done is None else done[: len(values) - total - size + 1] + out[total : len(values) - size + 1] * power(total)
            total += size
        if 2 * size > k:
            return mixed(done)
        out = out[:-size] + out[size:] * power(size)
        size *= 2


@dataclass
class Runs:
    """Runs of windows with one anchor: first window, number, and anchor hash."""

    first: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    text: np.ndarray


def anchor_runs(tokens: Tokens, length: int, k: int) -> Runs:
    width = length - k + 1
    n = len(tokens.values)
    valid = np.zeros(n + 1, dtype=np.int8)
    has = tokens.count >= length
    np.add.at(valid, tokens.first[has], 1)
    np.add.at(valid, tokens.first[has] + tokens.count[has] - length + 1, -1)
    valid = np.cumsum(valid[:-1], dtype=np.int8).astype(bool)
    owners = np.full(n, -1, dtype=np.int64)
    hashes = np.zeros(n, dtype=np.uint64)
    for lo in range(0, n, SPAN):
        hi = min(n, lo + SPAN)
        piece = tokens.values[lo : min(n, hi + length - 1)]
        if len(piece) < length:
            break
        h = grams(piece, k)
        hashes[lo : lo + len(h)] = h
        # the upper half of the hash orders, the lower half of the key is the place
        keys = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
        owner = (_least(keys, width) & np.uint64(0xFFFFFFFF)).astype(np.int64) + lo
        owners[lo : lo + len(owner)] = owner
    owners[~valid] = -1
    change = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]]) if n else np.zeros(0, dtype=np.int64)
    end = np.r_[change[1:], n] if n else change
    held = owners[change] >= 0 if n else np.zeros(0, dtype=bool)
    first, count = change[held], (end - change)[held]
    text = np.searchsorted(tokens.first + tokens.count, first, side="right")
    return Runs(first, count, hashes[owners[first]], text)


# --------------------------------------------------- step 1: shared anchors


def stretch_hashes(tokens: Tokens, first: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    return range_hash(prefix_sums(tokens.values), first, first + np.asarray(size), powers(len(tokens.values) + 1, INVERSE))


def tell_anchors(tokens: Tokens, runs: Runs, length: int, buckets: int):
    """Each anchor of the chunk, and how many different stretches it has here."""
    unique, inverse, counts = np.unique(runs.anchor, return_inverse=True, return_counts=True)
    several = np.flatnonzero(counts[inverse] > 1)
    if len(several):
        content = stretch_hashes(tokens, runs.first[several], runs.count[several] + length - 1)
        order = np.lexsort((content, inverse[several]))
        anchor, content = inverse[several][order], content[order]
        fresh = np.r_[True, (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])]
        counts = np.maximum(1, np.bincount(anchor[fresh], minlength=len(unique)))
    counts = np.minimum(counts, 0xFFFF).astype("<u2")
    squeeze = zstandard.ZstdCompressor(level=1)
    for b, rows in by_bucket(bucket_of(unique, buckets), buckets):
        yield b, len(rows).to_bytes(8, "little") + to_six(unique[rows]) + squeeze.compress(counts[rows].tobytes())


def shared_anchors(told: list[tuple[int, bytes]], most: int = MOST_STRETCHES):
    """For each chunk a bit per anchor: another chunk holds it too; behind
    them, if any is set, a bit per anchor: it is hot."""
    expand = zstandard.ZstdDecompressor()
    lists, numbers = [], []
    for _, p in told:
        n = int.from_bytes(p[:8], "little")
        lists.append(from_six(p[8 : 8 + 6 * n]))
        numbers.append(np.frombuffer(expand.decompress(p[8 + 6 * n :]), dtype="<u2"))
    every = np.concatenate(lists)
    values, inverse, counts = np.unique(every, return_inverse=True, return_counts=True)
    bits = counts[inverse] > 1
    hot = (np.bincount(inverse, weights=np.concatenate(numbers)) > most)[inverse]
    at = 0
    for (c, _), a in zip(told, lists):
        here = slice(at, at + len(a))
        yield c, np.packbits(bits[here]).tobytes() + (np.packbits(hot[here]).tobytes() if hot[here].any() else b"")
        at += len(a)


def candidates(tokens: Tokens, runs: Runs, length: int, buckets: int, replies: dict[int, bytes], across_texts: bool) -> tuple[Runs, np.ndarray]:
    """The runs, those of hot anchors cut in single windows, and the indices of
    those that may repeat: the anchor is hot or held elsewhere
    (``across_texts``: in another text)."""
    unique, inverse, counts = np.unique(runs.anchor, return_inverse=True, return_counts=True)
    shared, hot = np.zeros(len(unique), dtype=bool), np.zeros(len(unique), dtype=bool)
    for b, rows in by_bucket(bucket_of(unique, buckets), buckets):
        if b in replies:
            bits, size = np.frombuffer(replies[b], dtype=np.uint8), -(-len(rows) // 8)
            shared[rows] = np.unpackbits(bits[:size], count=len(rows)).astype(bool)
            if len(bits) > size:
                hot[rows] = np.unpackbits(bits[size:], count=len(rows)).astype(bool)
    if across_texts:
        low = np.full(len(unique), np.iinfo(np.int64).max)
        high = np.full(len(unique), -1)
        np.minimum.at(low, inverse, runs.text)
        np.maximum.at(high, inverse, runs.text)
        shared |= low != high
    else:
        shared |= counts > 1
    if not hot.any():
        return runs, np.flatnonzero(shared[inverse])
    cut, rest = np.flatnonzero(hot[inverse]), np.flatnonzero((shared & ~hot)[inverse])
    first = ranges(runs.first[cut], runs.count[cut])
    single = Runs(first, np.ones(len(first), dtype=np.int64), stretch_hashes(tokens, first, length), np.repeat(runs.text[cut], runs.count[cut]))
    both = Runs(*(np.concatenate([getattr(runs, f)[rest], getattr(single, f)]) for f in ("first", "count", "anchor", "text")))
    return both, np.arange(len(both.first))


# ------------------------------------------------- steps 2 to 4: stretches


@dataclass(frozen=True)
class Rule:
    """What an operator asks about windows.

    Every stretch has a number at its sender; ``combine(class, numbers, n)``
    joins the numbers of equal stretches, ``repeated(joined, number)`` tells
    whether a stretch's window with that joined number goes, and
    ``window_values(forks)`` gives the joined number of every window.
    """

    length: int
    width: int  # bytes of a token
    combine: Callable
    repeated: Callable
    window_values: Callable


@dataclass
class Forks:
    """Different stretches of forked anchors: windows, joined number and
    tokens (one stretch after the other) of each."""

    windows: np.ndarray
    value: np.ndarray
    tokens: np.ndarray
    starts: np.ndarray


@dataclass
class Stretches:
    """A chunk's runs that may repeat, and its different stretches."""

    chosen: np.ndarray  # runs
    of: np.ndarray  # the class of each chosen run
    rep: np.ndarray  # one run of each class
    content: np.ndarray  # hash of each class's anchor and tokens


def stretches(tokens: Tokens, runs: Runs, chosen: np.ndarray, length: int) -> Stretches:
    if not len(chosen):
        return Stretches(chosen, chosen, chosen, np.zeros(0, dtype=np.uint64))
    content = stretch_hashes(tokens, runs.first[chosen], runs.count[chosen] + length - 1) ^ mixed(runs.anchor[chosen])
    keys, rep, of = np.unique(content, return_index=True, return_inverse=True)
    return Stretches(chosen, of, chosen[rep], keys)


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (size[0] of them), first[1], ..."""
    total = np.cumsum(size)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - size, size) + np.repeat(first, size)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, by column."""
    n = len(arrays[0])
    return zstandard.ZstdCompressor(level=1).compress(n.to_bytes(8, "little") + b"".join(a.tobytes() for a in arrays))


def _unpack(payload: bytes, *kinds) -> tuple[list[np.ndarray], bytes]:
    """The arrays of ``_pack``, and what stands behind them."""
    data = zstandard.ZstdDecompressor().decompress(payload)
    n, at, out = int.from_bytes(data[:8], "little"), 8, []
    for kind in map(np.dtype, kinds):
        out.append(np.frombuffer(data, dtype=kind, count=n, offset=at))
        at += n * kind.itemsize
    return out, data[at:]


def send_keys(runs: Runs, found: Stretches, number: np.ndarray, buckets: int):
    """Step 2: anchor, content and number of each different stretch."""
    anchor = runs.anchor[found.rep]
    for b, rows in by_bucket(bucket_of(anchor, buckets), buckets):
        yield b, _pack(anchor[rows], found.content[rows], number[rows].astype(np.int64))


NONE, ALL, FORK, ASKED = range(4)


def answer_keys(told, rule: Rule):
    """For each stretch: no window goes, all do, or its anchor forks; of a
    fork's equal stretches the first is asked for its tokens."""
    parts = [_unpack(p, np.uint64, np.uint64, np.int64)[0] for _, p in told]
    anchor, content, number = (np.concatenate([p[k] for p in parts]) for k in range(3))
    _, first, of = np.unique(content, return_index=True, return_inverse=True)
    value = rule.combine(of, number, len(first))
    _, group, classes = np.unique(anchor[first], return_inverse=True, return_counts=True)
    fork = classes[group] > 1
    state = np.where(fork[of], FORK, np.where(rule.repeated(value[of], number), ALL, NONE)).astype(np.uint8)
    state[first[fork]] = ASKED
    cuts = np.cumsum([len(p[0]) for p in parts])
    for (c, _), s in zip(told, np.split(state, cuts[:-1])):
        yield c, _pack(s)


def read_states(runs: Runs, found: Stretches, buckets: int, replies: dict[int, bytes]) -> np.ndarray:
    out = np.zeros(len(found.rep), dtype=np.uint8)
    for b, rows in by_bucket(bucket_of(runs.anchor[found.rep], buckets), buckets):
        out[rows] = _unpack(replies[b], np.uint8)[0][0]
    return out


def send_forks(runs: Runs, found: Stretches, number: np.ndarray, state: np.ndarray, raw: np.ndarray, rule: Rule, buckets: int):
    """Step 3: content, number and windows of forked stretches, and the tokens
    of those asked for; ``raw`` is the token table, ``width`` bytes a token."""
    squeeze = zstandard.ZstdCompressor(level=1)
    forked = np.flatnonzero(state >= FORK)
    for b, at in by_bucket(bucket_of(runs.anchor[found.rep[forked]], buckets), buckets):
        rows = forked[at]
        windows = runs.count[found.rep[rows]]
        asked = state[rows] == ASKED
        body = raw[ranges(runs.first[found.rep[rows[asked]]], windows[asked] + rule.length - 1)].tobytes()
        head = len(rows).to_bytes(8, "little") + b"".join(a.tobytes() for a in (found.content[rows], number[rows].astype(np.int64), windows.astype(np.uint8), asked.astype(np.uint8)))
        yield b, squeeze.compress(head + body)


def answer_forks(told, rule: Rule):
    """For each forked stretch a bit per window that goes."""
    parts, bodies = [], []
    for _, p in told:
        arrays, body = _unpack(p, np.uint64, np.int64, np.uint8, np.uint8)
        parts.append(arrays)
        bodies.append(body)
    content, number, windows, asked = (np.concatenate([p[k] for p in parts]) for k in range(4))
    windows = windows.astype(np.int64)
    _, of = np.unique(content, return_inverse=True)
    n = int(of.max(initial=-1)) + 1
    body = b"".join(bodies)
    tokens = np.frombuffer(body, dtype=np.uint8) if rule.width == 1 else from_six(body)
    # asked stretches come in the order of their tokens; put them in the order of the classes
    sent = np.flatnonzero(asked)
    sizes = windows[sent] + rule.length - 1
    order = np.argsort(of[sent], kind="stable")
    sent, starts = sent[order], (np.cumsum(sizes) - sizes)[order]
    forks = Forks(windows[sent], rule.combine(of, number, n), tokens, starts)
    value = rule.window_values(forks)
    at = (np.cumsum(forks.windows) - forks.windows)[of]
    flags = rule.repeated(value[ranges(at, windows)], np.repeat(number, windows))
    bits = window_bits(flags, windows)
    cuts = np.cumsum([len(p[0]) for p in parts])
    for (c, _), x in zip(told, np.split(bits, cuts[:-1])):
        yield c, _pack(x)


def window_bits(flags: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """A word per stretch: bit w is the flag of its w-th window."""
    out = np.zeros(len(windows), dtype=np.uint64)
    owner = np.repeat(np.arange(len(windows)), windows)
    place = ranges(np.zeros(len(windows), dtype=np.int64), windows).astype(np.uint64)
    some = np.flatnonzero(flags)
    np.bitwise_or.at(out, owner[some], np.uint64(1) << place[some])
    return out


def decided_windows(runs: Runs, found: Stretches, state: np.ndarray, buckets: int, replies: dict[int, bytes]) -> np.ndarray:
    """For each window of each chosen run whether it goes."""
    bits = np.where(state == ALL, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
    forked = np.flatnonzero(state >= FORK)
    for b, at in by_bucket(bucket_of(runs.anchor[found.rep[forked]], buckets), buckets):
        bits[forked[at]] = _unpack(replies[b], np.uint64)[0][0]
    width = runs.count[found.chosen]
    place = ranges(np.zeros(len(width), dtype=np.int64), width).astype(np.uint64)
    return (np.repeat(bits[found.of], width) >> place) & np.uint64(1) == 1


def covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of n tokens lie in a window that starts at one of ``starts``."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + length, n), -1)
    return np.cumsum(edge[:-1]) > 0
