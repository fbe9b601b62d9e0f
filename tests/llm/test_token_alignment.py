"""Operator 11 against whole-text encoding and decoded bytes alone."""

import bisect
import hashlib
from collections import Counter

import pytest
from helpers import SF001, documents

from faultscore.llm import token_alignment as ta


@pytest.fixture(scope="module")
def tokenizers():
    with open(f"{ta.TOKENIZERS}/{ta.BYTE_BPE}", "rb") as a, open(f"{ta.TOKENIZERS}/{ta.PIECE_BPE}", "rb") as b:
        return ta.Tokenizers(a.read(), b.read())


def brute_tokens(tok, text):
    """Token ids with their ends by decoded bytes, from encoding the text whole."""
    if not text:
        return None
    raw = (" " + text).encode()
    a, b = tok.a.encode(" " + text, add_special_tokens=False).ids, tok.b.encode(text)
    out = []
    for ids, table in ((a, tok.a_bytes), (b, tok.b_bytes)):
        if b"".join(table[i] for i in ids) != raw:
            return None
        at, ends = 0, []
        for i in ids:
            at += len(table[i])
            ends.append(at)
        out.append((ids, ends))
    return out


def brute(tok, rows):
    done = []
    held = Counter()
    for doc_id, text in rows:
        tokens = brute_tokens(tok, text)
        groups, links = [], Counter()
        if tokens:
            (a, a_ends), (b, b_ends) = tokens
            cuts = sorted(set(a_ends) & set(b_ends))
            ours, theirs = ([[] for _ in cuts] for _ in range(2))
            for ids, ends, into in ((a, a_ends, ours), (b, b_ends, theirs)):
                for i, e in zip(ids, ends):
                    into[bisect.bisect_left(cuts, e)].append(i)
            for x, y in zip(ours, theirs):
                groups.append(",".join(map(str, x)) + "|" + ",".join(map(str, y)))
                links.update((p, q) for p in x for q in y)
        done.append((doc_id, tokens, groups, links))
        held.update(links.keys())
    top = {}
    for (x, _), n in held.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for doc_id, tokens, groups, links in done:
        best = sum(n for p, n in links.items() if held[p] == top[p[0]])
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if tokens else ""
        out.append((doc_id, len(tokens[0][0]) if tokens else 0, len(tokens[1][0]) if tokens else 0, len(groups), sum(links.values()), best, sum(n * held[p] for p, n in links.items()), digest))
    return sorted(out, key=str)


TEXTS = [
    None, "", " ", "  ", "a", "hello world", "  two  blanks  ", "line\nline\n\nnext\n", "\nstarts with a line end", "tab\tand\r\nreturn", "é漢𝔘 naïve 🙂👍🏽 word",
    "<|endoftext|> <s> </s> <unk> <0x41>", "▁x", "lower ▁ one eighth block", "ﬁ ½ 　 wide blank", "nul \x00 byte", "it's we'll 12345 1,234.5", "word " * 200, "x" * 3000,
    "===== ----- ....", "hello world", "no break blank line", "ä" * 500, "end blank ", "a\x1cb \x85 c", "日本語 の テキスト\n改行",
]


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_awkward_texts(spark, tokenizers):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "repeated id"), (None, "no id")]
    assert rows_of(ta.align(documents(spark, rows))) == brute(tokenizers, rows)


def test_stretches_forgotten_and_small_blocks_and_slices(spark, tokenizers, monkeypatch):
    rows = [(i, t) for i, t in enumerate(TEXTS * 3)]
    monkeypatch.setattr(ta, "BLOCK_DOCUMENTS", 5)
    monkeypatch.setattr(ta, "SLICE", 7)
    kept = ta.Stretches(tokenizers, 10)
    for (_, text), got in zip(rows, kept.documents(t for _, t in rows)):
        tokens = brute_tokens(tokenizers, text)
        assert (tokens is None) == (got is None)
        if got:
            assert got[0][0] == len(tokens[0][0]) and got[0][1] == len(tokens[1][0])
    assert rows_of(ta.align(documents(spark, rows).repartition(3), most=10)) == brute(tokenizers, rows)


def test_empty_table(spark):
    assert ta.align(documents(spark, [(1, "x")]).limit(0)).collect() == []


def test_given_documents(spark, tokenizers):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert rows_of(ta.align(docs)) == brute(tokenizers, [(r.doc_id, r.text) for r in docs.collect()])
