"""Operator 7: language identification by cross-parsing entropy.

Each language's labelled text becomes a suffix automaton.  A text is
cross-parsed with every automaton: from the current place the longest match
in the language's text is one phrase (one character where nothing matches),
and the next phrase starts behind it.  The language needing the fewest
phrases per character wins.  Phrases start afresh at each word (a run of
letters, lower-cased, with a blank on either side), so a word's phrase counts
are the same wherever it stands and are worked out once per batch.

The automata are fitted on a bounded sample: per language at most
``SAMPLE_ROWS`` documents in the order of a hash of doc_id and at most
``SAMPLE_CHARS`` characters in all.  Whole texts are predicted.

Defined results: a null text or one without letters gives ``und`` and score
0; equal phrase counts go to the language that sorts first, score 0; with one
learned language the score is 1; with none, every text is ``und``; a null
doc_id counts as held out; an empty table gives an empty result; repeated
rows give a row each.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_text, pick

SAMPLE_ROWS = 120
SAMPLE_CHARS = 60_000
#: Labels are a closed set; more is an error in the table.
MAX_LANGUAGES = 1_000
UNDETERMINED = "und"
LETTERS = re.compile(r"[^\W\d_]+")


class SuffixAutomaton:
    """Automaton of all substrings of a text (online construction)."""

    def __init__(self, text: str) -> None:
        self.next: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        nxt = self.next
        for ch in text:
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and ch not in nxt[p]:
                nxt[p][ch] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][ch]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(nxt)
                    nxt.append(dict(nxt[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and nxt[p].get(ch) == q:
                        nxt[p][ch] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur

    def phrases(self, text: str) -> int:
        """Number of greedy longest-match phrases of ``text``."""
        nxt, root = self.next, self.next[0]
        count, state = 0, root
        for ch in text:
            to = state.get(ch)
            if to is None:
                count += state is not root
                to = root.get(ch)
                if to is None:
                    count += 1
                    state = root
                    continue
            state = nxt[to]
        return count + (state is not root)


def words(text: str) -> list[str]:
    """Runs of letters of the lower-cased text; number signs such as superscripts,
    fractions and Roman numeral signs are no letters."""
    out = []
    for run in LETTERS.findall(text.lower()):
        if run.isalpha():
            out.append(run)
        else:
            out += "".join(c if c.isalpha() else " " for c in run).split()
    return out


def training_text(texts: list[str]) -> str:
    return " " + " ".join(w for t in texts for w in words(t)) + " "


@lru_cache(maxsize=2)  # by content: the same sample is built once per Python worker
def automata(sample: tuple[tuple[str, str], ...]) -> tuple[SuffixAutomaton, ...]:
    return tuple(SuffixAutomaton(text) for _, text in sample)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def learn(labelled: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> tuple[tuple[str, str], ...]:
    """((lang, training text), ...) from (doc_id, text, lang) rows."""
    base = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    order = Window.partitionBy("lang").orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id")
    ranked = base.select("lang", "doc_id").withColumn("r", F.row_number().over(order)).where(F.col("r") <= rows)
    chosen = ranked.groupBy("lang").agg(F.collect_set("doc_id").alias("ids")).limit(MAX_LANGUAGES + 1).collect()
    if len(chosen) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    ids = [i for r in chosen for i in r["ids"]]
    picked = base.where(F.col("doc_id").isin(ids)) if ids else base.limit(0)
    first = picked.groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
    got = first.select("lang", "doc_id", F.substring("text", 1, chars).alias("text")).orderBy("lang", "doc_id").limit(rows * max(1, len(chosen))).collect()
    sample = {}
    for r in got:
        sample.setdefault(r["lang"], []).append(r["text"])
    return tuple((lang, training_text(texts)[:chars]) for lang, texts in sorted(sample.items()) if any(words(t) for t in texts))


def predict(docs: DataFrame, sample: tuple[tuple[str, str], ...], names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` (with a column text) plus the predicted language and score."""
    langs = [lang for lang, _ in sample]
    shared = docs.sparkSession.sparkContext.broadcast(sample)  # bounded by SAMPLE_CHARS a language

    def make():
        built = automata(shared.value)
        known: dict[str, tuple[int, ...]] = {}

        def phrases(word: str) -> tuple[int, ...]:
            got = known.get(word)
            if got is None:
                if len(known) > 200_000:
                    known.clear()
                got = known[word] = tuple(a.phrases(f" {word} ") for a in built)
            return got

        def told(text: str | None) -> tuple[str, float]:
            counted = Counter(words(text or ""))
            if not counted or not langs:
                return UNDETERMINED, 0.0
            totals = [0] * len(langs)
            for word, n in counted.items():
                for i, c in enumerate(phrases(word)):
                    totals[i] += n * c
            best = min(range(len(langs)), key=lambda i: (totals[i], langs[i]))
            rest = [t for i, t in enumerate(totals) if i != best]
            return langs[best], 1.0 - totals[best] / min(rest) if rest else 1.0

        return lambda texts: zip(*map(told, texts))

    return map_text(docs, "text", [(names[0], "string", pa.string()), (names[1], "double", pa.float64())], make)


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score); learned from the rows not held out."""
    rows = pick(docs, doc_id="doc_id", text="text", lang="lang")
    sample = learn(rows.where(~held_out(F.col("doc_id"))))
    return predict(rows.select("doc_id", "text"), sample).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def q_identify(spark, sf_dir):
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
