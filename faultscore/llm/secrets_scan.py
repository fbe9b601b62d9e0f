"""Operator 1: secret scans.

Base rules find assignments, access keys and long hexadecimal runs.  The
method adds random-looking tokens.  A token is a run of 20 or more characters
of the base64 alphabets; it may stand right behind a "=".  For the encoding inferred from its characters (hex,
base32, base64) a battery tests that it is uniformly random: chi-squared
uniformity over the alphabet, the runs test above and below the alphabet's
middle, and lag-1 serial correlation; Fisher's method joins the three.  A
token the battery rejects (p < ``BATTERY_P``) is no secret.

Passing is weak evidence for a short token and strong for a long one, so the
false-discovery control is length-aware: each token's e-value is the
likelihood ratio of uniform symbols against the corpus's own symbol
frequencies (counted over all tokens of all texts), which grows with the
length only as fast as the token's symbols differ from ordinary text.  The
e-Benjamini-Hochberg procedure over all tokens then keeps the expected share
of false ones at ``FDR`` under any dependence.

Defined results: null is the empty text, with no span and the hash of the
empty string; repeated rows give a row each; tokens inside a base span are not
reported twice; an empty table gives an empty result; other columns are not
read.  Spans are code points, end exclusive, ordered by start, then kind.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_text, pick, written

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_RUN = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
KINDS = ("assign", "access", "hex", "random")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
BATTERY_P = 0.001
FDR = 0.01

SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"
CODE = {c: i for i, c in enumerate(SYMBOLS)}
ENCODINGS = (
    ("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+"), "0123456789abcdef"),
    ("base32", re.compile(r"[A-Z2-7]+"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base64", re.compile(r"[A-Za-z0-9+/]+"), "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", re.compile(r"[A-Za-z0-9_-]+"), "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base rules' matches."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    # maximal runs: the matches of HEX that are long enough
    out += [(m.start(), 2, m.end()) for m in HEX_RUN.finditer(text)]
    return sorted(out)


def infer_encoding(token: str) -> tuple[str, str] | None:
    """(encoding, its alphabet) with the smallest alphabet that holds the token."""
    for name, pattern, alphabet in ENCODINGS:
        if pattern.fullmatch(token):
            return name, alphabet.upper() if name == "hex" and token != token.lower() else alphabet
    return None


def _upper(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(ranks: np.ndarray, k: int) -> tuple[float, float, float, float]:
    """p-values of uniformity, runs, serial correlation, and all by Fisher."""
    n = len(ranks)
    stat = float((np.bincount(ranks, minlength=k).astype(float) ** 2).sum() * k / n - n)
    df = k - 1  # Wilson-Hilferty
    p_chi = _upper(((max(stat, 0) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))
    high = ranks >= k // 2
    a = int(high.sum())
    b = n - a
    runs = 1 + int((high[1:] != high[:-1]).sum())
    if a and b and n > 2:
        mean = 2 * a * b / n + 1
        var = 2 * a * b * (2 * a * b - n) / (n * n * (n - 1))
        p_runs = min(1.0, 2 * _upper(abs(runs - mean) / math.sqrt(var))) if var > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)  # all on one side of the middle
    x = ranks - ranks.mean()
    ss = float((x * x).sum())
    p_serial = min(1.0, 2 * _upper(abs(float((x[1:] * x[:-1]).sum()) / ss) * math.sqrt(n))) if ss else 2.0 ** (1 - n)
    h = -sum(math.log(max(p, 1e-300)) for p in (p_chi, p_runs, p_serial))
    return p_chi, p_runs, p_serial, math.exp(-h) * (1 + h + h * h / 2)


def tokens_of(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, str, str, float]]:
    """(start, end, token, encoding, battery p) of every token outside base spans."""
    out = []
    # both lists rise: ``reach`` is the furthest end of the spans that start by now
    at, reach = 0, -1
    for m in TOKEN.finditer(text):
        while at < len(base) and base[at][0] <= m.start():
            reach = max(reach, base[at][2])
            at += 1
        if m.end() <= reach:
            continue
        token = m.group().rstrip("=")
        found = infer_encoding(token)
        if found is None or len(token) < 20:
            out.append((m.start(), m.end(), token, "", 0.0))
            continue
        place = {c: i for i, c in enumerate(found[1])}
        out.append((m.start(), m.end(), token, found[0], battery(np.array([place[c] for c in token]), len(found[1]))[3]))
    return out


_BYTES = np.frombuffer(SYMBOLS.encode(), dtype=np.uint8)
_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_TOKEN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("token", pa.string()), ("encoding", pa.string()), ("p", pa.float64())])
SCANNED = [
    ("base", "array<struct<start:long,kind:int,end:long>>", pa.list_(_SPAN)),
    ("tokens", "array<struct<start:long,end:long,token:string,encoding:string,p:double>>", pa.list_(_TOKEN)),
    ("symbols", "array<long>", pa.list_(pa.int64())),
]


def scan(docs: DataFrame) -> DataFrame:
    """One pass over the texts: doc_id, base spans, tokens, and in the first
    row of each batch the batch's symbol counts."""

    def scanned(texts: list) -> tuple[list, list, list]:
        texts = [t or "" for t in texts]
        counts = sum(np.bincount(np.frombuffer(t.encode("utf-8", "replace"), dtype=np.uint8), minlength=256)[_BYTES] for t in texts)
        base = [base_spans(t) for t in texts]
        tokens = [tokens_of(t, b) for t, b in zip(texts, base)]
        spans = [[{"start": s, "kind": k, "end": e} for s, k, e in b] for b in base]
        found = [[dict(zip(("start", "end", "token", "encoding", "p"), t)) for t in ts] for ts in tokens]
        return spans, found, [counts.tolist()] + [None] * (len(texts) - 1)

    return map_text(docs, "text", SCANNED, lambda: scanned, ["doc_id"])


def log_e_value(token: str, encoding: str, text_log_p: np.ndarray) -> float:
    """Natural log of the e-value against ordinary text; the encoding was
    picked out of four, so a quarter of the likelihood ratio counts."""
    alphabet = {name: len(alphabet) for name, _, alphabet in ENCODINGS}[encoding]
    return -len(token) * math.log(alphabet) - float(sum(text_log_p[CODE[c]] for c in token)) - math.log(len(ENCODINGS))


def e_bh_threshold(histogram: dict[int, int], tested: int, fdr: float, step: float) -> float:
    """Least log e-value rejected by e-BH, from counts per bin of ``step``
    (bins are rounded down, which only makes the control stricter)."""
    rejected, cut = 0, math.inf
    for b in sorted(histogram, reverse=True):
        rejected += histogram[b]
        if b * step >= math.log(tested / (rejected * fdr)):
            cut = b * step
    return cut


STEP = 0.25


@dataclass(frozen=True)
class Calibration:
    """The corpus's symbol frequencies (logarithms) and the least e-value kept."""

    text_log_p: np.ndarray
    cut: float


def token_e(token: str, encoding: str, p: float, text_log_p: np.ndarray) -> float:
    return log_e_value(token, encoding, text_log_p) if encoding and p >= BATTERY_P else -1e9


def calibrate(rows: DataFrame, fdr: float) -> tuple[Calibration, DataFrame]:
    """From scanned rows: the calibration, and (row, start, end, e) of the tokens."""
    counts = dict(rows.select(F.posexplode("symbols").alias("i", "n")).groupBy("i").agg(F.sum("n")).collect())  # one row per symbol
    total = sum(counts.values()) + len(SYMBOLS)
    text_log_p = np.array([math.log((counts.get(i, 0) + 1) / total) for i in range(len(SYMBOLS))])

    def score(batches):
        for pdf in batches:
            pdf["e"] = [token_e(t, c, p, text_log_p) for t, c, p in zip(pdf["token"], pdf["encoding"], pdf["p"])]
            yield pdf[["row", "start", "end", "e"]]

    tokens = rows.select("row", F.explode("tokens").alias("t")).select("row", "t.*")
    scored = written(tokens.mapInPandas(score, "row string, start long, end long, e double"), "tokens")
    bins = {r["b"]: r["count"] for r in scored.where(F.col("e") > 0).groupBy(F.floor(F.col("e") / STEP).cast("int").alias("b")).count().collect()}
    return Calibration(text_log_p, e_bh_threshold(bins, max(1, scored.count()), fdr, STEP)), scored


def _scanned(docs: DataFrame) -> DataFrame:
    rows = written(scan(pick(docs, doc_id="doc_id", text="text")), "secrets")
    # rows of one id may repeat: a row is named by its id and its spans
    return rows.withColumn("row", F.sha2(F.to_json(F.struct("doc_id", "base", "tokens")), 256))


def secrets(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """doc_id, base and spans (all of them): arrays of struct<start, kind, end>."""
    rows = _scanned(docs)
    found, scored = calibrate(rows, fdr)
    kept = scored.where(F.col("e") >= found.cut).distinct().groupBy("row").agg(F.collect_list(F.struct("start", F.lit(3).alias("kind"), "end")).alias("random"))
    joined = rows.select("row", "doc_id", "base").join(kept, "row", "left")
    none = F.array().cast("array<struct<start:long,kind:int,end:long>>")
    return joined.select("doc_id", F.sort_array("base").alias("base"), F.sort_array(F.concat("base", F.coalesce("random", none))).alias("spans"))


def joined_spans(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(spans: str, kind: int) -> Column:
    """How many of the spans are of the kind."""
    # a second argument of the function, even one with a default, would be the span's place
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def q_secrets(spark, sf_dir):
    found = secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    per_kind = [of_kind("base", k).alias(f"n_{KINDS[k]}") for k in range(3)]
    return found.select("doc_id", *per_kind, F.sha2(joined_spans(F.col("base")), 256).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans"))


MASK = "<secret>"


def masked(text: str, found: Calibration) -> str:
    """The text with every base span and kept token replaced by ``MASK``,
    overlapping ones by one mask."""
    base = base_spans(text)
    spans = [(s, e) for s, _, e in base] + [(s, e) for s, e, t, c, p in tokens_of(text, base) if token_e(t, c, p, found.text_log_p) >= found.cut]
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """The documents with every found span masked; a rewritten text gets its
    new n_chars.  Rows stay, in the input's columns.

    A first pass calibrates over all texts, a second masks each text in its
    row, so that no text moves.
    """
    found, _ = calibrate(_scanned(docs), fdr)

    def texts(batch: list) -> tuple[list]:
        return ([None if t is None else masked(t, found) for t in batch],)

    out = map_text(docs, "text", [("__masked", "string", pa.string())], lambda: texts)
    changed = ~F.col("text").eqNullSafe(F.col("__masked"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("__masked").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.col("__masked")).select(*docs.columns)
