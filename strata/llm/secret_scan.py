"""Secret scan: fixed patterns, plus tokens that look random to two character Markov models.

A first-order model of random strings and one of ordinary identifiers are
trained from labelled samples (what the fixed patterns match, against the other
tokens of the same documents). Of long tokens, less what the fixed matches cover, the run with the
highest log-likelihood ratio is added, if that is high enough.
"""
from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import let

# The base patterns, in their order; group 2 of the first has 12 characters or more.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_N = len(ALPHABET)
TOKEN = r"[A-Za-z0-9+/_=-]{%d,}"
IDENTIFIER = r"\b(?:[A-Z][A-Z_]{5,}|[A-Za-z][a-z_]{5,})\b"  # letters of one case; the first may be a capital
_SPAN = "struct<start:int,kind:int,end:int>"
_NONE = f"array<{_SPAN}>"


def _spans(text: Column, pattern: str, kind: int, keep: Column | None = None) -> Column:
    """Spans (code points, end exclusive) of the pattern's matches, leftmost and not overlapping.

    The pieces between the matches give their places. ``keep``: flags of the matches to return.
    """
    none = F.array().cast(_NONE)
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    keep = F.transform(found, lambda m: F.lit(True)) if keep is None else keep
    steps = F.arrays_zip(
        F.transform(pieces, lambda p: F.char_length(p)).alias("gap"),
        F.transform(found, lambda m: F.char_length(m)).alias("size"), keep.alias("keep"))

    def step(acc: Column, s: Column) -> Column:
        start = acc["at"] + s["gap"]
        end = start + F.coalesce(s["size"], F.lit(0))  # the last piece has no match
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(
            F.coalesce(s["keep"], F.lit(False)), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.when(text.rlike(pattern), F.aggregate(steps, start, step, lambda acc: acc["spans"])).otherwise(none)


def _codes(token: Column) -> Column:
    """Places of the token's characters in ALPHABET, from 0."""
    return F.transform(F.split(token, "", -1), lambda c: F.instr(F.lit(ALPHABET), c) - 1)


def _pairs(codes: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.size(codes) - 2), lambda i: F.get(codes, i) * _N + F.get(codes, i + 1))


def train(docs: DataFrame, sample_docs: int = 5000, smoothing: float = 8.0, id_col: str = "doc_id", text_col: str = "text") -> list[float]:
    """Log-likelihood ratio (bits) of every character pair, random string against identifier.

    Fitted on a bounded sample: about ``sample_docs`` documents, by a hash of
    the id and text. Labels: values that the base patterns match are random; of the
    other tokens, those of six letters or more in one case are identifiers. Only the pair
    counts (at most 2 * 67 * 67) come to the driver. Without samples all
    ratios are 0.
    """
    total = docs.count()
    share = min(1.0, sample_docs / max(1, total))
    text = F.coalesce(F.col(text_col), F.lit(""))
    sample = docs.where(F.pmod(F.xxhash64(id_col, text_col), F.lit(1_000_000)) < int(share * 1_000_000) + 1).select(text.alias("text"))
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    values = F.concat(
        F.filter(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), lambda v: (F.char_length(v) >= 12) & ~v.contains(".")),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)), F.regexp_extract_all("text", F.lit(HEX), F.lit(0)))
    labelled = sample.select(F.lit(1).alias("random"), F.explode(values).alias("token")).unionByName(
        sample.select(F.lit(0).alias("random"), F.explode(F.regexp_extract_all(rest, F.lit(IDENTIFIER), F.lit(0))).alias("token")))
    counts = labelled.select("random", F.explode(let(_codes(F.col("token")), _pairs)).alias("pair")).groupBy("random", "pair").count().collect()
    table = {(r["random"], r["pair"]): r["count"] for r in counts}

    def bits(label: int) -> list[float]:
        """Each row is smoothed with the label's single characters, so that a character
        that a label hardly has stays unlikely after one that it never has."""
        seen = [0.5 + sum(table.get((label, a * _N + b), 0) for a in range(_N)) for b in range(_N)]
        single = [x / sum(seen) for x in seen]
        out = []
        for a in range(_N):
            row = [table.get((label, a * _N + b), 0) + smoothing * single[b] for b in range(_N)]
            out += [math.log2(x / sum(row)) for x in row]
        return out

    return [r - o for r, o in zip(bits(1), bits(0))]


def _best_run(token: Column, model: Column, min_chars: int, min_bits: float) -> Column:
    """``first, end, ok`` of the token's run of ``min_chars`` or more whose pair ratios, each less ``min_bits``, have the largest
    sum (the earliest end, then the earliest start). ``ok``: the sum is at least the log2 of the places where a run can
    begin, so that a long token doesn't qualify by its length alone."""
    need = min_chars - 1  # pairs

    def run(gains: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            start = i - F.lit(need - 1)
            sums = F.struct((acc["lead"] + F.get(gains, i)).alias("lead"),
                            (acc["lag"] + F.when(start > 0, F.get(gains, start - 1)).otherwise(0.0)).alias("lag"))
            lows = let(sums, lambda x: F.struct(
                x["lead"].alias("lead"), x["lag"].alias("lag"), ((start >= 0) & (acc["low"].isNull() | (x["lag"] < acc["low"]))).alias("new")))
            placed = let(lows, lambda x: F.struct(
                x["lead"].alias("lead"), x["lag"].alias("lag"), F.when(x["new"], x["lag"]).otherwise(acc["low"]).alias("low"),
                F.when(x["new"], start).otherwise(acc["at"]).alias("at")))
            return let(placed, lambda x: let((start >= 0) & (acc["best"].isNull() | (x["lead"] - x["low"] > acc["best"])), lambda more: F.struct(
                x["lead"].alias("lead"), x["lag"].alias("lag"), x["low"].alias("low"), x["at"].alias("at"),
                F.when(more, x["lead"] - x["low"]).otherwise(acc["best"]).alias("best"),
                F.when(more, x["at"]).otherwise(acc["first"]).alias("first"), F.when(more, i + 2).otherwise(acc["end"]).alias("end"))))

        none, nowhere = F.lit(None).cast("double"), F.lit(None).cast("int")
        begin = F.struct(F.lit(0.0).alias("lead"), F.lit(0.0).alias("lag"), none.alias("low"), nowhere.alias("at"),
                         none.alias("best"), nowhere.alias("first"), nowhere.alias("end"))
        starts = F.size(gains) - F.lit(need - 1)
        return F.aggregate(F.sequence(F.lit(0), F.size(gains) - 1), begin, step, lambda acc: F.struct(
            acc["first"].alias("first"), acc["end"].alias("end"), (acc["best"] >= F.log2(starts)).alias("ok")))

    return let(F.transform(_pairs(_codes(token)), lambda p: F.get(model, p) - F.lit(min_bits)), run)


def _outside(token: Column, base: Column, min_chars: int) -> Column:
    """The parts of a token (``start, end, text``) that no base span touches, of ``min_chars`` or more: ``at, end`` within it."""
    part = "struct<at:int,end:int>"
    touching = F.filter(base, lambda x: (x["start"] < token["end"]) & (token["start"] < x["end"]))
    cuts = F.concat(F.array_sort(F.transform(touching, lambda x: F.struct(
        (x["start"] - token["start"]).alias("at"), (x["end"] - token["start"]).alias("end")))),
        F.array(F.struct((token["end"] - token["start"]).alias("at"), (token["end"] - token["start"]).alias("end"))))

    def step(acc: Column, x: Column) -> Column:
        piece = F.struct(acc["at"].alias("at"), x["at"].alias("end"))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(
            x["at"] - acc["at"] >= min_chars, F.concat(acc["parts"], F.array(piece))).otherwise(acc["parts"]).alias("parts"))

    return F.aggregate(cuts, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{part}>").alias("parts")), step, lambda acc: acc["parts"])


def scan(
    docs: DataFrame, ratios: list[float], min_chars: int = 20, min_bits: float = 1.0, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Returns ``id, spans``: array of (start, kind, end) by start, then kind (0 assign, 1 access, 2 hex, 3 markov).

    The base kinds are the leftmost non-overlapping matches of their patterns.
    Kind 3: base spans are cut out of the tokens of ``min_chars`` characters or more; of each part that
    is still as long, the best run (see ``_best_run``) is added, if its log-likelihood ratio is high enough.

    Defined cases: a null text is empty and has no span; repeated rows are
    scanned each; null ids are kept; an empty table gives no rows; extra columns
    are ignored. One row is read and written at a time, nothing is shuffled.
    """
    model = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    token = TOKEN % min_chars

    def runs(t: Column, base: Column) -> Column:
        """Kind 3 spans of one token."""
        found = F.transform(_outside(t, base, min_chars), lambda part: let(
            _best_run(F.substring(t["text"], part["at"] + 1, part["end"] - part["at"]), model, min_chars, min_bits), lambda r: F.struct(
                (t["start"] + part["at"] + r["first"]).alias("start"), F.lit(3).alias("kind"), (t["start"] + part["at"] + r["end"]).alias("end"), r["ok"].alias("ok"))))
        return F.transform(F.filter(found, lambda r: r["ok"]), lambda r: F.struct(
            r["start"].alias("start"), r["kind"].alias("kind"), r["end"].alias("end")))

    def all_spans(text: Column) -> Column:
        long_value = F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.char_length(v) >= 12)
        base = F.concat(_spans(text, ASSIGN, 0, long_value), _spans(text, ACCESS, 1), _spans(text, HEX, 2))
        tokens = F.transform(F.arrays_zip(_spans(text, token, 3).alias("at"), F.regexp_extract_all(text, F.lit(token), F.lit(0)).alias("text")),
                             lambda t: F.struct(t["at"]["start"].alias("start"), t["at"]["end"].alias("end"), t["text"].alias("text")))
        return let(base, lambda b: F.array_sort(F.concat(b, F.flatten(F.transform(tokens, lambda t: runs(t, b))))))

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = F.array(F.struct(let(text, all_spans).alias("spans")))
    return docs.select(F.col(id_col).alias("id"), F.inline(rows))  # inline: evaluated once, whatever reads it


def written(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
