"""Fill-in-the-middle transformation: a document's tokens are cut twice and the pieces put into another order.

Method: repeated-capture matching. One ``regex.fullmatch`` of ``(unit)*`` over the whole text keeps every
repetition of its group, so ``match.ends(1)`` gives the number of units and the offsets of both cuts at once.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import small_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# blanks with the word behind them, or the blanks at the end; possessive, so that nothing is kept for backtracking
UNITS = regex.compile(r"((?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++))*+", regex.DOTALL)


def cut(text: str, first: int, second: int) -> tuple[int, int, int]:
    """(n, end of the prefix, end of the middle): number of units, and the code points before the cuts
    after ``first % (n + 1)`` and ``second % (n + 1)`` units, the smaller first."""
    ends = UNITS.fullmatch(text).ends(1)
    n = len(ends)
    low, high = sorted((first % (n + 1), second % (n + 1)))
    return n, ends[low - 1] if low else 0, ends[high - 1] if high else 0


def _transform(fim_percent: int, spm_percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ns, forms, heads, middles, outputs = [], [], [], [], []
            for text, h in zip(batch.column("text").to_pylist(), batch.column("draws").to_pylist()):
                n, a, b = cut(text, h[0], h[1])
                ns.append(n)
                if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= fim_percent:
                    forms.append("plain")
                    heads.append(None)
                    middles.append(None)
                    outputs.append(text)
                    continue
                spm = h[3] % 100 < spm_percent
                forms.append("spm" if spm else "psm")
                heads.append(a)
                middles.append(b - a)
                head, middle, rest = text[:a], text[a:b], text[b:]
                outputs.append(f"{SUFFIX}{rest}{PREFIX}{head}{MIDDLE}{middle}" if spm else f"{PREFIX}{head}{SUFFIX}{rest}{MIDDLE}{middle}")
            columns = [batch.column("kept"), pa.array(ns, pa.int64()), pa.array(forms, pa.string()), pa.array(heads, pa.int64()),
                       pa.array(middles, pa.int64()), pa.array(outputs, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["kept", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def fill_in_middle(
    docs: DataFrame, seed: int = 42, fim_percent: int = 50, spm_percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Returns a struct ``kept`` of the columns ``keep`` (default: the id), ``n, form, prefix_chars, middle_chars, output``.

    A unit is a word with the ASCII blanks before it, or the blanks at the end of the text; ``n`` units make up the
    text. Draws h1 to h4 are the first four groups of eight hex digits of sha256 of ``seed:id``. The prefix ends
    after the smaller of h1 % (n + 1) and h2 % (n + 1) units, the middle after the larger. Form: ``plain`` (the text as
    it is) if it is empty, holds a marker, or h3 % 100 >= ``fim_percent``; else ``spm`` (suffix, prefix, middle) if
    h4 % 100 < ``spm_percent``, else ``psm``.

    Defined cases: a null text is the empty one; a null id draws like an empty id (``42:``); rows with equal ids draw alike,
    repeated rows are transformed each; an empty table gives no rows; other columns are ignored unless kept, under their
    own names inside ``kept``. Each row is transformed by itself: no shuffle, and Arrow batches hold few rows.
    """
    small_batches(docs.sparkSession, 256)
    keep = keep or [id_col]
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draw = lambda i: F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long")
    rows = docs.select(F.struct(*keep).alias("kept"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.array(*(draw(i) for i in range(4))).alias("draws"))
    kind = rows.schema["kept"].dataType.simpleString()
    return rows.mapInArrow(_transform(fim_percent, spm_percent), (
        f"kept {kind}, n long, form string, prefix_chars long, middle_chars long, output string"))


def restore(output: Column, form: Column) -> Column:
    """The text from ``output`` and ``form`` alone. No text with a marker is ever cut, and a marker can't begin
    in one piece and end in the next, so the first marker of each kind is the one that was put in."""
    def between(start: str, end: str | None) -> Column:
        rest = F.substring(output, F.instr(output, start) + len(start), F.char_length(output))
        return rest if end is None else F.substring(rest, F.lit(1), F.instr(rest, end) - 1)

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
