"""Fill-in-the-middle and collocations against plain versions, on odd rows too."""
import hashlib
import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import plain  # noqa: E402
from strata.llm import collocations, fill_in_middle  # noqa: E402

R = random.Random(11)
LONG = "".join(R.choice(["word", "é", "𝒳y", " ", "\n\t ", "\x0b", " ", " "]) for _ in range(60_000))
ODD = [None, "", " ", " \n\t", "one", " one", "one ", "a <P> b", "x<S>", "<M>", "<P", "a <S", "tail <", "<S<S >", "P>S>M>", "   ", "ä ö\u0085ü", LONG, LONG + " "]
SCHEMA = "doc_id long, text string, kept int, output int, n int, draws int, form int, lang string"


def fim_rows():
    rows = [(j * 20 + k, t) for j, t in enumerate(ODD) for k in range(20)]
    return rows + [(None, "a b c d"), (None, None), rows[-1], (-5, "minus five words in here"), (2**62, "a large id")]


def test_fill_in_middle(spark):
    rows = fim_rows()
    out = fill_in_middle.fill_in_middle(spark.createDataFrame([(*r, 1, 2, 3, 4, 5, None) for r in rows], SCHEMA), keep=["doc_id", "output"])
    out = out.withColumn("back", fill_in_middle.restore(F.col("output"), F.col("form"))).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    have = sorted(((r.kept.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, sha(r.output), sha(r.back)) for r in out), key=repr)
    want = [(i, *plain.fim(i, t)) for i, t in rows]
    assert have == sorted(((*w[:5], sha(w[5]), sha(t or "")) for w, (_, t) in zip(want, rows)), key=repr)
    assert {w[2] for w in want} == {"plain", "spm", "psm"} and all(r.kept.output == 2 for r in out)
    assert fill_in_middle.fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0


def test_cuts_of_a_long_text():
    text = "a  b\n" * 300_000
    assert fill_in_middle.cut(text, 0, 600_002) == (600_001, 0, 0)
    assert fill_in_middle.cut(text, 1, 600_000) == (600_001, 1, len(text) - 1)


def phrase_rows():
    words = [f"w{i}" for i in range(60)] + ["É", "été", "Don't", "x-y", "a b", "\x85q"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = []
    for d in range(150):
        lang = [None, "en", "de", "en", "en", "und"][d % 6]
        text = ""
        for _ in range(R.randrange(0, 60)):
            text += R.choice(["New York City Hall", "new york", "ab ab ab ab ab", *R.choices(words, weights, k=6)]) + R.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", " ;: ", "\x0b", "\r\n"])
        rows.append((lang, text))
    return rows + [("en", None), (None, ""), ("fr", " . , "), ("fr", "only"), ("de", "ab " * 3000), rows[1], rows[1]]


def got(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


SMALL = {"CHUNK": 64, "GROUP": 500, "RANKS": 8, "TILE": 4, "DENSE": 3, "HEAD": 20}


@pytest.mark.parametrize("least,top", [(30, 2000), (5, 40)])
def test_collocations(spark, least, top):
    rows = phrase_rows()
    docs = spark.createDataFrame([(*r, 0, 0, "x") for r in rows], "lang string, text string, n int, rank int, phrase string")
    want = sorted(plain.collocations(rows, least, top=top))
    assert len(want) > 10 and {r[0] for r in want} >= {"en", "de", "und"}
    assert got(collocations.collocations(docs.repartition(3), min_count=least, top=top)) == want
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_chunks_and_tiles_change_nothing(monkeypatch):
    """The counts of small chunks, tiles and heads add up to the same."""
    import pyarrow as pa

    rows = phrase_rows()
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] or "und" for r in rows]), pa.array([r[1] or "" for r in rows])], ["lang", "text"])

    def count():
        words = {}
        for b in collocations._word_counts(3)([batch]):
            for lang, key, word, n in zip(*(c.to_pylist() for c in b.columns)):
                words[lang, key, word] = words.get((lang, key, word), 0) + n
        ranked = {}
        for (lang, key, _), n in sorted(words.items(), key=lambda x: -x[1]):
            if len(ranked.setdefault(lang, [])) < collocations.RANKS:
                ranked[lang].append(key)
        ranked = {lang: np.array(keys, np.int64).view(np.uint64) for lang, keys in ranked.items()}
        one = collocations.Symbols(ranked, np.full(1 << (collocations.BITS - 6), 2**64 - 1, np.uint64))

        class Sent:
            value = [one, one]

        pairs = {}
        for b in collocations._phrase_counts(3, Sent)([batch]):
            for lang, p, w, n in zip(*(c.to_pylist() for c in b.columns)):
                pairs[lang, p, w] = pairs.get((lang, p, w), 0) + n
        return words, pairs

    want = count()
    for name, value in SMALL.items():
        monkeypatch.setattr(collocations, name, value)
    assert count() == want and len(want[1]) > 500


def test_dense_and_sparse_tiles():
    g = np.random.default_rng(5)
    a = np.minimum(g.geometric(0.01, 50_000), 2047)
    b = np.minimum(g.geometric(0.002, 50_000), 2047)
    x, y, n = collocations.tiles(a, b)
    want = {}
    for p in zip(a.tolist(), b.tolist()):
        want[p] = want.get(p, 0) + 1
    assert dict(zip(zip(x.tolist(), y.tolist()), n.tolist())) == want and len(x) == len(want)


def test_shared_keys_are_counted_with_another_seed(spark, monkeypatch):
    """Words that share a key under the first seed."""
    rows = [("en", "alpha beta gamma delta. " * 40)]
    seeds = []

    def counting(seed, count=collocations._word_counts):
        seeds.append(seed)
        inner = count(seed)

        def run(batches):
            import pyarrow as pa
            import pyarrow.compute as pc

            for b in inner(batches):
                key = pc.bit_wise_and(b.column("key"), pa.scalar(1 if seed == 1 else -1, pa.int64()))
                yield b.set_column(1, "key", key)

        return run

    monkeypatch.setattr(collocations, "_word_counts", counting)
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert got(collocations.collocations(docs)) == sorted(plain.collocations(rows)) and seeds == [1, 2]
