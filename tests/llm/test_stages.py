"""The pipeline's stages over repeated rows, rows without doc_id, nulls, empty tables and clashing names."""

import collections
import re

import pytest
import sentencepiece
from pyspark.sql import functions as F

from cadenza.llm import mixing, ngram_join, pieces, quality, secrets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, decoded string, kept int, block int"
PLAIN = "a quiet river runs past the old mill and the children watch the boats go by"
ROWS = [
    (1, PLAIN), (1, PLAIN), (1, PLAIN + " token=abcdefgh12345"), (2, None), (2, None), (3, ""), (4, " \n\t "), (None, "secret=abcdefgh12345 and more"), (None, None),
    (5, "password: hunter2secret then token=zyxwvuts98765 end"), (6, "=== $$$ *** " * 20), (7, "été ▁ naïve 😀 " * 5), (8, PLAIN.upper()),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(n, t, "en", "s", -1, "i", "d", 3, 4) for n, t in ROWS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(n, int(n != 6), 0) for n in range(1, 9)] + [(1, 1, 0), (None, 0, 0), (3, None, 0)], "doc_id long, quality int, toxic int")


def _counted(rows):
    return collections.Counter((r["doc_id"], r["text"]) for r in rows)


def test_redact_answers_every_row(docs):
    """Repeated rows and rows without doc_id are redacted each; n_chars changes only where the text did."""
    rows = secrets.redact(docs).collect()
    hide = lambda t: t and re.sub(r"(secret=|token=|password: )[a-z0-9]+", "[SECRET]", t)
    got = collections.Counter((r["doc_id"], re.sub(r"(secret=|token=|password: )?\[SECRET\]", "[SECRET]", r["text"]) if r["text"] else r["text"]) for r in rows)
    assert got == collections.Counter((n, hide(t)) for n, t in ROWS)
    assert all(r["n_chars"] == (len(r["text"]) if "[SECRET]" in (r["text"] or "") else -1) for r in rows)


def test_keep_good_answers_every_row(docs, labels):
    """A row stays by its text alone: equal texts stay or go together, whatever their doc_id."""
    scores = {(r["doc_id"], r["predicted"]) for r in quality.classify(docs, labels).collect()}
    kept = _counted(quality.keep_good(docs, labels).collect())
    every = collections.Counter(ROWS)
    assert all(every[k] == n for k, n in kept.items())
    single = {n for n in (5, 6, 7, 8)}
    assert {n for n in single if (n, 1) in scores} == {n for n, _ in kept} & single
    assert {n for n, t in kept if not t} in (set(), {2, 3, None})


def test_keep_good_without_labels(docs, labels):
    """Nothing to learn from: every row stays."""
    assert _counted(quality.keep_good(docs, labels.limit(0)).collect()) == collections.Counter(ROWS)


def test_keep_one_counts_rows(docs):
    """Of repeated texts one row stays; texts without a word, and rows without doc_id, are linked with nothing by their emptiness."""
    kept = _counted(ngram_join.keep_one(docs).collect())
    assert kept[(1, PLAIN)] == 1 and kept[(8, PLAIN.upper())] == 0
    assert kept[(2, None)] == 2 and kept[(None, None)] == 1 and kept[(3, "")] == 1


def test_mixing_copies_are_whole_rows(docs):
    out = mixing.mix_copies(docs)
    assert out.columns == docs.columns
    got = _counted(out.collect())
    every = collections.Counter(ROWS)
    assert all(n <= 2 * every[k] for k, n in got.items()) and sum(got.values()) > 0


def test_pieces_answer_every_row(docs):
    """One row per row: null and empty texts have the begin and end ids and decode to nothing; other columns don't matter."""
    tool = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    rows = pieces.encode_pieces(docs).collect()
    want = []
    for n, t in ROWS:
        ids = tool.encode(t or "", add_bos=True, add_eos=True)
        want.append((n, tuple(ids), tool.decode(ids)))
    assert collections.Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in rows) == collections.Counter(want)
    assert all(len(i) == 2 and d == "" for n, i, d in want if n in (2, 3))


def test_pieces_of_an_empty_table(docs):
    out = pieces.encode_pieces(docs.limit(0))
    assert out.columns == ["doc_id", "ids", "decoded"] and out.collect() == []


def test_stages_after_each_other(docs, labels):
    """What one stage leaves is whole input of the next, down to nothing."""
    for start in (docs, docs.where(F.col("text").isNull()), docs.limit(0)):
        left = start
        for stage in (lambda d: quality.keep_good(d, labels), ngram_join.keep_one, secrets.redact, mixing.mix_copies):
            left = stage(left)
            assert left.columns == docs.columns
        assert pieces.encode_pieces(left).count() == left.count()
