"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE bytes over its whole text. A passage is encoded as the
square roots of its character-class bigram shares; a small layer embeds it, gated attention
(tanh times sigmoid) weighs the passages of a document, and a logistic unit scores the weighted
sum. All weights are learned together from document labels, with numpy on the driver, from a
bounded sample of labelled rows: in order of a hash of doc_id at most ``sample`` of them, as long as
all their passages together are at most ``passages``. A row in the sample is learned from whole;
one that has over a sixteenth of ``passages`` alone is not chosen. Labels are learned only where
crc32(doc_id as text) mod 5 is not 0. Scoring reads nothing but the text, every passage of it.

Defined results: a null or empty text is one empty passage; a null doc_id is not held out;
repeated rows give repeated results; labels with a null or repeated doc_id or null quality:
the first are left out, of the second the smallest quality counts, and it is learned from the
smallest text of a repeated doc_id; without usable labels every
score is 0.5 and ``keep_good`` keeps all rows; a very long text is scored slice by slice under running
sums of its attention, so memory is a slice beside the text; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mixed, packed, plain_docs, spread, string_bytes, unpacked, written

PASSAGE, CLASSES, EMBED, GATE = 512, 16, 32, 16
FEATURES = CLASSES**2 + 2
SAMPLE, PASSAGES, EPOCHS, THRESHOLD, SLICE_BYTES = 6_000, 80_000, 14, 0.3, 1_500_000


def _class_table() -> np.ndarray:
    table = np.full(256, 14, np.uint8)
    groups = [" ", "\n\r\t\v\f", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".", ",", "!?", "|", "*#$%&", "()[]{}<>\"'`", "-_/\\+=~^@"]
    for i, group in enumerate(groups):
        table[list(group.encode())] = i
    table[0xC0:] = 12
    table[0x80:0xC0] = 13
    table[list(b":;")] = 15
    return table


CLASS_OF = _class_table()


def encoded(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(passage features in float32, passages per text) of texts of ``lengths`` bytes that lie back to back."""
    ends = np.cumsum(lengths)
    kinds = CLASS_OF[data].astype(np.int64)
    passages = np.maximum(1, -(-lengths // PASSAGE))
    base = np.cumsum(passages) - passages
    place = np.arange(len(kinds)) - np.repeat(ends - lengths, lengths)
    of = np.repeat(base, lengths) + place // PASSAGE
    before = np.concatenate([[0], kinds[:-1]]) if len(kinds) else kinds
    before[place % PASSAGE == 0] = 0
    total = int(passages.sum())
    counts = np.bincount(of * CLASSES**2 + before * CLASSES + kinds, minlength=total * CLASSES**2).reshape(total, -1)
    shares = counts / np.maximum(1, counts.sum(axis=1, keepdims=True))
    return np.sqrt(np.concatenate([shares, repeated_words(data, kinds, of, total)], axis=1)).astype(np.float32), passages


def encode_passages(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per slice of whole documents: (passage features, passages per document)."""
    data, offsets = string_bytes(column)
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1)
        yield encoded(data[offsets[first] : offsets[last]], np.diff(offsets[first : last + 1]))
        first = last


def repeated_words(data: np.ndarray, kinds: np.ndarray, of: np.ndarray, passages: int) -> np.ndarray:
    """[passages, 2]: shares of a passage's words that equal the word before them, and the one before that."""
    solid = kinds > 1
    starts = np.flatnonzero(solid & np.concatenate([[True], ~solid[:-1] | (of[1:] != of[:-1])]))
    if not len(starts):
        return np.zeros((passages, 2))
    letters = np.where(solid, mixed(data.astype(np.uint64) + np.uint64(1)), np.uint64(0))
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(len(data) - starts[0]) - np.repeat(starts - starts[0], lengths)
    weights = np.cumprod(np.full(PASSAGE + 1, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
    words = np.add.reduceat(letters[starts[0] :] * weights[np.minimum(place, PASSAGE)], starts - starts[0])
    home = of[starts]
    total = np.maximum(1, np.bincount(home, minlength=passages))
    out = np.zeros((passages, 2))
    for gap in (1, 2):
        same = (words[gap:] == words[:-gap]) & (home[gap:] == home[:-gap])
        out[:, gap - 1] = np.bincount(home[gap:][same], minlength=passages) / total
    return out


class Model:
    """Embedding, gated attention and logistic unit; ``step`` learns from a batch of bags."""

    def __init__(self, seed: int = 7) -> None:
        r = np.random.default_rng(seed)
        d = FEATURES
        draw = lambda a, b: (r.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        self.w = {"E": draw(d, EMBED) * 4, "e": np.zeros(EMBED, np.float32), "V": draw(EMBED, GATE), "U": draw(EMBED, GATE), "a": draw(GATE, 1)[:, 0], "c": draw(EMBED, 1)[:, 0], "b": np.zeros(1, np.float32)}
        self.moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.w.items()}
        self.steps = 0

    def forward(self, x: np.ndarray, sizes: np.ndarray) -> tuple:
        w = self.w
        h = np.tanh(x @ w["E"] + w["e"])
        t, s = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        logits = (t * s) @ w["a"]
        starts = np.cumsum(sizes) - sizes
        raised = np.exp(logits - np.repeat(np.maximum.reduceat(logits, starts), sizes))
        attention = raised / np.repeat(np.add.reduceat(raised, starts), sizes)
        z = np.add.reduceat(attention[:, None] * h, starts)
        p = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["b"], -30, 30)))
        return h, t, s, attention, starts, z, p

    def gradients(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy of a batch of bags."""
        w = self.w
        h, t, s, attention, starts, z, p = self.forward(x, sizes)
        of = np.repeat(np.arange(len(sizes)), sizes)
        d_out = (p - y) / len(y)
        d_z = d_out[:, None] * w["c"]
        d_att = (h * d_z[of]).sum(axis=1)
        d_logit = attention * (d_att - np.add.reduceat(attention * d_att, starts)[of])
        d_t, d_s = d_logit[:, None] * w["a"] * s * (1 - t * t), d_logit[:, None] * w["a"] * t * s * (1 - s)
        d_h = attention[:, None] * d_z[of] + d_t @ w["V"].T + d_s @ w["U"].T
        d_e = d_h * (1 - h * h)
        return {"E": x.T @ d_e, "e": d_e.sum(axis=0), "V": h.T @ d_t, "U": h.T @ d_s, "a": (d_logit[:, None] * t * s).sum(axis=0), "c": z.T @ d_out, "b": np.array([d_out.sum()])}

    def step(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray, rate: float) -> None:
        w, grads = self.w, self.gradients(x, sizes, y)
        self.steps += 1
        for k, g in grads.items():
            m, v = self.moments[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w[k] -= (rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.99**self.steps)) + 1e-8)).astype(np.float32)

    def streamed(self, data: np.ndarray, slice_bytes: int) -> float:
        """The score of one text, its passages a slice at a time: a running maximum of attention logits, and under it
        the running sums of weights and of weighted passages, are all that is carried."""
        w, top, weight, total = self.w, -np.inf, 0.0, np.zeros(EMBED)
        step = max(1, slice_bytes // PASSAGE) * PASSAGE  # passages don't look beyond their ends
        for at in range(0, max(1, len(data)), step):
            x, _ = encoded(data[at : at + step], np.array([len(data[at : at + step])]))
            h = np.tanh(x @ w["E"] + w["e"]).astype(np.float64)
            logits = ((np.tanh(h @ w["V"]) / (1 + np.exp(-(h @ w["U"])))) @ w["a"]).astype(np.float64)
            most = max(top, logits.max())
            raised = np.exp(logits - most)
            weight, total = weight * np.exp(top - most) + raised.sum(), total * np.exp(top - most) + raised @ h
            top = most
        return 1 / (1 + np.exp(-np.clip(total / weight @ w["c"] + w["b"][0], -30, 30)))

    def scores(self, column: pa.Array, slice_bytes: int = SLICE_BYTES) -> np.ndarray:
        """A score per text; texts of over ``slice_bytes`` are streamed, the others go together in slices."""
        data, offsets = string_bytes(column)
        long = np.flatnonzero(np.diff(offsets) > slice_bytes)
        out = np.empty(len(offsets) - 1)
        first = 0
        for stop in np.append(long, len(out)).tolist():
            while first < stop:
                last = min(stop, max(first + 1, int(np.searchsorted(offsets, offsets[first] + slice_bytes, "right")) - 1))
                out[first:last] = self.forward(*encoded(data[offsets[first] : offsets[last]], np.diff(offsets[first : last + 1])))[-1]
                first = last
            if stop < len(out):
                out[stop] = self.streamed(data[offsets[stop] : offsets[stop + 1]], slice_bytes)
                first = stop + 1
        return out


def fold(doc_id: Column, parts: int = 5) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts))


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, passages: int = PASSAGES) -> dict[str, np.ndarray] | None:
    """The learned weights; None without usable labels."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).dropna().where(fold(F.col("doc_id")) != 0)
    usable = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    place = F.xxhash64("doc_id")
    chosen = usable.orderBy(place, "doc_id").limit(sample)
    # the sample is bounded, and so is what is broadcast and collected
    labelled = plain_docs(documents).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    many = F.greatest(F.lit(1), F.ceil(F.octet_length("text") / PASSAGE)).cast("long")
    whole = written(labelled.withColumn("passages", many).where(F.col("passages") <= max(1, passages // 16)), "labelled")
    so_far = F.sum("passages").over(Window.orderBy(place, "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    fits = whole.select("doc_id", so_far.alias("so_far")).where(F.col("so_far") <= passages).select("doc_id")
    learned = whole.join(F.broadcast(fits), "doc_id").select("doc_id", "text", "quality")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for x, sizes in encode_passages(batch.column("text")):
                ends = np.cumsum(sizes)
                rows = [x[a:b].astype("<f2").tobytes() for a, b in zip(ends - sizes, ends, strict=True)]
                n = len(sizes)
                yield pa.record_batch([batch.column("doc_id").slice(at, n), batch.column("quality").slice(at, n), pa.array(rows, pa.binary())], names=["doc_id", "quality", "bag"])
                at += n

    rows = sorted(learned.mapInArrow(bags, "doc_id long, quality int, bag binary").collect())
    if len({r["quality"] for r in rows}) < 2:
        return None
    x = [np.frombuffer(r["bag"], "<f2").reshape(-1, FEATURES) for r in rows]
    y = np.array([float(r["quality"] > 0) for r in rows])
    model, order = Model(), np.random.default_rng(11)
    batch, total = 64, EPOCHS * -(-len(x) // 64)
    for _ in range(EPOCHS):
        places = order.permutation(len(x))
        for i in range(0, len(x), batch):
            own = places[i : i + batch]
            model.step(np.concatenate([x[j] for j in own]).astype(np.float32), np.array([len(x[j]) for j in own]), y[own], 0.01 * (1 - model.steps / (total + 1)))
    return model.w


def scored(documents: DataFrame, weights: dict[str, np.ndarray] | None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model()
        if weights is not None:
            model.w = weights
        for batch in batches:
            found = model.scores(batch.column("text")) if weights is not None else np.full(batch.num_rows, 0.5)
            yield pa.record_batch([batch.column("doc_id"), pa.array(np.round(found.astype(np.float64), 6))], names=["doc_id", "score"])

    found = spread(plain_docs(documents)).mapInArrow(score, "doc_id long, score double")
    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(documents, train(documents, labels))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``documents`` without those that the classifier rejects; rows are scored where they are read."""
    weights = train(documents, labels)
    if weights is None:
        return documents
    whole = packed(documents).select("kept", "text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model()
        model.w = weights
        for batch in batches:
            found = np.round(model.scores(batch.column("text").fill_null("")).astype(np.float64), 6)
            yield batch.filter(pa.array(found >= THRESHOLD))

    return unpacked(whole.mapInArrow(keep, whole.schema), documents.columns)
