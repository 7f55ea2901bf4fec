"""LM scoring with an Elias-Fano n-gram trie.

The model is an interpolated absolute-discounting n-gram model over an add-one unigram base. It
is cut into shards by the hash of an n-gram's first word, so a context and its successors share a
shard. In a shard, level n lists the n-grams grouped by context: a monotone pointer sequence in
Elias-Fano form gives each context its range of successors, a successor is a fingerprint within
that range, and smoothed probabilities are quantised to a byte. Levels are memory-mapped files.
An n-gram is found by searching each next word within the range of the context before it.

Documents are hashed into blocks of bounded size. A block sends every shard of which it holds words
its distinct n-grams with their counts in training documents (the pre-aggregated shuffle); the shard
adds the counts up, builds its levels, looks every distinct n-gram up and answers; the block then sums
the scores of its documents. The corpus crosses the network once (both visits to a block read one
exchange). Shards and relays between them and the blocks are laid out as in ``census``.

Words are lower-cased (A-Z) runs other than ASCII white space and are told apart by 64-bit hashes.
Successor fingerprints have 40 bits.

Defined results: a null or empty text is the end token alone; rows without doc_id are left out;
repeated rows are counted and scored each; with no training documents every count is 0; an empty
table gives an empty table; a very long text is one document of one block; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .census import MESSAGES, Route
from .common import block_count, keyed_docs, planes, unplanes, word_hashes, words_of, written

ORDER, DISCOUNT, BLOCK_MB, HELD_OUT = 2, 0.75, 5, (7, 2)
FINGER, STEPS = np.uint64(40), 32
END, BEGIN = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC949C7DEFEB77B2B)


def quantised(p: np.ndarray) -> np.ndarray:
    """A byte for a probability: 1 for 1.0, then STEPS steps a decade; 0 stands for none."""
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.clip(np.rint(-np.log10(p) * STEPS) + 1, 1, 255), 0).astype(np.uint8)


VALUE_OF = np.concatenate([[0.0], 10.0 ** (-np.arange(255) / STEPS)])


class EliasFano:
    """A monotone sequence: low bits packed in full, high bits as unary gaps with a count per word."""

    def __init__(self, arrays: dict[str, np.ndarray], name: str) -> None:
        self.low, self.high, self.before = (arrays[f"{name}.{x}"] for x in ("low", "high", "before"))
        self.n, self.bits = int(arrays[f"{name}.head"][0]), int(arrays[f"{name}.head"][1])

    @staticmethod
    def build(values: np.ndarray, name: str) -> dict[str, np.ndarray]:
        values = values.astype(np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (top // max(1, n)).bit_length() - 1)
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros((int(ones[-1]) // 64 + 1) * 64 if n else 64, np.uint8)
        flags[ones] = 1
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        low = values & np.uint64((1 << bits) - 1)
        at = np.arange(n, dtype=np.uint64) * np.uint64(bits)
        packed = np.zeros(n * bits // 64 + 2, np.uint64)
        if bits:
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(packed, word, low << shift)
            over = shift + np.uint64(bits) > np.uint64(64)
            np.bitwise_or.at(packed, word[over] + 1, low[over] >> (np.uint64(64) - shift[over]))
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(high))[:-1]]).astype(np.uint32)
        return {f"{name}.low": packed, f"{name}.high": high, f"{name}.before": before, f"{name}.head": np.array([n, bits], np.uint64)}

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at positions i."""
        word = np.searchsorted(self.before, i, "right") - 1
        left = (i - self.before[word]).astype(np.int64)
        body = np.ascontiguousarray(self.high[word])
        place = np.zeros(len(i), np.int64)
        for width in (32, 16, 8, 4, 2, 1):  # halve the word until one bit is left
            count = np.bitwise_count(body & np.uint64((1 << width) - 1)).astype(np.int64)
            skip = left >= count
            left -= np.where(skip, count, 0)
            body = np.where(skip, body >> np.uint64(width), body)
            place += np.where(skip, width, 0)
        high = (word.astype(np.int64) * 64 + place - i).astype(np.uint64)
        if not self.bits:
            return high.astype(np.int64)
        at = i.astype(np.uint64) * np.uint64(self.bits)
        first, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        low = self.low[first] >> shift
        over = np.where(shift > 0, self.low[first + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return ((high << np.uint64(self.bits)) | ((low | over) & np.uint64((1 << self.bits) - 1))).astype(np.int64)


def build_levels(counts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], discount: float = DISCOUNT) -> dict[str, np.ndarray]:
    """Levels from, for each n, (context index in level n - 1, word key, count), sorted by context and key.

    Level 1 has no contexts: its keys are full hashes.
    """
    arrays: dict[str, np.ndarray] = {"1.key": counts[0][1], "1.count": counts[0][2].astype(np.uint64)}
    for n in range(2, len(counts) + 1):
        context, key, count = counts[n - 1]
        above = len(counts[n - 2][1])
        total = np.bincount(context, weights=count, minlength=above)
        arrays |= EliasFano.build(np.concatenate([[0], np.cumsum(np.bincount(context, minlength=above))]), f"{n}.from")
        kinds = np.bincount(context[count > 0], minlength=above)
        # fingerprints in five byte planes
        arrays[f"{n}.finger"] = np.ascontiguousarray(key.view(np.uint8).reshape(-1, 8)[:, :5])
        arrays[f"{n}.share"] = quantised(np.maximum(count - discount, 0) / np.maximum(1, total[context]))
        arrays[f"{n - 1}.rest"] = np.where(total > 0, quantised(discount * kinds / np.maximum(1, total)), 0).astype(np.uint8)
    return arrays


class Trie:
    """Levels in memory-mapped files of a folder."""

    def __init__(self, arrays: dict[str, np.ndarray], folder: str) -> None:
        self.arrays = {}
        for name, array in arrays.items():
            path = os.path.join(folder, name)
            array.tofile(path)
            self.arrays[name] = np.memmap(path, array.dtype, "r", shape=array.shape) if array.size else array
        self.order = max(int(x.split(".")[0]) for x in arrays if x.endswith(".share")) if len(arrays) > 2 else 1

    def words(self, hashes: np.ndarray) -> np.ndarray:
        """Positions in level 1, -1 where absent."""
        keys = self.arrays["1.key"]
        if not len(keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return np.where(keys[at] == hashes, at, -1)

    def successors(self, n: int, context: np.ndarray, finger: np.ndarray) -> np.ndarray:
        """Positions in level n of words after contexts of level n - 1; -1 where absent."""
        pointer, stored = EliasFano(self.arrays, f"{n}.from"), self.arrays[f"{n}.finger"]
        seen = context >= 0
        at = np.where(seen, context, 0)
        low, high = pointer.get(at), pointer.get(at + 1)
        high = np.where(seen, high, low)
        last = high.copy()

        def key(places: np.ndarray) -> np.ndarray:
            wide = np.zeros((len(places), 8), np.uint8)
            wide[:, :5] = stored[places]
            return wide.view(np.uint64)[:, 0]

        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            less = key(middle) < finger[open_]
            low[open_] = np.where(less, middle + 1, low[open_])
            high[open_] = np.where(less, high[open_], middle)
            open_ = open_[low[open_] < high[open_]]
        hit = np.flatnonzero(low < last)
        found = np.full(len(context), -1)
        hit = hit[key(low[hit]) == finger[hit]]
        found[hit] = low[hit]
        return found

    def value(self, name: str, places: np.ndarray) -> np.ndarray:
        stored = self.arrays[name]
        return np.where(places >= 0, stored[np.maximum(places, 0)], 0) if len(stored) else np.zeros(len(places), np.uint8)


class Block:
    """The tokens of a block's documents and their distinct n-grams, words in order of hash."""

    def __init__(self, table: pa.Table, order: int) -> None:
        texts = table.column("text").combine_chunks()
        words, index, sizes = words_of(texts)
        hashes = np.concatenate([word_hashes(words), [END, BEGIN]])
        by_hash = np.argsort(hashes, kind="stable")
        rank = np.empty(len(hashes), np.int64)
        rank[by_hash] = np.arange(len(hashes))
        self.hashes, self.words = hashes[by_hash], len(hashes)
        # each document: begin marks, words, end
        lead = order - 1
        lengths = sizes + 1 + lead
        starts = np.cumsum(lengths) - lengths
        stream = np.full(lengths.sum(), rank[-1], np.int64)
        body = np.repeat(starts + lead - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(index))
        stream[body] = rank[index]
        stream[starts + lengths - 1] = rank[-2]
        self.tokens = sizes + 1
        self.doc = np.repeat(np.arange(len(sizes)), self.tokens)
        # positions of scored tokens in the stream
        self.at = np.repeat(starts + lead - (np.cumsum(self.tokens) - self.tokens), self.tokens) + np.arange(self.tokens.sum())
        train = np.array(table.column("train").to_pylist(), bool)
        self.train = np.repeat(train, self.tokens)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.stream = stream
        begins = rank[-1]
        for n in range(1, order + 1):
            marked = self.codes(n) * 2 + self.train
            if 1 < n < order:  # begin marks alone are a context too, though none of them is scored
                begins = np.searchsorted(self.levels[-1][0], begins) * self.words + rank[-1]
                marked = np.append(marked, begins * 2)
            marked = np.sort(marked)
            own = marked >> 1
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
            trained = np.add.reduceat(marked & 1, first) if len(first) else np.zeros(0, np.int64)
            codes, counts = own[first], trained
            if n == 1:  # every word of the block, so that contexts are found by rank
                full = np.zeros(self.words, np.int64)
                full[codes] = counts
                codes, counts = np.arange(self.words), full
            self.levels.append((codes, counts))

    def codes(self, n: int) -> np.ndarray:
        """For every scored token, the n-gram that ends there: its context's place in level n - 1 and its word's rank."""
        here = self.stream[self.at]
        if n == 1:
            return here
        context = self.places(n - 1, 1)
        return context * self.words + here

    def places(self, n: int, back: int) -> np.ndarray:
        """The place in level n of the n-gram that ends ``back`` tokens before each scored token."""
        place = self.stream[self.at - back - (n - 1)]
        for m in range(2, n + 1):
            place = np.searchsorted(self.levels[m - 1][0], place * self.words + self.stream[self.at - back - (n - m)])
        return place


def _message_schema(order: int) -> str:
    return "to int, sender int, key binary, count1 binary" + "".join(f", sizes{n} binary, finger{n} binary, count{n} binary" for n in range(2, order + 1))


def _answer_schema(order: int) -> str:
    return "to int, part int, tokens long, kinds long, count1 binary" + "".join(f", rest{n - 1} binary, share{n} binary" for n in range(2, order + 1))


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


#: Per level: (place of each n-gram's context in the level before, key: hash or fingerprint, count), sorted by both.
Levels = list[tuple[np.ndarray, np.ndarray, np.ndarray]]


def letters(sender: int, cuts: list[tuple[int, int, int]], levels: Levels) -> pa.Table:
    """A message for each run of first words: their n-grams, level by level."""
    rows = []
    for to, low, high in cuts:
        row = [to, sender, planes(levels[0][1][low:high]), planes(levels[0][2][low:high].astype(np.uint32))]
        for context, key, count in levels[1:]:
            a, b = np.searchsorted(context, [low, high])
            sizes = np.bincount(context[a:b] - low, minlength=high - low).astype(np.uint32)
            row += [planes(sizes), planes(np.ascontiguousarray(key[a:b]), 5), planes(count[a:b].astype(np.uint32))]
            low, high = int(a), int(b)
        rows.append(row)
    schema = _message_schema(len(levels))
    kinds = [pa.int32(), pa.int32()] + [pa.binary()] * (schema.count(",") - 1)
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_names(schema))


def combined(rows: list[dict], order: int) -> tuple[Levels, list[np.ndarray], list[list[int]]]:
    """(levels of several messages together; per level the place of every message's n-grams in them; n-grams per message)."""
    keys, place = np.unique(np.concatenate([unplanes(r["key"], np.uint64) for r in rows]), return_inverse=True)
    counted = lambda n: np.concatenate([unplanes(r[f"count{n}"], np.uint32) for r in rows])
    levels, places = [(np.zeros(len(keys), np.int64), keys, np.bincount(place, weights=counted(1), minlength=len(keys)))], [place]
    sizes_of = [[len(r["key"]) // 8 for r in rows]]
    for n in range(2, order + 1):
        sizes = np.concatenate([unplanes(r[f"sizes{n}"], np.uint32) for r in rows]).astype(np.int64)
        finger = np.concatenate([unplanes(r[f"finger{n}"], np.uint64, 5) for r in rows])
        unique, place = np.unique(np.repeat(place, sizes).astype(np.uint64) << FINGER | finger, return_inverse=True)
        levels.append(((unique >> FINGER).astype(np.int64), unique & np.uint64((1 << 40) - 1), np.bincount(place, weights=counted(n), minlength=len(unique))))
        places.append(place)
        sizes_of.append([len(r[f"finger{n}"]) // 5 for r in rows])
    return levels, places, sizes_of


def replies(part: int, rows: list[dict], order: int, totals: tuple[int, int], values: dict[str, np.ndarray], places: list[np.ndarray], sizes_of: list[list[int]]) -> pa.Table:
    """An answer to every message from the values of the distinct n-grams."""
    out: list[list] = [[r["sender"] for r in rows], [part] * len(rows), [totals[0]] * len(rows), [totals[1]] * len(rows)]
    for name in _names(_answer_schema(order))[4:]:
        level = int(name[-1]) - 1
        out.append(_cut(values[name][places[level]], sizes_of[level]))
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64()] + [pa.binary()] * (len(out) - 4)
    return pa.table([pa.array(c, k) for c, k in zip(out, types, strict=True)], names=_names(_answer_schema(order)))


def values_of(rows: list[dict], order: int) -> dict[str, np.ndarray]:
    """The values of answers, put together in order of their parts."""
    rows = sorted(rows, key=lambda r: r["part"])
    kind = lambda name: np.uint64 if name == "count1" else np.uint8
    return {name: np.concatenate([np.zeros(0, kind(name)), *(unplanes(r[name], kind(name)) for r in rows)]) for name in _names(_answer_schema(order))[4:]}


def held_out(doc_id: Column, parts: int, of: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)) == of


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(documents: DataFrame, order: int = ORDER, discount: float = DISCOUNT, fold: tuple[int, int] = HELD_OUT, block_mb: float = BLOCK_MB, messages: int = MESSAGES) -> DataFrame:
    docs = keyed_docs(documents)
    blocks = block_count(docs, block_mb)
    route = Route(blocks, blocks, messages)
    docs = docs.select("doc_id", "text", (~held_out(F.col("doc_id"), *fold)).alias("train"), F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int").alias("block"))

    def send(key: tuple, table: pa.Table) -> pa.Table:
        own, block = Block(table, order), key[0].as_py()
        levels: Levels = []
        for codes, counts in own.levels:
            word = codes % own.words
            levels.append((codes // own.words, own.hashes[word] >> (np.uint64(64) - FINGER) if levels else own.hashes, counts))
        return letters(block, route.sent(own.hashes, block), levels)

    def forward(key: tuple, table: pa.Table) -> pa.Table:
        levels, _, _ = combined(table.to_pylist(), order)
        return letters(key[0].as_py(), route.forwarded(levels[0][1], key[0].as_py()), levels)

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        levels, places, sizes_of = combined(rows, order)
        count = levels[0][2]
        model: Levels = levels[:1]
        for n, (context, finger, total) in enumerate(levels[1:], 2):
            # only n-grams of training documents enter the model, but a context keeps its place even if it is not counted
            kept = total > 0 if n == order else np.ones(len(total), bool)
            model.append((context[kept], finger[kept], total[kept]))
        with tempfile.TemporaryDirectory() as folder:
            trie = Trie(build_levels(model, discount), folder)
            at = trie.words(levels[0][1])
            values = {"count1": trie.value("1.count", at).astype(np.uint64)}
            for n, (context, finger, _) in enumerate(levels[1:], 2):
                values[f"rest{n - 1}"] = trie.value(f"{n - 1}.rest", at).astype(np.uint8)
                at = trie.successors(n, at[context], finger)
                values[f"share{n}"] = trie.value(f"{n}.share", at).astype(np.uint8)
        return replies(key[0].as_py(), rows, order, (int(count.sum()), int((count > 0).sum())), values, places, sizes_of)

    def back(key: tuple, table: pa.Table, found: pa.Table) -> pa.Table:
        rows, answered = table.to_pylist(), found.to_pylist()
        _, places, sizes_of = combined(rows, order)
        return replies(key[0].as_py(), rows, order, (0, 0), values_of(answered, order), places, sizes_of)

    sent = docs.groupBy("block").applyInArrow(send, _message_schema(order))
    ranged = sent.groupBy("to").applyInArrow(forward, _message_schema(order)) if route.relayed else sent
    # written, as the totals of all shards are needed before the first document is scored
    answered = written(ranged.groupBy("to").applyInArrow(answer, _answer_schema(order)), "answers")
    totals = answered.groupBy("part").agg(F.max("tokens").alias("tokens"), F.max("kinds").alias("kinds")).agg(F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds")).first()
    tokens, kinds = totals["tokens"] or 0, totals["kinds"] or 0
    if route.relayed:
        answered = sent.groupBy("to").cogroup(answered.groupBy("to")).applyInArrow(back, _answer_schema(order))

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        own, values = Block(table, order), values_of(answers.to_pylist(), order)
        count = values["count1"].astype(np.float64)
        here = own.codes(1)
        p = ((count + 1) / (tokens + kinds + 1))[here]
        base = np.bincount(own.doc, weights=np.log10(p), minlength=len(own.tokens))
        for n in range(2, order + 1):
            weight = VALUE_OF[values[f"rest{n - 1}"]][own.places(n - 1, 1)]
            p = VALUE_OF[values[f"share{n}"]][np.searchsorted(own.levels[n - 1][0], own.codes(n))] + np.where(weight > 0, weight, 1) * p
        total = np.bincount(own.doc, weights=np.log10(np.minimum(p, 1)), minlength=len(own.tokens))
        known = np.bincount(own.doc, weights=count[here] > 0, minlength=len(own.tokens)).astype(np.int64)
        held = np.array([not x for x in table.column("train").to_pylist()], bool)
        n = len(own.tokens)
        return pa.table(
            [table.column("doc_id").combine_chunks(), pa.array(held), pa.array(own.tokens), pa.array(known), pa.array(np.full(n, tokens, np.int64)), pa.array(base), pa.array(total)],
            names=_names(SCORES),
        )

    return docs.groupBy("block").cogroup(answered.groupBy("to")).applyInArrow(finish, SCORES)


def _cut(values: np.ndarray, sizes: list[int]) -> list[bytes]:
    """Values in runs of the given sizes, as byte planes."""
    ends = np.cumsum(sizes)
    return [planes(np.ascontiguousarray(values[b - s : b])) for s, b in zip(sizes, ends, strict=True)]
