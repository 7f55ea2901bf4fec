"""Token ids in a word-aligned binary format (Simple-8b).

Documents are range-partitioned and sorted by doc_id, tokenised, and their ids packed into
64-bit words: the top 4 bits choose how many ids of how many bits share the other 60. Ids are
cut into blocks of BLOCK ids whose word offsets are stored, so that all blocks are packed and
unpacked side by side. An id of 60 bits or more is an escape: selector 15 with all payload bits
set, and the id itself in the next word.

A row of the stored table is one segment file: its partition and number there, the documents'
ids and lengths, the words and the block offsets. Segments are of bounded size.

A text is cut at ASCII white space, which the tokenizer drops anyway, so that every distinct
word of a batch is tokenised once, and a bounded number of words once per worker.

Defined results: a null or empty text has only the end id; rows without doc_id are left out;
rows with equal doc_id are ordered by their text and keep one result each; other columns are
ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import gathered, keyed_docs, words_of, written

BLOCK, END_ID, SEGMENT_IDS, GATHERED_BYTES = 256, 1, 1 << 20, 12_000_000
#: Letters that lower-casing and normalising leave alone or lower one by one, and a word of them with signs after it.
LATIN, LETTER = "[a-zß-öø-ÿ]", "[A-Za-zÀ-ÖØ-öø-ÿ]"
PLAIN = f"^{LATIN}+$"
#: ASCII signs but the apostrophe, which can start a pretoken with letters.
SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
SIGNED = rf"^{LETTER}+[!-&(-/:-@\[-`{{-~]*$"
#: Distinct words whose ids a worker keeps, and batches after which it starts anew.
KNOWN, RENEWED = 1_000_000, 64
#: Ids per word and bits per id, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = np.uint64((1 << 60) - 1)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, first word of each block). All blocks advance together, a word at a time."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    body = np.zeros((blocks + 1) * BLOCK, np.uint64)
    body[:n] = ids
    width = np.frexp(body[: blocks * BLOCK].astype(np.float64))[1].astype(np.uint8)
    large = body[: blocks * BLOCK] >= np.uint64(1 << 52)
    if large.any():  # no selector between 30 and 60 bits, so the width need not be exact
        width[large] = 60
    # widest id among the next k, for each k that a selector packs
    selector = np.full((blocks, BLOCK), 15, np.uint8)
    reach, most = 1, width.reshape(blocks, BLOCK)
    for choice in range(14, 0, -1):
        count = int(COUNTS[choice])
        while reach < count:
            step = min(reach, count - reach)
            ahead = np.zeros_like(most)
            ahead[:, :-step] = most[:, step:]
            most = np.maximum(most, ahead)
            reach += step
        fits = most <= BITS[choice]
        if not fits.any():  # longer words of narrower ids don't fit either
            break
        selector = np.where(fits, choice, selector)
    sizes = np.minimum(BLOCK, n - np.arange(blocks) * BLOCK)
    at, live, selector = np.zeros(blocks, np.int64), np.arange(blocks), selector.reshape(-1)
    made: list[np.ndarray] = []
    while len(live):
        start = live * BLOCK + at[live]
        made.append(start)
        at[live] += COUNTS[selector[start]]
        live = live[at[live] < sizes[live]]
    start = np.sort(np.concatenate(made))
    chosen = selector[start]
    words = chosen.astype(np.uint64) << np.uint64(60)
    escaped = (chosen == 15) & (body[start] >= ESCAPE)
    words[escaped] |= ESCAPE
    for choice in range(2, 16):
        of = np.flatnonzero((chosen == choice) & ~escaped)
        first, count = start[of], int(COUNTS[choice])
        left, packed = BLOCK - first % BLOCK, words[of]
        over = np.flatnonzero(left < count)  # words that end beyond their block
        for k in range(count):
            values = body[first + k]
            values[over[left[over] <= k]] = 0
            packed |= values << np.uint64(k * int(BITS[choice]))
        words[of] = packed
    count = np.bincount(start // BLOCK, minlength=blocks) + np.bincount(start[escaped] // BLOCK, minlength=blocks)
    if escaped.any():
        words = np.insert(words, np.flatnonzero(escaped) + 1, body[start[escaped]])
    return words, (np.cumsum(count) - count).astype(np.uint32)


def unpack(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The n ids; a pass per selector over all words at once."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    marked = np.flatnonzero((selector == 15) & ((words & ESCAPE) == ESCAPE))
    # an escape's own word may look like another escape: settle them in order
    after = -1
    for at in marked:
        if at != after:
            after = at + 1
            raw[after] = True
    counts = np.where(raw, 0, COUNTS[selector])
    block = np.repeat(np.arange(len(offsets)), np.diff(np.append(offsets.astype(np.int64), len(words))))
    before = np.concatenate([[0], np.cumsum(counts)])
    start = block * BLOCK + before[:-1] - before[offsets.astype(np.int64)[block]]
    stop = np.minimum((block + 1) * BLOCK, n)
    for choice in np.unique(selector[~raw]):
        of = np.flatnonzero((selector == choice) & ~raw)
        count, bits = int(COUNTS[choice]), int(BITS[choice])
        if not bits:
            continue
        places = start[of, None] + np.arange(count)
        values = (words[of, None] >> (np.arange(count) * bits).astype(np.uint64)) & np.uint64((1 << bits) - 1)
        inside = places < stop[of, None]
        out[places[inside]] = values[inside]
    if raw.any():
        at = np.flatnonzero(raw)
        out[start[at - 1]] = words[at]
    return out


def gathered_runs(flat: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs flat[begin : begin + size], back to back."""
    before = np.cumsum(sizes) - sizes
    return flat[np.repeat(begin - before, sizes) + np.arange(sizes.sum())]


class ChunkTokenizer:
    """The library's tokenizer, called once for every distinct word that a worker doesn't know yet.

    A Latin word with ASCII signs after it is two pretokens, the letters and the signs, and letters are
    lowered one by one: both are words of their own here. A text of lower-case Latin words is tokenised
    word by word: these are given to the library many at a time, and cut apart at the tokens that end a
    word. All other words are given to it one by one.

    Ids of words met are kept for later batches, up to ``known`` words.
    """

    def __init__(self, path: str, known: int = KNOWN, renewed: int = RENEWED) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tool, self.most, self.renewed, self.batches = Tokenizer.from_file(path), known, renewed, 0
        names = self.tool.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(max(names.values()) + 1, bool)
        self.ends_word[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.words, self.flat, self.sizes = pa.array([], pa.large_string()), np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _new_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, ids per word), from the library."""
        plain = pc.match_substring_regex(words, PLAIN).to_numpy(zero_copy_only=False)
        sizes = np.zeros(len(words), np.int64)
        texts = words.filter(pa.array(plain)).to_pylist()
        found = self.tool.encode_batch_fast([" ".join(texts[i : i + 2000]) for i in range(0, len(texts), 2000)], add_special_tokens=False)
        many = np.concatenate([np.array(x.ids, np.uint32) for x in found] or [np.zeros(0, np.uint32)])
        last = np.flatnonzero(self.ends_word[many])
        sizes[plain] = np.diff(last, prepend=-1)
        single = [np.array(x.ids, np.uint32) for x in self.tool.encode_batch_fast(words.filter(pa.array(~plain)).to_pylist(), add_special_tokens=False)]
        sizes[~plain] = [len(x) for x in single]
        ids = np.empty(sizes.sum(), np.uint32)
        of = np.repeat(plain, sizes)
        ids[of] = many
        ids[~of] = np.concatenate(single) if single else []
        return ids, sizes

    def _ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat ids, first of each word, ids per word) of distinct words."""
        if self.batches and self.batches % self.renewed == 0:
            self._forget()
        self.batches += 1
        place = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(place < 0)
        fresh = words.take(pa.array(new))
        ids, counts = self._new_ids(fresh)
        place[new] = len(self.sizes) + np.arange(len(new))
        flat, sizes = np.concatenate([self.flat, ids]), np.concatenate([self.sizes, counts])
        keep = min(len(new), self.most - len(self.words))
        if keep > 0:
            self.words = pa.concat_arrays([self.words, fresh[:keep]])
            self.sizes = sizes[: len(self.words)].copy()
            self.flat = flat[: self.sizes.sum()].copy()
        return flat, (np.cumsum(sizes) - sizes)[place], sizes[place]

    def _chunk_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks, ids per chunk)."""
        signed = np.flatnonzero(pc.match_substring_regex(chunks, SIGNED).to_numpy(zero_copy_only=False))
        whole = chunks.take(pa.array(signed))
        heads = pc.ascii_rtrim(whole, characters=SIGNS)
        ending = np.flatnonzero(pc.not_equal(pc.binary_length(heads), pc.binary_length(whole)).to_numpy(zero_copy_only=False))
        tails = pc.replace_substring_regex(whole.take(pa.array(ending)), f"^{LETTER}+", "")
        other = np.ones(len(chunks), bool)
        other[signed] = False
        coded = pa.concat_arrays([pc.utf8_lower(heads), tails, chunks.filter(pa.array(other))]).dictionary_encode()
        flat, begin, sizes = self._ids(coded.dictionary)
        of = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # each chunk's first word, then its signs if it has any
        owner = np.concatenate([signed, signed[ending], np.flatnonzero(other)])
        of = of[np.argsort(owner, kind="stable")]
        lengths = np.bincount(owner, weights=sizes[coded.indices.to_numpy(zero_copy_only=False)], minlength=len(chunks)).astype(np.int64)
        return gathered_runs(flat, begin[of], sizes[of]), lengths

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by END_ID; ids per text)."""
        chunks, index, per_row = words_of(column, lower=False)
        flat, sizes = self._chunk_ids(chunks)
        # one more chunk stands for the end of a text
        index = np.insert(index, np.cumsum(per_row), len(sizes))
        flat, sizes = np.append(flat, np.uint32(END_ID)), np.append(sizes, 1)
        lengths = sizes[index]
        ids = gathered_runs(flat, (np.cumsum(sizes) - sizes)[index], lengths)
        total = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.cumsum(per_row) + np.arange(1, len(per_row) + 1)
        return ids, np.diff(total[ends], prepend=0)


_tokenizers: dict[str, ChunkTokenizer] = {}


def tokenizer(path: str) -> ChunkTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = ChunkTokenizer(path)
    return _tokenizers[path]


SEGMENT = "part int, segment long, doc_ids array<long>, doc_lengths array<long>, n_ids long, words binary, block_offsets binary"


def encode_segments(documents: DataFrame, path: str | None = None) -> DataFrame:
    """Segments in ascending doc_id order: partitions are ranges of doc_id, segments follow within them."""
    model = path or public_tokenizers.path("word_bpe_49k.json")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, part, segment = tokenizer(model), TaskContext.get().partitionId(), 0
        for batch in gathered(batches, GATHERED_BYTES):
            ids, lengths = tool.encode(batch.column("text"))
            ends = np.cumsum(lengths)
            first = 0
            while first < len(lengths):
                before = ends[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(ends, before + SEGMENT_IDS, "right")))
                own = ids[before : ends[last - 1]]
                words, offsets = pack(own)
                yield pa.record_batch(
                    [
                        pa.array([part], pa.int32()), pa.array([segment], pa.int64()),
                        pa.array([batch.column("doc_id")[first:last].to_pylist()], pa.list_(pa.int64())), pa.array([lengths[first:last]], pa.list_(pa.int64())),
                        pa.array([len(own)], pa.int64()), pa.array([words.astype("<u8").tobytes()], pa.binary()), pa.array([offsets.astype("<u4").tobytes()], pa.binary()),
                    ],
                    names=[x.split()[0] for x in SEGMENT.split(", ")],
                )
                first, segment = last, segment + 1

    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = keyed_docs(documents).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    return ranged.mapInArrow(encode, SEGMENT)


def segment_starts(segments: DataFrame) -> DataFrame:
    """(part, segment, start): ids before each segment. Only counts are summed, first by partition."""
    sizes = segments.select("part", "segment", "n_ids")
    of_parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("total"))
    before = of_parts.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("segment")) - F.col("n_ids")
    return sizes.select("part", "segment", within.alias("inner")).join(before, "part").select("part", "segment", (F.col("inner") + F.col("before")).alias("start"))


def documents_of(segments: DataFrame) -> DataFrame:
    """(part, segment, doc_id, offset, n_tokens, ids_crc32), unpacked from stored segments."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["block_offsets"], "<u4"), row["n_ids"]).astype("<u4")
                lengths = np.array(row["doc_lengths"], np.int64)
                ends = np.cumsum(lengths)
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(ends - lengths, ends, strict=True)]
                n = len(lengths)
                yield pa.record_batch(
                    [
                        pa.array([row["part"]] * n, pa.int32()), pa.array([row["segment"]] * n, pa.int64()), pa.array(row["doc_ids"], pa.int64()),
                        pa.array(ends - lengths), pa.array(lengths), pa.array(crcs, pa.int64()),
                    ],
                    names=["part", "segment", "doc_id", "offset", "n_tokens", "ids_crc32"],
                )

    return segments.mapInArrow(decode, "part int, segment long, doc_id long, offset long, n_tokens long, ids_crc32 long")


def token_digests(documents: DataFrame, path: str | None = None) -> DataFrame:
    """Write the segments, read them back, and describe each document's ids."""
    stored = written(encode_segments(documents, path), "token-ids", "none")
    read = documents_of(stored).join(segment_starts(stored), ["part", "segment"])
    return read.select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
