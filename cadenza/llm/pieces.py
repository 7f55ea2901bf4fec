"""SentencePiece BPE by a merge-type prefix table.

A text is cut before each space (no piece of the vocabulary holds a space mark after another
character, which is checked on loading), so a chunk is encoded once and its ids are reused.
Within a chunk, for every prefix the table holds the one last piece of the prefix's encoding:
automaton matches that end there are tried from the longest, and one is right if it is
compatible with the last piece of the prefix before it, that is if BPE of the two strings
side by side keeps both pieces. The ids are then read backwards. Chunks that begin with several
space marks hold pieces of equal rank, for which compatibility isn't defined: there merges are
replayed from a heap, best rank first and leftmost among equals, in n log n.

Distinct chunks of a batch are encoded once; ids of documents are gathered from theirs by numpy, and
so are the bytes that ids decode to.

Characters outside the vocabulary become byte pieces. Ids start with the begin id and stop with
the end id. Decoding joins the pieces, turns marks into spaces and drops the leading one.

Defined results: a null or empty text gives the two outer ids and an empty decoded text; a null
doc_id stays null; repeated rows give repeated results; a very long text, word or run of spaces takes
time in proportion (n log n for spaces) and memory of its ids; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from .common import plain_docs, spread

MARK = "▁"
KEPT_CHUNKS, KEPT_PAIRS = 400_000, 600_000


class PieceTable:
    """The vocabulary, its automaton, and the caches of one worker (both of bounded size)."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.begin, self.end, self.unknown = model.bos_id(), model.eos_id(), model.unk_id()
        names = [model.id_to_piece(i) for i in range(size)]
        self.byte_id = [0] * 256
        self.piece_bytes: list[bytes] = []
        self.ids: dict[str, int] = {}
        self.rank = [0.0] * size
        for i, name in enumerate(names):
            if model.is_byte(i):
                self.byte_id[int(name[3:5], 16)] = i
                self.piece_bytes.append(bytes([int(name[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.piece_bytes.append(b"")
            else:
                if MARK in name.lstrip(MARK):
                    raise ValueError("pieces with inner space marks are not supported")
                self.piece_bytes.append(name.replace(MARK, " ").encode())
                self.ids[name] = i
                self.rank[i] = -model.get_score(i)
        self.names = names
        self.single = {name for name in self.ids if len(name) == 1}
        self.unknown_char = re.compile("([^" + re.escape("".join(sorted(self.single))) + "])")
        self.automaton = ahocorasick.Automaton()
        for name, i in self.ids.items():
            self.automaton.add_word(name, i)
        self.automaton.make_automaton()
        self.lengths = [len(name) for name in names]
        #: Whether a piece's own string encodes to it, as far as it was asked.
        self.alone: list[bool | None] = [None] * size
        self.pairs: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.chunks: dict[str, tuple[int, ...]] = {}
        self.flat_bytes: np.ndarray | None = None

    def forget(self) -> None:
        """Drop the caches at the end of a task: a worker may go on to other work."""
        self.chunks.clear()
        self.pairs.clear()

    def merged(self, text: str) -> list[int]:
        """BPE by replaying merges, best rank first and leftmost among equals."""
        parts: list[str] = list(text)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ids, rank = self.ids, self.rank
        heap = []
        for i in range(n - 1):
            found = ids.get(parts[i] + parts[i + 1])
            if found is not None:
                heap.append((rank[found], i, found))
        heapq.heapify(heap)
        while heap:
            _, i, found = heapq.heappop(heap)
            j = after[i]
            # a pair is out of date if either side has merged since
            if not parts[i] or j >= n or ids.get(parts[i] + parts[j]) != found:
                continue
            parts[i], parts[j] = self.names[found], ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                found = ids.get(parts[i] + parts[k])
                if found is not None:
                    heapq.heappush(heap, (rank[found], i, found))
            h = before[i]
            if h >= 0:
                found = ids.get(parts[h] + parts[i])
                if found is not None:
                    heapq.heappush(heap, (rank[found], h, found))
        return [ids[p] for p in parts if p]

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE of the two pieces' strings side by side is just these two pieces."""
        key = left << 20 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._kept_apart(left, right)
        return known

    def _halves(self, piece: int) -> tuple[int, int] | None:
        """The two pieces whose merge makes this one; None for a single character."""
        name = self.names[piece]
        if len(name) == 1:
            return None
        if piece not in self.halves:
            parts = list(name)
            while len(parts) > 2:
                options = [(self.rank[found], i) for i in range(len(parts) - 1) if (found := self.ids.get(parts[i] + parts[i + 1])) is not None]
                at = min(options)[1]
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self.halves[piece] = self.ids[parts[0]], self.ids[parts[1]]
        return self.halves[piece]

    def _kept_apart(self, left: int, right: int) -> bool:
        """Walk both pieces back through their merges, latest first: no pair met at the seam may merge before the piece that ends its stay there."""
        rank, latest, on_left = self.rank, float("inf"), False
        while True:
            across = self.ids.get(self.names[left] + self.names[right])
            if across is not None and (rank[across] < latest or rank[across] == latest and not on_left):
                return False
            a, b = self._halves(left), self._halves(right)
            if a is None and b is None:
                return True
            # the later of the two merges is undone; among equals the right one came later
            if b is None or a is not None and rank[left] > rank[right]:
                latest, on_left, left = rank[left], True, a[1]
            else:
                latest, on_left, right = rank[right], False, b[0]

    def run(self, text: str) -> list[int] | None:
        """Ids by the prefix table; None if a character is unknown."""
        last = [0] * len(text)
        done, pairs, lengths = -1, self.pairs, self.lengths
        for end, piece in self.automaton.iter(text):
            if end == done:
                continue
            before = end - lengths[piece]
            if before >= 0:
                key = last[before] << 20 | piece
                if key <= 0xFFFFF:  # no piece ends there
                    return None
                ok = pairs.get(key)
                if ok is None:
                    ok = self.compatible(key >> 20, piece)
            else:
                ok = self.alone[piece]
                if ok is None:
                    ok = self.alone[piece] = self.merged(self.names[piece]) == [piece]
            if ok:
                last[end], done = piece, end
        ids, at = [], len(text) - 1
        while at >= 0:
            piece = last[at]
            if not piece:
                return None
            ids.append(piece)
            at -= lengths[piece]
        ids.reverse()
        return ids

    def chunk(self, text: str) -> tuple[int, ...]:
        known = self.chunks.get(text)
        if known is None:
            if len(self.chunks) >= KEPT_CHUNKS:
                self.chunks.clear()
            ids = None if text.startswith(MARK * 2) else self.run(text)
            if ids is None:
                ids = []
                for i, part in enumerate(self.unknown_char.split(text)):
                    if i % 2:
                        ids.extend(self.byte_id[b] for b in part.encode())
                    elif part:
                        ids.extend(self.merged(part) if part.startswith(MARK * 2) else self.run(part))
            known = self.chunks[text] = tuple(ids)
        return known

    def encode(self, text: str) -> list[int]:
        return self.encode_all(pa.array([text], pa.large_string()))[0].tolist()

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts back to back, ids per text); texts without nulls."""
        texts = texts.cast(pa.large_string())
        marked = pc.replace_substring(pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(MARK, pa.large_string())), " ", MARK)
        cuts = self._separator(marked)
        # each chunk is a run of marks and what follows up to the next mark
        split = pc.split_pattern(pc.replace_substring_regex(marked, f"([^{MARK}]){MARK}", f"\\1{cuts}{MARK}"), cuts)
        per_text = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        ids = [self.chunk(x) for x in coded.dictionary.to_pylist()]
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.int32)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # an empty text has no mark and no ids of its own
        empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        lengths = np.where(np.repeat(empty, per_text), 0, sizes[index])
        starts = (np.cumsum(sizes) - sizes)[index]
        body = _ranges(flat, starts, lengths)
        inner = np.add.reduceat(np.append(lengths, 0), np.cumsum(per_text) - per_text) if len(per_text) else np.zeros(0, np.int64)
        total = inner + 2
        ends = np.cumsum(total)
        out = np.empty(int(total.sum()), np.int32)
        inside = np.ones(len(out), bool)
        inside[ends - 1] = inside[ends - total] = False
        out[inside] = body
        out[ends - 1], out[ends - total] = self.end, self.begin
        return out, total

    @staticmethod
    def _separator(marked: pa.Array) -> str:
        """A private-use character that none of the texts holds."""
        return next(c for c in map(chr, range(0xF0000, 0xFFFFE)) if not pc.any(pc.match_substring(marked, c)).as_py())

    def decode_all(self, ids: np.ndarray, lengths: np.ndarray) -> list[str]:
        """What each text's ids decode to."""
        if self.flat_bytes is None:
            self.byte_sizes = np.array([len(b) for b in self.piece_bytes])
            self.flat_bytes = np.frombuffer(b"".join(self.piece_bytes), np.uint8)
            self.marked = np.array([name.startswith(MARK) for name in self.names])
        sizes = self.byte_sizes[ids]
        starts = (np.cumsum(self.byte_sizes) - self.byte_sizes)[ids]
        joined = _ranges(self.flat_bytes, starts, sizes).tobytes()
        upto = np.concatenate([[0], np.cumsum(sizes)])
        out, at = [], 0
        for n in lengths.tolist():
            outer = [self.begin, self.end]
            first = next((i for i in ids[at : at + n] if i not in outer), None)
            skip = int(first is not None and self.marked[first])
            out.append(joined[upto[at] + skip : upto[at + n]].decode("utf-8", "replace"))
            at += n
        return out

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(np.array(ids, np.int64), np.array([len(ids)]))[0]


def _ranges(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[start : start + length] of every range, back to back."""
    ends = np.cumsum(lengths)
    places = np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
    return flat[places]


_tables: dict[str, PieceTable] = {}


def table(path: str) -> PieceTable:
    """The worker's table; kept between tasks."""
    if path not in _tables:
        _tables[path] = PieceTable(path)
    return _tables[path]


def default_model() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def encode_pieces(documents: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>, decoded string)."""
    path = model or default_model()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = table(path)
        for batch in batches:
            ids, lengths = tool.encode_all(batch.column("text"))
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
            yield pa.record_batch([batch.column("doc_id"), lists, pa.array(tool.decode_all(ids, lengths), pa.string())], names=["doc_id", "ids", "decoded"])
        tool.forget()

    return spread(plain_docs(documents)).mapInArrow(encode, "doc_id long, ids array<int>, decoded string")


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def piece_digests(documents: DataFrame, model: str | None = None) -> DataFrame:
    """One row per document: number of ids, and digests of the ids and of the text they decode to."""
    path = model or default_model()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = table(path)
        for batch in batches:
            ids, lengths = tool.encode_all(batch.column("text"))
            ends = np.cumsum(lengths)
            stored = ids.astype("<u4")
            coded = [hashlib.sha256(stored[b - n : b]).hexdigest() for b, n in zip(ends, lengths, strict=True)]
            decoded = [hashlib.sha256(x.encode()).hexdigest() for x in tool.decode_all(ids, lengths)]
            yield pa.record_batch([batch.column("doc_id"), pa.array(lengths), pa.array(coded, pa.string()), pa.array(decoded, pa.string())], names=[x.split()[0] for x in DIGEST.split(", ")])
        tool.forget()

    return spread(plain_docs(documents)).mapInArrow(digest, DIGEST)
