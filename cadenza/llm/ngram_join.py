"""N-gram Jaccard join by vertical partitioning, with the components and the number of its links.

Sets are the distinct five-word shingles of whole texts. Equal sets are one class from the start.

1. A census counts every shingle over all classes of a block and all blocks. A set of n shingles
   that has more than n // 4 to itself can't reach 75%; only the others keep their shared shingles.
2. A second census counts these among class representatives; that gives the global order (count,
   then hash) and each set's prefix, whose shingles index the candidates.
3. The global order is cut into fragments of about equal size, at counts taken from a histogram. Tasks
   of (cell of candidates, fragment) count partial overlaps, each fragment apart from the others;
   then the partial overlaps of every pair are summed and compared exactly.
4. A prefix shingle's sets are not paired with each other. Each round pairs the sets of a shingle
   with one leader and joins components; what is left are pairs between different components,
   which the last step finds inside its tasks, sending on lists of candidates. So no link that could
   join two components is missed, while pairs inside a component are not made.
5. All links lie within components. A large component whose prefix shingles are each in few sets, as in a
   chain, has few candidates: these are listed and verified like those of step 3. Any other is dealt to
   chunks, and every two chunks meet in one task. It adds up partial overlaps of rare shingles by their
   pairs and of common ones by products of membership matrices, and sends on counts, never pairs.

Defined results: a null, empty or wordless text has no shingles and links with nothing; rows
without doc_id are left out; of rows with equal doc_id the smallest text counts; a very long text is
one set of one block; an empty table gives an empty table; columns other than doc_id and text are
ignored by ``join`` and kept by ``keep_one``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .census import census, without_relays
from .common import block_count, bounded_batches, keyed_docs, mixed, one_per_id, packed, released, unpacked, word_hashes, words_of, written
from .components import components, thinned

WIDTH, LEAST, BLOCK_MB, STAR_ROUNDS, CELL_SETS, CHUNK, FRAGMENTS = 5, 75, 5, 3, 500, 2_048, 4
#: Sets of a component that one task holds twice, and how many of them a membership matrix has at a time.
DEALT, SLICE = 4_096, 1_024
#: Candidates are listed in a component of more than DEALT sets if they are at most so many a set, with at most CHUNK sets a shingle.
LISTED = 512
STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every distinct shingle of every row, in order of hash and then row."""
    words, index, sizes = words_of(texts.combine_chunks())
    stream = word_hashes(words)[index]
    row = np.repeat(np.arange(len(sizes)), sizes)
    total = max(0, len(stream) - WIDTH + 1)
    value = np.zeros(total, np.uint64)
    for j in range(WIDTH):
        value = value * STEP + stream[j : j + total]
    whole = row[:total] == row[WIDTH - 1 : WIDTH - 1 + total]
    hashes, rows = mixed(value[whole]), row[:total][whole]
    short = np.flatnonzero((sizes > 0) & (sizes < WIDTH))
    if len(short):
        starts = (np.cumsum(sizes) - sizes)[short]
        value = sizes[short].astype(np.uint64)
        for j in range(WIDTH - 1):
            there = sizes[short] > j
            value = np.where(there, value * STEP + stream[np.minimum(starts + j, len(stream) - 1)], value)
        hashes, rows = np.concatenate([hashes, mixed(value)]), np.concatenate([rows, short])
        by_row = np.argsort(rows, kind="stable")
        hashes, rows = hashes[by_row], rows[by_row]
    order = np.argsort(hashes, kind="stable")
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[new], rows[new]


def prefix_length(n: np.ndarray) -> np.ndarray:
    """A set of n that links shares one of any n - ceil(0.75 n) + 1 of its shingles that come first in the order."""
    return n - -(-n * LEAST // 100) + 1


def runs(sorted_hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct, count of each, place of every entry among the distinct)."""
    first = np.ones(len(sorted_hashes), bool)
    first[1:] = sorted_hashes[1:] != sorted_hashes[:-1]
    at = np.flatnonzero(first)
    return sorted_hashes[at], np.diff(np.append(at, len(sorted_hashes))), np.cumsum(first) - 1


CLASSES = "d1 long, d2 long, n long, doc_ids array<long>, core binary"


def classes(docs: DataFrame, block_mb: float) -> DataFrame:
    """Rows (d1, d2, n, doc_ids, core): per block, its documents with one set; core: the set's shared shingles, if it may link."""
    blocks = block_count(docs, block_mb)
    blocked = docs.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int"))

    def ask(table: pa.Table):
        hashes, rows = shingles(table.column("text"))
        by_row = np.argsort(rows, kind="stable")
        n = np.bincount(rows, minlength=table.num_rows)
        full = np.flatnonzero(n)
        starts = (np.cumsum(n) - n)[full]
        own = hashes[by_row]
        digest = np.zeros((table.num_rows, 2), np.uint64)
        if len(full):
            digest[full, 0] = np.add.reduceat(mixed(own), starts)
            digest[full, 1] = np.add.reduceat(mixed(own ^ STEP) * STEP, starts)
        _, first, of = np.unique(np.concatenate([digest, n[:, None].astype(np.uint64)], axis=1), axis=0, return_index=True, return_inverse=True)
        speaks = np.zeros(table.num_rows, bool)
        speaks[first] = True
        keep = speaks[rows]
        hashes, rows = hashes[keep], rows[keep]
        distinct, counts, place = runs(hashes)
        return distinct, counts, (hashes, rows, place, n, digest, first, of.reshape(-1))

    def finish(table: pa.Table, kept, distinct: np.ndarray, totals: np.ndarray) -> pa.Table:
        hashes, rows, place, n, digest, first, of = kept
        shared = totals[place] >= 2
        common = np.bincount(rows[shared], minlength=len(n))
        may = (n > 0) & (n - common < prefix_length(n))
        use = shared & may[rows]
        by_row = np.argsort(rows[use], kind="stable")
        own, sizes = hashes[use][by_row], np.where(may, common, 0)
        sizes[~np.isin(np.arange(len(n)), first)] = 0
        ends = np.cumsum(sizes)
        ids = np.array(table.column("doc_id").to_pylist(), np.int64)
        order = np.argsort(of, kind="stable")
        members = np.split(ids[order], np.cumsum(np.bincount(of, minlength=len(first)))[:-1]) if len(first) else []
        return pa.table(
            [
                pa.array(digest[first, 0].view(np.int64)), pa.array(digest[first, 1].view(np.int64)), pa.array(n[first]), pa.array(members, pa.list_(pa.int64())),
                pa.array([own[ends[r] - sizes[r] : ends[r]].tobytes() if may[r] else None for r in first], pa.binary()),
            ],
            names=["d1", "d2", "n", "doc_ids", "core"],
        )

    # counts only prune here, so six bytes of a hash do
    return census(blocked, blocks, ask, finish, CLASSES, 6, without_relays(blocks), staged=True)


ORDERED = "rep long, n long, ordered binary, ends array<int>, prefix array<long>, at array<int>"


def in_order(sets: DataFrame) -> DataFrame:
    """From (rep, n, core): the shared shingles in the global order, how many have counts of at most k bits, and the prefix."""
    entries = sets.agg(F.coalesce(F.sum(F.octet_length("core")), F.lit(0)).alias("b")).first()["b"]
    blocks = max(1, -(-entries // 6_000_000))
    blocked = sets.withColumn("block", F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int"))

    def ask(table: pa.Table):
        cores = [np.frombuffer(x, np.uint64) for x in table.column("core").to_pylist()]
        rows = np.repeat(np.arange(len(cores)), [len(c) for c in cores])
        hashes = np.concatenate(cores)
        order = np.argsort(hashes, kind="stable")
        hashes, rows = hashes[order], rows[order]
        distinct, counts, place = runs(hashes)
        return distinct, counts, (hashes, rows, place)

    def finish(table: pa.Table, kept, distinct: np.ndarray, totals: np.ndarray) -> pa.Table:
        hashes, rows, place = kept
        count = totals[place].astype(np.int64)
        shared = count >= 2
        hashes, rows, count = hashes[shared], rows[shared], count[shared]
        by_order = np.lexsort((hashes, count, rows))
        hashes, rows, count = hashes[by_order], rows[by_order], count[by_order]
        n = np.array(table.column("n").to_pylist(), np.int64)
        sizes = np.bincount(rows, minlength=len(n))
        single = n - sizes
        prefix = np.minimum(prefix_length(n) - single, sizes)
        bits = np.frexp(count.astype(np.float64))[1]
        ids, starts = table.column("rep").to_pylist(), np.cumsum(sizes) - sizes
        out = []
        for r in np.flatnonzero(prefix > 0):
            own = slice(starts[r], starts[r] + sizes[r])
            first = hashes[own][: prefix[r]].view(np.int64)
            places = np.arange(single[r], single[r] + len(first), dtype=np.int32)
            out.append((ids[r], int(n[r]), hashes[own].tobytes(), np.searchsorted(bits[own], np.arange(33), "right").astype(np.int32), first, places))
        columns = list(zip(*out, strict=True)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32())]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in ORDERED.split(", ")])

    return census(blocked, blocks, ask, finish, ORDERED, 8, without_relays(blocks), staged=True)


def pivots(cut: DataFrame, fragments: int = FRAGMENTS) -> list[int]:
    """Numbers of bits of a count at which the global order is cut, so that fragments hold about equally many entries."""
    upto = list(cut.agg(*(F.coalesce(F.sum(F.get("ends", F.lit(k))), F.lit(0)).alias(f"b{k}") for k in range(33))).first())
    return sorted({next(k for k in range(33) if upto[k] * fragments >= upto[-1] * f) for f in range(1, fragments)} - {32})


#: Candidates of one set: the others, their sizes and their component labels.
CANDIDATES = "a long, na long, bs array<long>, nbs array<long>, labels array<long>"
LINKS = "a long, b long"
PARTIAL = f"in_cell int, {CANDIDATES}, shared array<int>"


def enough(shared: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Whether 100 * intersection >= LEAST * union, from the intersection and the sum of both sizes."""
    return shared * (100 + LEAST) >= total * LEAST


def fragments_of(ordered: DataFrame, cuts: list[int]) -> DataFrame:
    """(cell, fragment, rep, segment) from (cell, rep, ordered, ends): each fragment's shingles in order of hash."""

    def cut(batches):
        for batch in batches:
            out = []
            for cell, rep, ordered, ends in zip(*(batch.column(c).to_pylist() for c in ("cell", "rep", "ordered", "ends")), strict=True):
                own = np.frombuffer(ordered, np.uint64)
                edges = [0, *(ends[k] for k in cuts), len(own)]
                out += [(cell, f, rep, np.sort(own[a:b]).tobytes()) for f, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.binary()), strict=True)], names=["at_cell", "at_fragment", "rep", "segment"])

    return ordered.mapInArrow(cut, "at_cell int, at_fragment int, rep long, segment binary")


def verified(made: DataFrame, cut: DataFrame, cuts: list[int], sets: int) -> DataFrame:
    """(a, b): of each set's candidates the links, one per component label.

    Sets are dealt to cells. A cell gets the segments that its candidates need once per fragment; a task
    counts one cell's partial overlaps in one fragment, and the last one sums them per pair.
    """
    cells = max(1, -(-sets // CELL_SETS))
    dealt = written(made.withColumn("cell", F.pmod(F.xxhash64("a"), F.lit(cells)).cast("int")), "candidates")

    def name(key: tuple, table: pa.Table) -> pa.Table:
        found = np.unique(np.concatenate([table.column("a").to_numpy(), table.column("bs").combine_chunks().flatten().to_numpy()]))
        return pa.table([pa.array(np.full(len(found), key[0].as_py(), np.int32)), pa.array(found)], names=["cell", "rep"])

    needed = dealt.groupBy("cell").applyInArrow(name, "cell int, rep long")
    there = fragments_of(needed.join(cut.select("rep", "ordered", "ends"), "rep"), cuts)
    asked = dealt.withColumn("fragment", F.explode(F.array(*(F.lit(f) for f in range(len(cuts) + 1)))))

    def count(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        segment = {rep: np.frombuffer(x, np.uint64) for rep, x in zip(right.column("rep").to_pylist(), right.column("segment").to_pylist(), strict=True)}
        none, lists = np.zeros(0, np.uint64), left.column("bs").combine_chunks()
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        all_bs, shared = lists.flatten().to_numpy(), np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
        for a, start, end in zip(left.column("a").to_pylist(), [0, *ends[:-1]], ends, strict=True):
            own = segment.get(a, none)
            if len(own):
                others = [segment.get(b, none) for b in all_bs[start:end].tolist()]
                flat = np.concatenate(others)
                at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
                shared[start:end] = np.bincount(np.repeat(np.arange(len(others)), [len(o) for o in others]), weights=own[at] == flat, minlength=len(others))
        offsets = pa.array(np.append(0, ends).astype(np.int32))
        first = key[1].as_py() == 0  # one fragment's rows bring what the sum compares with
        rest = [left.column(c).combine_chunks() if first else pa.nulls(left.num_rows, pa.list_(pa.int64())) for c in ("bs", "nbs", "labels")]
        columns = [pa.array([key[0].as_py()] * left.num_rows, pa.int32()), left.column("a").combine_chunks(), left.column("na").combine_chunks(), *rest, pa.ListArray.from_arrays(offsets, pa.array(shared))]
        return pa.table(columns, names=[x.split()[0] for x in PARTIAL.split(", ")])

    partial = asked.groupBy("cell", "fragment").cogroup(there.groupBy("at_cell", "at_fragment")).applyInArrow(count, PARTIAL)

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total: dict[int, np.ndarray] = {}
        for a, shared in zip(table.column("a").to_pylist(), table.column("shared").combine_chunks(), strict=True):
            total[a] = total.get(a, 0) + shared.values.to_numpy().astype(np.int64)
        out = []
        whole = table.filter(pc.is_valid(table.column("bs"))).combine_chunks()
        for a, na, bs, nbs, labels in zip(whole.column("a").to_pylist(), whole.column("na").to_pylist(), *(whole.column(c).chunk(0) if whole.num_rows else [] for c in ("bs", "nbs", "labels")), strict=True):
            linked = np.flatnonzero(enough(total[a], na + nbs.values.to_numpy()))
            _, first = np.unique(labels.values.to_numpy()[linked], return_index=True)
            out += [(a, b) for b in bs.values.to_numpy()[linked[first]].tolist()]
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return partial.groupBy("in_cell").applyInArrow(add, LINKS)


def between_components(named: DataFrame, divided: DataFrame, entries: int) -> DataFrame:
    """CANDIDATES between components that share a prefix shingle, found inside tasks.

    A shingle of more than CHUNK sets is split: every two chunks of its sets meet in a task of their own.
    """
    chunks = F.ceil(F.col("members") / CHUNK).cast("int")
    placed = named.join(divided.select("h", "members"), "h").withColumn("of", chunks).withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("of")).cast("int"))
    meets = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
    cells = max(1, -(-entries // 50_000))
    keyed = meets.select(
        F.when(F.col("of") == 1, F.pmod(F.xxhash64("h"), F.lit(cells))).otherwise(F.col("h")).alias("cell"), F.least("chunk", "with").alias("i"), F.greatest("chunk", "with").alias("j"),
        "h", "rep", "n", "at", "label", "chunk",
    )

    def pair(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("h", "ascending"), ("rep", "ascending")])
        h, rep, n, at, label, chunk = (table.column(c).to_numpy() for c in ("h", "rep", "n", "at", "label", "chunk"))
        i, j = key[1].as_py(), key[2].as_py()
        sets, where = np.unique(rep, return_inverse=True)
        size, of = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
        size[where], of[where] = n, label
        codes: list[np.ndarray] = [np.zeros(0, np.int64)]
        held = 0
        edges = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1], [True]]))
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            left = low + np.flatnonzero(chunk[low:high] == i)
            right = left if i == j else low + np.flatnonzero(chunk[low:high] == j)
            for k in range(0, len(left), 256):
                a, b = left[k : k + 256, None], right[None]
                # if this shingle is the first in common, no more can be shared than what follows it
                most = np.minimum(n[a] - at[a], n[b] - at[b])
                good = (label[a] != label[b]) & enough(most, n[a] + n[b])
                if i == j:
                    good &= rep[a] < rep[b]
                x, y = np.nonzero(good)
                codes.append(np.unique(where[a[x, 0]] * len(sets) + where[right[y]]))
                held += len(codes[-1])
                if held > max(4_000_000, 2 * len(codes[0])):  # the same pairs come back under other shingles
                    codes = [np.unique(np.concatenate(codes))]
                    held = len(codes[0])
        code = np.unique(np.concatenate(codes))
        a, b = code // max(1, len(sets)), code % max(1, len(sets))
        starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)
        offsets = pa.array(np.append(starts, len(a)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v[b])) for v in (sets, size, of)]
        return pa.table([pa.array(sets[a[starts]]), pa.array(size[a[starts]]), *lists], names=["a", "na", "bs", "nbs", "labels"])

    parts = keyed.groupBy("cell", "i", "j").applyInArrow(pair, CANDIDATES)
    # a set may meet another under several shingles
    one = parts.groupBy("a", "na").agg(F.array_distinct(F.flatten(F.collect_list(F.arrays_zip("bs", "nbs", "labels")))).alias("all"))
    return one.select("a", "na", *(F.col(f"all.{c}").alias(c) for c in ("bs", "nbs", "labels")))


def prefixes(cut: DataFrame) -> DataFrame:
    return written(cut.select("rep", "n", F.inline(F.arrays_zip(F.col("prefix").alias("h"), F.col("at").alias("at")))), "prefixes")


def overlaps(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], rows: int, others: int) -> np.ndarray:
    """[rows, others]: shared shingles of every two sets, from the (hash, row) of both sides in order of hash.

    Partial overlaps of rare shingles are added up pair by pair, those of common ones by matrix products.
    """
    out = np.zeros((rows, others), np.float32)
    (ha, ra), (hb, rb) = a, b
    common = np.intersect1d(ha, hb)
    sides = [(np.searchsorted(h, common), np.searchsorted(h, common, "right")) for h in (ha, hb)]
    (a0, a1), (b0, b1) = sides
    pairs = (a1 - a0) * (b1 - b0)
    dense = pairs * 200 > rows * others
    rare = np.flatnonzero(~dense)
    upto = np.cumsum(pairs[rare])
    at = 0
    while at < len(rare):  # a few million pairs at a time
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + 4_000_000, "right")))
        own = rare[at:stop]
        of = np.repeat(own, pairs[own])
        place = np.arange(len(of)) - np.repeat(np.cumsum(pairs[own]) - pairs[own], pairs[own])
        width = (b1 - b0)[of]
        np.add.at(out, (ra[a0[of] + place // width], rb[b0[of] + place % width]), 1)
        at = stop
    often = np.flatnonzero(dense)
    for at in range(0, len(often), 512):
        own = often[at : at + 512]
        x, y = np.zeros((rows, len(own)), np.float32), np.zeros((others, len(own)), np.float32)
        for matrix, of, low, high in ((x, ra, a0, a1), (y, rb, b0, b1)):
            size = (high - low)[own]
            column = np.repeat(np.arange(len(own)), size)
            matrix[of[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low[own], size)], column] = 1
        out += x @ y.T
    return out


COUNTS = "rep long, linked long"


def link_counts(labels: DataFrame, cut: DataFrame, sizes: DataFrame, dealt: int = DEALT) -> DataFrame:
    """(rep, linked): with how many documents of other classes a class's set links; classes without links are left out.

    ``labels`` (node, label) has the components of all links, ``sizes`` (rep, members) the documents of a class.
    """
    named = written(labels.select(F.col("node").alias("rep"), "label"), "named")
    chunks = named.groupBy("label").agg(F.ceil(F.count("*") / dealt).cast("int").alias("of"))
    placed = named.join(chunks, "label").join(sizes, "rep").join(cut.select("rep", "n", "ordered"), "rep")
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("of")).cast("int"))
    meets = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
    cells = max(1, -(-named.count() // CELL_SETS))
    # small components share a task
    keyed = meets.select(
        F.when(F.col("of") == 1, F.pmod(F.xxhash64("label"), F.lit(cells))).otherwise(F.col("label")).alias("cell"), F.least("chunk", "with").alias("i"), F.greatest("chunk", "with").alias("j"),
        "label", "chunk", "rep", "n", "members", "ordered",
    )

    def count(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("label", "ascending"), ("rep", "ascending")])
        label, chunk, rep, n, members = (table.column(c).to_numpy() for c in ("label", "chunk", "rep", "n", "members"))
        shingle = [np.frombuffer(x, np.uint64) for x in table.column("ordered").to_pylist()]
        linked = np.zeros(len(rep), np.int64)

        def entries(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            flat, of = np.concatenate([shingle[r] for r in rows]), np.repeat(np.arange(len(rows)), [len(shingle[r]) for r in rows])
            order = np.argsort(flat, kind="stable")
            return flat[order], of[order]

        edges = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1], [True]]))
        i, j = key[1].as_py(), key[2].as_py()
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            left = low + np.flatnonzero(chunk[low:high] == i)
            right = left if i == j else low + np.flatnonzero(chunk[low:high] == j)
            if not len(left) or not len(right):
                continue
            theirs = entries(right)
            for at in range(0, len(left), SLICE):
                own = left[at : at + SLICE]
                shared = overlaps(entries(own), theirs, len(own), len(right)).astype(np.int64)
                link = enough(shared, n[own][:, None] + n[right]) & (own[:, None] != right)
                linked[own] += link @ members[right]
                if i != j:
                    linked[right] += members[own] @ link
        found = np.flatnonzero(linked)
        return pa.table([pa.array(rep[found]), pa.array(linked[found])], names=["rep", "linked"])

    return keyed.groupBy("cell", "i", "j").applyInArrow(count, COUNTS).groupBy("rep").agg(F.sum("linked").alias("linked"))


def counted_links(labels: DataFrame, cut: DataFrame, sizes: DataFrame, dealt: int = DEALT, most: int = LISTED) -> DataFrame:
    """As ``link_counts``, with the work of a large component growing with its candidates where these are few.

    The sum of squares of a component's prefix shingles bounds its candidates before any is made.
    """
    large = written(labels.groupBy("label").agg(F.count("*").alias("sets")).where(F.col("sets") > dealt), "large")
    if large.isEmpty():
        return link_counts(labels, cut, sizes, dealt)
    named = labels.join(large, "label").select(F.col("node").alias("rep"), "label")
    entries = written(named.join(cut.select("rep", "n", "prefix"), "rep").select("label", "rep", "n", F.explode("prefix").alias("h")), "inside")
    met = entries.groupBy("label", "h").agg(F.count("*").alias("m")).groupBy("label").agg(F.sum(F.col("m") * F.col("m")).alias("pairs"), F.max("m").alias("most"))
    sparse = written(met.join(large, "label").where((F.col("pairs") <= most * F.col("sets")) & (F.col("most") <= CHUNK)).select("label", "sets"), "sparse")
    sets = sparse.agg(F.coalesce(F.sum("sets"), F.lit(0))).first()[0]
    if not sets:
        return link_counts(labels, cut, sizes, dealt)
    kept = entries.join(sparse.select("label"), "label")
    left, right = (kept.select("label", "h", F.col("rep").alias(r), F.col("n").alias(n)) for r, n in (("a", "na"), ("b", "nb")))
    near = (F.col("a") < F.col("b")) & (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * LEAST)
    listed = left.join(right, ["label", "h"]).where(near).groupBy("a", "na").agg(F.collect_set(F.struct("b", "nb")).alias("all"))
    # labels of their own, so that every link is told
    made = listed.select("a", "na", F.col("all.b").alias("bs"), F.col("all.nb").alias("nbs"), F.col("all.b").alias("labels"))
    links = written(verified(made, cut, pivots(cut), sets), "listed")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = both.join(sizes.withColumnRenamed("rep", "b"), "b").groupBy(F.col("a").alias("rep")).agg(F.sum("members").alias("linked"))
    return counts.unionByName(link_counts(labels.join(sparse, "label", "left_anti"), cut, sizes, dealt))


def links_between(cut: DataFrame, star_rounds: int = STAR_ROUNDS) -> DataFrame:
    """(a, b): verified links that join all that any links join."""
    spark = cut.sparkSession
    entries, cuts = prefixes(cut), pivots(cut)
    size = entries.agg(F.count("*").alias("entries"), F.count_distinct("rep").alias("sets")).first()
    links = spark.createDataFrame([], LINKS)
    for turn in range(star_rounds + 1):
        if turn:
            labels = components(links)
            named = entries.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
        else:
            named = entries.withColumn("label", F.col("rep"))
        # shingles whose sets are still in several components
        lead = F.min(F.struct(F.xxhash64("label", F.lit(turn)), "rep", "n", "label"))
        divided = named.groupBy("h").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("members"), lead.alias("lead")).where("x != y")
        divided = written(divided, "divided")
        if divided.isEmpty():
            break
        if turn < star_rounds:
            leads = divided.select("h", F.col("lead.rep").alias("b"), F.col("lead.n").alias("nb"), F.col("lead.label").alias("other"))
            near = F.least("n", "nb") * 100 >= F.greatest("n", "nb") * LEAST
            pairs = named.join(leads, "h").where((F.col("label") != F.col("other")) & near)
            # a set has at most one leader per shingle of its prefix
            listed = pairs.groupBy(F.col("rep").alias("a"), F.col("n").alias("na")).agg(F.collect_set(F.struct("b", "nb", "other")).alias("all"))
            made = listed.select("a", "na", F.col("all.b").alias("bs"), F.col("all.nb").alias("nbs"), F.col("all.other").alias("labels"))
        else:
            made = between_components(named, divided, size["entries"])
        links = links.unionByName(thinned(written(verified(made, cut, cuts, size["sets"]), "links")))
        released(spark)
    return links


def labelled(docs: DataFrame, block_mb: float = BLOCK_MB, counted: bool = False) -> DataFrame:
    """From (doc_id, text) without nulls or repeated ids: (doc_id, n_shingles, component_id, class_id), and n_links if ``counted``."""
    rows = written(classes(docs, block_mb), "classes")
    released(docs.sparkSession)  # the texts and messages of the census
    reps = rows.groupBy("d1", "d2", "n").agg(F.min(F.array_min("doc_ids")).alias("rep"), F.max("core").alias("core"), F.sum(F.size("doc_ids")).alias("members"))
    known = written(reps, "reps")
    cut = written(in_order(known.where("core is not null").select("rep", "n", "core")), "ordered")
    released(docs.sparkSession)
    links = links_between(cut)
    labels = components(links)
    named = known.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    others = [F.col("n").alias("n_shingles"), "label", "rep"]
    if counted:
        named = named.join(written(counted_links(labels, cut, known.select("rep", "members")), "counts"), "rep", "left").withColumn("n_links", F.coalesce("linked", F.lit(0)) + F.col("members") - 1)
        others.append("n_links")
    listed = rows.select("d1", "d2", "n", "doc_ids").join(named.drop("core"), ["d1", "d2", "n"]).select(F.explode("doc_ids").alias("doc_id"), *others)
    alone = F.col("n_shingles") == 0
    found = [F.when(alone, F.col("doc_id")).otherwise(F.col("label")).alias("component_id"), F.when(alone, F.col("doc_id")).otherwise(F.col("rep")).alias("class_id")]
    if counted:
        found.append(F.when(alone, 0).otherwise(F.col("n_links")).cast("long").alias("n_links"))
    return listed.select("doc_id", "n_shingles", *found)


def join(documents: DataFrame, block_mb: float = BLOCK_MB) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id, n_links).

    class_id is the smallest doc_id with the same set, n_links how many other documents reach 75% with this one, same sets among them.
    """
    return labelled(one_per_id(keyed_docs(documents)), block_mb, counted=True)


def keep_one(documents: DataFrame) -> DataFrame:
    """``documents`` with one row of each component: that with the smallest doc_id, without doc_id only if all are.

    Rows are compared under a written number of their own, so rows without doc_id and with a repeated one count each.
    """
    bounded_batches(documents.sparkSession)
    whole = written(packed(documents).withColumn("row", F.monotonically_increasing_id()), "rows")
    found = labelled(whole.select(F.col("row").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))).select(F.col("doc_id").alias("row"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row"))
    stay = found.join(whole.select("row", "doc_id"), "row").groupBy("component_id").agg(first.alias("first")).select(F.col("first.row").alias("stay"))
    kept = whole.join(stay.hint("shuffle_hash"), F.col("row") == F.col("stay"))
    return unpacked(kept, documents.columns)


#: DuckDB: all overlaps by a join on shingles, components by reachability, links counted.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w
), n AS (SELECT w.doc_id, count(s) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY 1),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
p AS (SELECT a, b, c, x.n AS na, y.n AS nb FROM o JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id),
l AS (SELECT a, b FROM p WHERE 100 * c >= 75 * (na + nb - c)),
r AS (SELECT doc_id, doc_id AS to_id FROM n UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.to_id = l.a),
k AS (SELECT a AS doc_id, min(b) AS same FROM p WHERE c = na AND c = nb GROUP BY 1)
SELECT n.doc_id, n.n AS n_shingles, min(to_id) AS component_id, least(n.doc_id, any_value(coalesce(same, n.doc_id))) AS class_id, coalesce(any_value(g.n_links), 0)::BIGINT AS n_links
FROM n JOIN r ON n.doc_id = r.doc_id LEFT JOIN k ON n.doc_id = k.doc_id LEFT JOIN (SELECT a, count(*) AS n_links FROM l GROUP BY 1) g ON n.doc_id = g.a GROUP BY n.doc_id, n.n
"""
