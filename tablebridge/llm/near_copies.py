"""N-gram Jaccard join with signature trees.

A document's set is its distinct shingles of ``words`` words; documents link when the sets share
at least ``percent`` of their union. The join is exact (sets are kept as 64-bit hashes) and goes
from cheap to dear:

1. Documents with equal sets are one node, whatever their number.
2. Every node gets a bitmap of its shingles, two bits or more for each, and a prefix: the least of its shingles in an
   order that puts frequent ones last. Linked nodes share a shingle of their prefixes.
   Frequencies come from counts over all documents in a table of fixed size; they only
   shape the order, so their being approximate costs no link.
3. Nodes that share a prefix shingle meet in the cell of the least such node. Of the cells that
   two nodes share the least one decides about them. A cell's nodes form a signature tree: each
   tree node holds the OR (and the AND) of the bitmaps below it and the range of set sizes. Two
   tree nodes are traversed together and left when the largest overlap that bitmaps and sizes
   allow is below what a link needs. Bitmaps of one width make one tree; it also holds the next
   wider ones folded to that width, as linked sets are at most one width apart. The nodes that
   remain possible partners form groups.
4. The texts of those nodes alone are fetched, once for each group. There the trees are traversed
   again, pairs are compared exactly, the most alike first, and pairs that links connect already
   are left out. So a group gives a forest of links, fewer than it has nodes, however many of
   its pairs link.
5. A cell of more than CELL nodes or SHINGLES shingles is cut into blocks. First each block is a
   cell; then, among the cells whose nodes are not one component yet, every pair of blocks that
   are not one component is a cell for the pairs across. So no task holds an unbounded cell, and
   a large group of near copies is one component before its blocks meet.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A null or wordless text has an empty
set, links with nothing and is its own component. Repeated rows and ids get a result each;
a null id never names a component unless it has no other. Other columns pass through
``drop_near_copies`` whatever their names are; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.batches import small_batches, stage, tidy
from tablebridge.llm.components import components
from tablebridge.llm.words import SPACED, chunks, mixed, shingle_sets, split_words

SHINGLE = 4
PERCENT = 85
BITS = 512  # of the narrowest bitmaps
SLOT_BITS = 22  # the table of frequencies has four million slots
LIVE_BITS = 24  # filters of fixed size, two megabytes
OFTEN = 3  # a shingle of fewer documents in a batch is not counted there
CELL = 4096  # nodes
SHINGLES = 4_000_000  # of a cell's nodes together
FANOUT = 4
PAIRS_AT_ONCE = 8192  # of narrow bitmaps, and at most so many
PAIR_BYTES = 2 << 20  # of the bitmaps on either side of the pairs that are looked at together
PAIRS_IN_ORDER = 100_000  # possible pairs that are compared by likeness


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, values, edges, sizes) of a few megabytes of texts; row i has the set values[edges[i]:edges[i + 1]]."""
    for batch in batches:
        for a, b, data, offsets in chunks(batch.column("text")):
            values, edges = shingle_sets(split_words(data, offsets, SPACED), words)
            yield batch.slice(a, b - a), values, edges, np.diff(edges)


def _top(values: np.ndarray, bits: int) -> np.ndarray:
    return (values >> np.uint64(64 - bits)).astype(np.int64)


def _key(own: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def _packed_bits(values: np.ndarray) -> np.ndarray:
    """The bitmap of one set, as 64-bit words; its width is a power of two."""
    width = max(BITS, 1 << (2 * len(values) - 1).bit_length())
    bits = np.zeros(width, dtype=bool)
    bits[(values & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits).view(np.uint64)


def frequencies(docs: DataFrame, words: int) -> np.ndarray:
    """log2 of the counts of frequent shingles by slot; four megabytes, whatever the input."""

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counted() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            often = n >= OFTEN
            return pa.RecordBatch.from_pydict({"slot": pa.array(_top(values[often], SLOT_BITS), pa.int64()), "n": pa.array(n[often], pa.int64())})

        for _, values, _, _ in _sets(batches, words):
            held.append(values)
            if sum(map(len, held)) >= 2_000_000:
                yield counted()
        if held:
            yield counted()

    counts = docs.select("text").mapInArrow(tidy(frequent), "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    # Eight slots are one number, so the driver reads half a million rows at most.
    level = "shiftleft(CAST(length(bin(n)) AS BIGINT), CAST(8 * (slot % 8) AS INT))"
    packed = counts.groupBy(F.shiftright("slot", 3).alias("at")).agg(F.expr(f"bit_or({level})").alias("word"))
    rows = packed.toArrow()
    out = np.zeros(1 << SLOT_BITS - 3, dtype="<i8")
    out[rows.column("at").to_numpy()] = rows.column("word").to_numpy()
    return out.view(np.uint8)


def signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Per document: doc_id, n, key (null without words), bits and prefix.

    ``prefix`` stands on the first document of a key in a task only, empty on the others.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequencies(docs, words))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level_of, seen = shared.value, set()
        for rows, values, edges, n in _sets(batches, words):
            text = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((values, level_of[_top(values, SLOT_BITS)], text))
            rank = np.arange(len(values)) - np.repeat(edges[:-1], n)
            width = n - -(-percent * n // 100) + 1
            prefix = values[order].view(np.int64)
            in_prefix = rank < np.repeat(width, n)
            keys, bits, prefixes = [], [], []
            for i in range(len(n)):
                own = slice(edges[i], edges[i + 1])
                key = _key(values[own]) if n[i] else None
                new = key is not None and key not in seen
                keys.append(key)
                bits.append(_packed_bits(values[own]).tobytes() if new else b"")
                prefixes.append(prefix[own][in_prefix[own]] if new else [])
                seen.add(key)
            yield pa.RecordBatch.from_pydict({
                "doc_id": rows.column("doc_id"), "n": pa.array(n, pa.int64()), "key": pa.array(keys, pa.int64()),
                "bits": pa.array(bits, pa.binary()), "prefix": pa.array(prefixes, pa.list_(pa.int64()))})

    return docs.select("doc_id", "text").mapInArrow(tidy(sign), f"doc_id {kind}, n bigint, key bigint, bits binary, prefix array<bigint>")


def slot_filter(values: DataFrame, bits: int = LIVE_BITS) -> np.ndarray:
    """A packed bitmap of the top bits of one long column; its size does not depend on the input."""
    slots = values.select(F.shiftrightunsigned(values.columns[0], 64 - bits).alias("s"))
    # The executors pack 64 slots into a number, so the driver reads 2 ** (bits - 6) rows at most.
    rows = slots.groupBy(F.shiftright("s", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, CAST(s % 64 AS INT)))").alias("word")).toArrow()
    out = np.zeros(1 << bits - 6, dtype="<i8")
    out[rows.column("at").to_numpy()] = rows.column("word").to_numpy()
    return out.view(np.uint8)


def _unpacked(packed: np.ndarray) -> np.ndarray:
    return np.unpackbits(packed, bitorder="little").astype(bool)


class Groups:
    """Which rows are connected: a label for each, and the rows of each label."""

    def __init__(self, labels: np.ndarray):
        _, self.label = np.unique(labels, return_inverse=True)
        order = np.argsort(self.label, kind="stable")
        edges = np.searchsorted(self.label[order], np.arange(self.label.max(initial=-1) + 2))
        self.rows = [order[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def unite(self, x: int, y: int) -> None:
        a, b = self.label[x], self.label[y]
        if len(self.rows[a]) < len(self.rows[b]):
            a, b = b, a
        self.label[self.rows[b]] = a
        self.rows[a] = np.concatenate([self.rows[a], self.rows[b]])
        self.rows[b] = self.rows[b][:0]

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return self.label[i] != self.label[j]


class SignatureTrees:
    """The trees of many cells at once, level by level; level 0 holds the nodes themselves."""

    def __init__(self, cell: np.ndarray, n: np.ndarray, comp: np.ndarray, bits: np.ndarray, percent: int):
        self.percent = percent
        self.levels = [{"cell": cell, "any": bits, "all": bits, "low": n, "high": n, "from": comp, "to": comp}]
        while True:
            x = self.levels[-1]
            new_cell = np.ones(len(x["cell"]), dtype=bool)
            new_cell[1:] = x["cell"][1:] != x["cell"][:-1]
            if new_cell.all():
                break
            at = np.arange(len(new_cell))
            rank = at - np.maximum.accumulate(np.where(new_cell, at, 0))
            first = np.flatnonzero(rank % FANOUT == 0)
            self.levels.append({
                "cell": x["cell"][first], "any": np.bitwise_or.reduceat(x["any"], first), "all": np.bitwise_and.reduceat(x["all"], first),
                "low": np.minimum.reduceat(x["low"], first), "high": np.maximum.reduceat(x["high"], first),
                "from": np.minimum.reduceat(x["from"], first), "to": np.maximum.reduceat(x["to"], first),
                "first": first, "count": np.diff(np.append(first, len(new_cell)))})

    def _possible(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether two nodes of different components below i and j could link."""
        x, percent = self.levels[level], self.percent
        same = (x["from"][i] == x["to"][i]) & (x["from"][j] == x["to"][j]) & (x["from"][i] == x["from"][j])
        sized = (100 * x["high"][i] >= percent * x["low"][j]) & (100 * x["high"][j] >= percent * x["low"][i])
        need = -(-percent * (x["low"][i] + x["low"][j]) // (100 + percent))
        # Bits that all sets of one side have and none of the other stand for a shingle each that can't be common.
        most = np.minimum(x["high"][i] - np.bitwise_count(x["all"][i] & ~x["any"][j]).sum(axis=1, dtype=np.int64),
                          x["high"][j] - np.bitwise_count(x["all"][j] & ~x["any"][i]).sum(axis=1, dtype=np.int64))
        return ~same & ((i == j) | (sized & (most >= need)))

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        most = max(1, min(PAIRS_AT_ONCE, PAIR_BYTES // max(1, self.levels[0]["any"].itemsize * self.levels[0]["any"].shape[1])))
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top]["cell"]))
        todo = [(top, roots, roots)]
        while todo:
            level, i, j = todo.pop()
            if len(i) > most:
                todo += [(level, i[k:k + most], j[k:k + most]) for k in range(0, len(i), most)]
                continue
            possible = self._possible(level, i, j)
            i, j = i[possible], j[possible]
            if not level:
                apart = i < j
                yield i[apart], j[apart]
            elif len(i):
                x = self.levels[level]
                step = np.arange(FANOUT * FANOUT)
                a, b = (step // FANOUT)[None, :], (step % FANOUT)[None, :]
                real = (a < x["count"][i][:, None]) & (b < x["count"][j][:, None]) & ((i != j)[:, None] | (a <= b))
                todo.append((level - 1, (x["first"][i][:, None] + a)[real], (x["first"][j][:, None] + b)[real]))


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by ``cell``, cut anew so that no cell is in two of them."""
    held: list[pa.RecordBatch] = []

    def joined() -> Iterator[pa.RecordBatch]:
        if held:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()
            held.clear()
            yield from rows

    for batch in batches:
        cells = batch.column("cell").to_numpy()
        if not len(cells):
            continue
        if held and held[-1].column("cell")[-1].as_py() != cells[0]:
            yield from joined()
        last = np.flatnonzero(cells != cells[-1])
        cut = int(last[-1]) + 1 if last.size else 0
        if cut:
            held.append(batch.slice(0, cut))
            yield from joined()
        held.append(batch.slice(cut))  # its last cell may go on in the next batch
    yield from joined()


class Meeting:
    """The nodes of whole cells (cell, owner, block, across, key, n, comp, owners), with a bitmap each."""

    def __init__(self, rows: pa.RecordBatch, bits: list[np.ndarray], percent: int):
        self.cell, self.key = rows.column("cell").to_numpy(), rows.column("key").to_numpy()
        self.owner, self.block = rows.column("owner").to_numpy(), rows.column("block").to_numpy()
        self.across = rows.column("across").to_numpy(zero_copy_only=False)
        self.owners = rows.column("owners").to_pylist()
        self.sets: dict[int, frozenset] = {}
        self.n, self.comp, self.bits, self.percent = rows.column("n").to_numpy(), rows.column("comp").to_numpy(), bits, percent
        # A component counts for itself in every cell.
        self.groups = Groups(np.unique(np.stack([self.cell, self.comp]), axis=1, return_inverse=True)[1].reshape(-1))

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows of possible partners, and the bits that differ."""
        width = np.array([len(b) for b in self.bits], dtype=np.int64)
        for words in np.unique(width).tolist():
            chosen = np.flatnonzero((width == words) | (width == 2 * words))
            own = width[chosen] == words
            bits = np.stack([b if len(b) == words else b[:words] | b[words:] for b in (self.bits[k] for k in chosen.tolist())])
            for i, j in SignatureTrees(self.cell[chosen], self.n[chosen], self.comp[chosen], bits, self.percent).pairs():
                new = own[i] | own[j]  # two wider ones have a tree of their own
                i, j = i[new], j[new]
                yield chosen[i], chosen[j], np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64)

    def decides(self, x: int, y: int) -> bool:
        """Whether this cell is the one that compares two of its nodes."""
        if self.across[x] and self.block[x] == self.block[y]:
            return False
        for i in (x, y):
            if i not in self.sets:
                self.sets[i] = frozenset(self.owners[i])
        return min(self.sets[x] & self.sets[y]) == self.owner[x]

    def undecided(self, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[int, int]]:
        apart = self.groups.apart(i, j)
        for x, y in zip(i[apart].tolist(), j[apart].tolist(), strict=True):
            if self.groups.label[x] != self.groups.label[y] and self.decides(x, y):
                yield x, y


def _partners(percent: int) -> Callable:
    """Rows of cells to those nodes that have a possible partner; ``cell`` then names a group of such nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_cells(batches):
            met = Meeting(rows, [np.frombuffer(b.as_buffer(), dtype=np.uint64) for b in rows.column("bits")], percent)
            partner = np.zeros(rows.num_rows, dtype=bool)
            for i, j, _ in met.pairs():
                for x, y in met.undecided(i, j):
                    met.groups.unite(x, y)
                    partner[[x, y]] = True
            # Members of a component that has a partner all stay: any of them may hold the link.
            wide = np.zeros(len(met.groups.rows), dtype=bool)
            wide[met.groups.label[partner]] = True
            kept = np.flatnonzero(wide[met.groups.label])
            root = np.array([met.key[met.groups.rows[g][0]] for g in met.groups.label[kept]], dtype=np.int64)
            group = mixed(met.cell[kept].view(np.uint64) ^ mixed(root.view(np.uint64)))
            yield pa.RecordBatch.from_pydict({
                "cell": pa.array(group.view(np.int64)), **{c: rows.column(c).take(pa.array(kept)) for c in ("owner", "block", "across", "key", "comp")}})

    return run


def _forest(words: int, percent: int) -> Callable:
    """Rows of groups, with the texts, to links (a, b) that connect what is linked in a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_cells(batches):
            own = [values[a:b] for _, values, edges, _ in _sets([rows], words) for a, b in zip(edges[:-1], edges[1:], strict=True)]
            met = Meeting(rows, [_packed_bits(x) for x in own], percent)
            links: list[tuple[int, int]] = []

            def compare(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
                i, j, unlike = (np.concatenate(x) for x in zip(*found, strict=True))
                order = np.argsort(unlike, kind="stable")
                for k in range(0, len(order), PAIRS_AT_ONCE):
                    part = order[k:k + PAIRS_AT_ONCE]
                    for x, y in met.undecided(i[part], j[part]):
                        p, q = own[x], own[y]
                        common = len(np.intersect1d(p, q, assume_unique=True))
                        if 100 * common >= percent * (len(p) + len(q) - common):
                            met.groups.unite(x, y)
                            links.append((int(met.key[x]), int(met.key[y])))

            found, n = [], 0
            for pairs in met.pairs():
                found.append(pairs)
                n += len(pairs[0])
                if n >= PAIRS_IN_ORDER:
                    compare(found)
                    found, n = [], 0
            if n:
                compare(found)
            yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return run


def meeting_nodes(signed: DataFrame) -> DataFrame:
    """Per node that shares a prefix shingle: key, n, bits and owners, the names of its cells."""
    nodes = signed.filter(F.size("prefix") > 0)
    live = stage(
        nodes.select(F.explode("prefix").alias("shingle"), "key").groupBy("shingle")
        .agg(F.min("key").alias("owner"), F.max("key").alias("other")).filter("owner < other").select("shingle", "owner"), "live")
    shared = signed.sparkSession.sparkContext.broadcast(slot_filter(live.select("shingle")))

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = _unpacked(shared.value)
        for batch in batches:
            prefix = batch.column("prefix")
            row = np.repeat(np.arange(batch.num_rows), prefix.value_lengths().to_numpy())
            values = prefix.flatten().to_numpy()
            good = keep[_top(values.view(np.uint64), LIVE_BITS)]
            yield pa.RecordBatch.from_pydict({"shingle": pa.array(values[good]), "key": batch.column("key").take(pa.array(row[good]))})

    owners = (nodes.select("key", "prefix").mapInArrow(tidy(passing), "shingle bigint, key bigint").join(live, "shingle")
              .select("owner", "key").distinct().groupBy("key").agg(F.collect_list("owner").alias("owners")))
    once = nodes.groupBy("key").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))  # several tasks may hold a key
    return stage(owners.join(once, "key"), "nodes")


def wanted_texts(docs: DataFrame, signed: DataFrame, keys: DataFrame, words: int) -> DataFrame:
    """(key, text) of some keys, from one document each; a text is smaller than its shingles."""
    spark = docs.sparkSession
    holders = signed.filter(F.size("prefix") > 0).select("key", "doc_id").join(keys, "key", "left_semi").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    shared = spark.sparkContext.broadcast(slot_filter(holders.select(F.xxhash64("doc_id"))))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        live = _unpacked(shared.value)

        def passing() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(live[_top(batch.column("h").to_numpy().view(np.uint64), LIVE_BITS)]))

        seen = set()
        for rows, values, edges, n in _sets(passing(), words):
            found, at = [], []
            for i in np.flatnonzero(n):
                if (key := _key(values[edges[i]:edges[i + 1]])) not in seen:
                    seen.add(key)
                    found.append(key)
                    at.append(int(i))
            yield pa.RecordBatch.from_pydict({"key": pa.array(found, pa.int64()), "text": rows.column("text").take(pa.array(at, pa.int64()))})

    # A set that two tasks held stands in its groups twice, as one component.
    return stage(docs.select("text", F.xxhash64("doc_id").alias("h")).mapInArrow(tidy(texts), "key bigint, text string"), "texts")


def linked(cells: DataFrame, nodes: DataFrame, docs: DataFrame, signed: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) that connect what is linked in ``cells`` (cell, owner, block, across, key, comp)."""
    known = nodes.select("key", "n", "owners")
    signs = cells.join(nodes, "key").repartition("cell").sortWithinPartitions("cell", "comp", "n")
    groups = stage(signs.mapInArrow(tidy(_partners(percent)), "cell bigint, owner bigint, block int, across boolean, key bigint, comp bigint"), "groups")
    texts = wanted_texts(docs, signed, groups.select("key").distinct(), words)
    with small_batches(docs.sparkSession):
        full = groups.join(known, "key").join(texts, "key").repartition("cell").sortWithinPartitions("cell", "comp", "n")
        return stage(full.mapInArrow(tidy(_forest(words, percent)), "a bigint, b bigint"), "links")


def near_copies(docs: DataFrame, words: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the least doc_id that links reach."""
    signed = stage(signatures(docs, words, percent), "signatures")
    nodes = meeting_nodes(signed)
    places = nodes.select(F.explode("owners").alias("owner"), "key", "n")
    blocks = F.greatest(F.ceil(F.count("*") / CELL), F.ceil(F.sum("n") / SHINGLES)).cast("int")
    sizes = stage(places.groupBy("owner").agg(blocks.alias("blocks")), "sizes")
    placed = places.join(sizes, "owner").select("owner", "key", "blocks", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("block"))
    cell = F.when(F.col("blocks") == 1, F.col("owner")).otherwise(F.xxhash64("owner", "block"))
    links = linked(placed.select(cell.alias("cell"), "owner", "block", F.lit(False).alias("across"), "key", F.col("key").alias("comp")),
                   nodes, docs, signed, words, percent)
    groups = components(links).select(F.col("node").alias("key"), F.col("component").alias("comp"))
    if sizes.filter("blocks > 1").limit(1).count():
        members = stage(placed.filter("blocks > 1").join(groups, "key", "left").withColumn("comp", F.coalesce("comp", "key")), "cut")
        spans = members.groupBy("owner", "block").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
        both = spans.join(spans.toDF("owner", "other", "other_low", "other_high"), "owner").filter("block < other").filter(
            F.least("low", "other_low") < F.greatest("high", "other_high"))
        pairs = stage(both.select("owner", F.xxhash64("owner", "block", "other").alias("cell"), F.explode(F.array("block", "other")).alias("block")), "block_pairs")
        more = linked(members.join(pairs, ["owner", "block"]).select("cell", "owner", "block", F.lit(True).alias("across"), "key", "comp"),
                      nodes, docs, signed, words, percent)
        groups = components(links.union(more)).select(F.col("node").alias("key"), F.col("component").alias("comp"))
    placed = stage(
        signed.select("doc_id", "n", "key").join(groups, "key", "left").select("doc_id", "n", F.coalesce("comp", "key").alias("comp")), "placed")
    least = stage(placed.filter("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
                  .filter("copies > 1").drop("copies"), "least")
    return placed.join(least, "comp", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("first", "doc_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, words: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each group of near copies, the one with the least doc_id; columns unchanged.

    Of rows with equal ids in one group all stay or go together; rows with a null id stay.
    """
    # Written first, so that Spark knows its size when it chooses how to join.
    gone = stage(near_copies(docs, words, percent).filter("doc_id > component_id").select(F.col("doc_id").alias("id")).distinct(), "gone")
    rows = docs.select(F.struct("*").alias("row"))
    return rows.join(gone, F.col("row.doc_id") == F.col("id"), "left_anti").select("row.*")
