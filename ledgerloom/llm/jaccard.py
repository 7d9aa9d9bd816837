"""N-gram Jaccard join: documents whose word shingles overlap enough, as components.

A document's shingles are hashed into groups. Its group counts are a point, and the
overlap of two documents is at most the sum of the smaller counts per group, which
prunes pairs of points and pairs of rectangles in an R-tree of points; what survives
is compared shingle by shingle.

So that trees can be built apart from each other, documents are first brought
together by whole groups: with more groups than two linked documents can differ in
shingles, at least one group is the same in both. Equal groups give clusters that no
link leaves, and each cluster has a tree of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import (
    give_back_memory,
    mixed,
    released,
    sent,
    span_hashes,
    text_slices,
    word_spans,
    written,
)
from ledgerloom.llm.graph import components

WORDS = 3
# Linked when 100 * intersection >= THRESHOLD * union.
THRESHOLD = 90
# Bands of sizes grow by half, so below this a partner may be two bands away.
LEAST_THRESHOLD = 67

# Dimensions of the points, and entries of a tree node.
GROUPS = 32
FANOUT = 32
# Distinct sets compared in one piece; larger clusters are worked on in pages.
PAGE_SETS = 512
# Bits of the map of clustered sets that every task gets (2 MB).
GATE_BITS = 1 << 24
# Group keys held before they are combined and handed on.
HELD_KEYS = 1 << 20


# --- sets ------------------------------------------------------------------------


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of a slice's rows, and where each row's begin.

    Only A to Z are lower-cased. A row of one or two words has them as one shingle.
    """
    upper = (data >= 65) & (data <= 90)
    begin, end, row = word_spans(data, offsets)
    words = span_hashes(np.where(upper, data + 32, data).astype(np.uint8), begin, end)
    n = len(offsets) - 1
    per_row = np.bincount(row, minlength=n)
    first = np.concatenate([[0], np.cumsum(per_row)])
    made: list[np.ndarray] = []
    if len(words) >= WORDS:
        whole = np.zeros(len(words) - WORDS + 1, np.uint64)
        for i in range(WORDS):
            whole = mixed(whole + words[i:len(words) - WORDS + 1 + i] * np.uint64(2 * i + 3))
    else:
        whole = np.zeros(0, np.uint64)
    for r in range(n):
        a, b = first[r], first[r + 1]
        if b - a >= WORDS:
            found = np.sort(whole[a:b - WORDS + 1])
            if len(found) > 1:
                found = found[np.concatenate([[True], found[1:] != found[:-1]])]
        elif b > a:
            found = np.array([b - a], np.uint64)
            for i in range(a, b):
                found = mixed(found + words[i:i + 1])
        else:
            found = np.zeros(0, np.uint64)
        made.append(found)
    starts = np.concatenate([[0], np.cumsum([len(m) for m in made])]).astype(np.int64)
    return (np.concatenate(made) if made else np.zeros(0, np.uint64)), starts


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Wrapping sums of the rows' values."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[starts[1:]] - total[starts[:-1]]


def set_keys(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys per row, equal for equal sets."""
    n = np.diff(starts).astype(np.uint64)
    one = mixed(_sums(mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)), starts) + n)
    two = mixed(_sums(mixed(hashes + np.uint64(0x14057B7EF767814F)), starts) ^ n)
    return one.view(np.int64), two.view(np.int64)


# --- group keys ------------------------------------------------------------------


@cache
def bands(threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First size, number of groups and spare groups of each band of set sizes.

    Two linked sets of which the smaller is in the band differ in at most ``most``
    shingles, each of which spoils one group at most. One group more, and a few to
    spare for groups that hold no shingle, and an equal group with content is certain
    for any set with no more empty groups than were spared.
    """
    firsts, groups, spare = [], [], []
    low = 1
    while low < 1 << 40:
        high = max(low, low * 3 // 2 - 1)
        larger = high * 100 // threshold
        most = (high + larger) * (100 - threshold) // (100 + threshold)
        best = 0
        for extra in range(64):
            count = most + 1 + extra
            if count == 1:
                break
            mean = count * math.exp(low * math.log1p(-1 / count))
            term = tail = math.exp(-mean)
            for i in range(1, extra + 1):
                term *= mean / i
                tail += term
            best = extra
            if 1 - tail < 1e-4:
                break
        firsts.append(low)
        groups.append(most + 1 + best)
        spare.append(best)
        low = high + 1
    return np.array(firsts, np.int64), np.array(groups, np.int64), np.array(spare, np.int64)


def group_keys(
    hashes: np.ndarray, starts: np.ndarray, threshold: int
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of which two linked rows share at least one, and the row of each key.

    A row takes the groups of its own band and, where a smaller partner may be in the
    band below, of that one. Rows with too many empty groups also give the shingles of
    which linked rows share one: the lowest by hash, as many as may be missing and one.
    """
    firsts, groups, spare = bands(threshold)
    sizes = np.diff(starts)
    rows = np.flatnonzero(sizes)
    keys: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    own = np.searchsorted(firsts, sizes, "right") - 1
    smallest = -(-sizes * threshold // 100)
    below = np.searchsorted(firsts, smallest, "right") - 1
    sparse = np.zeros(len(sizes), bool)
    of_row = np.repeat(np.arange(len(sizes)), sizes)
    contents = mixed(hashes + np.uint64(0x2545F4914F6CDD1D))
    for band, wanted in ((own, sizes > 0), (below, (sizes > 0) & (below < own))):
        count = np.where(wanted, groups[band], 0)
        base = np.concatenate([[0], np.cumsum(count)])
        if not base[-1]:
            continue
        held = wanted[of_row]
        owner = of_row[held]
        place = base[owner] + (hashes[held] % count[owner].astype(np.uint64)).astype(np.int64)
        total = np.zeros(base[-1], np.uint64)
        np.add.at(total, place, contents[held])
        full = np.bincount(place, minlength=base[-1]) > 0
        group_of = np.repeat(np.arange(len(sizes)), count)
        number = np.arange(base[-1]) - base[group_of]
        label = number.astype(np.uint64) * np.uint64(4096) + band[group_of].astype(np.uint64)
        empty = count - np.bincount(group_of[full], minlength=len(sizes))
        sparse |= wanted & (empty > spare[band])
        keys.append(mixed(total ^ mixed(label))[full])
        owners.append(group_of[full])
    for r in rows[sparse[rows]]:
        prefix = hashes[starts[r]:starts[r + 1]][: sizes[r] - smallest[r] + 1]
        keys.append(mixed(prefix ^ np.uint64(0xD1342543DE82EF95)))
        owners.append(np.full(len(prefix), r))
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(keys).view(np.int64), np.concatenate(owners)


_MARK = pa.struct(
    [("link", pa.bool_()), ("doc_id", pa.int64()), ("n", pa.int64()), ("second", pa.int64())]
)
_ROWS = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("mark", _MARK)])
_ROWS_DDL = "key long, node long, mark struct<link: boolean, doc_id: long, n: long, second: long>"


def _rows(key: np.ndarray, node: np.ndarray, mark: pa.Array | None = None) -> pa.RecordBatch:
    mark = pa.nulls(len(key), _MARK) if mark is None else mark
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(node), mark], schema=_ROWS)


def _links(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    n = len(a)
    nothing = pa.nulls(n, pa.int64())
    mark = pa.StructArray.from_arrays(
        [pa.array(np.ones(n, bool)), nothing, nothing, nothing], fields=list(_MARK)
    )
    return _rows(a, b, mark)


def _first_of_run(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted by key: where runs begin, and for every place the first node of its run."""
    begins = np.concatenate([[True], key[1:] != key[:-1]])
    return begins, node[np.flatnonzero(begins)][np.cumsum(begins) - 1]


def keyed_sets(docs: DataFrame, threshold: int) -> DataFrame:
    """Rows of documents, links found inside a task, and group keys left to compare.

    Each task keeps one set per key and links the others to it, so a key that a third
    of all documents hold arrives once per task.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        seen: set[int] = set()

        def combined() -> Iterator[pa.RecordBatch]:
            key = np.concatenate([k for k, _ in held])
            node = np.concatenate([n for _, n in held])
            order = np.argsort(key, kind="stable")
            key, node = key[order], node[order]
            begins, first = _first_of_run(key, node)
            linked = ~begins & (node != first)
            pairs = np.unique(np.stack([node[linked], first[linked]]), axis=1)
            yield _links(pairs[0], pairs[1])
            yield _rows(key[begins], node[begins])
            held.clear()
            seen.clear()
            give_back_memory()

        for batch in batches:
            ids = batch.column(0)
            for a, b, data, offsets in text_slices(batch.column(1)):
                hashes, starts = shingle_sets(data, offsets)
                node, second = set_keys(hashes, starts)
                n = b - a
                mark = pa.StructArray.from_arrays(
                    [
                        pa.array(np.zeros(n, bool)), ids.slice(a, n),
                        pa.array(np.diff(starts)), pa.array(second),
                    ],
                    fields=list(_MARK),
                )
                yield _rows(node, node, mark)
                key, owner = group_keys(hashes, starts, threshold)
                fresh = np.array([v not in seen for v in node.tolist()], bool)
                seen.update(node.tolist())
                keep = fresh[owner]
                held.append((key[keep], node[owner[keep]]))
                if sum(len(k) for k, _ in held) >= HELD_KEYS:
                    yield from combined()
        if held:
            yield from combined()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(make, _ROWS_DDL)


def linked_keys(rows: DataFrame) -> DataFrame:
    """Documents and links as they came; runs of an equal key turned into links.

    Rows arrive sorted by key and are read as a stream, so a run of any length needs
    no memory.
    """

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last_node = None, None
        for batch in batches:
            marked = batch.column(2).is_valid()
            yield batch.filter(marked)
            rest = batch.filter(pc.invert(marked))
            key = rest.column(0).to_numpy(zero_copy_only=False)
            node = rest.column(1).to_numpy(zero_copy_only=False)
            if not len(key):
                continue
            if last_key == key[0]:
                key = np.concatenate([[last_key], key])
                node = np.concatenate([[last_node], node])
            begins, first = _first_of_run(key, node)
            linked = ~begins & (node != first)
            yield _links(node[linked], first[linked])
            last_key, last_node = key[-1], first[-1]

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(link, _ROWS_DDL)


# --- R-tree ------------------------------------------------------------------------


class CountTree:
    """An R-tree of group-count points, packed by size and then by coordinate order."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        # Like sizes first; inside a size class, sets with their weight in the same group.
        order = np.lexsort((points.argmax(1), sizes)) if len(sizes) else np.zeros(0, np.int64)
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.order = order
        self.points, self.sizes = points[order], sizes[order]
        high, small, large = self.points, self.sizes, self.sizes
        low = self.points
        while len(high) > FANOUT or not self.levels:
            cuts = np.arange(0, len(high), FANOUT)
            if not len(cuts):
                break
            high = np.maximum.reduceat(high, cuts)
            low = np.minimum.reduceat(low, cuts)
            small = np.minimum.reduceat(small, cuts)
            large = np.maximum.reduceat(large, cuts)
            self.levels.append((low, high, small, large))

    def pairs(self, other: CountTree, threshold: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each own point, in turn, the other's points that may overlap it enough."""
        if not self.levels or not other.levels:
            return
        for i in range(len(self.points)):
            point, size = self.points[i], self.sizes[i]
            nodes = np.arange(len(other.levels[-1][1]))
            for level in reversed(range(len(other.levels))):
                _, high, small, large = other.levels[level]
                bound = np.minimum(high[nodes], point).sum(1)
                near = (
                    ((100 + threshold) * bound >= threshold * (size + small[nodes]))
                    & (100 * large[nodes] >= threshold * size)
                    & (100 * size >= threshold * small[nodes])
                )
                nodes = nodes[near]
                below = len(other.levels[level - 1][1]) if level else len(other.points)
                nodes = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                nodes = nodes[nodes < below]
            bound = np.minimum(other.points[nodes], point).sum(1)
            sizes = other.sizes[nodes]
            fit = nodes[(100 + threshold) * bound >= threshold * (size + sizes)]
            if len(fit):
                yield int(self.order[i]), other.order[fit]


class Sets:
    """Shingle sets of texts, with their tree."""

    def __init__(self, texts: pa.Array) -> None:
        hashes, starts = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
        for _, _, data, offsets in text_slices(texts):
            found, at = shingle_sets(data, offsets)
            hashes.append(found)
            starts.append(at[1:] + starts[-1][-1])
        self.hashes, self.starts = np.concatenate(hashes), np.concatenate(starts)
        self.sizes = np.diff(self.starts)
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        place = owner * GROUPS + (mixed(self.hashes) % np.uint64(GROUPS)).astype(np.int64)
        points = np.bincount(place, minlength=len(self.sizes) * GROUPS)
        self.tree = CountTree(points.reshape(-1, GROUPS), self.sizes)

    def of(self, row: int) -> np.ndarray:
        return self.hashes[self.starts[row]:self.starts[row + 1]]


def joined(
    left: Sets, right: Sets, threshold: int, label_left: np.ndarray, label_right: np.ndarray
) -> Iterator[tuple[int, int]]:
    """Links that connect what labels hold apart: enough to join every linked pair.

    ``label_*`` say what is connected so far and are updated; both may be one array.
    """
    for i, candidates in left.tree.pairs(right.tree, threshold):
        mine = left.of(i)
        for j in candidates:
            if label_left[i] == label_right[j]:
                continue
            theirs = right.of(j)
            at = np.searchsorted(mine, theirs)
            at[at == len(mine)] = 0
            same = int((mine[at] == theirs).sum())
            if (100 + threshold) * same >= threshold * (len(mine) + len(theirs)):
                yield i, int(j)
                new, old = label_left[i], label_right[j]
                label_right[label_right == old] = new
                label_left[label_left == old] = new


# --- the join ------------------------------------------------------------------------


_PAIR = pa.schema([("a", pa.string()), ("b", pa.string())])


def _runs(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[pa.Table]:
    """Rows of a sorted stream, a table for each run of equal values in the first ``by`` columns."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*[batch.column(i).to_pylist() for i in range(by)], strict=True))
        begin = 0
        for i, key in enumerate(keys):
            if key != last:
                if i > begin:
                    held.append(batch.slice(begin, i - begin))
                if held:
                    yield pa.Table.from_batches(held)
                held, begin, last = [], i, key
        held.append(batch.slice(begin))
    if held:
        yield pa.Table.from_batches(held)


def _page_links(pages: DataFrame, threshold: int) -> DataFrame:
    """Links inside every page; takes ``root``, ``page``, ``id``, ``text``."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for page in _runs(batches, 2):
            ids = page.column("id").to_pylist()
            sets = Sets(page.column("text").combine_chunks())
            label = np.arange(len(ids))
            found = list(joined(sets, sets, threshold, label, label))
            yield pa.RecordBatch.from_pydict(
                {"a": [ids[i] for i, _ in found], "b": [ids[j] for _, j in found]}, schema=_PAIR
            )

    ordered = pages.repartition("root", "page").sortWithinPartitions("root", "page")
    return ordered.select("root", "page", "id", "text").mapInArrow(link, "a string, b string")


def _visits(pages: DataFrame, visitors: DataFrame, threshold: int) -> DataFrame:
    """Links between a cluster's pages and sets outside its largest component.

    Each page stays in one task; visitors pass by it in blocks of bounded size.
    """

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home_key = home = None
        for block in _runs(batches, 4):
            key = (block.column(0)[0].as_py(), block.column(1)[0].as_py())
            ids = block.column("id").to_pylist()
            comps = block.column("component").to_pylist()
            sets = Sets(block.column("text").combine_chunks())
            if not block.column(2)[0].as_py():
                home_key, home = key, (ids, comps, sets)
                continue
            if key != home_key:
                continue
            names = {c: n for n, c in enumerate(dict.fromkeys([*home[1], *comps]))}
            here = np.array([names[c] for c in home[1]])
            there = np.array([names[c] for c in comps])
            found = list(joined(home[2], sets, threshold, here, there))
            yield pa.RecordBatch.from_pydict(
                {"a": [home[0][i] for i, _ in found], "b": [ids[j] for _, j in found]}, schema=_PAIR
            )

    both = pages.withColumns({"visit": F.lit(False), "block": F.lit(0).cast("long")}).unionByName(
        visitors.withColumn("visit", F.lit(True))
    )
    order = ["root", "page", "visit", "block"]
    ordered = both.repartition("root", "page").sortWithinPartitions(*order)
    return ordered.select(*order, "id", "component", "text").mapInArrow(link, "a string, b string")


def _id(node: str, second: str) -> Column:
    return F.concat_ws(".", F.col(node), F.col(second))


def _gate(clusters: DataFrame) -> np.ndarray:
    """A bitmap of the clusters' nodes by hash, of fixed size.

    It lets a task drop most texts that are in no cluster before they are shuffled. Its
    words come to the driver, at most ``GATE_BITS / 64`` of them; a bitmap that fills up
    lets more texts pass to the join, which decides.
    """
    place = F.col("node").bitwiseAND(GATE_BITS - 1)
    words = (
        clusters.groupBy(F.shiftright(place, 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(node & 63 as int))")).alias("bits"))
        .toArrow()
    )
    bitmap = np.zeros(GATE_BITS >> 6, np.int64)
    bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return bitmap


def _verified_links(docs: DataFrame, clusters: DataFrame, threshold: int) -> DataFrame:
    """Links between distinct sets of every cluster, enough to connect all that are linked."""

    gate = sent(docs.sparkSession, _gate(clusters))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_slices(batch.column(0)):
                node, second = set_keys(*shingle_sets(data, offsets))
                word = gate.value[(node & (GATE_BITS - 1)) >> 6]
                named = pa.RecordBatch.from_arrays(
                    [pa.array(node), pa.array(second), batch.column(0).slice(a, b - a)],
                    names=["node", "second", "text"],
                )
                yield named.filter(pa.array((word >> (node & 63)) & 1 == 1))

    named = docs.select("text").mapInArrow(name, "node long, second long, text string")
    sets = written(
        named.join(clusters.withColumnRenamed("node", "of_node"), F.col("node") == F.col("of_node"))
        .groupBy("root", "node", "second")
        .agg(F.first("text").alias("text"))
        .withColumn("id", _id("node", "second")),
        "jaccard-sets",
    )
    pages_of = sets.groupBy("root").agg(
        F.ceil(F.count(F.lit(1)) / PAGE_SETS).alias("pages")
    ).withColumnRenamed("root", "of_root")
    paged = sets.join(pages_of, F.col("root") == F.col("of_root")).select(
        "root", "pages", "id", "text", F.pmod(F.xxhash64("id"), F.col("pages")).alias("page")
    )
    inside = written(_page_links(paged, threshold), "jaccard-links")
    large = paged.filter("pages > 1")
    if not pages_of.filter("pages > 1").take(1):
        return inside
    label = components(inside).select(F.col("node").alias("linked"), F.col("root").alias("component"))
    labelled = written(
        large.join(label, F.col("id") == F.col("linked"), "left")
        .withColumn("component", F.coalesce("component", "id"))
        .drop("linked"),
        "jaccard-pages",
    )
    sized = labelled.groupBy("root", "component").agg(F.count(F.lit(1)).alias("n"))
    main = sized.groupBy(F.col("root").alias("of_root")).agg(
        F.max(F.struct("n", "component")).getField("component").alias("main")
    )
    outside = labelled.join(main, F.col("root") == F.col("of_root")).filter("component <> main")
    blocks = outside.groupBy(F.col("root").alias("in_root")).agg(
        F.ceil(F.count(F.lit(1)) / PAGE_SETS).alias("blocks")
    )
    visitors = outside.join(blocks, F.col("root") == F.col("in_root")).select(
        "root", "id", "component", "text",
        F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("pages") - 1)).alias("page"),
    )
    pages = labelled.select("root", "page", "id", "component", "text")
    return inside.unionByName(_visits(pages, visitors, threshold))


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` for every row of ``docs``.

    Takes ``doc_id`` and ``text``; other columns are ignored. Rows link when 100 times
    the intersection of their shingle sets is at least ``threshold`` times the union.
    ``component_id`` is the smallest id reachable; rows without words link with nothing
    and are their own. A null id is passed over when the smallest is sought, so it is
    null only where no row of the component has an id. Equal and repeated rows share a
    component. No rows give no rows. ``threshold`` is from 67 to 100 percent.
    """
    if not LEAST_THRESHOLD <= threshold <= 100:
        raise ValueError(f"threshold must be from {LEAST_THRESHOLD} to 100 percent")
    with released():
        rows = written(linked_keys(keyed_sets(docs, threshold)), "jaccard-keys")
        candidates = rows.filter("mark.link").select(F.col("key").alias("a"), F.col("node").alias("b"))
        clusters = components(candidates)
        label = components(_verified_links(docs, clusters, threshold))
        label = label.withColumnRenamed("node", "of_node")
        sized = rows.filter("not mark.link").select(
            "mark.doc_id", F.col("mark.n").alias("n_shingles"), _id("node", "mark.second").alias("id")
        )
        # Only sets that link with another one are in the table of labels.
        labelled = written(
            sized.join(label, F.col("id") == F.col("of_node"), "left").select(
                "doc_id", "n_shingles", F.coalesce("root", "id").alias("component")
            ),
            "jaccard-labels",
        )
    # Written, so that the join's side with a hot component can be split.
    smallest = written(
        labelled.filter("n_shingles > 0")
        .groupBy(F.col("component").alias("of"))
        .agg(F.min("doc_id").alias("smallest"), F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1"),
        "jaccard-smallest",
    )
    together = (F.col("component") == F.col("of")) & (F.col("n_shingles") > 0)
    return labelled.join(smallest, together, "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("rows") > 1, F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id"),
    )
