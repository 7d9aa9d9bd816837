"""Fill-in-middle: texts cut in three at drawn places and put together in another order.

A slice of texts is a run of bytes in fixed blocks. Two Fenwick trees hold how many
units, and how many code points, begin in each block. The unit a cut falls before is
found by descending the tree of units to its block, and then by looking at that block's
bytes alone; the code points before it come from the other tree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import text_slices

BLOCK = 256

PLAIN, PREFIX_FIRST, SUFFIX_FIRST = "plain", "psm", "spm"
UNITS = ("char", "word", "line")


@dataclass(frozen=True)
class Marks:
    """The texts that open the three parts. Splitting at them must be unambiguous."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        marks = [self.prefix, self.suffix, self.middle]
        if not all(marks) or any(a in b for a in marks for b in marks if a is not b):
            raise ValueError("marks must not be empty or part of one another")
        if any(a[:i] == b[-i:] for a in marks for b in marks for i in range(1, len(a))):
            raise ValueError("no mark may begin as one of them ends")


MARKS = Marks()


def fenwick(counts: np.ndarray) -> np.ndarray:
    """The tree of ``counts``: node i, from 1, sums the last ``i & -i`` of the first i counts."""
    tree = np.concatenate([np.zeros(1, np.int64), counts.astype(np.int64)])
    step = 1
    while 2 * step < len(tree):
        nodes = np.arange(2 * step, len(tree), 2 * step)
        tree[nodes] += tree[nodes - step]
        step *= 2
    return tree


def sum_before(tree: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The sum of the first ``blocks`` counts, for each of many."""
    node, total = blocks.astype(np.int64), np.zeros(len(blocks), np.int64)
    while node.any():
        total += tree[node]
        node = node & (node - 1)
    return total


def block_of(tree: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block that holds unit number ``wanted`` (from 0), and the units to skip in it.

    Binary lifting: from the highest power down, a node is passed when all it sums lies
    before the unit.
    """
    at, left = np.zeros(len(wanted), np.int64), wanted.astype(np.int64)
    step = 1 << max((len(tree) - 1).bit_length() - 1, 0)
    while step:
        node = at + step
        inside = node < len(tree)
        sums = tree[np.where(inside, node, 0)]
        passed = inside & (sums <= left)
        at = np.where(passed, node, at)
        left = np.where(passed, left - sums, left)
        step >>= 1
    return at, left


class BlockIndex:
    """Which bytes of a slice begin a unit or a code point, and their sums by block."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, unit: str) -> None:
        self.size = len(data)
        chars = (data & 0xC0) != 0x80
        self.chars, self.char_tree = self._blocks(chars)
        if unit == "char":
            self.units, self.unit_tree = self.chars, self.char_tree
        else:
            begins = np.zeros(len(data), bool)
            if unit == "line":
                begins[1:] = data[:-1] == 10
            else:
                blank = ((data >= 9) & (data <= 13)) | (data == 32)
                begins[1:] = blank[:-1] & ~blank[1:]
            begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
            self.units, self.unit_tree = self._blocks(begins)

    @staticmethod
    def _blocks(begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        blocks = np.zeros((len(begins) // BLOCK + 1, BLOCK), bool)
        blocks.reshape(-1)[:len(begins)] = begins
        return blocks, fenwick(blocks.sum(1))

    @staticmethod
    def _before(blocks: np.ndarray, tree: np.ndarray, at: np.ndarray) -> np.ndarray:
        block, place = at // BLOCK, at % BLOCK
        local = blocks[block] & (np.arange(BLOCK) < place[:, None])
        return sum_before(tree, block) + local.sum(1)

    def units_before(self, at: np.ndarray) -> np.ndarray:
        return self._before(self.units, self.unit_tree, at)

    def chars_before(self, at: np.ndarray) -> np.ndarray:
        return self._before(self.chars, self.char_tree, at)

    def start_of(self, unit: np.ndarray) -> np.ndarray:
        """The byte where each of the units begins; past the last one, the slice's end."""
        block, skip = block_of(self.unit_tree, unit)
        known = block < len(self.units)
        inside = self.units[np.where(known, block, 0)]
        reached = np.cumsum(inside, axis=1, dtype=np.int32) > skip[:, None]
        return np.where(known, block * BLOCK + reached.argmax(1), self.size)


def cut_slice(
    data: np.ndarray, offsets: np.ndarray, first: np.ndarray, second: np.ndarray, unit: str = "char"
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``n`` units, both cuts as bytes, and the code points of prefix and middle, per text.

    The cuts of a text of n units stand before unit ``first % (n + 1)`` and unit
    ``second % (n + 1)``, in order; unit n is the text's end.
    """
    index = BlockIndex(data, offsets, unit)
    before = index.units_before(offsets)
    n = np.diff(before)
    one, two = first % (n + 1), second % (n + 1)
    cuts = []
    for place in (np.minimum(one, two), np.maximum(one, two)):
        at = index.start_of(before[:-1] + place)
        cuts.append(np.where(place == n, offsets[1:], at))
    chars = [index.chars_before(at) for at in (offsets[:-1], *cuts)]
    return n, cuts[0], cuts[1], chars[1] - chars[0], chars[2] - chars[1]


_CUT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
        ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string()),
    ]
)


def drawn(doc_id: Column, seed: int, group: int) -> Column:
    """One of the eight numbers below 2^32 that a document draws; a null id draws as empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(text, 256), 8 * group - 7, 8), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame,
    seed: int = 1,
    transformed: int = 90,
    suffix_first: int = 20,
    unit: str = "char",
    marks: Marks = MARKS,
) -> DataFrame:
    """``doc_id``, ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output`` per document.

    Of a hundred documents about ``transformed`` are cut before two drawn units, and of
    those ``suffix_first`` in a hundred put the suffix first; what is drawn depends on
    seed and id alone. ``n`` counts units: code points, words each with the white space
    after it (and before the first), or lines. The others, empty texts and texts that
    hold a mark stay plain, with null lengths. ``output`` is the whole new text.

    A null text is empty. Rows that share an id, or have none, draw the same numbers and
    are rows of their own. Other columns are not read. No rows give no rows.
    """
    if unit not in UNITS:
        raise ValueError(f"unknown unit {unit!r}; use one of {UNITS}")
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = text.contains(marks.prefix) | text.contains(marks.suffix) | text.contains(marks.middle)
    plain = (text == "") | marked | (drawn(F.col("doc_id"), seed, 3) % 100 >= transformed)
    turned = drawn(F.col("doc_id"), seed, 4) % 100 < suffix_first
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        drawn(F.col("doc_id"), seed, 1).alias("first"),
        drawn(F.col("doc_id"), seed, 2).alias("second"),
        F.when(plain, PLAIN).when(turned, SUFFIX_FIRST).otherwise(PREFIX_FIRST).alias("form"),
    )
    opening = [m.encode() for m in (marks.prefix, marks.suffix, marks.middle)]

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, first, second, forms = batch.columns
            draws = [c.to_numpy(zero_copy_only=False) for c in (first, second)]
            for begin, end, data, offsets in text_slices(texts):
                n, one, two, prefix, middle = cut_slice(
                    data, offsets, draws[0][begin:end], draws[1][begin:end], unit
                )
                kinds = forms.slice(begin, end - begin)
                whole = data.tobytes()
                outputs = [
                    _put_together(whole, *places, form, opening)
                    for *places, form in zip(
                        offsets[:-1].tolist(), one.tolist(), two.tolist(), offsets[1:].tolist(),
                        kinds.to_pylist(), strict=True,
                    )
                ]
                stays = np.array([form == PLAIN for form in kinds.to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(begin, end - begin), pa.array(n), kinds,
                        pa.array(prefix, mask=stays), pa.array(middle, mask=stays),
                        pa.array(outputs, pa.string()),
                    ],
                    schema=_CUT,
                )

    return rows.mapInArrow(
        turn,
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string",
    )


def _put_together(
    whole: bytes, start: int, one: int, two: int, end: int, form: str, opening: list[bytes]
) -> bytes:
    prefix, suffix, middle = opening
    if form == PREFIX_FIRST:
        parts = (prefix, whole[start:one], suffix, whole[two:end], middle, whole[one:two])
    elif form == SUFFIX_FIRST:
        parts = (suffix, whole[two:end], prefix, whole[start:one], middle, whole[one:two])
    else:
        parts = (whole[start:end],)
    return b"".join(parts)


def restored(output: Column, form: Column, marks: Marks = MARKS) -> Column:
    """The text that :func:`fill_in_middle` gave as ``output`` in ``form``.

    A text that holds a mark is never cut, so each mark stands once and splits exactly.
    """

    def parts(opened: str, next_one: str) -> Column:
        # What the split gives before the opening mark is empty.
        at = "|".join("\\Q" + m + "\\E" for m in (opened, next_one, marks.middle))
        return F.split(output, at)

    psm, spm = parts(marks.prefix, marks.suffix), parts(marks.suffix, marks.prefix)
    return (
        F.when(form == PREFIX_FIRST, F.concat(psm[1], psm[3], psm[2]))
        .when(form == SUFFIX_FIRST, F.concat(spm[2], spm[3], spm[1]))
        .otherwise(output)
    )
