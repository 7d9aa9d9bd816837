"""Edit-aware token counts: segment trees over pre-token runs.

A text is cut into leaves where encoding starts afresh, so its count is the sum of its
leaves' counts. A document keeps a tree of those sums. An edit touches a few leaves and
their neighbours at the boundary; only these are encoded again, and the sums above them
are updated.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tokens import TextEncoder, encoder, hard_cuts, tokenizer_path

# Characters a leaf is filled up to; one run without a cut may be longer.
LEAF = 256
# A tree is built anew when a leaf grows to this many times its usual length.
OVERGROWN = 16


def cut_leaves(text: str, leaf: int = LEAF) -> list[str]:
    """The text in runs of whole pieces, each as short as ``leaf`` characters allow."""
    if len(text) <= leaf:
        return [text] if text else []
    bounds, last = [0], 0
    for at in hard_cuts(text):
        if at - bounds[-1] > leaf and last > bounds[-1]:
            bounds.append(last)
        if at - bounds[-1] >= leaf:
            bounds.append(at)
        last = at
    if len(text) - bounds[-1] > leaf and last > bounds[-1]:
        bounds.append(last)
    bounds.append(len(text))
    return [text[a:b] for a, b in zip(bounds, bounds[1:], strict=False) if b > a]


class TokenTree:
    """Characters and tokens of a text's leaves, summed in a binary tree.

    Node 1 is the root and node i has the parts 2i and 2i + 1. The tree holds numbers
    only: what it was built from is the text that edits are applied to.
    """

    def __init__(self, chars: np.ndarray, tokens: np.ndarray) -> None:
        self.chars, self.tokens = chars, tokens

    @staticmethod
    def of(leaves: Sequence[str], counts: Sequence[int]) -> TokenTree:
        width = 1
        while width < len(leaves):
            width *= 2
        sums = [np.zeros(2 * width, np.int64), np.zeros(2 * width, np.int64)]
        for total, values in zip(sums, ([len(x) for x in leaves], counts), strict=True):
            total[width:width + len(leaves)] = values
            level = width
            while level > 1:
                total[level // 2:level] = total[level:2 * level].reshape(-1, 2).sum(1)
                level //= 2
        return TokenTree(*sums)

    @property
    def width(self) -> int:
        return len(self.chars) // 2

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    @property
    def length(self) -> int:
        return int(self.chars[1])

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds the character at ``at``, and where that leaf begins."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if at >= begin + int(self.chars[node]) and self.chars[node + 1]:
                begin += int(self.chars[node])
                node += 1
        return node - self.width, begin

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.width
        more = chars - int(self.chars[node]), tokens - int(self.tokens[node])
        while node:
            self.chars[node] += more[0]
            self.tokens[node] += more[1]
            node //= 2


def build(text: str, tokens: TextEncoder, leaf: int = LEAF) -> TokenTree:
    leaves = cut_leaves(text, leaf)
    return TokenTree.of(leaves, tokens.counts(leaves))


def apply_edit(
    text: str,
    tree: TokenTree,
    start: int,
    removed: int,
    inserted: str,
    tokens: TextEncoder,
    leaf: int = LEAF,
) -> tuple[str, TokenTree, int]:
    """The text and tree after an edit, and how many characters were encoded for it.

    The edit is held to the text: it begins at its end at the latest. Encoded are the
    leaves that hold a changed character or one beside it, because whether a leaf's
    boundary is a cut depends on the two characters around it. Their new text is cut
    again into the same places of the tree.
    """
    start = min(max(start, 0), len(text))
    end = min(start + max(removed, 0), len(text))
    after = text[:start] + inserted + text[end:]
    if not tree.length:
        return after, build(after, tokens, leaf), len(after)
    first, begin = tree.find(max(start - 1, 0))
    last, last_begin = tree.find(min(end, len(text) - 1))
    stop = last_begin + int(tree.chars[last + tree.width])
    region = after[begin:stop + len(inserted) - (end - start)]
    places = last - first + 1
    parts = cut_leaves(region, leaf)
    if len(parts) > places:
        parts = [*parts[:places - 1], "".join(parts[places - 1:])]
    parts += [""] * (places - len(parts))
    if max(map(len, parts)) > OVERGROWN * leaf:
        whole = cut_leaves(after, leaf)
        if max(map(len, whole)) <= OVERGROWN * leaf or len(whole) > tree.width:
            return after, TokenTree.of(whole, tokens.counts(whole)), len(after)
    for place, (part, count) in enumerate(zip(parts, tokens.counts(parts), strict=True)):
        tree.put(first + place, len(part), count)
    return after, tree, len(region)


EDIT_TYPE = "array<struct<start: long, removed: long, inserted: string>>"
TREE_TYPE = "struct<chars: array<long>, tokens: array<long>>"


def with_trees(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``docs`` (``doc_id``, ``text``, and any ``edits``) with a column ``tree``.

    A null text is empty and its tree has one empty leaf.
    """
    path = tokenizer or tokenizer_path()
    kept = [c for c in ("doc_id", "text", "edits") if c in docs.columns]

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path)
        for batch in batches:
            texts = batch.column(kept.index("text")).to_pylist()
            trees = [build(t or "", tokens) for t in texts]
            tree = pa.StructArray.from_arrays(
                [
                    pa.array([t.chars for t in trees], pa.list_(pa.int64())),
                    pa.array([t.tokens for t in trees], pa.list_(pa.int64())),
                ],
                names=["chars", "tokens"],
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, tree], names=[*kept, "tree"])

    types = {"doc_id": "long", "text": "string", "edits": EDIT_TYPE}
    rows = docs.select(*[F.col(c).cast(types[c]).alias(c) for c in kept])
    return rows.mapInArrow(plant, ", ".join([*[f"{c} {types[c]}" for c in kept], f"tree {TREE_TYPE}"]))


def edited(rows: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Counts before and after the ``edits`` of every row with ``text`` and ``tree``.

    Gives ``doc_id``, ``tokens_before``, ``tokens_after``, ``n_edits``, ``chars_after``,
    ``chars_encoded``, ``text`` and ``tree``, both as edited. Edits apply in order, each
    to the text the one before left; places count characters and are held to the text.
    Null edits, starts and lengths are none, and a null insertion is empty. Repeated rows
    and null ids are rows of their own; an empty table gives none.
    """
    path = tokenizer or tokenizer_path()

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path)
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for doc_id, text, edits, held in zip(*columns, strict=True):
                tree = TokenTree(np.array(held["chars"], np.int64), np.array(held["tokens"], np.int64))
                text, before, encoded = text or "", tree.total, 0
                changes = [e for e in edits or [] if e is not None]
                for e in changes:
                    text, tree, more = apply_edit(
                        text, tree, e["start"] or 0, e["removed"] or 0, e["inserted"] or "", tokens
                    )
                    encoded += more
                out.append(
                    (
                        doc_id, before, tree.total, len(changes), len(text), encoded, text,
                        {"chars": tree.chars, "tokens": tree.tokens},
                    )
                )
            columns = list(zip(*out, strict=True)) if out else [[]] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _EDITED, strict=True)], schema=_EDITED
            )

    return rows.select("doc_id", "text", "edits", "tree").mapInArrow(
        change,
        "doc_id long, tokens_before long, tokens_after long, n_edits int, chars_after long, "
        f"chars_encoded long, text string, tree {TREE_TYPE}",
    )


_LONGS = pa.list_(pa.int64())
_EDITED = pa.schema(
    [
        ("doc_id", pa.int64()), ("tokens_before", pa.int64()), ("tokens_after", pa.int64()),
        ("n_edits", pa.int32()), ("chars_after", pa.int64()), ("chars_encoded", pa.int64()),
        ("text", pa.string()), ("tree", pa.struct([("chars", _LONGS), ("tokens", _LONGS)])),
    ]
)


def revision(text: Column) -> Column:
    """A revision drawn from a text itself: a passage removed, one repeated, one replaced."""
    n = F.coalesce(F.char_length(text), F.lit(0))

    def place(salt: int) -> Column:
        key = F.concat_ws(":", F.lit(str(salt)), F.coalesce(text, F.lit("")))
        return F.crc32(key.cast("binary")) % (n + 1)

    def edit(start: Column, removed: int, inserted: Column) -> Column:
        return F.struct(
            start.cast("long").alias("start"), F.lit(removed).cast("long").alias("removed"),
            F.coalesce(inserted, F.lit("")).alias("inserted"),
        )

    return F.array(
        edit(place(1), 40, F.lit("")),
        edit(place(2), 0, F.substr(text, (place(3) + 1).cast("int"), F.lit(60))),
        edit(place(4), 25, F.lit(" [revised] ")),
    )
