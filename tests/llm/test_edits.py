import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import edits
from ledgerloom.llm.tokens import encoder, tokenizer_path
from tests.llm.fixtures import SF_DIR, no_docs, odd_docs

INSERTED = ["", " ", "\n", "x", " foo", "foo ", "  ", "'s", "<|endof", "text|>", "é　z", "a b c d " * 60]
PIECES = st.sampled_from([" ", "\n", "a", "bc", " de", "'s", "  ", "<|endoftext|>", "é", ".", "12", "\x1c"])


def full(text):
    return len(encoder(tokenizer_path()).ids(text))


@settings(max_examples=150, deadline=None)
@given(
    st.lists(PIECES, max_size=60).map("".join),
    st.lists(st.tuples(st.integers(0, 90), st.integers(0, 30), st.lists(PIECES, max_size=6).map("".join)), max_size=5),
)
def test_counts_equal_full_encoding(text, changes):
    tokens = encoder(tokenizer_path())
    tree = edits.build(text, tokens, leaf=8)
    assert tree.total == full(text)
    for start, removed, inserted in changes:
        text, tree, _ = edits.apply_edit(text, tree, start, removed, inserted, tokens, leaf=8)
        assert (tree.total, tree.length) == (full(text), len(text))


def test_only_the_touched_region_is_encoded(spark):
    tokens = encoder(tokenizer_path())
    draw = random.Random(1)
    text = " ".join(r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(40).collect())
    tree = edits.build(text, tokens)
    for _ in range(200):
        at = draw.randrange(len(text))
        text, tree, encoded = edits.apply_edit(text, tree, at, draw.choice([0, 1, 30]), draw.choice(INSERTED), tokens)
        assert encoded < 0.05 * len(text)
    assert tree.total == full(text)


def test_leaves_put_together_are_the_text():
    for text in ("", "   ", "a" * 1000, "ab cd " * 200, "\n\n x" * 300):
        leaves = edits.cut_leaves(text, 20)
        assert "".join(leaves) == text
        assert sum(map(full, leaves)) == full(text)


def test_odd_documents_and_edits(spark):
    docs = odd_docs(spark).withColumn("edits", edits.revision(F.col("text")))
    defining = Tokenizer.from_file(tokenizer_path())
    got = edits.edited(edits.with_trees(docs)).collect()
    assert len(got) == 12
    for r in got:
        assert r.tokens_after == len(defining.encode(r.text, add_special_tokens=False).ids)
        assert r.n_edits == 3 and r.chars_after == len(r.text)
    typed = F.lit(None).cast(edits.EDIT_TYPE)
    same = edits.edited(edits.with_trees(odd_docs(spark).withColumn("edits", typed))).collect()
    assert all(r.tokens_before == r.tokens_after and r.chars_encoded == 0 for r in same)
    partly = F.array(F.lit(None), F.struct(F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("removed"), F.lit(None).cast("string").alias("inserted")))
    same = edits.edited(edits.with_trees(odd_docs(spark).withColumn("edits", partly.cast(edits.EDIT_TYPE)))).collect()
    assert all(r.tokens_before == r.tokens_after and r.n_edits == 1 for r in same)
    none = no_docs(spark).withColumn("edits", edits.revision(F.col("text")))
    assert edits.edited(edits.with_trees(none)).collect() == []
