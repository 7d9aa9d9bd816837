import hashlib
from decimal import Decimal

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.functions import composite_value, row_hash, surrogate_key, table_checksum


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def signed(value):
    return (value + 2**63) % 2**64 - 2**63


def spark_xxhash(*texts):
    seed = 42
    for text in texts:
        seed = xxhash.xxh64_intdigest(text.encode(), seed=seed)
    return signed(seed)


def one(df, column):
    return df.select(column).first()[0]


def test_surrogate_key_is_prefix_and_value(spark):
    df = spark.createDataFrame([("A1", None)], "id string, gone string")
    assert one(df, surrogate_key("AR|", F.col("id"))) == sha("AR|A1")
    assert one(df, surrogate_key("AR|", F.col("gone"))) == sha("AR|")


def test_null_part_of_composite_leaves_the_prefix(spark):
    df = spark.createDataFrame([("g", None, "c")], "a string, b string, c string")
    assert one(df, composite_value(["a", "b", "c"])) is None
    assert one(df, surrogate_key("AU|", composite_value(["a", "b", "c"]))) == sha("AU|")
    assert one(df, composite_value(["a", "c"], suffix=".BAL")) == "g.c.BAL"


def test_prefix_and_value_have_no_delimiter(spark):
    df = spark.createDataFrame([("BC", "C")], "x string, y string")
    assert one(df, surrogate_key("A", F.col("x"))) == one(df, surrogate_key("AB", F.col("y")))


def test_id_type_is_part_of_the_key(spark):
    df = spark.createDataFrame([(123,)], "id bigint").withColumn(
        "wide", F.col("id").cast("decimal(38,10)")
    )
    assert one(df, surrogate_key("K", F.col("id"))) == sha("K123")
    assert one(df, surrogate_key("K", F.col("wide"))) == sha("K123.0000000000")


HASH_PAIRS = [("a||b", "", "a", "b||"), (None, "x", "", "x")]


@pytest.mark.parametrize("pair", HASH_PAIRS)
def test_row_hash_collides_unless_strict(spark, pair):
    left = spark.createDataFrame([pair[:2]], "p string, q string")
    right = spark.createDataFrame([pair[2:]], "p string, q string")
    assert one(left, row_hash(["p", "q"])) == one(right, row_hash(["p", "q"]))
    strict = row_hash(["p", "q"], strict=True)
    assert one(left, strict) != one(right, strict)


def test_row_hash_values(spark):
    df = spark.createDataFrame([("a", None, 7)], "p string, q string, n int")
    assert one(df, row_hash(["p", "q", "n"])) == sha("a||||7")
    assert one(df, row_hash(["p", "q"], "md5")) == hashlib.md5(b"a||").hexdigest()


def test_row_hash_rejects_unknown_algorithm(spark):
    with pytest.raises(ValueError, match="sha512"):
        row_hash(["p"], "sha512")
    with pytest.raises(ValueError):
        row_hash([])


def test_checksum_against_brute_force(spark):
    rows = [(str(i), None if i % 3 == 0 else f"v{i}") for i in range(15_000)]
    df = spark.createDataFrame(rows, "id string, v string")
    total = sum(spark_xxhash(a, b or "") for a, b in rows)
    assert abs(total) > 2**63
    assert table_checksum(df, ["id", "v"]).first()[0] == f"rows:15000|hash_sum:{signed(total)}"


def test_checksum_of_extreme_fingerprints(spark):
    from ledgerloom.functions.checksums import checksum_text, hash_sum_lanes

    for values in ([2**63 - 1] * 5, [-(2**63)] * 5, [-1], [0], [-(2**63), 2**63 - 1, -7]):
        df = spark.createDataFrame([(v,) for v in values], "fp bigint")
        sums = df.agg(F.count("*").alias("n"), *hash_sum_lanes("fp"))
        text = sums.select(checksum_text(F.col("n"))).first()[0]
        assert text == f"rows:{len(values)}|hash_sum:{signed(sum(values))}"


def test_checksum_ignores_order_and_sees_edits_and_copies(spark):
    rows = [(i, f"v{i}") for i in range(500)]

    def checksum(data):
        df = spark.createDataFrame(data, "id int, v string")
        return table_checksum(df, ["id", "v"]).first()[0]

    base = checksum(rows)
    assert checksum(rows[::-1]) == base
    assert checksum(rows + rows[:1]) != base
    assert checksum([(0, "changed"), *rows[1:]]) != base


def test_checksum_of_nothing(spark):
    empty = spark.createDataFrame([], "id int")
    assert table_checksum(empty, ["id"]).first()[0] == "empty_dataframe"
    with pytest.raises(ValueError, match="crc"):
        table_checksum(empty, ["id"], "crc")


def test_checksum_method_is_portable(spark):
    df = spark.createDataFrame([("a", Decimal("1.50"))], "p string, d decimal(10,2)")
    want = int(sha("a||1.50")[:15], 16)
    assert table_checksum(df, ["p", "d"], "sha256").first()[0] == f"rows:1|hash_sum:{want}"
