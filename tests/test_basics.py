import pytest
from pyspark.sql import functions as F

from weftline.operators import basics, numbering, words
from weftline.sources.text import stream_lines


@pytest.fixture
def ints(spark):
    return lambda *values: spark.createDataFrame([(v,) for v in values], "value bigint")


def test_counts_and_averages(ints):
    six = ints(1, 2, 2, 3, 3, 4)
    assert basics.row_count(six).first()[0] == 6
    assert basics.total(six, "value").first()[0] == 15
    assert basics.average(six, "value").first()[0] == 2.5
    assert sorted(r[0] for r in basics.distinct_values(six, "value").collect()) == [1, 2, 3, 4]
    assert basics.count_distinct(six, "value").first()[0] == 4
    assert tuple(basics.distinct_average(six, "value").first()) == (10, 4, 2.5)


def test_the_two_averages_differ(ints):
    df = ints(1, 1, 1, 5)
    assert basics.average(df, "value").first()[0] == 2.0
    assert basics.distinct_average(df, "value").first()["distinct_average"] == 3.0


def test_sets(ints):
    a, b = ints(1, 10, 2, 3, 4, 5, 3), ints(1, 6, 2, 3, 7, 8, 3)
    assert sorted(r[0] for r in basics.intersection(a, b).collect()) == [1, 2, 3]
    assert basics.bag_union(a, b).count() == 14
    nulls = basics.intersection(ints(None, None, 1), ints(None, 2)).collect()
    assert [r[0] for r in nulls] == [None]


def test_samples(spark):
    df = spark.range(10_000)
    picked = basics.hash_sample(df, ["id"], 0.1, 1)
    again = basics.hash_sample(df.repartition(7), ["id"], 0.1, 1)
    assert 850 < picked.count() < 1150
    assert set(picked.collect()) == set(again.collect())
    assert basics.exact_sample(df, ["id"], 25, 3).distinct().count() == 25
    assert 800 < basics.bernoulli_sample(df, 0.1, 1).count() < 1200
    assert [r[0] for r in basics.first_rows(df.repartition(5), ["id"], 2).collect()] == [0, 1]


def test_words_and_vowels(spark):
    df = spark.createDataFrame([("queue aeiou Apple　 queue ",), ("",), (None,)], "value string")
    found = words.most_vowels(words.words(df), 10).collect()
    assert [tuple(r) for r in found] == [("aeiou", 5), ("queue", 4), ("queue", 4), ("Apple", 1)]


def test_words_of_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("queue aeiou\nApple\n")
    counted = words.vowel_counts(words.words(stream_lines(spark, str(tmp_path / "in"))))
    query = (
        counted.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "progress"))
        .format("parquet")
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(tuple(r) for r in found) == [("Apple", 1), ("aeiou", 5), ("queue", 4)]


def test_ties_at_the_top_k_boundary_go_by_word(spark):
    df = spark.createDataFrame([("bab dad cac",)], "value string")
    found = words.most_vowels(words.words(df), 2).collect()
    assert [r["word"] for r in found] == ["bab", "cac"]


def test_top_k_keeps_k_rows_per_task(spark, capsys):
    df = spark.range(100).select(F.col("id").cast("string").alias("word"))
    words.most_vowels(df, 3).explain()
    assert "TakeOrderedAndProject" in capsys.readouterr().out


def test_ordered_index(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(6)
    rows = numbering.ordered_index(df, ["x"]).collect()
    assert all(r["idx"] == r["x"] for r in rows) and len(rows) == 1000


def test_keyed_index_with_a_key_over_many_partitions(spark):
    key = F.when(F.col("id") % 3 > 0, F.lit(5)).otherwise(F.col("id") % 10)
    df = spark.range(3000).select(key.alias("key"), (F.col("id") * 7919 % 3000).alias("t"))
    expected: dict[int, int] = {}
    got = {(r["key"], r["t"]): r["pos"] for r in numbering.keyed_index(df, ["key"], ["t"]).collect()}
    for k, t in sorted(got):
        assert got[k, t] == expected.get(k, 0)
        expected[k] = expected.get(k, 0) + 1
    assert len(got) == 3000
