import pytest

from weftline.operators import matrix, minhash, users
from weftline.operators.minhash import HashParams
from weftline.sources import text

PARAMS = [HashParams(5, 7), HashParams(3, 1)]
PRIME = 2147483647


def long_sets(spark, sets):
    rows = [(i, x) for i, s in enumerate(sets) for x in (s or [None])]
    return spark.createDataFrame(rows, "set_id bigint, element bigint")


def test_signatures(spark):
    members = long_sets(spark, [[1, 2, 3], [4, 3, 9], [5, 6, 6], []])
    found = dict(tuple(r) for r in minhash.signatures(members, PARAMS, 10).collect())
    assert found == {0: [3, 1], 1: [3, 1], 2: [3, 7], 3: [PRIME, PRIME]}
    compared = {r.set_id: r.overlap for r in minhash.compare_with_reference(members, PARAMS, 10).collect()}
    assert compared == {1: 1.0, 2: 0.5, 3: 0.0}
    with pytest.raises(ValueError):
        minhash.compare_with_reference(members, PARAMS, 10, reference_id=99)


def test_membership_against_position(spark):
    row = spark.createDataFrame([([3, 1, 3], [1, 3, 5])], "a array<bigint>, b array<bigint>")
    found = row.select(minhash.membership_overlap(row.a, row.b), minhash.positional_similarity(row.a, row.b))
    assert tuple(found.first()) == (1.0, 0.0)


def test_equal_sets_have_equal_signatures_and_seeds_repeat(spark):
    members = long_sets(spark, [range(1, 50), list(range(49, 0, -1)) * 2])
    params = minhash.hash_params(8, seed=3)
    assert params == minhash.hash_params(8, seed=3)
    a, b = minhash.signatures(members, params, 1000).collect()
    assert a.signature == b.signature


@pytest.fixture(scope="module")
def plays(spark):
    rows = [(1, 10, 1), (1, 20, 1), (1, 31, 1), (2, 20, 1), (2, 30, 1), (2, 40, 1), (2, 50, 1), (3, 10, 1), (3, 20, 2), (3, 30, 9), (4, 30, 5), (4, 31, 7)]
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "user_id bigint, item_id bigint, cnt bigint, at bigint")


@pytest.fixture(scope="module")
def utility(spark, plays):
    aliases = spark.createDataFrame([(31, 30), (30, 30)], "bad_id bigint, good_id bigint")
    return users.resolve_aliases(plays, aliases)


def test_user_similarity(utility):
    m = users.utility_matrix(utility, ["at"])
    found = users.user_similarity(m, 1, 2).first()
    assert (found.common, found.ratio, found.jaccard) == (2, pytest.approx(2 / 3), pytest.approx(2 / 5))
    same = users.user_similarity(m, 1, 3).first()
    assert (same.ratio, same.jaccard) == (None, 1.0)
    assert users.user_similarity(m, 1, 1).collect() == []
    assert users.user_similarity(m, 1, 77).collect() == []


def test_last_count_wins_unless_summed(utility):
    last = {(r.user_id, r.item_id): r.cnt for r in users.utility_matrix(utility, ["at"]).collect()}
    total = {(r.user_id, r.item_id): r.cnt for r in users.utility_matrix(utility, ["at"], "sum").collect()}
    assert last[4, 30] == 7 and total[4, 30] == 12
    with pytest.raises(ValueError):
        users.utility_matrix(utility, ["at"], "first")


def test_aliases_go_one_hop(spark, plays):
    chain = spark.createDataFrame([(31, 30), (30, 29)], "bad_id bigint, good_id bigint")
    found = users.resolve_aliases(plays, chain).where("user_id = 1").collect()
    assert sorted(r.item_id for r in found) == [10, 20, 30]


MATRIX = "1 1 1 0 0\n3 3 3 0 0\n4 4 4 0 0\n5 5 5 0 0\n0 2 0 4 4\n0 0 0 5 5\n0 1 0 2 2"


@pytest.fixture
def entries(spark, tmp_path):
    (tmp_path / "m.txt").write_text(MATRIX)
    return text.read_matrix(spark, str(tmp_path)).drop("_corrupt")


def test_matrix_selection(spark, entries):
    assert entries.count() == 35 and matrix.drop_zeros(entries).count() == 20
    chosen = {(r.pos, r.c): (r.r, r.v) for r in matrix.select_rows(entries, [1, 5, 1]).collect()}
    assert [chosen[0, c][1] for c in range(5)] == [3, 3, 3, 0, 0]
    assert [chosen[1, c][1] for c in range(5)] == [0, 0, 0, 5, 5]
    assert chosen[2, 0] == (1, 3) and len(chosen) == 15
    columns = {(r.pos, r.r): r.v for r in matrix.select_columns(entries, [1, 3]).collect()}
    assert [columns[0, r] for r in range(7)] == [1, 3, 4, 5, 2, 0, 1]
    assert [columns[1, r] for r in range(7)] == [0, 0, 0, 0, 4, 5, 2]
    met = {(r.row_pos, r.col_pos): r.v for r in matrix.intersection(entries, [1, 5], [1, 3]).collect()}
    assert met == {(0, 0): 3, (0, 1): 0, (1, 0): 0, (1, 1): 5}
    index = spark.createDataFrame([(0, 5), (1, 1), (2, 5)], "pos int, r bigint")
    assert matrix.select_rows_by_table(entries, index).count() == 15
    assert matrix.select_columns_by_table(entries, index.where("r = 1").withColumnRenamed("r", "c")).count() == 7


def test_matrix_text_across_files_with_blank_lines(spark, tmp_path):
    (tmp_path / "part-0.txt").write_text("1 2\n\n 3 \t4 x\n")
    (tmp_path / "part-1.txt").write_text("\n5\n")
    rows = {(r.r, r.c): (r.v, r._corrupt) for r in text.read_matrix(spark, str(tmp_path)).collect()}
    assert rows == {
        (0, 0): (1, None), (0, 1): (2, None), (2, 0): (3, None), (2, 1): (4, None),
        (2, 2): (None, "x"), (4, 0): (5, None),
    }


def test_matrix_text_in_many_splits(spark, tmp_path):
    (tmp_path / "m.txt").write_text("".join(f"{i} {i * 2}\n" for i in range(2000)))
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    found = text.read_matrix(session, str(tmp_path))
    assert found.where("v <> r * (c + 1)").count() == 0 and found.count() == 4000


def test_malformed_lines_are_kept_aside(spark, tmp_path):
    def read(reader, content):
        path = tmp_path / reader.__name__
        path.write_text(content)
        return sorted((tuple(r) for r in reader(spark, str(path)).collect()), key=lambda row: (row[0] is None, str(row)))

    assert read(text.read_ints, "1\n 01\nx\n") == [(1, None), (1, None), (None, "x")]
    assert read(text.read_vectors, "1 2.5\n1  2\n") == [([1.0, 2.5], None), (None, "1  2")]
    assert read(text.read_aliases, "1\t2\n3\n4\t5\t6\n") == [(1, 2, None), (None, None, "3"), (None, None, "4\t5\t6")]
    assert read(text.read_triples, "1 2  3\n1 2\n1 2 c\n") == [
        (1, 2, 3, None), (None, None, None, "1 2 c"), (None, None, None, "1 2"),
    ]


def test_duplicate_aliases_keep_the_last(spark):
    rows = spark.createDataFrame([(1, 2, 0), (1, 3, 1), (4, 5, 2)], "bad_id bigint, good_id bigint, at int")
    assert sorted(tuple(r) for r in text.alias_table(rows, "at").collect()) == [(1, 3), (4, 5)]


def test_line_order_follows_the_numbers_in_names(spark, tmp_path):
    for part in (99_999, 100_000, 100_001):
        (tmp_path / f"part-{part}.txt").write_text(f"{part}\tx\n")
    lines = text.numbered_lines(spark, str(tmp_path)).orderBy("line_no").collect()
    assert [(r.line_no, r.value) for r in lines] == [(0, "99999\tx"), (1, "100000\tx"), (2, "100001\tx")]


def test_the_last_line_of_a_repeated_alias_counts(spark, tmp_path):
    (tmp_path / "part-00009.txt").write_text("1\t2\n1\t3\nbad\n4\t5\n")
    (tmp_path / "part-00010.txt").write_text("1\t9\n")
    found = text.read_alias_table(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in found) == [(1, 9), (4, 5)]


def test_empty_documents_have_signatures(spark, tmp_path):
    from weftline.plans import inputs

    rows = [(1, ""), (2, None), (3, "b a"), (4, " ")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    params = minhash.hash_params(4, 1)
    sets = inputs.word_sets(spark, str(tmp_path))
    found = {r.set_id: r.signature for r in minhash.signatures(sets, params, 1000).collect()}
    assert set(found) == {1, 2, 3, 4}
    assert found[1] == found[2] == found[4] == [minhash.HASH_PRIME] * 4 != found[3]
    assert minhash.compare_with_reference(sets, params, 1000).count() == 3
