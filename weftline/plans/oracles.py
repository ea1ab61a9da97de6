"""The SQL whose result each query must equal, over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from weftline.operators.basics import hash_threshold
from weftline.operators.expwindow import top_level
from weftline.plans.settings import (
    CLUSTERS,
    COEFFICIENTS,
    CUR_SEED,
    CUR_SIZE,
    DEGREE,
    HASHES,
    K,
    LAST_K,
    MATRIX_COLUMNS,
    MATRIX_ROWS,
    MODULUS,
    NEAREST_USERS,
    RADIUS,
    ROUNDS,
    SAMPLE_FRACTION,
    SAMPLE_ROWS,
    SAMPLE_SEED,
    TOP_WORDS,
    USERS,
    WIDTH,
)

# Unicode white space plus the four ASCII separators, as a character class.
GAP = (
    r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)

PARTS = """
    SELECT p_partkey AS bad_id, min(p_partkey) OVER (PARTITION BY p_brand, p_type) AS good_id
    FROM part"""

ALIASES = f"SELECT bad_id, good_id FROM ({PARTS}) WHERE bad_id <> good_id"

PLAYS = """
    SELECT o_custkey AS user_id, l_partkey AS item_id, CAST(l_quantity AS BIGINT) AS cnt,
           o_orderdate, o_orderkey, l_linenumber
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

RESOLVED = f"""
    SELECT user_id, coalesce(good_id, item_id) AS item_id, cnt, o_orderdate, o_orderkey, l_linenumber
    FROM ({PLAYS}) LEFT JOIN ({ALIASES}) ON item_id = bad_id"""

MATRIX = f"""
    SELECT user_id, item_id, arg_max(cnt, (o_orderdate, o_orderkey, l_linenumber, cnt)) AS cnt
    FROM ({RESOLVED}) GROUP BY user_id, item_id"""

WORDS = f"""
    SELECT doc_id, word
    FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '{GAP}')) AS word FROM documents)
    WHERE word <> ''"""

VOWELS = "length(word) - length(translate(word, 'aeiou', ''))"

LABEL_CENTRES = """
    WITH means AS (
        SELECT label, dim, avg(CAST(embedding[dim] AS DOUBLE)) AS x
        FROM embeddings, range(1, 65) t(dim) GROUP BY label, dim),
    centres AS (SELECT label AS id, list(x ORDER BY dim) AS v FROM means GROUP BY label)"""

CENTRE_PAIRS = f"""{LABEL_CENTRES},
    near AS (
        SELECT CAST(a.id AS BIGINT) AS i, CAST(b.id AS BIGINT) AS j, list_distance(a.v, b.v) AS d
        FROM centres a JOIN centres b ON a.id < b.id)"""

SETS = f"""
    WITH sets AS (
        SELECT d.doc_id AS set_id, x FROM documents d LEFT JOIN (
            SELECT doc_id, CAST('0x' || substr(md5(word), 1, 7) AS BIGINT) + 1 AS x
            FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '{GAP}')) AS word
                  FROM documents)
            WHERE word <> '') w ON d.doc_id = w.doc_id),
    signatures AS (
        SELECT set_id, [{", ".join(f"coalesce(min((({p.a} * x + {p.b}) % {p.prime}) % {MODULUS} + 1), {p.prime})" for p in HASHES)}] AS s
        FROM sets GROUP BY set_id),
    reference AS (SELECT s AS r FROM signatures ORDER BY set_id LIMIT 1),
    others AS (
        SELECT set_id, s, r FROM signatures, reference
        WHERE set_id <> (SELECT min(set_id) FROM signatures))"""

BITS = """
    SELECT user_id AS key, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos,
           CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS bit
    FROM events"""


def _as_one_stream(sql: str) -> str:
    """The same statement over all events as one stream with key 0."""
    return sql.replace("user_id AS key", "CAST(0 AS BIGINT) AS key").replace("PARTITION BY user_id ", "")



# One step per merge: all clusters left, with what the new one was made of.
CENTROID = """
    WITH RECURSIVE walk AS (
        SELECT CAST(0 AS BIGINT) AS step, row_number() OVER (ORDER BY vec_id) - 1 AS id,
               CAST(embedding AS DOUBLE[]) AS v, CAST(1 AS BIGINT) AS size, CAST(NULL AS BIGINT) AS l,
               CAST(NULL AS BIGINT) AS r, CAST(NULL AS DOUBLE) AS d
        FROM embeddings
        UNION ALL (
            WITH best AS (
                SELECT min({'d': list_distance(a.v, b.v), 'lo': a.id, 'hi': b.id}) AS m
                FROM walk a JOIN walk b ON a.id < b.id)
            SELECT c.step + 1, c.id, c.v, c.size, NULL, NULL, NULL
            FROM walk c, best WHERE c.id NOT IN (m.lo, m.hi)
            UNION ALL
            SELECT x.step + 1, (SELECT count(*) FROM embeddings) + x.step,
                   list_transform(list_zip(x.v, y.v), lambda p: (p[1] * x.size + p[2] * y.size) / (x.size + y.size)),
                   x.size + y.size, x.id, y.id, m.d
            FROM best JOIN walk x ON x.id = m.lo JOIN walk y ON y.id = m.hi))
    SELECT step - 1 AS step, l AS left_id, r AS right_id, id AS new_id, round(d, 6) AS height, size
    FROM walk WHERE l IS NOT NULL"""


def _linked(between: str) -> str:
    """One step per merge: every point's cluster, and a row without a point for the merge."""
    return f"""
    WITH RECURSIVE points AS (
        SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    pairs AS (
        SELECT a.id AS a, b.id AS b, list_distance(a.v, b.v) AS d FROM points a JOIN points b ON a.id < b.id),
    walk AS (
        SELECT CAST(0 AS BIGINT) AS step, id, id AS c, CAST(NULL AS BIGINT) AS l, CAST(NULL AS BIGINT) AS r,
               CAST(NULL AS DOUBLE) AS d, CAST(NULL AS BIGINT) AS size
        FROM points
        UNION ALL (
            WITH best AS (
                SELECT min({{'d': d, 'lo': lo, 'hi': hi}}) AS m FROM (
                    SELECT least(x.c, y.c) AS lo, greatest(x.c, y.c) AS hi, {between}(p.d) AS d
                    FROM pairs p JOIN walk x ON x.id = p.a JOIN walk y ON y.id = p.b
                    WHERE x.c <> y.c GROUP BY ALL))
            SELECT w.step + 1, w.id,
                   CASE WHEN w.c IN (m.lo, m.hi) THEN (SELECT count(*) FROM points) + w.step ELSE w.c END,
                   NULL, NULL, NULL, NULL
            FROM walk w, best WHERE w.id IS NOT NULL AND m IS NOT NULL
            UNION ALL
            SELECT w.step + 1, NULL, (SELECT count(*) FROM points) + w.step, m.lo, m.hi, m.d, count(*)
            FROM walk w, best WHERE w.id IS NOT NULL AND w.c IN (m.lo, m.hi) GROUP BY w.step, m))
    SELECT step - 1 AS step, l AS left_id, r AS right_id, c AS new_id, round(d, 6) AS height, size
    FROM walk WHERE l IS NOT NULL"""


def _kmeans(rounds: int) -> str:
    """Points, start centres ``c0`` and, per round i, assignment ``a<i>`` and centres ``c<i>``."""
    steps = [
        "WITH pts AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)",
        f"""c0 AS (SELECT CAST(row_number() OVER (ORDER BY id) - 1 AS INTEGER) AS cluster, v
                  FROM pts ORDER BY id LIMIT {K})""",
    ]
    for i in range(rounds):
        steps.append(
            f"""a{i} AS (
                SELECT p.id, any_value(p.v) AS v,
                       min({{'d': pow(list_distance(p.v, c.v), 2), 'cluster': c.cluster}}) AS b
                FROM pts p, c{i} c GROUP BY p.id)"""
        )
        steps.append(
            f"""m{i} AS (
                SELECT b.cluster AS cluster, dim, avg(v[dim]) AS x
                FROM a{i}, range(1, 65) t(dim) GROUP BY b.cluster, dim)"""
        )
        steps.append(
            f"""c{i + 1} AS (
                SELECT c.cluster, coalesce(any_value(m.v), any_value(c.v)) AS v FROM c{i} c LEFT JOIN
                    (SELECT cluster, list(x ORDER BY dim) AS v FROM m{i} GROUP BY cluster) m
                    ON c.cluster = m.cluster
                GROUP BY c.cluster)"""
        )
    return ",\n".join(steps)


def _cells(centres: str) -> str:
    return f"""SELECT cluster, CAST(dim - 1 AS INTEGER) AS dim, round(v[dim], 6) AS value
               FROM {centres}, range(1, 65) t(dim)"""


def _live(steps: str) -> str:
    """CTEs up to ``live``: the blocks kept at each step (key, n) of ``steps``."""
    top = top_level(WIDTH)
    return f"""bits AS ({BITS}), steps AS ({steps}),
    leveled AS (SELECT key, n, l AS level, (n + 1) // (1 << l) - 1 AS m FROM steps, range({top + 1}) t(l)),
    spans AS (
        SELECT key, n, level, m - 1 AS hi,
               CASE WHEN level < {top} THEN m - 2 + m % 2
                    ELSE greatest(0, CAST(floor((n - {WIDTH}) / {2**top}) AS BIGINT)) END AS lo
        FROM leveled WHERE m > 0),
    live AS (SELECT key, n, level, unnest(range(lo, hi + 1)) AS block FROM spans),
    sums AS (
        SELECT key, l AS level, pos // (1 << l) AS block, sum(bit) AS ones
        FROM bits, range({top + 1}) t(l) GROUP BY key, l, pos // (1 << l))"""


ESTIMATES = f"""WITH {_live("SELECT key, pos + 1 AS n FROM bits WHERE (pos + 1) % 10 = 0")},
    estimates AS (
        SELECT key, n, sum(ones * CASE WHEN n - block * (1 << level) <= {LAST_K} THEN 1.0
                                       WHEN n - (block + 1) * (1 << level) < {LAST_K} THEN 0.5
                                       ELSE 0.0 END) AS estimate
        FROM live JOIN sums USING (key, level, block) GROUP BY key, n)"""

EXACT = f"""
    SELECT key, pos + 1 AS n, CAST(sum(bit) OVER (PARTITION BY key ORDER BY pos
           ROWS BETWEEN {LAST_K - 1} PRECEDING AND CURRENT ROW) AS BIGINT) AS ones
    FROM ({BITS})"""


def _value(x: str) -> str:
    return " + ".join(f"{c!r} * pow({x}, {i})" for i, c in enumerate(COEFFICIENTS))


def _moments() -> str:
    x, y = "(l_quantity / 50)", "(l_extendedprice / 100000)"
    parts = [f"round(avg({y} * {y}), 6) AS yy"]
    parts += [f"round(avg(pow({x}, {i})), 6) AS x{i}" for i in range(2 * DEGREE + 1)]
    parts += [f"round(avg(pow({x}, {i}) * {y}), 6) AS xy{i}" for i in range(DEGREE + 1)]
    return f"SELECT count(*) AS n, {', '.join(parts)} FROM lineitem"


def _least_squares(by: str) -> str:
    """The normal equations of degree 2, by determinants."""
    x, y = "(l_quantity / 50)", "(l_extendedprice / 100000)"
    sums = [f"sum(pow({x}, {i})) AS s{i}" for i in range(5)] + [f"sum(pow({x}, {i}) * {y}) AS t{i}" for i in range(3)]
    keyed = f"{by} AS key, " if by else ""
    whole = "s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s3 * s2) + s2 * (s1 * s3 - s2 * s2)"
    parts = [
        "t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2)",
        "s0 * (t1 * s4 - s3 * t2) - t0 * (s1 * s4 - s3 * s2) + s2 * (s1 * t2 - t1 * s2)",
        "s0 * (s2 * t2 - t1 * s3) - s1 * (s1 * t2 - t1 * s2) + t0 * (s1 * s3 - s2 * s2)",
    ]
    solved = ", ".join(f"({p}) / ({whole}) AS c{i}" for i, p in enumerate(parts))
    group = f"GROUP BY {by}" if by else ""
    names = "key, " if by else ""
    rows = " UNION ALL ".join(
        f"SELECT {names}CAST({i} AS INTEGER) AS power, round(c{i}, 6) AS coefficient FROM solved" for i in range(3)
    )
    return f"""
        WITH sums AS (SELECT {keyed}{", ".join(sums)} FROM lineitem {group}),
        solved AS (SELECT {names}{solved} FROM sums) {rows}"""


def _places(column: str, chosen: list[int]) -> str:
    return ", ".join(f"({place}, {value})" for place, value in enumerate(chosen))


ROWS_AT = f"(VALUES {_places('r', MATRIX_ROWS)}) ri(pos, r)"
COLUMNS_AT = f"(VALUES {_places('c', MATRIX_COLUMNS)}) ci(pos, c)"
ENTRIES = """(
    SELECT vec_id AS r, CAST(dim - 1 AS BIGINT) AS c, round(CAST(embedding[dim] AS DOUBLE), 6) AS v
    FROM embeddings, range(1, 65) t(dim)) e"""


def _inverse(cell: Callable[[int, int], str]) -> list[str]:
    """The nine cells of the inverse of a 3 x 3 matrix, by cofactors."""

    def cofactor(i: int, j: int) -> str:
        (a, b), (c, d) = ([x for x in range(3) if x != y] for y in (i, j))
        sign = "" if (i + j) % 2 == 0 else "-"
        return f"{sign}({cell(a, c)} * {cell(b, d)} - {cell(a, d)} * {cell(b, c)})"

    det = "(" + " + ".join(f"{cell(0, j)} * {cofactor(0, j)}" for j in range(3)) + ")"
    return [f"{cofactor(j, i)} / {det}" for i in range(3) for j in range(3)]


def _inverted(gram: str) -> str:
    """``(a, b, x)``: the inverse of a 3 x 3 table ``(a, b, x)``."""
    at = ", ".join(f"max(x) FILTER (a = {i} AND b = {j}) AS g{i}{j}" for i in range(3) for j in range(3))
    cells = ", ".join(_inverse(lambda i, j: f"g{i}{j}"))
    return f"""(SELECT k // 3 AS a, k % 3 AS b, ([{cells}])[k + 1] AS x
        FROM (SELECT {at} FROM {gram}), range(9) t(k))"""


def _drawn(axis: str) -> str:
    unit = f"((CAST('0x' || substr(md5('{CUR_SEED}:{axis}:' || id), 1, 8) AS BIGINT) + 1) / 4294967297.0::DOUBLE)"
    return f"""(SELECT CAST(row_number() OVER (ORDER BY -ln({unit}) / norm2, id) - 1 AS INTEGER) AS pos, id, norm2
        FROM (SELECT {axis} AS id, sum(v * v) AS norm2 FROM cells GROUP BY 1) WHERE norm2 > 0
        QUALIFY pos < {CUR_SIZE})"""


CUR = f"""
    cells AS (
        SELECT vec_id AS r, CAST(dim - 1 AS BIGINT) AS c, CAST(embedding[dim] AS DOUBLE) AS v
        FROM embeddings, range(1, 65) t(dim)),
    rows_drawn AS {_drawn("r")}, columns_drawn AS {_drawn("c")},
    cm AS (SELECT r, pos AS j, c, v FROM cells JOIN columns_drawn ON c = id),
    rm AS (SELECT c, pos AS i, r, v FROM cells JOIN rows_drawn ON r = id),
    gram_c AS (SELECT x.j AS a, y.j AS b, sum(x.v * y.v) AS x FROM cm x JOIN cm y USING (r) GROUP BY ALL),
    gram_r AS (SELECT x.i AS a, y.i AS b, sum(x.v * y.v) AS x FROM rm x JOIN rm y USING (c) GROUP BY ALL),
    middle AS (
        SELECT j, i, sum(cm.v * cells.v * rm.v) AS x
        FROM cells JOIN cm ON cm.r = cells.r JOIN rm ON rm.c = cells.c GROUP BY ALL),
    link AS (
        SELECT g.a AS j, h.b AS i, sum(g.x * middle.x * h.x) AS u
        FROM middle JOIN {_inverted("gram_c")} g ON g.b = middle.j JOIN {_inverted("gram_r")} h ON h.a = middle.i
        GROUP BY ALL)"""
SEEDED = f"md5('{SAMPLE_SEED}:' || o_orderkey)"


def oracle_sql() -> dict[str, str]:
    vector_cells = ", ".join(
        f"round(CAST(embedding[{i + 1}] AS DOUBLE), 6) AS v{i}" for i in range(64)
    )
    hashed = ", ".join(
        f"(({p.a} * p_partkey + {p.b}) % {p.prime}) % {MODULUS} + 1 AS h{i}"
        for i, p in enumerate(HASHES[:3])
    )
    u1, u2 = USERS
    report = f"""{ESTIMATES}
            SELECT key, n, ones AS actual, CAST(estimate AS DOUBLE) AS estimate,
                   CAST(estimate - ones AS DOUBLE) AS absolute_error,
                   round((estimate - ones) / nullif(CAST(ones AS DOUBLE), 0), 6) AS relative_error
            FROM estimates JOIN ({EXACT}) USING (key, n)"""
    return {
        "ones_exact_global": _as_one_stream(EXACT),
        "ones_error_report_global": _as_one_stream(report),
        "read_vectors": f"SELECT CAST(len(embedding) AS INTEGER) AS dimensions, {vector_cells} FROM embeddings",
        "read_alias": ALIASES,
        "read_triples": f"SELECT user_id, item_id, cnt FROM ({PLAYS})",
        "read_ints": "SELECT o_custkey AS value FROM orders",
        "matrix_coo": """
            SELECT r, CAST(dim - 1 AS BIGINT) AS c, round(CAST(embedding[dim] AS DOUBLE), 6) AS v
            FROM (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, embedding FROM embeddings),
                 range(1, 65) t(dim)""",
        "words": WORDS,
        "take_first": "SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 2",
        "pairwise_sqdist": f"{CENTRE_PAIRS} SELECT i, j, round(d * d, 6) AS sqdist FROM near",
        "pairwise_euclid": f"{CENTRE_PAIRS} SELECT i, j, round(d, 6) AS d FROM near",
        "pairwise_square": f"""{CENTRE_PAIRS}
            SELECT i, j, round(d, 6) AS d FROM near
            UNION ALL SELECT j AS i, i AS j, round(d, 6) AS d FROM near
            UNION ALL SELECT CAST(id AS BIGINT), CAST(id AS BIGINT), 0.0 FROM centres""",
        "pairs_within": f"""
            WITH pts AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
            SELECT a.id AS i, b.id AS j, round(list_distance(a.v, b.v), 6) AS d
            FROM pts a JOIN pts b ON a.id < b.id WHERE list_distance(a.v, b.v) <= {RADIUS}""",
        "nearest_pair": """
            WITH pts AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
            near AS (
                SELECT a.id AS i, b.id AS j, list_distance(a.v, b.v) AS d
                FROM pts a JOIN pts b ON a.id < b.id)
            SELECT i, j, round(d, 6) AS d FROM near ORDER BY near.d, i, j LIMIT 1""",
        "alias_resolve": f"SELECT o_orderkey, l_linenumber, user_id, item_id, cnt FROM ({RESOLVED})",
        "row_count": "SELECT count(*) AS n FROM lineitem",
        "int_sum": "SELECT CAST(sum(l_linenumber) AS BIGINT) AS total FROM lineitem",
        "int_avg": "SELECT round(avg(l_linenumber), 6) AS average FROM lineitem",
        "int_distinct": "SELECT DISTINCT o_custkey FROM orders",
        "int_count_distinct": "SELECT count(DISTINCT o_custkey) AS n_distinct FROM orders",
        "int_distinct_avg": """
            SELECT CAST(sum(DISTINCT o_custkey) AS BIGINT) AS distinct_sum,
                   count(DISTINCT o_custkey) AS distinct_count,
                   round(avg(DISTINCT o_custkey), 6) AS distinct_average
            FROM orders""",
        "union_all": """
            SELECT o_custkey AS key FROM orders UNION ALL SELECT c_custkey AS key FROM customer""",
        "intersect_keys": """
            SELECT o_custkey AS key FROM orders INTERSECT SELECT c_custkey AS key FROM customer""",
        "sample_by_hash": f"""
            SELECT o_orderkey, o_custkey FROM orders
            WHERE CAST('0x' || substr({SEEDED}, 1, 8) AS BIGINT) < {hash_threshold(SAMPLE_FRACTION)}""",
        "sample_exact": f"""
            SELECT o_orderkey, o_custkey FROM orders ORDER BY {SEEDED}, o_orderkey LIMIT {SAMPLE_ROWS}""",
        "row_index": """
            SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS idx
            FROM orders""",
        "vowel_counts": f"""
            SELECT doc_id, count(*) AS words, CAST(sum({VOWELS}) AS BIGINT) AS vowels,
                   CAST(max({VOWELS}) AS INTEGER) AS most_vowels
            FROM ({WORDS}) GROUP BY doc_id""",
        "vowel_topk": f"""
            SELECT word, CAST({VOWELS} AS INTEGER) AS vowels FROM ({WORDS})
            ORDER BY vowels DESC, word LIMIT {TOP_WORDS}""",
        "kmeans_assign": f"""{_kmeans(1)}
            SELECT id, b.cluster AS cluster, round(b.d, 6) AS sqdist FROM a0""",
        "kmeans_update": f"""{_kmeans(1)}
            SELECT cluster, CAST(dim - 1 AS INTEGER) AS dim, round(x, 6) AS value FROM m0""",
        "kmeans_sizes": f"{_kmeans(1)} SELECT b.cluster AS cluster, count(*) AS n FROM a0 GROUP BY 1",
        "kmeans_wcv": f"{_kmeans(1)} SELECT round(sum(b.d), 6) AS wcv FROM a0",
        "kmeans_bcv": f"""{_kmeans(1)}
            SELECT round(coalesce(sum(pow(list_distance(a.v, b.v), 2)), 0), 6) AS bcv
            FROM c1 a JOIN c1 b ON a.cluster < b.cluster""",
        "kmeans_shift": f"""{_kmeans(1)}
            SELECT round(sum(pow(list_distance(a.v, b.v), 2)), 6) AS shift
            FROM c0 a JOIN c1 b ON a.cluster = b.cluster""",
        "kmeans_changed": f"""{_kmeans(1)}
            SELECT count(*) > 0 AS changed FROM c1 WHERE v NOT IN (SELECT v FROM c0)""",
        "kmeans_fit": f"{_kmeans(ROUNDS)} {_cells(f'c{ROUNDS}')}",
        "link_single": _linked("min"),
        "link_complete": _linked("max"),
        "link_average": _linked("avg"),
        "link_centroid": CENTROID,
        "hash_rows": f"SELECT p_partkey, {hashed} FROM part",
        "minhash_signatures": f"""{SETS}
            SELECT set_id, array_to_string(s, ',') AS signature FROM signatures""",
        "minhash_overlap": f"""{SETS}
            SELECT set_id, round(len(list_filter(r, lambda e: list_contains(s, e))) / len(r), 6)
                   AS overlap FROM others""",
        "minhash_similarity": f"""{SETS}
            SELECT set_id, round(len(list_filter(list_zip(r, s), lambda e: e[1] = e[2])) / len(r), 6)
                   AS similarity FROM others""",
        "utility_matrix": MATRIX,
        "utility_matrix_sum": f"""
            SELECT user_id, item_id, CAST(sum(cnt) AS BIGINT) AS cnt
            FROM ({RESOLVED}) GROUP BY user_id, item_id""",
        "user_similarity": f"""
            WITH m AS (SELECT DISTINCT user_id, item_id FROM ({RESOLVED}) WHERE user_id IN ({u1}, {u2})),
            c AS (
                SELECT count(*) FILTER (WHERE user_id = {u1}) AS n1,
                       count(*) FILTER (WHERE user_id = {u2}) AS n2,
                       count(*) - count(DISTINCT item_id) AS common
                FROM m)
            SELECT CAST({u1} AS BIGINT) AS user1, CAST({u2} AS BIGINT) AS user2, common,
                   round(common / nullif(n1 + n2 - 2 * common, 0), 6) AS ratio,
                   round(common / (n1 + n2 - common), 6) AS jaccard
            FROM c WHERE n1 > 0 AND n2 > 0""",
        "user_neighbours": f"""
            WITH m AS (SELECT DISTINCT user_id, item_id FROM ({RESOLVED})),
            sizes AS (SELECT user_id, count(*) AS n FROM m GROUP BY user_id),
            met AS (
                SELECT a.user_id, b.user_id AS other_id, count(*) AS common
                FROM m a JOIN m b ON a.item_id = b.item_id AND a.user_id <> b.user_id GROUP BY ALL),
            measured AS (
                SELECT met.*, x.n + y.n - common AS total, common / (x.n + y.n - common) AS jaccard
                FROM met JOIN sizes x ON x.user_id = met.user_id JOIN sizes y ON y.user_id = other_id)
            SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY measured.jaccard DESC, other_id) AS INTEGER) AS rank,
                   other_id, common, round(common / nullif(total - common, 0), 6) AS ratio,
                   round(jaccard, 6) AS jaccard
            FROM measured QUALIFY rank <= {NEAREST_USERS}""",
        "matrix_rows": f"SELECT ri.pos AS pos, r, c, v FROM {ENTRIES} JOIN {ROWS_AT} USING (r)",
        "matrix_cols": f"SELECT ci.pos AS pos, r, c, v FROM {ENTRIES} JOIN {COLUMNS_AT} USING (c)",
        "matrix_intersection": f"""
            SELECT ri.pos AS row_pos, ci.pos AS col_pos, r, c, v
            FROM {ENTRIES} JOIN {ROWS_AT} USING (r) JOIN {COLUMNS_AT} USING (c)""",
        "cur_drawn": f"""
            WITH {CUR}
            SELECT 'r' AS axis, pos, id, round(norm2, 6) AS norm2 FROM rows_drawn
            UNION ALL SELECT 'c', pos, id, round(norm2, 6) FROM columns_drawn""",
        "cur_link": f"""
            WITH {CUR}
            SELECT j AS col_pos, i AS row_pos, y.id AS c, x.id AS r, round(u, 6) AS u
            FROM link JOIN columns_drawn y ON y.pos = j JOIN rows_drawn x ON x.pos = i""",
        "cur_cells": f"""
            WITH {CUR},
            right_side AS (SELECT rm.c, j, sum(u * rm.v) AS x FROM link JOIN rm USING (i) GROUP BY ALL),
            product AS (SELECT cm.r, e.c, sum(cm.v * x) AS approx FROM cm JOIN right_side e USING (j) GROUP BY ALL)
            SELECT r, c, round(v, 6) AS v, round(approx, 6) AS approx FROM cells JOIN product USING (r, c)""",
        "poly_predict": f"""
            SELECT l_orderkey, l_linenumber, round({_value("(l_quantity / 50)")}, 6) AS predicted
            FROM lineitem""",
        "poly_sse": f"""
            SELECT round(sum(pow(l_extendedprice / 100000 - ({_value("(l_quantity / 50)")}), 2)), 6) AS sse
            FROM lineitem""",
        "poly_moments": _moments(),
        "poly_least_squares": _least_squares(""),
        "poly_least_squares_grouped": _least_squares("l_returnflag"),
        "link_labels": f"""{CENTROID.split("SELECT step - 1 AS step")[0]},
            merges AS (
                SELECT l, r, id FROM walk
                WHERE l IS NOT NULL AND step <= (SELECT count(*) FROM embeddings) - {CLUSTERS}),
            climb AS (
                SELECT id AS leaf, id AS node FROM walk WHERE step = 0
                UNION ALL SELECT c.leaf, m.id FROM climb c JOIN merges m ON c.node IN (m.l, m.r)),
            tops AS (SELECT leaf, max(node) AS top FROM climb GROUP BY leaf),
            named AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS leaf FROM embeddings)
            SELECT vec_id AS id, min(vec_id) OVER (PARTITION BY top) AS cluster FROM tops JOIN named USING (leaf)""",
        "ones_exact": EXACT,
        "expwin_blocks": f"""WITH {_live("SELECT key, max(pos) + 1 AS n FROM bits GROUP BY key")}
            SELECT key, n, CAST(level AS INTEGER) AS level, block, block * (1 << level) AS first_pos,
                   (block + 1) * (1 << level) - 1 AS last_pos, CAST(ones AS BIGINT) AS ones
            FROM live JOIN sums USING (key, level, block)""",
        "expwin_estimate": f"{ESTIMATES} SELECT key, n, CAST(estimate AS DOUBLE) AS estimate FROM estimates",
        "ones_error_report": report,
        "expwin_stream": f"{ESTIMATES} SELECT key, n, CAST(estimate AS DOUBLE) AS estimate FROM estimates",
        "expwin_resumed": f"""{ESTIMATES},
            earlier AS (
                SELECT user_id AS key, count(*) AS h FROM events
                WHERE epoch_us(ts) <= (SELECT (epoch_us(min(ts)) + epoch_us(max(ts))) // 2 FROM events)
                GROUP BY user_id)
            SELECT key, n, CAST(estimate AS DOUBLE) AS estimate
            FROM estimates LEFT JOIN earlier USING (key) WHERE n > coalesce(h, 0)""",
    }
