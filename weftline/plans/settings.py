"""Parameters of the registered queries, shared with their SQL."""

from weftline.operators.minhash import hash_params

K = 5
ROUNDS = 3
RADIUS = 1.1
CLUSTERS = 10

HASHES = hash_params(30, seed=7)
MODULUS = 100_000

SAMPLE_FRACTION = 0.1
SAMPLE_ROWS = 100
SAMPLE_SEED = 1

TOP_WORDS = 10
USERS = (1, 2)
NEAREST_USERS = 5
MATRIX_ROWS = [3, 7, 3]
MATRIX_COLUMNS = [1, 5]
CUR_SIZE = 3
CUR_SEED = 1

DEGREE = 2
COEFFICIENTS = [0.1, 0.5, 0.2]
RATE = 0.0004

WIDTH = 20
LAST_K = 15
