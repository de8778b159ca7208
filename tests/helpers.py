"""Small builders shared by the tests."""

import numpy as np


def matrix_df(spark, x):
    """A dense numpy matrix as long-form (user_idx, item_idx, value)."""
    rows, cols = np.nonzero(x)
    data = [(int(r), int(c), float(x[r, c])) for r, c in zip(rows, cols)]
    return spark.createDataFrame(data, "user_idx bigint, item_idx bigint, value double")


def cosine(x):
    """Item-item cosine with zero diagonal, written the plain way."""
    n2 = (x**2).sum(0)
    with np.errstate(divide="ignore", invalid="ignore"):
        s = np.nan_to_num(x.T @ x / np.sqrt(np.outer(n2, n2)))
    np.fill_diagonal(s, 0.0)
    return s


def top_edges(s, k, minimum=0.0):
    """{(i, j)} of each row's k best positive entries, ties to the smaller column."""
    keep = set()
    for i, row in enumerate(s):
        best = sorted((-v, j) for j, v in enumerate(row) if v > 0 and v >= minimum)
        keep |= {(i, j) for _, j in (best if k is None else best[:k])}
    return keep


# Likes of five users over six items.
SIMPLE = np.zeros((5, 6))
for _u, _items in enumerate([(0, 1), (0, 2), (1, 2, 3), (3, 4), (4, 5)]):
    SIMPLE[_u, list(_items)] = 1.0
