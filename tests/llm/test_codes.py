"""Vector codes against a plain product quantiser, and their defined cases."""

import hashlib
import math

import numpy as np
import pytest

from marketbars.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts, entries, rounds, scale):
    """Codes, errors and codebooks by full search; ids are distinct."""
    kept = {i: [math.floor(scale * float(np.float32(x))) for x in v] for i, v, _ in rows}
    ids = sorted(kept)
    width = len(kept[ids[0]]) // parts
    cut = {i: [v[p * width:(p + 1) * width] for p in range(parts)] for i, v in kept.items()}
    books = [[cut[i][p] for i in ids[:entries]] for p in range(parts)]

    def best(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            found = {}
            for i in ids:
                found.setdefault(best(cut[i][p], books[p])[1], []).append(cut[i][p])
            for k, members in found.items():
                books[p][k] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    out = {}
    for i in ids:
        pairs = [best(cut[i][p], books[p]) for p in range(parts)]
        out[i] = ("".join(f"{k:02x}" for _, k in pairs), sum(d for d, _ in pairs))
    flat = ",".join(str(x) for b in books for e in b for x in e)
    return out, hashlib.sha256(flat.encode()).hexdigest()


@pytest.mark.parametrize("seed", [1, 2])
def test_codes_equal_full_search(spark, seed):
    rng = np.random.default_rng(seed)
    # Few distinct values, so that distances tie and entries repeat.
    rows = [(int(i), [float(x) for x in rng.integers(-3, 4, 8) / 4], int(i) % 3) for i in rng.permutation(120)]
    found = codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(5), entries=9, scale=4, pivots=3)
    want, digest = plain(rows, 4, 9, codes.ROUNDS, 4)
    assert {r.vec_id: (r.code, r.error) for r in found.rows.collect()} == want
    assert found.digest() == digest
    totals = codes.with_label_error(found.rows).collect()
    label = {i: k for i, _, k in rows}
    for r in totals:
        assert r.label_error == sum(e for i, (_, e) in want.items() if label[i] == label[r.vec_id])


def test_bounds_leave_out_entries_and_no_nearest_one():
    rng = np.random.default_rng(5)
    centres = rng.integers(-2000, 2000, (40, 6))
    points = (centres[rng.integers(0, 40, 3000)] + rng.integers(-20, 20, (3000, 6))).astype(np.int64)
    entries = np.vstack([centres, centres[:5]]).astype(np.int64)
    pivots = codes.choose_pivots(entries[None], 4)[0]
    index, best, evaluated = codes.nearest(points, codes.far(points, pivots), entries, codes.far(entries, pivots))
    all_pairs = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (index == all_pairs.argmin(axis=1)).all() and (best == all_pairs.min(axis=1)).all()
    assert evaluated < 0.5 * all_pairs.size


def test_rows_that_are_dropped_or_have_no_code(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25, -0.5, 0.0], None), (2, [0.5, 0.25, -0.5, 0.125], None), (2, [0.0, 0.0, 0.0, 0.0], 1),
            (None, [1.0, 1.0, 1.0, 1.0], 1), (4, None, 1), (5, [1.0, None, 0.0, 0.0], 1), (6, [nan, 0.0, 0.0, 0.0], 1),
            (7, [inf, 0.0, 0.0, 0.0], 1), (8, [0.0] * 8, 2), (0, [1.0], 2), (9, [], 2), (10, [1e30, 0.0, 0.0, 0.0], 2)]
    found = codes.compress(spark.createDataFrame(rows, SCHEMA), rounds=1)
    # Ids 1 and 2 start the entries, and of the two rows of id 2 the smaller vector does.
    assert found.entries.shape == (4, 2, 1)
    out = codes.with_label_error(found.rows).collect()
    kept = sorted((r.vec_id if r.vec_id is not None else -1, r.code is None) for r in out)
    assert kept == [(-1, False), (0, True), (1, False), (2, False), (2, False), (8, True), (9, True), (10, True)]
    assert all((r.error is None) == (r.code is None) for r in out)
    assert len({r.label_error for r in out if r.label is None}) == 1
    assert {r.label_error for r in out if r.label == 2} == {None}


def test_empty_table_other_names_and_clashing_columns(spark):
    none = codes.compress(spark.createDataFrame([], SCHEMA))
    assert codes.with_label_error(none.rows).collect() == []
    assert none.digest() == hashlib.sha256(b"").hexdigest()
    rows = spark.createDataFrame([(3, [1.0, 2.0, 3.0, 4.0], "a", 7.0, "x")],
                                 "id int, v array<double>, kind string, far double, code string")
    out = codes.compress(rows, vec_id="id", vector="v", label="kind")
    assert [tuple(r) for r in codes.with_label_error(out.rows).collect()] == [(3, "a", "00000000", 0, 0)]
