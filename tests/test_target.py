"""Target statistics of categories against a plain version."""

from __future__ import annotations

import hashlib

import pytest

from clickloom.operators import encoders


def plain(data, seed, weight):
    """By id: mean target of the rows of the category that come before."""
    order = sorted(data, key=lambda r: hashlib.md5(f"{seed}-{r[0]}".encode()).hexdigest())
    known = [t for _, _, t in data if t is not None]
    prior = sum(known) / len(known)
    seen, found = {}, {}
    for i, c, t in order:
        n, total = seen.get(c, (0, 0.0))
        found[i] = (total + weight * prior) / (n + weight)
        if t is not None:
            seen[c] = (n + 1, total + t)
    return found, {c: (t + weight * prior) / (n + weight) for c, (n, t) in seen.items()}, prior


@pytest.mark.parametrize("weight", [1.0, 5.0])
def test_ordered_target_equals_the_plain_version(rows, weight):
    # A third of all rows in one category, a null category, many categories of one row.
    data = [(i, "hot" if i % 3 == 0 else f"c{i % 40}" if i % 3 == 1 else None, float(i % 7 == 0))
            for i in range(900)]
    data += [(900 + i, f"once{i}", None if i % 2 else 1.0) for i in range(50)]
    frame = rows(data, "id long, c string, t double")
    expected, _, _ = plain(data, 3, weight)
    found = encoders.ordered_target(frame, ["c"], "t", "id", 3, weight)
    assert found.columns == ["id", "c", "t", "c_target"]
    assert {r.id: pytest.approx(r.c_target) for r in found.collect()} == expected
    again = encoders.ordered_target(frame.repartition(7), ["c"], "t", "id", 3, weight)
    assert sorted(r.c_target for r in again.collect()) == pytest.approx(sorted(expected.values()))


def test_statistics_of_other_rows(rows):
    data = [(1, "a", 1.0), (2, "a", 0.0), (3, None, 1.0), (4, "b", None)]
    frame = rows(data, "id long, c string, t double")
    table = encoders.target_table(frame, "c", "t")
    prior = encoders.target_prior(frame, "t")
    others = rows([(9, "a"), (8, None), (7, "new"), (6, "b")], "id long, c string")
    found = encoders.with_target(others, table, "c", prior)
    assert {r.id: pytest.approx(r.c_target) for r in found.collect()} == {
        9: (1 + 2 / 3) / 3, 8: (1 + 2 / 3) / 2, 7: 2 / 3, 6: 2 / 3,
    }


def test_empty_table(rows):
    frame = rows([], "id long, c string, t double")
    assert encoders.ordered_target(frame, ["c"], "t", "id").count() == 0
    assert encoders.target_prior(frame, "t") == 0.0
