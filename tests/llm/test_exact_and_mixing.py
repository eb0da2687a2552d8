"""Exact dedup and mixing against brute force, with odd cases."""
import hashlib
import re
from collections import defaultdict

import pytest

from cases import SCHEMA, odd_rows, with_extra
from marketlake.llm import exact_dedup, mixing
from marketlake.llm._util import restore


def brute_groups(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i))
    return {k: (min(v, key=lambda b: (b[0], b[1], b[2] or 0))[2], len(v)) for k, v in groups.items()}


@pytest.mark.parametrize("extra", [False, True])
def test_exact_duplicates_match_brute_force(spark, extra):
    rows = odd_rows() + [(100 + i, " a  b", "en", "s1", 1) for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute_groups(rows)
    got = exact_dedup.exact_duplicates(with_extra(df) if extra else df).collect()
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
    for r in got:
        assert (r.keep_id, r.group_size) == by_sha[r.text_sha256]
        assert not r.kept or r.doc_id == r.keep_id


def test_one_id_with_texts_that_differ_in_white_space(spark):
    rows = [(1, "x  y", None, None, 1), (1, "xy", None, None, 1), (2, "x\ny z", None, None, 1), (2, "xy z ", None, None, 1),
            (2, "xyz", None, None, 1)]
    for parts in (1, 3):
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        got = exact_dedup.exact_duplicates(df).collect()
        assert sorted(r.kept for r in got if r.doc_id == 1) == [False, True]
        texts = sorted(r.text for r in restore(exact_dedup.deduplicated(df), df).collect())
        assert texts[0] == "x  y" and len(texts) == 2 and texts == sorted(["x  y", texts[1]])
    assert {texts[1]} <= {"x\ny z", "xy z "}


def test_deduplicated_keeps_one_row_of_repeats(spark):
    rows = odd_rows()
    df = with_extra(spark.createDataFrame(rows, SCHEMA))
    out = restore(exact_dedup.deduplicated(df), df)
    assert out.columns == df.columns
    texts = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in out.collect()]
    assert len(texts) == len(set(texts)) == len(brute_groups(rows))


def test_exact_plan_is_native_and_sorts_ranges(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    plan = exact_dedup.exact_duplicates(df)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "SortAggregate" in plan
    assert "Python" not in plan and "Pandas" not in plan


def water_fill(sizes, weights, cap):
    """Iterative resharing: clamp what is above its cap, share the excess by weight, repeat."""
    total, full, target = sum(sizes), set(), [0.0] * len(sizes)
    while True:
        rest = total - sum(cap * sizes[i] for i in full)
        share = sum(weights[i] for i in range(len(sizes)) if i not in full)
        target = [cap * sizes[i] if i in full else rest * weights[i] / share for i in range(len(sizes))]
        over = {i for i in range(len(sizes)) if i not in full and target[i] > cap * sizes[i]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("sizes", [[100, 10, 1000], [1, 1, 1, 1], [0, 50, 0, 7, 900, 3], [5], [0, 0]])
def test_targets_equal_iterative_resharing(spark, sizes):
    names = [f"s{i}" for i in range(len(sizes) - 1)] + [None]
    df = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    if sum(sizes) == 0:
        assert set(got.values()) == {0.0}
        return
    for name, want in zip(names, water_fill(sizes, weights, 3)):
        assert got[name] == pytest.approx(want, rel=1e-12, abs=1e-9)


def test_mix_takes_near_targets_and_repeats(spark):
    rows = odd_rows() + [(1000 + i, "t " * (i % 37), None, "big" if i % 3 else "small", 1) for i in range(600)]
    df = with_extra(spark.createDataFrame(rows, SCHEMA))
    got = mixing.mix(df).collect()
    assert sorted((r.doc_id or -1, r.size, r.taken) for r in got) == sorted(
        (r.doc_id or -1, r.size, r.taken) for r in mixing.mix(df.repartition(7)).collect())
    assert len(got) == len(rows)
    by_target = defaultdict(list)
    for r in got:
        assert r.taken <= 3 * r.size and r.taken == r.size * r.copies
        by_target[r.source, r.source_size, r.target].append(r)
    for (_, source_size, target), part in by_target.items():
        assert sum(r.size for r in part) == source_size
        assert abs(sum(r.taken for r in part) - target) <= max(r.size for r in part) / 2 + 1e-6


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.exact_duplicates(df).collect() == []
    assert mixing.mix(df).collect() == []
