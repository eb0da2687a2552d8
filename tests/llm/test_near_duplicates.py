"""MinHash and embedding near-duplicates against exact brute force, and the pipeline's stages."""
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from cases import SCHEMA, odd_rows, sentences, with_extra
from marketlake.llm import embedding_dedup, minhash_dedup
from marketlake.llm import _components
from marketlake.llm._components import connected, joined


def union_find(items):
    parent = {i: i for i in items}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(a, b):
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)

    return top, join


def shingles(text, width):
    ws = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        ws = ws.replace(c, " ")
    ws = [w for w in ws.split(" ") if w]
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i:i + width]) for i in range(max(1, len(ws) - width + 1)))


def brute_components(rows, width):
    sets = {i: shingles(t, width) for i, t in rows}
    top, join = union_find(sets)
    ids = [i for i in sets if sets[i]]
    for a in ids:
        for b in ids:
            if a < b:
                common = len(sets[a] & sets[b])
                if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                    join(a, b)
    return {i: (len(sets[i]), top(i)) for i in sets}


def edited(rng, text, edits):
    ws = text.split()
    for _ in range(edits):
        ws[rng.randrange(len(ws))] = f"new{rng.randrange(10_000)}"
    return " ".join(ws)


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_match_brute_force(spark, width):
    rng = random.Random(width)
    texts = sentences(40, 1) + sentences(10, 2, words=3) + ["One  two", "one TWO", "one", "ONE ", "", None, " \n"]
    for base in sentences(6, 3, words=60):      # families around the threshold, with copies
        texts += [edited(rng, base, rng.randrange(4)) for _ in range(25)] + [base] * 5
    ids = rng.sample(range(10_000), len(texts))
    df = with_extra(spark.createDataFrame([(i, t, None, None, 1) for i, t in zip(ids, texts)], SCHEMA))
    want = brute_components(list(zip(ids, texts)), width)
    for r in minhash_dedup.near_duplicates(df, width=width).collect():
        assert (r.n_shingles, r.component_id) == want[r.doc_id]
        assert r.kept == (r.doc_id == r.component_id)


@pytest.mark.parametrize("centres", [0, 1, 3])
def test_links_beside_the_star_are_found(spark, monkeypatch, centres):
    """A chain of texts in which neighbours are linked but the ends are far from the centre: one
    large bucket family, cut into many small blocks and star pieces."""
    monkeypatch.setattr(minhash_dedup, "BLOCK_BYTES", 5 * 8 * 99)
    monkeypatch.setattr(minhash_dedup, "CENTRES", centres)
    ws = [f"c{i}" for i in range(400)]
    rows = [(i, " ".join(ws[4 * i:4 * i + 100]), None, None, 1) for i in range(60)]
    want = brute_components([(r[0], r[1]) for r in rows], 2)
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(
        spark.createDataFrame(rows, SCHEMA), width=2).collect()}
    assert got == {i: c for i, (_, c) in want.items()}


@pytest.mark.parametrize("outsiders, most", [(3, 1), (40, 8)])
def test_only_outsiders_are_dealt_to_chunks(spark, monkeypatch, outsiders, most):
    """Rows that go to blocks: every entry once per chunk of outsiders, not once per chunk of the bucket."""
    monkeypatch.setattr(minhash_dedup, "BLOCK_BYTES", 5 * 8 * 10)
    nodes = [bytes([i // 256, i % 256]) for i in range(1000)]
    entries = spark.createDataFrame([(1, n, 10) for n in nodes], "bucket long, node binary, n long")
    parts = spark.createDataFrame([(n, b"family") for n in nodes[outsiders:]], "node binary, component binary")
    open_ = minhash_dedup._open_entries(entries, parts)
    assert open_.filter("outsider").count() == outsiders and open_.count() == 1000
    centres = minhash_dedup._further_centres(open_).collect()
    assert 1 <= len(centres) <= minhash_dedup.CENTRES and {bytes(c.centre) for c in centres} <= set(nodes[:outsiders])
    counts = {r["query"]: r["count"] for r in minhash_dedup._dealt_blocks(open_).groupBy("query").count().collect()}
    assert counts[False] == 1000 * most and counts[True] == outsiders * 200


def test_hot_group_of_copies(spark):
    rows = [(i, "the same words in every row", None, None, 1) for i in range(500)]
    rows += [(1000 + i, t, None, None, 1) for i, t in enumerate(sentences(500, 9))]
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter(r.component_id for r in got)[0] == 500 and sum(r.kept for r in got) == 501


def test_odd_rows_and_empty(spark):
    got = minhash_dedup.near_duplicates(with_extra(spark.createDataFrame(odd_rows(), SCHEMA)), width=2).collect()
    assert len(got) == len(odd_rows())
    empty = [r for r in got if r.n_shingles == 0]
    assert all(r.component_id == r.doc_id for r in empty)
    assert minhash_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(f"W{i % 701}\t" for i in range(5000))
    whole = minhash_dedup.shingle_sets([text, "x"], 2)[0]
    monkeypatch.setattr(minhash_dedup, "PIECE_BYTES", 1000)
    assert np.array_equal(minhash_dedup.shingle_sets([text], 2)[0], whole) and len(whole) == 701


def test_densified_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    donors, close = minhash_dedup.donor_order(), []
    for _ in range(60):
        both = rng.integers(0, 2 ** 63, 36, dtype=np.uint64) * np.uint64(2)
        a, b = np.unique(both[:30]), np.unique(np.r_[both[6:30], both[30:]])      # Jaccard 24 / 36
        s = minhash_dedup.signatures([a, b], donors)
        close.append((s[0] == s[1]).mean())
    assert np.mean(close) == pytest.approx(24 / 36, abs=0.06)


def test_connected_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 90)] + [(1000 + rng.randrange(60), 1000 + rng.randrange(60)) for _ in range(50)]
    edges += [(2000, 2000 + i) for i in range(1, 300)]
    top, join = union_find({x for e in edges for x in e})
    for a, b in edges:
        join(a, b)
    got = {r.node: r.component for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: top(n) for a, b in edges if a != b for n in (a, b)}
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []


def test_stars_need_no_round(spark, monkeypatch):
    """CHECK r03, op 9: the last round of every search for components changed nothing."""
    rounds = []
    step = _components._large_star
    monkeypatch.setattr(_components, "_large_star", lambda edges: rounds.append(1) or step(edges))
    stars = [(h, h + i) for h in (0, 100, 200) for i in range(1, 50)]
    parts = connected(spark.createDataFrame(stars, "a long, b long"))
    assert not rounds and {(r.node, r.component) for r in parts.collect()} == {(b, a) for a, b in stars} | {(h, h) for h in (0, 100, 200)}
    assert not _components._are_stars(spark.createDataFrame([(3, 2), (2, 1)], "u long, v long"))
    assert not _components._are_stars(spark.createDataFrame([(3, 2), (3, 1)], "u long, v long"))
    more = joined(parts, spark.createDataFrame([(149, 201), (300, 301)], "a long, b long"))
    want = {n: 0 for n in range(50)} | {n: 100 for n in [*range(100, 150), *range(200, 250)]} | {300: 300, 301: 300}
    assert {r.node: r.component for r in more.collect()} == want and rounds


def test_blocks_are_dealt_without_a_further_join(spark):
    """CHECK r03, pipeline: a join of all open entries to find the sizes that the entries can carry."""
    entries = spark.createDataFrame([(1, b"a", 10), (1, b"b", 10), (1, b"c", 10)], "bucket long, node binary, n long")
    parts = spark.createDataFrame([(b"a", b"a"), (b"b", b"a")], "node binary, component binary")
    open_ = minhash_dedup._open_entries(entries, parts).localCheckpoint()
    plan = minhash_dedup._dealt_blocks(open_)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert sorted((bytes(r.node), r.query) for r in minhash_dedup._dealt_blocks(open_).collect()) == [
        (b"a", False), (b"b", False), (b"c", False), (b"c", True)]


# --- embeddings ----------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def vector_rows(seed=0, dim=24):
    rng = np.random.default_rng(seed)
    rows, n = [], 0
    for _ in range(25):
        centre = rng.standard_normal(dim)
        for _ in range(12):     # cosines on both sides of the threshold
            v = centre / np.linalg.norm(centre) + rng.standard_normal(dim) * rng.uniform(0, 0.12)
            rows.append((n, (v * rng.uniform(0.1, 9)).astype(np.float32).tolist(), int(n % 3)))
            n += 1
    rows += [(n + i, rows[5][1], rows[5][2]) for i in range(7)]
    return rows


def brute_vectors(rows):
    good = [(i, np.array(v, dtype=np.float64), lab) for i, v, lab in rows
            if lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    top, join = union_find([i for i, _, _ in good])
    links = Counter()
    for x, (i, a, la) in enumerate(good):
        for j, b, lb in good[x + 1:]:
            if la == lb and len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.93:
                links[i] += 1
                links[j] += 1
                join(i, j)
    return {i: (links[i], top(i)) for i, _, _ in good}


def test_embeddings_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 40)
    rows = vector_rows() + [(900, None, 1), (901, [], 1), (902, [0.0] * 24, 1), (903, [float("nan")] * 24, 1),
                            (904, [None] + [1.0] * 23, 1), (905, [float("inf")] * 24, 1), (906, [1.0, 2.0], 1),
                            (907, [2.0, 4.0], 1), (908, [1.0, 2.0], None), (909, [3.0], 2), (910, [5.0], 2)]
    want = brute_vectors(rows)
    assert 20 < sum(n > 0 for n, _ in want.values()) < len(want)
    for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect():
        assert (r.n_links, r.component_id) == want.get(r.vec_id, (0, r.vec_id)), r
        assert r.kept == (r.vec_id == r.component_id)


def test_embeddings_recall_is_one_and_count_filters():
    rng = np.random.default_rng(8)
    a = rng.standard_normal((300, 64))
    noise = rng.standard_normal((300, 64))
    noise -= (noise * a).sum(1, keepdims=True) / (a * a).sum(1, keepdims=True) * a
    tan = np.tan(np.arccos(0.9301))
    b = a + noise / np.linalg.norm(noise, axis=1, keepdims=True) * np.linalg.norm(a, axis=1, keepdims=True) * tan
    i, j = embedding_dedup.links(a, b, 0.93)
    assert {(k, k) for k in range(300)} <= set(zip(i.tolist(), j.tolist()))
    directions = embedding_dedup.rotation(64)
    half, least = embedding_dedup.window(0.93, directions.shape[1])
    unit = a / np.linalg.norm(a, axis=1, keepdims=True) @ directions
    passed = (embedding_dedup.count_collisions(unit, unit, half) >= least).mean()
    assert passed < 0.05


def test_embeddings_odd_and_empty(spark):
    rows = vector_rows()[:20] + [(None, vector_rows()[0][1], 0), (3, vector_rows()[3][1], 0), (3, vector_rows()[3][1], 0)]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'x' node", "'y' component_id", "1 n_links", "2 `row`")
    assert embedding_dedup.near_duplicates(df).count() == len(rows)
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], VECTORS)).collect() == []


# --- pipeline ---------------------------------------------------------------------------------------

def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(6)
    base = sentences(150, 21, words=60)
    docs = [(i, t, "en", f"s{i % 3}", 1) for i, t in enumerate(base)]
    docs += [(1000 + i, base[i] + " ", "en", "s0", 1) for i in range(20)]                    # exact copies
    docs += [(2000 + i, edited(rng, base[i + 30], 1), "en", "s1", 1) for i in range(20)]     # near copies
    docs += [(3000 + i, t + " vilewretch" * 5, "en", "s2", 1) for i, t in enumerate(sentences(90, 22))]
    docs += [docs[3], (None, None, None, None, None)]
    labels = [(d[0], 1, int(3000 <= (d[0] or 0))) for d in docs if d[0] is not None and d[0] % 5]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    clean = stages["toxicity"](spark, df, str(tmp_path))
    assert clean.columns == df.columns
    left = {r.doc_id for r in clean.collect()}
    assert len([i for i in left if i and i >= 3000]) <= 3 and len(left) >= 185
    exact = stages["exact_dedup"](spark, clean, str(tmp_path)).collect()
    kept = [r.doc_id for r in exact]
    # the copy with the longer original text stays; a row that repeats id and text stays once
    assert len(kept) == len(set(kept)) and not {*range(20)} & {*kept}
    near = stages["minhash_dedup"](spark, spark.createDataFrame(exact, SCHEMA), str(tmp_path)).collect()
    want = defaultdict(set)
    for i, (_, c) in brute_components([(r.doc_id, r.text) for r in exact if r.doc_id is not None], 5).items():
        want[c].add(i)
    assert {r.doc_id for r in near} == {min(v) for v in want.values()} | {None}
    mixed = stages["mixing"](spark, spark.createDataFrame(near, SCHEMA), str(tmp_path))
    assert mixed.columns == df.columns and max(Counter(r.doc_id for r in mixed.collect()).values()) <= 3
    last = stages["sentencepiece"](spark, mixed, str(tmp_path)).collect()
    assert len(last) == mixed.count() and all(r.n_tokens == len(r.ids) for r in last)
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id or -1, r.ids_sha256) for r in whole) == sorted((r.doc_id or -1, r.ids_sha256) for r in last)


def test_full_sets_are_made_once_by_one_worker_a_task(spark, tmp_path, capsys):
    """A filter on the node below the join would make all sets a second time, in a second worker of the task."""
    rows = [(i, None if i == 3 else f"a b c d e f {i % 4} g") for i in range(12)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    src = spark.read.parquet(f"{tmp_path}/docs")
    nodes = src.select(minhash_dedup._signature_column(5)("text").alias("s"), "doc_id").select("s.node", "doc_id")
    wanted = nodes.filter("node is not null").groupBy("node").agg({"doc_id": "min"}).toDF("node", "low_id")
    wanted.write.parquet(f"{tmp_path}/wanted")
    sets = minhash_dedup._full_sets(src, spark.read.parquet(f"{tmp_path}/wanted"), 5)
    sets.explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1
    assert sorted(len(r.elements) // 8 for r in sets.collect()) == [4] * 4


def test_pipeline_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_pipeline_mixing_passes_rows_without_words_once(spark):
    rows = [(i, None if i % 3 == 0 else "  " if i % 3 == 1 else "", None, f"s{i % 4}", 0) for i in range(24)]
    rows += [(100 + i, f"some words here {i}", None, "big" if i else "small", 1) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = Counter(r.doc_id for r in corpus_pipeline.mix_sources(spark, df, None).collect())
    assert all(out[i] == 1 for i in range(24)) and max(out.values()) <= 3
