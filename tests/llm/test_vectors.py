"""Top-k search, whitening and spelling variants against brute force."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardtide.llm import queries, topk, variants, vectors, whitening

VECTORS = "vec_id long, embedding array<double>, label int, rank string, x string, query string, score string, slab string"


@pytest.fixture(scope="module")
def mixed_vectors(llm):
    """Ties, repeated rows, null ids, vectors that take no part, unequal lengths, clashing columns."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, size=19) / 256) for i in range(330)]
    rows += [(50, np.zeros(19)), (7, rows[7][1]), (None, rng.standard_normal(19)), (2 ** 60, rng.standard_normal(19)), (2 ** 60 + 1, rng.standard_normal(19))]
    rows = [(i, [float(c) for c in v]) for i, v in rows]
    rows += [(400, None), (450, [1.0, None]), (500, [float("nan")]), (550, [float("inf")] * 19), (600, []), (650, [1.0]), (701, [-2.0, 0.5]), (-50, [0.25] * 19)]
    return llm.createDataFrame([(*r, 1, "a", "b", "c", "d", "e") for r in rows], VECTORS).repartition(3)


def plain(rows):
    """``id, components`` of the rows that take part, by Python's whole numbers."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dims = max((len(v) for _, v in kept), default=0)
    return [(i, [math.floor(256 * c) for c in v] + [0] * (dims - len(v))) for i, v in kept]


def plain_top(rows, k):
    whole = plain(rows)
    out = []
    for q, x in whole:
        if q is None or q % 50:
            continue
        scores = [(-sum(a * b for a, b in zip(x, y)), i is None, i or 0) for i, y in whole if i != q]
        out += [(q, r + 1, None if no else i, -s) for r, (s, no, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("k", [5, 1000])
def test_top_k_equals_all_pairs(mixed_vectors, k, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 8)  # several blocks of queries
    rows = [(r.vec_id, r.embedding) for r in mixed_vectors.collect()]
    got = topk.nearest(mixed_vectors, k=k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_top(rows, k)


def test_top_k_of_wide_numbers(llm):
    """Sums beyond 2^53 are exact; beyond 64 bits they become the nearest long."""
    rows = [(0, [2.0 ** 25, 1.0]), (1, [2.0 ** 15, 1 / 256]), (2, [2.0 ** 15, 0.0]), (3, [1e300, 0.0]), (50, [-1e300, 1.0])]
    got = topk.nearest(llm.createDataFrame(rows, "vec_id long, embedding array<double>")).where("query_id = 0").orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(3, 2 ** 63 - 1), (1, 2 ** 56 + 256), (2, 2 ** 56), (50, -2 ** 63)]


def test_bounds_keep_every_pair_above_the_threshold():
    rng = np.random.default_rng(0)
    for _ in range(20):
        q, c = (rng.integers(-9, 10, size=(n, 37)).astype(float) for n in (12, 300))
        scores = q @ c.T
        least = np.sort(scores, 1)[:, -rng.integers(1, 40)]
        which, at, score = topk.live_pairs(q, np.ascontiguousarray(c.T), topk.masses(c).T, least)
        want = set(zip(*np.nonzero(scores >= least[:, None])))
        got = dict(zip(zip(which, at), score))
        assert want <= set(got) and all(scores[p] == s for p, s in got.items())


def test_empty_tables_have_no_answers(llm, nothing):
    empty = llm.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.nearest(empty).count() == 0 and whitening.whiten(empty).count() == 0
    assert variants.variants(nothing).count() == 0


def test_top_k_sql_at_small_scale(llm, small_dir):
    from checks.compare import connect

    got = queries.QUERIES["op11_columnar_topk"](llm, small_dir).toPandas()
    want = connect(small_dir).execute(queries.ORACLES["op11_columnar_topk"]).fetchdf()
    assert sorted(got.itertuples(index=False, name=None)) == sorted(want[got.columns].itertuples(index=False, name=None))


def plain_whitening(rows, wanted=4):
    whole = plain(rows)
    ids, x = [i for i, _ in whole], np.array([v for _, v in whole], dtype=float)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    c = fit - sums / n
    v = c.T @ c / n
    values, vecs = np.linalg.eigh(v)
    values, vecs = values[::-1][:wanted], vecs[:, ::-1][:, :wanted]
    return ids, n, ((n * x - sums) ** 2).sum(1), (x - sums / n) @ vecs / np.sqrt(values), values / np.trace(v)


def test_whitening_equals_dense_eigenvectors(mixed_vectors):
    rows = [(r.vec_id, r.embedding) for r in mixed_vectors.where("vec_id is not null and vec_id <> 50 and vec_id <> 7").collect()]
    ids, n, deviation, whitened, explained = plain_whitening(rows)
    got = whitening.whiten(mixed_vectors.where("vec_id is not null and vec_id <> 50 and vec_id <> 7")).toPandas()
    assert len(got) == 4 * len(ids) and set(got.n) == {n} and got.identity_error.max() < 1e-9
    table = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    signs = np.sign((table * whitened).sum(0))
    np.testing.assert_allclose(table * signs, whitened, rtol=1e-8, atol=1e-9)
    np.testing.assert_allclose(got.groupby("component").explained.first(), explained, rtol=1e-9)
    assert got[got.component == 1].set_index("vec_id").deviation.loc[ids].tolist() == deviation.astype(int).tolist()


def test_whitening_counts_distinct_vectors_once(llm):
    """Repeated rows are fitted once and projected each time; null ids too; flat directions go."""
    rows = [(None, [0.0, 1.0]), (1, [4.0, 1.0]), (1, [4.0, 1.0]), (2, [4.0, 1.0]), (3, None)]
    got = whitening.whiten(llm.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert len(got) == 4 and {r.component for r in got} == {1} and {r.n for r in got} == {2}
    assert {r.deviation for r in got} == {1024 ** 2} and {round(abs(r.whitened), 12) for r in got} == {1.0}
    assert sum(r.vec_id is None for r in got) == 1 and {r.explained for r in got} == {1.0}
    same = llm.createDataFrame([(1, [1.0]), (2, [1.0])], "vec_id long, embedding array<float>")
    assert whitening.whiten(same).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_solver_reaches_double_precision(seed):
    """Matrices with equal, close and vanishing eigenvalues."""
    rng = np.random.default_rng(seed)
    dims = int(rng.integers(1, 90))
    turn = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
    values = np.sort(rng.random(dims))[::-1] * 1000.0
    if seed % 3 == 1:
        values[:6] = values[0]
    if seed % 3 == 2:
        values[3:] = 0.0
    v = (turn * values) @ turn.T
    v = (v + v.T) / 2
    got, vecs = whitening.leading(lambda w: v @ w, dims, 4, values.sum())
    np.testing.assert_allclose(got, values[:4], atol=1e-10)
    assert np.abs(v @ vecs - vecs * got).max() < 1e-10 and np.abs(vecs.T @ vecs - np.eye(len(got))).max() < 1e-13


def test_solver_tells_when_it_does_not_converge(monkeypatch):
    monkeypatch.setattr(whitening, "MAX_TURNS", 1)
    v = np.diag(np.arange(1.0, 60.0))
    with pytest.raises(ArithmeticError):
        whitening.leading(lambda w: v @ w, 59, 4, v.trace())


def test_deviations_beyond_64_bits():
    x = np.array([[1 << 40], [3]])
    assert whitening.deviations(x, 2, [7]) == [None, 1]
    assert whitening.deviations(np.array([[1 << 20], [3]]), 2, [7]) == [((1 << 21) - 7) ** 2, 1]


def test_slabs_keep_ids_and_numbers(llm):
    rows = [(2 ** 62 + i, [float(i), -1.0][:1 + i % 2]) for i in range(50)] + [(None, [2.0 ** 40])]
    whole = vectors.whole_vectors(llm.createDataFrame(rows, "vec_id long, embedding array<double>"))
    for by_column in (True, False):
        slabs = [vectors.Slab(r, by_column) for r in vectors.packed(whole, 2, by_column, rows=7).collect()]
        assert max(len(s.ids) for s in slabs) <= 7
        got = {None if no else int(i): row.tolist() for s in slabs for i, no, row in zip(s.ids, s.no_id, s.x.T if by_column else s.x)}
        assert got == {i: [int(256 * c) for c in v] + [0] * (2 - len(v)) for i, v in rows}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(counts):
    out = []
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def words_of(rows):
    counts = Counter()
    for doc_id, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def test_variants_equal_all_pairs(llm, small_dir):
    docs = llm.read.parquet(f"{small_dir}/documents.parquet").limit(60).select("doc_id", "text").cache()
    got = sorted(map(tuple, variants.variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()))
    want = plain_variants(words_of([tuple(r) for r in docs.collect()]))
    assert got == want and any(w[1] for w in want)


def test_variants_in_large_buckets(llm, monkeypatch):
    """One half shared by all words: many parts and tiles, every pair met once."""
    monkeypatch.setattr(variants, "PART_WORDS", 90)
    rng = np.random.default_rng(1)
    words = {"stem" + "".join(rng.choice(list("abéÿ"), size=rng.integers(1, 5))): int(rng.integers(1, 9)) for _ in range(600)}
    words |= {w[::-1]: n for w, n in words.items()} | {"stemaaaa" * 900: 3, "stemaaaa" * 900 + "b": 50}
    df = llm.createDataFrame(list(words.items()), "word string, n long")
    cells = variants.near_words(df, part_words=90)
    assert cells.count() == len({w for w in words for v in words if one_edit(w, v)})
    got = sorted(map(tuple, variants.group_variants(df).collect()))
    assert got == plain_variants(words)


def test_words_of_awkward_rows(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = {r.word: r.n for r in variants.counted_words(awkward).collect()}
    assert got == words_of(rows)
    assert variants.variants(awkward).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_chains_lead_to_the_last_form(llm):
    chain = [(f"word{i:02d}", f"word{i + 1:02d}") for i in range(37)]
    got = {r.word: r.root for r in variants.roots(llm.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {w: "word37" for w, _ in chain}
