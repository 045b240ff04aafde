"""Operators over whole corpora and the pipeline, against brute force."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from cardtide.llm import decontaminate, mixing, partenum
from cardtide.llm.queries import QUERIES


def brute_groups(rows, width, num, den):
    """Smallest id reachable by links, by comparing every pair of sets."""
    sets = []
    for _, text in rows:
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode("utf-8", "surrogatepass").split()
        grams = {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}
        sets.append(grams or ({tuple(words)} if words else set()))
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * min(len(a), len(b)) >= num * max(len(a), len(b)):
                same = len(a & b)
                if den * same >= num * (len(a) + len(b) - same):
                    group[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    smallest = {g: min((m for m in ids if m is not None), default=None) for g, ids in members.items()}
    return sorted(((rows[i][0], len(sets[i]), smallest[find(i)] if sets[i] else rows[i][0]) for i in range(len(rows))), key=repr)


def planted(seed=4, documents=120):
    """Texts of many lengths with near copies around the threshold, chains and shared passages."""
    dice = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = dice.choices(vocabulary, k=60)
    rows = []
    for base in range(documents):
        words = dice.choices(vocabulary, k=dice.choice([1, 3, 4, 5, 8, 9, 12, 20, 40, 90, 200, 500]))
        if base % 3 == 0:
            words = passage + words
        rows.append(" ".join(words))
        for _ in range(dice.choice([0, 0, 1, 3, 14])):
            copy = list(words)
            for _ in range(dice.choice([0, 1, 1, 2, 3, len(words) // 30])):
                copy[dice.randrange(len(copy))] = dice.choice(vocabulary)
            rows.append(" ".join(copy))
            if dice.random() < 0.3:
                words = copy  # the next copy is one of this copy
    dice.shuffle(rows)
    return [(1000 + i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("heavy", [partenum.HEAVY, 2])
@pytest.mark.parametrize("width, similar", [(4, (85, 100)), (5, (80, 100))])
def test_groups_match_all_pairs(llm, width, similar, heavy):
    rows = planted()
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = partenum.jaccard_groups(docs, width, partenum.Fraction(*similar), heavy).collect()
    assert sorted(map(tuple, got), key=repr) == brute_groups(rows, width, *similar)


def test_near_misses_in_common_buckets_are_all_compared(llm):
    """Sets that share nearly everything and mostly stay below the threshold, around one common text."""
    dice = random.Random(12)
    base = [f"w{i}" for i in range(130)]
    rows = []
    for i in range(220):
        words = list(base)
        for _ in range(dice.choice([2, 2, 2, 2, 3, 3])):
            words[dice.randrange(len(words))] = f"x{dice.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute_groups(rows, 4, 85, 100)
    assert 10 < len({c for _, _, c in want}) < 200
    assert sorted(map(tuple, partenum.jaccard_groups(docs).collect()), key=repr) == want


def test_signatures_meet_for_every_similar_pair():
    dice = np.random.default_rng(7)
    for similar in (partenum.Fraction(85, 100), partenum.Fraction(80, 100)):
        bands = partenum.Bands(similar)
        for size in (7, 10, 25, 60, 150, 700):
            for _ in range(30):
                a = np.unique(dice.integers(0, 2**63, size).astype(np.uint64))
                common = dice.integers(int(size * float(similar)), size + 1)
                extra = dice.integers(0, 2**63, max(0, int(common / similar) - size)).astype(np.uint64)
                b = np.unique(np.concatenate([a[:common], extra]))
                same = len(np.intersect1d(a, b))
                if same < similar * (len(a) + len(b) - same) or np.array_equal(a, b):
                    continue
                left = {t: (s, set(m.tolist())) for t, s, m in partenum.signatures(a, bands)}
                right = {t: (s, set(m.tolist())) for t, s, m in partenum.signatures(b, bands)}
                assert any(len(left[t][1] & right[t][1]) > max(left[t][0], right[t][0]) for t in left.keys() & right.keys())


@pytest.mark.parametrize("band_of", [3, 10, 40, 150, 600])
def test_a_band_agrees_on_more_signatures_than_its_margin(band_of):
    """The plan's bound against the worst spread of differing parts over the groups."""
    for similar in (partenum.Fraction(85, 100), partenum.Fraction(80, 100)):
        bands = partenum.Bands(similar)
        plan = bands.plan(bands.band(band_of))
        assert plan.difference == max(
            a + b - 2 * same for a in [bands.largest(bands.band(band_of))] for b in range(1, a + 1)
            for same in range(1, b + 1) if same >= similar * (a + b - same)) or plan.difference < 2
        left = np.full(plan.groups, plan.parts)  # differing parts fall where they cost most
        cost = lambda parts_hit: {2: (1, 1), 3: (2, 1, 0)}[plan.parts][parts_hit]
        hit = np.zeros(plan.groups, dtype=int)
        for _ in range(plan.difference):
            g = max(range(plan.groups), key=lambda i: cost(hit[i]) if hit[i] < plan.parts else -1)
            left[g] -= cost(hit[g])
            hit[g] += 1
        assert left.sum() > plan.margin >= 2


def test_small_bands_enumerate_pairs_of_parts():
    bands = partenum.Bands(partenum.SIMILAR)
    some = np.arange(1, 61, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    plan = bands.plan(bands.band(60))
    assert plan.parts == 3
    tag, spare, marks = partenum.signatures(some, bands)[0]
    assert spare >= 0 and plan.groups * 3 - plan.margin <= len(marks) <= plan.groups * 3
    # One element more changes one part, which two of the group's three signatures hold.
    more = np.append(some, np.uint64(5))
    assert bands.band(61) == bands.band(60)
    other = partenum.signatures(more, bands)[0][2]
    assert len(np.setdiff1d(marks, other)) in (1, 2)


def test_awkward_rows_form_groups(awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    got = partenum.jaccard_groups(awkward).collect()
    assert sorted(map(tuple, got), key=repr) == brute_groups(rows, 4, 85, 100)
    kept = partenum.drop_near_copies(awkward)
    assert kept.columns == awkward.columns
    assert sum(r.doc_id == 1000 for r in kept.collect()) == 1
    assert partenum.drop_near_copies(nothing).count() == 0 and partenum.jaccard_groups(nothing).count() == 0


def test_one_of_each_group_stays(llm):
    rows = planted(9, 60) + [(1000, "one two three four five six seven")] * 2 + [(None, "one two three four five six seven")]
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = sorted(r.doc_id for r in partenum.drop_near_copies(docs, 5, partenum.Fraction(80, 100)).collect())
    groups = brute_groups([(i, t) for i, t in rows if i is not None and i != 1000], 5, 80, 100)
    expected = {c for _, _, c in groups}
    assert set(kept) - {1000} == expected - {1000} and len([i for i in kept if i != 1000]) == len(expected - {1000})


# decontamination

def edit_distance_in(item, text):
    """Least distance of the item to any stretch of the text, by the plain table."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        last, row[0] = row[0], 0
        for i, d in enumerate(item, 1):
            last, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, last + (c != d))
        best = min(best, row[-1])
    return best


def test_pieces_are_one_more_than_the_budget():
    for length in (20, 40, 85, 333):
        for errors in range(length // 10):
            pieces = [p for p in decontaminate.split(length, errors) if p.errors == 0]
            assert len(pieces) == errors + 1
            assert sorted((p.start, p.end) for p in pieces)[0][0] == 0 and sum(p.end - p.start for p in pieces) == length


def test_items_are_found_within_their_budget(llm):
    dice = random.Random(2)
    syllables = ["th", "an", "er", "on", "in", "the ", "re ", "st", "ou, ", "é"]
    text = lambda n: "".join(dice.choices(syllables, k=n))
    items = [(i, text(dice.randint(12, 60))) for i in range(12)]
    searcher = decontaminate.Searcher(items)
    for item_id, item in items:
        whole = decontaminate.normalized(item)
        k = decontaminate.budget(len(whole))
        for edits in (0, 1, k // 2, k, k + 2, 2 * k + 3):
            changed = list(whole)
            for _ in range(edits):
                at = dice.randrange(len(changed))
                changed[at:at + 1] = dice.choice([[], ["x"], [changed[at], "q"]])
            host = decontaminate.normalized(text(30) + " " + "".join(changed) + " " + text(20))
            found = {m.item_id: m for m in searcher.search(host)}
            distance = edit_distance_in(whole, host)
            assert (item_id in found) == (distance <= k)
            if item_id in found:
                m = found[item_id]
                assert edit_distance_in(whole, host[m.start:m.end]) == m.distance == distance


def test_the_least_distance_of_periodic_items():
    """Worse matches of the same item stand right before, after and across the best one."""
    dice = random.Random(8)
    for _ in range(400):
        item = (dice.choice(["abcab", "ab", "abcd efg ", "aab"]) * 40)[:dice.randint(25, 60)]
        item = decontaminate.normalized(item)
        k = decontaminate.budget(len(item))
        copies = []
        for _ in range(3):
            changed = list(item)
            for _ in range(dice.choice([0, 0, 1, k, k + 2])):
                changed[dice.randrange(len(changed))] = dice.choice("abcxyz")
            copies.append("".join(changed)[dice.choice([0, 0, 3]):])
        host = decontaminate.normalized(dice.choice(["", " ", "ab"]).join(copies))
        found = decontaminate.Searcher([(1, item)]).search(host)
        distance = edit_distance_in(item, host)
        assert [m.distance for m in found] == [distance] * (distance <= k)
        assert all(edit_distance_in(item, host[m.start:m.end]) == m.distance for m in found)


@pytest.mark.parametrize("rate", [0.1, 0.25])
def test_copies_with_all_the_edits_of_the_rate_are_found(rate):
    dice = random.Random(5)
    for length in (20, 25, 30, 95, 100, 233):
        item = decontaminate.normalized("".join(dice.choices("abcdefghijklmnopqrstuvwxyz", k=length)))
        k = int(rate * length)
        for edits, found in ((k, True), (k + 1, False)):
            # Edits at even distances, so that no piece longer than needed stays whole.
            places = {(2 * i + 1) * length // (2 * edits) for i in range(edits)}
            host = "".join("#" if i in places else c for i, c in enumerate(item))
            assert len(places) == edits and edit_distance_in(item, host) == edits
            got = decontaminate.Searcher([(1, item)], rate).search(f"%% {host} %%")
            assert [m.distance for m in got] == [edits] * found
    with pytest.raises(ValueError):
        decontaminate.budget(50, 1.0)


def test_contaminated_documents(llm, medium_dir):
    got = QUERIES["op9_pigeonhole"](llm, medium_dir).collect()
    items = {r.item_id: decontaminate.normalized(r.text) for r in llm.read.parquet(f"{medium_dir}/benchmark.parquet").collect()}
    docs = {r.doc_id: decontaminate.normalized(r.text) for r in llm.read.parquet(f"{medium_dir}/documents.parquet").collect()}
    exact = {(d, i) for d, text in docs.items() for i, item in items.items() if item in text}
    assert exact == {(r.doc_id, r.item_id) for r in got if r.distance == 0} and len(exact) > 10
    for r in got:
        assert edit_distance_in(items[r.item_id], docs[r.doc_id][r.start:r.end]) == r.distance <= 0.1 * r.item_chars


def test_blocks_of_items_and_awkward_rows(llm, medium_dir, awkward, nothing):
    docs, items = (llm.read.parquet(f"{medium_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    one = decontaminate.contaminated(docs, items).collect()
    many = decontaminate.contaminated(docs, items, block_chars=2000).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))
    odd = items.limit(3).unionAll(llm.createDataFrame([(None, "x" * 90), (7, None), (8, "")], "item_id long, text string"))
    assert decontaminate.contaminated(awkward, odd).count() == 0 and decontaminate.contaminated(nothing, items).count() == 0
    assert decontaminate.clean_documents(awkward, odd).count() == awkward.count()
    assert decontaminate.clean_documents(docs, items.limit(0)).count() == docs.count()


# mixing

def test_rates_reach_the_targets(llm, medium_dir):
    got = QUERIES["op5_mixing"](llm, medium_dir).toPandas()
    p = got[[f"p_{d}" for d in mixing.DOMAINS]].to_numpy()
    assert np.allclose(p.sum(1), 1) and (got.rate >= 0).all() and len(got) == 1000
    shares = (got.tokens.to_numpy() * got.rate.to_numpy()) @ p / got.tokens.sum()
    assert np.abs(shares - np.array(mixing.WEIGHTS)).sum() < 0.02
    copies = (got.tokens * got.copies).sum() / (got.tokens * got.rate).sum()
    assert 0.9 < copies < 1.1
    labels = llm.read.parquet(f"{medium_dir}/labels.parquet").toPandas().merge(got, on="doc_id")
    named = np.where(labels.toxic == 1, 2, np.where(labels.quality == 1, 1, 0))
    assert (labels[[f"p_{d}" for d in mixing.DOMAINS]].to_numpy().argmax(1) == named).mean() > 0.9
    assert (labels[(labels.quality == 1) & (labels.toxic == 0)].copies >= 1).mean() > 0.97


def plain_rates(p, tokens, goal, rounds=40_000):
    """The least-squares problem by very many plain projected-gradient rounds; the objective it ends with."""
    share = tokens / tokens.sum()
    size = share @ p
    rates = np.ones(len(p))
    for _ in range(rounds):
        rates = np.maximum(0.0, rates - p @ (((share * rates) @ p - goal) / size))
    return (((share * rates) @ p - goal) ** 2 / size).sum() / 2


@pytest.mark.filterwarnings("ignore:600 rounds")
@pytest.mark.parametrize("sharpness, goal", [(0.3, (0.2, 0.5, 0.3)), (0.3, (0.0, 0.96, 0.04)), (3.0, (0.0, 0.96, 0.04)), (0.05, (0.0, 0.5, 0.5))])
def test_fitted_rates_solve_the_least_squares_problem(llm, monkeypatch, sharpness, goal):
    rng = np.random.default_rng(0)
    p = rng.dirichlet(sharpness * np.array([0.4, 1.0, 0.5]), 300)
    tokens = rng.integers(1, 500, 300).astype(float)
    judged = llm.createDataFrame([(int(t), [float(x) for x in row]) for t, row in zip(tokens, p)], "_tokens long, _p array<double>")
    if goal[0] == 0.0:  # hundreds of rounds: their totals are added up here instead of by a job each
        monkeypatch.setattr(mixing, "_shares", lambda _, steps: (tokens.sum(), (tokens * mixing.replayed_rates(p, steps)) @ p))
    plan = mixing.fit_rates(judged, goal)
    rates = plan.rates(pd.Series(list(p)))
    reached = (tokens * rates) @ p / tokens.sum()
    assert (plan.converged or len(plan.steps) == mixing.ROUNDS) and (rates >= 0).all() and np.allclose(plan.reached, reached, atol=1e-9)
    size = tokens @ p / tokens.sum()
    objective = ((reached - np.array(goal)) ** 2 / size).sum() / 2
    # The fit ends where the targets are reached to TOLERANCE, or comes as close as very many plain rounds.
    assert np.abs(reached - goal).sum() <= mixing.TOLERANCE or objective <= 1.05 * plain_rates(p, tokens, np.array(goal)) + 1e-8


def test_rounds_that_do_not_suffice_are_told(llm):
    judged = llm.createDataFrame([(5, [0.4, 0.5, 0.1]), (9, [0.3, 0.3, 0.4])], "_tokens long, _p array<double>")
    with pytest.warns(RuntimeWarning, match="3 rounds"):
        plan = mixing.fit_rates(judged, (0.0, 0.5, 0.5), rounds=3)
    assert not plan.converged and len(plan.steps) == 3


def test_mixing_awkward_tables(llm, awkward, nothing):
    labels = awkward.selectExpr("doc_id", "cast(doc_id % 2 as int) quality", "cast(doc_id % 3 = 0 as int) toxic")
    assert mixing.document_rates(awkward, labels).count() == awkward.count()
    assert mixing.mixed_documents(awkward, labels).columns == awkward.columns
    none = labels.limit(0)
    rates = mixing.document_rates(awkward, none, (1.0, 1.0, 1.0)).toPandas()
    assert np.allclose(rates.rate, 1) and (rates.copies == 1).all()
    assert mixing.document_rates(nothing, none).count() == 0 and mixing.mixed_documents(nothing, none).count() == 0


# pipeline

def test_pipeline_stages(llm, medium_dir):
    docs = llm.read.parquet(f"{medium_dir}/documents.parquet")
    labels = llm.read.parquet(f"{medium_dir}/labels.parquet").toPandas()
    quality = dict(zip(labels.doc_id, labels.quality))
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "benchmark", "mixing", "sharding"]
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = f"{corpus_pipeline.new_folder(llm, 'test')}"
        stage(llm, tables[-1], medium_dir).write.parquet(path)
        tables.append(llm.read.parquet(path))
        if name != "sharding":
            assert tables[-1].columns == columns
    before, good, alone, clean, mixed, sharded = [t.toPandas() for t in tables]
    known = good[good.doc_id.isin(quality)]
    assert np.mean([quality[i] for i in known.doc_id]) > 0.99
    assert sum(quality.get(i) == 1 for i in good.doc_id) > 0.98 * sum(quality[i] == 1 for i in quality if i in set(before.doc_id))
    groups = brute_groups(list(zip(good.doc_id, good.text)), 5, 80, 100)
    assert sorted(alone.doc_id) == sorted({c for _, _, c in groups})
    items = [decontaminate.normalized(r.text) for r in llm.read.parquet(f"{medium_dir}/benchmark.parquet").collect()]
    leaks = {i for i, t in zip(alone.doc_id, alone.text) if any(item in decontaminate.normalized(t) for item in items)}
    assert leaks and set(clean.doc_id) == set(alone.doc_id) - leaks
    assert set(mixed.doc_id) <= set(clean.doc_id)
    assert sorted(sharded.doc_id) == sorted(mixed.doc_id)
    crc = {i: zlib.crc32(t.encode()) for i, t in zip(mixed.doc_id, mixed.text)}
    assert all(crc[i] == c for i, c in zip(sharded.doc_id, sharded.text_crc32))
    for _, slots in sharded.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))


def test_pipeline_stages_on_awkward_tables(llm, medium_dir, awkward, nothing):
    for docs in (awkward, nothing):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(llm, docs, medium_dir)
            assert out.count() <= 2 * docs.count() and (name == "sharding" or out.columns == docs.columns)


CLASHING = ("row", "key", "id", "wins", "maybe", "text_key", "text_hash", "spans", "clean", "at", "own", "crc", "shard", "slot", "a.b", "c`d",
            "_p", "_rate", "_copies", "_copy", "_judged", "_tokens", "_key", "_id", "_hash", "_maybe", "_text_key", "_wins", "_spans", "node", "label")


def test_columns_of_any_name_keep_their_values(llm, tmp_path):
    """Every operator that returns documents hands on all their columns, whatever they are called."""
    from cardtide.llm import sanitise, sharding

    texts = [t for _, t in planted(5, 20)] + ["write to jo@example.org now"] * 2
    rows = [(i, t, *[f"{name}{i}" for name in CLASHING]) for i, t in enumerate(texts)]
    docs = llm.createDataFrame(rows, ["doc_id", "text", *CLASHING])
    labels = llm.createDataFrame([(i, i % 2, 0) for i in range(len(rows))], "doc_id long, quality int, toxic int")
    before = {r[0]: tuple(r) for r in docs.collect()}
    for out in (partenum.drop_near_copies(docs), mixing.mixed_documents(docs, labels)):
        assert out.columns == docs.columns and out.count() > 0
        assert all(tuple(r) == before[r[0]] for r in out.collect())
    clean = sanitise.sanitised_documents(docs)
    assert clean.columns == docs.columns
    assert all(r[2:] == before[r[0]][2:] for r in map(tuple, clean.collect())) and clean.where("text like '%<email>%'").count() == 2
    sharding.write_shards(docs, str(tmp_path / "shards"))
    back = llm.read.parquet(str(tmp_path / "shards"))
    assert back.columns == [*docs.columns, "shard_of"] and {tuple(r)[:-1] for r in back.collect()} == set(before.values())


def test_joined_rows_stay_in_proportion_to_one_large_group(llm):
    """Chains, stars and near misses: contraction carries each edge over once per round, and few rounds do."""
    dice = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 3000)] + [(5000, 5000 + i) for i in range(1, 2000)] + [(9000 + i, 8999 - i) for i in range(500)]
    dice.shuffle(edges)
    calls = []
    real = partenum.stage

    def counting(df, name):
        out = real(df, name)
        calls.append((name, out.count()))
        return out
    partenum.stage = counting
    try:
        got = dict(map(tuple, partenum.components(llm.createDataFrame(edges, "a long, b long").repartition(4)).collect()))
    finally:
        partenum.stage = real
    above = {}

    def root(n):
        while above.get(n, n) != n:
            n = above[n]
        return n
    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        if low != high:
            above[high] = low
    assert got == {n: root(n) for e in edges for n in e}
    assert sum(n for name, n in calls if name == "edges") <= 2 * len(edges)


def test_clusters_join_all_that_signatures_connect(llm):
    dice = random.Random(4)
    rows = [(s, k) for s in range(300) for k in {dice.randrange(900) for _ in range(dice.choice([1, 2, 2, 3]))}] + [(-1, k) for k in range(400)]
    count = {}
    for s, _ in rows:
        count[s] = count.get(s, 0) + 1
    incidence = llm.createDataFrame([(s, k, count[s]) for s, k in rows], "sig long, key long, members long").repartition(3)
    got = dict(map(tuple, partenum.clusters(incidence).collect()))
    above = {}

    def root(n):
        while above.get(n, n) != n:
            n = above[n]
        return n
    first = {}
    for s, k in rows:
        low, high = sorted((root(first.setdefault(s, k)), root(k)))
        if low != high:
            above[high] = low
    linked = {k for s, k in rows if count[s] > 1}
    assert got == {k: root(k) for k in linked}
