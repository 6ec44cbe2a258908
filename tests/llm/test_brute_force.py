"""Every operator against a plain version on the smallest tables or small fixtures."""

from __future__ import annotations

import base64
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import ann, chaining, knn, language_id, line_dedup, mixing, packing, queries, simhash, suffix_dedup, warc
from starloom.llm._components import connected_components


def docs_of(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_language_held_out_accuracy(spark, sf_dir):
    found = language_id.op1_language_id(spark, sf_dir).join(docs_of(spark, sf_dir).select("doc_id", "lang"), "doc_id").toPandas()
    held = found[found.held_out]
    assert len(found) == docs_of(spark, sf_dir).count() and 0 < len(held) < len(found)
    assert (held.lang == held.lang_pred).mean() > 0.95
    assert found.score.between(0, 1).all() and found.accepted.mean() > 0.99


ODD = [
    "今天天气很好，我们一起去公园散步吧，然后回家吃饭。", "Сегодня хорошая погода, мы пойдём гулять в парк после обеда.",
    "Dzisiaj jest bardzo ładna pogoda i chętnie pójdziemy na spacer do parku.", "asdkjh qwlekj zxcmnb poiqwe lkjasd mnbzxc qpwoei zmxncb", "AAAA AAAA AAAA AAAA",
    "xkcd zzzz qqqq wwww vvvv kkkk jjjj",
]


def test_texts_in_no_learned_language_are_rejected_and_mixed_ones_stay(spark, sf_dir):
    docs = docs_of(spark, sf_dir)
    model = language_id.train(docs.where(~language_id.held_out()).select("text", "lang"))
    texts = {r["lang"]: r["text"] for r in docs.where("lang is not null and length(text) > 400").orderBy("doc_id").collect()}
    a, *rest = texts.values()
    mixed = [" ".join(x for pair in zip(a.split()[:60], b.split()[:60], strict=False) for x in pair) for b in rest]
    cases = [(t, False) for t in ODD] + [(t, True) for t in mixed] + [(t[:200].rsplit(" ", 1)[0], True) for t in texts.values()]
    frame = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id int, text string")
    found = {r["doc_id"]: r for r in language_id.predict(frame, model).collect()}
    assert [found[i]["accepted"] for i in range(len(cases))] == [known for _, known in cases]
    assert all(r["lang_pred"] in model.languages for r in found.values())


def test_copies_neither_fill_nor_empty_the_sample(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(language_id, "fit", lambda bags, labels, buckets, kinds: taken.append(Counter(x for x, k in zip(labels, kinds, strict=True) if k == 0)))
    rows = [("un texte " + str(i), "fr") for i in range(300)] + [("some text " + str(i), "en") for i in range(300)] + [("one text", "en")] * 6000
    language_id.train(spark.createDataFrame(rows, "text string, lang string"), per_language=250)
    assert 200 <= taken[0]["fr"] <= 300 and 200 <= taken[0]["en"] <= 300


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_groups(items, linked):
    parent = {i: i for i, _ in items}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(items):
        for j, y in items[:a]:
            if linked(x, y):
                p, q = top(i), top(j)
                parent[max(p, q)] = min(p, q)
    return {i: top(i) for i, _ in items}


def test_simhash(spark, sf_dir):
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op2_simhash(spark, sf_dir).collect()}
    prints = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs_of(spark, sf_dir).collect()]
    groups = plain_groups(prints, lambda x, y: (x ^ y).bit_count() <= 4)
    assert found == {i: (f"{x:016x}", groups[i]) for i, x in prints}


@pytest.mark.parametrize("hot", [2, 256])
def test_links_lose_nothing_in_hot_shards(spark, hot):
    rng = random.Random(4)
    centers = [rng.getrandbits(64) for _ in range(6)]
    values = {rng.choice(centers) ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(7))) & (2**64 - 1) for _ in range(250)}
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), hot=hot)
    got = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    wanted = plain_groups([(v, v % 2**64) for v in signed], lambda x, y: (x ^ y).bit_count() <= 4)
    assert {v: got.get(v, v) for v in signed} == wanted


@given(st.lists(st.integers(0, 2**64 - 1), max_size=40), st.integers(0, 2**64 - 1), st.integers(0, 64))
def test_bk_tree(values, asked, radius):
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    assert sorted(tree.within(asked, radius)) == sorted({v for v in values if (v ^ asked).bit_count() <= radius})


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 80)]
    found = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(path + star + [(5, 5), (5, 4)], "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(80)}


def test_ann_recall_and_scores(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    ids, x = rows.vec_id.to_numpy(), np.stack(rows.embedding).astype(float)
    found = ann.op3_ann(spark, sf_dir).toPandas()
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[q]
        scores[q] = -np.inf
        best = ids[np.lexsort((ids, -scores))[: min(20, len(ids) - 1)]]
        own = found[found.query_id == ids[q]].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, len(best) + 1))
        assert np.allclose(own.score, scores[np.searchsorted(ids, own.vec_id)])
        hits, total = hits + len(set(best) & set(own.vec_id)), total + len(best)
    assert hits / total >= 0.9


def exact_neighbours(x, q, k):
    s = x @ x[q]
    s[q] = -np.inf
    return set(np.lexsort((np.arange(len(x)), -s))[:k].tolist())


@pytest.mark.parametrize("clusters", [80, 0])
def test_ann_visits_a_part_and_still_recalls(spark, monkeypatch, clusters):
    """With many blocks and salted groups; clustered vectors, and vectors of no structure at all."""
    for name, value in (("BLOCK_ROWS", 500), ("SHARE_QUERIES", 16), ("SAMPLE_ROWS", 1000)):
        monkeypatch.setattr(ann, name, value)
    budgets = []
    calibrated = ann._calibrated
    monkeypatch.setattr(ann, "_calibrated", lambda *a: budgets.append(calibrated(*a)) or budgets[-1])
    rng = np.random.default_rng(5)
    x = rng.normal(size=(80, 32))[rng.integers(0, 80, 4000)] + 0.3 * rng.normal(size=(4000, 32)) if clusters else rng.normal(size=(4000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = ann.search(df, df.where("vec_id % 40 = 0"), 10).toPandas()
    hits = sum(len(exact_neighbours(x, q, 10) & set(found[found.query_id == q].vec_id)) for q in range(0, 4000, 40))
    print("recall", hits / 1000, "budget", budgets)
    assert hits / 1000 >= 0.9 and (budgets[0] < 1000 if clusters else budgets[0] <= 4000 * 48)


def test_equal_vectors_are_one_entry(spark):
    """A third of all rows hold one vector: the least ids that have it come first, and the work doesn't grow with them."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8))
    x[::3] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for found in (ann.search(df, df.where("vec_id % 2 = 0"), 5, budget=1e9), knn.search(df, df.where("vec_id % 2 = 0"), 5)):
        found = found.toPandas()
        y = x if found.score.dtype == float else np.floor(256 * x)
        for q in range(0, 300, 2):
            s = y @ y[q]
            s[q] = -np.inf
            own = found[found.query_id == q].sort_values("rank")
            assert own.vec_id.tolist() == np.lexsort((np.arange(300), -np.round(s, 9)))[:5].tolist()


def test_prefix_ranges_are_counted_exactly(spark):
    """Counts over blocks and salts against the strings themselves; ascents against their definition."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 12))
    x[:200] = x[0] + 1e-4 * rng.normal(size=(200, 12))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, v array<double>")
    trees = 4
    index = ann._with_strings(df, 12, 1e3, trees, False)
    code = {r["vec_id"]: r["strings"] for r in index.collect()}
    strings = np.array([code[i] for i in range(900)])
    bounds = np.sort(strings, axis=0)[[150, 300, 450, 600, 750]].T.copy()
    sizes = np.stack([np.bincount(ann._block_of(bounds, strings)[:, t], minlength=6) for t in range(trees)])
    found = {r["vec_id"]: r["counts"] for r in ann._range_counts(index, index.where("vec_id % 9 = 0"), bounds, sizes, trees).collect()}
    for q, counts in found.items():
        for depth in range(ann.SYMBOLS + 1):
            true = int(((strings >> ann._shift(depth)) == (strings[q] >> ann._shift(depth))).sum())
            whole = [(np.searchsorted(bounds[t], strings[q, t] >> ann._shift(depth) << ann._shift(depth), "right"), np.searchsorted(bounds[t], (strings[q, t] >> ann._shift(depth) << ann._shift(depth)) + (1 << ann._shift(depth)) - 1, "right")) for t in range(trees)]
            if all(a == b for a, b in whole) or depth == 0:
                assert counts[depth] == true
            else:
                assert counts[depth] >= true
    depth, ahead = ann.ascent(np.array([[400, 90, 40, 4], [400, 4, 4, 4], [8, 8, 8, 8]]), 60, 4)
    assert depth.tolist() == [1, 0, 3] and ahead.tolist() == [2, 1, 4]


def test_knn_is_exact(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    ids, x = rows.vec_id.to_numpy(), np.floor(256 * np.stack(rows.embedding).astype(float)).astype(np.int64)
    wanted = set()
    for q in np.flatnonzero(ids % 50 == 0):
        s = x @ x[q]
        order = [j for j in np.lexsort((ids, -s)) if j != q][:5]
        wanted |= {(ids[q], k, ids[j], s[j]) for k, j in enumerate(order, 1)}
    assert {tuple(r) for r in knn.op5_knn(spark, sf_dir).collect()} == wanted


def test_knn_with_clusters_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_QUERIES", 8)
    monkeypatch.setattr(knn, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(6)
    x = rng.integers(-3, 4, (10, 6))[rng.integers(0, 10, 600)] + rng.normal(scale=0.05, size=(600, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {tuple(r) for r in knn.search(df, df.where("vec_id % 7 = 0"), 3, pivots=6).collect()}
    y = np.floor(256 * x).astype(np.int64)
    wanted = set()
    for q in range(0, 600, 7):
        s = y @ y[q]
        wanted |= {(q, k, j, s[j]) for k, j in enumerate([j for j in np.lexsort((np.arange(600), -s)) if j != q][:3], 1)}
    assert found == wanted


def plain_substrings(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[p : p + length] for t in raw for p in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((len(t), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def test_substrings_on_the_tables(spark, sf_dir):
    rows = docs_of(spark, sf_dir).orderBy("doc_id").collect()
    found = suffix_dedup.op4_suffix_dedup(spark, sf_dir).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in found] == plain_substrings([r["text"] for r in rows], 400)


@pytest.mark.parametrize(("length", "hot"), [(32, 256), (32, 4), (17, 2), (50, 8)])
def test_substrings_with_hot_cores(spark, tmp_path, length, hot):
    rng = random.Random(1)
    base = ["".join(rng.choices("abcd é", k=120)) for _ in range(6)]
    texts = []
    for _ in range(100):
        t = "".join(rng.choices("abcdef", k=rng.randint(0, 60)))
        for _ in range(rng.randint(0, 3)):
            u = rng.randint(0, 60)
            t += rng.choice(base)[u : rng.randint(u, 120)] + "".join(rng.choices("abc", k=rng.randint(0, 4)))
        texts.append(t)
    texts += [None, "", "a" * 300, "a" * 300, "ab" * 90, "abc" * 99 + "x", "q" + "abc" * 70] + ["".join(rng.choices("xyz", k=50)) + base[0] + "".join(rng.choices("xyz", k=50)) for _ in range(50)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    found = suffix_dedup.dedup_substrings(spark.read.parquet(str(tmp_path / "d")), length, hot).orderBy("doc_id").collect()
    assert [tuple(r)[1:5] for r in found] == plain_substrings(texts, length)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=30).map(lambda b: bytes(x % 3 + 97 for x in b)), min_size=1, max_size=30))
def test_deep_shallow_sorting(strings):
    order, shared = suffix_dedup.deep_shallow(strings, 8)
    assert [strings[i] for i in order] == sorted(strings) and sorted(order) == list(range(len(strings)))
    for k in range(1, len(order)):
        a, b = strings[order[k - 1]], strings[order[k]]
        n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert shared[k] == n


def test_packing_is_best_fit(spark, sf_dir):
    found = packing.op6_packing(spark, sf_dir).toPandas()
    texts = {r["doc_id"]: r["text"] for r in docs_of(spark, sf_dir).collect()}
    pieces = defaultdict(str)
    for r in found.sort_values(["doc_id", "piece"]).itertuples():
        pieces[r.doc_id] += texts[r.doc_id][r.start : r.start + r.n_chars]
    assert dict(pieces) == texts
    for _, own in found.groupby("bin_id"):
        own = own.sort_values("position")
        assert own.position.tolist() == [0, *own.n_chars.cumsum().tolist()[:-1]]
        assert own.capacity.iloc[0] == min(c for c in packing.LENGTHS if c >= own.n_chars.sum())
    bins = found.groupby("bin_id")
    cost = sum(map(packing.sequence_cost, bins.capacity.first()))
    sizes = sorted(found.n_chars.tolist(), reverse=True)
    for least in packing.LENGTHS:
        assert cost <= plain_cost(sizes, least) + 1e-6
    assert bins.n_chars.sum().sum() == sum(sizes)


def plain_cost(sizes, least):
    """Best fit with a fixed least length to open, bins downsized at the end."""
    bins = []
    for s in sizes:
        fits = [b for b in bins if b[0] >= s]
        if fits:
            b = min(fits, key=lambda b: b[0])
        else:
            b = [next(c for c in packing.LENGTHS if c >= max(s, least)), 0]
            bins.append(b)
        b[0], b[1] = b[0] - s, b[1] + s
    return sum(packing.sequence_cost(min(c for c in packing.LENGTHS if c >= b[1])) for b in bins)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 64), max_size=40), st.one_of(st.none(), st.integers(1, 4)))
def test_packings_fit_and_cost_no_more_than_any_fixed_length(sizes, open_bins):
    lengths, cost = [8, 16, 32, 64], lambda c: 4 + c + c * c / 100
    sizes = sizes if open_bins else sorted(sizes, reverse=True)
    bins, offsets, capacity = packing.best_fit(sizes, lengths, cost, open_bins)
    filled = defaultdict(int)
    for s, b, at in zip(sizes, bins, offsets, strict=True):
        assert at == filled[b]
        filled[b] += s
    assert all(capacity[b] == min(c for c in lengths if c >= n) for b, n in filled.items())
    total = sum(map(cost, capacity))
    for least in lengths:
        assert total <= sum(map(cost, packing._packed(sizes, lengths, cost, open_bins, least)[2])) + 1e-9


def test_lookahead_opens_a_short_bin_where_little_is_left_and_a_long_one_for_many_pieces():
    cost = lambda c: 100 + c
    assert packing._packed([5, 3], [8, 64], cost, None, None)[2] == [8]
    assert packing._packed([20] * 3 + [4], [24, 64], cost, None, None)[2] == [64]
    assert packing._packed([8] * 4, [8, 64], lambda c: 100 if c > 8 else 1, None, None)[2] == [8] * 4


def test_packing_of_many_blocks_and_ties(spark):
    rows = spark.range(900).selectExpr("id % 7 AS doc_id", "repeat('x', cast(100 * (id % 5) AS int)) AS text")
    found = packing.pack(rows, [256, 512], block_items=100)
    bins = found.groupBy("bin_id").agg(F.sum("n_chars").alias("n"), F.max("capacity").alias("c"), F.min("capacity").alias("d"), F.count("*").alias("k")).collect()
    assert len({r["bin_id"] >> 20 for r in bins}) > 5 and sum(r["k"] for r in bins) == 900
    assert all(r["c"] == r["d"] == (256 if r["n"] <= 256 else 512) and r["n"] <= 512 for r in bins)
    assert found.groupBy("bin_id", "position").agg(F.sum(F.sign("n_chars")).alias("m")).where("m > 1").count() == 0


def test_many_equal_rows_are_numbered_in_parts(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(mixing, "HOT_ROWS", 64)
    rows = [(1, "a")] * 3000 + [(i, "b") for i in range(500)] + [(i, None) for i in range(100)]
    spark.createDataFrame(rows, "doc_id long, source string").repartition(5).write.parquet(str(tmp_path / "d"))
    found = mixing.mix(spark.read.parquet(str(tmp_path / "d")), block_rows=4).toPandas()
    assert len(found) == 3600 and not found.duplicated(["mix_slot", "mix_row"]).any()
    assert ((found.mix_slot >= found.mix_release) & (found.mix_slot < found.mix_deadline)).all()
    assert sorted(found.fillna("").groupby("source").mix_block.nunique()) == [25, 125, 750]


def test_archives(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    first = {}
    for r in sorted(pages, key=lambda r: r["page_id"]):
        first.setdefault(r["html"], r["page_id"])
    wanted = []
    for r in pages:
        raw, own = r["html"].encode(), first[r["html"]] == r["page_id"]
        wanted.append((r["page_id"], len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if own else "revisit", None if own else first[r["html"]]))
    found = warc.op7_warc(spark, sf_dir).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, found)) == sorted(wanted)


def test_archive_predicates_are_pushed(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_warc(spark.createDataFrame([(1, "u", "x"), (2, "u", "x")], "page_id long, url string, html string"), path)
    found = warc.read_warc(spark, path, "record_id string, record_type string").where("record_type = 'revisit'")
    assert "Filter " not in found._jdf.queryExecution().executedPlan().toString()
    assert [r["record_id"] for r in found.collect()] == ["<urn:page:2>"]


def test_oracle_texts(spark, duck, sf_dir):
    for name, text in queries.ORACLE_SQL.items():
        found = queries.QUERIES[name](spark, sf_dir)
        columns = ", ".join(f'"{c}"' for c in found.columns)
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(duck.sql(f"SELECT {columns} FROM ({text})").fetchall(), key=repr), name


def plain_lines(texts, size, long_words=50):
    seen, out = set(), []
    for t in texts:
        lines = t.split("\n")
        gone = [False] * len(lines)
        for n in dict.fromkeys((size, 1)):
            for i in range(len(lines) - n + 1):
                w = tuple(lines[i : i + n])
                if n == size or len(re.findall(r"[^\x20\x09-\x0D]+", w[0])) >= long_words:
                    if w in seen:
                        gone[i : i + n] = [True] * n
                    seen.add(w)
        out.append("\n".join(x for x, g in zip(lines, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8])
def test_lines(spark, tmp_path, size):
    rng = random.Random(size)
    texts = ["\n".join(rng.choices("abc", k=rng.randint(1, 25))) for _ in range(60)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "d"))
    found = line_dedup.dedup_lines(spark.read.parquet(str(tmp_path / "d")), size).orderBy("doc_id").collect()
    assert [r["text"] for r in found] == plain_lines(texts, size)


def line_texts(seed):
    rng = random.Random(seed)
    texts = ["\n".join(rng.choices("abc", k=rng.randint(0, 14))) for _ in range(25)]
    base = [str(rng.random()) for _ in range(40)]
    texts += ["\n".join(base[rng.randint(0, 20) : rng.randint(20, 40)]) for _ in range(6)]
    return texts + ["\n".join(base), "\n".join(["new", *base]), "\n".join([*base[:30], "other"]), None, "", "", "x\nx\nx\nx\nx\nx\nx\nx\nx"]


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_order_is_that_of_a_plain_suffix_array(spark, tmp_path, seed):
    texts = line_texts(seed)
    spark.createDataFrame(list(enumerate(texts)), "row long, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    each = line_dedup._lines(docs, 50)
    names = {(r["row"], r["line"]): (r["a"], r["b"]) for r in each.collect()}
    count = Counter(names.values())
    suffix = {(i, k): tuple(names[i, j] for j in range(k, len(t.split("\n")))) for i, t in enumerate(texts) if t is not None for k in range(len(t.split("\n")))}
    plain = sorted(suffix, key=suffix.get)
    rank = {}
    for at, place in enumerate(plain, 1):
        rank[place] = rank[plain[at - 2]] if at > 1 and suffix[plain[at - 2]] == suffix[place] else at
    places, classes, initial = line_dedup.suffix_order(each.drop("long"))
    assert {(r["row"], r["line"]): r["rank"] for r in places.collect()} == {p: r for p, r in rank.items() if count[names[p]] > 1}

    def shared(x, y):
        return next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))

    before = {rank[p]: shared(suffix[q], suffix[p]) for q, p in zip(plain, plain[1:], strict=False) if rank[q] != rank[p]}
    for r in line_dedup.common_prefixes(classes, initial).collect():
        assert r["lcp"] == before.get(r["rank"], 0)
    longest = {p: max((shared(s, suffix[q]) for q in suffix if q != p), default=0) for p, s in suffix.items()}
    assert {(r["row"], r["line"]): r["length"] for r in line_dedup.longest_repeats(docs).collect()} == {p: n for p, n in longest.items() if n}
    runs = {(i, k): n for (i, k), n in longest.items() if n >= 2 and longest.get((i, k - 1), 0) <= n}
    assert {(r["row"], r["line"]): r["length"] for r in line_dedup.repeated_runs(docs).collect()} == runs and max(runs.values()) >= 30


def test_a_long_line_is_a_run_and_clashing_columns_stay(spark, tmp_path):
    words = " ".join(f"w{i}" for i in range(50))
    rows = [(2, f"a\n{words}\nb", 7, "r", 1.5), (1, f"c\n{words}\nd", 8, "s", 2.5), (3, f"e\n{words[:-4]}\nf", 9, "t", 3.5), (4, f"g\n{words[:-4]}\nh", 9, "u", 4.5)]
    spark.createDataFrame(rows, "doc_id long, text string, row int, line string, starts double").write.parquet(str(tmp_path / "d"))
    found = line_dedup.dedup_lines(spark.read.parquet(str(tmp_path / "d"))).orderBy("doc_id").collect()
    assert [r["text"] for r in found] == [rows[1][1], "a\nb", rows[2][1], rows[3][1]]
    assert [(r["row"], r["line"], r["starts"]) for r in found] == [(8, "s", 2.5), (7, "r", 1.5), (9, "t", 3.5), (9, "u", 4.5)]


def test_passages_of_the_tables(spark, sf_dir):
    words = {r["doc_id"]: re.findall(r"[^\x20\x09-\x0D]+", r["text"].lower()) for r in docs_of(spark, sf_dir).collect()}
    seen = defaultdict(set)
    for i, w in words.items():
        for p in range(len(w) - 50):
            seen[tuple(w[p : p + 51])].add(i)
    found = chaining.op9_chaining(spark, sf_dir).collect()
    assert {i for s in seen.values() if len(s) > 1 for i in s} <= {r["doc_id"] for r in found}
    for r in found:
        a, b = words[r["doc_id"]][r["begin"] : r["end"]], words[r["source_id"]][r["source_begin"] : r["source_end"]]
        assert r["doc_id"] != r["source_id"] and r["identity"] >= 0.8 and min(len(a), len(b)) >= 50
        assert plain_distance(a, b) <= round((1 - r["identity"]) * max(len(a), len(b))) + 1e-6


def plain_distance(a, b):
    if a == b:
        return 0
    row = np.arange(len(b) + 1)
    names = {w: i for i, w in enumerate({*a, *b})}
    y = np.array([names[w] for w in b])
    for i, x in enumerate(a, 1):
        new = np.minimum(row[1:] + 1, row[:-1] + (y != names[x]))
        new = np.concatenate([[i], new])
        row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
    return int(row[-1])


def test_fuzzy_passages_are_found_and_others_left_alone(spark, tmp_path):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    passage = [word() for _ in range(120)]
    changed = [word() if i % 15 == 7 else w for i, w in enumerate(passage)]
    del changed[60]
    texts = [" ".join([word() for _ in range(200)] + p + [word() for _ in range(100)]) for p in (passage, changed, [], [word() for _ in range(80)], passage[:30])]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    found = chaining.passages(spark.read.parquet(str(tmp_path / "d"))).collect()
    assert {r["doc_id"] for r in found} == {0, 1}
    for i in (0, 1):
        own = [r for r in found if r["doc_id"] == i]
        assert min(r["begin"] for r in own) <= 210 and max(r["end"] for r in own) >= 310


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=30), st.lists(st.integers(0, 3), max_size=30))
def test_edit_distance(a, b):
    assert chaining.edit_distance(np.array(a), np.array(b)) == plain_distance(a, b)


@settings(max_examples=100, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 60), st.integers(0, 60)), max_size=12))
def test_best_chain(matches):
    matches = sorted(matches)
    best = {}
    for i, (x, y) in enumerate(matches):
        best[i] = 6 + max([0.0, *(best[j] - chaining.GAP_COST * (x - a + y - b) for j, (a, b) in enumerate(matches[:i]) if a < x and b < y)])
    found = chaining.chains([(x, x, y, y, 6) for x, y in matches]) if matches else []
    assert sorted(i for c in found for i in c) == list(range(len(matches)))
    if matches:
        chain = [matches[i] for i in found[0]]
        score = 6 * len(chain) - chaining.GAP_COST * sum(c - a + d - b for (a, b), (c, d) in zip(chain, chain[1:], strict=False))
        assert abs(score - max(best.values())) < 1e-9


@pytest.mark.parametrize("weights", [None, {"src0": 5.0, "src1": 1.0}])
def test_mixture_keeps_every_window(spark, sf_dir, weights):
    rows = docs_of(spark, sf_dir).select("doc_id", "source")
    found = mixing.mix(rows, weights, block_rows=4).toPandas()
    assert sorted(found.doc_id) == sorted(r["doc_id"] for r in rows.collect())
    assert (found.mix_slot >= found.mix_release).all() and (found.mix_slot < found.mix_deadline).all()
    blocks = found.drop_duplicates("mix_slot").sort_values("mix_slot")
    assert blocks.mix_slot.tolist() == list(range(len(blocks)))
    assert (found.groupby("mix_slot")[["source", "mix_block"]].nunique() == 1).all().all()
    names = sorted(found.source.unique())
    sizes = [len(found[found.source == n]) for n in names]
    least = 1.0
    target = [s**0.5 if weights is None else weights.get(n, least) for n, s in zip(names, sizes, strict=True)]
    plan = mixing.phases_of([-(-s // 4) for s in sizes], mixing.quanta_of(target))
    order = [names.index(s) for s in blocks.source]
    for p in plan:
        share = {m["source"]: m["share"] / p["size"] for m in p["members"]}
        n = sum(m["end"] - m["first"] for m in p["members"])
        done = Counter()
        for t, s in enumerate(order[p["slot"] : p["slot"] + n], 1):
            done[s] += 1
            assert all(abs(done[k] - w * t) < 1 for k, w in share.items())


@given(st.lists(st.floats(0.001, 1000), min_size=1, max_size=90))
def test_quanta(weights):
    found = mixing.quanta_of(weights)
    assert sum(found) == max(mixing.QUANTA, 4 * len(weights)) and min(found) >= 1
