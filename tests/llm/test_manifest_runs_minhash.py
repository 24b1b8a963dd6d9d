"""Periodic runs, MinHash near-duplicates and Merkle manifests: whole results, odd rows and hot groups."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlens.llm import merkle, minhash, periodic_runs
from claimlens.llm.oracles import SQL
from claimlens.llm.queries import llm_queries
from compare import compare, duck_connect
from test_queries import LOWER, empty, run, texts, tiny, words_of  # noqa: F401  (fixtures)

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal_to_sql(spark, name):
    got = llm_queries()[name](spark, SMALL).toPandas()
    ok, why = compare(got, duck_connect(SMALL).execute(SQL[name]).df())
    assert ok, why


# --- Periodic runs -----------------------------------------------------------------------------------------------------

def brute_runs(w, least_words=6, least_periods=4):
    n, found = len(w), {}
    for q in range(1, n // least_periods + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            j = i
            while j + 1 < n and w[j + 1] == w[j + 1 - q]:
                j += 1
            if j - i + 1 + q >= max(least_words, least_periods * q):
                found.setdefault((i - q, j - i + 1 + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def made_up(r, symbols):
    w = []
    while len(w) < r.randint(0, 70):
        unit = [str(r.randint(0, symbols)).encode() for _ in range(r.randint(1, 8))]
        w += (unit * r.choice([1, 1, 2, 4, 5, 9]))[:r.randint(1, 50)]
    return w


@pytest.mark.parametrize("symbols", [1, 3, 40])
def test_runs_equal_brute_force(symbols):
    r = random.Random(symbols)
    for _ in range(400):
        several = [made_up(r, symbols) for _ in range(r.randint(1, 4))]
        assert periodic_runs.find_runs(several) == [brute_runs(w) for w in several]
        for w in several:                                         # without the look for stretches, and all squares
            number = {x: k for k, x in enumerate(dict.fromkeys(w))}
            squares = periodic_runs.runs_of([number[x] for x in w])
            assert sorted(squares, key=lambda x: (x[0], x[2])) == brute_runs(w, 2, 2)


def test_runs_of_a_long_text():
    r = random.Random(4)
    unit = [b"%d" % r.randint(0, 900) for _ in range(700)]
    text = [b"start", *unit * 43, b"end"]
    assert periodic_runs.find_runs([text, [], [b"a"] * 60_000]) == [[(1, 700 * 43, 700)], [], [(0, 60_000, 1)]]


def test_runs_query(spark, tiny, texts):  # noqa: F811
    for r in run(spark, tiny, "op11_periodic_runs"):
        w, h = words_of(texts[r["doc_id"]]), zlib.crc32(str(r["doc_id"]).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(w)
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None,) * 3)
        gone = {i for s, size, q in runs for i in range(s + q, s + size)}
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (None if best[0] is None else 1000 * best[1] // best[2])
        assert r["runs_sha256"] == sha("".join(f"{s},{size},{q}\n" for s, size, q in runs))
        assert r["collapsed_sha256"] == sha(" ".join(x for i, x in enumerate(w) if i not in gone))


def test_runs_operator_with_odd_rows(spark):
    rows = [(None, "a b " * 5, 1), (3, None, 2), (3, "", 3), (3, "x y z", 4), (3, "x y z", 4)]
    docs = spark.createDataFrame(rows, "id long, text string, runs int")
    got = sorted(((r.id is None, r["_runs"], r.collapsed, r.runs, r.n_words) for r in periodic_runs.periodic_runs(docs, "id", "text").collect()),
                 key=lambda x: x[3])
    assert got == [(True, [(0, 10, 2)], "a b", 1, 10), (False, [], "", 2, 0), (False, [], "", 3, 0)] + [(False, [], "x y z", 4, 3)] * 2


# --- MinHash -----------------------------------------------------------------------------------------------------------

def sets_of(rows, size):
    found = {}
    for k, text in rows:
        w = words_of((text or "").translate(LOWER))
        found[k] = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    return found


def brute_classes(sets, percent):
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {k: find(k) for k in sets}


def near_copies(r, groups, copies, changes, words=90):
    """Groups of texts that each differ from the one before in a few words, a common passage in all of them."""
    passage, rows = [f"p{k}" for k in range(60)], []
    for g in range(groups):
        w = passage + [f"g{g}w{r.randrange(10**6)}" for _ in range(words)]
        for _ in range(copies):
            rows.append((len(rows), " ".join(w)))
            for _ in range(r.randint(0, changes)):
                w[60 + r.randrange(words)] = f"n{r.randrange(10**6)}"
    return rows


def test_minhash_query(spark, tiny, texts):  # noqa: F811
    sets = sets_of(texts.items(), 3)
    root = brute_classes(sets, 85)
    got = run(spark, tiny, "op12_minhash")
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == \
        sorted((d, len(sets[d]), root[d], root[d] == d) for d in sets)


@pytest.mark.parametrize("k", [64, 16])
def test_minhash_chains(spark, k):
    """Chains of links, a passage that all share, and texts about as long as a sketch."""
    rows = near_copies(random.Random(k), 12, 14, 4) + [(1000 + n, " ".join(f"w{j}" for j in range(n))) for n in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sets = sets_of(rows, 3)
    root = brute_classes(sets, 85)
    got = minhash.near_duplicates(docs, "doc_id", "text", 3, 85, k).collect()
    assert {r.doc_id: r.component_id for r in got} == root


def test_minhash_defaults_and_odd_rows(spark):
    base = " ".join(f"w{k}" for k in range(100))
    rows = [(None, base), (None, base + " x"), (7, base), (7, base), (3, base.upper()), (9, None), (9, ""), (9, " \n"), (1, "one two"),
            (2, "ONE\ttwo"), (4, "two one"), (None, "alone")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "id long, t string"), "id", "t").collect()
    assert Counter(tuple(r) for r in got) == Counter([
        (None, 96, 3, False), (None, 97, 3, False), (7, 96, 3, False), (7, 96, 3, False), (3, 96, 3, True), *[(9, 0, 9, True)] * 3,
        (1, 1, 1, True), (2, 1, 1, False), (4, 1, 4, True), (None, 1, None, False)])


def test_minhash_pairs_stay_few(spark):
    """A group of 400 copies of one text with few to many changed words: the links are whole, the pairs that are met few."""
    r = random.Random(2)
    text = [f"w{k}" for k in range(150)]
    rows = [(0, " ".join(text))]
    for k in range(1, 400):
        own = list(text)
        for place in r.sample(range(150), r.choice([1, 2, 3, 4, 6, 8])):
            own[place] = f"n{k}x{place}"
        rows.append((k, " ".join(own)))
    rows += [(5000 + k, " ".join([f"w{j}" for j in range(60)] + [f"u{k}x{j}" for j in range(90)])) for k in range(400)]
    search = minhash.NearDuplicates(spark.createDataFrame(rows, "id long, t string").repartition(4), "id", "t", 3, 85)
    lists = search.lists()
    roots = minhash.components(spark, search.verified(search.first_pairs(lists)))
    nodes = search.mixed_nodes(lists, roots)
    entries = search.entries(nodes)
    assert search.first_pairs(entries).count() <= 2 * nodes.count()
    assert search.pairs_across(search._named(entries, roots)).count() < 2000
    want = brute_classes(sets_of(rows, 3), 85)
    got = minhash.near_duplicates(search.docs, "id", "text", 3, 85).collect()
    assert {r.id: r.component_id for r in got} == want and len(set(want.values())) > 420


def test_union_sketch_estimates():
    r = np.random.default_rng(3)
    for _ in range(50):
        x, y = (np.unique(r.integers(0, 200, r.integers(1, 90)).astype(np.uint64)) for _ in range(2))
        shared, size = minhash.estimates([x[:32].view(np.int64)], [y[:32].view(np.int64)], 32)
        union = sorted(set(x.tolist()) | set(y.tolist()))[:32]
        assert (shared[0], size[0]) == (sum(v in x and v in y for v in union), len(union))
    assert minhash.least_shared(64, 85) == 34 and minhash.least_shared(4, 85) == 0


# --- Merkle ------------------------------------------------------------------------------------------------------------

def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(*values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    levels = []
    while len(nodes) > 1:
        levels.append(nodes)
        nodes = [h("".join(nodes[i:i + 3])) for i in range(0, len(nodes), 3)]
    return nodes[0], levels


def path_of(levels, place):
    path = []
    for nodes in levels:
        first = place // 3 * 3
        path.append((place - first, nodes[first:place] + nodes[place + 1:first + 3]))
        place //= 3
    return path


def brute_manifest(rows, tampered):
    """rows: (id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0] is not None, row[0] or 0, leaf_of(*row), row))
    names, trees, out = sorted(groups, key=lambda s: (s is not None, (s or "").encode())), {}, []
    for s in names:
        groups[s].sort(key=lambda x: x[:3])
        trees[s] = levels_of([x[2] for x in groups[s]])
    root, upper = levels_of([trees[s][0] for s in names])
    for k, s in enumerate(names):
        for place, (_, _, leaf, row) in enumerate(groups[s]):
            path = path_of(trees[s][1], place) + path_of(upper, k)
            node = leaf_of(*row[:4], row[4] and row[4].replace("\n", "")) if tampered(row[0]) else leaf
            for at, run_ in path:
                node = h("".join([*run_[:at], node, *run_[at:]]))
            out.append((row[0], leaf, trees[s][0], root, h("".join(x for _, r in path for x in r)), node, node == root))
    return Counter(out)


def even(i):
    return i is not None and zlib.crc32(str(i).encode()) % 2 == 0


def manifest_of(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    fields = ("doc_id", "source", "lang", "n_chars")
    other = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, merkle.leaf_digest(*fields, F.replace("text", F.lit("\n"), F.lit(""))))
    return Counter(tuple(r) for r in merkle.manifest(docs, "doc_id", "source", merkle.leaf_digest(*fields, "text"), other).collect())


def test_manifest_query(spark, tiny):  # noqa: F811
    rows = [tuple(r) for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = Counter((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"])
                  for r in run(spark, tiny, "op13_merkle_manifest"))
    assert got == brute_manifest(rows, even)


def test_manifest_of_odd_rows(spark):
    """Null and negative ids, ids far apart, repeated rows, ids with several leaves, null and odd sources, one-row groups."""
    r = random.Random(6)
    ids = [None, None, 0, -1, -(1 << 63), (1 << 63) - 1, 1 << 40, 1023, 1024, 7, 7, 7, 7]
    rows = [(i, s, "en", 5, f"line\none {r.randint(0, 2)}é") for i in ids for s in (None, "", "é", "z", "\U0001F600")]
    rows += [(5, "hot", None, None, None)] * 40 + [(5, "hot", "nl", k, "a\nb") for k in range(30)] + [(9, "single", "x", 1, "t")]
    assert manifest_of(spark, rows) == brute_manifest(rows, even)


@pytest.mark.parametrize("n", [1, 3, 4, 728, 730, 2188])
def test_manifest_of_one_group(spark, n):
    """Group sizes around a slot array's places: one round or two."""
    rows = [(k * 37 % 5000 if n > 4 else k, "s", None, k, f"t{k}\n") for k in range(n)]
    assert manifest_of(spark, rows) == brute_manifest(rows, even)


def test_manifest_of_many_groups_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(merkle, "REPEATS", 64)
    rows = [(k, f"s{k}", None, None, "x") for k in range(1500)] + [(3, "s3", None, None, "x")] * 800
    assert manifest_of(spark, rows) == brute_manifest(rows, even)


def test_rank_directory():
    r = np.random.default_rng(1)
    for n in (0, 1, 40, 1000):
        places = np.sort(r.choice(1024, n, replace=False))
        words = merkle.unpack_bits(merkle.pack_bits(places))
        extra = places[::3]
        ranks = merkle.Ranks(words, extra, np.full(len(extra), 2))
        asked = np.arange(1024)
        want = np.searchsorted(places, asked) + 2 * np.searchsorted(extra, asked)
        assert ranks.rank(asked).tolist() == want.tolist()
    assert re.fullmatch("p", merkle.pack_bits(np.array([5]))[:1].decode())
