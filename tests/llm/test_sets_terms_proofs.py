"""N-gram join, source divergence and Merkle manifest against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dustline.llm import merkle, ngram_join, term_audit

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, value long, node long"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    w = min(5, len(words))
    return {tuple(words[i:i + w]) for i in range(len(words) - w + 1)} if words else set()


def made_rows(seed=3):
    """Texts with exact copies, near copies in chains and in a large group, a shared passage, and the edge cases."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["größe", "Ärger", "ÉCOLE"]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage = prose(60)
    texts = [prose(rng.choice([3, 5, 12, 60, 150, 700])) for _ in range(120)]
    texts += [prose(30) + passage + prose(5) for _ in range(40)]
    base = prose(200)
    for _ in range(60):  # a large group of near copies
        copy = list(base)
        copy[rng.randrange(200)] = "x" + str(rng.randrange(1000))
        texts.append(copy)
    chain = prose(120)
    for i in range(12):  # neighbours are alike, the ends are not
        chain = chain[3:] + prose(3)
        texts.append(chain)
    texts += [list(t) for t in texts[:30]]
    rows = [(i, rng.choice([" ", "\t", "  "]).join(t) if i % 3 else " ".join(t).upper(), ["en", "de", None, "fr"][i % 4 if i % 2 else 0], f"s{i % 5 if i % 3 else 0}", i, 1, 2)
            for i, t in enumerate(texts)]
    rows += [(1000, None, "en", "s0", None, 1, 2), (1001, "", None, None, 0, 1, 2), (1002, " \t\n", "en", "only", 3, 1, 2), (1003, "one two", "en", "s1", 7, 1, 2),
             (1004, "ONE  two", "en", None, 7, 1, 2), (1005, "word " * 20000, "en", "s1", 100000, 1, 2), (1006, rows[0][1], "en", "s1", 1, 1, 2), (1006, rows[0][1], "en", "s1", 1, 1, 2),
             (None, rows[1][1], "en", "s1", 1, 1, 2), (1007, "é" * 30 + " " + "y" * 5000, "zz", "lone", 1, 1, 2), (1003, "another text with the same id", "en", "s1", 7, 1, 2)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return made_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


# ---- n-gram join -------------------------------------------------------------
def expected_components(rows, least=80):
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    meet = defaultdict(Counter)
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            for j in where[x]:
                meet[i][j] += 1
            where[x].append(i)
    for i, others in meet.items():
        for j, common in others.items():
            if 100 * common >= least * (len(sets[i]) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[root(i)].append(r[0])
    return sorted(((r[0], len(sets[i]), min(ids[root(i)]) if ids[root(i)] else None) for i, r in enumerate(rows)), key=str)


def joined_rows(df):
    assert df.dtypes == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint")]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_join_equals_brute_force(docs, rows):
    assert joined_rows(ngram_join.joined(docs)) == expected_components(rows)


def test_join_in_blocks_of_lists_equals_brute_force(docs, rows, monkeypatch):
    monkeypatch.setattr(ngram_join, "LIST", 3)
    monkeypatch.setattr(ngram_join, "LOADS", 1 << 12)  # one cell for many shingles: long lists
    monkeypatch.setattr(ngram_join, "SALT_ROWS", 4)
    assert joined_rows(ngram_join.joined(docs)) == expected_components(rows)


def test_join_of_an_empty_table(docs):
    assert ngram_join.joined(docs.limit(0)).collect() == []


def test_points_bound_the_overlap():
    rng = np.random.default_rng(5)
    for n, m, common in ((10, 12, 9), (300, 340, 280), (1000, 1200, 40), (40000, 45000, 39000), (255, 257, 250)):
        pool = rng.integers(-2 ** 63, 2 ** 63, n + m, dtype=np.int64)
        a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[:common], pool[n:n + m - common]]))
        points = [ngram_join.point_from(ngram_join.point_of(s).tobytes(), len(s)) for s in (a, b)]
        assert points[0].sum() == len(a) and len(points[0]) == ngram_join.coordinates(len(a))
        assert ngram_join.bound(*points) >= len(np.intersect1d(a, b))


@pytest.mark.parametrize("sizes", [(1, 1), (7, 40), (200, 200), (65, 1)])
def test_tree_gives_every_pair_that_may_link(sizes):
    rng = np.random.default_rng(sum(sizes))
    centres = rng.poisson(4, (6, 16))

    def made(n):
        points = np.maximum(0, centres[rng.integers(0, 6, n)] + rng.integers(-1, 2, (n, 16))).astype(np.int32)
        return points, points.sum(axis=1).astype(np.int64), rng.integers(0, 3, n)

    def may(p, q, i, j):
        return (np.minimum(p[0][i], q[0][j]).sum() >= ngram_join.needed(p[1][i] + q[1][j]) and p[2][i] != q[2][j]
                and 100 * min(p[1][i], q[1][j]) >= 80 * max(p[1][i], q[1][j]))

    p, q = made(sizes[0]), made(sizes[1])
    a, b = ngram_join.Tree(*p), ngram_join.Tree(*q)
    got = sorted((int(i), int(j)) for x, y in ngram_join.tree_pairs(a, b) for i, j in zip(x, y))
    assert got == [(i, j) for i in range(sizes[0]) for j in range(sizes[1]) if may(p, q, i, j)]
    got = sorted(tuple(sorted((int(i), int(j)))) for x, y in ngram_join.tree_pairs(a, a) for i, j in zip(x, y))
    assert got == [(i, j) for i in range(sizes[0]) for j in range(i + 1, sizes[0]) if may(p, p, i, j)]


def test_tree_prunes_unlike_points():
    rng = np.random.default_rng(1)
    points = rng.poisson(4, (2048, 64)).astype(np.int32)
    tree = ngram_join.Tree(points, points.sum(axis=1).astype(np.int64), np.arange(2048))
    assert sum(len(i) for i, _ in ngram_join.tree_pairs(tree, tree)) == 0
    one = ngram_join.Tree(np.repeat(points[:1], 2048, axis=0), np.full(2048, points[0].sum()), np.zeros(2048, dtype=np.int64))
    assert not list(ngram_join.tree_pairs(one, one))  # one component: nothing is compared below the root


# ---- source divergence -------------------------------------------------------
def expected_audit(rows, least):
    terms = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    df, groups, out = defaultdict(Counter), defaultdict(Counter), []
    for _, text, lang, source, *_ in rows:
        found = terms(text)
        groups[lang or "", source or ""].update(found)
        df[lang or ""].update(set(found))
    p = lambda c, n, v: 1 + 10 ** 9 * (c + 5) // (n + 5 * v)
    for lang in {g for g, _ in groups}:
        kept = [t for t, d in df[lang].items() if d >= least]
        v = len(kept)
        own = {s: c for (g, s), c in groups.items() if g == lang}
        whole = Counter()
        for c in own.values():
            whole.update(c)
        lang_n = sum(whole[t] for t in kept)
        n = {s: sum(c[t] for t in kept) for s, c in own.items()}
        for s, c in own.items():
            pairs = [(-sum(abs(p(c[t], n[s], v) - p(d[t], n[o], v)) for t in kept), o.encode()) for o, d in own.items() if o != s]
            single = [(p(whole[t], lang_n, v) - p(c[t], n[s], v), t.encode()) for t in kept if c[t] > 0 and p(c[t], n[s], v) > p(whole[t], lang_n, v)]
            for part, found, most in (("pair", pairs, None), ("term", single, 50)):
                out += [(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(sorted(found)[:most])]
    return sorted(out)


@pytest.mark.parametrize("least", [1, 6, 10 ** 6])
def test_audit_equals_brute_force(docs, rows, least):
    got = term_audit.audit(docs, least)
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    assert sorted(tuple(r) for r in got.collect()) == expected_audit(rows, least)


def test_audit_in_small_blocks_and_small_memory(docs, rows, monkeypatch):
    for name, value in (("BLOCK_TERMS", 7), ("BLOCK_SOURCES", 2), ("MERGE_RUNS", 50), ("LONG_BYTES", 200)):
        monkeypatch.setattr(term_audit, name, value)
    assert sorted(tuple(r) for r in term_audit.audit(docs, 3).collect()) == expected_audit(rows, 3)


def test_audit_of_an_empty_table(docs):
    assert term_audit.audit(docs.limit(0)).collect() == []


def test_shares_are_exact_beyond_64_bits(spark):
    cases = [(c, n, v) for c in (0, 1, 10 ** 12, 8 * 10 ** 17) for n in (c, 9 * 10 ** 17) for v in (1, 10 ** 9)]
    df = spark.createDataFrame(cases, "c long, n long, v long")
    got = {(r.c, r.n, r.v): r.p for r in df.select("*", term_audit.share(F.col("c"), F.col("n"), F.col("v")).alias("p")).collect()}
    assert got == {(c, n, v): 1 + 10 ** 9 * (c + 5) // (n + 5 * v) for c, n, v in cases}


def test_radix_order_is_a_stable_sort():
    rng = np.random.default_rng(2)
    words = [rng.integers(0, 3, 500).astype(np.uint64) << np.uint64(50), rng.integers(0, 2 ** 63, 500, dtype=np.int64).astype(np.uint64) % np.uint64(70000)]
    assert (ngram_order := term_audit.radix_order(words)).tolist() == np.lexsort((words[1], words[0])).tolist(), ngram_order


# ---- Merkle manifest ---------------------------------------------------------
H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()


def expected_proofs(rows):
    def leaf(r, lower=False):
        values = [r[0], r[3], r[2], r[4], r[1]]
        if lower and values[4] is not None:
            values[4] = re.sub("[A-Z]", lambda m: m[0].lower(), values[4])
        return H(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in values))

    def tree(nodes):
        """(root, for each leaf its (left, right) siblings by level)."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            runs = [nodes[i:i + 16] for i in range(0, len(nodes), 16)]
            for k, path in enumerate(paths):
                run, pos = runs[at[k] // 16], at[k] % 16
                path.append((run[:pos], run[pos + 1:]))
                at[k] //= 16
            nodes = [H(*run) for run in runs]
        return nodes[0], paths

    key = lambda x: (x is not None, x)
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append((key(r[0]), leaf(r), r))
    trees = {s: (sorted(found, key=lambda x: x[:2]),) for s, found in by_source.items()}
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    subroots = {}
    for s in order:
        subroots[s] = tree([x[1] for x in trees[s][0]])
    root, top = tree([subroots[s][0] for s in order])
    out = []
    for i, s in enumerate(order):
        for (_, digest, r), path in zip(trees[s][0], subroots[s][1]):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            acc, siblings = leaf(r, tampered), []
            for left, right in path + top[i]:
                acc = H(*left, acc, *right)
                siblings += left + right
            out.append((r[0], digest, subroots[s][0], root, H(*siblings), acc, acc == root))
    return sorted(out, key=str)


def shown(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def condition():
    from dustline.llm.common import remainder
    return remainder("doc_id", 5) == 0


def test_proofs_equal_brute_force(docs, rows):
    got = merkle.proofs(docs, condition())
    assert got.dtypes == [("doc_id", "bigint"), ("leaf", "string"), ("subroot", "string"), ("root", "string"), ("proof_sha256", "string"),
                          ("folded_root", "string"), ("verified", "boolean")]
    assert shown(got) == expected_proofs(rows)


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17], [257], [1] * 17, [1, 300, 16, 1]])
def test_trees_of_every_shape(spark, sizes):
    rows = [(k * 1000 + i, "Text" if i % 2 else "text", "en", f"s{k}", 4) for k, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert shown(merkle.proofs(df, condition())) == expected_proofs(rows)


def test_manifest_of_an_empty_table(docs):
    assert merkle.proofs(docs.limit(0), condition()).collect() == []
