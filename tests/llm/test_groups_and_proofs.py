"""Near-duplicate groups, the dataset manifest and whitened embeddings, and
what tells rows of one doc_id apart."""

import hashlib
import os
import random
import subprocess
import sys
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest

from rankwalk.llm import manifest, near_dedup, oracle, substring_dedup, whitening
from rankwalk.llm.countmin import Shape

SMALL = dict(retained=Shape(depth=2, log2=16), involved=Shape(depth=2, log2=14))


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


def same_as_sql(out, con, sql):
    found = con.execute(sql)
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(out.columns)
    assert canon(out.columns, out.collect()) == canon(columns, found.fetchall())


@pytest.mark.parametrize("name", ["near_duplicates", "merkle_manifest"])
def test_edge_cases_match_sql(docs, con, name):
    operator = {"near_duplicates": lambda d: near_dedup.near_duplicates(d, **SMALL), "merkle_manifest": manifest.merkle_manifest}[name]
    same_as_sql(operator(docs), con, getattr(oracle, name)())
    assert operator(docs.limit(0)).count() == 0


def test_no_link_is_lost(spark):
    """Documents mixed from shared passages, copies of many similarities around
    the limit, and sets on either side of both sketch sizes."""
    rng = random.Random(3)
    passages = [[f"p{i}w{j}" for j in range(40)] for i in range(8)]
    texts = [" ".join(w for p in rng.sample(passages, 4) for w in p) for _ in range(40)]
    for size in (20, 110, 130, 150, 420, 520, 700):
        base = [f"c{size}w{j}" for j in range(size)]
        for edits in [0, 1, 1, 2, 2, 3, 4, 6, 8, 10, 12]:
            copy = list(base)
            for at in rng.sample(range(size), min(edits * size // 130 + (edits > 0), size)):
                copy[at] = f"e{rng.randrange(10**9)}"
            texts.append(" ".join(copy))
        texts += [" ".join(base[: size * k // 20]) for k in (16, 17, 18, 19)]
    rows = list(enumerate(texts))
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    same_as_sql(near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), **SMALL), con, oracle.near_duplicates())


def family(rng, size, tag, copies, share):
    """Copies of a text that each keep ``share`` of its words."""
    base = [f"{tag}{j}" for j in range(size)]
    texts = []
    for _ in range(copies):
        copy = list(base)
        for at in rng.sample(range(size), round(size * (1 - share))):
            copy[at] = f"e{rng.randrange(10**9)}"
        texts.append(" ".join(copy))
    return texts


def test_alike_documents_that_do_not_link_are_not_paired(spark, monkeypatch):
    """Groups whose members are 0.6 to 0.8 alike: the pairs to estimate stay few, not the square of a group."""
    rng = random.Random(5)
    texts = [x for size, share in ((300, 0.965), (700, 0.955), (1400, 0.955)) for x in family(rng, size, f"g{size}x", 40, share)]
    counts, estimated = [], near_dedup.estimated
    monkeypatch.setattr(near_dedup, "estimated", lambda pairs, sets: counts.append(pairs.count()) or estimated(pairs, sets))
    rows = list(enumerate(texts))
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    same_as_sql(near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), **SMALL), con, oracle.near_duplicates())
    assert max(counts) <= 2 * len(texts), counts


@pytest.mark.parametrize("most", [0, 4])
def test_links_without_and_with_many_rounds(spark, monkeypatch, most):
    """Groups around the limit: the last round alone finds every component, and so it does after many others."""
    monkeypatch.setattr(near_dedup, "ROUNDS", 0)
    monkeypatch.setattr(near_dedup, "MOST_ROUNDS", most)
    monkeypatch.setattr(near_dedup, "CROSSING", 0)
    monkeypatch.setattr(near_dedup, "VAIN", 0)
    rng = random.Random(7)
    texts = [x for size in (200, 560, 900) for share in (0.995, 0.991, 0.987) for x in family(rng, size, f"g{size}x", 6, share)]
    rows = list(enumerate(texts))
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), **SMALL)
    assert 3 < found.select("component_id").distinct().count() < len(texts)
    same_as_sql(found, con, oracle.near_duplicates())


def test_parity_bits_never_exceed_the_difference():
    rng = np.random.default_rng(2)
    for size in (1, 5, 100, 3000):
        x = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        y = np.unique(np.concatenate([x[: size // 2], rng.integers(0, 2**63, size).astype(np.uint64)]))
        bits = lambda s: near_dedup.parity_bits(s).view(np.uint8)
        assert np.unpackbits(bits(x) ^ bits(y)).sum() <= len(np.setxor1d(x, y))
        assert np.array_equal(bits(x), bits(x[::-1]))


def test_estimates_fall_short_rarely():
    for k in (near_dedup.K, near_dedup.WIDE):
        least = near_dedup.least_shared(k, 1e-12)
        assert 0.5 * k < least < 0.85 * k
        shared = np.random.default_rng(1).binomial(k, 0.85, 200_000)
        assert shared.min() >= least


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_manifest(rows):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, more=0):
        n = r["n_chars"]
        return sha("".join(map(field, (r["doc_id"], r["source"], r["lang"], None if n is None else n + more, r["text"]))))

    def tree(hashes):
        at, paths = list(range(len(hashes))), [[] for _ in hashes]
        while len(hashes) > 1:
            for k, a in enumerate(at):
                paths[k].append((hashes[a ^ 1], a % 2 == 1) if a ^ 1 < len(hashes) else None)
            at = [a // 2 for a in at]
            hashes = [sha("".join(hashes[i:i + 2])) for i in range(0, len(hashes), 2)]
        return hashes[0], paths

    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    members = [sorted((r for r in rows if r["lang"] == x), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, leaf(r))) for x in langs]
    trees = [tree([leaf(r) for r in m]) for m in members]
    root, upper = tree([t for t, _ in trees])
    for m, (top, paths), above in zip(members, trees, upper):
        for r, path in zip(m, paths):
            chosen = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            h, proof = leaf(r, int(chosen)), ""
            for step in path + above:
                proof += step[0] if step else ""
                h = sha(h if not step else step[0] + h if step[1] else h + step[0])
            yield (r["doc_id"], leaf(r), top, root, sha(proof), h, h == root)


@pytest.mark.parametrize("stride, block", [(8, 9), (2, 1)])
def test_manifest_matches_brute_force(spark, monkeypatch, stride, block):
    """With two levels a stride the same rows climb many strides, also above the subroots."""
    monkeypatch.setattr(manifest, "STRIDE", stride)
    monkeypatch.setattr(manifest, "BLOCK", block)
    langs = [None, "", "-", "=", "de", "en", "é", "日"] + [f"l{i}" for i in range(9)]
    sizes = [1, 2, 3, 4, 5, 16, 17, 33] + [1] * 9
    rows = [(None if i % 11 == 5 else i, None if i % 13 == 0 else "x" * i, x, "s" if i % 3 else None, None if i % 5 == 0 else i)
            for x, (n, start) in zip(langs, zip(sizes, np.cumsum([0] + sizes).tolist())) for i in range(start, start + n)]
    rows += [(70, "same", "en", "s", 4)] * 2 + [(70, "other", "en", "s", 4), (7, "w " * 200_000, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS idx", "2 AS tree")
    out = manifest.merkle_manifest(docs)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, brute_manifest([r.asDict() for r in docs.collect()])))
    one = docs.where("doc_id = 1")
    assert [tuple(r) for r in manifest.merkle_manifest(one).collect()] == list(brute_manifest([r.asDict() for r in one.collect()]))


def test_whitening_matches_numpy(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(60, 5)) * [1, 2, 3, 4, 5] + 7).astype(np.float32)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    rows += [(100, rows[3][1]), (100, rows[3][1]), (None, rows[4][1]), (101, [-0.0] * 5)]
    odd = [(102, None), (103, [1.0, None, 1.0, 1.0, 1.0]), (104, [nan] + [1.0] * 4), (105, [inf] + [1.0] * 4), (106, [1.0, 2.0]), (107, [])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").selectExpr("*", "1 AS component", "'x' AS n")
    got = whitening.whitened(df).toPandas()
    assert len(got) == 4 * len(rows) and set(got["component"]) == {1, 2, 3, 4}
    x = np.floor(np.array([v for _, v in rows], dtype=np.float64) * 256)
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    values, axes = np.linalg.eigh(np.cov(fit.T, bias=True))
    values, axes = values[::-1][:4], axes[:, ::-1][:, :4]
    want = (x - fit.mean(axis=0)) @ axes / np.sqrt(values)
    assert (got["n"] == n).all() and (got["identity_error"] < 1e-12).all()
    for k in range(4):
        part = got[got["component"] == k + 1].sort_values(["vec_id", "deviation"], na_position="last")
        own = want[:, k][np.lexsort((((n * x - total) ** 2).sum(axis=1), [1000 if i is None else i for i, _ in rows]))]
        assert min(np.abs(part["whitened"] - own).max(), np.abs(part["whitened"] + own).max()) < 1e-9
        assert np.allclose(part["explained"], values[k] / np.trace(np.cov(fit.T, bias=True)), rtol=1e-12)
    assert sorted(got[got["component"] == 1]["deviation"]) == sorted(int(d) for d in ((n * x - total) ** 2).sum(axis=1))


def test_whitening_of_odd_tables(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert whitening.whitened(make([])).count() == 0
    assert whitening.whitened(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0         # no variance
    assert whitening.whitened(make([(1, []), (2, None)])).count() == 0
    line = whitening.whitened(make([(1, [0.0, 0.0]), (2, [1.0, 1.0])])).collect()            # one component has any
    assert {(r["vec_id"], r["component"], r["n"], r["deviation"]) for r in line} == {(1, 1, 2, 2 * 256**2), (2, 1, 2, 2 * 256**2)}
    assert sorted(abs(r["whitened"]) for r in line) == pytest.approx([1.0, 1.0])
    # Entries far apart: the other component has less than 1e-12 of the variance.
    large = whitening.whitened(make([(1, [1e300, 1.0]), (2, [-1e300, 1.0]), (3, [0.0, 1.5])])).collect()
    assert len(large) == 3 and {r["deviation"] for r in large if r["vec_id"] == 1} == {None}


def test_exact_sums_beyond_64_bits(spark):
    x = np.array([[2**44, -2**44], [2**44 - 1, 3], [5, -2**43]], dtype=object)
    fit = spark.createDataFrame([(list(map(int, v)),) for v in x], "x array<long>")
    n, totals = whitening.sums(fit, 2)
    assert (n, totals) == (3, [int(s) for s in x.sum(axis=0)])
    centred = 3 * x - x.sum(axis=0)
    want = {(0, 0): (centred[:, 0] ** 2).sum(), (1, 1): (centred[:, 1] ** 2).sum(), (0, 1): ((centred[:, 0] + centred[:, 1]) ** 2).sum()}
    assert whitening.squares(fit, n, totals) == want


def test_texts_of_one_doc_id_keep_apart(spark):
    """Many texts under one id: only windows that a smaller id has are cut."""
    words = lambda a, n: " ".join(f"{a}{i}" for i in range(n))
    rows = [(1, words("r", 60))] + [(2, f"{words(f'u{k}x', 20)} {words('r', 40) if k % 50 == 0 else ''}") for k in range(400)] + [(2, words("s", 13 + k % 3)) for k in range(30)]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    out = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    same_as_sql(out, con, oracle.substring_dedup())


def test_tasks_do_not_import_the_package(tmp_path):
    """Workers find neither the repository nor the driver's path."""
    script = tmp_path / "run.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {sys.path[0]!r}); sys.path.insert(0, {str(__file__).split('/tests/')[0]!r})
from rankwalk.session import local_session
s = local_session(2, 4)
from rankwalk.llm import queries
for q in ("op3_quality_classifier", "op11_minhash_near_dedup", "op13_embedding_whitening"):
    assert queries.QUERIES[q](s, "/root/testdata/sf0.001").count() > 0, q
print("all ran")
""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable}
    ran = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert "all ran" in ran.stdout, ran.stderr[-2000:]
