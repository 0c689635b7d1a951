"""Every operator on the edge cases, against its SQL or a brute force."""

import duckdb
import pandas as pd
import pytest

from rankwalk.llm import (decontamination, jaccard_join, licenses, line_dedup, oracle, packing, quality_classifier,
                          quality_rules, sharding, substring_dedup, url_filter)
from rankwalk.llm.queries import URL_RULES

OPERATORS = {
    "quality_rules": lambda d, i: quality_rules.quality_rules(d),
    "line_dedup": lambda d, i: line_dedup.line_dedup(d).drop("text"),
    "license_scan": lambda d, i: licenses.license_scan(d),
    "substring_dedup": lambda d, i: substring_dedup.substring_dedup(d),
    "jaccard_components": lambda d, i: jaccard_join.jaccard_components(d),
    "balanced_shards": lambda d, i: sharding.balanced_shards(d),
    "benchmark_leaks": lambda d, i: decontamination.benchmark_leaks(d, i),
    "packed": lambda d, i: packing.packed(d),
}


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", list(OPERATORS))
def test_matches_sql_on_edge_cases(spark, docs, items, con, name):
    out = OPERATORS[name](docs, items)
    found = con.execute(getattr(oracle, name)())
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(out.columns)
    assert canon(out.columns, out.collect()) == canon(columns, found.fetchall())


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_tables(spark, docs, items, name):
    assert OPERATORS[name](docs.limit(0), items.limit(0)).count() == 0


def test_stages_keep_columns_and_apply_decisions(spark, docs, items):
    lines = line_dedup.deduplicated(docs)
    assert lines.columns == docs.columns and lines.count() == docs.count()
    assert not [r for r in lines.collect() if "shared line here" in (r["text"] or "").lower().split("\n")]
    kept = jaccard_join.one_of_each(docs)
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect())
    # 1 and 2 are equal, so are 6 and both rows 7; the two null rows and 8 and 11 are compared by their sets.
    assert kept.columns == docs.columns and (False, 2) not in ids and (False, 7) not in ids and (False, 3) in ids and (False, 5) in ids
    clean = decontamination.decontaminated(docs, items)
    assert clean.columns == docs.columns and {1, 2, 8, 11, 6, 7}.isdisjoint({r["doc_id"] for r in clean.collect()})
    cut = substring_dedup.deduplicated(docs)
    assert cut.columns == docs.columns and {r["doc_id"]: r["text"] for r in cut.collect()}[2] == ""
    assert quality_rules.filtered(docs).columns == docs.columns


def test_url_rules(spark):
    urls = [(1, "http://a.www.Example.com/en/x?q"), (2, "https://example.com/en/"), (3, "https://example.com/fr#/en/"), (4, "http://notexample.com/en/"),
            (5, None), (6, "no scheme"), (7, "x://net/es/1"), (7, "x://net/es/1"), (8, "x://a.net"), (None, "http://www.example.com/en/a")]
    pages = spark.createDataFrame(urls, "page_id long, url string").selectExpr("*", "'x' AS host", "'y' AS part")
    got = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.url_filter(pages, URL_RULES).collect()}
    assert got == {(1, "a.www.example.com", "/en/x", "www.example.com/en/", "allow"), (2, "example.com", "/en/", "example.com/en/", "block"),
                   (3, "example.com", "/fr", "com/", "allow"), (4, "notexample.com", "/en/", "com/", "allow"), (5, "", "", None, "allow"),
                   (6, "", "", None, "allow"), (7, "net", "/es/1", "net/es/", "block"), (8, "a.net", "", None, "allow"),
                   (None, "www.example.com", "/en/a", "www.example.com/en/", "allow")}
    assert url_filter.url_filter(pages.limit(0), URL_RULES).count() == 0
    assert {r["verdict"] for r in url_filter.url_filter(pages, []).collect()} == {"allow"}


def test_leaks_count_item_rows_apart(spark):
    """Repeated item rows, one id for two texts, and several null ids."""
    import duckdb
    import pandas as pd
    words = lambda a, b: " ".join(f"{a}{i}" for i in range(b))
    items = [(1, words("r", 14)), (1, words("r", 14)), (2, words("s", 14)), (2, words("t", 24)), (None, words("u", 14)), (None, words("v", 14)), (3, words("s", 14))]
    # Document 1 holds 4 of 10 shingles of item 1; 3 holds 6 and 6 of items 2; 5 holds 5 and 5 of the null items.
    docs = [(1, words("r", 8) + " x"), (2, "y " + words("r", 14)), (3, words("s", 10) + " x " + words("t", 10)), (4, words("s", 14) + " x " + words("t", 24)),
            (5, words("u", 9) + " x " + words("v", 9)), (6, words("v", 13))]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]).astype({"item_id": "Int64"}))
    out = decontamination.benchmark_leaks(d, i)
    found = con.execute(oracle.benchmark_leaks())
    assert canon(out.columns, out.collect()) == canon([c[0] for c in found.description], found.fetchall())
    assert sorted((r["doc_id"], r["item_id"] or 0, r["n_shared"]) for r in out.collect()) == [
        (2, 1, 10), (2, 1, 10), (4, 2, 10), (4, 2, 20), (4, 3, 10), (6, 0, 9)]
    assert sorted(r["doc_id"] for r in decontamination.decontaminated(d, i).collect()) == [1, 3, 5]


def test_licence_spellings(spark):
    texts = ["RELEASED under the MIT licence", "copyright (c) me\n" + dict(licenses.KNOWN)["ISC"], "Licensed under CC-BY-NC-4.0", "Released under the MIT License, kind of"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {(r["doc_id"], r["license_id"]) for r in licenses.license_scan(docs).collect()} >= {(0, "MIT"), (2, "CC-BY-NC-4.0")}
    assert not [r for r in licenses.license_scan(docs).collect() if r["doc_id"] == 3]


BSD3 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""


def test_rewrapped_licences(spark):
    """A licence matches however its paragraphs are wrapped, with statements of any form before it."""
    import textwrap
    starts = ["", "Copyright (c) 2020 Some One\n\n", "© Some One\nAll rights reserved.\n\n", "Copyright 1999-2004 A\n(c) 2005 B\n\n"]
    texts = [(i, starts[w % 4] + "\n".join(textwrap.fill(p, w) for p in t.split("\n"))) for i, t in (
        ("MIT", licenses._MIT), ("ISC", licenses._ISC), ("BSD-3-Clause", licenses._bsd(3, True, True)), ("BSD-2-Clause", licenses._bsd(2, False, False)))
        for w in range(40, 121)]
    texts.append((None, licenses._MIT.replace("copyright notice", "notice")))
    texts.append((None, licenses._MIT + "\nCopyright notices stay."))
    docs = spark.createDataFrame([(n, t) for n, (_, t) in enumerate(texts)], "doc_id long, text string")
    found = {(r["doc_id"], r["license_id"]) for r in licenses.license_scan(docs).where("unit = 'text'").collect()}
    assert found == {(n, i) for n, (i, _) in enumerate(texts) if i}
    con = duckdb.connect()
    con.register("documents", pd.DataFrame([(n, t) for n, (_, t) in enumerate(texts)], columns=["doc_id", "text"]))
    rows = con.execute(f"SELECT doc_id, license_id FROM ({oracle.license_scan()}) WHERE unit = 'text'").fetchall()
    assert set(rows) == found


def test_printed_digests_are_those_held(spark):
    from pathlib import Path
    from rankwalk.llm import license_digests
    folder = Path("/usr/share/common-licenses")
    texts = [(i, (folder / f).read_text()) for f, i in license_digests.FILES.items() if (folder / f).exists()]
    assert set(license_digests.digests(spark, texts)) <= set(licenses.DIGESTS)


def test_entire_licences(spark):
    from pathlib import Path
    from pyspark.sql import functions as F
    numbers, head = BSD3.split("3. "), "BSD 3-Clause License\n\nCopyright (c) 2020, Some One\nAll rights reserved.\n\n"
    bsd2 = numbers[0] + numbers[1][numbers[1].index("THIS SOFTWARE"):]
    texts = [("BSD-3-Clause", head + BSD3), ("BSD-2-Clause", bsd2), ("BSD-3-Clause", "\n\n".join(p.replace("\n", " ") for p in BSD3.split("\n\n")))]
    held = Path("/usr/share/common-licenses")
    files = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    texts += [(i, (held / f).read_text()) for f, i in files.items() if (held / f).exists()]
    texts += [(None, BSD3.replace("THIS SOFTWARE", "THIS PROGRAM")), (None, "Copyright 2020 Someone")]
    docs = spark.createDataFrame([(n, t) for n, (_, t) in enumerate(texts)], "doc_id long, text string")
    found = licenses.license_scan(docs)
    assert {(r["doc_id"], r["license_id"]) for r in found.where("unit = 'text'").collect()} == {(n, i) for n, (i, _) in enumerate(texts) if i}
    rows = licenses.known_digests(spark, licenses.KNOWN)
    assert rows.count() == rows.select("digest").distinct().count() and rows.where(F.col("digest") == F.md5(F.lit("").cast("binary"))).count() == 0


def test_classifier_holds_out_and_separates(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    rows = quality_classifier.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)
    none = quality_classifier.quality_scores(docs.limit(3), labels.limit(0)).collect()
    assert [r["score"] for r in none] == [0.5] * 3
    odd = spark.createDataFrame([(None, None), (1, ""), (1, "")], "doc_id long, text string")
    assert all(0 <= r["score"] <= 1 for r in quality_classifier.quality_scores(odd, labels).collect())


def test_classifier_lets_all_equal_neighbours_vote():
    """Zero vectors score 0.5; the order of equal copies among the voters does not matter."""
    import numpy as np
    rng = np.random.default_rng(1)
    hot = rng.random(quality_classifier.BINS).astype(np.float32)
    raw = np.concatenate([np.tile(hot, (90, 1)), rng.random((110, quality_classifier.BINS)).astype(np.float32)])
    labels = np.array([1] * 30 + [0] * 60 + [0, 1] * 55)
    asked = np.stack([np.zeros_like(hot), hot])
    settings, found = quality_classifier.Settings(), []
    for order in (np.arange(200), np.arange(200)[::-1], rng.permutation(200)):
        found.append(quality_classifier.train(raw[order], labels[order], settings.dims).scores(asked, settings))
    one, none = 30 / (labels == 1).sum(), 60 / (labels == 0).sum()
    assert [f[0] for f in found] == [0.5] * 3
    assert np.allclose([f[1] for f in found], one / (one + none), atol=1e-3)


def test_items_are_counted_for_candidates_alone(spark):
    """Only a shared sketch hash makes a candidate, and only 4/5 of the item's
    shingles make a find."""
    item, other = [f"w{i}" for i in range(24)], [f"v{i}" for i in range(30)]
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    shingles = decontamination.item_shingles(items).cache()
    rows = {r["hash"]: r["sketch"] for r in shingles.collect()}
    assert len(rows) == 20 and sum(rows.values()) == 20 - 16 + 1
    small = sorted(rows, key=lambda h: h % 2**64)
    assert {h for h, marked in rows.items() if marked} == set(small[:5])
    # a: all shingles; b: 15 of 20, the small ones too; c: all but the sketch; d: one sketch hash
    held = {"a": small, "b": small[:15], "c": small[5:], "d": small[:1]}
    hits = spark.createDataFrame([(k, 1, h) for k, hashes in held.items() for h in hashes], "row_key string, doc_id long, hash long")
    pairs = decontamination.candidates(hits, shingles)
    assert sorted(r["row_key"] for r in pairs.collect()) == ["a", "b", "d"]
    assert decontamination.document_sketches(hits, shingles).where("row_key = 'a'").count() == 5
    found = decontamination.verified(hits, shingles, pairs).collect()
    assert [(r["row_key"], r["n_shared"], r["q"]) for r in found] == [("a", 20, 20)]
    docs = spark.createDataFrame([(1, " ".join(other + item + other)), (2, " ".join(item[:18] + other)), (3, " ".join(other))], "doc_id long, text string")
    assert [(r["doc_id"], r["n_shared"]) for r in decontamination.benchmark_leaks(docs, items).collect()] == [(1, 20)]
