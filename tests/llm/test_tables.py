"""Vectors, mixing, licences, the pipeline, and the queries' SQL."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
import corpus_pipeline
from tests.check_oracles import compare, connect
from tests.llm import brute
from tidemark.llm import licences, mixing, near_vectors, queries

SF_DIR = "/root/testdata/sf0.001"
ORACLES = queries.oracle_sql()


def test_vectors_link_exactly_and_odd_ones_do_not(spark):
    rng = np.random.default_rng(1)
    rows = []
    for k in range(12):
        center = rng.normal(size=24)
        for j in range(int(rng.integers(1, 12))):
            rows.append((len(rows), [float(x) for x in center + rng.normal(size=24) * 0.06 * j]))
    rows += [(500, rows[0][1]), (501, rows[0][1]), (502, None), (503, []), (504, [0.0] * 24), (505, [float("nan")] * 24)]
    rows += [(506, [None, *rows[0][1][1:]]), (507, [1.0, 2.0]), (None, rows[0][1]), (508, [x * 1e300 for x in rows[0][1]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS rep", "2 AS cell")
    usable = {i: np.array(v) / max(map(abs, v)) for i, v in rows if i is not None and v and len(v) == 24 and None not in v and any(v) and not math.isnan(v[0])}
    union, links = brute.Union([i for i, _ in rows if i is not None]), dict.fromkeys([i for i, _ in rows], 0)
    for a in usable:
        for b in usable:
            if a < b and usable[a] @ usable[b] / np.linalg.norm(usable[a]) / np.linalg.norm(usable[b]) >= 0.9:
                union.join(a, b)
                links[a] += 1
                links[b] += 1
    got = {r.vec_id: r for r in near_vectors.linked_vectors(df).collect()}
    assert {i: got[i].n_links for i in links if i is not None} == {i: n for i, n in links.items() if i is not None}
    assert all(got[i].component_id == union.find(i) and got[i].kept == (i == union.find(i)) for i in links if i is not None)
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, False)
    assert near_vectors.linked_vectors(df.limit(0)).count() == 0


def test_recall_of_a_grid_of_many_cells(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "CELL", 8)
    monkeypatch.setattr(near_vectors, "PART", 16)
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(200, 32))
    vectors = np.concatenate([centers + rng.normal(size=centers.shape) * s for s in (0, 0.2, 0.3, 0.42)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    true = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    found = np.array([r.n_links for r in near_vectors.linked_vectors(df).orderBy("vec_id").collect()])
    assert (found <= true).all() and found.sum() >= 0.9 * true.sum()


@pytest.mark.parametrize("cell", [512, 2])
def test_each_length_of_vectors_is_searched(spark, monkeypatch, cell):
    monkeypatch.setattr(near_vectors, "CELL", cell)
    rng = np.random.default_rng(4)
    rows = []
    for width, n in ((16, 12), (8, 9), (3, 5), (1, 4)):
        for center in rng.normal(size=(n, width)):
            rows += [[float(x) for x in center + rng.normal(size=width) * s] for s in (0, 0, 0.02)]
    vectors = {i: np.array(v) / np.linalg.norm(v) for i, v in enumerate(rows)}
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    union, links = brute.Union(vectors), dict.fromkeys(vectors, 0)
    for a, x in vectors.items():
        for b, y in vectors.items():
            if a < b and len(x) == len(y) and x @ y >= 0.9:
                union.join(a, b)
                links[a], links[b] = links[a] + 1, links[b] + 1
    got = {r.vec_id: r for r in near_vectors.linked_vectors(df, recall=1.0).collect()}
    assert all(got[i].n_links <= links[i] for i in links) and sum(r.n_links for r in got.values()) >= 0.9 * sum(links.values())
    if cell == 512:
        assert {i: (r.n_links, r.component_id) for i, r in got.items()} == {i: (links[i], union.find(i)) for i in links}
    assert min(sum(got[i].n_links for i in links if len(rows[i]) == w) for w in (16, 8, 3, 1)) > 0


def test_multi_sequence_visits_in_order_of_distance():
    rng = np.random.default_rng(3)
    a, b = rng.random(7), rng.random(5)
    cells = near_vectors.multi_sequence(a, b, 35)
    sums = [a[c // 5] + b[c % 5] for c in cells]
    assert sums == sorted(sums) and len(set(cells.tolist())) == 35


def test_raking_meets_the_marginals(spark):
    rows = [("s1", "en", "x", 900), ("s1", "de", "y", 50), ("s2", "en", "y", 30), ("s2", "de", "x", 20), ("s3", "en", "x", 5), ("s3", "de", "y", 0)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, m long")
    targets = {"source": {"s1": 0.5, "s2": 0.3, "s3": 0.2}, "lang": {"en": 0.6, "de": 0.4}, "topic": {"x": 0.5, "y": 0.5}}
    got = mixing.rake(cells, targets, 200).collect()
    mass = {(r[0], r[1], r[2]): r[3] / 1005 for r in rows}
    for at, name in enumerate(("source", "lang", "topic")):
        for member, share in targets[name].items():
            held = sum(r.ratio * mass[r.source, r.lang, r.topic] for r in got if r[at] == member)
            assert held == pytest.approx(share, abs=0.02)


def test_sample_has_the_target_shares_where_raking_lifts_cells(spark):
    counts = {("en", "a"): 1600, ("en", "b"): 200, ("de", "a"): 100, ("de", "b"): 100}
    keys = [key for key, n in counts.items() for _ in range(n)]
    docs = spark.createDataFrame([(i, "one two three", lang, s) for i, (lang, s) in enumerate(keys)], "doc_id long, text string, lang string, source string")
    targets = {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.7, "de": 0.3}}
    rows = mixing.mixed(docs, targets).collect()
    drawn = sum(r.mix_copies for r in rows)
    assert drawn == pytest.approx(len(rows), rel=0.05) and max(r.mix_ratio for r in rows) > 2
    assert all(abs(r.mix_copies - r.mix_ratio) < 1 for r in rows)
    chances, chosen = sum(r.mix_probability for r in rows), sum(r.mix_selected for r in rows)
    assert max(r.mix_probability for r in rows) == pytest.approx(1, abs=1e-6) and chosen > 300
    for column, wanted in targets.items():
        for member, share in wanted.items():
            own = [r for r in rows if r[column] == member]
            assert sum(r.mix_copies for r in own) / drawn == pytest.approx(share, abs=0.02)
            assert sum(r.mix_probability for r in own) / chances == pytest.approx(share, abs=0.01)
            assert sum(r.mix_selected for r in own) / chosen == pytest.approx(share, abs=0.05)


def test_probabilities_of_documents_meet_the_targets(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = mixing.mixed(docs).collect()
    total, weighed = sum(r.mix_tokens for r in rows), sum(r.mix_tokens * r.mix_probability for r in rows)
    for column, name in (("source", "source"), ("lang", "lang"), ("mix_topic", "topic")):
        held, drawn = Counter(), Counter()
        for r in rows:
            held[r[column] or ""] += r.mix_tokens / total
            drawn[r[column] or ""] += r.mix_tokens * r.mix_probability / weighed
        want = mixing._targets(held, mixing.TEMPERATURES[name], None)
        assert all(drawn[m] == pytest.approx(share, abs=0.01) for m, share in want.items())


def test_mixing_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame(
        [(i, "word " * 9, "en", "s", 7, "x", i, "r", "t", 0.5) for i in range(40)] + [(0, "word " * 9, "en", "s", 7, "x", 0, "r", "t", 0.5)],
        "doc_id long, text string, lang string, source string, mix_tokens int, _s string, id long, row string, topic string, ratio double",
    )
    out = mixing.mixed(docs)
    assert out.columns == [c for c in docs.columns if c != "mix_tokens"] + mixing._ADDED
    assert {(r.mix_tokens, r.row, r.ratio, round(r.mix_ratio, 6)) for r in out.collect()} == {(9, "r", 0.5, 1.0)}
    kept = mixing.sampled(docs)
    assert kept.columns == docs.columns and sorted(kept.collect()) == sorted(docs.collect())
    long = spark.createDataFrame([(1, "word " * 400_000, "en", "s")], "doc_id long, text string, lang string, source string")
    assert mixing.mixed(long).first()["mix_tokens"] == 400_000


def test_the_sample_holds_a_row_as_often_as_it_was_drawn(spark):
    docs = spark.createDataFrame([(i, "word " * 50, "en" if i % 50 else "de", "s") for i in range(500)], "doc_id long, text string, lang string, source string")
    expected = {r.doc_id: r.mix_copies for r in mixing.mixed(docs).collect() if r.mix_copies}
    got = {r.doc_id: r["count"] for r in mixing.sampled(docs).groupBy("doc_id").count().collect()}
    assert got == expected and max(got.values()) > 1


def test_mixing_of_null_and_empty_rows(spark):
    rows = [(i, "word " * (i % 7 + 1), None if i % 5 == 0 else "en", None if i % 3 == 0 else "s") for i in range(60)]
    docs = spark.createDataFrame([*rows, (None, None, None, None), (99, "", "fr", "z")], "doc_id long, text string, lang string, source string")
    out = mixing.mixed(docs)
    assert out.count() == 62 and out.columns[:4] == docs.columns
    assert out.filter("mix_probability IS NULL OR mix_probability < 0 OR mix_probability > 1 OR mix_selected IS NULL").isEmpty()
    assert mixing.sampled(docs.limit(0)).count() == 0


def test_licences_are_found_and_inherited(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    files = [
        (1, "host/lib/", f"about\n{mit}\nmore"), (2, "host/lib/a.c", "int main"), (3, "host/lib/deep/LICENSE.txt", gpl),
        (4, "host/lib/deep/b.c", None), (5, "host/lib/deep/down/c.c", ""), (6, "host/other/d.c", "words"), (7, None, mit),
        (8, "host/lib/e.c", gpl + " Thanks."), (8, "host/lib/e.c", gpl + " Thanks."), (9, "host/lib/deep/f.c", "a license to be merry"),
    ]
    got = {r.file_id: r for r in licences.scan(spark.createDataFrame(files, "file_id long, path string, text string")).collect()}
    assert {i: (r.licence, r.origin) for i, r in got.items()} == {
        1: ("MIT", "own"), 2: ("MIT", "inherited"), 3: ("GPL-3.0", "own"), 4: ("GPL-3.0", "inherited"), 5: ("GPL-3.0", "inherited"),
        6: (None, "none"), 7: ("MIT", "own"), 8: ("GPL-3.0", "own"), 9: ("GPL-3.0", "inherited"),
    }
    assert got[5].directory == "host/lib/deep"


def test_linked_and_wrapped_notices_are_found(spark):
    filler = [(100 + k, f"http://h/p{k}", f"<p>words of page {k} under the version of 4.0 trees</p>") for k in range(60)]
    pages = [
        (1, "http://h/a/", "<p>About.</p><p>Licensed under <a href='x'>CC BY 4.0</a>.</p>"), (2, "http://h/a/b.html", "<p>none</p>"),
        (3, "http://h/c", "<p>Licensed under the <a>Apache <em>License</em></a>, Version 2.0</p>"),
        (4, "http://h/d", "<pre>Some words.\nThis work is licensed under the GNU\nGeneral Public License,\nversion 3.\n\nMore</pre>"),
        (5, "http://h/e", "<div>Released under<br/>the <b>MIT</b><br>License</div>"), (6, "http://h/f", "<p>a license to <i>be</i> merry</p>"),
        (7, "http://h/g", None),
    ]
    got = {r.page_id: r for r in licences.scan_pages(spark.createDataFrame(pages + filler, "page_id long, url string, html string")).collect()}
    assert {i: (got[i].licence, got[i].origin) for i, _, _ in pages} == {
        1: ("CC-BY-4.0", "own"), 2: ("CC-BY-4.0", "inherited"), 3: ("Apache-2.0", "own"), 4: ("GPL-3.0", "own"), 5: ("MIT", "own"),
        6: (None, "none"), 7: (None, "none"),
    }


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_sql(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, name, queries.queries()[name], ORACLES[name]) is None


def test_pipeline_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    named = docs.withColumn("score", F.lit("own")).withColumn("_score", F.lit("own"))
    kept = stages["toxicity"](spark, named, SF_DIR)
    assert kept.columns == named.columns and kept.select("score", "_score").distinct().collect() == [("own", "own")]
    assert 0.8 * docs.count() < kept.count() <= docs.count()
    single = stages["near_copies"](spark, docs, SF_DIR)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = {i for i, (_, c) in brute.linked(rows, 5, (80, 100)).items() if i == c}
    assert single.columns == docs.columns and {r.doc_id for r in single.collect()} == expected
    clean = {r.doc_id: r.text for r in stages["personal_data"](spark, docs, SF_DIR).collect()}
    assert clean.keys() == {i for i, _ in rows} and not any(brute.personal(t) for t in clean.values())
    assert stages["mixing"](spark, docs, SF_DIR).columns == docs.columns
    assert stages["packing"](spark, docs, SF_DIR).select("doc_id").distinct().count() == len(rows)


def test_near_copies_of_repeated_ids_nulls_and_empty_texts(spark):
    long, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    rows = [
        (1, long, "a"), (2, long + " end", "b"), (2, long + " end", "b"), (5, other, "c"), (5, other, "c"), (5, other, "b"),
        (7, None, "d"), (8, "", "d"), (9, "", "d"), (None, long, "n"), (None, long, "n"), (None, None, "n"),
    ]
    docs = spark.createDataFrame([(i, t, s, 1, "r") for i, t, s in rows], "doc_id long, text string, source string, id int, row string")
    out = dict(corpus_pipeline.STAGES)["near_copies"](spark, docs, SF_DIR)
    assert out.columns == docs.columns
    expected = [(None, None, "n"), (None, long, "n"), (1, long, "a"), (5, other, "b"), (7, None, "d"), (8, "", "d"), (9, "", "d")]
    assert sorted(((r.doc_id, r.text, r.source) for r in out.collect()), key=str) == sorted(expected, key=str)
    assert dict(corpus_pipeline.STAGES)["near_copies"](spark, docs.limit(0), SF_DIR).isEmpty()


def test_entry_registers_every_operator():
    names = spark_entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names


def test_pages_without_a_cue_are_not_cut_for_cues(spark):
    """Only pages whose source has a cue's letters are cut, and those cut by tags or in capitals stay found."""
    pages = [
        (1, "http://a/1", "<p>LICENSED UNDER CC BY 4.0.</p>"),
        (2, "http://a/2", "<p>Released under the MIT Li<b>cen</b>se.</p>"),
        (3, "http://a/3", "<p>nothing</p>"),
        (4, "http://a/4", None),
        (5, "http://a/5", "<script>license</script><p>Subject to the terms of the Mozilla Public Licenſe, v. 2.0.</p>"),
    ]
    filler = [(k, f"http://f{k}/x", f"<p>filler words number {k} of a page</p>") for k in range(10, 60)]
    df = spark.createDataFrame(pages + filler, "page_id long, url string, html string")
    files = df.select(
        F.col("page_id").alias("file_id"), licences.url_path(F.col("url")).alias("path"),
        licences.plain_text(F.col("html")).alias("text"), licences.joined_text(F.col("html")).alias("joined"), "html",
    )
    kept = files.filter(licences._may_be_cued(F.col("html"))).select("file_id").collect()
    assert sorted(r.file_id for r in kept) == [1, 5]
    got = {r.file_id: r.own_licence for r in licences.own_licences(files, "joined", "html").collect()}
    assert (got[1], got[2], got[3], got[4]) == ("CC-BY-4.0", "MIT", None, None)
    whole = {r.file_id: r.own_licence for r in licences.own_licences(files.drop("html"), "joined").collect()}
    assert got == whole
