"""Operators on texts against brute force, with nulls, empties, ties, repeats and clashing columns."""

import hashlib
import random
from types import SimpleNamespace
from unittest.mock import patch

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tidemark.llm import fingerprints, jaccard_join, language, packing, personal_data, queries, repeats, toxicity
from tidemark.llm.components import components

# Columns of an input that carry the names operators use inside.
CLASHES = ["sig", "core", "component", "node", "score", "sketch", "mark", "a", "b", "n"]


def table(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema).selectExpr("*", *[f"7 AS {c}" for c in CLASHES])


def prose(rng, n, words=4000):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def edited(rng, text, changes):
    words = text.split(" ")
    for i in rng.sample(range(len(words)), min(changes, len(words))):
        words[i] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    rows, next_id = [], 0
    for _ in range(25):
        base = prose(rng, rng.choice([1, 2, 3, 5, 12, 40, 150, 400]))
        for k in range(rng.choice([1, 1, 2, 4])):
            rows.append((next_id, edited(rng, base, k * rng.choice([0, 1, 3])) if k else base))
            next_id += 1
    passage = prose(rng, 60)
    rows += [(next_id + k, f"{prose(rng, 30)} {passage} {prose(rng, 30)}") for k in range(6)]
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "é" * 150), (904, "A" * 700), (905, "é" * 150), (906, rows[0][1].upper())]
    return rows


@pytest.mark.parametrize("words, least", [(3, (90, 100)), (5, (80, 100))])
def test_jaccard_components(spark, corpus, words, least):
    got = jaccard_join.linked_documents(table(spark, corpus), words=words, least=least).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.linked(corpus, words, least)


def test_jaccard_blocks_agree_with_a_single_block(spark, corpus, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 2)
    rng = random.Random(8)
    base = prose(rng, 120)
    rows = [*corpus, *[(2000 + k, edited(rng, base, k % 9)) for k in range(40)]]
    got = jaccard_join.linked_documents(table(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.linked(rows, 3, (90, 100))


def test_signatures_never_miss_a_pair_at_the_threshold():
    rng = np.random.default_rng(1)
    for least in ((90, 100), (80, 100)):
        layout = jaccard_join.Layout(least)
        for n in [1, 2, 5, 9, 10, 19, 20, 47, 190, 600]:
            left = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            drop = int(n * (1 - least[0] / least[1]) + 1e-9)
            right = np.sort(rng.permutation(left)[drop:])
            assert len(np.intersect1d(layout.signatures(left), layout.signatures(right)))


def test_bucket_counts_bound_intersections_and_tell_large_sets_apart():
    rng = np.random.default_rng(5)
    for n in (100, 2000, 2100, 30000, 300000):
        base = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        copy = np.unique(np.concatenate([base[n // 10 :], rng.integers(0, 2**64, n // 12, dtype=np.uint64)]))
        other = np.unique(np.concatenate([base[: n // 4], rng.integers(0, 2**64, n - n // 4, dtype=np.uint64)]))
        sets = [base, copy, other]
        counts = [jaccard_join.bucket_counts(s) for s in sets]
        matrix = jaccard_join.folded(counts)
        assert all(counts) and matrix.sum(axis=1).tolist() == [len(s) for s in sets]
        for a in range(3):
            for b in range(3):
                assert np.minimum(matrix[a], matrix[b]).sum() >= len(np.intersect1d(sets[a], sets[b]))
        sizes, known = np.array([len(s) for s in sets]), np.ones(3, dtype=bool)
        pairs = jaccard_join.possible(matrix, sizes, known, np.zeros(3, dtype=int), (80, 100))
        assert pairs[0, 1] and not pairs[0, 2]
    empty = jaccard_join.folded([b"", jaccard_join.bucket_counts(base)])
    assert not empty[0].any() and empty[1].sum() == len(base)


def test_jaccard_of_an_id_with_several_texts(spark):
    rng = random.Random(14)
    a, b = prose(rng, 60), prose(rng, 80)
    rows = [(5, a), (5, b), (5, b), (1, a + " more"), (7, b + " more"), (9, prose(rng, 50)), (3, "")]
    for _ in range(2):
        rows.reverse()
        got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.linked_documents(table(spark, rows)).collect()}
        assert got == {(5, 58, 1), (5, 78, 1), (1, 59, 1), (7, 79, 1), (9, 48, 9), (3, 0, 3)}


def test_words_are_hashed_alike_wherever_they_stand(monkeypatch):
    rng = random.Random(15)
    words = ["".join(rng.choices("abcdeé", k=rng.choice([1, 2, 5, 70, 200]))) for _ in range(400)]
    text = "".join(w + rng.choice([" ", "\n", " \t ", "\x0b"]) for w in words).encode()
    whole = jaccard_join.word_hashes(text)
    assert len(whole) == len(words) and len(np.unique(whole)) == len(set(words))
    assert [int(jaccard_join.word_hashes(w.encode())[0]) for w in words] == whole.tolist()
    assert (jaccard_join.word_hashes(b"  A\xc3\x89Z\r") == jaccard_join.word_hashes("aÉz".encode())).all()
    assert jaccard_join.word_hashes(b" \n ").size == 0 == jaccard_join.word_hashes(b"").size
    monkeypatch.setattr(jaccard_join, "PIECE", 100)
    assert (jaccard_join.word_hashes(text) == whole).all()


def test_jaccard_of_null_ids_and_empty_tables(spark):
    got = jaccard_join.linked_documents(table(spark, [(None, "a b c d"), (1, "a b c d"), (1, "a b c d")])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (1, 1), (1, 1)]
    assert jaccard_join.linked_documents(table(spark, [])).count() == 0


def test_jaccard_of_common_signatures(spark, corpus, monkeypatch):
    """Few sets are a crowd here: parts are spared, crowds compared in blocks, as families and signature by signature."""
    rng = random.Random(21)
    passages = [prose(rng, 40) for _ in range(3)]
    rows = list(corpus)
    for k in range(40):
        rows.append((3000 + k, " ".join([prose(rng, 60 + k % 5), *rng.sample(passages, 2), prose(rng, 20)])))
    family = prose(rng, 150)
    rows += [(4000 + k, edited(rng, family, rng.choice([2, 6, 30]))) for k in range(30)]
    for crowd, block in ((1, 2000), (2, 7), (5, 2000)):
        monkeypatch.setattr(jaccard_join, "CROWD", crowd)
        monkeypatch.setattr(jaccard_join, "BLOCK_SETS", block)
        got = jaccard_join.linked_documents(table(spark, rows), words=5, least=(80, 100)).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.linked(rows, 5, (80, 100))


def test_jaccard_compares_no_chain_of_chance_candidates(spark, monkeypatch):
    """Different texts that share passages are one candidate component, and yet no blocks of it are compared."""
    rng = random.Random(22)
    passages = [prose(rng, 60) for _ in range(4)]
    rows = [(k, " ".join([prose(rng, 120), *rng.sample(passages, 2)])) for k in range(160)]
    rows += [(1000 + k, f"{t} more") for k, t in rows[:5]]
    compared, blocks = [], jaccard_join._blocks

    def counted(members, growth):
        compared.append(members.count())
        return blocks(members, growth)

    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 20)
    monkeypatch.setattr(jaccard_join, "_blocks", counted)
    got = jaccard_join.linked_documents(table(spark, rows), words=5, least=(80, 100)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.linked(rows, 5, (80, 100))
    assert 10 <= sum(compared) <= 30


def test_similar_sets_share_a_signature_that_neither_spares():
    rng = np.random.default_rng(2)
    for least in ((90, 100), (80, 100)):
        layout = jaccard_join.Layout(least)
        for n in [1, 5, 10, 20, 47, 190, 600, 2000]:
            spared = 0
            for _ in range(20):
                left = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
                right = np.sort(rng.permutation(left)[int(n * (1 - least[0] / least[1]) + 1e-9) :])
                used = []
                # Any order of all signatures is right; the worst one for the pair spares those it shares.
                common = set(np.intersect1d(layout.signatures(left), layout.signatures(right)).tolist())
                for side in (left, right):
                    sigs, left_out = layout.signed(side)
                    kept = set()
                    for group in range(1 << jaccard_join.GROUP_BITS):
                        own = [s for s in sigs.tolist() if s % (1 << jaccard_join.GROUP_BITS) == group]
                        spare = left_out >> jaccard_join.SPARE_BITS * group & (1 << jaccard_join.SPARE_BITS) - 1
                        assert spare < max(len(own), 1)
                        kept |= set(sorted(own, key=lambda s: (s not in common, s))[spare:])
                        spared += spare
                    used.append(kept)
                assert used[0] & used[1]
            assert spared or n < 100


@pytest.mark.parametrize("cut", [1, 2, 3, 5, 50])
def test_members_of_signatures_wherever_batches_end(cut):
    rng = np.random.default_rng(3)
    sig = np.sort(np.concatenate([np.repeat(rng.integers(-50, 50, 12), rng.integers(1, 9, 12)), rng.integers(100, 10**6, 20)]))
    node = rng.integers(0, 6, len(sig))
    node = node[np.lexsort((node, sig))]
    batches = [pa.RecordBatch.from_arrays([pa.array(x[i : i + cut]) for x in (sig, node)], names=["sig", "node"]) for i in range(0, len(sig), cut)]
    with patch.object(jaccard_join.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 4)):
        out = pa.Table.from_batches(list(jaccard_join._neighbours(iter([batches[0].slice(0, 0), *batches])))).to_pylist()
    groups = {}
    for s, d in zip(sig.tolist(), node.tolist()):
        groups.setdefault(s, set()).add(d)
    ends = (int(sig[0]), int(sig[-1]))
    got = [(r["sig"], r["a"]) for r in out if r["kind"] == jaccard_join._MEMBER]
    assert sorted(got) == sorted((s, d) for s, ds in groups.items() if len(ds) > 2 or s in ends for d in ds)
    edges = {(r["a"], r["b"]) for r in out if r["kind"] == jaccard_join._EDGE}
    assert edges == {pair for ds in groups.values() for pair in zip(sorted(ds)[1:], sorted(ds))}
    assert [r["sig"] for r in out if r["kind"] == jaccard_join._END] == list(ends)


def test_bounds_of_pairs_with_other_numbers_of_buckets():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)) for n in (3, 2000, 2060, 2100, 5000)]
    sets.append(np.unique(np.concatenate([sets[2][:1900], sets[3][:50]])))
    counts = [*map(jaccard_join.bucket_counts, sets), b""]
    sizes = np.array([*map(len, sets), 400])
    a, b = (x.ravel() for x in np.indices((7, 7)))
    got = jaccard_join.bounds(tuple(pa.array([counts[i] for i in x], pa.binary()) for x in (a, b)), (sizes[a], sizes[b]))
    for x, y, most in zip(a, b, got):
        if 6 in (x, y):
            assert most == min(sizes[x], sizes[y])
        else:
            assert most == np.minimum(*jaccard_join.folded([counts[x], counts[y]])).sum() >= len(np.intersect1d(sets[x], sets[y]))


def test_repeats(spark, corpus):
    rows = [*corpus, (903, "é" * 150), (None, corpus[0][1])]
    got = repeats.digests(table(spark, rows)).collect()
    expected = sorted((i if i is not None else -1, *d) for (i, _), d in zip(rows, brute.repeats([t for _, t in rows])))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == expected
    assert repeats.digests(table(spark, [])).count() == 0


def test_repeats_of_rows_that_share_an_id(spark):
    rng = random.Random(31)
    first = prose(rng, 150)
    while True:  # another text whose sixteen-bit mark is the first's
        second = prose(rng, 60) + f" {rng.random()}"
        if repeats.mark_of(second.encode()) == repeats.mark_of(first.encode()):
            break
    rows = [(7, first), (7, second), (8, first[:300])] + [(None, prose(rng, 60)) for _ in range(300)] + [(None, first[100:400])]
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.digests(table(spark, rows)).collect())
    assert got == sorted((i or -1, *d) for (i, _), d in zip(rows, brute.repeats([t for _, t in rows])))


def test_repeats_of_long_texts_are_parsed_piecewise(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 300)
    rng = random.Random(2)
    a, b = prose(rng, 300), prose(rng, 120)
    data = (a + b).encode()
    whole = [p for p in repeats.phrases(data)]
    assert [s for first, last, _ in whole for s in range(first, last + 1)] == list(range(len(data) - 199))
    rows = [(1, a + b), (2, b + a[:400]), (3, prose(rng, 100))]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.digests(table(spark, rows)).collect()}
    assert [got[i] for i in (1, 2, 3)] == brute.repeats([t for _, t in rows])


def test_repeats_can_be_cut_out(spark):
    rng = random.Random(3)
    passage = prose(rng, 80)
    rows = [(1, "first " + passage), (2, passage + " second"), (3, None)]
    df = table(spark, rows)
    cut = repeats.without_repeats(df, repeats.repeated_runs(df))
    assert cut.columns == df.columns
    assert {r.doc_id: r.text for r in cut.collect()} == {1: "first ", 2: " second", 3: None}


def test_fingerprints(spark, corpus):
    rows = [(i, t) for i, t in corpus]
    got = sorted(fingerprints.edited_fingerprints(table(spark, rows)).collect(), key=lambda r: r.doc_id)
    ordered = [t or "" for _, t in sorted(rows, key=lambda r: r[0])]
    for row, text, following in zip(got, ordered, ordered[1:] + ordered[:1]):
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
    prints = {r.doc_id: r.fingerprint for r in got}
    assert prints[900] == prints[901] == prints[902] == "" and prints[903] == prints[905]
    assert fingerprints.edited_fingerprints(table(spark, [])).count() == 0
    alone = fingerprints.edited_fingerprints(table(spark, [(5, "one two three four five six")])).first()
    assert alone.near_next == 1.0


def test_containment_is_estimated_for_unequal_texts(spark):
    rng = random.Random(4)
    part = prose(rng, 600, 10**6)
    whole = part + " " + prose(rng, 20000, 10**6)
    df = spark.createDataFrame([(part, whole)], "p string, w string")
    p, w = fingerprints.sketch(F.col("p")), fingerprints.sketch(F.col("w"))
    got = df.select(fingerprints.containment(p, w, F.col("w")), fingerprints.containment(w, p, F.col("p"))).first()
    assert got[0] > 0.95 and got[1] < 0.1


def test_short_texts_are_found_in_longer_ones(spark):
    rng = random.Random(16)
    rows = []
    for k in range(40):
        part = prose(rng, 5, 10**6)
        rows += [(2 * k, part), (2 * k + 1, f"{prose(rng, 40, 10**6)} {part} {prose(rng, 40, 10**6)}")]
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(table(spark, rows)).collect()}
    assert all(got[2 * k].near_next == 1.0 for k in range(40))
    assert all(got[2 * k + 1].near_next == 0.0 for k in range(39))


def test_merging_gives_the_sketch_of_the_union(spark):
    rng = random.Random(17)
    rows = [(prose(rng, rng.choice([0, 3, 5, 6, 9, 40]), 10**6), prose(rng, rng.choice([0, 5, 7, 60]), 10**6)) for _ in range(60)]
    a, b = fingerprints.sketch(F.col("a")), fingerprints.sketch(F.col("b"))
    both = F.array_union(fingerprints.shingle_hashes(F.col("a")), fingerprints.shingle_hashes(F.col("b")))
    df = spark.createDataFrame(rows, "a string, b string").select(fingerprints.merged(a, b).alias("m"), both.alias("u"))
    below = -(1 << 63) + (1 << 64) // fingerprints.SCALE
    for r in df.collect():
        low = sorted(h for h in r.u if h < below)
        assert r.m == (low or ([min(r.u)] if r.u else []))


def test_packing_is_a_partition_with_right_ids(spark, corpus):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    tokenizer.encode_special_tokens = True
    rng = random.Random(6)
    rows = [*corpus, (1000, prose(rng, 3000)), (1001, "<|endoftext|> don't  stop\n\n \t now"), (None, "no id")]
    got = packing.pack_documents(table(spark, rows).coalesce(1)).collect()  # a task leaves a padded sequence
    expected = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}
    for key, ids in expected.items():
        pieces = sorted((r for r in got if r.doc_id == key), key=lambda r: r.start)
        at = 0
        for p in pieces:
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == packing.zlib.crc32(np.array(ids[at : at + p.length], dtype="<u4").tobytes())
            at += p.length
        assert at == len(ids)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        assert sorted(o for o, _ in pieces) == [sum(n for _, n in sorted(pieces)[:k]) for k in range(len(pieces))]
        assert sum(n for _, n in pieces) <= 1024
    assert sum(r.length for r in got) > 0.9 * 1024 * (len(sequences) - 1)
    assert packing.pack_documents(table(spark, [])).count() == 0


def test_query_and_stage_pack_the_ids_of_the_tokenizers_default_setting(spark, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|><|endoftext|>\n\nnext"), (3, "<|endoftext> no token"), (4, None)]
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    query, stage = queries.queries()["op5_vector_packing"](spark, str(tmp_path)), corpus_pipeline.pack_sequences(spark, docs, str(tmp_path))
    expected = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}
    assert expected[1] == [64, 220, 50256, 275, 0]
    for packed in (query, stage):
        got = {r.doc_id: (r.length, r.ids_crc32) for r in packed.collect()}
        assert got == {i: (len(ids), packing.zlib.crc32(np.array(ids, dtype="<u4").tobytes())) for i, ids in expected.items()}


def test_packing_keeps_all_three_limits(spark):
    rng = random.Random(9)
    turns = [
        (c, t, "assistant" if t % 2 else "user", prose(rng, rng.randrange(1, 200))) for c in range(60) for t in range(4)
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    limits = packing.Limits(tokens=1024, segments=3, loss=300)
    sums = packing.pack_conversations(df, limits=limits).groupBy("sequence_id").agg(
        F.sum("length").alias("t"), F.count("*").alias("s"), F.sum("loss_tokens").alias("l")
    )
    assert sums.filter("t > 1024 OR s > 3 OR l > 300").isEmpty() and sums.count() > 10


def test_bins_prefer_what_fits_the_room():
    bins = packing.choose(np.array([[600, 1, 0], [500, 1, 0], [400, 1, 0], [424, 1, 0]], dtype=float), np.array([1024.0, 128, 1024]))
    assert sorted(map(sorted, bins)) == [[0, 3], [1, 2]]


PII = [
    (1, "write a.b+c@mail.example.com, x@y@z.org or @no.where; 10.0.0.255 and 10.0.0.256, 1.2.3.4.5"),
    (2, "card 4111 1111 1111 1111 and 4111 1111 1111 1112, call +1 (017) 555-7713 or +1-2"),
    (3, None), (4, ""), (5, "9" * 5000 + " " + "1." * 50), (6, "a@b.c@d.e +49 30 1234567 é 192.168.0.1"), (6, "a@b.c@d.e +49 30 1234567 é 192.168.0.1"),
]


def test_pattern_spans_and_digest(spark):
    field = personal_data.Field({})
    for row, (_, text) in zip(sorted(personal_data.find(table(spark, PII), field).collect(), key=lambda r: r.doc_id), PII):
        spans = brute.personal(text or "")
        assert row.spans == ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert row.base_sha256 == hashlib.sha256(row.spans.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == kind for k, _, _ in spans) for kind in personal_data.KINDS]


@pytest.fixture(scope="module")
def field(spark):
    rng = random.Random(11)
    rows = []
    for i in range(240):
        what = [
            f"{rng.choice(['ann', 'bob', 'eve'])}{i}@mail{i % 9}.example.com",
            ".".join(str(rng.randrange(256)) for _ in range(4)),
            f"+{rng.randrange(1, 99)} ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}",
            f"{rng.randrange(10, 99999)}",
        ][i % 4]
        rows.append((i, f"{prose(rng, 10)} {what} {prose(rng, 10)}".replace("w", "word")))
    return personal_data.train(table(spark, rows))


def test_field_adds_spans_without_touching_the_patterns(field):
    base, added = personal_data.all_spans("call 1 (555) 555-1234 or mail ann at mail3 dot example dot com now", field)
    assert base == [] and {k for k, _, _ in added} <= {"phone", "email"} and added
    text = "plain words, 12 apples, the year 1999 and room 404"
    assert personal_data.all_spans(text, field) == ([], [])
    assert personal_data.redacted("to eve7@mail1.example.com.", field) == "to <EMAIL>."


def test_field_posteriors_sum_over_all_segmentations(field):
    text = "at 1.2.3.4 x"
    lattice = field.lattice(text, personal_data.units_of(text))
    forward, backward = field.marginals(lattice)
    assert forward[-1] == pytest.approx(backward[0])


def test_language_of_known_unknown_and_wordless_texts(spark):
    english = "the house and the river are near the old bridge with stones"
    german = "das haus und der fluss sind nahe an der alten brücke mit steinen"
    rows = [(i, english if i % 2 else german, "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, "bridges housed rivers", None), (101, "steinhaus flussbrücken", None), (102, None, "en"), (103, "12 !", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", *[f"7 AS {c}" for c in CLASHES])
    got = {r.doc_id: r for r in language.identify_documents(docs).collect()}
    assert all(got[i].lang_pred == ("en" if i % 2 else "de") for i in range(60))
    assert (got[100].lang_pred, got[101].lang_pred) == ("en", "de")
    assert (got[102].lang_pred, got[102].score, got[103].lang_pred) == ("und", 0.0, "und")
    assert language.identify_documents(docs.limit(0)).count() == 0


def test_language_of_signs_that_are_no_letters_and_of_many_languages(spark):
    assert [language.words_in(r) for r in language.runs_of("½ ² 12 X² äÖ½b")] == [[], [], ["x"], ["äö", "b"]]
    rng = random.Random(32)
    rows = [(i, " ".join(f"q{chr(97 + k % 26)}{chr(97 + k // 26)}{rng.choice('xyz')}" for _ in range(6)), f"l{k}") for k in range(230) for i in (4 * k, 4 * k + 1, 4 * k + 2)]
    docs = spark.createDataFrame([*rows, (5000, "½ ²", "l1"), (5001, "qaax½ ½ qaay²", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.identify_documents(docs).collect()}
    assert (got[5000].lang_pred, got[5000].score, got[5001].lang_pred) == ("und", 0.0, "l0")
    assert np.mean([got[i].lang_pred == lang for i, _, lang in rows if not got[i].held_out]) > 0.9


def test_toxicity_learns_words_and_handles_odd_rows(spark):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        words = prose(rng, 40, 500).split(" ")
        if bad:
            words[5:5] = rng.sample(["nastyword", "vileword", "foulword"], 2)
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    docs = table(spark, [*rows, (1000, None), (1001, "")])
    marks = spark.createDataFrame([*labels, (1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_documents(docs, marks).collect()}
    held = [i for i, _ in rows if got[i].held_out]
    assert np.mean([got[i].predicted == dict(labels)[i] for i in held]) > 0.95
    assert got[1000].score == got[1001].score and got[1000].predicted == 0
    assert all(r.predicted == 0 for r in toxicity.score_documents(docs, marks.limit(0)).collect())


def test_toxicity_does_not_depend_on_how_many_rows_the_draw_leaves_out(spark):
    rng = random.Random(21)
    base = []
    for i in range(1000):
        bad = i % 10 == 0
        telling = "hint" if rng.random() < (0.6 if bad else 0.15) else "vileword" if bad else "usual"
        base.append((f"{telling} w{rng.randrange(20)}", int(bad)))  # three of ten hints are toxic

    def predictions(copies):
        rows = [(k * len(base) + i, text, toxic) for k in range(copies) for i, (text, toxic) in enumerate(base)]
        df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
        model = toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"), per_label=1000)
        probes = spark.createDataFrame([("hint w1",), ("usual w2",), ("hint",), ("vileword w3",), ("",)], "text string")
        scores = [r.score for r in toxicity.with_score(probes, model, F.col("text")).collect()]
        return [s >= toxicity.THRESHOLD for s in scores]

    assert predictions(1) == predictions(20) == [False, False, False, True, False]


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(13)
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(20)] + [(7, 7), (None, 3)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(50)]
    union = brute.Union({n for e in edges for n in e if n is not None})
    for a, b in edges:
        if a is not None:
            union.join(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    touched = {n for a, b in edges if a is not None and a != b for n in (a, b)}
    assert got == {n: union.find(n) for n in touched}
