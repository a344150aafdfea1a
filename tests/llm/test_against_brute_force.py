"""Whole queries on the smallest tables, and hot groups, against plain Python."""

import hashlib
import itertools
import os
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
import corpus_pipeline
from tests.oracle import connect, duckdb_result, spark_result
from tidemark.llm import chaining, common, cuckoo, inner_products, language, minhash, packing, suffixes, toxicity
from tidemark.llm import bpe as transducer
from tidemark.llm.components import components
from tidemark.llm.queries import ORACLE, QUERIES, vocabulary

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


def run(spark, name):
    return QUERIES[name](spark, FOLDER).collect()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert spark_result(QUERIES[name](spark, FOLDER)) == duckdb_result(connect(FOLDER), ORACLE[name])


def test_all_operators_are_registered():
    names = entry_point.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names


def test_languages_of_held_out_documents(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    held = [r for r in run(spark, "op2_language_filters") if r["held_out"]]
    assert held and sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) >= 0.98 * len(held)


def test_a_language_with_one_or_two_documents_is_told(spark):
    random = np.random.default_rng(6)
    letters = {"aa": "abcdefgh", "bb": "ijklmnop", "cc": "qrstuvwx"}
    text = lambda c: " ".join("".join(random.choice(list(letters[c]), 2)) for _ in range(300))
    rows = [(i, text(lang), lang) for i, lang in enumerate(["aa"] * 20 + ["bb"] * 2 + ["cc"])]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert [model.decide(text(c))[0] for c in letters] == list(letters)


def test_many_languages_need_several_planes():
    names = [f"l{i:03d}" for i in range(70)]
    random = np.random.default_rng(5)
    words = {n: ["".join(chr(97 + c) for c in random.integers(0, 26, 6)) for _ in range(40)] for n in names}
    grams = {n: np.unique(language.grams(language.points(" ".join(w)))) for n, w in words.items()}
    filters = language.LanguageFilters(names, grams, names[0])
    assert len(filters.planes) == 2
    for n in names:
        assert filters.decide(" ".join(words[n]))[0] == n


def test_long_texts_count_each_gram_once():
    filters = language.LanguageFilters(["a"], {"a": np.zeros(0, np.uint64)}, "a")
    codes = np.frombuffer(("abcde " * 100_000).encode("utf-32-le"), np.uint32)
    n, _ = filters.counts(codes)
    assert n == sum(len(codes) - s + 1 for s in language.SIZES)


def test_encoding_matches_the_library(spark, texts):
    tokenizer = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    for r in run(spark, "op8_streaming_bpe"):
        ids = tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        back = tokenizer.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


def test_transducer_in_small_pieces(monkeypatch):
    path = vocabulary("byte_bpe_50k.json")
    mine, theirs = transducer.ByteBPE(path), Tokenizer.from_file(path)
    for name, value in (("AT_ONCE", 8), ("PIECE", 13), ("CACHED_CHARS", 0)):
        monkeypatch.setattr(transducer, name, value)
    random = np.random.default_rng(3)
    for alphabet in (" \n\t'aAbest0123.,!#é漢😀\x1c\x85　", "abetsion=A", "=-_", "a"):
        for _ in range(60):
            text = "".join(random.choice(list(alphabet), random.integers(0, 300)))
            ids = np.frombuffer(mine.encode(text), "<u4").tolist()
            assert ids == theirs.encode(text, add_special_tokens=False).ids
            assert "".join(mine.decode(ids)) == text
    assert "".join(mine.decode([10**9])) == ""
    broken = mine.encode("é漢")[:4]
    assert "".join(mine.decode(np.frombuffer(broken, "<u4").tolist())).endswith(("�", "é"))


def test_pair_stability_is_what_merging_gives():
    bpe = transducer.ByteBPE(vocabulary("byte_bpe_50k.json"))
    ids, random = list(bpe.merged.values()), np.random.default_rng(9)
    for a, b in random.choice(ids, (4_000, 2)).tolist():
        assert bpe.joint(a, b) == (bpe.merge(bpe.tokens[a] + bpe.tokens[b]) == [a, b])


def test_word_ids_match_the_library():
    path = vocabulary("word_bpe_49k.json")
    mine, theirs = packing.WordIds(path), Tokenizer.from_file(path)
    random = np.random.default_rng(4)
    alphabet = list(" \n'aAbeésÉßΣIİ0123.,!#`é漢😀\x1c\x85́ÿµªº×÷<|>")
    some = ["".join(random.choice(alphabet, random.integers(0, 60))) for _ in range(1_500)]
    for text in [*some, "a<|endoftext|>b", "it's I'M we'LL '' 's", "a" * 9_000, " x y　z", ""]:
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids


def test_packed_ids_are_the_documents(spark, texts):
    tokenizer = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    rows = packing.pack(spark.read.parquet(f"{FOLDER}/documents.parquet"), vocabulary("word_bpe_49k.json")).collect()
    parts = defaultdict(list)
    for r in rows:
        parts[r["doc_id"]].append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
    for doc, text in texts.items():
        ids = [i for _, piece in sorted(parts[doc]) for i in piece]
        assert ids == [*tokenizer.encode(text, add_special_tokens=False).ids, packing.END]


def test_plan_uses_each_length_as_often_as_it_occurs():
    random = np.random.default_rng(6)
    lengths = random.integers(1, 64, 5_000)
    histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)), strict=True))
    slots, rest, behind = packing.plan(histogram, 64, 10)
    used = defaultdict(int)
    for n, low, high, _, _ in slots:
        used[n] += high - low
    left = sum(n * (histogram[n] - low) for n, low, _ in rest)
    assert all(used[n] + next((histogram[n] - low for m, low, _ in rest if m == n), 0) == histogram[n] for n in histogram)
    assert left < 0.2 * lengths.sum() and behind >= 10


def test_repeated_bytes(spark, texts):
    seen, expected = set(), set()
    for doc in sorted(texts):
        raw = texts[doc].encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = b"\x01" * 100
            seen.add(raw[i : i + 100])
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        runs = sum(1 for x in bytes(gone).split(b"\x00") if x)
        expected.add((doc, len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    assert {tuple(r) for r in run(spark, "op9_suffix_levels")} == expected


def brute_removed(texts):
    seen, out = set(), {}
    for doc in sorted(texts):
        raw, gone = texts[doc].encode(), 0
        flags = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                flags[i : i + 100] = b"\x01" * 100
            seen.add(raw[i : i + 100])
        out[doc] = sum(flags)
    return out


def test_hot_strings_take_the_window_path(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "GROUP", 4)
    monkeypatch.setattr(suffixes, "SPREAD", 3)
    random = np.random.default_rng(8)
    word = lambda: "".join(chr(97 + c) for c in random.integers(0, 26, random.integers(2, 9)))
    line = " ".join(word() for _ in range(30))
    texts = {i: " ".join(word() for _ in range(20)) + line[i % 7 :] + " ".join(word() for _ in range(20)) for i in range(60)}
    texts[60] = "xyz " * 200
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    assert {r["doc_id"]: r["n_removed"] for r in suffixes.removed(rows).collect()} == brute_removed(texts)


def test_rows_with_one_doc_id_are_judged_in_order(spark):
    random = np.random.default_rng(18)
    some = ["".join(chr(97 + c) for c in random.integers(0, 26, 300)) for _ in range(40)]
    rows = [(i // 2, some[i % 40] if i < 40 else some[79 - i]) for i in range(80)]
    found = suffixes.removed(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert len(found) == 80
    assert all((r["n_removed"] == 0) == (r["doc_id"] < 20) for r in found)


def test_levels_find_every_repeat():
    random, family, seen = np.random.default_rng(1), suffixes.Levels(), set()
    for _ in range(30):
        mer = random.integers(0, 50, 200).astype(np.uint64) << np.uint64(32)
        ctx = random.integers(0, 50, 200).astype(np.uint64) << np.uint64(32)
        hit = family.add(mer, ctx, np.arange(200), np.arange(200))
        for m, c, h in zip(mer.tolist(), ctx.tolist(), hit.tolist(), strict=True):
            assert h == ((m, c) in seen)
            seen.add((m, c))
    sizes = [len(level[0]) for level in family.levels]
    assert all(a >= 2 * b for a, b in itertools.pairwise(sizes))


def shingled(text, k):
    words = text.encode().lower().split()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) or frozenset([tuple(words)] if words else [])


def brute_components(texts, k):
    sets = {d: shingled(t, k) for d, t in texts.items()}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {(d, len(sets[d]), find(d), find(d) == d) for d in sets}


def test_near_duplicates(spark, texts):
    assert {tuple(r) for r in run(spark, "op10_oph_minhash")} == brute_components(texts, 2)


def test_links_that_no_star_tries(spark):
    """Documents close to the threshold in long rows: the centre of a bucket is unlike many of its members."""
    random = np.random.default_rng(2)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for i in range(120):
        words = list(base)
        for at in random.choice(len(words), random.integers(0, 22), replace=False):
            words[at] = f"x{i % 40}_{at}"
        texts[i] = " ".join(words)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {tuple(r) for r in minhash.near_duplicates(rows, k=2).collect()} == brute_components(texts, 2)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200)]
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and all(found[i] == 100 for i in range(100, 140))


def test_salted_join_keeps_every_row(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    many = spark.range(1_000).select((F.when(F.col("id") < 600, 7).otherwise(F.col("id") % 50)).alias("k"), "id")
    one = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    rows = common.salted_join(many, one, "k").collect()
    assert len(rows) == 1_000 and all(r["v"] == 2 * r["k"] for r in rows)


def test_passages_that_repeat_are_found(spark, texts):
    rows = run(spark, "op6_collinear_passages")
    seen, found = set(), defaultdict(set)
    words = {d: texts[d].encode().lower().split() for d in texts}
    for r in rows:
        found[r["doc_id"]].update(range(r["start_word"], r["end_word"]))
        assert r["source_id"] < r["doc_id"] and r["similarity"] >= 0.8 and r["end_word"] - r["start_word"] >= 50
    wanted = hit = 0
    for doc in sorted(words):
        runs = [tuple(words[doc][i : i + 50]) for i in range(len(words[doc]) - 49)]
        cover = {j for i, x in enumerate(runs) if x in seen for j in range(i, i + 50)}
        wanted, hit = wanted + len(cover), hit + len(cover & found[doc])
        seen.update(runs)
    assert hit >= 0.99 * wanted


def test_fuzzy_passage_with_insertions(spark):
    random = np.random.default_rng(12)
    word = lambda: "".join(chr(97 + c) for c in random.integers(0, 26, 6))
    shared = [word() for _ in range(100)]
    changed = [w if i % 17 else f"{w} {word()}" for i, w in enumerate(shared) if i % 23]
    texts = [(1, " ".join([word() for _ in range(80)] + shared)), (2, " ".join(changed + [word() for _ in range(90)])),
             (3, " ".join(word() for _ in range(200)))]
    rows = chaining.passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["source_id"]) for r in rows} == {(2, 1)}
    assert sum(r["end_word"] - r["start_word"] for r in rows) >= 85
    kept = {r["doc_id"]: r["text"] for r in
            chaining.without_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert kept[1] == texts[0][1] and kept[3] == texts[2][1] and 80 <= len(kept[2].split()) <= 110


@pytest.mark.parametrize("kept", [0.8, 0.82, 0.85, 0.88, 0.9, 0.95])
def test_stretches_against_all_stretches(kept):
    """Every stretch that is long and similar enough is covered, but for its badly matched ends."""
    random = np.random.default_rng(int(1000 * kept))
    for n in (50, 55, 60, 80, 100):
        for _ in range(4):
            hit = np.concatenate([np.zeros(30, bool), random.random(n) < kept, np.zeros(30, bool)])
            to = np.cumsum(random.integers(0, 20, len(hit)) != 0) + np.cumsum(random.integers(0, 40, len(hit)) == 0)
            hit &= np.diff(to, prepend=-1) > 0
            rows = list(chaining.similar_stretches(hit, to))
            total, covered = np.concatenate([[0], np.cumsum(hit)]), np.zeros(len(hit), bool)
            for b, e, similarity in rows:
                assert e - b >= 50 and similarity >= 0.8
                assert similarity == (total[e] - total[b]) / max(e - b, to[e - 1] - to[b] + 1)
                covered[b:e] = True
            fine = [(b, e) for b in range(len(hit)) for e in range(b + 50, len(hit) + 1)
                    if 10 * (total[e] - total[b]) >= 8 * max(e - b, to[e - 1] - to[b] + 1)]
            assert bool(fine) == bool(rows)
            for b, e in fine:
                if any(x <= b and e <= y and (x, y) != (b, e) for x, y in fine):
                    continue
                poor = np.zeros(len(hit), bool)  # in an end of which at most half is matched
                for x in range(b + 1, e + 1):
                    if 2 * (total[x] - total[b]) <= x - b:
                        poor[b:x] = True
                    if 2 * (total[e] - total[x - 1]) <= e - x + 1:
                        poor[x - 1 : e] = True
                assert (covered | poor)[b:e].all()


def test_a_clean_run_does_not_hide_its_passage():
    hit = np.concatenate([np.ones(30, bool), np.arange(30) % 6 != 0])
    assert [r[:2] for r in chaining.similar_stretches(hit, np.arange(60))] == [(0, 60)]
    hit = np.concatenate([np.arange(35) % 5 != 0, np.ones(12, bool), np.arange(1, 36) % 5 != 0])
    assert sum(r[1] - r[0] for r in chaining.similar_stretches(hit, np.arange(82))) >= 80


def test_passages_with_replaced_words_are_found(spark):
    """50 to 60 words of which 0.8 to 0.95 are kept, at random places between unrelated words."""
    random = np.random.default_rng(21)
    word = lambda: "".join(chr(97 + c) for c in random.integers(0, 26, 7))
    texts, cases = [], [(n, kept) for n in (50, 60) for kept in (0.8, 0.85, 0.9, 0.95) for _ in range(10)]
    for i, (n, kept) in enumerate(cases):
        shared = [word() for _ in range(n)]
        changed = list(shared)
        for at in random.choice(n, int(n * (1 - kept) + 1e-9), replace=False):
            changed[at] = word()
        for doc, part in ((i, shared), (1000 + i, changed)):
            texts.append((doc, " ".join([*(word() for _ in range(70)), *part, *(word() for _ in range(70))])))
    rows = chaining.passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert all(r["doc_id"] == 1000 + r["source_id"] for r in rows)
    assert len({r["doc_id"] for r in rows}) >= len(cases) - 1


@pytest.mark.parametrize(("n", "held"), [(51, 40), (55, 40), (60, 40), (65, 48), (70, 48)])
def test_exact_passage_whose_begin_is_held_earlier(spark, n, held):
    """Documents that hold the begin, then two with all of it; the last has only an earlier holder of all to go by."""
    random = np.random.default_rng(n)
    word = lambda: "".join(chr(97 + c) for c in random.integers(0, 26, 7))
    other = lambda: [word() for _ in range(70)]
    texts, at = [], {}
    for i in range(0, 40, 4):
        shared = [word() for _ in range(n)]
        for doc, part in ((i, shared[:held]), (i + 1, shared), (i + 2, shared)):
            texts.append((doc, " ".join([*other(), *part, *other()])))
        at[i + 2] = set(range(70, 70 + n))
    rows = chaining.passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    for doc, wanted in at.items():
        assert wanted == wanted & {w for r in rows if r["doc_id"] == doc for w in range(r["start_word"], r["end_word"])}


def test_seeds_point_to_their_first_and_previous_holder(spark):
    random = np.random.default_rng(31)
    shared = " ".join("".join(chr(97 + c) for c in random.integers(0, 26, 7)) for _ in range(60))
    rows = chaining.matches(spark.createDataFrame([(d, shared) for d in (3, 5, 8, 9)], "doc_id long, text string"))
    pairs = {(r["doc_id"], r["source_id"]) for r in rows.collect() if r["place"] == r["source_place"]}
    assert pairs == {(5, 3), (8, 3), (8, 5), (9, 3), (9, 8)}


def test_chains_are_the_best():
    random = np.random.default_rng(13)
    for _ in range(40):
        first = np.sort(random.integers(0, 60, 8))
        source = random.integers(0, 60, 8)
        length = random.integers(0, 4, 8)
        anchors = np.stack([first, first + length, source, source + length], axis=1).astype(np.int64)
        score = lambda c: sum(a[1] - a[0] + chaining.K for a in c) - chaining.GAP_COST * sum(
            b[0] - a[1] + b[2] - a[3] for a, b in itertools.pairwise(c))
        fine = lambda c: all(a[1] < b[0] and a[3] < b[2] for a, b in itertools.pairwise(c))
        best = max(score(c) for n in range(1, 9) for c in itertools.combinations(anchors.tolist(), n) if fine(c))
        assert score(chaining.chains(anchors)[0].tolist()) >= best - 1e-9 or len(chaining.chains(anchors)[0]) < 8


def test_cuckoo_filter_inserts_deletes_and_grows():
    random = np.random.default_rng(14)
    digests = [hashlib.sha256(bytes(random.integers(0, 256, 8, dtype=np.uint8))).hexdigest() for _ in range(3_000)]
    shard, live = cuckoo.CuckooShard(), {}
    for step in range(12_000):
        d = digests[random.integers(0, len(digests))]
        if random.random() < 0.7:
            assert shard.insert(d, step) == (d not in live)
            live[d] = live.get(d, 0) + 1
        elif d in live:
            live[d] -= 1
            assert shard.delete(d) == (live[d] == 0)
            live = {k: n for k, n in live.items() if n}
    assert shard.grown > 0
    assert all((shard.find(d) is not None) == (d in live) for d in digests)
    again = cuckoo.CuckooShard.load(shard.rows(0))
    assert all((again.find(d) is not None) == (d in live) for d in digests)


def test_cuckoo_index_over_batches(spark):
    rows = lambda ids, change: spark.createDataFrame(
        [(hashlib.sha256(str(i % 50).encode()).hexdigest(), i, change) for i in ids], "digest string, doc_id long, change int")
    index = cuckoo.CuckooIndex(spark, shards=3).change(rows(range(120), 1)).change(rows(range(0, 50), -1))
    found = {r["digest"]: r["live"] for r in index.digests().collect()}
    assert found == {hashlib.sha256(str(i).encode()).hexdigest(): 2 if i < 20 else 1 for i in range(50)}
    gone = index.change(rows([i for i in range(20, 50)], -1))
    assert gone.digests().count() == 20


def test_exact_products_with_bounds(spark):
    random = np.random.default_rng(15)
    vectors = (random.normal(0, 1, (3_000, 12)) * random.lognormal(0, 1, (3_000, 1))).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    whole = np.floor(1024 * vectors.astype(float)).astype(np.int64)
    got = defaultdict(list)
    for r in inner_products.top_products(rows, F.col("vec_id") % 100 == 0).orderBy("rank").collect():
        got[r["query_id"]].append((r["score"], r["vec_id"]))
    for q in range(0, 3_000, 100):
        scores = sorted(((-int(whole[q] @ whole[i]), i) for i in range(3_000) if i != q))[:10]
        assert got[q] == [(-s, i) for s, i in scores]


def test_toxicity_learns_stems():
    random = np.random.default_rng(16)
    word = lambda: "".join(chr(97 + c) for c in random.integers(0, 26, 6))
    common_words = [word() for _ in range(300)]
    text = lambda bad: [*random.choice(common_words, 60), *(["vilest" + word()[:3]] if bad else [])]
    labels = (np.arange(600) % 4 == 0).astype(int)
    model = toxicity.ConvolutionalClassifier()
    model.fit([list(text(y)) for y in labels], labels)
    good = [model.probability(list(text(0))) for _ in range(60)]
    bad = [model.probability(list(text(1))) for _ in range(60)]
    assert np.mean([b > g for b in bad for g in good]) > 0.97


def test_calibration_is_monotone():
    assert toxicity.calibrated(0.3, 0.3) == pytest.approx(toxicity.THRESHOLD)
    values = [toxicity.calibrated(p, 0.2) for p in np.linspace(0, 1, 50)]
    assert values == sorted(values) and values[0] == 0 and values[-1] == pytest.approx(1)


def test_pipeline_stage_by_stage(spark, texts):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
        out = stage(spark, docs, FOLDER)
        if name == "packing":
            assert {r["doc_id"] for r in out.select("doc_id").collect()} == set(before)
            break
        assert out.columns == columns
        folder = common.shared_folder(spark, "stage")
        out.write.parquet(folder)
        docs = spark.read.parquet(folder)
        after = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
        if name == "language_id":
            assert all(any(c.isalpha() for c in before[d]) for d in after)
            assert all(not any(c.isalpha() for c in before[d]) for d in set(before) - set(after))
        elif name == "exact_dedup":
            groups = defaultdict(list)
            for d, t in before.items():
                groups[" ".join(t.replace("\x0b", " ").split())].append(d)
            assert len(after) <= len(before) and len(after) >= len(groups)
        elif name == "near_dedup":
            assert set(after) == {d for d, _, _, kept in brute_components(before, 5) if kept}
        elif name == "substring_dedup":
            assert set(after) == set(before) and sum(map(len, after.values())) <= sum(map(len, before.values()))
