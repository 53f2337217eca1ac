"""Training-data operators on small fixtures: nulls, empty and long texts, ties, repeats, empty tables, clashing names."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from filmweave.llm import components, decontam, exact, licenses, mixing, quality, queries, sharding, simhash, templates, toxicity, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row int, size int, key string, digest string, fp string"


def docs_of(spark, rows):
    """Documents from (doc_id, text, source), with columns whose names the operators use themselves."""
    full = [(i, t, "en", s, len(t or ""), 7, 8, "k", "d", "f") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    words = random.Random(3)
    prose = [" ".join(words.choices("of the and thing reading only other than with house".split(), k=30)) + "." for _ in range(60)]
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(prose)]
    rows += [(100, None, None), (101, "", "s0"), (102, None, "s1"), (None, "Lone text without id", "s2"), (103, "long " * 60000, "s0")]
    rows += [(5, prose[5], "s2"), (5, prose[5], "s2"), (104, prose[5].upper(), "s1"), (105, prose[5], "s0")]
    return docs_of(spark, rows).cache()


LABELS = "doc_id long, quality int, toxic int"


def test_quality_keeps_rows_and_columns(spark, odd):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(None, None, None)], LABELS)
    kept = quality.classify(odd, labels).collect()
    assert len(kept) == odd.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in kept)
    assert quality.keep_good(odd, labels).columns == odd.columns
    none = quality.classify(odd.limit(0), labels.limit(0))
    assert none.count() == 0 and none.columns == ["doc_id", "held_out", "score", "predicted"]


def test_quality_prior_and_separation():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(1, 0.5, (600, quality.N_FEATURES)), rng.normal(-1, 0.5, (600, quality.N_FEATURES))
    model = quality.fit_pu(good[:200], np.vstack([good[200:], bad[:200]]))
    assert abs(model.prior - 2 / 3) < 0.12
    assert (model.score(good) > 0.5).mean() > 0.98 and (model.score(bad[200:]) < 0.5).mean() > 0.98


def test_held_out_follows_crc32(spark):
    rows = spark.range(50).select("id", quality.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)


def test_toxicity_tolerates_gaps(spark):
    words = random.Random(4)
    clean = ["".join(words.choices("abcdeghilnorstu", k=words.randint(3, 9))) for _ in range(400)]
    rows, labels = [], []
    for i in range(400):
        text = words.choices(clean, k=40)
        if i % 4 == 0:
            text[words.randrange(40)] = words.choice(["scoundrel", "blockhead", "knucklehead"])
        rows.append((i, " ".join(text) + ".", "s"))
        labels.append((i, 1, int(i % 4 == 0)))
    documents = docs_of(spark, [*rows, (900, None, "s"), (901, "", "s")])
    labels = spark.createDataFrame(labels, LABELS)
    model = toxicity.train(documents, labels)
    held = toxicity.score(documents, model).join(labels, "doc_id").where(quality.held_out(F.col("doc_id"))).select("score", "toxic").collect()
    assert np.mean([(r["score"] >= 0.5) == (r["toxic"] == 1) for r in held]) >= 0.95
    odd = ["you block*head", "b l o c k h e a d", "scoun-drel here", None, "", "the house"]
    assert list(model.score(pa.array([t or "" for t in odd], pa.large_string())) >= 0.5) == [True, True, True, False, False, False]
    assert toxicity.worst_sentences(docs_of(spark, [(1, "Fine here. You scoundrel! Well.", "s")]), model).count() == 1
    empty = toxicity.classify(documents.limit(0), labels.limit(0))
    assert empty.count() == 0
    assert {r["score"] < 0.5 for r in toxicity.classify(documents, labels.limit(0)).collect()} == {True}


def brute_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_decontamination_against_brute_force(spark):
    words = random.Random(6)
    pool = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(words.choices(pool, k=words.randint(10, 30)))) for i in range(40)] + [(90, None), (91, ""), (92, "..."), (93, "w1")]
    rows = []
    for i in range(150):
        text = words.choices(pool, k=60)
        if i % 3 == 0:
            leak = items[i % 40][1].split()
            for _ in range(words.randint(0, int(0.2 * len(leak)))):
                leak[words.randrange(len(leak))] = words.choice(["x,", "Y", "z!"])
            text[20:20] = leak
        rows.append((i, " ".join(text).upper(), "s"))
    documents = docs_of(spark, [*rows, (500, None, "s"), (501, "", "s"), (502, rows[0][1], "s")])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(documents, benchmark).collect()}
    expected = set()
    for doc, text, _ in [*rows, (502, rows[0][1], "s")]:
        have = decontam.item_words(text)
        for item, wanted in items:
            want = decontam.item_words(wanted)
            n = len(want)
            if n and any(brute_edits(have[s : s + n], want) <= decontam.allowed(n) for s in range(len(have) - n + 1)):
                expected.add((doc, item))
    assert found <= expected and len(found) >= 0.95 * len(expected)
    exact_leaks = {(d, i) for d, t, _ in rows for i, w in items if w and len(w) > 5 and f" {w.upper()} " in f" {t} "}
    assert exact_leaks <= found
    kept = decontam.without_leaks(documents, benchmark)
    assert kept.columns == documents.columns
    assert {r["doc_id"] for r in kept.collect()} == ({r[0] for r in rows} | {500, 501, 502}) - {d for d, _ in found}
    assert decontam.leaks(documents, benchmark.limit(0)).count() == 0 == decontam.leaks(documents.limit(0), benchmark).count()


def test_templates_drop_recurring_lines(spark):
    shared = "User 17 logged in from the main office today"
    rows = [(i, f"Own line number {'abcdefghij'[i]} {'klmnopqrst'[i]} x\n\n{shared.replace('17', str(i))}\nend {i}{i}{i} of {'uvwxyzabcd'[i]}", "s") for i in range(10)]
    documents = docs_of(spark, [*rows, (50, None, "s"), (51, "", "s"), (51, "", "s"), (52, "word " * 30000, "s")])
    out = {(r["doc_id"]): r for r in templates.drop_recurring(documents).collect()}
    assert all("logged in" not in out[i]["text"] and out[i]["lines_dropped"] >= 1 for i in range(10))
    assert all(f"{'abcdefghij'[i]} {'klmnopqrst'[i]} x\n\n" in out[i]["text"] for i in range(10))
    assert out[50]["text"] is None and out[51]["text"] == "" and out[52]["lines_dropped"] == 0
    assert templates.drop_recurring(documents).count() == 14 and templates.drop_recurring(documents.limit(0)).count() == 0


def test_shards_are_even_and_mixed(spark, odd):
    rows = [(i, "é" * (i % 7), f"s{i % 4 % 3}") for i in range(1003)] + [(None, None, None)] * 3
    out = sharding.assign(docs_of(spark, rows), 10).collect()
    counts = [sum(r["shard"] == s for r in out) for s in range(10)]
    assert sum(counts) == 1006 and max(counts) - min(counts) <= 1
    assert all(sorted(r["slot"] for r in out if r["shard"] == s) == list(range(counts[s])) for s in range(10))
    for s in range(10):
        assert abs(sum(r["shard"] == s and r["doc_id"] is not None and r["doc_id"] % 4 % 3 == 0 for r in out) - 50) <= 2
    assert all(r["size"] == 2 * ((r["doc_id"] or 0) % 7) + 16 for r in out)
    whole = sharding.sharded(odd, 4)
    assert whole.columns == [*odd.columns, "shard", "slot"] and whole.count() == odd.count()
    assert sharding.assign(odd.limit(0)).count() == 0


def test_shards_do_not_depend_on_the_layout(spark):
    rng = random.Random(1)
    rows = [(i, f"text {i % 900}", f"s{i % 3}") for i in range(1000)] + [(7, "same", "s0")] * 300 + [(None, None, None)] * 20
    rng.shuffle(rows)
    docs = docs_of(spark, rows)
    placed = [sorted(map(str, sharding.assign(docs.repartition(n), 10).drop("_row").collect())) for n in (3, 7)]
    assert placed[0] == placed[1] and len(placed[0]) == 1320
    same = [sum("Row(doc_id=7, size=20" in r and f"shard={s}," in r for r in placed[0]) for s in range(10)]
    assert sum(same) == 300 and min(same) > 15  # copies are spread like other rows


def test_shards_against_a_plain_interleaving(spark):
    """Of the sources only the order of fractions matters: each shard's mixture is that of sorting all rows by them."""
    counts = {"a": 700, "b": 200, None: 99, "c": 1}
    rows = [(i * 10 + k, f"t{i}", s) for k, (s, n) in enumerate(counts.items()) for i in range(n)]
    out = sharding.assign(docs_of(spark, rows), 8).join(docs_of(spark, rows).select("doc_id", "source"), "doc_id").collect()
    order = sorted((2 * r + 1) / (2 * n) for n in counts.values() for r in range(n))
    ends = [order[-(-len(order) * (s + 1) // 8) - 1] for s in range(8)]
    for shard in range(8):
        for source, n in counts.items():
            low = ends[shard - 1] if shard else -1
            have = sum(r["shard"] == shard and r["source"] == source for r in out)
            want = sum(low < (2 * r + 1) / (2 * n) <= ends[shard] for r in range(n))
            assert abs(have - want) <= 1


def test_warc_pages_of_many_megabytes(spark):
    pages = spark.createDataFrame([(1, "u", "é" * 6_000_000), (2, "u", "x" * 3_000_000)], "page_id long, url string, html string")
    out = {r["page_id"]: r["payload_bytes"] for r in warc.round_trip(pages).collect()}
    assert out == {1: 12_000_000, 2: 3_000_000}


def test_mix_meets_targets(spark, odd):
    rows = [(i, " ".join(["w"] * (i % 9)), ["a", "b", None][i % 3]) for i in range(3000)]
    out = mixing.mix(docs_of(spark, rows), columns=["doc_id", "source"]).collect()
    taken = {s: sum(r["_size"] * r["_times"] for r in out if r["source"] == s) for s in ("a", "b", None)}
    total = sum(i % 9 for i in range(3000))
    for s, share in (("a", 5 / 8), ("b", 2 / 8), (None, 1 / 8)):
        assert abs(taken[s] - share * total) <= 8
    assert max(r["_times"] for r in out) <= 3
    assert mixing.mixed(odd).columns == odd.columns
    assert mixing.mixed(odd.limit(0)).count() == 0


def test_warc_round_trip(spark):
    rows = [(1, "u", "héé" * 20000), (2, "u\n", "héé" * 20000), (3, None, None), (4, "u", ""), (9, "u", "WARC/1.1\r\n\r\nx"), (5, "u", "a"), (5, "u", "a"), (None, "u", "b")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, row int")
    out = {(r["page_id"], r["record_type"]): r for r in warc.round_trip(pages).collect()}
    for page, _, html in rows:
        payload = (html or "").encode()
        first = min((p or -1) for p, _, h in rows if (h or "").encode() == payload)
        row = out[page, "response" if page is None or page == first else "revisit"]
        assert row["payload_bytes"] == len(payload)
        assert row["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert row["refers_to"] == (None if row["record_type"] == "response" else first)
    assert (5, "response") in out and (5, "revisit") in out
    assert warc.round_trip(pages.limit(0)).count() == 0
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")
    assert warc.unchunked(warc.chunked(b"x" * 9999)) == b"x" * 9999


def test_warc_lost_segment_raises(spark):
    parts = warc.records("urn:page:1:0", "u", b"y" * 50000, "D", None)
    found = spark.createDataFrame([tuple(r.values()) for i, p in enumerate(parts) if i != 1 for r in warc.parse(p + b"\r\n\r\n")], warc.RECORD)
    with pytest.raises(Exception, match="segments"):
        warc.reassembled(found).collect()


def brute_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_fingerprints_and_components(spark, odd):
    out = simhash.near_duplicates(odd).select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fp"), "component_id").collect()
    assert len(out) == odd.count()
    texts = [(r["doc_id"], f"{brute_fingerprint(r['text']):016x}") for r in odd.collect()]
    assert sorted(map(str, texts)) == sorted(str((r["doc_id"], r["fp"])) for r in out)
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns and kept.count() == len({r["component_id"] for r in out})


def test_links_in_large_buckets_are_complete(spark):
    rng = random.Random(8)
    base, points = rng.getrandbits(64), set()
    while len(points) < 600:
        x = base
        for bit in rng.sample(range(20), rng.randint(0, 6)):
            x ^= 1 << bit
        points.add(x)
    points = list(points) + [rng.getrandbits(64) for _ in range(200)]
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    roots = dict(map(tuple, components.components(simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"))).collect()))
    parent = {p: p for p in signed}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(points):
        for j in range(i):
            if (a ^ points[j]).bit_count() <= 2:
                parent[top(signed[i])] = top(signed[j])
    groups = {}
    for p in signed:
        groups.setdefault(top(p), set()).add(roots.get(p, p))
    assert all(len(g) == 1 for g in groups.values()) and len(set().union(*groups.values())) == len(groups)


def test_masks_cover_every_pair_of_bits():
    kept = simhash.masks()
    assert all(any(not m >> a & 1 and not m >> b & 1 for m in kept) for a in range(64) for b in range(64))


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 300)], "a long, b long")
    roots = [r["root"] for r in components.components(edges).collect()]
    assert len(roots) == 601 and len(set(roots)) == 2


def test_licenses(spark):
    rows = [(1, "Intro\nReleased under the MIT License.\nx", "s"), (2, "Licensed under CC BY-NC 4.0.", "s"), (3, "All rights reserved.", "s"), (4, None, "s"), (5, "", "s")]
    rows += [(6, "The general public work of version 3", "s"), (6, "Licensed under the Apache License, Version 2.0.", "s"), (None, "Licensed under the MIT License", "s")]
    out = {(r["doc_id"], r["license"]) for r in licenses.scan(docs_of(spark, rows)).collect()}
    assert out == {(1, "mit"), (2, "cc-by-nc-4.0"), (3, "none"), (4, "none"), (5, "none"), (6, "apache-2.0"), (None, "mit")}
    assert licenses.scan(docs_of(spark, rows).limit(0)).count() == 0


def test_exact_dedup_and_later_batches(spark, odd, tmp_path):
    out = exact.deduplicate(odd).collect()
    texts = [(r["doc_id"], (r["text"] or "")) for r in odd.collect()]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = {}
    for i, t in texts:
        groups.setdefault(hashlib.sha256(t.translate(lower).encode()).hexdigest(), []).append(i)
    for r in out:
        group = groups[r["digest"]]
        best = max((i for i in group if i is not None), default=None)
        assert (r["keep_id"], r["group_size"], r["kept"]) == (best, len(group), r["doc_id"] == best)
    index = exact.DigestIndex(spark, f"file://{tmp_path}/index", 4)
    index.add(odd, 0).count()
    again = exact.DigestIndex(spark, f"file://{tmp_path}/index", 4)
    later = again.add(docs_of(spark, [(900, texts[7][1], "s"), (901, "new text", "s"), (902, "NEW text", "s")]), 1).collect()
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in later} == {(900, 7, False), (901, 902, False), (902, 902, True)}
    assert exact.deduplicate(odd.limit(0)).count() == 0


def test_queries_match_sql(spark):
    import __spark_entry__ as entry

    from ..compare import difference, oracle

    sf = "/root/testdata/sf0.001"
    sql, queries = entry.oracle_sql(), entry.queries()
    db = oracle(sf)
    for name in queries:
        if name.startswith("op") and name in sql:
            assert difference(spark, db, sf, queries[name], sql[name]) is None


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, sf)
        out.write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns[: len(before.columns)] == before.columns and docs.count() > 0
    shards = [r["n"] for r in docs.groupBy("shard").agg(F.count("*").alias("n")).collect()]
    assert max(shards) - min(shards) <= 1


def test_template_tokens(spark):
    lines = ["a b1  c", "x y", "\t", "", " lead 7 ", "no digits at all"]
    rows = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, line string")
    got = [r["t"] for r in rows.orderBy("i").select(templates.tokens(F.col("line")).alias("t")).collect()]
    assert got == [[templates.WILDCARD if any(c.isdigit() for c in t) else t for t in line.split()] for line in lines]


@pytest.mark.parametrize("name", ["op4_shard_interleaved", "op5_mix_thresholds", "op9_license_ngrams"])
def test_native_plans_have_no_python(spark, name):
    text = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not [w for w in ("EvalPython", "MapInPandas", "MapInArrow", "CartesianProduct", "Cross") if w in text]


def test_pipeline_keeps_one_of_each_fingerprint_component(spark):
    import corpus_pipeline

    words = random.Random(8)
    pool = [f"w{i}" for i in range(3000)]
    texts = [" ".join(words.choices(pool, k=200)) for _ in range(60)]
    base = words.choices(pool, k=2000)  # a long text with one word changed: few of its bits change
    for i in range(40):
        copy = list(base)
        copy[words.randrange(2000)] = f"other{i}"
        texts.append(" ".join(copy))
    rows = [(i, t, "s") for i, t in enumerate([*texts, *texts[:30], texts[0].upper()])]
    prints = {i: brute_fingerprint(t) for i, t, _ in rows}
    top = {i: i for i in prints}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in prints:
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2 and root(i) != root(j):
                a, b = sorted((root(i), root(j)))
                top[b] = a
    kept = corpus_pipeline.without_near_duplicates(spark, docs_of(spark, rows), "")
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids == {root(i) for i in prints} and len(ids) < 90


CLASHING = ("_row", "_size", "_times", "_copy", "_id", "_gone", "_left", "_marks", "_quality", "shard", "slot", "row", "fp", "whole", "score")


def test_columns_of_any_name_keep_their_values(spark):
    words = random.Random(2)
    pool = "of the and thing reading only other than with house".split()
    rows = [(i, " ".join(words.choices(pool, k=30)) + ".", "en", f"s{i % 3}", i) for i in range(40)]
    rows += [(40 + i, rows[i][1], "en", "s1", i) for i in range(5)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in CLASHING:
        documents = documents.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], LABELS)

    def check(out, but=()):
        assert [c for c in out.columns if c in documents.columns] == [c for c in documents.columns if c not in but] + list(but)
        got = out.collect()
        assert got and all(r[c] == f"{c}{r['doc_id']}" for r in got for c in CLASHING if c not in but)
        return got

    check(quality.keep_good(documents, labels))
    assert len(check(simhash.keep_first(documents))) == 40
    check(mixing.mixed(documents))
    assert sorted(r["slot"] for r in check(sharding.sharded(documents, 1), ("shard", "slot"))) == list(range(45))
    assert len(templates.drop_recurring(documents).collect()) == 45
    out = templates.drop_recurring(documents).collect()
    assert all(r[c] == f"{c}{r['doc_id']}" for r in out for c in CLASHING)
    benchmark = spark.createDataFrame([(1, rows[3][1])], "item_id long, text string")
    check(decontam.without_leaks(documents, benchmark))


def test_a_batch_that_is_added_again_gets_the_same_answers(spark, odd, tmp_path):
    index = exact.DigestIndex(spark, f"file://{tmp_path}/retried", 4)
    first = sorted(map(str, index.add(odd, 0).collect()))
    size = index.table().count()
    again = exact.DigestIndex(spark, f"file://{tmp_path}/retried", 4)
    assert sorted(map(str, again.add(odd, 0).collect())) == first and again.table().count() == size


def test_decontamination_with_insertions_deletions_and_short_documents(spark):
    words = random.Random(16)
    pool = [f"w{i}" for i in range(300)]
    items = [(i if i else None, " ".join(words.choices(pool, k=words.randint(20, 60)))) for i in range(30)]
    rows, planted = [], set()
    for i in range(300):
        item, leak = items[i % 30][0], items[i % 30][1].split()
        kind = i // 30 % 5  # deletions, insertions, both, the same alone as a document, the ends cut off a document
        for j in range(words.randint(1, decontam.allowed(len(leak)))):
            if kind == 4:
                leak = leak[1:] if i % 2 else leak[:-1]
            elif kind == 0 or (kind > 1 and j % 2):
                leak.pop(words.randrange(len(leak)))
            else:
                leak.insert(words.randrange(len(leak)), "new")
        text = leak if kind > 2 else [*words.choices(pool, k=40), *leak, *words.choices(pool, k=40)]
        rows.append((i, " ".join(text), "s"))
        planted.add((i, item))
    rows += [(400 + i, " ".join(words.choices(pool, k=30)), "s") for i in range(50)]
    documents, benchmark = docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontam.leaks(documents, benchmark).collect()}
    assert set(found) <= planted and len(found) >= 0.97 * len(planted)
    for (doc, item), edits in list(found.items())[:60]:
        have, want = rows[doc][1].split(), dict(items)[item].split()
        k = decontam.allowed(len(want))
        parts = (have[s : s + n] for s in range(len(have)) for n in range(len(want) - k, len(want) + k + 1))
        assert edits == min(brute_edits(want, part) for part in parts if len(part) >= len(want) - k)
    passage = " ".join(items[3][1].split()[:-1])
    assert [r["item_id"] for r in decontam.leaks(docs_of(spark, [(1, passage, "s")]), benchmark).collect()] == [3]
    assert {r["doc_id"] for r in decontam.without_leaks(documents, benchmark).collect()} == {r[0] for r in rows} - {d for d, _ in found}


def left_of(spark, texts):
    """Lines that stay of documents of these texts."""
    documents = docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)])
    return {r["doc_id"]: r["text"] for r in templates.drop_recurring(documents).collect()}


def test_copies_of_a_document_keep_its_lines(spark):
    own = "\n".join(" ".join(f"{'abcdefghij'[i]}{'klmnopqrst'[j]}own" for j in range(10)) * 3 for i in range(4))
    out = left_of(spark, [own] * 12 + ["other text alone"])
    assert all(out[i] == own for i in range(12))


def test_the_longer_a_line_the_fewer_documents_it_needs(spark):
    line = lambda n: " ".join(f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(n))
    for size, need in ((19, 5), (20, 5), (25, 4), (40, 3), (50, 2)):
        name = lambda i: "".join("abcdefghij"[int(d)] for d in str(i))
        for documents in (need - 1, need):
            out = left_of(spark, [f"own {name(i + 10 * size)} part\n{line(size)}" for i in range(documents)])
            assert all((line(size) in t) == (documents < need) for t in out.values())


def test_long_lines_recur_from_two_documents_on(spark):
    passage = " ".join(f"word{'abcdefghij'[i % 10]}{'klmnop'[i // 10]}" for i in range(55))
    short = "a short line of seven words only"
    out = left_of(spark, [f"own one\n{passage}\n{short}", f"other two\n{passage}\n{short}", f"{passage} more"])
    assert out == {0: f"own one\n{short}", 1: f"other two\n{short}", 2: f"{passage} more"}


@pytest.mark.parametrize("count", [40, 4000])
def test_fields_of_words_stay_fields_at_every_size(spark, count):
    name = lambda i: "".join("abcdefghij"[int(d)] for d in str(i))
    lines = [f"Report sent to the office by N{name(i % 50)} from C{name(i * 7 % 53)} this morning early today" for i in range(count)]
    out = left_of(spark, [f"own {name(i)}\n{line}" for i, line in enumerate(lines)])
    assert out == {i: f"own {name(i)}" for i in range(count)}


def test_lines_of_digits_recur(spark):
    same = ["Page 3 of 10", "12 May 2020 10:33 Posted", "10 20 30"]
    out = left_of(spark, ["\n".join([*same, f"Page {i} of {i + 7}", f"{i} {i} {i} alone"]) for i in range(6)])
    assert out == {i: f"{i} {i} {i} alone" for i in range(6)}
    assert left_of(spark, same * 4) == {i: same[i % 3] for i in range(12)}
