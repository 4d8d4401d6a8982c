"""Operators against brute force on the smallest tables, and on rows with every kind of defect."""

from __future__ import annotations

import itertools
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import check
import corpus_pipeline
from daystrata.llm import (
    decontaminate,
    exact_dedup,
    hashed,
    license_scan,
    mixing,
    near_dedup,
    pii,
    quality,
    queries,
    sql,
    substring_dedup,
    token_counts,
    toxicity,
)
from daystrata.llm.components import components

BPE = public_tokenizers.path("byte_bpe_50k.json")
LONG = "long " + "x" * 70_000 + " " + "many words of a kind " * 8_000
SCHEMA = "doc_id long, text string, lang string, source string, keep_id string, n_words string, size int, score string, found int"
PASSAGE = " ".join(f"word{i}" for i in range(60))
ROWS = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one"),
    (5, LONG),
    (6, PASSAGE),
    (7, PASSAGE + " and an end of its own"),
    (7, "another text under the same id"),
    (8, PASSAGE),
    (8, PASSAGE),
    (None, PASSAGE),
    (None, "Released under the MIT License. mail a@b.co now +1 (988) 555-2485"),
    (9, "Licensed under the Apache License, Version 2.0. card 4111 1111 1111 1111 at 10.0.0.1"),
]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def db(sf_dir):
    return check.database(sf_dir)


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None, None if i is None else f"s{i % 2}", "a", "b", 1, "c", 2) for i, t in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(sql.all_sql()))
def test_query_equals_sql(spark, db, sf_dir, name):
    df = queries.all_queries()[name](spark, sf_dir)
    found = check.table(df.columns, df.collect())
    result = db.execute(sql.all_sql()[name])
    assert found == check.table([c[0] for c in result.description], result.fetchall())
    assert found


# exact dedup


def test_exact_dedup_when_digests_collide(docs):
    plain = exact_dedup.exact_dedup(docs).drop("locator")
    weak = exact_dedup.exact_dedup(docs, digest=lambda t: F.unhex(F.lpad(F.hex(F.length(t) % 5), 4, "0"))).drop("locator")
    shuffled = exact_dedup.exact_dedup(docs, broadcast_digests=0).drop("locator")
    assert sorted(plain.collect()) == sorted(weak.collect()) == sorted(shuffled.collect())


def test_digest_state_takes_new_files_only(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id long, text string")
    staged = frame.select("id", exact_dedup.sha256(F.col("text")).alias("digest"), F.lit("here").alias("locator"))
    path, state = str(tmp_path / "digests"), str(tmp_path / "state")
    staged.write.parquet(path)
    exact_dedup.fold_digests(spark, path, state)
    staged.filter("id = 2").withColumn("id", F.lit(9).cast("long")).write.mode("append").parquet(path)
    found = exact_dedup.fold_digests(spark, path, state)
    assert sorted((r["keep_id"], r["n"]) for r in found.collect()) == [(3, 2), (9, 2)]


def test_exact_dedup_of_odd_rows(odd, nothing):
    found = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(odd).collect())
    assert found[(1, 2, 2, False)] == found[(2, 2, 2, True)] == 1
    assert found[(8, 8, 4, True)] == 2
    assert found[(None, 8, 4, False)] == found[(6, 8, 4, False)] == 1
    assert sum(found.values()) == len(ROWS)
    assert exact_dedup.exact_dedup(nothing).count() == 0


# near dedup


def test_near_dedup_of_odd_rows(odd, nothing):
    found = near_dedup.near_duplicates(odd).collect()
    assert len(found) == len(ROWS)
    by_id = {(r["doc_id"], r["n_shingles"]): r for r in found}
    assert by_id[(1, 0)]["component_id"] == 1 and by_id[(1, 0)]["kept"]
    assert by_id[(4, 1)]["component_id"] == 4
    # 56 of 62 shingles are common.
    assert by_id[(6, 56)]["component_id"] == by_id[(7, 62)]["component_id"] == by_id[(8, 56)]["component_id"] == 6
    assert by_id[(None, 56)]["component_id"] is None and by_id[(None, 56)]["kept"]
    assert near_dedup.near_duplicates(nothing).count() == 0


def test_links_across_a_large_band(spark):
    """A chain whose ends are not alike, in one band with texts that are alike to none."""
    words = [f"w{i}" for i in range(200)]
    chain = [" ".join(words[: 180 - 12 * i] + [f"c{i}x{j}" for j in range(20 + 12 * i)]) for i in range(5)]
    near = [" ".join(words[:190] + [f"n{i}"]) for i in range(40)]
    rows = [(i, t) for i, t in enumerate(chain + near)]
    signer = near_dedup.Signer(words=3, bands=60, rows=2)
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), signer=signer)
    sets = {i: {tuple(t.split()[k : k + 3]) for k in range(len(t.split()) - 2)} for i, t in rows}
    linked = [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == _components(sets, linked)


def _components(nodes, links):
    label = {n: n for n in nodes}
    for _ in nodes:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 103), (103, 101), (200, 200), (7, 3), (3, 7)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "left long, right long")).collect()}
    expected = _components({n for pair in links for n in pair}, links)
    assert found == {n: c for n, c in expected.items() if n != 200}


@pytest.mark.parametrize("size", [30, 150, 3_000, 20_000])
def test_odd_sketches_tell_pairs_apart(spark, size):
    """Pairs at the threshold stay, clearly less similar ones go."""
    signer = near_dedup.Signer()
    random = np.random.default_rng(size)
    bound = spark.range(1).select(signer.most_bits(F.lit(2 * size), 80)).first()[0]

    def differing(similarity):
        common = round(2 * size * similarity / (1 + similarity))
        both = random.integers(0, 2**64, 2 * size - common, np.uint64)
        left, right = signer.sketch(np.sort(both[:size])), signer.sketch(np.sort(both[size - common :]))
        return sum(int(x).bit_count() for x in (left ^ right).view(np.uint64))

    assert all(differing(0.8) <= bound for _ in range(50))
    assert size == 20_000 or all(differing(0.5) > bound for _ in range(20))


# token counts


@pytest.mark.parametrize("chunk, overlap, huge", [(16_384, 512, 32_768), (300, 20, 400), (200, 150, 0)])
def test_token_counts(texts, chunk, overlap, huge):
    whole = Tokenizer.from_file(BPE)
    encoder = token_counts.Encoder(BPE, chunk, overlap, huge)
    odd = ["", " ", "  ", "a  b", "a   b ", " \n x", "x \n\n y", "don't we'll '", "a<|endoftext|>b <|endoftext|>", "é ü  ñ", "1 22  3.5"]
    odd += [LONG, "x" * 3_000, " " * 1_000 + "y", "\n" * 700, "<|endoftext|>" * 200, "it's <|endof" * 300, "ab  " * 500, "é　 a  b " * 200]
    every = list(texts.values()) + odd
    expected = [len(e.ids) for e in whole.encode_batch(every, add_special_tokens=False)]
    assert encoder.counts(every) == expected


def test_token_counts_of_odd_rows(odd, nothing):
    found = token_counts.count_tokens(odd, BPE).collect()
    assert sorted((r["n_bytes"], r["n_tokens"] > 0) for r in found)[:3] == [(0, False), (0, False), (3, True)]
    assert len(found) == len(ROWS) and sum(r["over_limit"] for r in found) == 1
    assert token_counts.count_tokens(nothing, BPE).count() == 0


# license scan and personal data


def test_licenses_of_odd_rows(odd, nothing):
    found = {(r["doc_id"], r["n_words"]): r for r in license_scan.scan_licenses(odd).collect()}
    assert found[(9, 18)]["labels"] == "apache-2" and found[(9, 18)]["first_word"] == 3
    assert found[(None, 14)]["base_labels"] == "mit" and found[(1, 0)]["labels"] == ""
    assert license_scan.scan_licenses(odd).count() == len(ROWS)
    assert license_scan.scan_licenses(nothing).count() == 0


def test_license_blocks(spark):
    lines = ["x\nYou may not use this file in compliance with the License\ny", "may license use", "UNDER THE MIT LICENSE"]
    found = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r["labels"], r["n_base"]) for r in found] == [("apache-2", 0), ("", 0), ("mit", 1)]
    assert 0.8 <= found[0]["score"] < 1


GPL = """\
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or"""
MPL = """\
# This Source Code Form is subject to the terms of the Mozilla Public
# License, v. 2.0. If a copy of the MPL was not distributed with this"""
BSD = """\
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions"""


def test_licenses_wrapped_over_lines(spark):
    scattered = "\n".join(f"{word} " + "x " * 10 for _, t in license_scan.TEMPLATES for word in t.split())
    texts = {
        1: GPL,
        2: "before\n" * 500 + MPL + "\nafter" * 500,
        3: "x\n\n" + BSD.replace("\n", "\r\n"),
        4: scattered,
        5: "x y\n" * 33 + GPL + "\n" + BSD,
    }
    found = {r["doc_id"]: r for r in license_scan.scan_licenses(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert {i: r["labels"] for i, r in found.items()} == {1: "gpl-3", 2: "mpl-2", 3: "bsd", 4: "", 5: "bsd,gpl-3"}
    assert [found[i]["score"] for i in (1, 2, 3, 4)] == [1.0, 1.0, 1.0, 0.0]


@pytest.mark.parametrize("width", [1, 4])
def test_wrapped_templates_are_found_wherever_they_begin(spark, width):
    rows, labels = [], {}
    for label, template in license_scan.TEMPLATES:
        words = template.split()
        wrapped = "\n".join(" ".join(words[i : i + width]) for i in range(0, len(words), width))
        for before in (0, 1, 17, 35, 36, 37, 71, 72, 73, 100):
            labels[len(rows)] = label
            rows.append((len(rows), "x\n" * before + wrapped + "\nx" * 50))
    found = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(labels[r["doc_id"]] in r["labels"].split(",") and r["score"] == 1.0 for r in found) and len(found) == len(rows)


def test_spans(spark):
    text = "iban GB82 WEST 1234 5698 7654 32 é card 4111 1111 1111 1111, a@b.c_d@e.f 1.2.3.4.5 999.1.1.1 4111 1111 1111 1112"
    found = pii.pii_digest(pii.pii_spans(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    assert found["spans"] == "iban:5:32,card:40:59,email:61:66,email:66:72,ip:73:80"
    assert found["scores"].split(",")[:2] == ["1.00", "0.85"]


def test_places_of_many_spans(spark):
    words = [f"user{i}@mail.org" if i % 3 else "é word" for i in range(30_000)]
    text = " ".join(words)
    frame = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    row = pii.pii_spans(frame).filter("size(found) > 0").select(F.col("found.start").alias("s"), F.col("found.end").alias("e"), F.col("found.value").alias("v"))
    found = row.first()
    assert found["v"] == [w for w in words if "@" in w]
    assert all(text[s:e] == v for s, e, v in zip(found["s"], found["e"], found["v"]))


@pytest.mark.parametrize("condition", ["n_email > 0", "spans like 'ip%'"])
def test_a_filter_on_spans_stays_behind_them(spark, docs, condition):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    digest = pii.pii_digest(pii.pii_spans(docs))
    assert plan(digest.filter(condition)).count("regexp_extract_all(") == plan(digest).count("regexp_extract_all(") == len(pii.KINDS)


def test_spans_of_odd_rows(odd, nothing):
    found = pii.pii_digest(pii.pii_spans(odd))
    sums = found.agg(*[F.sum(f"n_{k}") for k in ("email", "ip", "card", "phone")], F.count("*")).first()
    assert tuple(sums) == (1, 1, 1, 1, len(ROWS))
    assert pii.pii_digest(pii.pii_spans(nothing)).count() == 0


# decontamination


def test_masks_find_every_pattern():
    for missing in itertools.combinations(range(20), 4):
        assert any(
            all(place + at not in missing for at in mask) for mask in decontaminate.MASKS for place in range(20 - mask[-1])
        )


@pytest.mark.parametrize("length", range(1, 20))
def test_masks_of_short_items_find_every_pattern(length):
    unequal = length - decontaminate.least_equal(length, decontaminate.SHARE)
    masks = decontaminate.masks_for(length, unequal)
    for missing in itertools.combinations(range(length), unequal):
        assert any(all(p + at not in missing for at in mask) for mask in masks for p in range(length - mask[-1]))


def test_leaks_of_short_items(spark):
    item = [f"b{i}" for i in range(15)]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "c0 c1 c2 c3 c4 c5 c6 c7 c8 c9")], "item_id long, text string")

    def changed(*places):
        return "x y " + " ".join("z" if i in places else w for i, w in enumerate(item)) + " v w"

    docs = {
        1: changed(7),
        2: changed(4, 9),
        3: changed(3, 7, 11),
        4: changed(0, 7, 14),
        5: changed(2, 5, 8, 11),
        6: "x " + " ".join(item[:13]),  # clipped at the end of the document
        7: " ".join(item[3:]) + " y",  # and at its beginning
        8: " ".join(item[4:]) + " y",
        9: "x c0 z c2 c3 c4 c5 c6 z c8 c9 y",
        10: "x c0 z c2 z c4 c5 c6 z c8 c9 y",
    }
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"], r["n_words"], r["n_equal"]) for r in decontaminate.find_leaks(frame, bench).collect()}
    assert found == {(1, 1, 15, 14), (2, 1, 15, 13), (3, 1, 15, 12), (4, 1, 15, 12), (6, 1, 13, 13), (7, 1, 12, 12), (9, 2, 10, 8)}


def test_every_pattern_of_a_short_item_is_found():
    item = [f"b{i}" for i in range(15)]
    items = decontaminate.Items([(1, " ".join(item))])
    hashes = decontaminate.WordHashes(decontaminate.PLAIN)
    for count in (1, 2, 3):
        places = list(itertools.combinations(range(15), count))
        texts = [" ".join("z" if i in missing else w for i, w in enumerate(item)) for missing in places]
        assert [m[0] for m in items.matches(hashes.all(texts))] == list(range(len(places)))


def test_pipeline_drops_leaks_of_items_without_id(spark, tmp_path):
    spark.createDataFrame([(None, "an item that has no id"), (1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, "here an item that has no id stands"), (2, "nothing here")], "doc_id long, text string")
    assert [r["doc_id"] for r in corpus_pipeline.drop_leaks(spark, docs, str(tmp_path)).collect()] == [2]


def test_leaks(spark):
    item = [f"b{i}" for i in range(40)]
    changed = ["z" if i in (3, 8, 13, 18) else w for i, w in enumerate(item[:20])]
    docs = [
        (1, "x y " + " ".join(item).upper() + " z"),
        (2, "x " + " ".join(changed) + " z"),
        (3, " ".join(item[:15])),
        (4, "before a short item after"),
        (5, "a short thing"),
        (None, " ".join(item[20:])),
        (6, None),
        (1, "nothing here"),
    ]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "A short, item"), (3, None), (None, "nothing here"), (4, "")], "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontaminate.find_leaks(frame, bench).collect()
    assert {(r["doc_id"], r["item_id"], r["n_equal"]) for r in found} == {(1, 1, 40), (2, 1, 16), (4, 2, 3), (None, 1, 20)}
    blocks = decontaminate.find_leaks(frame, bench, block_words=10).collect()
    assert sorted(map(str, blocks)) == sorted(map(str, found))
    assert decontaminate.find_leaks(frame, bench.limit(0)).count() == 0
    assert decontaminate.find_leaks(frame.limit(0), bench).count() == 0


# substring dedup


def test_repeats_of_odd_rows(odd, nothing):
    found = {(r["doc_id"], r["n_words"]): r["n_removed"] for r in substring_dedup.remove_repeats(odd).collect()}
    assert found[(6, 60)] == found[(8, 60)] == found[(None, 60)] == 60 and found[(7, 66)] == 60
    assert found[(1, 0)] == found[(4, 1)] == 0 and found[(5, 40_002)] == 40_000
    assert substring_dedup.remove_repeats(odd).count() == len(ROWS)
    assert substring_dedup.remove_repeats(nothing).count() == 0


def test_repeats_over_many_packs(docs, monkeypatch):
    expected = sorted(substring_dedup.remove_repeats(docs).collect())
    monkeypatch.setattr(substring_dedup, "PACK_ROWS", 7)
    monkeypatch.setattr(substring_dedup, "BUCKET_WINDOWS", 500)
    assert sorted(substring_dedup.remove_repeats(docs).collect()) == expected


# classifiers


def _measured(rows, truth, chance, taken):
    """(recall, precision, log loss, log loss of the base rate)."""
    y, p = np.array([r[truth] for r in rows], float), np.clip([r[chance] for r in rows], 1e-6, 1 - 1e-6)
    hit = np.array([r[taken] for r in rows], bool)
    loss = lambda q: float(-(y * np.log(q) + (1 - y) * np.log(1 - q)).mean())
    return (hit & (y == 1)).sum() / y.sum(), (hit & (y == 1)).sum() / max(1, hit.sum()), loss(p), loss(np.full(len(y), y.mean()))


def test_toxicity_on_held_out_rows(spark, sf_dir):
    folder = "/root/testdata/sf0.01"
    labels, docs = spark.read.parquet(f"{folder}/labels.parquet"), spark.read.parquet(f"{folder}/documents.parquet")
    found = toxicity.score_toxicity(docs, labels)
    rows = found.join(labels.withColumnRenamed("doc_id", "i"), F.col("doc_id") == F.col("i")).filter("held_out").collect()
    recall, precision, loss, base = _measured(rows, "toxic", "score", "predicted")
    assert recall > 0.7 and precision > 0.9 and loss < 0.6 * base
    again = toxicity.score_toxicity(docs.repartition(7), labels)
    assert {r["doc_id"]: r["score"] for r in again.collect()} == {r["doc_id"]: r["score"] for r in found.collect()}


@pytest.mark.parametrize("condition", ["score < 0.7", "predicted = 1"])
def test_a_filter_on_the_score_stays_behind_it(spark, docs, sf_dir, condition):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    plan = toxicity.score_toxicity(docs, labels).filter(condition)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("scored(") == plan.count("split(") == 0


def test_scoring_of_a_text_of_many_words_is_linear(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    rows = [(i, f"{'bad' if i % 2 else 'good'} words {i}") for i in range(200)] + [(999, " ".join(f"w{i}" for i in range(200_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert toxicity.without_toxic(docs, labels).count() == 101


def test_a_pair_is_learnt_whose_terms_say_nothing_alone(spark):
    """Toxic are texts with both terms or with neither; each of them is in as many toxic texts as in others."""
    random = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(1600):
        a, b = random.integers(0, 2, 2)
        words = [f"w{k}" for k in random.integers(0, 300, 12)]
        words[5:5] = ["insult"] * a + ["group"] * b
        rows.append((i, " ".join(words)))
        labels.append((i, int(a == b)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = toxicity.score_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), threshold=0.5)
    truth = dict(labels)
    held = [r for r in found.collect() if r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.9


def test_telling_terms_stay_one_row_a_document(spark):
    """Documents that share all of their terms are not multiplied by them; the sample holds each one's terms in order."""
    rows = [(i, float(i % 2), [5, 9, 40, 77]) for i in range(30)] + [(30, 1.0, []), (31, 0.0, [7, 78]), (32, 1.0, [3, 77])]
    met = spark.createDataFrame(rows, "doc_id long, label double, buckets array<int>")
    kept = np.array([3, 9, 77])
    found = {r["doc_id"]: (r["label"], r["places"]) for r in hashed._places(met, kept).collect()}
    assert found == {i: (label, [k for k, b in enumerate(kept) if b in own]) for i, label, own in rows}
    sample = hashed.sample_terms(met, met.select("doc_id"), lambda chosen: chosen)
    assert list(sample.labels) == [label for _, label, _ in rows]
    lengths = np.diff([*sample.starts, len(sample.terms)])
    assert [n > 0 for n in lengths] == [any(b in sample.buckets for b in own) for _, _, own in rows]


def _loss_slope(loss, values, at, step=1e-5):
    flat = values.reshape(-1)
    before = flat[at]
    flat[at] = before + step
    up = loss()
    flat[at] = before - step
    down = loss()
    flat[at] = before
    return (up - down) / (2 * step)


def test_gradients_of_the_factorization_machine():
    random = np.random.default_rng(8)
    lengths = random.integers(0, 6, 40)
    terms = np.concatenate([np.sort(random.choice(9, n, replace=False)) for n in lengths]).astype(np.int64)
    sample = hashed.Sample(np.arange(9), random.integers(0, 2, 40).astype(float), terms, np.concatenate(([0], np.cumsum(lengths)[:-1])))
    model = {"bias": np.array([0.3]), "linear": random.normal(0, 1, 9), "pairs": random.normal(0, 1, (9, 3))}

    def loss():
        p = toxicity.scores({**model, "bias": model["bias"][0]}, sample.terms, sample.starts)
        return float(-(sample.labels * np.log(p) + (1 - sample.labels) * np.log(1 - p)).mean())

    found = toxicity.gradients({**model, "bias": model["bias"][0]}, sample)
    for name, gradient in found.items():
        for at, value in enumerate(np.atleast_1d(gradient).reshape(-1)):
            assert value == pytest.approx(_loss_slope(loss, model[name], at), abs=1e-6), name


def test_factorization_learns_a_pair():
    """Two terms that only together mean the label."""
    random = np.random.default_rng(2)
    flags = random.integers(0, 2, (2000, 2))
    terms = np.concatenate([np.flatnonzero(f) for f in flags])
    lengths = flags.sum(axis=1)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    sample = hashed.Sample(np.array([5, 9]), flags.prod(axis=1).astype(float), terms, starts)
    scores = toxicity.scores(toxicity.fit(sample), terms, starts)
    assert ((scores > 0.7) == (flags.sum(axis=1) == 2)).all()


def test_classifiers_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (4, 1, None), (None, 1, 1), (6, None, None)], "doc_id long, toxic int, quality int")
    ratings = labels.select("doc_id", quality.grade(F.col("quality"), F.col("toxic")).alias("grade"))
    for some in (labels, labels.limit(0)):
        scored = toxicity.score_toxicity(odd, some).collect()
        assert len(scored) == len(ROWS) and all(0 <= r["score"] <= 1 for r in scored)
        rated = quality.score_quality(odd, ratings.join(some.select("doc_id").distinct(), "doc_id")).collect()
        assert len(rated) == len(ROWS) and all(0 <= r["tail_probability"] <= 1 for r in rated)
    assert toxicity.score_toxicity(nothing, labels).count() == quality.score_quality(nothing, ratings).count() == 0


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").withColumn("poor", 1 - F.col("quality"))
    found = queries.op8_quality(spark, folder).join(labels, "doc_id").filter("held_out")
    rows = found.select("*", (1 - F.col("tail_probability")).alias("chance"), (~F.col("kept")).alias("rejected")).collect()
    recall, precision, loss, base = _measured(rows, "poor", "chance", "rejected")
    assert recall > 0.7 and precision > 0.8 and loss < 0.6 * base


def test_gradients_of_the_ordinal_regression():
    random = np.random.default_rng(9)
    lengths = random.integers(0, 5, 50)
    terms = np.concatenate([np.sort(random.choice(6, n, replace=False)) for n in lengths]).astype(np.int64)
    sample = hashed.Sample(np.arange(6), random.integers(0, 4, 50).astype(float), terms, np.concatenate(([0], np.cumsum(lengths)[:-1])))
    model = {"weights": random.normal(0, 1, 6), "first": np.array([-0.5]), "gaps": random.normal(0, 0.5, 2)}
    plain = lambda: {**model, "first": model["first"][0]}

    def loss():
        tails = quality._tails(plain(), hashed.row_sums(model["weights"][sample.terms], sample.starts))
        padded = np.concatenate((np.ones((50, 1)), tails, np.zeros((50, 1))), axis=1)
        own = sample.labels.astype(int)
        return float(-np.log(padded[np.arange(50), own] - padded[np.arange(50), own + 1]).mean())

    for name, gradient in quality.gradients(plain(), sample, 4).items():
        for at, value in enumerate(np.atleast_1d(gradient)):
            assert value == pytest.approx(_loss_slope(loss, model[name], at), abs=1e-6), name


def test_ordinal_fit_keeps_thresholds_in_order():
    random = np.random.default_rng(3)
    flags = random.integers(0, 2, (3000, 4))
    grades = np.clip(flags[:, 0] + flags[:, 1], 0, 2)
    terms = np.concatenate([np.flatnonzero(f) for f in flags])
    starts = np.concatenate(([0], np.cumsum(flags.sum(axis=1))[:-1]))
    model = quality.fit(hashed.Sample(np.arange(4), grades.astype(float), terms, starts), 3)
    tails = quality._tails(model, hashed.row_sums(model["weights"][terms], starts))
    assert (tails[:, 0] >= tails[:, 1]).all()
    assert (np.rint(tails.sum(axis=1)) == grades).mean() > 0.99


# mixing


def test_knapsack_is_the_best_subset():
    random = np.random.default_rng(4)
    for _ in range(60):
        sizes = sorted(random.choice(np.arange(2, 30), 4, replace=False).tolist())
        counts = random.integers(1, 4, 4).tolist()
        total = sum(s * n for s, n in zip(sizes, counts))
        budget = int(random.integers(0, total + 1))
        taken = mixing.fit_counts(sizes, counts, budget)
        least = [n * budget // total for n in counts]
        best = min(
            (sum(s * c for s, c in zip(sizes, choice)) for choice in itertools.product(*(range(low, n + 1) for low, n in zip(least, counts)))),
            key=lambda w: (abs(w - budget), w),
        )
        assert sum(s * t for s, t in zip(sizes, taken)) == best
        assert all(0 <= t <= n for t, n in zip(taken, counts))
    big = mixing.fit_counts([3, 1000, 70_000], [10**6, 10**4, 900], 40_000_000)
    assert sum(s * t for s, t in zip([3, 1000, 70_000], big)) in (40_000_000, 39_999_999, 39_999_998)


def test_long_documents_are_fitted_too():
    """Budgets of which more is left than the knapsack holds: sums of long documents are held against them."""
    assert mixing.fit_counts([70_000, 150_000], [4, 2], 280_000) == [4, 0]
    assert mixing.fit_counts([60_000, 100_000], [2, 1], 120_000) == [2, 0]
    random = np.random.default_rng(11)
    for _ in range(60):
        sizes = sorted(random.choice(np.arange(2, 30), 4, replace=False).tolist())
        counts = random.integers(1, 4, 4).tolist()
        total = sum(s * n for s, n in zip(sizes, counts))
        budget = int(random.integers(0, total + 1))
        words = lambda choice: sum(s * c for s, c in zip(sizes, choice))
        # With so small a knapsack all documents are long ones.
        taken = mixing.fit_counts(sizes, counts, budget, knapsack_words=8)
        least = [n * budget // total for n in counts]
        best = min(abs(words(c) - budget) for c in itertools.product(*(range(low, n + 1) for low, n in zip(least, counts))))
        rest = budget - words(least)
        assert abs(words(taken) - budget) == best or rest <= 8
        assert all(0 <= t <= n for t, n in zip(taken, counts))
    # Sums beyond number: the longest ones left, then the knapsack.
    many = sorted(set(random.integers(10_000, 200_000, 60).tolist()))
    taken = mixing.fit_counts(many, [5] * len(many), 3_000_001)
    assert abs(sum(s * t for s, t in zip(many, taken)) - 3_000_001) <= 20_000


def _targets(totals: dict, cap: int = 3) -> dict:
    names = sorted(totals, key=lambda n: (n is None, n))
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    full: set = set()
    while True:
        left = sum(totals.values()) - sum(cap * totals[n] for n in full)
        share = {n: cap * totals[n] if n in full else left * weight[n] / sum(weight[m] for m in names if m not in full) for n in names}
        over = {n for n in names if n not in full and share[n] > cap * totals[n]}
        if not over:
            return share
        full |= over


@pytest.mark.parametrize("bucket_rows", [4096, 2])
def test_mixing(docs, bucket_rows):
    few = docs.filter("source in ('src0', 'src1', 'src2', 'src3') or doc_id % 3 = 0").withColumn(
        "source", F.when(F.col("source") == "src1", None).when(F.col("doc_id") % 40 == 5, "tiny").otherwise(F.col("source"))
    )
    rows = mixing.mix_sources(few, bucket_rows=bucket_rows).collect()
    again = mixing.mix_sources(few.repartition(5), bucket_rows=bucket_rows).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    totals = Counter()
    taken = Counter()
    for r in rows:
        totals[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
    expected = _targets(totals)
    for r in rows:
        assert r["target"] == pytest.approx(expected[r["source"]]) and r["source_size"] == totals[r["source"]]
    for source in totals:
        own = [r["size"] for r in rows if r["source"] == source]
        assert abs(taken[source] - expected[source]) <= (20 if len(own) > 9 else max(own) / 2)


def test_mixing_of_odd_rows(odd, nothing):
    rows = mixing.mix_sources(odd).collect()
    assert len(rows) == len(ROWS) and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.mix_sources(nothing).count() == 0
    assert all(r["taken"] == 0 for r in mixing.mix_sources(odd.filter("doc_id <= 3")).collect())


# pipeline


def test_pipeline_stages(spark, docs, texts):
    folder = "/root/testdata/sf0.001"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    now = docs
    scores = {r["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(docs, labels).collect()}
    expected = {i for i, p in scores.items() if not p}
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, folder)
        found = {r["doc_id"] for r in now.select("doc_id").collect()}
        if number == 1:
            newest = {}
            for i in expected:
                newest[texts[i]] = max(i, newest.get(texts[i], -1))
            expected = set(newest.values())
        if number == 2:
            sets = {i: _shingles(texts[i], 5) for i in expected}
            links = [
                (a, b)
                for a, b in itertools.combinations(sorted(sets), 2)
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
            ]
            expected = {i for i, c in _components(sets, links).items() if i == c}
        if number == 3:
            leaks = decontaminate.find_leaks(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))
            expected -= {r["doc_id"] for r in leaks.collect()}
        if number == 4:
            mixed = mixing.mix_sources(docs.filter(F.col("doc_id").isin(sorted(expected)))).filter("copies > 0")
            copies = {r["doc_id"]: r["copies"] for r in mixed.collect()}
            assert {r["doc_id"]: r["mix_copies"] for r in now.collect()} == copies
            expected = set(copies)
        assert found == expected, number
        assert number == 4 or now.columns == docs.columns


def _shingles(text, n):
    words = text.encode().translate(near_dedup.LOWER).split()
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def test_pipeline_stages_of_odd_rows(spark, odd, nothing):
    names = ["_id", "_hash", "_sha256", "_source", "_size", "_number", "_copies", "mix_copies"]
    clashing = odd.withColumns({name: F.lit(1) for name in names}).withColumn("map", F.create_map(F.lit("a"), F.lit(1)))
    for frame in (odd, nothing, clashing):
        now = frame
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            now = stage(spark, now, "/root/testdata/sf0.001")
            assert number == 4 or now.columns == frame.columns
        assert sorted(now.columns) == sorted({*frame.columns, "mix_copies"})
        assert now.count() <= frame.count() and (frame is nothing or now.count())


def test_mixing_stage_takes_equal_rows_as_often_as_the_mix_says(spark):
    rows = [(None, f"a b c d{i % 2}", "s") for i in range(30)] + [(7, "a b c d", "s")] * 11 + [(i, "w " * 90, "t") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    said = mixing.mix_sources(docs).groupBy("source").agg(F.sum("copies").alias("n")).collect()
    found = corpus_pipeline.mix(spark, docs, "").groupBy("source").agg(F.sum("mix_copies").alias("n")).collect()
    assert sorted(found) == sorted(said) and len(found) == 2


def test_toxicity_stage_drops_what_the_model_rejects(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    left = corpus_pipeline.drop_toxic(spark, docs, folder)
    rejected = toxicity.score_toxicity(docs, labels).filter("predicted = 1").count()
    assert left.columns == docs.columns and rejected > 50 and left.count() == docs.count() - rejected


def test_pipeline_keeps_one_row_of_equal_texts(spark):
    rows = [
        *[(None, PASSAGE, source) for source in ("b", "a", None, "a")],
        *[(8, "twice under one id", "c")] * 2,
        (7, "twice under one id", "c"),
        (7, "another text under an id", "c"),
        (None, "also without id", "d"),
        *[(9, text, "e") for text in (None, "")],
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = corpus_pipeline.drop_copies(spark, docs, "")
    assert found.columns == docs.columns
    expected = [(None, PASSAGE, None), (8, "twice under one id", "c"), (7, "another text under an id", "c"), (None, "also without id", "d"), (9, None, "e")]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))
