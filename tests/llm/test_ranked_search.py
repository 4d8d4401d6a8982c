"""Ranked search against brute force."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from daystrata.llm import ranked_search


def _brute(docs, items, top=20):
    """Counter of (item_id, rank, doc_id, score)."""
    words = [(i, ranked_search.terms_of(t)) for i, t in docs]
    n_docs, length = sum(bool(w) for _, w in words), sum(len(w) for _, w in words)
    counts = [(i, len(w), Counter(w)) for i, w in words]
    frequency = Counter(t for _, _, c in counts for t in c)
    found = Counter()
    for item, text in items:
        scores = []
        for i, n, c in counts:
            score = 0
            for t in ranked_search.terms_of(text):
                if c[t]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency[t] + 1)))
                    score += weight * ((1_000_000_000 * c[t]) // (1_000 * c[t] + 12 * (75 + 25 * n * n_docs // length)))
            if score > 0:
                scores.append((-score, i is None, i))
        for rank, (score, _, i) in enumerate(sorted(scores, key=lambda s: (*s[:2], s[2] or 0))[:top]):
            found[(item, rank + 1, i, -score)] += 1
    return found


def _found(frame):
    return Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in frame.collect())


@pytest.mark.parametrize("owners, bundle, pack, block", [(4, 64, 4_096, 500_000), (1, 3, 10, 40), (7, 1, 64, 10**9)])
def test_ranks_of_skewed_texts(spark, monkeypatch, owners, bundle, pack, block):
    """A term that all documents have, many ties, repeated terms in items, few documents in a pack."""
    monkeypatch.setattr(ranked_search, "PACK_DOCUMENTS", pack)
    random = np.random.default_rng(6)
    word = lambda n: " ".join(f"w{int(k)}" for k in random.zipf(1.4, n) % 50)
    docs = [(i, "The " + word(int(random.integers(1, 40)))) for i in range(400)]
    docs += [(1000 + i, "the w1 copy") for i in range(60)] + [(5, "the w1 copy"), (None, "the W1, copy!"), (None, None), (7, ""), (None, "rare thing")]
    items = [(i, word(6)) for i in range(12)] + [(3, "the the THE"), (3, "copy w1"), (None, "rare w2"), (20, None), (21, "absent word"), (22, "...")]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, item_id string, score int").repartition(5)
    asked = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, doc_id int")
    found = ranked_search.search(frame, asked, owners=owners, bundle_items=bundle, block_terms=block)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert _found(found) == _brute(docs, items)


def test_ranks_without_documents_or_items(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search.search(docs.limit(0), items).count() == 0
    assert ranked_search.search(docs, items.limit(0)).collect() == []
    assert ranked_search.search(docs, spark.createDataFrame([(1, None)], "item_id long, text string")).schema == ranked_search.search(docs, items).schema
    only = ranked_search.search(spark.createDataFrame([("x", None), ("y", "...")], "doc_id string, text string"), items)
    assert only.count() == 0


def test_sums_that_cannot_be_among_the_best_are_not_carried_on():
    owners = ranked_search.Owners.of(np.array([1, 1_000]), 2_000, 10_000, 2)
    stage = ranked_search.Stage(ranked_search.Queries([(0, "rare common")]), owners, 0, 4, 2)
    assert stage.later == [int(owners.weights[1]) * ranked_search.MOST]
    total = np.array([10, 0, 5 * stage.later[0], 9 * stage.later[0], 4 * stage.later[0]])
    at, scores = stage.leading(total, stage.later[0])
    assert at.tolist() == [2, 3, 4] and (scores == total[at]).all()
