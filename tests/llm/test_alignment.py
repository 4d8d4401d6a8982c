"""Cross-tokenizer alignment against brute force over token ends."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from daystrata.llm import alignment
from daystrata.llm.word_bpe import byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None,
    "",
    " ",
    "  two spaces  inside \n and at an end  ",
    "a\n b \t c",
    "x" * 3_000,
    "xy" * 40_000,
    "word " * 3_000,
    "special <|endoftext|> <s> </s> <unk> <0x41>",
    "a ▁ b",
    "é ü ñ ﬁ ｘ １ 中文字符 😀😃 ́ \x00 \x7f  ",
    "don't we'll  it's",
    "same text",
    "same text",
    "\U0001f469‍\U0001f469‍\U0001f467" * 50,
]


class Brute:
    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.bytes = {letter: b for b, letter in enumerate(byte_letters())}

    def groups(self, text):
        if not text:
            return []
        raw = (" " + text).encode()
        a = self.a.encode(" " + text, add_special_tokens=False)
        left = [(i, bytes(self.bytes[c] for c in t)) for i, t in zip(a.ids, a.tokens)]
        right = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            right.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        if b"".join(t for _, t in left) != raw or b"".join(t for _, t in right) != raw:
            return []
        ends = lambda tokens: np.cumsum([len(t) for _, t in tokens]).tolist()
        both = np.array(sorted(set(ends(left)) & set(ends(right))))
        found = [([], []) for _ in both]
        for side, tokens in enumerate((left, right)):
            for (i, _), end in zip(tokens, ends(tokens)):
                found[np.searchsorted(both, end)][side].append(i)
        return found

    def rows(self, texts):
        every = [self.groups(t) for t in texts]
        links = []
        for groups in every:
            own = Counter()
            for left, right in groups:
                for i, n in Counter(left).items():
                    for j, m in Counter(right).items():
                        own[i, j] += n * m
            links.append(own)
        documents = Counter(pair for own in links for pair in own)
        highest = {}
        for (i, _), n in documents.items():
            highest[i] = max(n, highest.get(i, 0))
        for groups, own in zip(every, links):
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            yield (
                sum(len(x) for x, _ in groups),
                sum(len(y) for _, y in groups),
                len(groups),
                sum(own.values()),
                sum(n for pair, n in own.items() if documents[pair] == highest[pair[0]]),
                sum(n * documents[pair] for pair, n in own.items()),
                hashlib.sha256(text.encode()).hexdigest() if text else "",
            )


@pytest.fixture(scope="module")
def brute():
    return Brute()


def _found(frame):
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted(tuple(r[c] for c in columns) for r in alignment.link_digest(frame, A, B).collect())


def test_alignment_of_documents(spark, sf_dir, brute):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    expected = sorted((r["doc_id"], *row) for r, row in zip(rows, brute.rows([r["text"] for r in rows])))
    assert _found(docs) == expected


@pytest.mark.parametrize("pack, lane", [(alignment.PACK_DOCUMENTS, alignment.LANE), (2, 7)])
def test_alignment_of_odd_rows(spark, brute, monkeypatch, pack, lane):
    monkeypatch.setattr(alignment, "PACK_DOCUMENTS", pack)
    monkeypatch.setattr(alignment.align, "__defaults__", (lane,))
    rows = [(i, t, 1, "p", 2) for i, t in enumerate(ODD)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, pack int, groups string, code int").repartition(3)
    assert _found(frame) == sorted((i, *row) for (i, *_), row in zip(rows, brute.rows(ODD)))


def test_alignment_of_no_rows_and_rows_without_id(spark, brute):
    schema = "doc_id long, text string"
    assert alignment.link_digest(spark.createDataFrame([], schema), A, B).count() == 0
    frame = spark.createDataFrame([(None, "some words"), (None, "some words"), (None, None)], schema)
    found = [tuple(r)[1:] for r in alignment.link_digest(frame, A, B).collect()]
    assert Counter(found) == Counter(brute.rows(["some words", "some words", None]))


def test_lanes_end_together(brute):
    tokenizers = alignment.TwoTokenizers(A, B)
    texts = ["one two three " * 500, "x" * 5_000, "", "a b"]
    a, b = tokenizers.encode(texts)
    stretches = alignment.lanes(a, b, 16)
    assert len(stretches) > 20
    for _, i, k, j, m in stretches:
        assert a.ends[k - 1] == b.ends[m - 1] and i < k and j < m
    plain, lane = alignment.align(a, b, 10**9), alignment.align(a, b, 16)
    for name in ("cuts", "documents", "codes", "times"):
        assert (getattr(plain, name) == getattr(lane, name)).all()


def test_large_groups_are_counted_by_their_ids(monkeypatch):
    tokenizers = alignment.TwoTokenizers(A, B)
    a, b = tokenizers.encode(["x" * 2_000, "ab" * 900, "some words here"])
    one_by_one = alignment.align(a, b)
    monkeypatch.setattr(alignment, "SINGLE_LINKS", 0)
    by_ids = alignment.align(a, b)
    for name in ("cuts", "documents", "codes", "times"):
        assert (getattr(one_by_one, name) == getattr(by_ids, name)).all()
