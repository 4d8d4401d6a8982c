"""The transducer against a dict, encoding and decoding against the tokenizers library."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daystrata.llm import queries, word_bpe
from daystrata.llm.transducer import Transducer, compile_words

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None,
    "",
    " \t\n",
    "Hello WORLD's  it's foo\nbar 123 don't'S 'RE 'll",
    "<|endoftext|> a<|startoftext|>B<|END <|ENDOFTEXT|> <|endoftext|><|endoftext|>",
    "x" * 5_000 + " " + "ab'sx'llll''re" * 300,
    "\x1c\x1d a\x85b　c\xa0d\x00e",
    "ΣΑΣ Σ ΑΣ. İstanbul ǅ ß ẞ é ÀÉ ﬁ naïve 中文 😀",
    "a ́b ́ é １２ ٣ ४ ©®™ …—“”",
    "many words of a kind " * 4_000,
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)

    def both(text):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        return ids, tokenizer.decode(ids, skip_special_tokens=False)

    return both


def _walked(entries, words):
    known, ids, lengths = Transducer(data=compile_words(sorted(entries.items()))).look_up(words)
    ends = np.cumsum(lengths)
    found = iter(tuple(ids[e - n : e].tolist()) for e, n in zip(ends.tolist(), lengths.tolist()))
    return [next(found) if k else None for k in known]


@settings(max_examples=150, deadline=None)
@given(
    st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 3), max_size=4).map(tuple), max_size=40),
    st.lists(st.binary(min_size=1, max_size=6), max_size=20),
)
def test_transducer_is_a_dict(entries, others):
    words = list(dict.fromkeys([*entries, *others, *(w[:-1] for w in entries if len(w) > 1), *(w + b"z" for w in entries)]))
    assert _walked(entries, words) == [entries.get(w) for w in words]


def test_transducer_shares_endings():
    words = [a + b for a in ("re", "un", "over", "") for b in ("doing", "making", "taking", "seeing")]
    built = Transducer(data=compile_words((w.encode(), (1,)) for w in sorted(words)))
    letters = {w[:i] for w in words for i in range(len(w) + 1)}
    assert built.states < len(letters) / 2
    # Equal states would have been shared: all states differ in what they accept.
    assert len({_accepted(built, s) for s in range(built.states)}) == built.states


def _accepted(built, state):
    here = [(b"", tuple(built.numbers[built.end_at[state] :][: built.end_len[state]]))] if built.final[state] else []
    for key, to, at, n in zip(built.keys, built.targets, built.out_at, built.out_len):
        if key >> 8 == state:
            out = tuple(built.numbers[at : at + n])
            here += [(bytes([key & 255]) + word, out + rest) for word, rest in _accepted(built, to)]
    return frozenset(here)


def test_words_must_be_sorted_and_distinct():
    for words in ([b"b", b"a"], [b"a", b"a"]):
        with pytest.raises(ValueError):
            compile_words((w, (1,)) for w in words)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=30), max_size=5))
def test_any_text_is_encoded_as_by_the_library(texts):
    encoder, tokenizer = _shared()
    found = {}
    for i, ids, _ in encoder.encode(texts):
        found.setdefault(i, []).extend(ids.tolist())
    assert [found[i] for i in range(len(texts))] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def _shared(kept=[]):  # noqa: B006
    if not kept:
        kept.extend((word_bpe.WordBpe(PATH), Tokenizer.from_file(PATH)))
    return kept


@pytest.mark.parametrize("lexicon_words", [0, 5, word_bpe.LEXICON_WORDS])
def test_encoded_texts(spark, sf_dir, library, lexicon_words):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(60)
    odd = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (None, "no id")], "doc_id long, text string")
    rows = docs.unionByName(odd).withColumns({"ids": F.lit(1), "n": F.lit(2), "word": F.lit("w"), "decoded": F.lit("x")})
    found = word_bpe.encode_texts(rows, PATH, lexicon_words=lexicon_words).collect()
    expected = []
    for r in rows.collect():
        ids, text = library(r["text"])
        expected.append((r["doc_id"], len(ids), np.array(ids, "<u4").tobytes(), text))
    assert Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in found) == Counter(expected)
    assert word_bpe.encode_texts(rows.limit(0), PATH).count() == 0


def test_long_texts_are_taken_in_parts(library, monkeypatch):
    monkeypatch.setattr(word_bpe, "BATCH_BYTES", 50)
    encoder = word_bpe.WordBpe(PATH, cache=20)
    texts = ["some words " * 40, None, "y" * 300, "  z  " * 60, "end"]
    found = {}
    for i, ids, shown in encoder.encode(texts):
        found.setdefault(i, []).append((ids, shown))
    assert len(found[0]) > 5
    for i, text in enumerate(texts):
        ids, shown = library(text)
        assert np.concatenate([f[0] for f in found[i]]).tolist() == ids
        assert " ".join(f[1] for f in found[i] if f[1]) == shown == encoder.decode(np.array(ids, int))


def test_query_is_that_of_the_library(spark, sf_dir, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    found = queries.op12_word_bpe(spark, sf_dir).collect()
    assert len(found) == len(texts)
    for r in found:
        ids, text = library(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_a_round_of_merges_looks_up_only_pairs_beside_a_merged_id(library, monkeypatch):
    encoder = word_bpe.WordBpe(PATH)
    words = [f"{a}{b}ing{a}" for a in ("interest", "under", "zq", "x", "re") for b in ("stand", "qqq", "able", "")]
    pieces = [w.encode() for w in [*words, "a", "y" * 70, "ha" * 20]]
    asked, rank_of = [], encoder.rank_of

    def counted(left, right):
        asked.append(left.size)
        return rank_of(left, right)

    monkeypatch.setattr(encoder, "merged_alone", lambda p: np.array(library(p.decode())[0]))
    monkeypatch.setattr(encoder, "rank_of", counted)
    ids, lengths = encoder.merged(pieces)
    ends = np.cumsum(lengths)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, lengths)] == [library(p.decode())[0] for p in pieces]
    merges = sum(len(p) - n for p, n in zip(pieces, lengths.tolist()) if len(p) <= word_bpe.WORD_BYTES)
    assert sum(asked) <= 2 * merges
    nothing = encoder.merged([])
    assert len(nothing[0]) == len(nothing[1]) == 0
