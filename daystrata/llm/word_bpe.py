"""BPE encoding and decoding with word ends: a lexicon of frequent words as a minimal acyclic transducer, the rest merged."""

from __future__ import annotations

import heapq
import json
import os
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daystrata.llm.common import keep, keep_in_batches, text_of
from daystrata.llm.transducer import Transducer, compile_words, spread
from daystrata.sources.files import scratch_dir

# Frequent words that the lexicon holds.
LEXICON_WORDS = 50_000
# Longer words are not put in the lexicon.
WORD_BYTES = 64
# Bytes of text that are encoded together; longer texts are taken in parts, cut at white space.
BATCH_BYTES = 4 << 20
# Words that a worker remembers until it forgets them all.
CACHE = 400_000
# ASCII white space, where words end.
BLANKS = r"[\x20\x09-\x0D]+"
# The file's own pattern for pieces of a word, for lower-case ASCII words without white space (fixed by the file).
ASCII_PIECES = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
# The same with the Latin letters up to U+024F but U+0130: small and capital ones are single letters in their normal form.
LATIN = re.compile(r"[\x00-\x7F\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u024F]+")
LATIN_PIECES = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00DF-\u00F6\u00F8-\u024F]+|[0-9]|[^a-z\u00DF-\u00F6\u00F8-\u024F0-9]+"
)
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# A space near which a long text may be cut.
CUT = re.compile(rb"[\x20\x09-\x0D]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones as they are, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return [chr(b) if b in set(plain) else chr(256 + others.index(b)) for b in range(256)]


class WordBpe:
    """A BPE file of the tokenizers library that drops white space and marks the ends of words.

    White space parts words for every step of the file (its normal form, its pattern, its special strings), so a text's
    ids are those of its words one after the other. Words of ASCII are cut into pieces by the file's pattern here; for
    other words the library's own normal form and pattern are asked. Pieces are merged here, by the file's ranks.
    """

    def __init__(self, path: str, lexicon: Transducer | None = None, cache: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        model = parts["model"]
        suffix = model.get("end_of_word_suffix") or ""
        if model["type"] != "BPE" or not suffix or model.get("dropout") or parts["decoder"] or parts["normalizer"] is None:
            raise ValueError("not a BPE file with word ends and without a decoder")
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in parts["added_tokens"]):
            raise ValueError("special strings must be plain ones")
        self.normal, self.cut = tokenizer.normalizer.normalize_str, tokenizer.pre_tokenizer.pre_tokenize_str
        vocabulary = model["vocab"]
        self.special = {t["content"].encode(): t["id"] for t in parts["added_tokens"]}
        by_length = sorted(self.special, key=lambda s: (-len(s), s))
        self.specials = re.compile(b"(" + b"|".join(map(re.escape, by_length)) + b")") if by_length else None
        self.names = {i: name for name, i in vocabulary.items()} | {i: s.decode() for s, i in self.special.items()}
        self.size = max(self.names) + 1
        letters = byte_letters()
        self.byte_of = {letter: b for b, letter in enumerate(letters)}
        self.inner = np.array([vocabulary.get(c, -1) for c in letters], np.int64)
        self.last = np.array([vocabulary.get(c + suffix, -1) for c in letters], np.int64)
        if (self.inner < 0).any() or (self.last < 0).any():
            raise ValueError("the vocabulary must have every byte, within and at the end of a word")
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        codes = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(codes)
        self.codes, self.ranks = codes[order], order
        self.results = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        # Ranks of pairs of bytes, by whether the right one ends its piece.
        self.first = np.stack([self.rank_of(self.inner[:, None], right[None, :]) for right in (self.inner, self.last)])
        self.lexicon, self.cache = lexicon, cache
        self.forget()

    def forget(self) -> None:
        """Words met so far: their number, and by number their ids (flat, with a begin and a length) and decoded text."""
        self.known: dict[bytes, int] = {}
        self.ids, self.begin, self.length = np.zeros(1 << 16, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.shown: list[str] = []

    # pieces

    def pieces(self, word: bytes) -> list[bytes | int]:
        """The pieces of one word as bytes, special strings as their ids."""
        if b"<|" not in word and word not in self.special:
            return self.plain_pieces(word)
        parts = self.specials.split(word) if self.specials and b"<|" in word else [word]
        found: list[bytes | int] = []
        for part in parts:
            found.extend([self.special[part]] if part in self.special else self.plain_pieces(part))
        return found

    def plain_pieces(self, part: bytes) -> list[bytes]:
        """The pieces of a word, or of a part of one, without special strings."""
        if part.isascii():
            return ASCII_PIECES.findall(part.translate(LOWER))
        letters = part.decode("utf-8", "surrogatepass")
        if LATIN.fullmatch(letters):
            return [p.encode() for p in LATIN_PIECES.findall(letters.lower())]
        cut = self.cut(self.normal(letters))
        return [bytes(map(self.byte_of.__getitem__, piece)) for piece, _ in cut]

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; pairs that do not merge rank behind all others."""
        code = left * self.size + right
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.ranks[at], len(self.codes))

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lengths) of pieces, all merged together: each round merges the first best pair of every piece.

        A round changes the ranks of the pairs beside a merged id only; all others are kept from round to round.
        """
        nothing = len(self.codes)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        alone = np.flatnonzero(sizes > WORD_BYTES)
        long = [self.merged_alone(pieces[i]) for i in alone.tolist()]
        who = np.flatnonzero(sizes <= WORD_BYTES)
        sizes = sizes[who]
        raw = np.frombuffer(b"".join([p for p in pieces if len(p) <= WORD_BYTES] if long else pieces), np.uint8)
        ends = np.cumsum(sizes) - 1
        is_last = np.zeros(len(raw), np.int64)
        is_last[ends] = 1
        ids = np.where(is_last, self.last[raw], self.inner[raw])
        rank = np.full(len(raw), nothing, np.int64)
        rank[:-1] = self.first[is_last[1:], raw[:-1], raw[1:]]
        rank[ends] = nothing
        ended = [(alone, np.fromiter(map(len, long), np.int64, len(long)), *long)]
        while len(who):
            # The least of rank and place is the first best pair.
            best = np.minimum.reduceat(rank << 32 | np.arange(len(rank)), ends - sizes + 1)
            over = best >= nothing << 32
            out = np.repeat(over, sizes)
            ended.append((who[over], sizes[over], ids[out]))
            gone = np.cumsum(np.where(over, sizes, 0))[~over]
            who, sizes, best = who[~over], sizes[~over] - 1, best[~over]
            at = best & 0xFFFFFFFF
            ids[at] = self.results[best >> 32]
            out[at + 1] = True
            ids, rank = ids[~out], rank[~out]
            # Where the merged ids stand now, and the pairs that they begin or end.
            at = at - gone - np.arange(len(at))
            ends = np.cumsum(sizes) - 1
            rank[at] = nothing
            pairs = np.concatenate((at[at < ends], at[at > ends - sizes + 1] - 1))
            rank[pairs] = self.rank_of(ids[pairs], ids[pairs + 1])
        owner, lengths = (np.concatenate([e[i] for e in ended]) for i in range(2))
        flat = np.concatenate([np.zeros(0, np.int64), *chain.from_iterable(e[2:] for e in ended)])
        order = np.argsort(owner)
        begin = np.cumsum(lengths) - lengths
        return flat[spread(begin[order], lengths[order])], lengths[order]

    def merged_alone(self, piece: bytes) -> np.ndarray:
        """The ids of one long piece: a heap of pairs by rank and place, over a linked list."""
        raw = np.frombuffer(piece, np.uint8)
        ids = self.inner[raw]
        ids[-1] = self.last[raw[-1]]
        nothing, n = len(self.codes), len(ids)
        rank = self.rank_of(ids[:-1], ids[1:])
        heap = [(int(r), i, int(ids[i]), int(ids[i + 1])) for i, r in enumerate(rank) if r < nothing]
        heapq.heapify(heap)
        symbols, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))

        def offer(i: int) -> None:
            j = after[i]
            if i >= 0 and j < n:
                r = int(self.rank_of(np.array([symbols[i]]), np.array([symbols[j]]))[0])
                if r < nothing:
                    heapq.heappush(heap, (r, i, symbols[i], symbols[j]))

        while heap:
            r, i, left, right = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j] = int(self.results[r]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return np.array([s for s in symbols if s >= 0], np.int64)

    # words and texts

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lengths) of distinct words: from the lexicon, or merged if they are not in it."""
        lengths = np.zeros(len(words), np.int64)
        if self.lexicon is None:
            known, ids, counts = np.zeros(len(words), bool), np.zeros(0, np.int64), np.zeros(0, np.int64)
        else:
            known, ids, counts = self.lexicon.look_up(words)
        unseen = np.flatnonzero(~known)
        cut = [[w.translate(LOWER)] if w.isalpha() else self.pieces(w) for w in map(words.__getitem__, unseen.tolist())]
        pieces = list(dict.fromkeys(chain.from_iterable(cut)))
        number = {p: i for i, p in enumerate(pieces)}
        is_special = np.fromiter((isinstance(p, int) for p in pieces), bool, len(pieces))
        merged, counts_of = self.merged([p for p in pieces if isinstance(p, bytes)])
        size = np.ones(len(pieces), np.int64)
        size[~is_special] = counts_of
        flat = np.empty(int(size.sum()), np.int64)
        held = np.repeat(is_special, size)
        flat[~held] = merged
        flat[held] = [p for p in pieces if isinstance(p, int)]
        which = np.fromiter(map(number.__getitem__, chain.from_iterable(cut)), np.int64)
        owner = np.repeat(np.arange(len(unseen)), np.fromiter(map(len, cut), np.int64, len(cut)))
        lengths[known] = counts
        lengths[unseen] = np.bincount(owner, size[which], len(unseen)).astype(np.int64) if len(which) else 0
        at = np.cumsum(lengths) - lengths
        result = np.empty(int(lengths.sum()), np.int64)
        result[spread(at[known], counts)] = ids
        result[spread(at[unseen], lengths[unseen])] = flat[spread((np.cumsum(size) - size)[which], size[which])]
        return result, lengths

    def learn(self, words: list[bytes]) -> None:
        """Look up or merge words that are not remembered, and remember them."""
        ids, lengths = self.words(words)
        total = int(self.begin[-1] + self.length[-1]) if len(self.begin) else 0
        if total + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(max(len(self.ids), len(ids)), np.int32)))
        self.ids[total : total + len(ids)] = ids
        ends = np.cumsum(lengths)
        self.begin = np.concatenate((self.begin, total + ends - lengths))
        self.length = np.concatenate((self.length, lengths))
        names = list(map(self.names.__getitem__, ids.tolist()))
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.shown.extend([names[e - 1] if n == 1 else " ".join(names[e - n : e]) for e, n in zip(ends.tolist(), lengths.tolist())])

    def encode(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, str]]:
        """(place of the text, ids, decoded) for every part of every text, in order; a text has one part at least."""
        waiting: list[tuple[int, list[bytes]]] = []
        size = 0
        for i, text in enumerate(texts):
            for part in parts_of((text or "").encode("utf-8", "surrogatepass"), BATCH_BYTES):
                waiting.append((i, part.split()))
                size += len(part)
                if size > BATCH_BYTES:
                    yield from self._encode(waiting)
                    waiting, size = [], 0
        yield from self._encode(waiting)

    def _encode(self, waiting: list[tuple[int, list[bytes]]]) -> Iterator[tuple[int, np.ndarray, str]]:
        met = set(chain.from_iterable(words for _, words in waiting))
        if len(self.known) > self.cache:
            self.forget()
        self.learn(list(met.difference(self.known)))
        for i, words in waiting:
            which = list(map(self.known.__getitem__, words))
            at = np.array(which, np.int64)
            size = self.length[at]
            shown = map(self.shown.__getitem__, which)
            # A word that is all white space of other kinds has no ids.
            yield i, self.ids[spread(self.begin[at], size)], " ".join(shown if size.all() else filter(None, shown))

    def decode(self, ids: np.ndarray) -> str:
        """What the library's decoding gives, special strings kept: the names of the ids with spaces between."""
        return " ".join([self.names[i] for i in ids.tolist() if i in self.names])


def parts_of(raw: bytes, size: int) -> Iterator[bytes]:
    """``raw`` in parts of about ``size`` bytes, cut at white space."""
    at = 0
    while len(raw) - at > size:
        cut = CUT.search(raw, at + size)
        if cut is None:
            break
        yield raw[at : cut.start()]
        at = cut.start()
    yield raw[at:] if at else raw


def frequent_words(docs: DataFrame, text_col: str = "text", words: int = LEXICON_WORDS) -> DataFrame:
    """(word): the most frequent words of all texts, as they stand, no more than ``words`` of them.

    How many words there are of about each frequency, in steps of a 64th of a power of two, tells from which on they
    are few enough; so only words of the lexicon leave the tasks.
    """
    every = docs.select(F.explode(F.split(text_of(text_col), BLANKS)).alias("word"))
    counted = every.filter((F.col("word") != "") & (F.octet_length("word") <= WORD_BYTES)).groupBy("word").agg(F.count("*").alias("n"))
    counted = keep(counted.filter("n > 1").select("word", F.floor(F.log2("n") * 64).cast("int").alias("step")))
    total, least = 0, None
    for step, n in sorted(counted.groupBy("step").count().collect(), reverse=True):
        total += n
        if total > words:
            break
        least = step
    return counted.filter(F.lit(least is not None) & (F.col("step") >= F.lit(least or 0))).select("word")


def publish_lexicon(spark: SparkSession, words: list[str], path: str) -> str:
    """Compile a lexicon of words, write it to the shared folder and have executors fetch it. Its file name."""
    encoder = WordBpe(path)
    distinct = sorted(w.encode("utf-8", "surrogatepass") for w in words)
    ids, lengths = encoder.words(distinct)
    ends = np.cumsum(lengths)
    data = compile_words((w, tuple(ids[e - n : e].tolist())) for w, e, n in zip(distinct, ends.tolist(), lengths.tolist()))
    name = f"lexicon-{uuid.uuid4().hex}.fst"
    folder = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    file = spark._jvm.org.apache.hadoop.fs.Path(folder, name)
    out = file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file)
    try:
        out.write(data)
    finally:
        out.close()
    spark.sparkContext.addFile(file.toString())
    return name


def encode_texts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lexicon_words: int = LEXICON_WORDS
) -> DataFrame:
    """Per input row: doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit) and decoded (text).

    ``path`` is a BPE file with word ends that every executor can open; ids are those of the tokenizers library without
    added tokens, special strings in a text included, and ``decoded`` is its decoding with them. The most frequent words
    of all texts, ``lexicon_words`` at most, are compiled into a transducer; what is not in it is merged, so the
    lexicon's contents change no row. Null and empty texts, and texts of white space only, have no ids and decode to an empty
    text. Rows are independent: repeated rows get equal answers, ids may be null, an empty table gives an empty result,
    and other columns are not looked at.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    frequent = [r["word"] for r in frequent_words(rows, "text", lexicon_words).collect()]
    name = publish_lexicon(spark, frequent, path)
    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL("n_tokens long, ids binary, decoded string")])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordBpe(path, Transducer(SparkFiles.get(name)))
        for batch in batches:
            yield from _encoded(encoder, batch)

    return rows.mapInArrow(encode, schema)


def _encoded(encoder: WordBpe, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of one batch, in batches of about the bytes that are encoded together."""
    texts = batch.column("text").to_pylist()
    done: list[tuple[int, bytes, str]] = []
    parts: list[tuple[np.ndarray, str]] = []
    first, size = 0, 0

    def flush() -> pa.RecordBatch:
        columns = [batch.column("doc_id").slice(first, len(done)), *map(pa.array, zip(*done), (pa.int64(), pa.binary(), pa.string()))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "decoded"])

    def finish() -> None:
        ids = np.concatenate([p[0] for p in parts])
        done.append((len(ids), ids.astype("<u4").tobytes(), " ".join(p[1] for p in parts if p[1])))
        parts.clear()

    current = 0
    for i, ids, shown in encoder.encode(texts):
        if i != current:
            finish()
            current = i
            if size > BATCH_BYTES:
                yield flush()
                first, size = first + len(done), 0
                done.clear()
        parts.append((ids, shown))
        size += len(shown)
    if texts:
        finish()
        yield flush()


def digests(encoded: DataFrame) -> DataFrame:
    """Per row of ``encode_texts``: doc_id, n_tokens and digests of ids and decoded text."""
    shown = encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
    return keep_in_batches(shown)
