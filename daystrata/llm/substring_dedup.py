"""Repeated passages: windows of words counted over all documents, passages located by Aho-Corasick automata."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystrata.llm.common import keep_in_batches, text_of
from daystrata.llm.words import MULTIPLIER, WordHashes, mixed

WINDOW = 35
# A pack of documents ends at so many rows or characters.
PACK_ROWS = 256
PACK_CHARS = 2_000_000
# Windows that one bucket of hashes has (about); buckets are counted one by one.
BUCKET_WINDOWS = 4_000_000
LEAST_BUCKETS = 64

PACKED = "origin long, n_words long, docs binary"
RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in compressed packs, each under a random number of its own."""
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        begin, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= PACK_CHARS or i + 1 - begin >= PACK_ROWS or i + 1 == len(texts):
                part = batch.slice(begin, i + 1 - begin)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema) as writer:
                    writer.write_batch(part)
                n_words = sum(len(t.encode("utf-8", "surrogatepass").split()) for t in texts[begin : i + 1])
                docs = squeeze.compress(sink.getvalue().to_pybytes())
                origin = uuid.uuid4().int >> 65
                yield pa.RecordBatch.from_arrays(
                    [pa.array([origin], pa.int64()), pa.array([n_words], pa.int64()), pa.array([docs], pa.binary())],
                    ["origin", "n_words", "docs"],
                )
                begin, size = i + 1, 0


class Pack:
    """The documents of a pack and the distinct windows of words in them."""

    def __init__(self, docs: bytes, window: int, buckets: int, word_hashes: WordHashes):
        raw = zstandard.ZstdDecompressor().decompressobj().decompress(docs)
        table = pa.ipc.open_stream(raw).read_all()
        self.window = window
        self.ids = table.column("doc_id").to_pylist()
        self.words = [word_hashes.split(t) for t in table.column("text").to_pylist()]
        self.ends = np.cumsum([len(w) for w in self.words])
        self.hashes = np.concatenate([word_hashes.hashes(w) for w in self.words])
        end_of = np.repeat(self.ends, [len(w) for w in self.words])
        places = np.arange(max(0, len(self.hashes) - window + 1))
        self.starts = places[places + window <= end_of[: len(places)]]
        found = window_hashes(self.hashes, window)[self.starts]
        self.distinct, first, self.which, self.times = np.unique(found, return_index=True, return_inverse=True, return_counts=True)
        # The bucket comes from other bits than the hash, so more buckets tell more windows apart.
        other = mixed(window_hashes(mixed(self.hashes), window)[self.starts[first]])
        self.bucket = (other % np.uint64(buckets)).astype(np.int64)
        self.order = np.argsort(self.bucket, kind="stable")

    def by_bucket(self) -> Iterator[tuple[int, np.ndarray]]:
        """(bucket, places in ``distinct``) in order."""
        in_order = self.bucket[self.order]
        cuts = np.flatnonzero(np.diff(in_order)) + 1
        for part in np.split(self.order, cuts):
            if len(part):
                yield int(self.bucket[part[0]]), part

    def removed(self, recurring: np.ndarray) -> list[np.ndarray]:
        """For each document, which words lie in a recurring window; ``recurring`` tells it of ``distinct``.

        Maximal runs of recurring windows are the confirmed passages. One automaton of the pack's distinct passages
        goes over all documents of the pack and finds every place of each.
        """
        hit = np.zeros(len(self.hashes) + 1, bool)
        hit[self.starts] = recurring[self.which]
        # Windows never cross the end of a document, so runs of starts in two documents are apart.
        edges = np.diff(hit.astype(np.int8), prepend=0)
        opens, closes = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        covered = [np.zeros(len(w), bool) for w in self.words]
        if not len(opens):
            return covered
        _, ids = np.unique(self.hashes, return_inverse=True)
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for begin, end in zip(opens.tolist(), closes.tolist()):
            passage = tuple(ids[begin : end + self.window - 1].tolist())
            automaton.add_word(passage, len(passage))
        automaton.make_automaton()
        begin = 0
        for document, end in enumerate(self.ends.tolist()):
            marks = np.zeros(end - begin + 1, np.int64)
            for last, length in automaton.iter(tuple(ids[begin:end].tolist())):
                marks[last + 1 - length] += 1
                marks[last + 1] -= 1
            covered[document] = np.cumsum(marks[:-1]) > 0
            begin = end
        return covered


def window_hashes(hashes: np.ndarray, window: int) -> np.ndarray:
    """Hash of every run of ``window`` words, put together from runs of powers of two."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    result, done = None, 0
    run, length, factor = hashes, 1, MULTIPLIER
    while True:
        if window & length:
            if result is None:
                result = run[:n]
            else:
                result = result * factor + run[done : done + n]
            done += length
        if 2 * length > window:
            return mixed(result)
        run = run[:-length] * factor + run[length:]
        length, factor = 2 * length, np.uint64(int(factor) ** 2 % 2**64)


def _windows(window: int, buckets: int):
    names = ["bucket", "origin", "hashes", "many"]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_hashes = WordHashes()
        for batch in batches:
            for origin, docs in zip(batch.column("origin").to_pylist(), batch.column("docs").to_pylist()):
                pack = Pack(docs, window, buckets, word_hashes)
                rows = [
                    (bucket, origin, pack.distinct[part].tobytes(), np.packbits(pack.times[part] > 1).tobytes())
                    for bucket, part in pack.by_bucket()
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return windows


def _answer(rows: list[tuple[int, int, bytes, bytes]]) -> pa.RecordBatch:
    """For every pack in one bucket, which of its windows recur: in the pack itself or in another one."""
    hashes = [np.frombuffer(r[2], np.uint64) for r in rows]
    many = [np.unpackbits(np.frombuffer(r[3], np.uint8), count=len(h)).astype(bool) for r, h in zip(rows, hashes)]
    everything = np.sort(np.concatenate(hashes))
    twice = np.unique(everything[1:][everything[1:] == everything[:-1]])
    answers = [np.packbits(np.isin(h, twice, assume_unique=True) | m).tobytes() for h, m in zip(hashes, many)]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[1] for r in rows], pa.int64()), pa.array([r[0] for r in rows], pa.int64()), pa.array(answers, pa.binary())],
        ["origin", "bucket", "recurring"],
    )


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket; only one bucket is held at a time."""
    held: list[tuple[int, int, bytes, bytes]] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "origin", "hashes", "many"))):
            if held and held[0][0] != row[0]:
                yield _answer(held)
                held = []
            held.append(row)
    if held:
        yield _answer(held)


def _removed(window: int, buckets: int):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_hashes = WordHashes()
        for batch in batches:
            for docs, answers in zip(batch.column("docs").to_pylist(), batch.column("answers").to_pylist()):
                pack = Pack(docs, window, buckets, word_hashes)
                by_bucket = {a["bucket"]: a["recurring"] for a in answers or ()}
                recurring = np.zeros(len(pack.distinct), bool)
                for bucket, part in pack.by_bucket():
                    bits = np.frombuffer(by_bucket[bucket], np.uint8)
                    recurring[part] = np.unpackbits(bits, count=len(part)).astype(bool)
                rows = []
                for doc_id, words, covered in zip(pack.ids, pack.words, pack.removed(recurring)):
                    kept = b" ".join(compress(words, ~covered))
                    rows.append((doc_id, len(words), int(covered.sum()), hashlib.sha256(kept).hexdigest()))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RESULT)], schema=RESULT)

    return remove


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per input row: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space).

    A word is removed if it lies in a run of ``window`` words of its document that also starts anywhere else, in the
    same or another document. Words are runs of anything but ASCII white space, as they are.

    Documents are packed, about 256 together. Of each pack, the distinct window hashes go to buckets by other bits of
    the hash; a bucket tells every pack which of its windows others have too. A window in a third of all documents is
    thus one hash per pack. Each pack then makes an automaton of the passages confirmed for it and streams its
    documents through. Texts move once, compressed, to meet the answers for their pack.

    Null and empty texts have no words. Documents shorter than a window lose nothing. Rows that repeat (with or without
    an id) are documents of their own, so their windows recur. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    packs = keep_in_batches(rows.mapInArrow(_pack, PACKED), PACK_ROWS)
    n_words = packs.agg(F.sum("n_words")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, int(n_words) // BUCKET_WINDOWS + 1)
    hashed = packs.mapInArrow(_windows(window, buckets), "bucket long, origin long, hashes binary, many binary")
    by_bucket = hashed.repartition("bucket").sortWithinPartitions("bucket")
    answered = keep_in_batches(by_bucket.mapInArrow(_answers, "origin long, bucket long, recurring binary"), 64)
    answers = answered.groupBy("origin").agg(F.collect_list(F.struct("bucket", "recurring")).alias("answers"))
    met = packs.join(answers, "origin", "left").select("docs", "answers")
    return keep_in_batches(met.mapInArrow(_removed(window, buckets), "doc_id long, n_words long, n_removed long, kept_sha256 string"), 4)
