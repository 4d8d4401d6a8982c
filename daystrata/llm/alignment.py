"""Alignment of two tokenizers: the tokens of all documents of a batch are merged in lockstep, step by step."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daystrata.llm.common import keep, keep_in_batches, text_of
from daystrata.llm.transducer import spread
from daystrata.llm.word_bpe import byte_letters

# Bytes of text, and documents, whose links are counted together before they are shuffled.
PACK_BYTES = 4 << 20
PACK_DOCUMENTS = 1_024
# Tokens of a text after which it goes on in a lane of its own.
LANE = 64
# Parts of texts that a worker remembers the tokens of, until it forgets them all.
CACHE = 600_000
# Parts that are encoded together.
PARTS = 50_000
# Links of a group of tokens that are written out one by one; those of larger groups are counted by their ids.
SINGLE_LINKS = 1_024
ID_BITS = 24
# The pattern that a byte-level file cuts texts with (fixed by the library, which names it use_regex).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# A text where a space stands after white space, before more of it or at the end: what is around decides its tokens.
INNER_SPACE = re.compile(r"\s (?:\s|\Z)|  | \Z")


class Tokens:
    """Token ids of a text and their ends in bytes, flat over the texts of a batch, for one tokenizer."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, counts: np.ndarray):
        self.ids, self.counts = ids, counts
        self.first = np.cumsum(counts) - counts
        ends = np.cumsum(lengths)
        before = np.concatenate(([0], ends))[self.first] if len(counts) else np.zeros(0, np.int64)
        self.ends = ends - np.repeat(before, counts)


class TwoTokenizers:
    """A byte-level BPE file (A) and a piece model with byte fallback (B) over space + text.

    A's pieces start at a space unless white space stands on both sides of it, B's pieces hold spaces at their beginning
    only; so without two spaces in a row the parts between spaces have the same tokens anywhere, and are remembered.
    """

    def __init__(self, a_path: str, b_path: str, cache: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        with open(a_path, encoding="utf-8") as file:
            parts = json.load(file)
        vocabulary = parts["model"]["vocab"]
        special = {t["id"]: t["content"] for t in parts["added_tokens"]}
        self.a_bytes = [b""] * (max([*vocabulary.values(), *special]) + 1)
        for name, i in vocabulary.items():
            self.a_bytes[i] = special[i].encode() if i in special else bytes(map(byte_of.__getitem__, name))
        self.fast = None
        merges = [m.split(" ") if isinstance(m, str) else m for m in parts["model"]["merges"]]
        plain = parts["normalizer"] is None and parts["pre_tokenizer"]["type"] == "ByteLevel" and parts["pre_tokenizer"]["use_regex"]
        if plain and all(vocabulary[a + b] == len(byte_of) + rank for rank, (a, b) in enumerate(merges)):
            # Ids are ranks, as the faster library for many short texts wants them.
            ranks = {self.a_bytes[i]: i for i in vocabulary.values() if i not in special}
            self.fast = tiktoken.Encoding("a", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        if any(" " in self.b.id_to_piece(i).lstrip("▁").replace("▁", " ") for i in range(self.b.get_piece_size()) if not self.b.is_byte(i)):
            raise ValueError("a piece of B holds a space that is not at its beginning")
        self.a_length = np.array(list(map(len, self.a_bytes)), np.int64)
        self.b_length = np.array(list(map(len, self.b_bytes)), np.int64)
        self.cache = cache
        self._forget()

    def _forget(self) -> None:
        """Parts met so far: their number, by number whether both tokenizers give their bytes back, and their ids."""
        self.known: dict[str, int] = {}
        self.right = np.zeros(0, bool)
        self.flat = [np.zeros(0, np.int32)] * 2
        self.begin = [np.zeros(0, np.int64)] * 2
        self.count = [np.zeros(0, np.int64)] * 2

    def encode_whole(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A for space + text and of B for text."""
        spaced = [" " + t for t in texts]
        if self.fast is not None:
            a = list(map(self.fast.encode_ordinary, spaced))
        else:
            a = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        return a, self.b.encode(texts, num_threads=1) if texts else []

    def _matches(self, text: str, a: list[int], b: list[int]) -> bool:
        raw = (" " + text).encode("utf-8", "surrogatepass")
        return b"".join(map(self.a_bytes.__getitem__, a)) == raw == b"".join(map(self.b_bytes.__getitem__, b))

    def _learn(self, parts: list[str]) -> None:
        for at in range(0, len(parts), PARTS):
            some = parts[at : at + PARTS]
            found = self.encode_whole(some)
            raw = "".join([" " + part for part in some]).encode("utf-8", "surrogatepass")
            right = np.ones(len(some), bool)
            count, flat = [], []
            for ids, names in zip(found, (self.a_bytes, self.b_bytes)):
                count.append(np.fromiter(map(len, ids), np.int64, len(ids)))
                flat.append(np.fromiter(chain.from_iterable(ids), np.int32, int(count[-1].sum())))
                # All parts together first: where that fails, each by itself.
                if b"".join(map(names.__getitem__, flat[-1].tolist())) != raw:
                    right = np.array([self._matches(*three) for three in zip(some, *found)])
            self.right = np.concatenate((self.right, right))
            for side in (0, 1):
                ends = np.cumsum(count[side])
                self.begin[side] = np.concatenate((self.begin[side], len(self.flat[side]) + ends - count[side]))
                self.count[side] = np.concatenate((self.count[side], count[side]))
                self.flat[side] = np.concatenate((self.flat[side], flat[side]))
            self.known.update(zip(some, range(len(self.known), len(self.known) + len(some))))

    def encode(self, texts: list[str]) -> tuple[Tokens, Tokens]:
        """Tokens of A and B; texts without both, or whose bytes they do not give back, have none."""
        parts: list[list[str] | None] = [None if not t or INNER_SPACE.search(" " + t) else t.split(" ") for t in texts]
        met = set().union(*(p for p in parts if p))
        if len(self.known) > self.cache:
            self._forget()
        # An empty part is a single space: the last one of a text.
        self._learn([p for p in met if p not in self.known])
        apart = [i for i, (t, p) in enumerate(zip(texts, parts)) if t and p is None]
        whole = {i: both for i, *both in zip(apart, *self.encode_whole([texts[i] for i in apart])) if self._matches(texts[i], *both)}
        size = np.array([len(p) if p else 0 for p in parts], np.int64)
        which = np.fromiter(map(self.known.__getitem__, chain.from_iterable(p for p in parts if p)), np.int64, int(size.sum()))
        # Texts with a part whose bytes do not come back have no tokens at all.
        owner = np.repeat(np.arange(len(texts)), size)
        fine = np.bincount(owner, ~self.right[which], len(texts))[owner] == 0
        which, owner = which[fine], owner[fine]
        both = []
        for side, length in enumerate((self.a_length, self.b_length)):
            count = self.count[side][which]
            flat = self.flat[side][spread(self.begin[side][which], count)].astype(np.int64)
            counts = np.bincount(owner, count, len(texts)).astype(np.int64)
            if whole:
                each = np.split(flat, np.cumsum(counts)[:-1])
                for i, ids in whole.items():
                    each[i] = np.array(ids[side], np.int64)
                    counts[i] = len(each[i])
                flat = np.concatenate(each)
            both.append(Tokens(flat, length[flat], counts))
        return both[0], both[1]


@dataclass
class Aligned:
    """Cuts and links of the documents of a batch.

    ``cuts``: per group its document, first and last token of A and of B (places in the batch); by document and place.
    ``links``: document, A id, B id and how many token pairs of the document have them; one entry per such pair of ids.
    """

    cuts: np.ndarray
    documents: np.ndarray
    codes: np.ndarray
    times: np.ndarray


def lanes(a: Tokens, b: Tokens, lane: int = LANE) -> np.ndarray:
    """(document, first A, end A, first B, end B) of stretches that are merged for themselves.

    A long text is parted where a token of A, near every ``lane``-th one, ends where a token of B does; without such a
    place the stretch is longer.
    """
    rows = []
    for doc, (n, m) in enumerate(zip(a.counts.tolist(), b.counts.tolist())):
        if not n:
            continue
        at, bt = int(a.first[doc]), int(b.first[doc])
        ea, eb = a.ends[at : at + n], b.ends[bt : bt + m]
        starts = [(0, 0)]
        if n > 2 * lane:
            tries = (np.arange(lane, n - lane, lane)[:, None] + np.arange(16)).clip(max=n - 1)
            place = np.searchsorted(eb, ea[tries])
            common = eb[np.minimum(place, m - 1)] == ea[tries]
            first = common.argmax(axis=1)
            some = np.flatnonzero(common.any(axis=1))
            starts += [(int(tries[k, first[k]]) + 1, int(place[k, first[k]]) + 1) for k in some]
        starts = sorted(set(starts))
        for (i, j), (k, l) in zip(starts, [*starts[1:], (n, m)]):
            if k > i:
                rows.append((doc, at + i, at + k, bt + j, bt + l))
    return np.array(rows, np.int64).reshape(-1, 5)


def align(a: Tokens, b: Tokens, lane: int = LANE) -> Aligned:
    """Merge the tokens of all documents in lockstep.

    One state vector holds a pointer into A's tokens and one into B's for every lane. At each step the pointer whose
    token ends first goes on; where both end together there is a cut, its links are emitted and both go on. Lanes that
    have come to their end are taken out of the vector.
    """
    state = lanes(a, b, lane)
    doc, i, i_end, j, _ = (state[:, k].copy() for k in range(5))
    i0, j0 = i.copy(), j.copy()
    cuts, links, large = [], [], []
    while len(doc):
        ea, eb = a.ends[i], b.ends[j]
        cut = np.flatnonzero(ea == eb)
        if len(cut):
            d, p, q, r, s = doc[cut], i0[cut], i[cut], j0[cut], j[cut]
            cuts.append((d, p, q, r, s))
            links.append((d, a.ids[q] << ID_BITS | b.ids[s]))
            more = np.flatnonzero((p < q) | (r < s))
            if len(more):
                # Last tokens are linked; the others of the group follow.
                d, p, q, r, s = d[more], p[more], q[more], r[more], s[more]
                height = s - r + 1
                many = (q - p + 1) * height
                if (many > SINGLE_LINKS).any():
                    large.extend(zip(*(x[many > SINGLE_LINKS].tolist() for x in (d, p, q, r, s))))
                    few = many <= SINGLE_LINKS
                    d, p, r, height, many = d[few], p[few], r[few], height[few], many[few]
                rest = many - 1
                within, tall = spread(np.zeros(len(rest), np.int64), rest), np.repeat(height, rest)
                left, right = a.ids[np.repeat(p, rest) + within // tall], b.ids[np.repeat(r, rest) + within % tall]
                links.append((np.repeat(d, rest), left << ID_BITS | right))
        i += ea <= eb
        j += eb <= ea
        i0[cut], j0[cut] = i[cut], j[cut]
        going = i < i_end
        if not going.all():
            doc, i, i_end, j, i0, j0 = doc[going], i[going], i_end[going], j[going], i0[going], j0[going]
    joined = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    every = np.stack([joined([x[k] for x in cuts]) for k in range(5)])
    # A document and its pair of ids as one number: equal ones are the times of a pair.
    keys = np.sort(joined([x[0] for x in links]) << 2 * ID_BITS | joined([x[1] for x in links]))
    keys, times = _summed(keys, np.ones(len(keys), np.int64))
    for d, p, q, r, s in large:
        left, n = np.unique(a.ids[p : q + 1], return_counts=True)
        right, m = np.unique(b.ids[r : s + 1], return_counts=True)
        product = n[:, None] * m[None, :]
        # The last tokens have been linked already.
        product[np.searchsorted(left, a.ids[q]), np.searchsorted(right, b.ids[s])] -= 1
        more = (d << 2 * ID_BITS | left[:, None] << ID_BITS | right[None, :]).reshape(-1)
        keys, times = np.concatenate((keys, more)), np.concatenate((times, product.reshape(-1)))
        order = np.argsort(keys, kind="stable")
        keys, times = _summed(keys[order], times[order])
    return Aligned(every[:, np.argsort(every[1])], keys >> 2 * ID_BITS, keys & ((1 << 2 * ID_BITS) - 1), times)


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of sorted ones, with the sums of their times."""
    if not len(keys):
        return keys, times
    new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[new], np.add.reduceat(times, new)


class Groups:
    """Groups of tokens as text: ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, size: int):
        self.size = size
        names = [b"%d%b" % (i, separator) for separator in (b",", b"|", b";") for i in range(size)]
        self.length = np.array(list(map(len, names)))
        width = int(self.length.max())
        self.letters = np.array(names, f"S{width}").view(np.uint8).reshape(-1, width)
        self.used = np.arange(width) < self.length[:, None]

    def text(self, ids_a: np.ndarray, ids_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> str:
        """The text for ids of a document, and the places of the last tokens of its groups."""
        n, m = len(ids_a), len(ids_b)
        if not n:
            return ""
        sep_a, sep_b = np.zeros(n, np.int64), np.zeros(m, np.int64)
        sep_a[last_a], sep_b[last_b] = 1, 2
        # A token of A stands behind the tokens of B of earlier groups; a token of B behind those of A of its own group.
        group_a, group_b = np.cumsum(sep_a == 1) - (sep_a == 1), np.cumsum(sep_b == 2) - (sep_b == 2)
        behind = np.concatenate(([0], last_b + 1))
        names = np.empty(n + m, np.int64)
        names[np.arange(n) + behind[group_a]] = ids_a + sep_a * self.size
        names[np.arange(m) + last_a[group_b] + 1] = ids_b + sep_b * self.size
        return self.letters[names][self.used[names]].tobytes()[:-1].decode()


FIELDS = (
    "n_a long, n_b long, n_groups long, n_links long, groups string, pack long, places binary, times binary, pack_codes binary, pack_counts binary"
)


def aligned_texts(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: doc_id, n_a, n_b, n_groups, n_links, groups (text) and, packed, the id pairs that are linked.

    Documents that follow each other in a task form a pack of bounded size. A row's ``places`` (into the codes of its
    pack) and ``times`` are its linked id pairs and how often; one row of the pack has the distinct codes of all its
    documents (A id in the upper bits, B id in the lower) and how many documents hold each.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL(FIELDS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = TwoTokenizers(a_path, b_path)
        groups = Groups(max(len(tokenizers.a_bytes), len(tokenizers.b_bytes)))
        pack = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column("text").to_pylist()
            first = 0
            while first < len(texts):
                size, end = 0, first
                while end < len(texts) and (end == first or size + len(texts[end]) <= PACK_BYTES) and end - first < PACK_DOCUMENTS:
                    size += len(texts[end])
                    end += 1
                ids = batch.column("doc_id").slice(first, end - first)
                yield _packed(tokenizers, groups, ids, texts[first:end], pack, schema)
                first, pack = end, pack + 1

    return rows.mapInArrow(run, schema)


def _packed(tokenizers: TwoTokenizers, groups: Groups, ids: pa.Array, texts: list[str], pack: int, schema: T.StructType) -> pa.RecordBatch:
    a, b = tokenizers.encode(texts)
    found = align(a, b)
    n = len(texts)
    doc, p, q, r, s = found.cuts
    n_groups = np.bincount(doc, minlength=n)
    n_links = np.zeros(n, np.int64)
    np.add.at(n_links, doc, (q - p + 1) * (s - r + 1))
    first_cut = np.concatenate(([0], np.cumsum(n_groups)))
    shown = []
    for i in range(n):
        own = slice(first_cut[i], first_cut[i + 1])
        at, bt = a.first[i], b.first[i]
        shown.append(groups.text(a.ids[at : at + a.counts[i]], b.ids[bt : bt + b.counts[i]], q[own] - at, s[own] - bt))
    codes = np.unique(found.codes)
    places = np.searchsorted(codes, found.codes)
    counts = np.bincount(places, minlength=len(codes))
    each = np.concatenate(([0], np.cumsum(np.bincount(found.documents, minlength=n))))
    places, times = places.astype(np.int32), found.times
    pieces = lambda values: [values[each[i] : each[i + 1]].tobytes() for i in range(n)]
    head = lambda values: [values.tobytes(), *[None] * (n - 1)]
    columns = [
        ids, a.counts, b.counts, n_groups.astype(np.int64), n_links, shown, np.full(n, pack), pieces(places), pieces(times), head(codes),
        head(counts.astype(np.int32)),
    ]
    kinds = [ids.type, *[pa.int64()] * 4, pa.string(), pa.int64(), *[pa.binary()] * 4]
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, [f.name for f in schema])


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pack, codes, counts in zip(*(batch.column(name).to_pylist() for name in ("pack", "pack_codes", "pack_counts"))):
            values = np.frombuffer(codes, np.int64)
            columns = [pa.array(np.full(len(values), pack)), pa.array(values), pa.array(np.frombuffer(counts, np.int32).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["pack", "code", "n"])


def with_counts(aligned: DataFrame) -> DataFrame:
    """The kept rows of ``aligned_texts`` with n_best and count_sum, from the counts of id pairs over all documents.

    Pairs are counted from the packs' sums; each pack then gets the counts of its own pairs, and only those.
    """
    packs = aligned.filter(F.col("pack_codes").isNotNull()).select("pack", "pack_codes", "pack_counts")
    opened = packs.mapInArrow(_opened, "pack long, code long, n long")
    total = opened.groupBy("code").agg(F.sum("n").alias("documents"))
    total = keep(total.withColumn("a_id", F.shiftright("code", ID_BITS)))
    highest = total.groupBy("a_id").agg(F.max("documents").alias("highest"))
    told = keep(total.join(highest, "a_id").select("code", "documents", (F.col("documents") == F.col("highest")).alias("best")))
    own = opened.select("pack", "code").join(told, "code").select("pack", "code", "documents", "best")
    rows = aligned.drop("pack_codes", "pack_counts")
    schema = T.StructType([f for f in rows.schema if f.name not in ("pack", "places", "times")])
    schema = schema.add("n_best", "long").add("count_sum", "long")

    def tell(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        # Places count in the order of the codes.
        theirs = theirs.sort_values("code")
        count, best = theirs["documents"].to_numpy(np.int64), theirs["best"].to_numpy(bool)
        sums = []
        for places, times in zip(mine["places"], mine["times"]):
            at, n = np.frombuffer(places, np.int32), np.frombuffer(times, np.int64)
            sums.append((int(n[best[at]].sum()), int((n * count[at]).sum())))
        mine = mine.assign(n_best=[s[0] for s in sums], count_sum=[s[1] for s in sums])
        return mine[[f.name for f in schema]]

    # A pack is bounded, and so are its rows on both sides.
    return rows.groupBy("pack").cogroup(own.groupBy("pack")).applyInPandas(tell, schema)


def link_digest(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    A is a byte-level BPE file, B a piece model with byte fallback; both are opened by every executor. Byte offsets in
    space + text where tokens of both end part the tokens into groups, and all tokens of A and B in a group are linked.
    An id pair's count is the number of input rows that hold it linked; ``n_best`` are the links whose count is the
    highest of their A id, ties included, ``count_sum`` is the sum of the counts of all links.

    Null and empty texts, and texts that the tokens do not give back, have no tokens: zeros and an empty groups_sha256.
    Repeated rows count once each and get equal answers, ids may be null, an empty table gives an empty result, and
    other columns are not looked at. A group of any size is handled; its links are then counted by their ids.
    """
    rows = aligned_texts(docs, a_path, b_path, id_col, text_col)
    groups = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    kept = keep_in_batches(rows.withColumn("groups", groups).withColumnRenamed("groups", "groups_sha256"), PACK_DOCUMENTS)
    return with_counts(kept).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
