"""Token counts of whole texts: huge ones as overlapping chunks, spliced where both encodings are sure to agree."""

import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystrata.llm.common import keep_in_batches, text_of

HUGE = 32_768
CHUNK = 16_384
OVERLAP = 512
# Decisions about the text before a boundary never look at as many characters after it: a contraction looks at two,
# a run of white space at one, and the longest special string in a vocabulary must be shorter.
MARGIN = 64
TOKEN_LIMIT = 1024
CACHE = 400_000
BATCH_CHARS = 1_000_000

# A space that has white space on both sides (or the end): what stands around it decides how it is cut.
INNER_SPACE = re.compile(r"\s (?:\s|\Z)")


class Encoder:
    """A byte-level BPE file of the tokenizers library, without added special tokens.

    The library first cuts a text into pieces (at special strings, then by a pattern that matches from left to right and
    never looks back), then merges bytes within each piece. So a cut between pieces that is right stays right whatever
    text comes before it, and what follows it depends on nothing before it.
    """

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP, huge: int = HUGE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.chunk, self.overlap, self.huge = chunk, overlap, huge
        self.known: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        result = [0] * len(texts)
        short, size = [], 0
        for i, text in enumerate(texts):
            if len(text) > self.huge:
                result[i] = self.spliced(text)
                continue
            short.append(i)
            size += len(text)
            if size > BATCH_CHARS:
                self._by_words(texts, short, result)
                short, size = [], 0
        self._by_words(texts, short, result)
        return result

    def _lengths(self, texts: list[str]) -> list[int]:
        encoded = (self.tokenizer.encode_batch_fast(texts[i : i + 2000], add_special_tokens=False) for i in range(0, len(texts), 2000))
        return [len(e) for batch in encoded for e in batch]

    def _by_words(self, texts: list[str], which: list[int], result: list[int]) -> None:
        """Counts of texts as sums over their parts between spaces, each part encoded once.

        A piece starts at the first space of a run of white space, and at its last one if a word follows. So every
        space starts a piece unless it has white space on both sides, and texts with such spaces are encoded whole.
        """
        whole = [i for i in which if INNER_SPACE.search(texts[i])]
        for i, n in zip(whole, self._lengths([texts[i] for i in whole])):
            result[i] = n
        skip = set(whole)
        parts = {i: texts[i].split(" ") for i in which if i not in skip}
        first = [p[0] for p in parts.values()]
        for i, n in zip(parts, self._lengths(first)):
            result[i] = n
        if len(self.known) > CACHE:
            self.known.clear()
        new = list(set().union(*(p[1:] for p in parts.values())).difference(self.known)) if parts else []
        self.known.update(zip(new, self._lengths([" " + p for p in new])))
        for i, p in parts.items():
            result[i] += sum(map(self.known.__getitem__, p[1:]))

    def _marks(self, text: str, begin: int, end: int) -> tuple[dict[int, int], int]:
        """Places in the text where a piece of text[begin:end] starts, with the tokens before it; and all tokens."""
        encoding = self.tokenizer.encode(text[begin:end], add_special_tokens=False)
        marks: dict[int, int] = {}
        last = None
        for i, (piece, (at, _)) in enumerate(zip(encoding.word_ids, encoding.offsets)):
            if piece != last:
                marks[begin + at] = i
                last = piece
        return marks, len(encoding.ids)

    def spliced(self, text: str) -> int:
        """Tokens of one text, never encoding much more than a chunk at once.

        Chunks overlap. The earlier one is right from a proven place on, up to a margin before its end; if a piece of
        the later one starts where a piece of the earlier one does, the later one is right from there on. Without such
        a place the later chunk starts further left, at the proven place at last.
        """
        n, total = len(text), 0
        sure, end = 0, min(self.chunk, len(text))
        marks, tokens = self._marks(text, 0, end)
        while end < n:
            overlap, common = self.overlap, None
            after = min(n, end + self.chunk - min(self.overlap, self.chunk // 2))
            while common is None:
                begin = max(sure, end - overlap)
                later, later_tokens = self._marks(text, begin, after)
                both = [at for at in later if at in marks and sure <= at <= end - MARGIN]
                if both:
                    common = max(both)
                elif begin == sure:
                    common = sure
                overlap *= 2
            total += marks[common] - marks[sure]
            sure, end, marks, tokens = common, after, later, later_tokens
        return total + tokens - marks[sure]


def count_tokens(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = TOKEN_LIMIT,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    huge: int = HUGE,
) -> DataFrame:
    """Per input row: doc_id, n_bytes, n_tokens, over_limit, as the tokenizers library counts the whole text.

    ``path`` is a byte-level BPE file that every executor can open. One pass without a shuffle. Null and empty texts
    have no bytes and no tokens. Special strings in a text count as the library does by default: as one token. Repeated
    rows get equal answers, ids may be null, an empty table gives an empty result, and other columns are not looked at.
    """

    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(path, chunk, overlap, huge)
        for texts in batches:
            yield pd.Series(encoder.counts(texts.tolist()), dtype="int64")

    tokens = F.pandas_udf(counted, "long")
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), tokens(text).alias("n_tokens"))
    return keep_in_batches(rows).withColumn("over_limit", F.col("n_tokens") > limit)
