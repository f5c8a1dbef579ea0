"""Token counts by a whole-token shortcut.

Offline, each vocabulary string that can stand for a whole pre-token is run
through the merges alone; those that come back as one token are *proven*. Counting then needs no
merge for a pre-token in the proven set; only the rest goes through the merges.

The vocabulary in use drops white space, so a text is counted piece by piece
between spaces, and a piece that occurs again is looked up.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Pieces kept per worker: a bound of memory, not of the result.
KEPT = 1_000_000

#: Pieces of visible ASCII and of Latin-1 letters are cut here by the vocabulary's
#: own rules (lower case, contractions, letters, digits, the rest); in that range
#: they are plain. All others go through the library's parts.
PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
CUT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+").findall
#: Bytes that are visible in Latin-1 stand for themselves, the others for the characters from 256 on.
VISIBLE = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
BYTE_CHARS = {b: chr(b) for b in VISIBLE} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in VISIBLE)}
#: The two characters that stand for the two bytes of a Latin-1 letter in a byte-level vocabulary.
SPELLED = {c: "".join(BYTE_CHARS[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


def load(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def proven(tokenizer) -> frozenset[str]:
    """Vocabulary strings, without the word end, that the merges turn into one token."""
    end = tokenizer.model.end_of_word_suffix or ""
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    whole = (s[: len(s) - len(end)] for s in tokenizer.get_vocab(with_added_tokens=True) if s.endswith(end) and s not in special)
    return frozenset(s for s in whole if s and len(tokenizer.model.tokenize(s)) == 1)


class Counter:
    """Counts the tokens of texts exactly as the tokenizer would."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.single = proven(self.tokenizer)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # taken once: each access to a part of the tokenizer is dear
        self.normal, self.split, self.merge = (
            self.tokenizer.normalizer.normalize_str, self.tokenizer.pre_tokenizer.pre_tokenize_str, self.tokenizer.model.tokenize)
        self.plain_rules = all(self.split(self.normal(x)) == [(y, (0, len(x)))] for x, y in (("Ab", "ab"), ("\u00c9", "\u00c3\u00a9")))
        self.seen: dict[str, int] = {}

    def piece(self, piece: str) -> int:
        """Tokens of a text without spaces."""
        if any(s in piece for s in self.special):  # cut out before any rule applies: leave it to the library
            return len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        single, merge = self.single, self.merge
        if self.plain_rules and PLAIN(piece):
            cut = CUT(piece.lower())
            if not piece.isascii():
                cut = [s.translate(SPELLED) for s in cut]
        else:
            cut = [s for s, _ in self.split(self.normal(piece))]
        n = 0
        for s in cut:
            n += 1 if s in single else len(merge(s))
        return n

    def text(self, text: str) -> int:
        pieces, seen = text.split(" "), self.seen
        counts = list(map(seen.get, pieces))
        if None in counts:
            if len(seen) > KEPT:
                seen.clear()
            for i, n in enumerate(counts):
                if n is None:
                    if (n := seen.get(pieces[i])) is None:
                        n = seen[pieces[i]] = self.piece(pieces[i])
                    counts[i] = n
        return sum(counts)


@functools.cache
def counter(path: str) -> Counter:
    return Counter(path)


def count(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """Bytes, tokens and whether they exceed ``limit``, one row per row of ``docs`` (doc_id, text).

    Null and empty texts have no bytes and no tokens. Texts are read whole, however
    long. Row-local, no shuffle; the vocabulary file must exist on every worker.
    Other columns are ignored; repeated rows are counted each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = counter(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            sizes = pa.compute.binary_length(batch.column(1).cast(pa.binary())).fill_null(0).cast(pa.int64())
            tokens = np.fromiter(map(of.text, texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(tokens), pa.array(tokens > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
