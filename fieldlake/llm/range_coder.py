"""Token ids in range-coded blocks.

A block holds up to ``BLOCK`` ids and is coded on its own: its header names the
ids that occur, then every id is coded by a mixture of three predictions that start
anew with the block: the id seen after the last two (order 2), the id seen after the
last one (order 1), and the adaptive frequency of ids (order 0). The mixture's
weights adapt by how often the two context predictions came true when as sure as now.
A range coder with carry turns ids into bytes; the header's checksum is verified on reading.

A long block is cut into up to 32 runs of consecutive ids, each with a range coder of
its own. They share the block's one model and are coded in step, an id of each at a
time: what one has met, all predict from. All blocks of a batch are coded in step too,
as numpy operations over the runs of all blocks: these need thousands of runs to be worth
their call. Models are integers (the one division of floats is exact), so both directions
agree everywhere.
"""

from __future__ import annotations

import functools
import itertools
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fieldlake.llm.common import tidy
from fieldlake.llm.token_counts import BYTE_CHARS, PLAIN, SPELLED, load
from fieldlake.session import stored

BLOCK = 8192
#: A block of n ids has n // RUN runs, one at least.
RUN = 256
#: Ids of a frame (the unit of a row): whole documents, until so many are together.
FRAME = 16 * BLOCK
#: Blocks held together, and about how many of them are coded in step: thousands of runs, whose models stay in a core's caches.
LANES, IN_STEP = 1024, 128
MAGIC = b"RCX2"
HEAD = struct.Struct("<4sIIII")

TOTAL_BITS, FREQ_BITS, HASH_BITS, FIND_BITS = 22, 16, 12, 11
TOTAL, MIXED = 1 << TOTAL_BITS, (1 << TOTAL_BITS) - (1 << 17)
LOWER = (1 << 32) - 1
WORD, SMALL, TOP = np.uint64(32), np.uint64(1 << 28), np.uint64(60)
#: Steps before which frequencies and weights are taken anew from what was met: these, and each multiple of ``EVERY``.
EARLY, EVERY = frozenset((0, 1, 2, 5, 12, 28)), 64


def _prior() -> np.ndarray:
    """Tried, order 2 right, order 1 alone right: counts to begin with, by state."""
    sure2, sure1, same = np.arange(32) >> 3, np.arange(32) >> 1 & 3, np.arange(32) & 1
    right = np.array([1, 9, 24, 42])
    return np.stack([np.full(32, 180), 3 * right[sure2], 3 * right[sure1] * (60 - right[sure2]) * (1 - same) // 60], 1)


class _Models:
    """The predictions of many blocks. Ids are places in a block's own list of ids; lane k is a run of block ``block[k]``."""

    def __init__(self, sizes: np.ndarray, block: np.ndarray, finding: bool = False):
        n = len(sizes)
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes  # of lists by id
        total = int(sizes.sum())
        self.rank = (np.arange(total) - np.repeat(self.starts, sizes)).astype(np.int32)
        self.counts = np.ones(total, np.int32)
        self.bounds = np.zeros(total, np.int64)  # of an id's part of 2^FREQ_BITS: upper * 2^32 + lower
        self.tally = np.tile(_prior(), (n, 1))
        self.shares = np.zeros(n << 5, np.int64)  # of order 2 * 2^32 + of order 1
        self.nearest = np.zeros(n << FIND_BITS if finding else 0, np.int16)
        self.one = np.zeros(total, np.int16)  # prediction * 4 + how often it was right, 0 to 3
        self.two = np.zeros(n << HASH_BITS, np.int16)
        self.base, self.at2, self.at_state, self.at_nearest = self.starts[block], block << HASH_BITS, block << 5, block << FIND_BITS
        self.x1, self.x2 = np.zeros(len(block), np.int64), np.zeros(len(block), np.int64)
        self.met = np.zeros((EVERY, len(block)), np.int32)  # since the last refresh; lanes at their end met nothing
        self.came = np.zeros((EVERY, len(block)), np.int32)
        self.rows = 0

    def step(self, t: int, n: int) -> None:
        """Predictions and weights of step ``t`` for the first ``n`` lanes."""
        if t % EVERY == 0 or t in EARLY:
            self._refresh()
        if n < len(self.base):
            for name in ("base", "at2", "at_state", "at_nearest", "x1", "x2"):
                setattr(self, name, getattr(self, name)[:n])
        self.i1 = self.base + self.x1
        self.i2 = ((self.x1 * 1327 + self.x2 * 2909) & ((1 << HASH_BITS) - 1)) + self.at2
        s1, s2 = self.one[self.i1], self.two[self.i2]
        self.g1, self.g2 = (s1 >> 2).astype(np.int64), (s2 >> 2).astype(np.int64)
        self.c1, self.c2 = s1 & 3, s2 & 3
        self.state = ((self.c2 << 3) + (self.c1 << 1) + (self.g1 == self.g2)) + self.at_state
        shares = self.shares[self.state]
        self.w2, self.w1 = shares >> 32, shares & LOWER
        self.w0 = TOTAL - self.w2 - self.w1

    def _refresh(self) -> None:
        """Parts by frequency (each id gets at least 1 of 2^FREQ_BITS) and weights from what was met."""
        if self.rows:
            self.counts += 24 * np.bincount(self.met[: self.rows].ravel(), minlength=len(self.counts) + 1)[:-1].astype(np.int32)
            came = np.bincount(self.came[: self.rows].ravel(), minlength=len(self.tally) * 4 + 4)[:-4].reshape(-1, 4)
            self.tally += 60 * np.stack([came.sum(1), came[:, 1] + came[:, 3], came[:, 2]], 1)
        self.rows = 0
        for a in range(0, len(self.sizes), 128):  # some blocks at a time: the steps in between are large
            sizes = self.sizes[a : a + 128]
            low, high = self.starts[a], self.starts[a] + sizes.sum()
            ends = self.starts[a : a + 128] + sizes - low - 1
            running = np.cumsum(self.counts[low:high], dtype=np.int32)
            until = running[ends]
            total = np.diff(until, prepend=0)
            running -= self.counts[low:high]
            running -= np.repeat(until - total, sizes)
            lower = (running * np.repeat(((1 << FREQ_BITS) - sizes) / total, sizes)).astype(np.int32)
            lower += self.rank[low:high]
            upper = np.empty(len(lower), np.int64)
            upper[:-1] = lower[1:]
            upper[ends] = 1 << FREQ_BITS
            self.bounds[low:high] = (upper << 32) + lower
            if len(self.nearest):  # the id at the lower end of each of 2^FIND_BITS equal steps
                first = (lower + ((1 << FREQ_BITS - FIND_BITS) - 1)) >> (FREQ_BITS - FIND_BITS)
                after = np.empty_like(first)
                after[:-1] = first[1:]
                after[ends] = 1 << FIND_BITS
                self.nearest[a << FIND_BITS : (a + len(sizes)) << FIND_BITS] = np.repeat(self.rank[low:high].astype(np.int16), after - first)
        shares = self.tally[:, 1:] * MIXED // self.tally[:, :1]
        self.shares = (shares[:, 0] << 32) + shares[:, 1]

    def find(self, t: np.ndarray) -> np.ndarray:
        """The id whose interval holds ``t``. A context's share lies at the lower end of its id's interval:
        with both taken out, ``t`` is a place in the share of order 0."""
        l2 = (((self.bounds[self.base + self.g2] & LOWER) * self.w0) >> FREQ_BITS) + self.w1 * (self.g1 < self.g2)
        l1 = ((self.bounds[self.base + self.g1] & LOWER) * self.w0) >> FREQ_BITS
        t = t - np.minimum(np.maximum(t - l2, 0), self.w2)
        t -= np.minimum(np.maximum(t - l1, 0), self.w1)
        share = ((((t + 1) << FREQ_BITS) - 1) / self.w0).astype(np.int64)  # below 2^39 by below 2^23: floor is exact
        x = self.nearest[(share >> (FREQ_BITS - FIND_BITS)) + self.at_nearest].astype(np.int64)
        at = self.base + x
        self.part = self.bounds[at]
        rest = np.flatnonzero((self.part >> 32) <= share)
        if rest.size:
            place, share = at[rest], share[rest]
            on = np.arange(len(rest))
            while on.size:
                place[on] += 1
                on = on[(self.bounds[place[on]] >> 32) <= share[on]]
            x[rest] += place - at[rest]
            self.part[rest] = self.bounds[place]
        return x

    def interval(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower bound and width; after ``find``, or with ``part`` set to the ids' bounds."""
        low = ((self.part & LOWER) * self.w0) >> FREQ_BITS
        width = (((self.part >> 32) * self.w0) >> FREQ_BITS) - low
        self.hit2, self.hit1 = x == self.g2, x == self.g1
        low += self.w2 * (x > self.g2)
        low += self.w1 * (x > self.g1)
        width += self.w2 * self.hit2
        width += self.w1 * self.hit1
        return low.view(np.uint64), width.view(np.uint64)

    def learn(self, x: np.ndarray) -> None:
        """After ``interval``. Runs of a block that meet the same context in a step: the last one's id stays."""
        n = len(x)
        fresh = ((x << 2) + 1).astype(np.int16)
        self.two[self.i2] = fresh + np.minimum(self.c2, 2) * self.hit2
        self.one[self.i1] = fresh + np.minimum(self.c1, 2) * self.hit1
        self.met[self.rows, :n] = self.base + x
        self.came[self.rows, :n] = (self.state << 2) + self.hit2 + (self.hit1 * np.int8(2))
        if n < self.met.shape[1]:
            self.met[self.rows, n:], self.came[self.rows, n:] = len(self.counts), len(self.tally) * 4
        self.rows += 1
        self.x2, self.x1 = self.x1, x


def _runs(lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Block and length of each run, longest first, and the runs of each block in order: equally long, but for the last."""
    number = np.maximum(lens // RUN, 1)
    size = -(-lens // number)
    block = np.repeat(np.arange(len(lens)), number)
    first = (np.arange(len(block)) - np.repeat(np.cumsum(number) - number, number)) * size[block]
    length = np.minimum(size[block], lens[block] - first)
    order = np.argsort(-length, kind="stable")
    lanes = np.split(np.argsort(order), np.cumsum(number)[:-1])
    return block[order], length[order], lanes


def _in_step(lens: list[int]) -> list[list[int]]:
    """Even groups of about ``IN_STEP`` blocks, by falling length."""
    order = sorted(range(len(lens)), key=lambda i: -lens[i])
    size = -(-len(order) // max(1, round(len(order) / IN_STEP)))
    return [order[at : at + size] for at in range(0, len(order), max(size, 1))]


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Each block of ids (none empty) as bytes."""
    out: list[bytes] = [b""] * len(blocks)
    for some in _in_step([len(b) for b in blocks]):
        for i, data in zip(some, _encode([blocks[i] for i in some]), strict=True):
            out[i] = data
    return out


class _Places:
    """The ids of a block and each id's place among them."""

    def __init__(self):
        self.occurs, self.place = np.zeros(1 << 16, bool), np.zeros(1 << 16, np.int16)

    def of(self, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if block.min() < 0 or block.max() >= len(self.occurs):
            return np.unique(block, return_inverse=True)
        self.occurs[block] = True
        ids = np.flatnonzero(self.occurs)
        self.occurs[ids] = False
        self.place[ids] = np.arange(len(ids))
        return ids, self.place[block]


def _encode(blocks: list[np.ndarray]) -> list[bytes]:
    own: list[np.ndarray] = []
    block, lens, lanes = _runs(np.array([len(b) for b in blocks]))
    x = np.zeros((len(block), lens[0]), np.int16)  # places are below BLOCK
    places = _Places()
    for b, mine in zip(blocks, lanes, strict=True):
        ids, at = places.of(b)
        own.append(ids)
        rows = np.zeros((len(mine), lens[mine[0]]), np.int16)
        rows.ravel()[: len(at)] = at
        x[mine, : rows.shape[1]] = rows
    x = np.ascontiguousarray(x.T)
    m = _Models(np.array([len(ids) for ids in own]), block)
    n = len(block)
    low, span = np.zeros(n, np.uint64), np.full(n, 1 << 60, np.uint64)
    words = np.zeros((n, int(lens[0]) + 4), np.uint32)
    used = np.zeros(n, np.int64)
    for t in range(int(lens[0])):
        while lens[n - 1] <= t:
            n -= 1
        now = x[t, :n].astype(np.int64)
        m.step(t, n)
        m.part = m.bounds[m.base + now]
        start, width = m.interval(now)
        r = span[:n] >> np.uint64(TOTAL_BITS)
        low[:n] += r * start
        np.multiply(r, width, out=span[:n])
        if (small := np.flatnonzero(span[:n] < SMALL)).size:
            _put(words, used, low, small)
            span[small] <<= WORD
        m.learn(now)
    low += SMALL - np.uint64(1)  # the least value of one word that lies in the span
    _put(words, used, low, np.arange(len(block)))
    out = []
    for b, ids, mine in zip(blocks, own, lanes, strict=True):
        steps = np.diff(ids, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4)
        listed = zlib.compress(steps.T.tobytes(), 6)  # first all low bytes
        crc = zlib.crc32(np.ascontiguousarray(b, "<u4"))
        head = HEAD.pack(MAGIC, len(b), len(ids), crc, len(listed)) + used[mine].astype("<u2").tobytes()
        out.append(head + listed + words[mine][_filled(used[mine], words.shape[1])].astype("<u4").tobytes())
    return out


def _filled(used: np.ndarray, width: int) -> np.ndarray:
    return np.arange(width) < used[:, None]


def _put(words: np.ndarray, used: np.ndarray, low: np.ndarray, lanes: np.ndarray) -> None:
    """Write the upper word of ``low``; a carry goes to the words before it."""
    now = low[lanes]
    over = lanes[now >> TOP != 0]
    at = used[over] - 1
    while over.size:
        words[over, at] += np.uint32(1)
        more = words[over, at] == 0
        over, at = over[more], at[more] - 1
    words[lanes, used[lanes]] = (now >> np.uint64(28)).astype(np.uint32)
    used[lanes] += 1
    low[lanes] = (now & (SMALL - np.uint64(1))) << WORD


def decode(blocks: list[bytes]) -> list[np.ndarray]:
    """The ids of each block; raises if a block is damaged."""
    out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(blocks)
    for some in _in_step([HEAD.unpack_from(b)[1] for b in blocks]):
        for i, ids in zip(some, _decode([blocks[i] for i in some]), strict=True):
            out[i] = ids
    return out


def _decode(blocks: list[bytes]) -> list[np.ndarray]:
    heads = [HEAD.unpack_from(b) for b in blocks]
    if any(h[0] != MAGIC or not 0 < h[1] <= BLOCK for h in heads):
        raise ValueError("not a block of ids")
    block, lens, lanes = _runs(np.array([h[1] for h in heads]))
    used = [np.frombuffer(b, "<u2", len(mine), HEAD.size).astype(np.int64) for b, mine in zip(blocks, lanes, strict=True)]
    n, wide = len(block), max(int(u.max()) for u in used) + 2
    words = np.zeros((n, wide), np.uint32)
    own = []
    for b, h, mine, u in zip(blocks, heads, lanes, used, strict=True):
        at = HEAD.size + 2 * len(mine)
        steps = np.frombuffer(zlib.decompress(b[at : at + h[4]]), np.uint8).reshape(4, -1)
        own.append(np.cumsum(np.ascontiguousarray(steps.T).view("<u4").ravel(), dtype=np.int64))
        rows = np.zeros((len(mine), wide), np.uint32)
        rows[_filled(u, wide)] = np.frombuffer(b, "<u4", offset=at + h[4])
        words[mine] = rows
    code = (words[:, 0].astype(np.uint64) << np.uint64(28)) | (words[:, 1] >> np.uint32(4))
    words[:, :-1] = (words[:, :-1] << np.uint32(28)) | (words[:, 1:] >> np.uint32(4))  # as they are taken in
    words, place = words.ravel(), np.arange(n) * wide + 1
    last = place + wide - 2
    m = _Models(np.array([len(u) for u in own]), block, finding=True)
    span = np.full(n, 1 << 60, np.uint64)
    x = np.zeros((lens[0], n), np.int16)
    for t in range(int(lens[0])):
        while lens[n - 1] <= t:
            n -= 1
        m.step(t, n)
        r = span[:n] >> np.uint64(TOTAL_BITS)
        now = m.find(np.minimum(code[:n] // r, np.uint64(TOTAL - 1)).view(np.int64))
        start, width = m.interval(now)
        code[:n] -= r * start
        np.multiply(r, width, out=span[:n])
        if (small := np.flatnonzero(span[:n] < SMALL)).size:
            at = place[small]
            code[small] = (code[small] << WORD) | words[at]
            place[small] = np.minimum(at + 1, last[small])
            span[small] <<= WORD
        m.learn(now)
        x[t, :n] = now
    x = np.ascontiguousarray(x.T)
    out = []
    for ids, h, mine in zip(own, heads, lanes, strict=True):
        got = ids[x[mine, : lens[mine[0]]].ravel()[: h[1]]].astype("<u4")
        if zlib.crc32(got) != h[3]:
            raise ValueError("a block does not have its checksum")
        out.append(got)
    return out


# -- ids of texts ------------------------------------------------------------------------

#: The vocabulary's own cuts for visible ASCII and Latin-1 letters (see ``token_counts``): a space goes with what follows.
LETTER = "a-zA-ZÀ-ÖØ-öø-ÿ"
CUT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[0-9]+| ?[^ {LETTER}0-9]+").findall
SPELLED_SPACED = SPELLED | {32: BYTE_CHARS[32]}
SPELLED_BYTES = BYTE_CHARS | {0: "\0"}
#: Classes of bytes for the same cuts over whole texts, white space too. Bytes of Latin-1 letters are told by their neighbours.
OTHER, LETTERS, DIGITS, MARKS, SPACE, WHITE = range(6)
CLASSES = bytes(
    LETTERS if chr(c).isalpha() else DIGITS if chr(c).isdigit() else MARKS if 33 <= c <= 126 else SPACE if c == 32 else WHITE if 9 <= c <= 13 else OTHER
    for c in range(128)) + bytes([OTHER] * 128)


def _classes(data: np.ndarray) -> np.ndarray:
    out = np.frombuffer(bytearray(data.tobytes().translate(CLASSES)), np.uint8)
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] >= 0x80) & (data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]  # not the signs of times and division
    out[lead] = out[lead + 1] = LETTERS
    return out


def _words(data: np.ndarray, kind: np.ndarray, starts: np.ndarray, lasts: np.ndarray) -> np.ndarray:
    """Where words start in texts without bytes of class ``OTHER``, given where these start and their last bytes.

    A word takes one space before it. Of several white bytes before a word the last one stands
    alone, if it is no space, and those before it are one word. Contractions only start a run of marks.
    """
    before, after = np.empty_like(kind), np.empty_like(kind)
    before[1:], after[:-1] = kind[:-1], kind[1:]
    before[starts], after[lasts] = OTHER, WHITE
    white = kind >= SPACE
    cut = np.where(white, (before < SPACE) | (after < SPACE), (kind != before) & (before != SPACE))
    at = np.flatnonzero((data == 39) & (before != MARKS) & (before != SPACE) & (after == LETTERS))
    if at.size:
        first = data[at + 1]
        more = np.where(after[at + 1] == LETTERS, data[np.minimum(at + 2, len(data) - 1)], 0)
        short = np.isin(first, list(b"stmd"))
        long = np.isin(first.astype(np.int64) << 8 | more, [c[0] << 8 | c[1] for c in (b"re", b"ve", b"ll")])
        for some, n in ((at[short], 2), (at[long], 3)):
            cut[some + 1] = False
            cut[(some + n)[after[some + n - 1] == LETTERS]] = True
    return np.flatnonzero(cut)


def _gather(flat: np.ndarray, at: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``numbers`` of those that lie in ``flat`` from ``at`` on, one behind the other, and their ends."""
    count = at[numbers + 1] - at[numbers]
    ends = np.cumsum(count)
    return flat[np.repeat(at[numbers] - (ends - count), count) + np.arange(count.sum())], ends


class Encoder:
    """Ids of whole texts as the tokenizer gives them; a word that occurs again is looked up.

    Texts of ASCII and Latin-1 letters are cut into words together, as bytes. Others are
    cut at spaces alone. A worker keeps words from task to task, ``KEPT`` and a slice's at most (some 150 MB).
    """

    KEPT = 800_000

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, self.specials)) or "(?!)").search
        self.merge = self.tokenizer.model.tokenize
        whole = self.tokenizer.encode(" It's Été, 12", add_special_tokens=False).ids
        self.plain_rules = self.tokenizer.normalizer is None and whole == self._plain(" It's") + self._plain(" Été,") + self._plain(" 12")
        self.clear()

    def clear(self) -> None:
        self.seen: dict[str, int] = {}
        self.words: dict[bytes, int] = {}
        self.flat, self.at = array("i"), array("q", [0])
        self.again = np.zeros(0, bool)  # by number, whether a word was met in a later slice of texts

    def _plain(self, piece: str) -> list[int]:
        return [t.id for s in CUT(piece) for t in self.merge(s.translate(SPELLED_SPACED))]

    def _add(self, ids: list[int]) -> int:
        self.flat.extend(ids)
        self.at.append(len(self.flat))
        return len(self.at) - 2

    def _piece(self, piece: str) -> int:
        """The number of a piece with its space; -1 if its ids depend on what stands around it."""
        bare = piece[1:] if piece[:1] == " " else piece
        if not piece:
            n = self._add([])
        elif not bare or bare[0].isspace() or bare[-1].isspace() or self.special(piece):
            n = -1
        elif self.plain_rules and PLAIN(bare):
            n = self._add(self._plain(piece))
        else:
            n = self._add(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        self.seen[piece] = n
        return n

    def _pieces(self, text: str) -> list[int]:
        """The numbers of a text's pieces."""
        get, piece = self.seen.get, self._piece
        pieces = text.replace(" ", "\0 ").split("\0") if "\0" not in text else ["  "]
        found = list(map(get, pieces))
        if None in found:
            found = [n if n is not None else known if (known := get(p)) is not None else piece(p) for p, n in zip(pieces, found, strict=True)]
        return found if -1 not in found else [self._add(self.tokenizer.encode(text, add_special_tokens=False).ids)]

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        found = np.fromiter(map(self.words.get, words, itertools.repeat(-1)), np.int64, len(words))
        self.again[found[found >= 0]] = True
        if (missing := np.flatnonzero(found < 0)).size:
            new = [words[i] for i in missing.tolist()]
            found[missing] = np.arange(len(new)) + len(self.at) - 1
            self.words.update(zip(new, found[missing].tolist(), strict=True))
            merge, extend, end = self.merge, self.flat.extend, self.at.append
            for spelled in b"\0".join(new).decode("latin-1").translate(SPELLED_BYTES).split("\0"):
                extend([t.id for t in merge(spelled)])
                end(len(self.flat))
            self.again = np.append(self.again, np.zeros(max(len(self.at) - len(self.again), 0), bool))
        return found

    def _forget(self) -> None:
        """Keep only the words that were met in more than one slice of texts, if they are less than half of all."""
        kept = [(w, n) for w, n in self.words.items() if self.again[n]]
        numbers = np.array([n for _, n in kept], np.int64)
        ids, ends = _gather(np.array(self.flat), np.array(self.at), numbers)
        self.clear()
        if 0 < len(kept) <= self.KEPT // 2:
            self.words = {w: n for n, (w, _) in enumerate(kept)}
            self.flat.frombytes(ids.tobytes())
            self.at.frombytes(ends.tobytes())
            self.again = np.zeros(len(self.at), bool)

    def texts(self, texts: list[str] | pa.Array, end: int) -> list[np.ndarray]:
        """The ids of each text (null: empty), with the end id."""
        if not len(texts):
            return []
        if len(self.seen) + len(self.words) > self.KEPT or len(self.flat) > 20_000_000:
            self._forget()
        column = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).fill_null("").cast(pa.large_binary())
        stop = self._add([end])
        places = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[places[0] : places[-1]]
        places = places - places[0]
        kind = _classes(data)
        whole = np.ones(len(column), bool)
        whole[np.searchsorted(places, np.flatnonzero(kind == OTHER), "right") - 1] = False
        for s in self.specials:
            whole &= ~pa.compute.match_substring(column, s.encode()).to_numpy(zero_copy_only=False)
        if not self.plain_rules:
            whole[:] = False
        if not whole.all():
            kept = np.repeat(whole, np.diff(places))
            data, kind = data[kept], kind[kept]
        sizes = np.diff(places) * whole
        ends = np.cumsum(sizes)
        some = sizes > 0
        cuts = _words(data, kind, (ends - sizes)[some], ends[some] - 1) if len(data) else np.empty(0, np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(cuts), [None, pa.py_buffer(np.append(cuts, len(data))), pa.py_buffer(np.ascontiguousarray(data))])
        words = words.dictionary_encode()
        which = self._numbers(words.dictionary.to_numpy(zero_copy_only=False).tolist())[words.indices.to_numpy()]
        after = np.searchsorted(cuts, ends)  # words up to the end of each text
        numbers = np.insert(which, after, stop)
        ends_at = after + np.arange(1, len(column) + 1)
        if not whole.all():
            pieces, last = [], 0
            for i, n in enumerate(ends_at.tolist()):
                pieces.append(numbers[last:n] if whole[i] else np.array([*self._pieces(column[i].as_py().decode()), stop], np.int64))
                last = n
            numbers, ends_at = np.concatenate(pieces), np.cumsum([len(p) for p in pieces])
        at, flat = np.frombuffer(self.at, np.int64), np.frombuffer(self.flat, np.int32)
        ids, ends = _gather(flat, at, numbers)
        del at, flat  # they lock the arrays
        return np.split(ids, ends[ends_at - 1][:-1])


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


# -- files ------------------------------------------------------------------------

FILE = "part int, frame int, before long, n_tokens long, doc_ids array<{id}>, doc_tokens array<long>, blocks array<binary>"


def write(docs: DataFrame, path: str, tokenizer: str, end: int = 2, together: int = LANES) -> None:
    """Write the ids of ``docs`` (doc_id, text) in ascending doc_id order below ``path``.

    A file holds one range of ids; its rows are frames of whole documents with their
    ids' blocks, in order. Null texts count as empty: the end id alone. Rows of one
    doc_id are kept each, ordered by a hash of their text; null ids come first. The
    files go through Spark's commit protocol, so a lost task is written again whole.
    About ``together`` blocks are coded in step: fewer need less memory and more time,
    and give the same files.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, frames, before = TaskContext.get().partitionId(), 0, 0
        of = encoder(tokenizer)
        names = [f.split()[0] for f in FILE.split(", ")]
        ids: list = []
        held: list[np.ndarray] = []
        waiting: list[tuple[list, list[np.ndarray]]] = []

        def out() -> pa.RecordBatch:
            nonlocal frames, before
            sizes = [[len(a) for a in arrays] for _, arrays in waiting]
            joined = []
            for _, arrays in waiting:
                joined.append(np.concatenate(arrays))
                arrays.clear()
            cut = [[x[i : i + BLOCK] for i in range(0, len(x), BLOCK)] for x in joined]
            coded = iter(encode([b for blocks in cut for b in blocks]))
            rows = []
            for (own, _), counts, x, blocks in zip(waiting, sizes, joined, cut, strict=True):
                rows.append((part, frames, before, len(x), own, counts, [next(coded) for _ in blocks]))
                frames, before = frames + 1, before + len(x)
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(id_type), pa.list_(pa.int64()), pa.list_(pa.binary())]
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

        id_type = None
        for batch in batches:
            id_type = batch.column(0).type
            for some in _slices(batch):
                arrays = of.texts(some.column(1), end)
                for i, a in zip(some.column(0).to_pylist(), arrays, strict=True):
                    ids.append(i)
                    held.append(a)
                    if sum_ := _enough(held):
                        waiting.append((ids, held))
                        ids, held = [], []
                        if sum(map(_blocks, waiting)) >= together:
                            yield out()
        if held:
            waiting.append((ids, held))
        if waiting:
            yield out()

    text_hash = F.xxhash64("text")
    ordered = docs.select("doc_id", "text", text_hash.alias("h")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    ordered.select("doc_id", "text").mapInArrow(tidy(run), FILE.format(id=kind)).write.parquet(path)


def _slices(batch: pa.RecordBatch, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Some rows at a time: texts of up to ``size`` bytes, one row at least."""
    ends = np.cumsum(pa.compute.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(batch):
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + size, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def _enough(held: list[np.ndarray]) -> bool:
    return len(held[-1]) >= FRAME or len(held) % 16 == 0 and sum(map(len, held)) >= FRAME


def _blocks(frame: tuple[list, list[np.ndarray]]) -> int:
    return sum(map(len, frame[1])) // BLOCK + 1


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32 and ids.

    Every block is decoded and its checksum verified.
    """
    return _read(spark, path, True)


def digests(spark: SparkSession, path: str, together: int = LANES) -> DataFrame:
    """As ``read``, without the ids: they stay in the task that decodes them. ``together`` as in ``write``."""
    return _read(spark, path, False, together)


def _read(spark: SparkSession, path: str, whole: bool, together: int = LANES) -> DataFrame:
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    sums = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored(sums.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")), "id-offsets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            while at < len(batch):
                size, lanes = 0, 0
                while at + size < len(batch) and lanes < together:
                    lanes += len(batch.column("blocks")[at + size])
                    size += 1
                some = batch.slice(at, size)
                at += size
                rows = some.to_pylist()
                decoded = iter(decode([b for row in rows for b in row["blocks"]]))
                doc_ids, starts, counts, crcs, ids = [], [], [], [], []
                for row in rows:
                    x = np.concatenate([next(decoded) for _ in row["blocks"]])
                    place = 0
                    for n in row["doc_tokens"]:
                        own = np.ascontiguousarray(x[place : place + n])
                        starts.append(row["before"] + place)
                        crcs.append(zlib.crc32(own))
                        if whole:
                            ids.append(own.astype(np.int64))
                        place += n
                    doc_ids += row["doc_ids"]
                    counts += row["doc_tokens"]
                parts_ = np.repeat(np.array([r["part"] for r in rows], np.int32), [len(r["doc_ids"]) for r in rows])
                arrays = [pa.array(doc_ids, some.column("doc_ids").type.value_type), pa.array(parts_), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(crcs, pa.int64())]
                names = ["doc_id", "part", "start", "n_tokens", "ids_crc32"]
                if whole:
                    arrays.append(pa.array(ids, pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    schema = f"doc_id {kind}, part int, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * whole
    rows = files.select("part", "before", "doc_ids", "doc_tokens", "blocks").mapInArrow(tidy(run), schema)
    return rows.join(parts, "part").select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if whole else []))
