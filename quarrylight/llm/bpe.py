"""Byte-pair encoding of a corpus as a streaming transducer with bounded lookahead, and the way back.

A text is cut into pieces by the vocabulary's pattern, which needs a few characters of lookahead. Within a piece, the
encoding of each prefix ends in one token, the only one that forms a stable pair with the token before it, so the
encodings of all prefixes form a tree. Tokens on the path to a prefix are stable once a lookahead stands behind them that
follows from the merge list and doesn't grow with the text; then they are emitted.
"""

from __future__ import annotations

import base64
import codecs
import math
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Characters of a text fed at once, and of a piece whose ids are remembered; pieces and pairs remembered; characters a
#: stream holds of an open piece before it feeds it on; bytes of a piece that is held as a whole, since that is little.
PART, SHORT, REMEMBERED, OPEN, LOOKED = 1 << 16, 64, 500_000, 512, 1024


def load_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file and their ids."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class BPE:
    """The encoder of one vocabulary: tokens by id, and of which two each is merged (parts[id] is None for a byte)."""

    def __init__(self, ranks: dict[bytes, int], parts: dict[int, tuple[int, int]] | None = None):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.pattern = regex.compile(PATTERN)
        self.transduced = 0  # bytes that transducers took in
        self.pieces = Pieces(self)
        self._pairs: dict[int, bool] = {}
        self._lookahead: int | None = None
        self.parts: dict[int, tuple[int, int]] = {} if parts is None else parts
        if parts is None:
            for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
                for k in range(1, len(token)):
                    left, right = ranks.get(token[:k]), ranks.get(token[k:])
                    if left is not None and right is not None and left < rank > right and self._stays(left, right, rank):
                        self.parts[rank] = left, right
                        break

    def _stays(self, left: int, right: int, below: float = math.inf) -> bool:
        """Whether no merge of a rank under `below` joins something across the boundary of the two tokens.

        Going back in time, the later of the two tokens next to the boundary is taken apart. Two of them would have been
        merged if their rank came before that at which either was taken up; of equal merges the left one comes first.
        """
        parts, ranks, tokens = self.parts, self.ranks, self.tokens
        until_left = until_right = below
        while True:
            rank = ranks.get(tokens[left] + tokens[right])
            if rank is not None and rank < until_left and rank <= until_right and rank < below:
                return False
            of_left, of_right = parts.get(left), parts.get(right)
            if of_left is not None and (of_right is None or left > right):
                until_left, left = left, of_left[1]
            elif of_right is not None:
                until_right, right = right, of_right[0]
            else:
                return True

    def stable(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are next to each other."""
        key = left << 32 | right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= REMEMBERED:
                self._pairs.clear()
            known = self._pairs[key] = self._stays(left, right)
        return known

    @property
    def lookahead(self) -> int:
        """The most bytes held back: a token, and the bytes behind it after which no merge can reach back to a boundary.

        Whether a boundary u|v is merged depends on what stands right of it only if an earlier merge takes away the
        right end of v, that is, if its left part ends v; whether that merge happens depends on its own right part in
        turn. The longest such sequence of ever earlier merges, with the lengths of the parts, bounds the reach.
        """
        if self._lookahead is None:
            reach: dict[int, tuple[list[int], list[int]]] = {}
            most = 0
            for token, (left, right) in sorted(self.parts.items()):
                end, far = right, 0
                while True:
                    if end in reach and (k := bisect_left(reach[end][0], token)):
                        far = max(far, reach[end][1][k - 1])
                    if end not in self.parts:
                        break
                    end = self.parts[end][1]
                ranks, fars = reach.setdefault(left, ([], []))
                ranks.append(token)
                fars.append(max(len(self.tokens[right]) + far, fars[-1] if fars else 0))
                most = max(most, len(self.tokens[right]) + far)
            self._lookahead = most + self.longest
        return self._lookahead

    def encode(self, text: str, part: int = PART) -> array:
        """The ids of a text, which is fed in parts; only they, a part and a bounded number of pieces are held."""
        run, out = StreamEncoder(self), array("i")
        for k in range(0, len(text) - part, part):
            out.extend(run.feed(text[k : k + part]))
        k = max(0, (len(text) - 1) // part) * part
        out.extend(run.finish(text[k:]))
        return out


class Pieces(dict):
    """What the transducer makes of each piece; that of short ones is remembered."""

    def __init__(self, bpe: BPE):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, text: str) -> list[int]:
        run = Transducer(self.bpe)
        ids = [*run.feed(text.encode()), *run.finish()]
        if len(text) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[text] = ids
        return ids


class Transducer:
    """Encodes one piece of any length, fed in parts of bytes; a token is emitted once no further byte can change it."""

    def __init__(self, bpe: BPE):
        self.bpe = bpe
        self.data = b""  # from the last emitted boundary on
        self.start = [0]  # of each prefix of data, where its last token begins
        self.last = [-1]  # and which it is; of the empty prefix, the token emitted last
        self.behind = 0  # the most bytes held after an emission

    def _extend(self, data: bytes) -> None:
        """The last tokens of the prefixes that data adds."""
        bpe, start, last = self.bpe, self.start, self.last
        ranks, stays, longest = bpe.ranks, bpe.stable, bpe.longest
        begun = len(self.data)
        self.data += data
        held = self.data
        for end in range(begun + 1, len(held) + 1):
            for begin in range(max(0, end - longest), end):
                token = ranks.get(held[begin:end])
                if token is not None and (last[begin] < 0 or stays(last[begin], token)):
                    start.append(begin)
                    last.append(token)
                    break
            else:
                raise ValueError("a byte isn't in the vocabulary")

    def _path(self, end: int) -> list[int]:
        ids = []
        while end:
            ids.append(self.last[end])
            end = self.start[end]
        return ids[::-1]

    def feed(self, data: bytes) -> list[int]:
        """The ids that are stable by now: those behind which no merge can reach back."""
        self.bpe.transduced += len(data)
        if len(self.data) + len(data) <= 2 * LOOKED:
            self._extend(data)
            return []
        ids, reach = [], self.bpe.lookahead - self.bpe.longest
        step = max(LOOKED, reach)
        for k in range(0, len(data), step):
            self._extend(data[k : k + step])
            cut = len(self.data)
            while cut > len(self.data) - reach and cut:
                cut = self.start[cut]
            if cut:
                ids += self._path(cut)
                self.data = self.data[cut:]
                self.start = [0] + [s - cut for s in self.start[cut + 1 :]]
                self.last = self.last[cut:]
            self.behind = max(self.behind, len(self.data))
        return ids

    def finish(self) -> list[int]:
        ids = self._path(len(self.data))
        self.data, self.start, self.last = b"", [0], [-1]
        return ids


class StreamEncoder:
    """Encodes a text fed in parts, in memory that doesn't grow with it."""

    RUNS = (regex.compile(r" ?\p{L}+"), regex.compile(r" ?\p{N}+"), regex.compile(r" ?[^\s\p{L}\p{N}]+"), regex.compile(r"\s+"))
    MORE = (regex.compile(r"\p{L}*"), regex.compile(r"\p{N}*"), regex.compile(r"[^\s\p{L}\p{N}]*"), regex.compile(r"\s*"))

    def __init__(self, bpe: BPE):
        self.bpe, self.text = bpe, ""
        self.kind, self.run = -1, None  # the open piece, once it is long

    def feed(self, part: str) -> list[int]:
        self.text += part
        return self._go(False)

    def finish(self, part: str = "") -> list[int]:
        self.text += part
        return self._go(True)

    def _go(self, last: bool) -> list[int]:
        ids: list[int] = []
        while True:
            if self.run:
                n = self.MORE[self.kind].match(self.text).end()
                ended = n < len(self.text)
                taken = n - (n > 0) * (self.kind == 3 and not (last and not ended))  # the last blank may belong to what follows
                ids += self.run.feed(self.text[:taken].encode())
                self.text = self.text[taken:]
                if not (ended or last):
                    return ids
                ids += self.run.finish()
                self.run = None
            pieces = self.bpe.pattern.findall(self.text)
            open_ = 0
            while not last and pieces and open_ < 3:  # more text might change what is so near the end
                open_ += len(pieces.pop())
            ids.extend(chain.from_iterable(map(self.bpe.pieces.__getitem__, pieces)))
            self.text = self.text[len(self.text) - open_ :] if open_ else ""
            if last or len(self.text) < OPEN:
                return ids
            self.kind = next(k for k, x in enumerate(self.RUNS) if x.match(self.text))
            n = self.RUNS[self.kind].match(self.text).end() - (self.kind == 3)
            self.run = Transducer(self.bpe)
            ids += self.run.feed(self.text[:n].encode())
            self.text = self.text[n:]


class StreamDecoder:
    """Ids fed in parts to text: a character comes out with its last byte; what isn't UTF-8 becomes U+FFFD."""

    def __init__(self, bpe: BPE):
        self.bpe, self.state = bpe, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(self.bpe.tokens[i] for i in ids))

    def finish(self) -> str:
        return self.state.decode(b"", final=True)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> tuple[dict[bytes, int], dict[int, tuple[int, int]]]:
    """Ranks and parts of a rank file, which an encoder is made of."""
    bpe = BPE(load_ranks(path))
    return bpe.ranks, bpe.parts


def _encode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = BPE(*shared.value)
        for batch in batches:
            flat, ends = array("i"), [0]
            texts = batch.column(1)
            for k in range(batch.num_rows):
                flat.extend(bpe.encode(texts[k].as_py() or ""))
                ends.append(len(flat))
                if len(flat) > 4_000_000 or k == batch.num_rows - 1:
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, dtype=np.int32) if flat else np.empty(0, dtype=np.int32)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(k + 2 - len(ends), len(ends) - 1), lists], names=["doc", "ids"])
                    flat, ends = array("i"), [0]

    return run


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc and ids: the token ids of each text, without special tokens.

    docs: doc long, text string; other columns are ignored; a row each, in any order. Null and empty texts have an empty
    list. Strings that look like special tokens are ordinary text. path names a rank file, read once on the driver; its
    tokens (some 50,000, as many for any corpus) are broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    return docs.select(F.col("doc").cast("long").alias("doc"), "text").mapInArrow(_encode(shared), "doc long, ids array<int>")


def _decode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = BPE(*shared.value)
        for batch in batches:
            texts = []
            for ids in batch.column(1).to_pylist():
                decoder = StreamDecoder(bpe)
                texts.append(None if ids is None else decoder.feed(ids) + decoder.finish())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc", "text"])

    return run


def decoded(docs: DataFrame, path: str) -> DataFrame:
    """doc and text of doc long, ids array<int>: the way back; null ids give a null text."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    return docs.select(F.col("doc").cast("long").alias("doc"), "ids").mapInArrow(_decode(shared), "doc long, text string")
